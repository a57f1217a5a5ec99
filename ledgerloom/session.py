"""Spark session settings the models rely on.

* session time zone UTC: epoch <-> date conversions must not depend on the host;
* AQE on (coalescing, skew-join splitting, runtime broadcast conversion);
* ANSI mode left on (Spark 4 default) — raw text goes through ``try_*`` functions;
* no UI server.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # A side is broadcast only when AQE has measured it below this size.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    # A task aggregates or parses what it reads, which takes 10 to 20 times the size of the file split or shuffle
    # partition (packed numbers, compressed JSON).  So these sizes bound its memory, whatever the input, and deal the
    # work out evenly; tables of many TB may take larger ones with larger executors.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32MB",
    "spark.sql.files.maxPartitionBytes": "64MB",
    # A partition over 5x the median and 256 MB is split by AQE (skewed joins and rebalances).
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "ledgerloom",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    On a cluster leave ``master`` unset and let spark-submit decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones anyway).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", os.environ.get("LEDGERLOOM_DRIVER_MEM", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # Runtime SQL confs also apply to a session that already existed.
    for k, v in conf.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def apply_sql_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings above to an existing session (e.g. one a driver created)."""
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for cut lineage / published tables.

    Read from ``spark.checkpoint.dir``.  Only a local-mode session (tests,
    the bench) gets a private scratch folder when the setting is unset; on a
    cluster an unset value is an error, never a machine-local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/ABFS) for this cluster")
    d = tempfile.mkdtemp(prefix="ledgerloom-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d
