"""Sinks: build runs, table writes, and contracts checked before anything is published.

A build writes into a folder of its own, ``root/runs/<run id>/{landed,intermediate,published}/<table>``,
so it never overwrites what it or any reader reads.  Each contracted table is *staged* there: cast to
its contract and written once; the write itself counts rows, nulls and every row rule (``DataFrame.observe``), and
the primary key is grouped on the written files.  A task that Spark repeats is observed twice, so the counts
are evidence only where their rows equal the written files' (read from the footers); otherwise the files are scanned.
The evidence is kept in the manifest, and quality checks of a published run use it instead of scanning.
Only after all checks does ``publish_run`` add a manifest, by a rename within the file system; readers
follow the newest manifest.  A crash before that leaves the previous run in force, and a later build starts
a new run.  All paths go through the Hadoop file system of their scheme, so ``hdfs:``, ``s3a:``, ``abfss:`` and
``file:`` roots behave alike.  Old runs are kept until a caller asks for ``remove_old_runs``.

Facts are rebalanced on their month before the write (AQE splits a hot month
across tasks instead of landing it in one) and written partitioned by month,
so date filters prune whole folders.
"""

from __future__ import annotations

import json
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.quality import CONTRACTS, PRIMARY_KEY, ROWS, enforce_contract, null_measure, row_measures
from ledgerloom.sources.descriptions import COLUMN_TEXT, TABLE_TEXT

# Model -> date column for month partitioning.
TABLE_MONTH = {"fct_sales_orders": "order_date", "fct_order_lines": "order_date", "fct_b2b_orders": "order_date",
               "consolidated_revenue": "order_date"}
# Partition column of month-partitioned tables (folder ``p_month=YYYY-MM-01``); dropped on read.
PART_COL = "p_month"
LAYERS = ("landed", "intermediate", "published")
# A run id starts with the time at which the run began (UTC), so ids sort by time.
BEGUN = "%Y%m%dT%H%M%S"


class ContractViolation(RuntimeError):
    pass


# ---------------------------------------------------------------- files through Hadoop

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def _names(spark: SparkSession, folder: str) -> list[str]:
    p, fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Appears under its name only when complete: written aside, then renamed to a new name."""
    aside, fs = _fs(spark, f"{path}.writing")
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(aside, _fs(spark, path)[0]):
        raise OSError(f"cannot rename to {path}")


# ---------------------------------------------------------------- runs

@dataclass
class Run:
    """Tables of one build.  ``tables``: layer -> names that are written completely; ``evidence``: ``layer/name`` -> what the
    write counted."""
    root: str
    run_id: str
    tables: dict[str, list[str]] = field(default_factory=lambda: {k: [] for k in LAYERS})
    evidence: dict[str, dict[str, int]] = field(default_factory=dict)

    def path(self, layer: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/runs/{self.run_id}/{layer}/{name}"

    def has(self, layer: str, name: str) -> bool:
        return name in self.tables[layer]


def _manifests(root: str) -> str:
    return f"{root.rstrip('/')}/manifests"


def new_run(root: str) -> Run:
    return Run(root, f"{time.strftime(BEGUN, time.gmtime())}-{time.time_ns() % 10**9:09d}-{uuid.uuid4().hex[:8]}")


def publish_run(spark: SparkSession, run: Run) -> None:
    _write_text(spark, f"{_manifests(run.root)}/{run.run_id}.json", json.dumps(
        {"run": run.run_id, "tables": run.tables, "evidence": run.evidence}))


def current_run(spark: SparkSession, root: str) -> Run:
    """The newest published run; raises when there is none (nothing is derived anew in silence)."""
    names = [n for n in _names(spark, _manifests(root)) if n.endswith(".json")]
    if not names:
        raise FileNotFoundError(f"no published run under {root}")
    text = "".join(r.value for r in spark.read.text(f"{_manifests(root)}/{names[-1]}").collect())
    found = json.loads(text)
    return Run(root, found["run"], found["tables"], found.get("evidence", {}))


def old_runs(spark: SparkSession, root: str) -> list[str]:
    """Folders of runs other than the one in force (replaced, or never published)."""
    now = current_run(spark, root).run_id
    return [f"{root.rstrip('/')}/runs/{n}" for n in _names(spark, f"{root.rstrip('/')}/runs") if n != now]


def remove_old_runs(spark: SparkSession, root: str, keep: int = 2, abandoned_after_hours: float = 48) -> list[str]:
    """Removes the published runs but the newest ``keep`` (one at least), and runs begun more than ``abandoned_after_hours``
    ago that were never published; younger ones may be builds at work.  A manifest goes before its tables, so no reader
    is led to a run that is half gone; readers that opened an older run must be done with it.  Returns the run ids."""
    if keep < 1:
        raise ValueError("the run in force is always kept")
    published = [n.removesuffix(".json") for n in _names(spark, _manifests(root)) if n.endswith(".json")]
    begun_by = time.strftime(BEGUN, time.gmtime(time.time() - 3600 * abandoned_after_hours))
    begun = _names(spark, f"{root.rstrip('/')}/runs")
    gone = [n for n in begun if n not in published and n.split("-")[0] < begun_by] + published[:-keep]
    for run_id in gone:
        for path in (f"{_manifests(root)}/{run_id}.json", f"{root.rstrip('/')}/runs/{run_id}"):
            p, fs = _fs(spark, path)
            if fs.exists(p) and not fs.delete(p, True):
                raise OSError(f"cannot remove {path}")
    return gone


# ---------------------------------------------------------------- tables

def with_comments(df: DataFrame, model: str) -> DataFrame:
    """Column descriptions, and the table's on its first column, as field metadata (kept in the Parquet schema)."""
    def meta(k: int, c: str) -> dict:
        out = {"comment": COLUMN_TEXT[c]} if c in COLUMN_TEXT else {}
        return out | ({"table_comment": TABLE_TEXT[model]} if not k and model in TABLE_TEXT else {})

    return df.select(*[F.col(c).alias(c, metadata=meta(k, c)) for k, c in enumerate(df.columns)])


def write_table(df: DataFrame, path: str, month_of: str | None = None, mode: str = "errorifexists",
                measures: dict[str, Column] | None = None) -> dict[str, int] | None:
    """Parquet table; with ``month_of`` partitioned by that date's month.  Returns what ``measures`` (with one named ``ROWS``) counted
    on the way, or None where that cannot be trusted.

    The ``rebalance`` hint clusters rows by month without a sampling pass; AQE
    then splits a month that is too large for one task and merges small ones,
    so a hot month is written by several tasks and no task writes every month.
    """
    seen = Observation() if measures else None
    if measures:
        df = df.observe(seen, *[c.alias(name) for name, c in measures.items()])
    if month_of:
        df = df.withColumn(PART_COL, F.trunc(F.col(month_of), "month")).hint("rebalance", PART_COL)
        df.write.mode(mode).partitionBy(PART_COL).parquet(path)
    else:
        df.write.mode(mode).parquet(path)
    if not measures:
        return None
    counted = seen.get
    return counted if counted[ROWS] == df.sparkSession.read.parquet(path).count() else None


def read_table(spark, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.drop(PART_COL) if PART_COL in df.columns else df


def repeated_keys(written: DataFrame, pk: str) -> int:
    """Values of the key that occur more than once (nulls are counted as nulls)."""
    return (written.where(F.col(pk).isNotNull()).groupBy(pk).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").count())


def write_contracted(df: DataFrame, model: str, path: str, tolerate: frozenset = frozenset()) -> dict:
    """Stages a contracted table and checks it; raises ``ContractViolation`` unless every broken
    ``model.column`` is listed in ``tolerate``.  Missing columns and types that cannot be cast fail first."""
    pk, cols = CONTRACTS[model]
    measures = row_measures(model)
    counted = write_table(with_comments(enforce_contract(df, model), model), path, TABLE_MONTH.get(model), measures=measures)
    written = read_table(df.sparkSession, path)
    if counted is None:
        counted = written.agg(*[c.alias(name) for name, c in measures.items()]).first().asDict()
    found = {c: n for c, _, required in cols if required and (n := counted[null_measure(c)])}
    if pk:
        counted[PRIMARY_KEY] = repeated_keys(written, pk)
        if counted[PRIMARY_KEY]:
            found[pk] = found.get(pk, 0) + counted[PRIMARY_KEY]
    bad = {c: n for c, n in found.items() if f"{model}.{c}" not in tolerate}
    if bad:
        raise ContractViolation(f"{model}: {bad}")
    return {"model": model, "path": path, "violations": found, "evidence": counted}


def write_measured(df: DataFrame, model: str, path: str) -> dict:
    """Writes a table without a contract; with its tests' row rules as evidence."""
    return {"model": model, "path": path, "evidence": write_table(with_comments(df, model), path, TABLE_MONTH.get(model),
                                                                  measures=row_measures(model))}


def write_landed(df: DataFrame, path: str) -> dict:
    """Writes a raw table; its rows and last sync time are evidence."""
    return {"path": path, "evidence": write_table(df, path, measures={
        ROWS: F.count(F.lit(1)), "synced": F.max(F.unix_micros(F.col("_fivetran_synced").cast("timestamp")))})}
