"""Small helpers shared by the operators: reading a table and mapping Arrow batches.

An Arrow batch holds at most ``BATCH_ROWS`` rows and about ``BATCH_BYTES``, so a task's Python worker keeps a few
hundred texts at a time, whatever the size of the input split.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BATCH_ROWS, BATCH_BYTES = 256, 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; an unset value is
    replaced by a scratch folder in local mode (tests) and refused on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found:
        return found
    from ledgerloom.session import checkpoint_dir
    return checkpoint_dir(spark)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: its lineage ends there."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def run_folder(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that do not clash (in any case) with those of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def map_arrow(df: DataFrame, worker: Callable[[], Callable[[pa.RecordBatch], dict]],
              schema: T.StructType) -> DataFrame:
    """``worker()`` runs once in each task and gives the function from a batch to its output columns."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = worker()
        for batch in batches:
            if batch.num_rows:
                columns = each(batch)
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type)
                     for f, c in ((f, columns[f.name]) for f in arrow)], schema=arrow)

    return df.mapInArrow(run, schema)


def filter_arrow(df: DataFrame, worker: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """Like :func:`map_arrow`, for functions that keep the columns and may drop rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = worker()
        for batch in batches:
            if batch.num_rows:
                yield each(batch)

    return df.mapInArrow(run, df.schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def schema_of(df: DataFrame, columns: Iterable[str], *more: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([df.schema[c] for c in columns] + [T.StructField(n, t) for n, t in more])
