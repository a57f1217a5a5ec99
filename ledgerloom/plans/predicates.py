"""Filter texts over named columns, taken apart by Spark's own analyzer.

A filter text (``"customer__region = 'ASIA' and metric_time >= date'1996-01-01'"``) is analyzed once against an empty
frame that has a column for each name it may use.  Its conjuncts come back as texts with the names they use, so
that each can be applied to the table that owns those names.  An unknown name raises Spark's error.  No job runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Conjunct:
    text: str
    names: tuple[str, ...]
    #: Whether it holds where all its names are null, as they are for a row that finds no match.
    holds_on_nulls: bool

    def on(self, df: DataFrame, columns: dict[str, str]) -> DataFrame:
        """The rows of ``df`` that meet it; ``columns``: name -> SQL expression over ``df``.  The rows travel as one struct, so
        that no name clashes with a column; Spark takes the struct apart again and pushes the filter below it."""
        named = df.select(F.struct("*").alias("_row"), *[F.expr(columns[n]).alias(n) for n in self.names])
        return named.filter(F.expr(self.text)).select("_row.*")


def _split(condition) -> list:
    if condition.getClass().getSimpleName() == "And":
        return _split(condition.left()) + _split(condition.right())
    return [condition]


def _names(condition, names: Iterable[str]) -> tuple[str, ...]:
    """The names a condition refers to, in the case in which they are declared."""
    declared, found, it = {n.lower(): n for n in names}, set(), condition.references().iterator()
    while it.hasNext():
        found.add(declared[it.next().name().lower()])
    return tuple(sorted(found))


def _holds_on_nulls(spark: SparkSession, text: str, types: dict[str, T.DataType], names: Iterable[str]) -> bool:
    """By constant folding; what does not fold counts as holding."""
    nulls = spark.range(1).select(*[F.lit(None).cast(types[n]).alias(n) for n in names], F.lit(1).alias("_one"))
    value = nulls.select(F.expr(text).alias("_holds"))._jdf.queryExecution().optimizedPlan().expressions().head().child()
    return value.getClass().getSimpleName() != "Literal" or value.value() is True


def conjuncts(spark: SparkSession, where: str, name_types: Callable[[str], T.DataType], names: Iterable[str]) -> list[Conjunct]:
    """The conjuncts of ``where``.  ``names``: all it may use; ``name_types`` is asked for those that occur in it."""
    types = {n: name_types(n) for n in names if n.lower() in where.lower()}
    probe = spark.createDataFrame([], T.StructType([T.StructField(n, t) for n, t in types.items()]))
    condition = probe.filter(F.expr(where))._jdf.queryExecution().analyzed().condition()
    out = []
    for part in _split(condition):
        used = _names(part, types)
        out.append(Conjunct(part.sql(), used, _holds_on_nulls(spark, part.sql(), types, used)))
    return out
