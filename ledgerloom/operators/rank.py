"""Global percent rank without a single-partition window over rows.

``percent_rank() over (order by x)`` with no partition moves every row into one task.  Here the
rank of a value is the number of rows before it, summed over four levels of 16-bit digits of the
64-bit integer: at each level, rows whose higher digits agree and whose digit is smaller come
before.

1. ``hist``: one row per distinct value with its count (partial aggregate);
2. per level, counts by (higher digits, digit), and their running sum within the higher digits:
   a window over at most 65,537 rows, whatever the data;
3. each distinct value adds up its four running sums and is joined back to the rows.

A value's digits are data, so the result does not depend on how rows are partitioned, sampled or
exchanges reused.  Ties share a rank, as with ``rank()``; nulls come first or last as one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS, LEVELS = 16, 4


def _digit(y: Column, level: int, null_digit: int) -> Column:
    """16 bits of the value; nulls are a digit of their own below or above all others."""
    return F.coalesce(F.shiftrightunsigned(y, BITS * level).bitwiseAND((1 << BITS) - 1), F.lit(null_digit).cast("long"))


def _higher(y: Column, level: int) -> Column:
    if level == LEVELS - 1:
        return F.lit(0).cast("long")
    return F.coalesce(F.shiftrightunsigned(y, BITS * (level + 1)), F.lit(-1).cast("long"))


def percent_rank_table(df: DataFrame, value: str, descending: bool = True, nulls_first: bool = True) -> DataFrame:
    """Distinct ``value`` (an integer column) -> ``pct_rank`` (double)."""
    if not isinstance(df.schema[value].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise TypeError(f"{value}: percent rank needs an integer column")
    v = F.col(value).cast("long")
    # Flipping the sign bit makes the unsigned order that of the signed values; ~v reverses it.
    y = (F.bitwise_not(v) if descending else v).bitwiseXOR(F.lit(-2**63).cast("long"))
    null_digit = -1 if nulls_first else 1 << BITS
    hist = df.groupBy(value).agg(F.count(F.lit(1)).alias("_cnt")).withColumn("_y", y)
    out = hist.withColumn("_before", F.lit(0).cast("long"))
    for level in range(LEVELS - 1, -1, -1):
        sums = (hist.groupBy(_higher(F.col("_y"), level).alias("_h"), _digit(F.col("_y"), level, null_digit).alias("_d"))
                .agg(F.sum("_cnt").alias("_c")))
        w = Window.partitionBy("_h").orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
        cols = ["_h", "_d", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_less")]
        if level == LEVELS - 1:  # one group, so its total is the number of rows
            cols.append(F.sum("_c").over(Window.partitionBy("_h")).alias("_n"))
        out = (out.withColumn("_h", _higher(F.col("_y"), level)).withColumn("_d", _digit(F.col("_y"), level, null_digit))
               .join(sums.select(*cols), ["_h", "_d"])
               .withColumn("_before", F.col("_before") + F.col("_less")).drop("_h", "_d", "_less"))
    return out.select(value, F.when(F.col("_n") <= 1, F.lit(0.0))
                      .otherwise(F.col("_before").cast("double") / (F.col("_n") - 1)).alias("pct_rank"))


def with_percent_rank(df: DataFrame, value: str, descending: bool = True, nulls_first: bool = True,
                      out: str = "pct_rank") -> DataFrame:
    """``df`` plus ``out`` = percent rank of ``value`` over all rows."""
    table = percent_rank_table(df, value, descending, nulls_first).select(
        F.col(value).alias("_v"), F.col("pct_rank").alias(out))
    return df.join(table, F.col(value).eqNullSafe(F.col("_v")), "left").drop("_v")
