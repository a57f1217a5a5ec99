"""Top-1 per key as an aggregate (skew-safe replacement for row_number() = 1).

``row_number() over (partition by k order by ...)`` needs every row of a key in
one task and a sort.  ``max(struct(order keys..., payload...))`` is an ordinary
aggregate: partial maxima are taken map-side before the shuffle, so a key that
holds a third of all rows is reduced in every input task first and only one row
per key and task crosses the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _desc_key(c: str, nulls_last: bool, i: int) -> list[Column]:
    col = F.col(c)
    if nulls_last:  # for a max: non-null beats null, then larger beats smaller
        return [col.isNotNull().alias(f"_k{i}n"), col.alias(f"_k{i}")]
    return [col.isNull().alias(f"_k{i}n"), col.alias(f"_k{i}")]


def top1_per_key(df: DataFrame, keys: Sequence[str], order_desc: Sequence[tuple[str, bool]],
                 payload: Sequence[str] | None = None) -> DataFrame:
    """Keep, per ``keys``, the row that is first under ``order by c1 desc, c2 desc, ...``.

    ``order_desc`` is a list of ``(column, nulls_last)``.  Give a unique column last
    for a deterministic result.  Returns ``keys + payload`` columns.
    """
    keys = list(keys)
    payload = [c for c in (payload or df.columns) if c not in keys]
    order_cols: list[Column] = []
    for i, (c, nulls_last) in enumerate(order_desc):
        order_cols += _desc_key(c, nulls_last, i)
    best = F.max(F.struct(*order_cols, F.struct(*[F.col(c) for c in payload]).alias("_row"))).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best._row.*")
