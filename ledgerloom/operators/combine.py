"""Combine per-key results of independent aggregates without joins.

Frames that share the key columns and carry disjoint value columns are
stacked (``unionByName``, missing columns null) and folded with one group-by
taking ``max`` of each value column: one shuffle for any number of inputs,
null keys group together (no null-safe join condition needed), and single-row
results need no cross or nested-loop join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combine_on_keys(frames: Sequence[DataFrame], keys: Sequence[str] = ()) -> DataFrame:
    keys = list(keys)
    stacked = frames[0]
    for f in frames[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    values: list[str] = []
    for f in frames:
        values += [c for c in f.columns if c not in keys and c not in values]
    aggs = [F.max(c).alias(c) for c in values]
    return stacked.groupBy(*keys).agg(*aggs) if keys else stacked.agg(*aggs)
