"""From any metric cell back to the raw rows behind it.

``audit_trace(project, metric, keys)`` resolves a metric to its simple metrics, each of them to its semantic model, and
the model to the raw table that feeds it.  The cell's fact rows are found as a metric query finds them (filters on own
names, semi-joins on entities), reduced to their lineage key, and joined to the live raw rows on the raw columns
that make up that key.  Where a feed repeats an id, the key takes in every column that the model derives its row
from, so that each raw row carries the measure of its own fact row and the traced rows add up to the metric.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.expr import live_rows
from ledgerloom.operators.staging import current_versions
from ledgerloom.plans.metrics import (
    DERIVED_METRICS,
    RATIO_METRICS,
    SEMANTIC_MODELS,
    SIMPLE_METRICS,
    SimpleMetric,
    filtered,
)


@dataclass(frozen=True)
class Lineage:
    """``key``: fact column -> expression over the raw table.  ``position``: fact column with the place inside the
    raw row (of an array).  ``rows``: the raw rows that can stand behind a fact row, by default the live ones."""
    table: str
    key: dict[str, str]
    position: str | None = None
    rows: Callable[[DataFrame], DataFrame] = field(default=lambda raw: raw.filter(live_rows()))


#: Semantic model -> where its rows come from.
LINEAGE = {
    "customers": Lineage("customers", {"customer_id": "customer_id"}, rows=current_versions),
    "sales_orders": Lineage("sales_orders", {"order_id": "id"}),
    "order_lines": Lineage("sales_orders", {"order_id": "id"}, position="line_number"),
    "b2b_orders": Lineage("ret_orders", {"order_id": "id", "b2b_customer_id": "order_user_id", "amount": "amount", "status": "status",
                                         "order_date": "cast(created_at as date)"}),
}


def simple_metrics(name: str) -> list[SimpleMetric]:
    """The simple metrics that a metric is made of."""
    if name in SIMPLE_METRICS:
        return [SIMPLE_METRICS[name]]
    inputs = ([RATIO_METRICS[name].numerator, RATIO_METRICS[name].denominator] if name in RATIO_METRICS
              else DERIVED_METRICS[name].inputs)
    return list(dict.fromkeys(m for i in inputs for m in simple_metrics(i)))


def _literal(value) -> str:
    if value is None:
        return "null"
    if isinstance(value, bool):
        return str(value).lower()
    return str(value) if isinstance(value, int | float) else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def cell(keys: dict) -> str | None:
    """A filter text for the cell with these group keys (null keys are a cell too)."""
    return " and ".join(f"`{k}` <=> {_literal(v)}" for k, v in keys.items()) or None


def cell_rows(project, model_key: str, metrics: list[SimpleMetric], where: str | None) -> DataFrame:
    """The lineage key, position and each metric's measure of the cell's fact rows."""
    sm, origin = SEMANTIC_MODELS[model_key], LINEAGE[model_key]
    rows = filtered(project, sm, project[sm.name], where)
    measures = [F.when(F.expr(m.expr).isNotNull(), F.lit(1)).otherwise(0).alias(m.name) if m.agg == "count"
                else F.expr(m.expr).alias(m.name) for m in metrics]
    place = F.col(origin.position) if origin.position else F.lit(None)
    return rows.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(origin.key)], place.cast("int").alias("position"), *measures)


def raw_cell(project, model_key: str, metrics: list[SimpleMetric], where: str | None) -> DataFrame:
    """Raw rows of the cell, all their columns, with position and measures."""
    origin = LINEAGE[model_key]
    facts = cell_rows(project, model_key, metrics, where)
    names = [f"_k{i}" for i in range(len(origin.key))]
    # Fact rows that agree in the whole key have the same measures; each meets its own raw row once.
    facts = facts.groupBy(*names, "position").agg(*[F.first(m.name).alias(m.name) for m in metrics])
    raw = origin.rows(project.raw.table(origin.table))
    raw = raw.select("*", *[F.expr(e).alias(f"_r{i}") for i, e in enumerate(origin.key.values())])
    same = reduce(lambda a, b: a & b, [(F.col(f"_r{i}") == F.col(n)) if not i else F.col(f"_r{i}").eqNullSafe(F.col(n))
                                       for i, n in enumerate(names)])
    return raw.join(facts, same).drop(*names, *[f"_r{i}" for i in range(len(names))])


def audit_trace(project, metric: str, keys: dict) -> DataFrame:
    """What stands behind the cell ``keys`` (group key -> value) of a metric: for each simple metric and each raw row the source
    table, its id, the position inside it (of lines), its sync time, and the row's contribution.  Contributions of a metric that
    adds up sum to its value in the cell; those of a count are 1 or 0, of other measures the measured values."""
    by_model: dict[str, list[SimpleMetric]] = {}
    for m in simple_metrics(metric):
        by_model.setdefault(m.model, []).append(m)
    parts = []
    for model_key, metrics in by_model.items():
        rows = raw_cell(project, model_key, metrics, cell(keys))
        pairs = F.array(*[F.struct(F.lit(m.name).alias("metric"), F.col(m.name).cast("decimal(38,2)").alias("contribution"))
                          for m in metrics])
        parts.append(rows.select(F.lit(LINEAGE[model_key].table).alias("source_table"), F.col("id").cast("string").alias("source_id"),
                                 "position", F.col("_fivetran_synced").alias("synced_at"), F.inline(pairs)))
    return reduce(DataFrame.unionByName, parts).select("metric", "source_table", "source_id", "position", "synced_at", "contribution")


def regional_trace(project, region: str, month: str) -> DataFrame:
    """Raw orders behind one (region, month) cell of regional performance."""
    keys = {"customer__region": region, "metric_time__month": month}
    rows = raw_cell(project, "sales_orders", [SIMPLE_METRICS["total_b2c_revenue"]], cell(keys))
    return rows.select(F.col("id").alias("order_id"), "customer_id", "order_datetime", "promo_info", "_fivetran_deleted",
                       F.col("_fivetran_synced").alias("synced_at"), F.col("total_b2c_revenue").alias("total_revenue"))
