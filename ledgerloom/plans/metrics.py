"""Metric layer: semantic models, simple / ratio / derived metrics, metric queries.

A metric query ``metric_query(project, metrics, group_by, where)`` resolves
each metric to its semantic model, left-joins foreign dimensions through the
shared entity, truncates ``metric_time`` to the grain, aggregates, and joins
metrics of different models on null-safe group keys.  Spec resolution is a
few dict lookups on the driver; all row work is one Spark plan.

Every measure is aggregated by the model's own keys and its entities' keys before a dimension is joined: sums and
counts are added up, an average travels as sum and count, a distinct count as the distinct values of each key.
A filter on an entity's dimensions becomes a semi-join of the entity's key before that.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import config as C
from ledgerloom.functions.expr import average
from ledgerloom.operators.combine import combine_on_keys
from ledgerloom.plans.predicates import Conjunct, conjuncts

GRAINS = {"day": None, "week": "week", "month": "month", "quarter": "quarter", "year": "year"}


@dataclass(frozen=True)
class SemanticModel:
    name: str                     # model in the project
    primary_entity: str | None    # entity name whose key is unique in the model
    entity_keys: dict             # entity name -> key column
    time_dimension: str | None    # agg_time_dimension (day grain)
    dimensions: dict = field(default_factory=dict)  # dimension name -> column expression (str)


@dataclass(frozen=True)
class SimpleMetric:
    name: str
    model: str
    agg: str          # "sum" | "count" | "count_distinct" | "avg" | "max" | "min"
    expr: str         # SQL expression over the model's columns


@dataclass(frozen=True)
class RatioMetric:
    name: str
    numerator: str
    denominator: str


@dataclass(frozen=True)
class DerivedMetric:
    name: str
    expr: str                 # expression over input metric names
    inputs: tuple


# ---------------------------------------------------------------- fixed values
SEMANTIC_MODELS = {
    "customers": SemanticModel("dim_customers", "customer", {"customer": "customer_id"}, "customer_since_date",
                               {"region": "region", "state": "state", "city": "city",
                                "loyalty_tier": "loyalty_segment_description",
                                "value_segment": "customer_value_segment"}),
    "sales_orders": SemanticModel("fct_sales_orders", "sales_order",
                                  {"sales_order": "order_id", "customer": "customer_id"}, "order_date",
                                  {"has_promo": "has_promo"}),
    "b2b_orders": SemanticModel("fct_b2b_orders", "b2b_order",
                                {"b2b_order": "order_id", "b2b_customer": "b2b_customer_id"}, "order_date",
                                {"status": "status", "is_cancelled_or_returned": "is_cancelled_or_returned"}),
    # Of this library: lines, which have no unique key of one column.
    "order_lines": SemanticModel("fct_order_lines", None, {"sales_order": "order_id", "customer": "customer_id"}, "order_date",
                                 {"product_category": "product_category", "has_catalog_match": "has_catalog_match"}),
}

SIMPLE_METRICS = {m.name: m for m in [
    SimpleMetric("total_customers", "customers", "count", "customer_id"),
    SimpleMetric("total_units_purchased", "customers", "sum", "units_purchased"),
    SimpleMetric("total_b2c_revenue", "sales_orders", "sum", "total_revenue"),
    SimpleMetric("total_b2c_orders", "sales_orders", "count", "order_id"),
    SimpleMetric("total_line_items", "sales_orders", "sum", "number_of_line_items"),
    SimpleMetric("total_b2b_orders", "b2b_orders", "count", "order_id"),
    SimpleMetric("total_b2b_revenue", "b2b_orders", "sum", "amount"),
    SimpleMetric("b2b_cancelled_amount", "b2b_orders", "sum",
                 "case when is_cancelled_or_returned then amount else 0 end"),
    # Of this library: measures of lines, and some that do not add up.
    SimpleMetric("total_line_revenue", "order_lines", "sum", "line_revenue"),
    SimpleMetric("total_line_units", "order_lines", "sum", "quantity"),
    SimpleMetric("distinct_line_products", "order_lines", "count_distinct", "product_id"),
    SimpleMetric("distinct_promo_codes", "sales_orders", "count_distinct", "promo_code"),
    SimpleMetric("distinct_buyers", "sales_orders", "count_distinct", "customer_id"),
    SimpleMetric("avg_items_per_order", "sales_orders", "avg", "number_of_line_items"),
    SimpleMetric("largest_order", "sales_orders", "max", "total_revenue"),
]}

RATIO_METRICS = {m.name: m for m in [
    RatioMetric("avg_b2c_order_value", "total_b2c_revenue", "total_b2c_orders"),
    RatioMetric("b2b_cancellation_rate", "b2b_cancelled_amount", "total_b2b_revenue"),
    RatioMetric("avg_b2b_order_value", "total_b2b_revenue", "total_b2b_orders"),
    RatioMetric("avg_units_per_customer", "total_units_purchased", "total_customers"),
]}

DERIVED_METRICS = {m.name: m for m in [
    DerivedMetric("revenue_per_customer", "try_divide(double(total_b2c_revenue), double(total_customers))",
                  ("total_b2c_revenue", "total_customers")),
]}


AGGREGATES = {"sum": F.sum, "count": F.count, "count_distinct": F.count_distinct, "max": F.max, "min": F.min,
              "avg": lambda c: average(F.sum(c), F.count(c))}
#: Aggregates that can be taken in two steps, with the second step's aggregate.
REAGGREGATE = {"sum": "sum", "count": "sum", "max": "max", "min": "min"}


def aggregate(kind: str, expr: Column) -> Column:
    return AGGREGATES[kind](expr)


def entity_model(entity: str) -> SemanticModel:
    return next(m for m in SEMANTIC_MODELS.values() if m.primary_entity == entity)


_WORD = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _words(expressions: Iterable[str]) -> set[str]:
    return {w for e in expressions for w in _WORD.findall(e)}


def _columns(project, model: str, *expressions: str) -> DataFrame:
    """The columns of a model that occur in the expressions (so a branch behind any other is left out)."""
    words = _words(expressions)
    return project.model(model, [c for c in project[model].columns if c in words])


def _split(sm: SemanticModel, group_by: list[str]) -> tuple[dict[str, Column], dict[str, dict[str, str]]]:
    """Own keys (output name -> column), and per foreign entity its dimensions (output name -> expression)."""
    own: dict[str, Column] = {}
    foreign: dict[str, dict[str, str]] = {}
    for g in group_by:
        if g.startswith("metric_time"):
            grain = GRAINS[g.split("__", 1)[1] if "__" in g else "day"]
            t = F.col(sm.time_dimension)
            own[g] = t if grain is None else F.date_trunc(grain, t).cast("date")
        elif "__" not in g:
            own[g] = F.expr(sm.dimensions[g])
        else:
            entity, dim = g.split("__", 1)
            target = entity_model(entity)
            if target is sm:
                own[g.replace("__", "_")] = F.expr(sm.dimensions[dim])
            else:
                foreign.setdefault(entity, {})[g.replace("__", "_")] = target.dimensions[dim]
    return own, foreign


def _with_entities(project, sm: SemanticModel, df: DataFrame, foreign: dict, keys: dict[str, str]) -> DataFrame:
    """``df`` left-joined once to each foreign entity; ``keys``: entity -> its key column in ``df``."""
    for entity, dims in foreign.items():
        target = entity_model(entity)
        pk = target.entity_keys[entity]
        side = _columns(project, target.name, pk, *dims.values()).select(
            F.col(pk).alias(f"_pk_{entity}"), *[F.expr(e).alias(out) for out, e in dims.items()])
        df = df.join(side, df[keys[entity]] == side[f"_pk_{entity}"], "left").drop(f"_pk_{entity}")
    return df


def _filter_names(project, sm: SemanticModel) -> dict[str, tuple[str | None, str]]:
    """What a filter may name for this model: name -> (foreign entity or None, expression)."""
    names = {c: (None, c) for c in project[sm.name].columns}
    names |= {n: (None, e) for n, e in sm.dimensions.items()}
    if sm.time_dimension:
        for grain, unit in GRAINS.items():
            e = sm.time_dimension if unit is None else f"cast(date_trunc('{unit}', {sm.time_dimension}) as date)"
            names[f"metric_time__{grain}"] = (None, e)
        names["metric_time"] = names["metric_time__day"]
    for entity in sm.entity_keys:
        target = next((m for m in SEMANTIC_MODELS.values() if m.primary_entity == entity), None)
        if target:
            names |= {f"{entity}__{d}": (None if target is sm else entity, e) for d, e in target.dimensions.items()}
    return names


def _conjuncts(project, sm: SemanticModel, where: str) -> tuple[list[Conjunct], dict[str, tuple[str | None, str]]]:
    names = _filter_names(project, sm)

    def type_of(name: str):
        entity, e = names[name]
        source = sm if entity is None else entity_model(entity)
        return project[source.name].select(F.expr(e).alias("x")).schema["x"].dataType

    return conjuncts(project.spark, where, type_of, names), names


def filtered(project, sm: SemanticModel, df: DataFrame, where: str | None) -> DataFrame:
    """Rows of the model that meet ``where``.  A conjunct on the model's own names is a filter of its scan; one on the
    names of one entity is a semi-join of that entity's key; any other (several entities in one conjunct, or one that holds
    for rows without a match) joins the names it needs."""
    if not where:
        return df
    parts, names = _conjuncts(project, sm, where)
    by_entity: dict[str, list[Conjunct]] = {}
    late, mixed = [], []
    for part in parts:
        entities = {names[n][0] for n in part.names}
        if entities <= {None}:
            columns = {n: names[n][1] for n in part.names}
            if project.for_filter(sm.name, df, words := _words(columns.values())) is not df:
                late.append((part, columns, words))  # after the filters that cost less
            else:
                df = part.on(df, columns)
        elif len(entities) == 1 and not part.holds_on_nulls:
            by_entity.setdefault(entities.pop(), []).append(part)
        else:
            mixed.append(part)
    df = project.for_filter(sm.name, df, {w for _, _, words in late for w in words})
    for part, columns, _ in late:
        df = part.on(df, columns)
    for entity, own in by_entity.items():
        target = entity_model(entity)
        pk = target.entity_keys[entity]
        used = {n: names[n][1] for part in own for n in part.names}
        side = _columns(project, target.name, pk, *used.values()).select(
            F.col(pk).alias("_pk"), *[F.expr(e).alias(n) for n, e in used.items()])
        for part in own:
            side = part.on(side, {n: f"`{n}`" for n in part.names})
        side = side.select("_pk")
        df = df.join(side, df[sm.entity_keys[entity]] == side["_pk"], "left_semi")
    for part in mixed:
        foreign: dict[str, dict[str, str]] = {}
        for n in part.names:
            if names[n][0]:
                foreign.setdefault(names[n][0], {})[n] = names[n][1]
        joined = _with_entities(project, sm, df, foreign, {e: sm.entity_keys[e] for e in foreign})
        columns = {n: f"`{n}`" if names[n][0] else names[n][1] for n in part.names}
        df = part.on(joined, columns).select(*df.columns)
    return df


def _simple_frame(project, model_key: str, metrics: list[SimpleMetric], group_by: list[str],
                  where: str | None) -> tuple[DataFrame, list[str]]:
    """Metrics of one semantic model, filtered, aggregated by its own keys and its entities' keys, then joined to
    the entities and aggregated to the group keys."""
    sm = SEMANTIC_MODELS[model_key]
    own, foreign = _split(sm, group_by)
    asked = " ".join([*group_by, where or ""])
    needed = [sm.time_dimension or "", *sm.entity_keys.values(), *[e for d, e in sm.dimensions.items() if d in asked],
              *[m.expr for m in metrics], where or ""]
    df = filtered(project, sm, _columns(project, sm.name, *needed), where)
    names = [g if g.startswith("metric_time") else g.replace("__", "_") for g in group_by]
    if not names:  # global metric: one group, keyed by a constant so all metric frames share a key
        own, names = {"_all": F.lit(1)}, ["_all"]
    if not foreign:
        return widen_decimals(df.groupBy(*[own[n].alias(n) for n in names]).agg(
            *[aggregate(m.agg, F.expr(m.expr)).alias(m.name) for m in metrics])), names
    entity_keys = {e: f"_fk_{e}" for e in foreign}
    keys = [*[c.alias(n) for n, c in own.items()], *[F.col(sm.entity_keys[e]).alias(k) for e, k in entity_keys.items()]]

    def over_entities(first: DataFrame, aggs: list[Column]) -> DataFrame:
        return _with_entities(project, sm, first, foreign, entity_keys).groupBy(*names).agg(*aggs)

    frames = []
    plain = [m for m in metrics if m.agg != "count_distinct"]
    if plain:
        first, second = [], []
        for m in plain:
            e = F.expr(m.expr)
            if m.agg == "avg":
                first += [F.sum(e).alias(f"{m.name}_sum"), F.count(e).alias(f"{m.name}_n")]
                second.append(average(F.sum(f"{m.name}_sum"), F.sum(f"{m.name}_n")).alias(m.name))
            else:
                first.append(aggregate(m.agg, e).alias(m.name))
                second.append(aggregate(REAGGREGATE[m.agg], F.col(m.name)).alias(m.name))
        frames.append(over_entities(df.groupBy(*keys).agg(*first), second))
    # A key's repeated values meet before the join; a key whose values are all null still makes its group.
    frames += [over_entities(df.select(*keys, F.expr(m.expr).alias("_value")).distinct(),
                             [F.count_distinct("_value").alias(m.name)]) for m in metrics if m.agg == "count_distinct"]
    return widen_decimals(frames[0] if len(frames) == 1 else combine_on_keys(frames, names)), names


def widen_decimals(df: DataFrame) -> DataFrame:
    """Decimal aggregates as decimal(38, scale): one result type whatever the input precision."""
    from pyspark.sql.types import DecimalType
    return df.select(*[F.col(f.name).cast(DecimalType(38, f.dataType.scale)).alias(f.name)
                       if isinstance(f.dataType, DecimalType) else F.col(f.name) for f in df.schema.fields])


def metric_query(project, metrics: list[str], group_by: list[str] | None = None,
                 where: str | None = None) -> DataFrame:
    """Evaluate simple, ratio and derived metrics at the same group keys.

    ``group_by`` items: ``metric_time__<grain>``, a local dimension name, or
    ``<entity>__<dimension>`` (joined through the entity).  ``where`` is a filter text over the same names and the
    models' own columns; each of its conjuncts holds for every model that takes part, so a name that one of them does
    not have is an error.  Ratio results are ``double(numerator) / double(denominator)`` (null when the denominator is 0).
    """
    group_by = list(group_by or [])
    needed: list[str] = []

    def need(name: str):
        if name in SIMPLE_METRICS:
            if name not in needed:
                needed.append(name)
        elif name in RATIO_METRICS:
            need(RATIO_METRICS[name].numerator)
            need(RATIO_METRICS[name].denominator)
        else:
            for i in DERIVED_METRICS[name].inputs:
                need(i)

    for m in metrics:
        need(m)
    by_model: dict[str, list[SimpleMetric]] = {}
    for n in needed:
        by_model.setdefault(SIMPLE_METRICS[n].model, []).append(SIMPLE_METRICS[n])
    frames, names = [], None
    for model_key, ms in by_model.items():
        f, names = _simple_frame(project, model_key, ms, group_by, where)
        frames.append(f)
    # Metrics of different semantic models meet on the group keys: stacked and
    # folded in one group-by (null keys group together), not joined pairwise.
    out = frames[0] if len(frames) == 1 else combine_on_keys(frames, names or [])
    cols = [F.col(k) for k in (names or []) if k != "_all"]
    for m in metrics:
        if m in SIMPLE_METRICS:
            cols.append(F.col(m))
        elif m in RATIO_METRICS:
            r = RATIO_METRICS[m]
            den = F.col(r.denominator).cast("double")
            cols.append(F.when(den != 0, F.col(r.numerator).cast("double") / den).alias(m))
        else:
            cols.append(F.expr(DERIVED_METRICS[m].expr).alias(m))
    return out.select(*cols)


def time_spine(spark, start: dt.date = C.SPINE_START, end_exclusive: dt.date = C.SPINE_END_EXCLUSIVE) -> DataFrame:
    """Daily dates in [start, end_exclusive)."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.date_sub(F.lit(end_exclusive), 1)))
                                 .alias("date_day"))


def data_time_spine(fact: DataFrame, date_col: str = "order_date") -> DataFrame:
    """Daily spine covering the fact's own date range (bounds computed by Spark)."""
    b = fact.agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    return b.select(F.explode(F.sequence("_lo", "_hi")).alias("date_day"))


def gap_filled(project, metric: str, grain: str = "day", fill: float | int | None = 0,
               group_by: list[str] | None = None, spine: DataFrame | None = None) -> DataFrame:
    """A metric of any kind per ``metric_time`` bucket of the spine, for each combination of the ``group_by`` keys
    that has data: buckets without data appear, with ``fill`` as value (``None`` keeps them null).  The spine is the
    fact's own date range unless one is given (such as ``time_spine``)."""
    group_by = list(group_by or [])
    key = f"metric_time__{grain}"
    found = metric_query(project, [metric], [key, *group_by])
    if spine is None:
        simple = metric
        while simple not in SIMPLE_METRICS:
            simple = (RATIO_METRICS[simple].numerator if simple in RATIO_METRICS else DERIVED_METRICS[simple].inputs[0])
        sm = SEMANTIC_MODELS[SIMPLE_METRICS[simple].model]
        spine = data_time_spine(project[sm.name], sm.time_dimension)
    if GRAINS[grain] is not None:
        spine = spine.select(F.date_trunc(GRAINS[grain], "date_day").cast("date").alias("date_day")).distinct()
    names = [g.replace("__", "_") for g in group_by]
    data = found.select(F.col(key).alias("_day"), *[F.col(n).alias(f"_g{k}") for k, n in enumerate(names)],
                        F.col(metric).alias("_value"))
    if names:
        # Each combination gets the whole spine, as one array of days (a scalar subquery, no cross join).
        days = spine.agg(F.array_sort(F.collect_list("date_day")).alias("_days")).scalar()
        spine = found.select(*names).distinct().select(*names, F.explode(days).alias("date_day"))
    cond = F.col("date_day") == F.col("_day")
    for k, n in enumerate(names):
        cond = cond & F.col(n).eqNullSafe(F.col(f"_g{k}"))
    value = F.col("_value")
    if fill is not None:
        value = F.coalesce(value, F.lit(fill).cast(found.schema[metric].dataType))
    return spine.join(data, cond, "left").select(F.col("date_day").alias(key), *names, value.alias(metric))
