"""Semantic views: declared tables, relationships, facts and dimensions.

``semantic_select(project, view, names)`` joins from the base table along the declared relationships
and projects the requested names; ``semantic_aggregate`` groups by dimensions and aggregates
facts.  Synonyms resolve to the same column.

The base is the first table, in the order of declaration, that no relationship points to.  In a governed view
a referenced column is unique, so joins keep the base's rows; a measure of any other table than the base would be
counted once per base row, so aggregating it is an error.  The raw view references a column that is not
unique: its joins multiply rows, which is what it is there to show.

Measures that add up are aggregated by the base's own keys before the join, so a hot key is reduced before
the shuffle, and once more after it.

A filter text may use names and synonyms (in backticks where they have blanks).  Each conjunct is applied to the table
that owns its columns, below the joins; one that spans tables, or that also holds for a row without a match, is
applied to the joined rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans.metrics import REAGGREGATE, aggregate, widen_decimals
from ledgerloom.plans.predicates import Conjunct, conjuncts


@dataclass(frozen=True)
class SemanticView:
    tables: dict            # alias -> (model name, primary key)
    relationships: list     # (from alias, fk column, to alias, referenced column)
    facts: dict             # name -> (alias, column)
    dimensions: dict        # name -> (alias, column)
    synonyms: dict = field(default_factory=dict)  # name -> its synonyms
    governed: bool = True

    def name_of(self, word: str) -> str:
        if word in self.facts or word in self.dimensions:
            return word
        return next((n for n, words in self.synonyms.items() if word in words), word)


# ---------------------------------------------------------------- fixed values
GOVERNED = SemanticView(
    tables={"sales_orders": ("fct_sales_orders", "order_id"), "customers": ("dim_customers", "customer_id"),
            "b2b_orders": ("fct_b2b_orders", "order_id"), "b2b_customers": ("dim_b2b_customers", "b2b_customer_id")},
    relationships=[("sales_orders", "customer_id", "customers", "customer_id"),
                   ("b2b_orders", "b2b_customer_id", "b2b_customers", "b2b_customer_id")],
    facts={"b2c_revenue": ("sales_orders", "total_revenue"), "line_items": ("sales_orders", "number_of_line_items"),
           "units_purchased": ("customers", "units_purchased"), "b2b_revenue": ("b2b_orders", "amount"),
           "b2b_account_total_revenue": ("b2b_customers", "total_revenue"),
           "account_health_score": ("b2b_customers", "health_score"),
           "open_support_tickets": ("b2b_customers", "open_tickets")},
    dimensions={"order_date": ("sales_orders", "order_date"), "has_promo": ("sales_orders", "has_promo"),
                "customer_name": ("customers", "customer_name"), "region": ("customers", "region"),
                "state": ("customers", "state"), "city": ("customers", "city"),
                "loyalty_tier": ("customers", "loyalty_segment_description"),
                "value_segment": ("customers", "customer_value_segment"),
                "b2b_order_date": ("b2b_orders", "order_date"), "b2b_order_status": ("b2b_orders", "status"),
                "is_cancelled_or_returned": ("b2b_orders", "is_cancelled_or_returned"),
                "b2b_customer_id": ("b2b_customers", "b2b_customer_id"),
                "company_name": ("b2b_customers", "company_name"), "b2b_region": ("b2b_customers", "region"),
                "account_health_status": ("b2b_customers", "account_health_status")},
    synonyms={
        "b2c_revenue": ("b2c sales", "online revenue", "sales", "revenue"),
        "line_items": ("items", "products ordered"),
        "units_purchased": ("total units", "volume"),
        "b2b_revenue": ("b2b sales", "wholesale revenue", "account revenue"),
        "account_health_score": ("health", "account score"),
        "open_support_tickets": ("open tickets", "unresolved tickets"),
        "order_date": ("date", "purchase date", "transaction date"),
        "has_promo": ("promoted", "discounted", "promo used"),
        "customer_name": ("customer", "name", "buyer"),
        "region": ("location", "area"),
        "loyalty_tier": ("loyalty", "segment", "tier", "loyalty segment"),
        "value_segment": ("value tier", "customer segment"),
        "is_cancelled_or_returned": ("cancelled", "returned"),
        "company_name": ("company", "account", "business"),
        "account_health_status": ("health status", "account risk", "risk"),
    },
)

# The ungoverned view over the raw tables (epoch numbers, JSON text, SCD2 versions).
RAW = SemanticView(
    tables={"sales_orders": ("raw.sales_orders", "id"), "customers": ("raw.customers", "id"),
            "ret_orders": ("raw.ret_orders", "id"), "ret_customers": ("raw.ret_customers", "id")},
    relationships=[("sales_orders", "customer_id", "customers", "customer_id"),
                   ("ret_orders", "order_user_id", "ret_customers", "id")],
    governed=False,
    facts={"number_of_line_items": ("sales_orders", "number_of_line_items"),
           "b2b_order_amount": ("ret_orders", "amount"), "units_purchased": ("customers", "units_purchased")},
    dimensions={"order_datetime": ("sales_orders", "order_datetime"),
                "ordered_products": ("sales_orders", "ordered_products"), "promo_info": ("sales_orders", "promo_info"),
                "customer_name": ("customers", "customer_name"), "city": ("customers", "city"),
                "region": ("customers", "region"), "loyalty_segment_number": ("customers", "loyalty_segment"),
                "b2b_order_status": ("ret_orders", "status"), "b2b_customer_name": ("ret_customers", "name"),
                "b2b_region": ("ret_customers", "region")},
)


def _table(project, view: SemanticView, alias: str, columns=None) -> DataFrame:
    model = view.tables[alias][0]
    if model.startswith("raw."):
        df = project.raw.table(model.split(".", 1)[1])
        return df.select(*dict.fromkeys(columns)) if columns is not None else df
    return project.model(model, columns)


@dataclass(frozen=True)
class _Filter:
    """A filter text's conjuncts, each for one table or for the joined rows."""
    conjuncts: list[Conjunct]
    owners: dict[str, tuple[str, str]]  # name or synonym -> (alias, column)

    def aliases(self, part: Conjunct) -> set[str]:
        return {self.owners[n][0] for n in part.names}

    def resolved(self) -> list[tuple[str, str, str]]:
        return [(n, *self.owners[n]) for part in self.conjuncts for n in part.names]

    def columns(self, alias: str) -> list[str]:
        return [c for _, a, c in self.resolved() if a == alias]

    def on_table(self, df: DataFrame, alias: str, computed: Callable[[DataFrame, set[str]], DataFrame]) -> DataFrame:
        """Filtered by the conjuncts on this table alone; ``computed`` comes before the first on columns that it changes."""
        late = []
        for part in (p for p in self.conjuncts if self.aliases(p) == {alias}):
            if computed(df, columns := {self.owners[n][1] for n in part.names}) is not df:
                late.append((part, columns))
            else:
                df = part.on(df, {n: f"`{self.owners[n][1]}`" for n in part.names})
        df = computed(df, {c for _, columns in late for c in columns})
        for part, _ in late:
            df = part.on(df, {n: f"`{self.owners[n][1]}`" for n in part.names})
        return df

    def below(self, alias: str) -> list[Conjunct]:
        return [part for part in self.conjuncts if self.aliases(part) == {alias} and not part.holds_on_nulls]


def _filter(project, view: SemanticView, where: str | None) -> _Filter:
    columns = {**view.facts, **view.dimensions}
    owners = columns | {w: columns[n] for n, words in view.synonyms.items() for w in words}
    if not where:
        return _Filter([], owners)

    def type_of(name: str):
        alias, column = owners[name]
        return _table(project, view, alias).schema[column].dataType

    return _Filter(conjuncts(project.spark, where, type_of, owners), owners)


def _resolve(view: SemanticView, word: str) -> tuple[str, str, str]:
    name = view.name_of(word)
    return (name, *(view.facts.get(name) or view.dimensions[name]))


def _base(view: SemanticView, aliases: set[str]) -> str:
    referenced = {to for _, _, to, _ in view.relationships}
    return next((a for a in view.tables if a in aliases and a not in referenced),
                next(a for a in view.tables if a in aliases))


def _steps(view: SemanticView, base: str, aliases: set[str]) -> list[tuple]:
    """The relationships to follow from ``base`` to all of ``aliases``."""
    steps, joined = [], {base}
    for step in view.relationships:
        if step[0] in joined and step[2] in aliases and step[2] not in joined:
            steps.append(step)
            joined.add(step[2])
    if aliases - joined:
        raise ValueError(f"no relationship path from {base} to {sorted(aliases - joined)}")
    return steps


def _joined(project, view: SemanticView, df: DataFrame, steps: list[tuple], resolved: list[tuple], found: _Filter) -> DataFrame:
    """``df``, with the base's columns under ``alias.column``, joined to the columns that are asked for.  A table with conjuncts of
    its own that fail on nulls is filtered by them and joined as an inner join, which is what they make of it."""
    for frm, fk, to, key in steps:
        wanted = list(dict.fromkeys([key, *(c for _, a, c in resolved if a == to), *found.columns(to)]))
        side = _table(project, view, to, wanted)
        own = found.below(to)
        for part in own:
            side = part.on(side, {n: f"`{found.owners[n][1]}`" for n in part.names})
        side = side.select(*[F.col(c).alias(f"{to}.{c}") for c in wanted])
        df = df.join(side, df[f"`{frm}.{fk}`"] == side[f"`{to}.{key}`"], "inner" if own else "left")
    # What is left spans tables, or holds for rows without a match.
    for part in found.conjuncts:
        aliases = found.aliases(part)
        if len(aliases) != 1 or (aliases & {step[2] for step in steps} and part.holds_on_nulls):
            df = part.on(df, {n: "`{}.{}`".format(*found.owners[n]) for n in part.names})
    return df


def _base_rows(project, view: SemanticView, base: str, columns: list[str], found: _Filter) -> DataFrame:
    """The base's columns, filtered by the conjuncts on it alone."""
    return found.on_table(_table(project, view, base, [*columns, *found.columns(base)]), base,
                          lambda df, names: project.for_filter(view.tables[base][0], df, names))


def _under_alias(df: DataFrame, alias: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{alias}.{c}") for c in df.columns])


def semantic_select(project, view: SemanticView, names: list[str], where: str | None = None) -> DataFrame:
    """Rows of the base table with the requested facts and dimensions (left joins), those that meet ``where``."""
    resolved, found = [_resolve(view, n) for n in names], _filter(project, view, where)
    aliases = {a for _, a, _ in resolved + found.resolved()}
    base = _base(view, aliases)
    steps = _steps(view, base, aliases)
    own = [c for _, a, c in resolved if a == base] + [fk for frm, fk, _, _ in steps if frm == base]
    rows = _under_alias(_base_rows(project, view, base, own, found), base)
    df = _joined(project, view, rows, steps, resolved, found)
    return df.select(*[F.col(f"`{a}.{c}`").alias(n) for n, a, c in resolved])


def semantic_aggregate(project, view: SemanticView, dimensions: list[str], measures: dict, where: str | None = None) -> DataFrame:
    """``measures``: output name -> (agg, fact or dimension name); over the rows that meet ``where``."""
    dims, found = [_resolve(view, d) for d in dimensions], _filter(project, view, where)
    sources = {out: (agg, *_resolve(view, src)) for out, (agg, src) in measures.items()}
    aliases = {a for _, a, _ in dims + found.resolved()} | {a for _, _, a, _ in sources.values()}
    base = _base(view, aliases)
    if view.governed and (wrong := sorted(n for _, n, a, _ in sources.values() if a != base)):
        raise ValueError(f"{wrong} are not facts of {base}: its rows would repeat them")
    steps = _steps(view, base, aliases)
    spanning = [c for n, a, c in found.resolved() if a == base and any(
        n in part.names and found.aliases(part) != {base} for part in found.conjuncts)]
    own = list(dict.fromkeys([c for _, a, c in dims if a == base] + [fk for frm, fk, _, _ in steps if frm == base] + spanning))
    rows = _base_rows(project, view, base, [*own, *(c for _, _, a, c in sources.values() if a == base)], found)
    if all(agg in REAGGREGATE and a == base for agg, _, a, _ in sources.values()):
        first = rows.groupBy(*[F.col(c).alias(f"{base}.{c}") for c in own]).agg(
            *[aggregate(agg, F.col(c)).alias(out) for out, (agg, _, _, c) in sources.items()])
        rows = _joined(project, view, first, steps, dims, found)
        aggs = [aggregate(REAGGREGATE[agg], F.col(out)).alias(out) for out, (agg, *_) in sources.items()]
    else:
        needed = dims + [(n, a, c) for _, n, a, c in sources.values()]
        rows = _joined(project, view, _under_alias(rows, base), steps, needed, found)
        aggs = [aggregate(agg, F.col(f"`{a}.{c}`")).alias(out) for out, (agg, _, a, c) in sources.items()]
    return widen_decimals(rows.groupBy(*[F.col(f"`{a}.{c}`").alias(n) for n, a, c in dims]).agg(*aggs))
