"""The model DAG: sources -> staging -> intermediate -> marts -> consumers.

``RetailProject`` builds every model lazily, once per project instance (a
model used by two consumers is the same DataFrame object, so Spark can reuse
its exchanges).  Without ``root`` everything derives from the star tables.  With ``root`` the
project reads the newest published run there (see ``sources.sinks``): landed raw tables, shared
intermediates and published tables come from that run, and one that it lacks is an error, never a
silent re-computation.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom import config as C
from ledgerloom.functions.expr import evaluated
from ledgerloom.operators import marts, staging
from ledgerloom.operators.lines import int_order_items, lines_from_items
from ledgerloom.plans import finance, marketing
from ledgerloom.sources import seeds
from ledgerloom.sources.retail import RawSources
from ledgerloom.sources.sinks import (
    PART_COL,
    Run,
    current_run,
    write_contracted,
    write_landed,
    write_measured,
)

RAW_TABLES = ["customers", "loyalty_segments", "sales_orders", "ret_customers", "ret_orders", "ret_tickets"]
PUBLIC_MARTS = ["dim_customers", "dim_b2b_customers", "fct_sales_orders", "fct_order_lines",
                "dim_regional_sales_targets", "fct_b2b_orders"]
# Intermediates read by more than one model: written once by a build.
MATERIALIZED_INTERMEDIATES = ["int_order_items", "int_current_customers", "int_b2b_customer_health"]
# Table-materialized models without a contract, in two steps: those of the second read one of the first.
# Both are built *from* the published marts.
TABLE_MODELS = [["rpt_promo_effectiveness", "loyalty_campaign_targets", "regional_performance",
                 "b2b_account_health_report", "consolidated_revenue"], ["regional_target_attainment"]]
LAYER_OF = {**dict.fromkeys(MATERIALIZED_INTERMEDIATES, "intermediate"),
            **dict.fromkeys(PUBLIC_MARTS + [t for step in TABLE_MODELS for t in step], "published")}
#: Columns that cost a model work of their own (a branch with shuffles): a reader that does not ask for them skips it.
SEPARABLE = {"dim_customers": frozenset({"customer_value_segment"})}
#: Columns that are folded from each order's JSON: filters on them come after they are computed, not before as well.
COSTLY = {"fct_sales_orders": frozenset({"total_revenue", "parsed_line_items"})}
#: Independent tables that a build writes at the same time.
WRITERS = 4


class RetailProject:
    """``run``: a build that is going on; its finished tables are read, all others are derived."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: dt.date = C.DEFAULT_AS_OF,
                 price_scale: int = 2, root: str | None = None, run: Run | None = None):
        self.spark, self.sf_dir, self.as_of, self.price_scale = spark, sf_dir, as_of, price_scale
        self.building = run is not None
        self.run = run if run is not None else current_run(spark, root) if root else None
        self._forget()

    def in_session(self, spark: SparkSession) -> RetailProject:
        """The same project in another session."""
        other = RetailProject(spark, self.sf_dir, self.as_of, self.price_scale)
        other.run, other.building = self.run, self.building
        other._forget()
        return other

    def _forget(self) -> None:
        landed = self.run and (not self.building or self.run.tables["landed"])
        self.raw = RawSources(self.spark, self.sf_dir, landed=self._landed if landed else None)
        self._models: dict[str, DataFrame] = {}
        self._key_counts: dict = {}
        self._partitioned: dict[str, DataFrame] = {}  # published tables read with their month column

    def _landed(self, name: str) -> DataFrame:
        return self._read("landed", name)

    def _read(self, layer: str, name: str) -> DataFrame:
        if not self.run.has(layer, name):
            raise LookupError(f"run {self.run.run_id} has no {layer} table {name}")
        return self.spark.read.parquet(self.run.path(layer, name))

    def model(self, name: str, columns: Iterable[str] | None = None) -> DataFrame:
        """``ref(name)``: the model's DataFrame (built once), or these columns of it.  A model that is derived leaves out
        the branches of its ``SEPARABLE`` columns unless they are asked for (Spark cannot drop such a join by itself)."""
        if columns is None:
            return self._whole(name)
        wanted = list(dict.fromkeys(columns))
        df = self._whole(name) if SEPARABLE.get(name, frozenset()) & set(wanted) else self._plain(name)
        return df.select(*wanted)

    def for_filter(self, name: str, df: DataFrame, columns: Iterable[str]) -> DataFrame:
        """``df``, rows of model ``name``, for a filter on ``columns``: computed first where the model is derived and one of
        them is ``COSTLY``.  A table that is read takes the filter in its scan."""
        return evaluated(df) if COSTLY.get(name, frozenset()) & set(columns) and not self._is_table(name) else df

    def _is_table(self, name: str) -> bool:
        """Whether the model is read from the run; one whose prices are not in cents is always derived."""
        return bool(LAYER_OF.get(name) and self.run and self.price_scale == 2
                    and (not self.building or self.run.has(LAYER_OF[name], name)))

    def _plain(self, name: str) -> DataFrame:
        if name not in SEPARABLE or self._is_table(name):
            return self._whole(name)
        key = f"{name} without {sorted(SEPARABLE[name])}"
        if key not in self._models:
            self._models[key] = getattr(self, f"_build_{name}_plain")()
        return self._models[key]

    def _whole(self, name: str) -> DataFrame:
        if name not in self._models:
            if self._is_table(name):
                df = self._read(LAYER_OF[name], name)
                if PART_COL in df.columns:
                    self._partitioned[name] = df
                    df = df.drop(PART_COL)
                self._models[name] = df
            else:
                self._models[name] = getattr(self, "_build_" + name)()
        return self._models[name]

    def __getitem__(self, name: str) -> DataFrame:
        return self.model(name)

    def evidence(self, name: str, layer: str | None = None) -> dict[str, int] | None:
        """What the write of the table that this model (or landed table) is read from has counted; None where it is derived."""
        layer = layer or LAYER_OF.get(name)
        if layer is None or self.run is None or self.building or (layer != "landed" and not self._is_table(name)):
            return None
        return self.run.evidence.get(f"{layer}/{name}")

    def window(self, name: str, date_col: str, lo: Column, hi: Column | None = None) -> DataFrame:
        """Rows of model ``name`` with ``lo <= date_col < hi`` (``hi`` optional).

        For a published month-partitioned table the implied folder bounds are added
        (``trunc(lo, month) <= p_month < hi`` holds for every qualifying row), so the
        scan prunes whole months; otherwise it is the plain filter.
        """
        cond = F.col(date_col) >= lo
        if hi is not None:
            cond = cond & (F.col(date_col) < hi)
        df = self[name]
        full = self._partitioned.get(name)
        if full is None:
            return df.filter(cond)
        part = F.col(PART_COL) >= F.trunc(lo, "month")
        if hi is not None:
            part = part & (F.col(PART_COL) < hi)
        return full.filter(part & cond).drop(PART_COL)

    # ------------------------------------------------------------ staging
    def _build_stg_customers(self):
        return staging.stg_customers(self.raw.customers)

    def _build_stg_loyalty_segments(self):
        return staging.stg_loyalty_segments(self.raw.loyalty_segments)

    def _build_stg_sales_orders(self):
        return staging.stg_sales_orders(self.raw.sales_orders)

    def _build_stg_ret_customers(self):
        return staging.stg_ret_customers(self.raw.ret_customers)

    def _build_stg_ret_orders(self):
        return staging.stg_ret_orders(self.raw.ret_orders)

    def _build_stg_ret_tickets(self):
        return staging.stg_ret_tickets(self.raw.ret_tickets)

    def _build_stg_product_catalog(self):
        return staging.stg_product_catalog(seeds.product_catalog(self.spark, self.sf_dir))

    def _build_stg_promo_campaigns(self):
        return staging.stg_promo_campaigns(seeds.promo_campaigns(self.spark))

    def _build_stg_regional_sales_targets(self):
        return staging.stg_regional_sales_targets(seeds.regional_sales_targets(self.spark, self.sf_dir))

    # ------------------------------------------------------------ intermediate
    def _build_int_current_customers(self):
        return marts.int_current_customers(self["stg_customers"], self["stg_loyalty_segments"])

    def _build_int_order_items(self):
        return int_order_items(self["stg_sales_orders"], self.price_scale)

    def _build_int_sales_order_lines(self):
        return lines_from_items(self["int_order_items"])

    def _build_int_b2b_customer_health(self):
        return marts.int_b2b_customer_health(self["stg_ret_customers"], self["stg_ret_orders"],
                                             self["stg_ret_tickets"])

    # ------------------------------------------------------------ marts
    def _build_dim_customers(self):
        return marts.dim_customers(self["int_current_customers"])

    def _build_dim_customers_plain(self):
        return marts.customer_attributes(self["int_current_customers"])

    def _build_dim_b2b_customers(self):
        return marts.dim_b2b_customers(self["int_b2b_customer_health"])

    def _build_fct_sales_orders(self):
        return marts.fct_sales_orders(self["int_order_items"])

    def _build_fct_order_lines(self):
        return marts.fct_order_lines(self["int_sales_order_lines"], self["stg_product_catalog"])

    def _build_fct_b2b_orders(self):
        return marts.fct_b2b_orders(self["stg_ret_orders"])

    def _build_dim_regional_sales_targets(self):
        return marts.dim_regional_sales_targets(self["stg_regional_sales_targets"])

    def _build_rpt_promo_effectiveness(self):
        return marts.rpt_promo_effectiveness(self["fct_sales_orders"], self["stg_promo_campaigns"])

    # ------------------------------------------------------------ consumers
    def _build_loyalty_campaign_targets(self):
        return marketing.loyalty_campaign_targets(self["dim_customers"], self["fct_sales_orders"], self.as_of)

    def _build_regional_performance(self):
        return marketing.regional_performance(self["fct_sales_orders"],
                                              self.model("dim_customers", ["customer_id", "region", "state"]))

    def _build_regional_target_attainment(self):
        return marketing.regional_target_attainment(self["regional_performance"],
                                                    self["dim_regional_sales_targets"])

    def _build_b2b_account_health_report(self):
        recent = self.window("fct_b2b_orders", "order_date", finance.recent_window_start(self.as_of))
        return finance.b2b_account_health_report(self["dim_b2b_customers"], recent, self.as_of)

    def _build_consolidated_revenue(self):
        return finance.consolidated_revenue(self["fct_sales_orders"], self["fct_b2b_orders"])

    # ------------------------------------------------------------ materialization
    def _write_all(self, layer: str, names: list[str], write) -> list:
        """``write(name, path)`` for independent tables, a few at a time.  Plans are made first, on one thread;
        a table counts as there only when its own write has ended well."""
        for name in names:
            _ = self.raw.table(name) if layer == "landed" else self[name]

        def timed(name: str):
            t0 = time.perf_counter()
            out = write(name, self.run.path(layer, name))
            return name, round(time.perf_counter() - t0, 3), out

        with ThreadPoolExecutor(WRITERS) as pool:
            done = list(pool.map(timed, names))
        self.run.tables[layer] += names
        self.run.evidence |= {f"{layer}/{name}": out["evidence"] for name, _, out in done if out["evidence"]}
        self._forget()
        return done

    def land(self, names=RAW_TABLES) -> list:
        """Write the raw tables as the connector lands them, straight from the sources."""
        return self._write_all("landed", list(names), lambda name, path: write_landed(self.raw.table(name), path))

    def publish(self, tolerate: frozenset = frozenset()) -> list:
        """Write intermediates, contract-checked marts, and the tables that read the marts."""
        done = self._write_all("intermediate", MATERIALIZED_INTERMEDIATES,
                               lambda name, path: write_measured(self[name], name, path))
        done += self._write_all("published", PUBLIC_MARTS,
                                lambda name, path: write_contracted(self[name], name, path, tolerate))
        for step in TABLE_MODELS:
            done += self._write_all("published", step, lambda name, path: write_measured(self[name], name, path))
        return done
