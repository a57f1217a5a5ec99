"""Benchmark: build + headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Mirrors how the model project runs: ``build`` lands the raw tables (derived
from the star tables) and publishes the contract-checked public marts in a
scratch root; the headline queries then run against them (consumer models,
metrics, semantic selections, data quality, questions).  The build's two
steps are timed and counted in the total.  Queries execute with the ``noop``
sink, so the whole plan runs and nothing is collected to the driver.

``BENCH_MODE=scratch`` times every query from the star tables instead.
Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "order_revenue", "line_margin", "value_segment", "promo_effectiveness", "b2b_health", "account_risk",
    "campaign_targets", "regional_performance", "target_attainment", "consolidated_revenue",
    "metric_revenue_by_month", "metric_derived", "semantic_select", "dq_not_null", "dq_unique",
    "source_freshness", "q_favourite_category", "q_top10_ltv",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from ledgerloom.plans.build import STAR_TOLERATED, build
    from ledgerloom.plans.registry import QUERIES, use_materialized
    from ledgerloom.session import checkpoint_dir, get_session

    spark = get_session(f"local[{cpus}]", app="ledgerloom-bench", shuffle_partitions=max(8, 2 * cpus))
    # Build output goes to the session's shared folder (spark.checkpoint.dir); only an unset
    # local-mode session gets a private scratch folder (see session.checkpoint_dir).
    root = os.path.join(checkpoint_dir(spark), f"ledgerloom-bench-{uuid.uuid4().hex[:8]}")
    # Warm-up (JVM, codegen caches): a small query, not timed.
    QUERIES["active_products"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    tables: dict[str, float] = {}
    if os.environ.get("BENCH_MODE", "build") == "build":
        b = build(spark, sf_dir, root, STAR_TOLERATED)
        times["build_land_raw"] = b["land_s"]
        times["build_publish_marts"] = b["publish_s"]
        tables = b["tables"]  # each model by itself; independent ones overlap, so these are not added up
        use_materialized(sf_dir, b["root"])
    for name in (only or HEADLINE):
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "build_tables": tables, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
