"""Builds are runs of their own: repeatable, safe to crash, and read through any file system."""

import pytest

from ledgerloom.plans import project as project_module
from ledgerloom.plans.build import STAR_TOLERATED, build
from ledgerloom.plans.project import RetailProject
from ledgerloom.sources import sinks
from tests.conftest import SF0001


def _content(project):
    def digest(df):  # a contract has its own column order
        return df.selectExpr(f"sum(xxhash64({', '.join(sorted(df.columns))})::decimal(38,0))").first()[0]

    return {name: (project[name].count(), digest(project[name]))
            for name in ("dim_customers", "fct_sales_orders", "consolidated_revenue", "regional_target_attainment")}


def test_two_builds_a_crash_and_a_uri_root(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/w"
    with pytest.raises(FileNotFoundError):
        RetailProject(spark, SF0001, root=root)
    first = build(spark, SF0001, root, STAR_TOLERATED)
    p = RetailProject(spark, SF0001, root=root)
    assert all("/runs/" in f for f in p["fct_sales_orders"].inputFiles() + p.raw.sales_orders.inputFiles())
    assert _content(p) == _content(RetailProject(spark, SF0001))
    assert set(first["tables"]) == set(project_module.LAYER_OF)

    def broken(*_a, **_k):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(project_module, "write_contracted", broken)
        with pytest.raises(RuntimeError, match="lost"):
            build(spark, SF0001, root, STAR_TOLERATED)
    assert sinks.current_run(spark, root).run_id == first["run"]
    assert _content(RetailProject(spark, SF0001, root=root)) == _content(p)

    second = build(spark, SF0001, root, STAR_TOLERATED)
    assert sinks.current_run(spark, root).run_id == second["run"] != first["run"]
    assert _content(RetailProject(spark, SF0001, root=root)) == _content(p)
    assert len(sinks.old_runs(spark, root)) == 2


def test_broken_contract_is_not_published(spark, tmp_path):
    root = f"file://{tmp_path}/w"
    with pytest.raises(sinks.ContractViolation):
        build(spark, SF0001, root)
    with pytest.raises(FileNotFoundError):
        sinks.current_run(spark, root)


def test_old_and_abandoned_runs_are_removed(spark, tmp_path, monkeypatch):
    root = f"file://{tmp_path}/w"
    assert sinks.remove_old_runs(spark, root) == []
    runs = []
    for day, published in enumerate([True, False, True, True, False], 1):
        monkeypatch.setattr(sinks.time, "strftime", lambda *_, d=day: f"2020010{d}T000000")
        run = sinks.new_run(root)
        spark.range(day).write.parquet(run.path("published", "t"))
        if published:
            sinks.publish_run(spark, run)
        runs.append(run)
    ids = [r.run_id for r in runs]
    monkeypatch.setattr(sinks.time, "strftime", lambda *_: "20200105T000000")  # the last is not old enough
    with pytest.raises(ValueError):
        sinks.remove_old_runs(spark, root, keep=0)
    assert sorted(sinks.remove_old_runs(spark, root, keep=2)) == ids[:2]
    assert sinks.current_run(spark, root).run_id == ids[3]
    assert [spark.read.parquet(r.path("published", "t")).count() for r in runs[2:]] == [3, 4, 5]
    assert sinks.remove_old_runs(spark, root, keep=1, abandoned_after_hours=0) == [ids[2]]
    assert [n for n in ids if sinks.path_exists(spark, f"{root}/runs/{n}")] == ids[3:]
    assert sinks.old_runs(spark, root) == [f"{root}/runs/{ids[4]}"]


def test_absent_table_is_an_error(spark, tmp_path):
    run = sinks.new_run(f"file://{tmp_path}")
    sinks.publish_run(spark, run)
    p = RetailProject(spark, SF0001, root=f"file://{tmp_path}")
    with pytest.raises(LookupError):
        p["dim_customers"]
    with pytest.raises(LookupError):
        p["stg_customers"]


def test_seed_csv_by_path(spark, tmp_path):
    import shutil

    from ledgerloom.sources import seeds
    shutil.copy(f"{seeds.SEED_DIR}/promo_campaigns.csv", tmp_path / "c.csv")
    a, b = seeds.promo_campaigns(spark), seeds.promo_campaigns(spark, f"file://{tmp_path}/c.csv")
    assert [tuple(r) for r in a.collect()] == [tuple(r) for r in b.collect()] and a.dtypes == b.dtypes
