"""Refreshes that do not disturb readers, states of a source, freed storage; row rules counted while writing."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from footfall.config import EngineConfig
from footfall.plans import marts as marts_module
from footfall.plans.checks import CHECKS, WatchedChecks, run_checks
from footfall.plans.marts import PUBLIC_TABLES, build_marts, publish_marts, shared_marts, source_version
from footfall.sources.driver_tables import W1, raw_events
from footfall.sources.readers import in_window
from footfall.sources.snapshots import Snapshots
from tests.rows import event, export

CFG = EngineConfig()


def raw(spark, *users):
    return export(spark, [event(u, "2020-11-01 10:00:00") for u in users])


def test_readers_see_whole_versions(spark, tmp_path):
    root = str(tmp_path / "marts")
    versions = Snapshots(spark, root)
    with pytest.raises(FileNotFoundError):
        versions.table("dim_users")
    publish_marts(spark, raw(spark, "a"), CFG, root)
    before = versions.table("dim_users")
    publish_marts(spark, raw(spark, "a", "b"), CFG, root)
    assert before.count() == 1 and versions.table("dim_users").count() == 2
    assert {p.name for p in Path(versions.folder()).iterdir()} == set(PUBLIC_TABLES)
    publish_marts(spark, raw(spark, "c"), CFG, root)
    assert len(versions.published()) == 2 == len(list((tmp_path / "marts" / "versions").iterdir()))


def test_a_failed_refresh_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "marts")
    publish_marts(spark, raw(spark, "a"), CFG, root)
    versions = Snapshots(spark, root)
    current = versions.published()
    broken = raw(spark, "a", "b").withColumn("event_name", F.when(F.col("user_pseudo_id") == "b", F.raise_error(F.lit("no"))).otherwise(F.col("event_name")))
    with pytest.raises(Exception, match="no"):
        publish_marts(spark, broken, CFG, root)
    assert versions.published() == current and versions.table("dim_users").count() == 1
    assert len(list((tmp_path / "marts" / "versions").iterdir())) == 1


def test_a_refresh_that_breaks_a_rule_is_not_published(spark, tmp_path):
    root = str(tmp_path / "marts")
    empty = raw(spark, "a").where("false")
    with pytest.raises(ValueError, match="Q98"):
        publish_marts(spark, empty, CFG, root)
    assert Snapshots(spark, root).published() == []
    tables = publish_marts(spark, empty, CFG, root, strict=False)
    assert Snapshots(spark, root).table("dim_users", schema=tables["dim_users"].schema).count() == 0


def test_what_a_dead_refresh_left_goes(spark, tmp_path):
    versions = Snapshots(spark, str(tmp_path))
    spark.range(3).write.parquet(f"{tmp_path}/versions/000000000000001-dead/t")
    with versions.refresh() as folder:
        spark.range(5).write.parquet(f"{folder}/t")
    spark.range(3).write.parquet(f"{tmp_path}/versions/999999999999999-running/t")
    versions.drop_unfinished(3600)
    assert versions.table("t").count() == 5
    assert sorted(p.name[:15] for p in (tmp_path / "versions").iterdir())[1:] == ["999999999999999"]


def test_a_file_added_in_a_subfolder_is_seen(spark, tmp_path):
    source = str(tmp_path / "events")
    raw(spark, "a").write.partitionBy("event_date").parquet(source)
    read = lambda keep: spark.read.schema(raw(spark, "a").schema).parquet(source)
    first, was = shared_marts(spark, source, read, CFG), source_version(spark, source)
    assert first["stg_events"].count() == 1 and shared_marts(spark, source, read, CFG) is first
    raw(spark, "b").drop("event_date").write.mode("append").parquet(f"{source}/event_date=20201101")
    assert source_version(spark, source) != was
    assert shared_marts(spark, source, read, CFG)["stg_events"].count() == 2


@pytest.mark.parametrize("named", [True, False])
def test_marts_of_an_older_version_free_their_storage(spark, tmp_path, monkeypatch, named):
    import itertools

    numbers = itertools.count()
    monkeypatch.setattr(marts_module, "shared_folder", lambda s: f"{tmp_path}/footfall-{next(numbers)}" if named else None)
    read = lambda keep: keep("first", raw(spark, "a", "b"))
    source = str(tmp_path / "source")

    def stored():
        return sum(p.stat().st_size for p in tmp_path.rglob("*.parquet")) if named else len(spark.sparkContext._jsc.getPersistentRDDs())

    empty = stored()
    one = shared_marts(spark, source, read, CFG, version=1)
    assert one["dim_users"].count() == 2 and stored() > empty
    full = stored()
    for version in (2, 3):
        assert shared_marts(spark, source, read, CFG, version=version)["dim_users"].count() == 2
        assert stored() <= full
    assert len([k for k in marts_module._KEPT if k[1] == source]) == 2


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    events = in_window(raw_events(spark, "/root/testdata/sf0.001"), W1)
    watched = WatchedChecks()
    tables = build_marts(spark, events, W1, str(tmp_path_factory.mktemp("built")), watched=watched)
    return tables, watched


def test_rules_counted_while_writing_are_those_of_the_checks(spark, built):
    tables, watched = built
    kinds = ("unique", "relationships")
    want = sorted(map(tuple, run_checks(tables, [c for c in CHECKS if c.kind not in kinds]).collect()), key=repr)
    assert sorted(map(tuple, watched.results().collect()), key=repr) == want and len(want) > 80
    both = [sorted(map(tuple, run_checks(tables, watched=w).collect()), key=repr) for w in (None, watched)]
    assert both[0] == both[1]


def test_references_of_a_table_take_one_scan(spark, built):
    tables, _ = built
    mine = [c for c in CHECKS if c.kind == "relationships" and c.table == "fct_funnel"]
    assert mine
    plan = run_checks(tables, mine)._jdf.queryExecution().optimizedPlan().toString()
    reading = [line for line in plan.splitlines() if "Relation" in line and "funnel_key" in line]
    assert "Join" not in plan and len(reading) == 2  # the references, and the check that there are rows


def test_references_find_orphans(spark):
    from footfall.plans.checks import Check

    child = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", None), (None, "z"), ("c", "x")], "k string, j string")
    parent = spark.createDataFrame([("a",), ("a",), ("x",), (None,)], "id string")
    checks = [
        Check("1", "child", "k", "relationships", parent="parent", parent_column="id"),
        Check("2", "child", "j", "relationships", parent="parent", parent_column="id"),
        Check("3", "child", "k", "relationships", parent="parent", parent_column="id", where="j is not null"),
    ]
    out = {r["check_id"]: (r["failures"], r["passed"]) for r in run_checks({"child": child, "parent": parent}, checks).collect()}
    assert out == {"1": (3, False), "2": (2, False), "3": (2, False), "Q98": (0, True)}
