from __future__ import annotations

import itertools
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from footfall.config import EngineConfig
from footfall.functions.columns import param_float, param_int, param_string, surrogate_key
from footfall.operators.gaps import assign_gap_sessions
from footfall.plans import marts as marts_module
from footfall.plans.checks import CHECKS, run_checks
from footfall.plans.layer import metric_layer
from footfall.plans.marts import PUBLIC_TABLES, build_marts, shared_folder, shared_marts
from footfall.queries import ALL, comparable, queries
from footfall.sources import readers, writers
from footfall.sources.driver_tables import W1, raw_events
from footfall.sources.schema import PUBLIC_COLUMNS
from tests.rows import event, export, param


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_window_prunes_days(spark, tmp_path):
    rows = [event("a", f"2020-11-{d:02d} 10:00:00") for d in range(1, 11)]
    writers.materialize(export(spark, rows), str(tmp_path / "x"), partition_by="event_date", cluster_by=["event_name"])
    cfg = EngineConfig(date(2020, 11, 3), date(2020, 11, 5))
    got = readers.read_events(spark, str(tmp_path / "x"), cfg)
    assert got.count() == 3
    assert "PartitionFilters: [isnotnull(event_date" in plan(got)
    assert {p.name for p in (tmp_path / "x").iterdir() if p.is_dir()} == {f"event_date=202011{d:02d}" for d in range(1, 11)}


def test_materialize_without_partitioning_is_a_full_refresh(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (5, 3):
        writers.materialize(spark.range(n), path)
    assert spark.read.parquet(path).count() == 3


def test_seed_from_file_and_shipped_agree(spark, tmp_path):
    shipped = readers.read_feature_catalogue(spark)
    path = tmp_path / "seed.csv"
    shipped.toPandas().to_csv(path, index=False)
    read = readers.read_feature_catalogue(spark, str(path))
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, shipped.collect()))
    assert [f.dataType.simpleString() for f in read.schema] == ["string", "string", "string", "boolean"]
    assert shipped.where("is_user_initiated").count() == 4 and shipped.count() == 6


def test_calendar(spark):
    days = readers.time_spine(spark)
    assert days.count() == 2922 and days.distinct().count() == 2922


def test_result_rows_are_bounded(spark):
    rows, more = writers.to_rows(spark.range(10), 10)
    assert len(rows) == 10 and more is False
    rows, more = writers.to_rows(spark.range(1000), 10_000)
    assert len(rows) == 500 and more is True
    rows, more = writers.to_rows(spark.range(1000), 10_000, at_most=2000)
    assert len(rows) == 1000 and more is False
    assert len(writers.to_rows(spark.range(5), -5)[0]) == 1


def test_csv_result(spark, tmp_path):
    writers.write_csv(spark.range(3), str(tmp_path / "out"))
    assert spark.read.csv(str(tmp_path / "out"), header=True).count() == 3


def test_parameter_kinds(spark):
    rows = [event("a", "2020-11-01 10:00:00", extra=[param("f", single=1.5), param("d", double=2.5), param("n", number=3)])]
    got = export(spark, rows).select(
        param_float("f").alias("f"), param_float("d").alias("d"), param_int("n").alias("n"),
        param_string("n").alias("wrong_kind"), param_string("absent").alias("absent"),
    ).first()
    assert tuple(got) == (1.5, 2.5, 3, None, None)


def test_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([("", "x"), (None, "x")], "a string, b string")
    assert df.select(surrogate_key([F.col("a"), F.col("b")]).alias("k")).distinct().count() == 2


def test_full_refresh_to_tables(spark, tmp_path):
    raw = readers.in_window(raw_events(spark, "/root/testdata/sf0.001"), W1)
    lazy = build_marts(spark, raw, W1)
    plain = build_marts(spark, raw, replace(W1, enable_partitioning=False), out=str(tmp_path / "plain"))
    by_day = build_marts(spark, raw, W1, out=str(tmp_path / "by_day"))
    assert set(lazy) == set(plain) == set(by_day) == set(PUBLIC_TABLES)
    for name, df in plain.items():
        assert df.columns == by_day[name].columns == PUBLIC_COLUMNS[name]
        assert df.schema.simpleString() == lazy[name].schema.simpleString() == by_day[name].schema.simpleString()
        # sums of doubles may differ in the last bits between runs
        rows = [sorted(map(str, comparable(x).collect())) for x in (df, by_day[name])]
        assert rows[0] == rows[1], name
    assert sorted(map(str, comparable(lazy["dim_users"]).collect())) == sorted(map(str, comparable(plain["dim_users"]).collect()))
    assert (tmp_path / "by_day" / "fct_funnel" / "session_date=2024-01-08").is_dir()


class _Conf(dict):
    def get(self, key, default=None):
        return super().get(key, default)


def test_shared_folder_is_the_one_the_session_names(spark, tmp_path):
    class Session:
        conf, sparkContext = _Conf({"spark.checkpoint.dir": f"file://{tmp_path}/"}), spark.sparkContext

    first, second = shared_folder(Session), shared_folder(Session)
    assert first.startswith(f"file://{tmp_path}/footfall-") and first != second
    Session.conf = _Conf({"spark.master": "local[2]"})
    assert shared_folder(Session) is None


def test_changed_source_is_read_again(spark, tmp_path):
    source = str(tmp_path / "events")
    export(spark, [event("a", "2020-11-01 10:00:00")]).write.parquet(source)
    marts = lambda: shared_marts(spark, source, lambda keep: spark.read.parquet(source), EngineConfig())
    first = marts()
    assert first["stg_events"].count() == 1 and marts() is first
    export(spark, [event("b", "2020-11-01 10:00:00")]).write.mode("append").parquet(source)
    assert marts()["stg_events"].count() == 2
    assert not any(k[:3] != list(marts_module._SHARED)[-1][:3] for k in marts_module._SHARED if k[1] == source)


def test_versions_may_come_from_the_caller(spark, tmp_path):
    source = str(tmp_path / "events")
    export(spark, [event("a", "2020-11-01 10:00:00")]).write.parquet(source)
    marts = lambda v: shared_marts(spark, source, lambda keep: spark.read.parquet(source), EngineConfig(), v)
    one = marts(1)
    assert marts(1) is one and marts(2) is not one


BOTH_WAYS = ("p01_staging", "c01_sessions", "c03_gap_sessions", "c05_funnel_dense", "c13_event_enrichment", "c15_user_mart", "r02_weekly_cohorts", "m_multi_model", "m_time_bounds", "j15_calendar_fill", "k_all_checks")


def test_written_and_persisted_tables_give_the_same_rows(spark, tmp_path, monkeypatch):
    """Queries over tables in a shared folder and over tables that the engine keeps."""
    sf, rows, shared = "/root/testdata/sf0.001", [], tmp_path / "shared"
    for named in (True, False):
        marts_module._SHARED.clear()
        marts_module._EXPORTS.clear()
        numbers = itertools.count()
        folder = lambda spark: f"{shared}/footfall-{next(numbers)}" if named else None  # noqa: B023, E731
        monkeypatch.setattr(marts_module, "shared_folder", folder)
        rows.append({q: sorted(map(str, queries()[q](spark, sf).collect())) for q in BOTH_WAYS})
        assert shared.exists()
    written = {p.name for p in shared.glob("footfall-*/*")}
    assert {"export", "stg_events", "session_core", "dim_users"} <= written
    assert rows[0] == rows[1]
    marts_module._SHARED.clear()
    marts_module._EXPORTS.clear()


def test_independent_tables_are_built_side_by_side(spark, tmp_path):
    """A table that takes long does not hold up another one; helpers go when the build is done."""
    import threading

    raw = export(spark, [event("a", "2020-11-01 10:00:00")])
    slow, others = threading.Event(), []

    def keep(name, df):
        others.append(name)
        if name == "stg_events":
            slow.wait(20)
        return df

    marts = marts_module.Marts(spark, raw, EngineConfig(), keep=keep)
    held = threading.Thread(target=lambda: marts["stg_events"])
    held.start()
    assert marts["time_spine"].count() > 0 and held.is_alive()
    slow.set()
    held.join()
    out = build_marts(spark, raw, EngineConfig(), out=str(tmp_path / "out"))
    assert {p.name for p in (tmp_path / "out").iterdir()} == set(PUBLIC_TABLES) == set(out)
    assert out["int_sessions"].count() == 1


def test_calendar_beyond_its_end(spark):
    """Filled results hold every row of the plain ones, also past the calendar and without a day."""
    cfg = EngineConfig(date(2027, 3, 1), date(2027, 3, 20))
    rows = [event("a", f"2027-03-{d:02d} 10:00:00", session=d) for d in (2, 3, 9)]
    layer = metric_layer(marts_module.Marts(spark, export(spark, rows), cfg))
    plain, filled = (layer.query("sessions", "metric_time", fill_spine=f).agg(F.sum("sessions")).first()[0] for f in (False, True))
    assert plain == filled == 3
    days = layer.query("sessions", "metric_time", "2027-03-01", "2027-03-10", fill_spine=True)
    assert days.count() == 10


def test_events_without_a_user_keep_their_place(spark):
    raw = export(spark, [event("a", "2020-11-01 10:00:00"), event(None, "2020-11-01 10:00:00", session=None)])
    staged = marts_module.Marts(spark, raw, EngineConfig())["stg_events"]
    out = assign_gap_sessions(staged, EngineConfig()).collect()
    assert sorted((r.user_pseudo_id or "", r.gap_session_number) for r in out) == [("", None), ("a", 1)]


def test_day_partitions_are_pruned(spark, tmp_path):
    raw = readers.in_window(raw_events(spark, "/root/testdata/sf0.001"), W1)
    keep = marts_module.TableFolder(spark, str(tmp_path), W1).keep
    layer = metric_layer(marts_module.Marts(spark, raw, W1, keep=keep))
    got = layer.query("sessions,revenue", "metric_time", "2024-01-08", "2024-01-14")
    scans = [line for line in plan(got).splitlines() if "PartitionFilters: [isnotnull(" in line]
    assert len(scans) == 2 and got.count() == 7


def test_the_export_is_laid_out_by_day_before_its_records_are_made(spark, tmp_path, monkeypatch):
    """Rows are dealt and sorted while they are flat; nested records would be several times as wide in that sort."""
    numbers = itertools.count()
    monkeypatch.setattr(marts_module, "shared_folder", lambda s: f"{tmp_path}/shared/{next(numbers)}")
    rows = [
        (k, None if k % 11 == 0 else datetime(2024, 1, 1 + k % 9, k % 24), None if k % 13 == 0 else k % 5,
         ("view", "click", "signup", "error", "purchase", None)[k % 6], None if k % 7 == 0 else k / 3, None if k % 17 == 0 else f'{{"k": {k % 100}}}')
        for k in range(300)
    ]
    kinds = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows + rows[:20], kinds).write.parquet(f"{tmp_path}/in/events.parquet")
    source = lambda keep: raw_events(spark, f"{tmp_path}/in", keep)
    cfg = replace(W1, window_end=date(2024, 1, 5))
    marts = shared_marts(spark, f"{tmp_path}/in/events.parquet", source, cfg)
    laid_out = {p.parents[1] for p in (tmp_path / "shared").rglob("event_date=*/*.parquet")}
    assert [p.name for p in laid_out] == ["export"]
    stored = spark.read.parquet(str(laid_out.pop()))
    assert not any(kind.startswith(("array", "struct")) for _, kind in stored.dtypes)
    assert "PartitionFilters: [isnotnull(event_date" in plan(marts.raw)
    lazy = readers.in_window(raw_events(spark, f"{tmp_path}/in"), cfg)
    assert marts.raw.dtypes == lazy.dtypes
    assert sorted(map(str, marts.raw.collect())) == sorted(map(str, lazy.collect()))
    everything = shared_marts(spark, f"{tmp_path}/in/events.parquet", source, replace(cfg, every_row=True))
    assert everything.raw.count() == 320


def test_of_shared_tables_only_the_export_is_dealt_by_day(spark, tmp_path, monkeypatch):
    """The others hold the rows of a window, many times as wide; dealing them by day shuffled and sorted every one."""
    numbers = itertools.count()
    monkeypatch.setattr(marts_module, "shared_folder", lambda s: f"{tmp_path}/shared/{next(numbers)}")
    rows = [
        (k, None if k % 11 == 0 else datetime(2024, 1, 1 + k % 9, k % 24), None if k % 13 == 0 else k % 5,
         ("view", "click", "signup", "error", "purchase", None)[k % 6], float(k), None if k % 17 == 0 else f'{{"k": {k % 100}}}')
        for k in range(300)
    ]
    kinds = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows + rows[:20], kinds).write.parquet(f"{tmp_path}/in/events.parquet")
    source = lambda keep: raw_events(spark, f"{tmp_path}/in", keep)
    for cfg in (replace(W1, window_end=date(2024, 1, 5)), replace(W1, every_row=True)):
        marts = shared_marts(spark, f"{tmp_path}/in/events.parquet", source, cfg)
        lazy = marts_module.Marts(spark, readers.in_window(raw_events(spark, f"{tmp_path}/in"), cfg), cfg)
        for name in ("stg_events", "session_core", "dim_users", "sessions_enriched", "fct_events"):
            assert marts[name].dtypes == lazy[name].dtypes
            assert sorted(map(str, marts[name].collect())) == sorted(map(str, lazy[name].collect()))
    written = {p.parent for p in (tmp_path / "shared").rglob("*.parquet")}
    assert {"stg_events", "sessions_enriched", "dim_users", "fct_events"} <= {p.name for p in written}
    assert {p.parent.name for p in written if "=" in p.name} == {"export"}


def test_shared_tables_are_written_without_what_their_columns_give(spark, tmp_path, monkeypatch):
    """Keys are made of other columns; the hash of an event alone was most of the bytes of staged events."""
    numbers = itertools.count()
    monkeypatch.setattr(marts_module, "shared_folder", lambda s: f"{tmp_path}/shared/{next(numbers)}")
    rows = [
        (k, None if k % 11 == 0 else datetime(2024, 1, 1 + k % 9, k % 24, 0, 0, k), None if k % 13 == 0 else k % 5,
         ("view", "click", "signup", "error", "purchase", None)[k % 6], float(k), None if k % 17 == 0 else f'{{"k": {k % 100}}}')
        for k in range(200)
    ]
    kinds = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows + rows[:20], kinds).write.parquet(f"{tmp_path}/in/events.parquet")
    cfg = replace(W1, every_row=True)
    marts = shared_marts(spark, f"{tmp_path}/in/events.parquet", lambda keep: raw_events(spark, f"{tmp_path}/in", keep), cfg)
    lazy = marts_module.Marts(spark, raw_events(spark, f"{tmp_path}/in"), cfg)
    given = {"export": {"user_pseudo_id"}, "stg_events": {"event_key", "session_key"}, "session_core": {"session_key"}, "sessions_enriched": {"session_key"}}
    for name in ("stg_events", "session_core", "sessions_enriched"):
        assert marts[name].dtypes == lazy[name].dtypes
        assert sorted(map(str, marts[name].collect())) == sorted(map(str, lazy[name].collect()))
    for name, keys in given.items():
        stored = [p for p in (tmp_path / "shared").glob(f"*/{name}") if p.is_dir()]
        assert len(stored) == 1 and not keys & set(spark.read.parquet(str(stored[0])).columns)


@pytest.mark.parametrize("kind", ["not_null", "accepted_values", "accepted_range", "expression_is_true", "relationships"])
def test_row_rules_write_no_events_in_context(spark, tmp_path, monkeypatch, kind):
    """They read them once, and few of their columns; references read them again and again."""
    numbers = itertools.count()
    monkeypatch.setattr(marts_module, "shared_folder", lambda s: f"{tmp_path}/shared/{next(numbers)}")
    rows = [
        (k, None if k % 11 == 0 else datetime(2024, 1, 1 + k % 9, k % 24), None if k % 13 == 0 else k % 5,
         ("view", "click", "signup", "error", "purchase", None)[k % 6], float(k), None if k % 17 == 0 else f'{{"k": {k % 100}}}')
        for k in range(100)
    ]
    kinds = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows + rows[:20], kinds).write.parquet(f"{tmp_path}/in/events.parquet")
    name = next(n for n in queries() if n.startswith("k0") and n.endswith(kind))
    got = queries()[name](spark, f"{tmp_path}/in").collect()
    written = {p.parent.name for p in (tmp_path / "shared").rglob("*.parquet")}
    assert {"stg_events", "session_core", "dim_users", "sessions_enriched"} <= written
    assert ("fct_events" in written) == (kind == "relationships")
    lazy = marts_module.Marts(spark, raw_events(spark, f"{tmp_path}/in"), ALL)
    wanted = run_checks(lazy, [c for c in CHECKS if c.kind == kind]).where(F.col("kind") == kind)
    assert len(got) > 3 and sorted(map(str, got)) == sorted(map(str, wanted.collect()))
