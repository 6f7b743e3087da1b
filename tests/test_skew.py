"""Hot keys: same results as brute force, and no task that gets a hot key whole."""

from __future__ import annotations

import random
from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from footfall.config import EngineConfig
from footfall.operators.event_facts import left_join_spreading_nulls
from footfall.operators.gaps import assign_gap_sessions, gap_sessions
from footfall.operators.sessions import enrich_sessions, session_core
from footfall.operators.staging import stage_events
from footfall.plans.layer import metric_layer
from footfall.sources.writers import materialize
from tests.rows import _EPOCH, event, export

MINUTE = 60_000_000


def random_events(seed, n, start):
    """A third of all events belong to one user and one session."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        user, session = ("hot", 1) if hot else (f"u{rng.randrange(12)}", rng.randrange(4))
        step = rng.choice([0, 1, 59_999_999, MINUTE, 2 * MINUTE - 1, 31 * MINUTE - 1, 31 * MINUTE])
        at = start + rng.randrange(400) * MINUTE + step
        rows.append((user, session, at, f"e{i}"))
    return rows


def brute_gaps(times, minutes):
    ordered = sorted(times)
    return [(b - a) // MINUTE > minutes for a, b in zip(ordered, ordered[1:])]


@pytest.mark.parametrize("minutes", [0, 1, 30])
@pytest.mark.parametrize("start", [1_606_800_000_000_000, -10 * 24 * 60 * MINUTE])  # 2020 and 1969
def test_gaps_match_brute_force(spark, minutes, start):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    cfg = replace(EngineConfig(), session_gap_minutes=minutes)
    rows = random_events(minutes, 600, start)
    events = spark.createDataFrame(rows, "user_pseudo_id string, s int, micros bigint, event_key string").select(
        "user_pseudo_id", "event_key", F.timestamp_micros("micros").alias("event_at"), "micros"
    )
    by_user = {}
    for user, _, at, _ in rows:
        by_user.setdefault(user, []).append(at)
    got = gap_sessions(events, cfg).groupBy("user_pseudo_id").agg(F.count("*").alias("n"), F.sum("events_in_session").alias("e"))
    for row in got.collect():
        times = by_user[row.user_pseudo_id]
        assert row.n == 1 + sum(brute_gaps(times, minutes)) and row.e == len(times)
    for user, times in by_user.items():
        numbered = {}
        ordered, number = sorted(times), 1
        for i, at in enumerate(ordered):
            number += i > 0 and (at - ordered[i - 1]) // MINUTE > minutes
            numbered[at] = number
        by_user[user] = numbered
    for row in assign_gap_sessions(events, cfg).collect():
        assert by_user[row.user_pseudo_id][row.micros] == row.gap_session_number


def test_session_gaps_match_brute_force(spark):
    rows = random_events(7, 900, 1_606_800_000_000_000)
    made = [
        event(user, (_EPOCH + timedelta(microseconds=at)).strftime("%Y-%m-%d %H:%M:%S.%f"), session=session, bundle=i)
        for i, (user, session, at, _) in enumerate(rows)
    ]
    cfg = EngineConfig()
    core = session_core(stage_events(export(spark, made)), cfg)
    expected = {}
    for user, session, at, _ in rows:
        expected.setdefault(f"{user}-{session}", []).append(at)
    got = {r.session_key: r for r in core.collect()}
    assert set(got) == set(expected)
    for key, times in expected.items():
        assert got[key].inactivity_gaps == sum(brute_gaps(times, 30))
        assert got[key].events_in_session == len(times)


@pytest.fixture
def forced_skew(spark):
    """Sort-merge joins only, and AQE thresholds low enough for a small test."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def wide_events(spark, n, hot):
    """Staged-like events; ``hot`` gives the session key of each third row."""
    third = F.col("id") % 3 == 0
    return spark.range(0, n, 1, 8).select(
        F.md5(F.col("id").cast("string")).alias("event_key"),
        F.when(third, F.lit(hot)).otherwise(F.concat(F.lit("u-"), (F.col("id") % 500).cast("string"))).alias("session_key"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )


def stored(df, path):
    """As between the layers of a build: written, then read back."""
    df.write.parquet(str(path))
    return df.sparkSession.read.parquet(str(path))


def test_hot_session_is_split_in_the_event_join(forced_skew, tmp_path):
    spark = forced_skew
    events = stored(wide_events(spark, 30_000, "hot-1"), tmp_path / "events")
    sessions = stored(
        events.groupBy("session_key").agg(F.count("*").alias("n")).select(F.col("session_key").alias("__session"), "n"),
        tmp_path / "sessions",
    )
    joined = left_join_spreading_nulls(events, sessions, "session_key", "__session", F.col("event_key"))
    assert "skew=true" in final_plan(joined).lower()
    assert joined.count() == 30_000


def test_events_without_session_are_spread(forced_skew):
    spark = forced_skew
    events = wide_events(spark, 30_000, None)
    sessions = events.where("session_key is not null").select(F.col("session_key").alias("__session")).distinct().withColumn("n", F.lit(1))
    joined = left_join_spreading_nulls(events, sessions, "session_key", "__session", F.col("event_key"))
    per_task = joined.where("session_key is null").groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert per_task[1] == 10_000 and per_task[0] < 5_000
    assert joined.where("session_key is null and n is not null").count() == 0


def test_hot_user_is_split_in_the_session_join(forced_skew, tmp_path):
    spark = forced_skew
    core = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), (F.col("id") % 700).cast("string"))).alias("user_pseudo_id"),
        F.col("id").alias("ga_session_id"), F.sha2(F.col("id").cast("string"), 512).alias("landing_page"),
        F.timestamp_seconds(F.col("id")).alias("session_started_at"), F.to_date(F.timestamp_seconds("id")).alias("session_date"),
    )
    users = core.groupBy("user_pseudo_id").agg(F.min("session_started_at").alias("first_seen_at")).select(
        "user_pseudo_id", "first_seen_at", F.to_date("first_seen_at").alias("first_seen_date"),
        F.lit(None).cast("timestamp").alias("first_touch_at"), F.lit(False).alias("is_left_censored"),
        F.lit(True).alias("is_cohort_eligible"),
        *[F.lit("x").alias(c) for c in ("acquisition_source", "acquisition_medium", "acquisition_campaign",
                                        "first_device_category", "first_country")],
    )
    joined = enrich_sessions(stored(core, tmp_path / "core"), stored(users, tmp_path / "users"), EngineConfig())
    assert "skew=true" in final_plan(joined).lower()
    assert joined.count() == 30_000


def test_hot_day_is_written_by_several_tasks(forced_skew, tmp_path):
    rows = forced_skew.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "20240101").otherwise(F.concat(F.lit("202402"), (F.col("id") % 20 + 10).cast("string"))).alias("event_date"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )
    materialize(rows, str(tmp_path / "t"), partition_by="event_date", cluster_by=["payload"])
    assert len(list((tmp_path / "t" / "event_date=20240101").glob("*.parquet"))) > 2
    assert forced_skew.read.parquet(str(tmp_path / "t")).count() == 30_000


def test_metric_rows_are_combined_before_dimension_joins(forced_skew):
    from footfall.queries import marts_of
    from footfall.sources.driver_tables import W1

    layer = metric_layer(marts_of(forced_skew, "/root/testdata/sf0.001", W1))
    text = layer.query("revenue,feature_adoption_rate", "user__first_country")._jdf.queryExecution().optimizedPlan().toString()
    for line_no, line in enumerate(text.splitlines()):
        if "Join LeftOuter" in line:
            below = [x for x in text.splitlines()[line_no + 1:]][:4]
            assert any("Aggregate" in x for x in below), text
