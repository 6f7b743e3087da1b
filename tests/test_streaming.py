"""Sessions of a stream."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from footfall.config import EngineConfig
from footfall.operators.gaps import gap_sessions
from footfall.sources.readers import pin_utc
from footfall.streaming import sessions as streaming

CFG = EngineConfig()
NOON = datetime(2021, 1, 1, 12)
KINDS = "user_pseudo_id string, event_at timestamp"


def rows(df):
    return sorted(tuple(r) for r in df.select("user_pseudo_id", "session_started_at", "session_ended_at", "events_in_session").collect())


@pytest.fixture
def folder(spark, tmp_path):
    pin_utc(spark)
    return str(tmp_path)


def test_cuts_at_31_minutes_and_not_a_microsecond_before(spark, folder):
    near, far = timedelta(minutes=30, seconds=59, microseconds=999_999), timedelta(minutes=31)
    events = [("near", NOON), ("near", NOON + near), ("far", NOON), ("far", NOON + far), ("chain", NOON), ("chain", NOON + near), ("chain", NOON + 2 * near)]
    df = spark.createDataFrame(events + [(None, NOON)], KINDS)
    out = streaming.sessions_of_slices(spark, df, folder, CFG, 2)
    assert [(r[0], r[3]) for r in rows(out)] == [("chain", 3), ("far", 1), ("far", 1), ("near", 2)]
    assert rows(out) == rows(gap_sessions(df, CFG))


def test_same_as_the_batch_operator(spark, folder):
    """One user has a third of all events; sessions go over the slices' borders."""
    import random

    pick = random.Random(1)
    events = [("busy" if k % 3 == 0 else f"u{k % 40}", NOON + timedelta(seconds=pick.randint(0, 400_000))) for k in range(3000)]
    df = spark.createDataFrame(events, KINDS)
    assert rows(streaming.sessions_of_slices(spark, df, folder, CFG, 3)) == rows(gap_sessions(df, CFG))


def test_no_events(spark, folder):
    assert streaming.sessions_of_slices(spark, spark.createDataFrame([], KINDS), folder, CFG).collect() == []


def test_late_events_are_left_out_and_counted(spark, folder):
    """Ten minutes late still counts with a delay of an hour; a day late does not."""

    def arrive(*events):
        spark.createDataFrame(list(events), KINDS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        source = spark.readStream.schema(KINDS).parquet(f"{folder}/in")
        query = streaming.start(streaming.stream_sessions(source, CFG, "1 hour"), f"{folder}/out", f"{folder}/checkpoint")
        query.awaitTermination()
        return sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators)

    assert arrive(("a", NOON), ("b", NOON + timedelta(hours=3))) == 0
    assert arrive(("b", NOON + timedelta(hours=2, minutes=50))) == 0
    assert arrive(("a", NOON - timedelta(days=1))) == 1
    assert arrive(("z", NOON + timedelta(days=2))) == 0
    out = spark.read.parquet(f"{folder}/out")
    assert [(r[0], r[3]) for r in rows(out)] == [("a", 1), ("b", 2)]
