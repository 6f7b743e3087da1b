"""Loads of days against the full refresh."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from footfall.config import EngineConfig
from footfall.plans.incremental import IncrementalMarts
from footfall.plans.marts import Marts
from footfall.queries import comparable
from tests.rows import event, export

CFG = EngineConfig()
FIRST = date(2020, 11, 1)


def days(a, b):
    return [FIRST + timedelta(n) for n in range(a, b)]


def rows_of(df):
    return sorted(map(str, comparable(df.select(*sorted(df.columns)), 5).collect()))


def same_as_full_refresh(spark, store, rows):
    raw = export(spark, rows)
    full = Marts(spark, raw, CFG)
    assert rows_of(store.events(raw)) == rows_of(full["stg_events"])
    assert rows_of(store.sessions(raw).drop("step_reach")) == rows_of(full["session_core"].drop("step_reach"))
    assert rows_of(store.users(raw)) == rows_of(full["dim_users"])


@pytest.fixture(scope="module")
def rows():
    """Sessions over several days, users who come back, purchases and features, events without a session."""
    pick, out = random.Random(2), []
    names = ("page_view", "view_item", "purchase", "select_promotion", "view_search_results", "add_to_cart")
    for user in range(25):
        for session in range(pick.randint(1, 4)):
            start = pick.randint(0, 11)
            for _ in range(pick.randint(1, 6)):
                day = FIRST + timedelta(min(11, start + pick.choice((0, 0, 0, 1, 3))))
                at = f"{day} {pick.randint(0, 23):02d}:{pick.randint(0, 59):02d}:00"
                out.append(event(f"u{user}", at, pick.choice(names), session=None if pick.random() < 0.05 else session))
    return out


def of(spark, rows, some):
    return export(spark, rows).where(F.col("event_date").isin([f"{d:%Y%m%d}" for d in some]))


def test_loads_are_the_full_refresh(spark, tmp_path, rows):
    store = IncrementalMarts(spark, str(tmp_path), CFG)
    for a, b in ((0, 5), (5, 9), (9, 12)):
        store.load(of(spark, rows, days(a, b)), days(a, b))
    same_as_full_refresh(spark, store, rows)
    store.load(of(spark, rows, days(5, 9)), days(5, 9))  # again, as after a load that died
    same_as_full_refresh(spark, store, rows)


def test_a_day_may_come_again_with_other_rows(spark, tmp_path, rows):
    """Late, changed and withdrawn events of one day; sessions there go, shrink, and begin on another day."""
    store = IncrementalMarts(spark, str(tmp_path), CFG)
    store.load(export(spark, rows), days(0, 12))
    on = f"{FIRST + timedelta(4):%Y%m%d}"
    kept = [r for r in rows if r[0] != on]
    changed = kept + [event("new", f"{FIRST + timedelta(4)} 10:00:00", "purchase"), event("u1", f"{FIRST + timedelta(4)} 11:00:00", "page_view", session=0)]
    store.load(of(spark, changed, days(4, 5)), days(4, 5))
    same_as_full_refresh(spark, store, changed)
    store.load(of(spark, kept, days(4, 5)), days(4, 5))
    same_as_full_refresh(spark, store, kept)
    assert not (tmp_path / "stg_events" / f"event_date={FIRST + timedelta(4)}").exists()


def test_days_that_nothing_touches_keep_their_files(spark, tmp_path):
    def files():
        return {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}

    rows = [event("a", f"{FIRST + timedelta(n)} 10:00:00", session=n) for n in range(6)]
    rows += [event("b", f"{FIRST + timedelta(2)} 23:50:00", session=9)]
    store = IncrementalMarts(spark, str(tmp_path), CFG)
    store.load(of(spark, rows, days(0, 4)), days(0, 4))
    before = files()
    more = [*rows, event("b", f"{FIRST + timedelta(4)} 00:05:00", session=9)]  # the session of day 2 goes on
    store.load(of(spark, more, days(4, 6)), days(4, 6))
    after = files()
    old = {p for p in before if after.get(p) == before[p]}
    changed = {p.split("/")[1] for p in before.keys() - old}
    assert changed == {f"session_date={FIRST + timedelta(2)}"}
    assert sum(p.startswith(("stg_events", "behaviour_days")) for p in before) == sum(p.startswith(("stg_events", "behaviour_days")) for p in old) > 3
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_load")]
    same_as_full_refresh(spark, store, more)


def test_loads_without_rows(spark, tmp_path):
    store = IncrementalMarts(spark, str(tmp_path), CFG)
    store.load(export(spark, []), days(0, 3))
    assert store.users(export(spark, [])).collect() == []
