"""Rows without a day, and days after the calendar's end, in queries that read every row."""

from __future__ import annotations

from datetime import datetime

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as driver
from footfall.plans.layer import metric_layer
from footfall.plans.marts import Marts
from footfall.sources.driver_tables import W1, raw_events
from tests.test_oracle import KINDS

SF = "/root/testdata/sf0.001"
NAMES = ("p01_staging", "a14_row_counts", "k01_not_null", "k03_accepted_values", "k04_relationships", "k05_accepted_range",
         "k06_expression_is_true", "c02_gap_half_hour", "c03_gap_sessions", "c03_gap_session_events", "r06_event_inventory", "t01_stream_sessions")


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    """The given events, ten of them without a time and ten in 2027."""
    folder = tmp_path_factory.mktemp("odd")
    events = pd.read_parquet(f"{SF}/events.parquet")
    events["ts"] = events["ts"].astype("datetime64[us]")
    events.loc[events.index[::100], "ts"] = pd.NaT
    late = events.index[50::100]
    events.loc[late, "ts"] = [datetime(2027, 3, 1 + 2 * k, 9) for k in range(len(late))]
    events.to_parquet(folder / "events.parquet")
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_the_sql(spark, source, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{source}/events.parquet'")
    result = con.execute(driver.oracle_sql()[name])
    df = driver.queries()[name](spark, source)
    order = sorted(df.columns)
    at = [[d[0] for d in result.description].index(c) for c in order]
    assert {d[0]: KINDS.get(str(d[1])) for d in result.description}.keys() == set(order)
    assert sorted(repr(tuple(r[c] for c in order)) for r in df.collect()) == sorted(repr(tuple(r[k] for k in at)) for r in result.fetchall())


def test_events_without_a_day_are_counted_and_reported(spark, source):
    queries = driver.queries()
    assert queries["p01_staging"](spark, source).where("event_date is null").count() == 10
    counts = {r["table"]: r["n_rows"] for r in queries["a14_row_counts"](spark, source).collect()}
    assert counts["stg_events"] == counts["fct_events"] == 1000
    q06 = queries["k01_not_null"](spark, source).where("check_id = 'Q06'").first()
    assert q06["failures"] == 10 and not q06["passed"]


@pytest.mark.parametrize("grain, rows", [("day", 19), ("week", 3), ("month", 1)])
def test_empty_days_after_the_calendar_are_filled(spark, source, grain, rows):
    """Sessions of 2027 on every other day; only the start is given."""
    from dataclasses import replace
    from datetime import date

    cfg = replace(W1, window_end=date(2027, 12, 31))
    marts = Marts(spark, raw_events(spark, source), replace(cfg, every_row=True))
    layer = metric_layer(marts)
    name = "metric_time" if grain == "day" else f"metric_time__{grain}"
    out = layer.query("sessions", name, "2027-03-01", fill_spine=True, order_by=name).collect()
    days = [r[name] for r in out]
    assert len(days) == rows and all(a < b for a, b in zip(days, days[1:]))
    plain = {r[name]: r["sessions"] for r in layer.query("sessions", name, "2027-03-01").collect()}
    assert {r[name]: r["sessions"] for r in out if r["sessions"]} == plain
    assert grain != "day" or sum(r["sessions"] == 0 for r in out) == rows - len(plain) > 5


def test_the_calendar_goes_on_to_the_windows_end(spark, source):
    from dataclasses import replace
    from datetime import date

    marts = Marts(spark, raw_events(spark, source), replace(W1, window_end=date(2027, 6, 30)))
    assert marts["time_spine"].agg({"date_day": "max"}).first()[0] == date(2027, 6, 30)
