"""Each rule at its boundary, on hand-made rows; one user per rule."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from footfall.config import EngineConfig
from footfall.operators.gaps import assign_gap_sessions, gap_sessions
from footfall.plans.checks import run_checks
from footfall.plans.marts import Marts, TableFolder
from footfall.sources.readers import in_window
from tests.rows import event, export, param

CFG = EngineConfig()  # 2020-11-01 .. 2021-01-31, N = 7, gap = 30
D = "2020-12-01"

ROWS = [
    event("u01", f"{D} 10:00:00", page=None, extra=[param("page_location", text="/first"), param("page_location", text="/second")]),
    event("u02", f"{D} 10:00:00", session=None), event("u02", f"{D} 10:01:00", session=None, name="click"),
    event("u03", f"{D} 10:00:00"), event("u03", f"{D} 10:30:59"),
    event("u04", f"{D} 10:00:00"), event("u04", f"{D} 10:31:00"),
    event("u05", f"{D} 10:00:00"), event("u05", f"{D} 10:00:09.999999", name="scroll"),
    event("u06", f"{D} 10:00:00"), event("u06", f"{D} 10:00:10", name="scroll"),
    event("u07", f"{D} 10:00:00"),
    event("u08", f"{D} 08:00:00", session=1), event("u08", f"{D} 20:00:00", session=2),
    event("u09", f"{D} 10:00:00", session=1), event("u09", "2020-12-08 10:00:00", session=2),
    event("u10", f"{D} 10:00:00", session=1), event("u10", "2020-12-09 10:00:00", session=2),
    event("u11", f"{D} 10:00:00", session=1), event("u11", "2020-12-08 10:00:00", name="purchase", session=2, transaction="a", revenue=5.0),
    event("u12", f"{D} 10:00:00", session=1), event("u12", "2020-12-09 10:00:00", name="purchase", session=2, transaction="b", revenue=5.0),
    event("u13", "2021-01-24 10:00:00"),
    event("u14", "2021-01-25 10:00:00"),
    event("u15", "2020-11-01 10:00:00", first_touch="2020-10-31 23:59:59.999999"),
    event("u16", "2020-11-01 10:00:00"),
    event("u17", f"{D} 10:00:00", name="purchase", session=None, transaction="c", revenue=3.0),
    event("u17", "2020-12-03 10:00:00", session=1),
    event("u18", f"{D} 10:00:00", name="session_start"), event("u18", f"{D} 10:01:00", name="begin_checkout"),
    event("u19", f"{D} 10:00:00", name="purchase", transaction="d", revenue=1.0),
    event("u19", f"{D} 10:01:00", name="begin_checkout"), event("u19", f"{D} 10:02:00", name="add_to_cart"),
    event("u19", f"{D} 10:03:00", name="view_item"), event("u19", f"{D} 10:04:00", name="session_start"),
    event("u20", f"{D} 10:00:00", session=1), event("u20", f"{D} 10:00:00", session=2),
    event("u21", f"{D} 10:00:00", name="purchase", transaction="T", revenue=10.0, session=1),
    event("u21", f"{D} 10:01:00", name="purchase", transaction="T", revenue=10.0, session=1),
    event("u21", f"{D} 18:00:00", name="purchase", transaction="T", revenue=10.0, session=2),
    event("u22", f"{D} 10:00:00", name="view_promotion"),
    event("u23", f"{D} 10:00:00", page=None), event("u23", f"{D} 10:01:00", page="/late"), event("u23", f"{D} 10:02:00", page="/later"),
    event("u24", f"{D} 23:50:00", session=1), event("u24", "2020-12-02 00:10:00", session=2),
    event("u25", f"{D} 10:00:00", name="view_search_results"), event("u25", f"{D} 10:01:00", name="click"),
    event("u25", f"{D} 10:02:00", name="select_promotion"), event("u25", f"{D} 10:03:00", name="view_search_results"),
    event("u26", f"{D} 10:00:00", engaged="1", msec=1500), event("u26", f"{D} 10:00:01", engaged="0", msec=250, name="scroll"),
    event("u27", f"{D} 10:00:00", name="b", device="mobile"), event("u27", f"{D} 10:00:00", name="a", device="tablet"),
    event("out", "2020-10-31 23:00:00"), event("out", "2021-02-01 00:00:00"),
]


@pytest.fixture(scope="module")
def marts(spark, tmp_path_factory):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    keep = TableFolder(spark, str(tmp_path_factory.mktemp("marts")), CFG).keep
    return Marts(spark, in_window(export(spark, ROWS), CFG), CFG, keep=keep)


@pytest.fixture(scope="module")
def rows_of(marts):
    cache = {}

    def get(table, user):
        if table not in cache:
            cache[table] = marts[table].collect()
        return [r for r in cache[table] if r["user_pseudo_id"] == user]

    return get


def one(rows):
    assert len(rows) == 1
    return rows[0]


def test_window_is_inclusive_and_outside_rows_are_gone(rows_of):
    assert rows_of("stg_events", "out") == []


def test_first_of_a_repeated_parameter(rows_of):
    assert one(rows_of("stg_events", "u01"))["page_location"] == "/first"


def test_events_without_session_stay_events_only(rows_of):
    assert len(rows_of("fct_events", "u02")) == 2
    assert rows_of("int_sessions", "u02") == [] and rows_of("dim_users", "u02") == []
    row = rows_of("fct_events", "u02")[0]
    assert row["session_key"] is None and row["has_full_d7_window"] is None
    assert row["is_left_censored"] is False and row["days_since_first_session"] is None


@pytest.mark.parametrize("user, gaps", [("u03", 0), ("u04", 1)])
def test_gap_is_counted_in_whole_minutes(rows_of, user, gaps):
    row = one(rows_of("int_sessions", user))
    assert row["inactivity_gaps"] == gaps and row["is_split_by_inactivity_rule"] == (gaps > 0)


@pytest.mark.parametrize("user, engaged", [("u05", False), ("u06", True)])
def test_ten_whole_seconds_make_an_engaged_session(rows_of, user, engaged):
    assert one(rows_of("int_sessions", user))["is_engaged_session_derived"] is engaged


def test_absent_engaged_flag_is_false_not_null(rows_of):
    assert one(rows_of("int_sessions", "u07"))["is_engaged_session"] is False
    assert one(rows_of("stg_events", "u07"))["is_session_engaged_event"] is None


def test_engagement_flag_and_seconds(rows_of):
    row = one(rows_of("int_sessions", "u26"))
    assert row["is_engaged_session"] is True and row["engagement_time_seconds"] == 1.75


def test_day_zero_is_no_return(rows_of):
    row = one(rows_of("dim_users", "u08"))
    assert (row["is_retained_d1"], row["is_retained_d7"], row["is_retained_d30"]) == (False, False, False)
    assert row["sessions"] == 2 and row["active_days"] == 1


@pytest.mark.parametrize("user, d7, d30", [("u09", True, True), ("u10", False, True)])
def test_day_seven_is_the_last_of_d7(rows_of, user, d7, d30):
    row = one(rows_of("dim_users", user))
    assert (row["is_retained_d7"], row["is_retained_d30"]) == (d7, d30)


@pytest.mark.parametrize("user, days, activated", [("u11", 7, True), ("u12", 8, False), ("u17", -2, False), ("u07", None, False)])
def test_activation_window(rows_of, user, days, activated):
    row = one(rows_of("dim_users", user))
    assert (row["days_to_first_purchase"], row["is_activated"]) == (days, activated)


@pytest.mark.parametrize("user, closed", [("u13", True), ("u14", False)])
def test_window_closes_on_the_seventh_day(rows_of, user, closed):
    row = one(rows_of("dim_users", user))
    assert row["has_full_d7_window"] is closed and row["has_full_activation_window"] is closed
    assert row["has_full_d1_window"] is True and row["has_full_d30_window"] is False


@pytest.mark.parametrize("user, censored", [("u15", True), ("u16", False)])
def test_left_censoring(rows_of, user, censored):
    assert one(rows_of("dim_users", user))["is_left_censored"] is censored
    assert one(rows_of("int_sessions", user))["is_left_censored"] is censored
    assert one(rows_of("fct_sessions", user))["is_cohort_eligible"] is not censored


def test_step_without_its_predecessor(rows_of):
    rows = {r["step_number"]: r for r in rows_of("fct_funnel", "u18")}
    assert len(rows) == 5
    assert [rows[i]["is_reached"] for i in range(1, 6)] == [True, False, False, True, False]
    assert [rows[i]["is_reached_in_sequence"] for i in range(1, 6)] == [True, False, False, False, False]
    assert rows[4]["seconds_from_session_start"] == 60 and rows[2]["step_event_count"] == 0


def test_sequence_ignores_order_in_time(rows_of):
    assert all(r["is_reached_in_sequence"] for r in rows_of("fct_funnel", "u19"))


def test_sessions_that_start_together_are_both_first(rows_of):
    assert [r["is_first_session"] for r in rows_of("int_sessions", "u20")] == [True, True]


def test_transactions_three_ways(rows_of):
    sessions = rows_of("int_sessions", "u21")
    assert sum(r["purchase_events"] for r in sessions) == 3
    assert sum(r["transactions"] for r in sessions) == 2
    assert len({r["transaction_id"] for r in rows_of("stg_events", "u21")}) == 1
    assert sum(r["session_revenue_usd"] for r in sessions) == 30.0


def test_impressions_are_not_adoption(rows_of):
    assert one(rows_of("dim_users", "u22"))["features_adopted"] == 0
    assert one(rows_of("dim_users", "u25"))["features_adopted"] == 3
    impression = one(rows_of("fct_events", "u22"))
    assert impression["feature_name"] == "promotions" and impression["is_user_initiated_feature"] is False


def test_landing_page_is_the_first_page_there_is(rows_of):
    assert one(rows_of("int_sessions", "u23"))["landing_page"] == "/late"


def test_calendar_days_not_24_hours(rows_of):
    assert one(rows_of("dim_users", "u24"))["is_retained_d1"] is True


def test_first_event_breaks_ties_by_name(rows_of):
    assert one(rows_of("int_sessions", "u27"))["device_category"] == "tablet"


def test_item_count_and_zero_filling(rows_of):
    staged = rows_of("stg_events", "u21")[0]
    assert staged["item_count"] == 2 and staged["is_entrance"] is False
    plain = one(rows_of("stg_events", "u07"))
    assert plain["item_count"] is None and plain["purchase_revenue_usd"] is None
    assert one(rows_of("fct_events", "u07"))["purchase_revenue_usd"] == 0.0


def test_no_event_is_lost_or_added(marts):
    assert marts["fct_events"].count() == marts["stg_events"].count() == len(ROWS) - 2
    assert marts["fct_funnel"].count() == 5 * marts["int_sessions"].count()


def test_gap_rule_sessions(spark, marts):
    sessions = {(r.user_pseudo_id, r.gap_session_number): r for r in gap_sessions(marts["stg_events"], CFG).collect()}
    assert ("u03", 2) not in sessions and ("u04", 2) in sessions
    assert sessions[("u09", 2)].events_in_session == 1
    assert assign_gap_sessions(marts["stg_events"], CFG).count() == len(ROWS) - 2


def test_only_the_known_checks_fail(marts):
    failed = {r.check_id for r in run_checks(marts).where(~F.col("passed")).collect()}
    # events without a session: NULL keys (warnings) and users that no session introduces
    assert failed == {"Q03", "Q32", "Q35"}


def test_activation_window_is_a_setting(spark):
    cfg = EngineConfig(activation_window_days=8)
    users = Marts(spark, in_window(export(spark, ROWS), cfg), cfg)["dim_users"]
    assert users.where("user_pseudo_id = 'u12'").first().is_activated is True


def test_empty_source_fails_only_the_non_empty_check(spark, tmp_path):
    cfg = EngineConfig(date(2010, 1, 1), date(2010, 1, 2))
    empty = Marts(spark, in_window(export(spark, ROWS), cfg), cfg, keep=TableFolder(spark, str(tmp_path), cfg).keep)
    failed = [(r.kind, r.table) for r in run_checks(empty).where(~F.col("passed")).collect()]
    assert {k for k, _ in failed} == {"non_empty"}
    assert {t for _, t in failed} == {"stg_events", "int_sessions", "fct_events", "dim_users", "fct_sessions", "fct_funnel"}
