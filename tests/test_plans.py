"""Plan shape: what must and must not be in the physical plans."""

from __future__ import annotations

import re

import pytest

from footfall.operators.funnel import fct_funnel
from footfall.operators.gaps import gap_sessions
from footfall.operators.sessions import session_core, with_filled_flags
from footfall.operators.users import session_rollup
from footfall.plans.layer import metric_layer
from footfall.plans.marts import Marts, TableFolder
from footfall.queries import queries
from footfall.sources.driver_tables import W1, raw_events
from footfall.sources.readers import in_window

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def marts(spark, tmp_path_factory):
    """Tables in a folder, as on a cluster that names one."""
    raw = in_window(raw_events(spark, SF), W1)
    return Marts(spark, raw, W1, keep=TableFolder(spark, str(tmp_path_factory.mktemp("marts")), W1).keep)


@pytest.fixture
def large(spark):
    """Plans as for tables beyond the broadcast limit."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_python_and_no_cross_join(spark, name):
    text = plan(queries()[name](spark, SF))
    for bad in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text, f"{name}: {bad}"


def test_funnel_adds_no_shuffle(marts):
    text = plan(fct_funnel(with_filled_flags(marts["sessions_enriched"]), W1))
    assert "Exchange" not in text and "Join" not in text and "Window" not in text


def test_raw_events_are_combined_before_any_window(marts, large):
    for df in (session_core(marts["stg_events"], W1), gap_sessions(marts["stg_events"], W1)):
        lines = plan(df).splitlines()
        window = max(i for i, x in enumerate(lines) if re.search(r"Window \[", x))
        assert any("Aggregate" in x and "partial_" in x for x in lines[window:])
        scan = [i for i, x in enumerate(lines) if "FileScan" in x and i > window][0]
        assert [x for x in lines[window:scan] if "partial_min" in x or "partial_max" in x]


def test_numbers_are_hash_aggregated(marts, large):
    text = plan(session_core(marts["stg_events"], W1))
    assert text.count("SortAggregate") == 2  # only the text values, partial and final
    assert "Expand" not in text


def test_exchange_counts(marts, large):
    # numbers: per block, per session; text: one; distinct: two
    assert plan(session_core(marts["stg_events"], W1)).count("Exchange hashpartitioning") == 5
    # per user and day, per user
    assert plan(session_rollup(marts["session_core"], W1)).count("Exchange hashpartitioning") == 2
    layer = metric_layer(marts)
    assert plan(layer.query("sessions,session_depth,transactions", "session__device_category")).count("Exchange hash") == 1
    assert plan(layer.query("feature_adoption_rate,feature_adoption_rate_promotions", "event__country")).count("Exchange hash") == 2


def test_distinct_counts_do_not_multiply_rows(marts):
    names = "feature_adoption_rate,feature_adoption_rate_promotions,feature_adoption_rate_site_search"
    assert "Expand" not in plan(metric_layer(marts).query(names))


def test_only_needed_columns_are_read(marts):
    text = plan(metric_layer(marts).query("sessions", "session__device_category", where="session__country = 'country_1'"))
    schema = re.search(r"ReadSchema: (struct<[^>]*>)", text).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {"session_key", "device_category", "country"}
    assert "PushedFilters: [IsNotNull(country), EqualTo(country,country_1)]" in text


def test_time_bounds_reach_the_scan(marts):
    text = plan(metric_layer(marts).query("revenue", start_time="2024-01-08", end_time="2024-01-14"))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date#\d+ >= 2024-01-08", text)


def test_small_seed_is_broadcast_by_its_size(marts, spark):
    from footfall.operators.event_facts import fct_events

    text = plan(fct_events(marts["stg_events"], marts["int_sessions"], marts["feature_catalogue"], W1))
    assert "BroadcastHashJoin [event_name" in text
