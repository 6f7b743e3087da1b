"""The metric layer on the given tables at the smallest scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from footfall.plans import catalogue, reports
from footfall.plans.layer import PRODUCT_ANALYTICS, metric_layer
from footfall.plans.marts import Marts
from footfall.plans.metric_definitions import METRICS
from footfall.plans.metric_query import MetricLayer, Refused, names_in, plain_filter
from footfall.plans.models import MODELS
from footfall.plans.semantics import Definitions, Metric
from footfall.plans.star_schema import star_layer
from footfall.queries import marts_of
from footfall.sources.driver_tables import W1, W2

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def marts(spark):
    return marts_of(spark, SF, W1)


@pytest.fixture(scope="module")
def layer(marts):
    return metric_layer(marts)


def test_inventory():
    d = PRODUCT_ANALYTICS
    assert len(d.measures) == 29 and len(d.metrics) == 42 and len(d.models) == 4
    kinds = [m.type for m in d.metrics.values()]
    assert (kinds.count("simple"), kinds.count("ratio")) == (25, 17)
    grains = [m.grain for m in d.metrics.values()]
    assert (grains.count("user"), grains.count("session"), grains.count("event")) == (21, 20, 1)


def test_governance_is_complete(spark, layer):
    rows = catalogue.metric_catalogue(spark, PRODUCT_ANALYTICS).collect()
    assert len(rows) == 42
    for row in rows:
        assert all(row[f] for f in ("label", "grain", "description", "definition", "assumption", "tradeoff", "breaks_if"))
    assert catalogue.governance(spark, layer, "revenue,sessions").count() == 2


@pytest.mark.parametrize("metric, n", [("d7_retention_rate", 16), ("sessions", 32), ("revenue", 45), ("purchase_conversion_rate", 42)])
def test_reachable_dimensions(layer, metric, n):
    assert len(layer.dimensions_of(metric)) == n


def test_dimensions_of_several_metrics_are_shared_ones(layer):
    both = layer.dimensions_of("d7_retention_rate,sessions")
    assert set(both) == set(layer.dimensions_of("d7_retention_rate"))


def test_unknown_metric_is_refused_as_data(layer):
    answer = layer.answer("made_up_metric")
    assert answer["refused"] is True and answer["ok"] is False
    assert "made_up_metric" in answer["error"] and len(answer["available_metrics"]) == 42
    with pytest.raises(Refused):
        layer.query("made_up_metric")


def test_unreachable_dimension_is_refused_with_governance(layer):
    answer = layer.answer("activation_rate", group_by="event__event_name")
    assert answer["ok"] is False and "event__event_name" in answer["error"]
    assert "activation_rate" in answer["governance"] and "hint" in answer


def test_raw_columns_cannot_be_filtered_on(layer):
    answer = layer.answer("sessions", where="user_pseudo_id = '1-1'")
    assert answer["ok"] is False and answer["governance"]


def test_bad_arguments_are_answered_not_raised(layer):
    for bad in ({"start_time": "last week"}, {"order_by": "nonsense"}, {"where": "session__country ="}):
        answer = layer.answer("sessions", **bad)
        assert answer["ok"] is False and answer["error"] and answer["governance"]
    with pytest.raises(ValueError):
        layer.answer("")


def test_repeated_names_count_once(layer):
    assert layer.query("sessions, sessions", "session__country,session__country").columns == ["session__country", "sessions"]


def test_answer_carries_rows_and_governance(layer):
    answer = layer.answer(
        "d7_retention_rate,d7_eligible_users", group_by="metric_time__month",
        where="{{ Dimension('user__first_device_category') }} = 'mobile'", order_by="metric_time__month",
    )
    assert answer["ok"] and answer["rows"] and answer["governance"]["d7_retention_rate"]["definition"]


def test_truncation_flag_is_exact(layer):
    n = layer.query("sessions", "session__device_category").count()
    assert layer.answer("sessions", "session__device_category", limit=n)["truncated"] is False
    assert layer.answer("sessions", "session__device_category", limit=n - 1)["truncated"] is True


def test_order_and_limits(layer):
    rows = layer.query("sessions", "session__landing_page", order_by="-sessions", limit=3).collect()
    assert len(rows) == 3 and [r.sessions for r in rows] == sorted((r.sessions for r in rows), reverse=True)
    with pytest.raises(ValueError):
        layer.query("sessions", "session__landing_page", limit=0)
    groups = "metric_time,session__landing_page,session__country,session__browser,session__operating_system"
    everything = layer.query("sessions", groups).count()
    assert layer.query("sessions", groups, limit=100_000).count() == everything > 300
    with pytest.raises(ValueError):
        layer.query("sessions", order_by="nonsense")


def test_explain_runs_nothing_and_shows_the_plan(spark, layer, marts):
    kept = []
    cold = metric_layer(Marts(spark, marts.raw, W1, keep=lambda name, df: kept.append(name) or df))
    told = cold.explain("activation_rate,revenue", "user__first_device_category")
    assert told["ok"] and "Physical Plan" in told["plan"] and told["governance"]["revenue"]["definition"]
    assert kept == [] and not cold.tables._tables
    assert cold.query("revenue").count() == 1 and kept


def test_refusals_are_data_everywhere(spark, layer):
    for told in (layer.explain("made_up"), catalogue.describe_metric(spark, layer, "made_up"), catalogue.list_dimensions(spark, layer, "made_up")):
        assert told["refused"] is True and "made_up" in told["error"]
    assert layer.explain("activation_rate", "event__event_name")["governance"]
    assert layer.explain("sessions", where="session__country =")["ok"] is False


def test_nested_ratios_are_refused_when_defined():
    ratio = Metric("twice", "t", "user", "t", "t", "-", "-", "-", numerator="activation_rate", denominator="sessions")
    with pytest.raises(ValueError, match="twice"):
        Definitions(MODELS, (*METRICS, ratio))


def test_distinct_counts_over_several_columns(spark):
    star = star_layer(spark, SF)
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    want = orders.agg(F.count_distinct("o_custkey"), F.count_distinct("o_orderstatus"), F.count("*")).first()
    assert tuple(star.query("buyers,order_statuses,orders").first()) == tuple(want)
    assert star.answer("buyers,order_statuses", "session__priority")["ok"]
    assert "Expand" not in star.query("buyers,order_statuses", "session__priority")._jdf.queryExecution().toString()


def test_trap_is_reproduced_and_warned_about(layer):
    grouped = layer.query("feature_adoption_rate", "event__feature_name").where("event__feature_name = 'site_search'").first()
    true = layer.query("feature_adoption_rate_site_search").first()
    assert grouped.feature_adoption_rate > true.feature_adoption_rate_site_search
    assert layer.warnings("feature_adoption_rate", "event__feature_name")
    assert not layer.warnings("feature_adoption_rate", "event__device_category")


def test_group_without_qualifying_rows_is_null_not_zero(layer):
    rows = layer.query("feature_adoption_rate_site_search,adoption_base_users", "event__feature_name").collect()
    other = [r for r in rows if r["event__feature_name"] == "promotions"]
    assert other and other[0].feature_adoption_rate_site_search is None and other[0].adoption_base_users is not None


def test_filtered_metric_keeps_only_its_groups(layer):
    rows = layer.query("sessions_reaching_purchase", "funnel_step__step_name").collect()
    assert [r["funnel_step__step_name"] for r in rows] == ["purchase"]


def test_additive_by_day_but_distinct_is_not(layer, marts):
    total = layer.query("new_users").first().new_users
    assert total == layer.query("new_users", "metric_time").agg(F.sum("new_users")).first()[0]
    assert layer.query("transactions").first()[0] == layer.query("transactions", "metric_time").agg(F.sum("transactions")).first()[0]
    purchases = marts["stg_events"].where("event_name = 'purchase'")
    overall = purchases.agg(F.count_distinct("transaction_id")).first()[0]
    by_day = purchases.groupBy("event_date").agg(F.count_distinct("transaction_id").alias("n")).agg(F.sum("n")).first()[0]
    assert overall < by_day


def test_identities(marts):
    gap = reports.funnel_gap(marts).collect()
    assert all(r.strict <= r.permissive for r in gap)
    funnel = marts["fct_funnel"].agg(F.sum("session_revenue_usd")).first()[0]
    sessions = marts["fct_sessions"].agg(F.sum("session_revenue_usd")).first()[0]
    assert funnel == pytest.approx(5 * sessions)
    day_zero = marts["int_sessions"].groupBy("user_pseudo_id").agg(F.bool_or(F.col("days_since_first_session") == 0).alias("d0"))
    assert day_zero.where("not d0").count() == 0
    event_revenue = marts["fct_events"].agg(F.sum("purchase_revenue_usd")).first()[0]
    assert event_revenue > sessions  # purchases without a session


def test_open_window_gives_null(spark):
    row = metric_layer(marts_of(spark, SF, W2)).query("d30_retention_rate,d30_eligible_users").first()
    assert row.d30_retention_rate is None and row.d30_eligible_users == 0


def test_calendar_fill(layer):
    rows = layer.query("sessions,d7_retention_rate", "metric_time", "2023-12-30", "2024-01-04", order_by="metric_time", fill_spine=True).collect()
    assert len(rows) == 6 and rows[0].sessions == 0 and rows[0].d7_retention_rate is None and rows[-1].sessions > 0
    with pytest.raises(ValueError):
        layer.query("sessions", "session__country", fill_spine=True)


def test_filter_text():
    assert plain_filter("{{ Dimension('user__x') }} = 'a__b'") == "user__x = 'a__b'"
    assert plain_filter("{{ TimeDimension('metric_time', 'week') }} > '2024-01-01'") == "metric_time__week > '2024-01-01'"
    assert names_in("user__x = 'a__b' and metric_time > '2024-01-01'") == {"user__x", "metric_time"}
    assert names_in("""user__x = "a__b" and user__y in ("it's c__d", "e\\"f__g") and user__z = 'h\\'i__j'""") == {"user__x", "user__y", "user__z"}


def test_double_quoted_literals(layer):
    assert layer.query("sessions", where='session__device_category = "mobile__x"').first()[0] == 0
    a, b = (layer.query("sessions", where=f"session__device_category = {q}mobile{q}").first()[0] for q in "'\"")
    assert a == b > 0


def test_time_filter_by_grain(layer):
    a = layer.query("sessions", where="{{ TimeDimension('metric_time', 'week') }} = date'2024-01-08'").first()[0]
    b = layer.query("sessions", start_time="2024-01-08", end_time="2024-01-14").first()[0]
    assert a == b > 0


def test_listing(spark, layer):
    names = [r.name for r in catalogue.list_metrics(spark, PRODUCT_ANALYTICS, "RETENTION").collect()]
    assert names == sorted(names) and "d7_retention_rate" in names
    assert catalogue.list_metrics(spark, PRODUCT_ANALYTICS).count() == 42
    row = catalogue.describe_metric(spark, layer, "feature_adoption_rate_promotions").first()
    assert row.numerator == "feature_adopters_7d" and row.built_in_filter == "event__feature_name = 'promotions'"
    assert row.semantic_models == ["events"]
    models = {r.name: r for r in catalogue.list_semantic_models(spark, PRODUCT_ANALYTICS).collect()}
    assert all(d.description for m in models.values() for d in m.dimensions)
    assert len(models) == 4 and len(models["users"].dimensions) == 15 and models["events"].primary_entity == "event"
    assert catalogue.list_dimensions(spark, layer, "d7_retention_rate").count() == 16
    lineage = catalogue.metric_lineage(spark, PRODUCT_ANALYTICS)
    assert {r.measure for r in lineage.where("metric = 'average_order_value'").collect()} == {"session_revenue", "transactions"}


MOBILE = "user__first_device_category = 'mobile'"


def _mobile(name, measure):
    return Metric(name, name, "user", name, name, "-", "-", "-", measure=measure, where=MOBILE)


def test_metric_filter_on_another_models_dimension(marts):
    """Such filters are applied to the combined rows, after the join."""
    custom = (_mobile("mobile_sessions", "sessions"), _mobile("mobile_revenue", "session_revenue"),
              _mobile("mobile_event_users", "event_users"), _mobile("mobile_base", "adoption_base_users"))
    layer = MetricLayer(Definitions(MODELS, METRICS + custom), marts)
    names = "mobile_sessions,mobile_revenue,mobile_event_users,mobile_base"
    plain = layer.query_measures("sessions,session_revenue,event_users,adoption_base_users", where=MOBILE).first()
    assert tuple(layer.query(names).first()) == pytest.approx(tuple(plain))
    for group in ("user__first_country", "user__first_device_category"):
        got = sorted(layer.query(names, group).collect(), key=str)
        want = sorted(layer.query_measures("sessions,session_revenue,event_users,adoption_base_users", group, where=MOBILE).collect(), key=str)
        assert [tuple(r)[:2] for r in got] == [tuple(r)[:2] for r in want] and len(got) > 0
        assert [r[3:] for r in got] == [r[3:] for r in want]
    both = layer.query("mobile_sessions,sessions", "user__first_device_category").collect()
    counts = {r[0]: r.mobile_sessions for r in both}
    assert counts["desktop"] is None and counts["mobile"] > 0


def test_report_views(spark, marts):
    reports.register_report_views(marts)
    a = spark.table("d7_users").agg(F.count("*"), F.count_if("is_retained_d7")).first()
    b = metric_layer(marts).query("d7_eligible_users,d7_retained_users").first()
    assert tuple(a) == tuple(b)


def test_layer_is_data_driven(spark):
    star = star_layer(spark, SF)
    assert "metric_time" not in star.dimensions_of("customers")
    assert "user__segment" in star.dimensions_of("orders") and "event__return_flag" not in star.dimensions_of("orders")
    total = star.query("customers").first()[0]
    assert total == star.query("customers", "user__segment").agg(F.sum("customers")).first()[0]
    with pytest.raises(Refused):
        star.query("customers", "metric_time")
