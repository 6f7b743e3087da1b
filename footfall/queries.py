"""Every query under the name it is registered with.

session and the directory of the given tables.
Tables that several queries need (staged events, sessions, users, ...) are
derived once per application, see ``shared_marts``. Queries whose feature is
the observation window (cohorts, censoring, eligibility and all that builds on
them) read the days of a window, which ``queries`` takes as an argument; the
others read every event.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.config import EngineConfig
from footfall.functions.columns import param_float
from footfall.operators import event_facts, funnel, gaps, sessions, staging, users
from footfall.plans import reports
from footfall.plans.checks import CHECKS, NON_EMPTY, row_counts, run_checks
from footfall.plans.incremental import IncrementalMarts
from footfall.plans.layer import metric_layer
from footfall.plans.marts import Marts, TableFolder, shared_folder, shared_marts
from footfall.plans.models import MODELS
from footfall.plans.star_schema import star_layer
from footfall.sources.driver_tables import W1, W2, raw_events
from footfall.sources.readers import time_spine
from footfall.sources.writers import delete_at_end
from footfall.streaming.sessions import sessions_of_slices

Query = Callable[[SparkSession, str], DataFrame]

#: Every row of the event export, also those without a day.
ALL = replace(W1, window_start=date(1000, 1, 1), window_end=date(9999, 12, 31), every_row=True)
HALF_HOUR = replace(ALL, session_gap_minutes=30)

# Dimension each measure of a model is shown by.
SHOWN_BY = {
    "users": "user__first_device_category", "sessions": "session__device_category",
    "events": "event__event_name", "funnel": "funnel_step__step_name",
}
MEASURE_IDS = {m.name: f"ms{i:02d}_{m.name}" for i, m in enumerate((x for s in MODELS for x in s.measures), 1)}

# Metric names in the order of their IDs MT01..MT42.
METRIC_ORDER = (
    "new_users", "sessions", "revenue", "transactions", "activation_eligible_users", "activated_users",
    "activation_rate", "avg_days_to_first_purchase", "d7_eligible_users", "d7_retained_users",
    "d7_retention_rate", "d1_eligible_users", "d1_retained_users", "d1_retention_rate",
    "d30_eligible_users", "d30_retained_users", "d30_retention_rate", "session_depth", "session_events",
    "engagement_rate", "engagement_rate_derived", "sessionisation_disagreement_rate", "engaged_sessions",
    "engaged_sessions_derived", "sessions_split_by_gap", "session_revenue", "revenue_per_session",
    "average_order_value", "sessions_reaching_view_item", "sessions_reaching_add_to_cart",
    "sessions_reaching_begin_checkout", "sessions_reaching_purchase", "sessions_starting_funnel",
    "purchase_conversion_rate", "checkout_completion_rate", "feature_adopters_7d", "adoption_base_users",
    "feature_adoption_rate", "feature_adoption_rate_site_search", "feature_adoption_rate_promotions",
    "feature_adoption_rate_product_list", "feature_adoption_rate_outbound_click",
)

# name -> arguments of a metric query; the last flag picks the second window
METRIC_QUERIES: dict[str, tuple[dict, EngineConfig]] = {
    "m_all_metrics_one_row": ({"metrics": ",".join(METRIC_ORDER)}, W1),
    "m_group_by_day": ({"metrics": "sessions,revenue,new_users", "group_by": "metric_time"}, W1),
    "m_group_by_week": ({"metrics": "d7_retention_rate,sessions,feature_adoption_rate", "group_by": "metric_time__week"}, W1),
    "m_group_by_month": ({"metrics": "activation_rate,session_depth", "group_by": "metric_time__month"}, W1),
    "m_group_by_quarter": ({"metrics": "sessions,purchase_conversion_rate", "group_by": "metric_time__quarter"}, W1),
    "m_group_by_year": ({"metrics": "transactions,average_order_value", "group_by": "metric_time__year"}, W1),
    "m_join_user_dim": ({"metrics": "sessions,revenue_per_session", "group_by": "user__first_country"}, W1),
    "m_join_session_dim": ({"metrics": "revenue", "group_by": "session__landing_page"}, W1),
    "m_join_two_models": ({"metrics": "revenue", "group_by": "session__device_category,user__acquisition_medium"}, W1),
    "m_join_from_funnel": ({"metrics": "sessions_reaching_view_item,purchase_conversion_rate", "group_by": "user__acquisition_source"}, W1),
    "m_multi_model": ({"metrics": "new_users,sessions,revenue,sessions_starting_funnel", "group_by": "user__first_device_category"}, W1),
    "m_own_dims": ({"metrics": "engagement_rate,engagement_rate_derived", "group_by": "session__browser,session__is_first_session"}, W1),
    "m_time_dim_grain": ({"metrics": "sessions,transactions", "group_by": "user__first_seen_date__week"}, W1),
    "m_ratio_trap": ({"metrics": "feature_adoption_rate,feature_adopters_7d", "group_by": "event__feature_name"}, W1),
    "m_numerator_filter": ({"metrics": "feature_adoption_rate_site_search,feature_adoption_rate_promotions,adoption_base_users", "group_by": "event__device_category"}, W1),
    "m_filtered_only": ({"metrics": "sessions_reaching_purchase", "group_by": "funnel_step__step_name,funnel_step__device_category"}, W1),
    "m_where": ({"metrics": "sessions,session_depth", "group_by": "session__country", "where": "session__is_engaged_session and session__device_category <> 'mobile'"}, W1),
    "m_where_joined": ({"metrics": "d7_retention_rate,revenue", "where": "{{ Dimension('user__first_device_category') }} = 'mobile'"}, W1),
    "m_where_null_session": ({"metrics": "revenue", "group_by": "event__country", "where": "session__device_category is null"}, W1),
    "m_time_bounds": ({"metrics": "sessions,revenue", "group_by": "metric_time", "start_time": "2024-01-08", "end_time": "2024-01-14"}, W1),
    "m_cohort_clock": ({"metrics": "feature_adopters_7d,adoption_base_users,revenue", "group_by": "metric_time"}, W1),
    "m_open_window_is_null": ({"metrics": "d30_retention_rate,d30_eligible_users,d7_retention_rate", "group_by": "metric_time__week"}, W2),
    "m_open_windows_by_medium": ({"metrics": "activation_rate,d1_retention_rate,d7_retention_rate,feature_adoption_rate", "group_by": "user__acquisition_medium"}, W2),
    "o02_top_landing_pages": ({"metrics": "sessions", "group_by": "session__landing_page", "order_by": "-sessions,session__landing_page", "limit": 5}, W1),
    "o02_large_limit": ({"metrics": "sessions", "group_by": "metric_time,session__landing_page,session__country", "order_by": "metric_time,session__landing_page,session__country", "limit": 2000}, W1),
}

STAR_QUERIES: dict[str, dict] = {
    "m_star_segment": {"metrics": "customers,orders,order_value,average_order_value", "group_by": "user__segment"},
    "m_star_month": {"metrics": "orders,buyers,large_buyer_share,net_revenue,lines_per_order", "group_by": "metric_time__month"},
    "m_two_distincts": {"metrics": "buyers,large_order_buyers,order_statuses,orders", "group_by": "metric_time__month"},
    "m_star_lines": {"metrics": "lines,net_revenue,avg_quantity,shipped_orders", "group_by": "event__return_flag,event__line_status"},
    "m_star_returned": {"metrics": "returned_share,net_revenue", "group_by": "session__priority"},
}


def comparable(df: DataFrame, digits: int = 7) -> DataFrame:
    """Types that compare across engines: zone-free instants, BIGINT, rounded doubles.

    Sums of doubles depend on their order in the last bits, so they are rounded.
    Few digits would put ratios of small counts (x.xx / 8) on a rounding edge,
    where those last bits decide; many digits would show them in large sums.
    """

    def plain(name: str, kind: str) -> Column:
        if kind == "timestamp":
            return F.col(name).cast("timestamp_ntz").alias(name)
        if kind == "double" or kind.startswith("decimal"):
            return F.round(F.col(name).cast("double"), digits).alias(name)
        if kind == "int":
            return F.col(name).cast("bigint").alias(name)
        return F.col(name)

    return df.select(*[plain(*c) for c in df.dtypes])


def marts_of(spark: SparkSession, sf_dir: str, cfg: EngineConfig) -> Marts:
    return shared_marts(spark, f"{sf_dir}/events.parquet", partial(raw_events, spark, sf_dir), cfg)


def on_marts(build: Callable[[Marts], DataFrame], cfg: EngineConfig = W1) -> Query:
    return lambda spark, sf_dir: comparable(build(marts_of(spark, sf_dir, cfg)))


def _columns(table: str, *names: str) -> Callable[[Marts], DataFrame]:
    return lambda m: m[table].select(*names)


def _sessions(m: Marts) -> DataFrame:
    core = sessions.session_core(m["stg_events"], m.cfg)
    return sessions.int_sessions(sessions.enrich_sessions(core, m["dim_users"], m.cfg))


def _users(m: Marts) -> DataFrame:
    return users.dim_users(m["session_core"], m["stg_events"], m["feature_catalogue"], m.cfg)


def _event_facts(m: Marts) -> DataFrame:
    return event_facts.fct_events(m["stg_events"], m["int_sessions"], m["feature_catalogue"], m.cfg)


def _score_by_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_events(spark, sf_dir)
    return comparable(
        raw.groupBy("event_name").agg(F.sum(param_float("score")).alias("score"), F.count("*").alias("n_events"))
    )


def _own_folder(spark: SparkSession) -> str:
    """A new folder that all executors see, deleted when the application ends."""
    home = spark.conf.get("spark.sql.warehouse.dir")
    return shared_folder(spark) or delete_at_end(spark, f"{home}/footfall-{uuid.uuid4().hex}")


def _streamed(m: Marts) -> DataFrame:
    """Sessions by the inactivity rule from a stream over all events."""
    return sessions_of_slices(m.spark, m["stg_events"], _own_folder(m.spark), HALF_HOUR)


def _by_loads(m: Marts) -> DataFrame:
    """Users after two loads, the days up to the middle of the window and the rest."""
    days = [m.cfg.window_start + timedelta(n) for n in range((m.cfg.window_end - m.cfg.window_start).days + 1)]
    store, half = IncrementalMarts(m.spark, _own_folder(m.spark), m.cfg), len(days) // 2
    for some in (days[:half], days[half:]):
        store.load(m.raw.where(F.col("event_date").between(f"{some[0]:%Y%m%d}", f"{some[-1]:%Y%m%d}")), some)
    return store.users(m.raw)


def _partitioned(m: Marts) -> DataFrame:
    """Staged events written by day, a range of days read back."""
    staged = TableFolder(m.spark, _own_folder(m.spark), m.cfg).keep("stg_events", staging.stage_events(m.raw))
    days = staged.where(F.col("event_date").between("2024-01-08", "2024-01-14"))
    return days.groupBy("event_date", "event_name").agg(F.count("*").alias("n_events"))


def _checks_of(kind: str, m: Marts) -> DataFrame:
    checks = [c for c in CHECKS if c.kind == kind]
    m["sessions_enriched"]  # what the other tables have in common
    # rules of single rows read a table once, and few of its columns; events in context are not written for that
    tables = m if kind in ("unique", "relationships") else m.planned()
    return run_checks(tables, checks).where(F.col("kind") == kind)


def _metric(name: str, cfg: EngineConfig, **arguments: str) -> Query:
    return on_marts(lambda m: metric_layer(m).query(**arguments), cfg)


def queries(first: EngineConfig = W1, second: EngineConfig = W2) -> dict[str, Query]:
    """All queries; those of a window read the days of ``first`` (which closes every cohort) or ``second``."""
    windows = {W1: first, W2: second, ALL: ALL}

    def on(build: Callable[[Marts], DataFrame], cfg: EngineConfig = W1) -> Query:
        return on_marts(build, windows[cfg])

    out: dict[str, Query] = {
        # sources and staging
        "s01_window_scan": on(lambda m: m["stg_events"].groupBy("event_date").agg(F.count("*").alias("n_events")), W2),
        "s04_partitioned_write": on(_partitioned),
        "p01_staging": on(lambda m: staging.stage_events(m.raw), ALL),
        "p04_param_float": _score_by_event,
        # sessions
        "c01_sessions": on(_sessions),
        "c01_sessions_w2": on(_sessions, W2),
        "c02_gap_disagreement": on(lambda m: sessions.session_core(m["stg_events"], m.cfg).select(
            "session_key", "inactivity_gaps", "is_split_by_inactivity_rule"), ALL),
        "c02_gap_half_hour": on(lambda m: sessions.session_core(m["stg_events"], HALF_HOUR).select(
            "session_key", "inactivity_gaps", "is_split_by_inactivity_rule"), ALL),
        "c03_gap_sessions": on(lambda m: gaps.gap_sessions(m["stg_events"], m.cfg), ALL),
        "c03_gap_sessions_half_hour": on(lambda m: gaps.gap_sessions(m["stg_events"], HALF_HOUR), ALL),
        "c03_gap_session_events": on(lambda m: gaps.assign_gap_sessions(m["stg_events"], HALF_HOUR).select(
            "event_key", "user_pseudo_id", "gap_session_number"), ALL),
        "c04_engagement": on(lambda m: m["int_sessions"].groupBy(
            "is_engaged_session", "is_engaged_session_derived").agg(F.count("*").alias("n_sessions")), ALL),
        "c05_funnel_dense": on(lambda m: funnel.fct_funnel(sessions.with_filled_flags(m["sessions_enriched"]), m.cfg)),
        "c06_cohort_anchor": on(_columns("int_sessions", "session_key", "user_first_seen_at", "user_first_seen_date",
                                               "days_since_first_session", "is_first_session")),
        "c07_left_censoring": on(_columns("dim_users", "user_pseudo_id", "first_touch_at", "is_left_censored")),
        # users
        "c08_retention_flags": on(lambda m: users.session_rollup(m["session_core"], m.cfg).select(
            "user_pseudo_id", "is_retained_d1", "is_retained_d7", "is_retained_d30", "active_days")),
        "c09_eligibility": on(lambda m: m["dim_users"].groupBy("first_seen_date").agg(
            *[F.count_if(c).alias(c) for c in ("has_full_activation_window", "has_full_d1_window",
                                               "has_full_d7_window", "has_full_d30_window", "is_cohort_eligible")]), W2),
        "c10_activation": on(_columns("dim_users", "user_pseudo_id", "first_purchase_at",
                                            "days_to_first_purchase", "is_activated")),
        "c11_acquisition": on(_columns(
            "dim_users", "user_pseudo_id", "acquisition_source", "acquisition_medium", "acquisition_campaign",
            "first_device_category", "first_operating_system", "first_country", "first_landing_page")),
        "c12_feature_adoption": on(lambda m: users.user_behaviour(m["stg_events"], m["feature_catalogue"]).select(
            "user_pseudo_id", "features_adopted")),
        # marts
        "c13_event_enrichment": on(_event_facts),
        "c13_event_enrichment_w2": on(_event_facts, W2),
        "c14_session_mart": on(lambda m: sessions.fct_sessions(
            sessions.enrich_sessions(m["session_core"], m["dim_users"], m.cfg))),
        "c15_user_mart": on(_users),
        "c15_user_mart_w2": on(_users, W2),
        "c16_transaction_counts": on(reports.transaction_counts, ALL),
        "c17_funnel_gap": on(reports.funnel_gap, ALL),
        "a14_row_counts": on(lambda m: row_counts({t: m[t] for t in (
            "stg_events", "int_sessions", "fct_events", "dim_users", "fct_sessions", "fct_funnel")}), ALL),
        "j14_orphan_users": on(lambda m: m["fct_events"].groupBy("user_pseudo_id").agg(
            F.count("*").alias("n_events")).join(m["dim_users"], "user_pseudo_id", "left_anti"), ALL),
        "j15_calendar_fill": on(lambda m: metric_layer(m).query(
            "sessions,revenue,d7_retention_rate", group_by="metric_time", start_time="2023-12-25",
            end_time="2024-02-10", fill_spine=True)),
        "j15_fill_outside_calendar": on(lambda m: metric_layer(m, lambda: time_spine(
            m.spark, date(2023, 12, 25), date(2024, 1, 15))).query("sessions,revenue", group_by="metric_time", fill_spine=True)),
        "j15_fill_null_day": on(lambda m: metric_layer(m).query(
            "feature_adopters_7d,adoption_base_users", group_by="metric_time", fill_spine=True), W2),
        # loads of days, streaming
        "t02_incremental_days": on(_by_loads),
        "t01_stream_sessions": on(_streamed, ALL),
        # reports
        "r01_kpi": on(reports.kpi_row),
        "r02_weekly_cohorts": on(reports.weekly_cohorts, W2),
        "r03_strict_funnel": on(reports.strict_funnel),
        "r04_feature_adoption": on(reports.feature_adoption),
        "r05_mobile_retention": on(reports.mobile_retention),
        "r06_event_inventory": on(reports.event_inventory, ALL),
        "r07_definition_gaps": on(reports.definition_gaps),
        "r08_window_sensitivity": on(lambda m: reports.window_sensitivity(m, m.cfg)),
    }
    for view in reports.REPORT_VIEWS:
        out[f"r09_{view}"] = on(partial(lambda name, m: reports.report_views(m)[name], view))
    for model in MODELS:
        for measure in model.measures:
            out[MEASURE_IDS[measure.name]] = on(
                partial(lambda name, group, m: metric_layer(m).query_measures(name, group), measure.name, SHOWN_BY[model.name])
            )
    for i, name in enumerate(METRIC_ORDER, 1):
        out[f"mt{i:02d}_{name}"] = _metric(name, first, metrics=name, group_by="metric_time__week")
    for name, (arguments, cfg) in METRIC_QUERIES.items():
        out[name] = _metric(name, windows[cfg], **arguments)
    for name, arguments in STAR_QUERIES.items():
        out[name] = partial(lambda args, spark, sf_dir: comparable(star_layer(spark, sf_dir).query(**args), 4), arguments)
    for n, kind in enumerate(("not_null", "unique", "accepted_values", "relationships", "accepted_range", "expression_is_true"), 1):
        out[f"k{n:02d}_{kind}"] = on(partial(_checks_of, kind), ALL)
    # here, users without a session exist, so that one reference fails
    out["k04_relationships_w2"] = on(partial(_checks_of, "relationships"), W2)
    out["k07_non_empty"] = on(lambda m: run_checks(m, NON_EMPTY), ALL)
    out["k_all_checks"] = on(run_checks, ALL)
    return out
