"""The standing reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.config import EngineConfig
from footfall.functions.columns import days_between, safe_ratio, utc_day
from footfall.plans.layer import metric_layer
from footfall.plans.marts import Marts

# Funnel metrics in step order.
FUNNEL_METRICS = (
    "sessions_starting_funnel", "sessions_reaching_view_item", "sessions_reaching_add_to_cart",
    "sessions_reaching_begin_checkout", "sessions_reaching_purchase",
)


def kpi_row(marts: Marts) -> DataFrame:
    """R01."""
    return metric_layer(marts).query("activation_rate,d7_retention_rate,session_depth,feature_adoption_rate")


def weekly_cohorts(marts: Marts) -> DataFrame:
    """By week of arrival; a week whose users are all still open is NULL."""
    return metric_layer(marts).query(
        "activation_rate,d1_retention_rate,d7_retention_rate",
        group_by="metric_time__week", order_by="metric_time__week",
    )


def strict_funnel(marts: Marts) -> DataFrame:
    """Sessions per step in sequence, and the share of the step before."""
    steps = (
        metric_layer(marts)
        .query_measures("funnel_sessions_in_sequence", "funnel_step__step_position,funnel_step__step_name")
        .select(
            F.col("funnel_step__step_position").cast("bigint").alias("step_number"),
            F.col("funnel_step__step_name").alias("step_name"),
            F.col("funnel_sessions_in_sequence").alias("sessions"),
        )
    )
    # one row per funnel step at this point
    before = F.lag("sessions").over(Window.partitionBy(F.lit(1)).orderBy("step_number"))
    return steps.withColumn("share_of_previous", safe_ratio(F.col("sessions"), before))


def feature_adoption(marts: Marts) -> DataFrame:
    """R04."""
    return metric_layer(marts).query(
        "feature_adoption_rate_site_search,feature_adoption_rate_product_list,"
        "feature_adoption_rate_promotions,feature_adoption_rate_outbound_click"
    )


def mobile_retention(marts: Marts) -> DataFrame:
    """D7 retention of users who arrived on mobile, by month of arrival."""
    return metric_layer(marts).query(
        "d7_retention_rate,d7_eligible_users", group_by="metric_time__month",
        where="{{ Dimension('user__first_device_category') }} = 'mobile'", order_by="metric_time__month",
    )


def event_inventory(marts: Marts) -> DataFrame:
    """Events by name and their share of all."""
    counts = marts["stg_events"].groupBy("event_name").agg(F.count("*").alias("events"))
    total = counts.agg(F.sum("events")).scalar()
    return counts.select("event_name", "events", safe_ratio(F.col("events"), total).alias("share"))


def transaction_counts(marts: Marts) -> DataFrame:
    """Purchase events, session-scoped and global distinct transactions."""
    per_session = marts["int_sessions"].agg(
        F.sum("purchase_events").alias("session_purchase_events"),
        F.sum("transactions").alias("session_scoped_transactions"),
    )
    overall = (
        marts["stg_events"]
        .where(F.col("event_name") == "purchase")
        .agg(
            F.count("*").alias("purchase_events"),
            F.count_distinct("transaction_id").alias("global_transactions"),
        )
    )
    both = per_session.unionByName(overall, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def funnel_gap(marts: Marts) -> DataFrame:
    """C17: permissive against strict, and by how much the first is larger."""
    permissive, strict = F.col("funnel_sessions_reached"), F.col("funnel_sessions_in_sequence")
    return (
        metric_layer(marts)
        .query_measures("funnel_sessions_reached,funnel_sessions_in_sequence", "funnel_step__step_name")
        .select(
            F.col("funnel_step__step_name").alias("step_name"),
            permissive.alias("permissive"), strict.alias("strict"),
            safe_ratio(permissive - strict, strict).alias("gap"),
        )
    )


def _finding(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("finding"), value.cast("double").alias("value"))


def definition_gaps(marts: Marts) -> DataFrame:
    """How far apart the competing definitions are, one finding per row."""
    one = F.lit(1)

    def share(flag: str) -> Column:
        return safe_ratio(F.count_if(flag), F.count(one))

    sessions = marts["int_sessions"].agg(
        F.array(
            _finding("engaged_share_client", share("is_engaged_session")),
            _finding("engaged_share_derived", share("is_engaged_session_derived")),
            _finding("sessions_split_by_gap", F.count_if("is_split_by_inactivity_rule")),
            _finding("split_share", share("is_split_by_inactivity_rule")),
            _finding("session_scoped_transactions", F.sum("transactions")),
        ).alias("f")
    )
    users = marts["dim_users"].agg(
        F.array(
            _finding("censored_users", F.count_if("is_left_censored")),
            _finding("censored_share", share("is_left_censored")),
        ).alias("f")
    )
    purchases = marts["stg_events"].where(F.col("event_name") == "purchase").agg(
        F.array(
            _finding("purchase_events", F.count(one)),
            _finding("global_transactions", F.count_distinct("transaction_id")),
        ).alias("f")
    )
    entry = marts["fct_funnel"].where("step_number = 1").agg(
        F.array(_finding("sessions_without_entry_step", F.count_if(~F.col("is_reached")))).alias("f")
    )
    steps = marts["fct_funnel"].groupBy("step_name").agg(
        F.array(
            F.struct(F.concat(F.lit("permissive_"), "step_name").alias("finding"),
                     F.count_if("is_reached").cast("double").alias("value")),
            F.struct(F.concat(F.lit("strict_"), "step_name").alias("finding"),
                     F.count_if("is_reached_in_sequence").cast("double").alias("value")),
        ).alias("f")
    )
    parts = [df.select(F.inline("f")) for df in (sessions, users, purchases, entry, steps.select("f"))]
    return reduce(DataFrame.unionByName, parts)


def window_sensitivity(marts: Marts, cfg: EngineConfig, windows: tuple[int, ...] = (7, 30)) -> DataFrame:
    """Activation under several windows, from one pass over the users."""
    new = ~F.col("is_left_censored")
    observed = days_between(F.col("first_seen_date"), F.lit(cfg.window_end))
    to_purchase = days_between(F.col("first_seen_date"), utc_day(F.col("first_purchase_at")))
    per_window = marts["dim_users"].agg(
        *[F.count_if(new & (observed >= n)).alias(f"eligible_{n}") for n in windows],
        *[
            F.count_if(new & (observed >= n) & to_purchase.between(0, n)).alias(f"activated_{n}")
            for n in windows
        ],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(n).cast("bigint").alias("window_days"),
                F.col(f"eligible_{n}").alias("eligible_users"),
                F.col(f"activated_{n}").alias("activated_users"),
                safe_ratio(F.col(f"activated_{n}"), F.col(f"eligible_{n}")).alias("activation_rate"),
            )
            for n in windows
        ]
    )
    return per_window.select(F.inline(rows))


# View name -> table and the eligibility filter built into it.
REPORT_VIEWS = {
    "activation_users": ("dim_users", "is_cohort_eligible and has_full_activation_window"),
    "d7_users": ("dim_users", "is_cohort_eligible and has_full_d7_window"),
    "d30_users": ("dim_users", "is_cohort_eligible and has_full_d30_window"),
    "strict_funnel_steps": ("fct_funnel", "is_reached_in_sequence"),
    "early_feature_events": ("fct_events", "is_user_initiated_feature and days_since_first_session <= 7"),
}


def report_views(marts: Marts) -> dict[str, DataFrame]:
    """Tables a dashboard can read without knowing the eligibility rules."""
    return {name: marts[table].where(rule) for name, (table, rule) in REPORT_VIEWS.items()}


def register_report_views(marts: Marts) -> None:
    for name, df in report_views(marts).items():
        df.createOrReplaceTempView(name)
