"""Sessions.

The session rollup never places raw events in one task per session or user:
events are first combined per (user, session, block) and only those few rows
meet again per session.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.config import EngineConfig
from footfall.functions.columns import composite_key, days_between, utc_day, whole_seconds_between
from footfall.operators.gaps import block_of, opens_after_gap
from footfall.sources.schema import PUBLIC_COLUMNS

SESSION = ["user_pseudo_id", "ga_session_id"]

_ATTRIBUTES = [
    "device_category", "operating_system", "browser", "platform", "country", "region", "city",
    "first_touch_source", "first_touch_medium", "first_touch_campaign",
]


#: Columns of a session that its others give.
SESSION_KEYS = ("session_key",)


def with_session_key(sessions: DataFrame) -> DataFrame:
    """The key of sessions, from the columns it is made of."""
    return sessions.withColumn("session_key", composite_key(F.col("user_pseudo_id"), F.col("ga_session_id")))


def _named(step: str) -> Column:
    return F.col("event_name") == step


def _per_block(events: DataFrame, cfg: EngineConfig) -> DataFrame:
    steps = []
    for i, step in enumerate(cfg.funnel_steps, 1):
        steps += [
            F.min(F.when(_named(step), F.col("event_at"))).alias(f"step{i}_at"),
            F.count_if(_named(step)).alias(f"step{i}_n"),
        ]
    revenue = F.when(_named("purchase"), F.coalesce("purchase_revenue_usd", F.lit(0.0))).otherwise(0.0)
    return events.groupBy(*SESSION, block_of(F.col("event_at"), cfg).alias("block")).agg(
        F.min("event_at").alias("first_at"),
        F.max("event_at").alias("last_at"),
        F.max("ga_session_number").alias("ga_session_number"),
        F.min("user_first_touch_at").alias("first_touch_at"),
        F.count("*").alias("n_events"),
        F.count_if(_named("page_view")).alias("page_views"),
        F.sum(F.coalesce("engagement_time_msec", F.lit(0))).alias("msec"),
        F.bool_or("is_session_engaged_event").alias("engaged"),
        F.sum(revenue).alias("revenue"),
        *steps,
    )


def _first_values(events: DataFrame) -> DataFrame:
    """Attributes of the first event, and the first page there is.

    Text cannot be aggregated in a hash table's fixed slots, so these go through
    one sort-based pass and leave the numbers above to a hash-based one.
    """
    return events.groupBy(*SESSION).agg(
        # the key makes ties repeatable; its 16 bytes order as their 32 digits do
        F.min(F.struct("event_at", "event_name", F.unhex("event_key").alias("event_key"), *_ATTRIBUTES)).alias("first_event"),
        F.min(F.when(F.col("page_location").isNotNull(), F.struct("event_at", "page_location"))).alias("landing"),
    )


def _distincts(events: DataFrame) -> DataFrame:
    """A04 and distinct pages; a narrow pass of its own. Only rows with a page and purchases with a transaction
    are read, and both kinds are counted from one list of distinct values."""
    bought = _named("purchase") & F.col("transaction_id").isNotNull()
    values = (
        events.where(F.col("page_location").isNotNull()).select(*SESSION, F.lit(True).alias("is_page"), F.col("page_location").alias("value"))
    ).unionAll(events.where(bought).select(*SESSION, F.lit(False), "transaction_id"))
    return values.distinct().groupBy(*SESSION).agg(
        F.count_if("is_page").alias("distinct_pages_viewed"),
        F.count_if(~F.col("is_page")).alias("transactions"),
    )


def session_core(events: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row per client session id; events without one are left out.

    ``step_reach`` holds, per funnel step in order, when it was first fired and how often.
    """
    events = events.where(F.col("ga_session_id").isNotNull())
    blocks = _per_block(events, cfg).withColumn("after_gap", opens_after_gap(SESSION, cfg))
    n = len(cfg.funnel_steps)
    merged = blocks.groupBy(*SESSION).agg(
        F.max("ga_session_number").alias("ga_session_number"),
        F.min("first_at").alias("session_started_at"),
        F.max("last_at").alias("session_ended_at"),
        F.min("first_touch_at").alias("session_first_touch_at"),
        F.sum("n_events").alias("events_in_session"),
        F.sum("page_views").alias("page_views"),
        F.sum("msec").alias("msec"),
        F.bool_or("engaged").alias("engaged"),
        F.count_if("after_gap").alias("inactivity_gaps"),
        F.sum("revenue").alias("session_revenue_usd"),
        *[F.min(f"step{i}_at").alias(f"step{i}_at") for i in range(1, n + 1)],
        *[F.sum(f"step{i}_n").alias(f"step{i}_n") for i in range(1, n + 1)],
    )
    # both sides of each join have a session once, on the partitioning they already have
    joined = merged.join(_first_values(events), SESSION, "left").join(_distincts(events), SESSION, "left")

    def count_of(step: str) -> Column:
        return F.col(f"step{cfg.funnel_steps.index(step) + 1}_n")

    duration = whole_seconds_between(F.col("session_started_at"), F.col("session_ended_at"))
    reach = F.array(
        *[
            F.struct(F.col(f"step{i}_at").alias("first_reached_at"), F.col(f"step{i}_n").alias("step_event_count"))
            for i in range(1, n + 1)
        ]
    )
    return joined.select(
        composite_key(F.col("user_pseudo_id"), F.col("ga_session_id")).alias("session_key"),
        *SESSION,
        "ga_session_number",
        "session_started_at",
        "session_ended_at",
        utc_day(F.col("session_started_at")).alias("session_date"),
        duration.alias("session_duration_seconds"),
        "events_in_session",
        "page_views",
        F.coalesce("distinct_pages_viewed", F.lit(0)).alias("distinct_pages_viewed"),
        (F.col("msec") / F.lit(1000.0)).alias("engagement_time_seconds"),
        F.col("landing.page_location").alias("landing_page"),
        F.coalesce("engaged", F.lit(False)).alias("is_engaged_session"),
        # The rule recomputed from the rows, next to the client's own flag
        (
            (duration >= cfg.engaged_min_seconds)
            | (F.col("page_views") >= cfg.engaged_min_page_views)
            | (count_of("purchase") > 0)
        ).alias("is_engaged_session_derived"),
        "inactivity_gaps",
        (F.col("inactivity_gaps") > 0).alias("is_split_by_inactivity_rule"),
        *[(count_of(s) > 0).alias(f"has_{s}") for s in ("view_item", "add_to_cart", "begin_checkout", "purchase")],
        count_of("purchase").alias("purchase_events"),
        F.coalesce("transactions", F.lit(0)).alias("transactions"),
        "session_revenue_usd",
        *[F.col(f"first_event.{c}").alias(c) for c in _ATTRIBUTES],
        "session_first_touch_at",
        reach.alias("step_reach"),
    )


def enrich_sessions(core: DataFrame, users: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Sessions with day zero and acquisition of their user.

    One join serves both session tables. Users are unique on their side, so a
    user with very many sessions skews only the session side, which AQE splits.
    """
    of_user = users.select(
        "user_pseudo_id",
        F.col("first_seen_at").alias("user_first_seen_at"),
        F.col("first_seen_date").alias("user_first_seen_date"),
        F.col("first_touch_at").alias("user_first_touch_at"),
        F.col("is_left_censored").alias("user_is_left_censored"),
        "is_cohort_eligible", "acquisition_source", "acquisition_medium", "acquisition_campaign",
        "first_device_category", "first_country",
    )
    return core.join(of_user, "user_pseudo_id", "left").withColumns(
        {
            "days_since_first_session": days_between(F.col("user_first_seen_date"), F.col("session_date")),
            "is_first_session": F.col("session_started_at") == F.col("user_first_seen_at"),
            "is_left_censored": F.coalesce("user_is_left_censored", F.lit(False)),
        }
    )


def int_sessions(enriched: DataFrame) -> DataFrame:
    return enriched.select(*PUBLIC_COLUMNS["int_sessions"])


def with_filled_flags(enriched: DataFrame) -> DataFrame:
    flags = ["is_first_session", "is_cohort_eligible", "user_is_left_censored"]
    return enriched.withColumns({c: F.coalesce(c, F.lit(False)) for c in flags})


def fct_sessions(enriched: DataFrame) -> DataFrame:
    """C14: the session mart; flags of a session without a known user are false."""
    return with_filled_flags(enriched).select(*PUBLIC_COLUMNS["fct_sessions"])
