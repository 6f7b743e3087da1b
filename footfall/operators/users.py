"""Users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.config import EngineConfig
from footfall.functions.columns import days_between, utc_day
from footfall.sources.schema import PUBLIC_COLUMNS

_HAS = ("view_item", "add_to_cart", "begin_checkout", "purchase")


def user_behaviour(events: DataFrame, catalogue: DataFrame) -> DataFrame:
    """First purchase and number of features used.

    Reads all staged events, with or without a session id. Events that are
    neither a purchase nor a deliberate feature use never reach the shuffle.
    """
    is_purchase = F.col("event_name") == "purchase"
    return (
        _chosen_uses(events, catalogue)
        .groupBy("user_pseudo_id")
        .agg(
            F.min(F.when(is_purchase, F.col("event_at"))).alias("first_purchase_at"),
            F.count_distinct("feature_name").alias("features_adopted"),
        )
    )


def _chosen_uses(events: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Purchases, and events that are a deliberate use of a feature."""
    chosen = catalogue.where("is_user_initiated").select("event_name", "feature_name")
    rows = events.select("user_pseudo_id", "event_date", "event_name", "event_at").join(chosen, "event_name", "left")
    return rows.where((F.col("event_name") == "purchase") | F.col("feature_name").isNotNull())


def behaviour_days(events: DataFrame, catalogue: DataFrame) -> DataFrame:
    """What ``user_behaviour`` needs of each day: a row per user, day and feature used."""
    bought_at = F.when(F.col("event_name") == "purchase", F.col("event_at"))
    return _chosen_uses(events, catalogue).groupBy("user_pseudo_id", "feature_name", "event_date").agg(F.min(bought_at).alias("first_purchase_at"))


def behaviour_of_days(days: DataFrame) -> DataFrame:
    """``user_behaviour`` from the rows of ``behaviour_days``."""
    return days.groupBy("user_pseudo_id").agg(
        F.min("first_purchase_at").alias("first_purchase_at"), F.count_distinct("feature_name").alias("features_adopted")
    )


def _per_day(core: DataFrame) -> DataFrame:
    """Sessions combined per user and day, so a user's rows are bounded by the
    number of days in the window before they meet in one task."""
    return core.groupBy("user_pseudo_id", "session_date").agg(
        F.min("session_started_at").alias("first_started"),
        F.max("session_started_at").alias("last_started"),
        F.min("session_first_touch_at").alias("first_touch"),
        F.count("*").alias("n_sessions"),
        F.count_if("is_engaged_session").alias("n_engaged"),
        F.sum("events_in_session").alias("n_events"),
        F.sum("page_views").alias("n_views"),
        F.sum("session_duration_seconds").alias("seconds"),
        F.sum("transactions").alias("n_transactions"),
        F.sum("session_revenue_usd").alias("revenue"),
        *[F.count_if(f"has_{s}").alias(f"n_{s}") for s in _HAS],
    )


_FIRST = (
    "session_started_at", "session_key", "first_touch_source", "first_touch_medium", "first_touch_campaign",
    "device_category", "operating_system", "country", "landing_page",
)


def _first_session(core: DataFrame) -> DataFrame:
    """Attributes of each user's first session. Text needs sort-based
    aggregation, so it is kept apart from the numbers."""
    return core.groupBy("user_pseudo_id").agg(F.min(F.struct(*_FIRST)).alias("first_session"))


def user_days(core: DataFrame) -> DataFrame:
    """What a user's row needs of each day: sums of the day's sessions, and its first session."""
    first = core.groupBy("user_pseudo_id", "session_date").agg(F.min(F.struct(*_FIRST)).alias("first_session"))
    return _per_day(core).join(first, ["user_pseudo_id", "session_date"])


def _returned(first_day: int, last_day: int) -> Column:
    """Day 0 never counts."""
    return F.bool_or(F.col("day").between(first_day, last_day))


def session_rollup(core: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The numbers a user's sessions add up to."""
    return _rollup_of_days(_per_day(core))


def _rollup_of_days(per_day: DataFrame) -> DataFrame:
    by_user = Window.partitionBy("user_pseudo_id")
    days = per_day.withColumn(
        "day", days_between(F.min("session_date").over(by_user), F.col("session_date"))
    )
    return days.groupBy("user_pseudo_id").agg(
        F.min("first_started").alias("first_seen_at"),
        F.min("first_touch").alias("first_touch_at"),
        F.max("last_started").alias("last_seen_at"),
        F.sum("n_sessions").alias("sessions"),
        F.sum("n_engaged").alias("engaged_sessions"),
        F.count("*").alias("active_days"),
        F.sum("n_events").alias("events"),
        F.sum("n_views").alias("page_views"),
        F.sum("seconds").alias("total_session_seconds"),
        F.sum("n_transactions").alias("transactions"),
        F.sum("revenue").alias("lifetime_revenue_usd"),
        *[F.sum(f"n_{s}").alias(f"sessions_with_{s}") for s in _HAS],
        _returned(1, 1).alias("is_retained_d1"),
        _returned(1, 7).alias("is_retained_d7"),
        _returned(1, 30).alias("is_retained_d30"),
    )


def dim_users(core: DataFrame, events: DataFrame, catalogue: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row per user, with the flags that say when the user may count."""
    return _users(session_rollup(core, cfg), _first_session(core), user_behaviour(events, catalogue), cfg)


def users_of_days(days: DataFrame, behaviour: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The same from the rows of ``user_days`` and ``behaviour_days``, of which a user has one for each day."""
    first = days.groupBy("user_pseudo_id").agg(F.min("first_session").alias("first_session"))
    return _users(_rollup_of_days(days), first, behaviour_of_days(behaviour), cfg)


def _users(rollup: DataFrame, first_session: DataFrame, behaviour: DataFrame, cfg: EngineConfig) -> DataFrame:
    first_day = utc_day(F.col("first_seen_at"))
    to_purchase = days_between(F.col("first_seen_date"), utc_day(F.col("first_purchase_at")))
    observed_days = days_between(F.col("first_seen_date"), F.lit(cfg.window_end))
    closed = {
        "has_full_activation_window": cfg.activation_window_days,
        "has_full_d1_window": 1,
        "has_full_d7_window": 7,
        "has_full_d30_window": 30,
    }
    first = {
        "acquisition_source": "first_touch_source",
        "acquisition_medium": "first_touch_medium",
        "acquisition_campaign": "first_touch_campaign",
        "first_device_category": "device_category",
        "first_operating_system": "operating_system",
        "first_country": "country",
        "first_landing_page": "landing_page",
    }
    return (
        rollup.join(first_session, "user_pseudo_id", "left")
        .join(behaviour, "user_pseudo_id", "left")
        .withColumns(
            {
                "first_seen_date": first_day,
                "last_seen_date": utc_day(F.col("last_seen_at")),
                "features_adopted": F.coalesce("features_adopted", F.lit(0)),
                "is_left_censored": F.coalesce(
                    utc_day(F.col("first_touch_at")) < F.lit(cfg.window_start), F.lit(False)
                ),
                **{c: F.col(f"first_session.{src}") for c, src in first.items()},
            }
        )
        .withColumns(
            {
                "lifespan_days": days_between(F.col("first_seen_date"), F.col("last_seen_date")),
                "days_to_first_purchase": to_purchase,
                "is_activated": F.coalesce(
                    to_purchase.between(0, cfg.activation_window_days), F.lit(False)
                ),
                "is_cohort_eligible": ~F.col("is_left_censored"),
                **{c: observed_days >= n for c, n in closed.items()},
            }
        )
        .select(*PUBLIC_COLUMNS["dim_users"])
    )
