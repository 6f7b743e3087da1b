"""Events with session, cohort, funnel and feature context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from footfall.config import ADOPTION_WINDOW_DAYS, EngineConfig
from footfall.functions.columns import days_between
from footfall.sources.schema import PUBLIC_COLUMNS


def left_join_spreading_nulls(
    left: DataFrame, right: DataFrame, key: str, right_key: str, spread_by: Column
) -> DataFrame:
    """Left equi-join on a nullable key to a side with unique keys.

    All NULL keys would hash to one partition; rows without a key get a
    stand-in that spreads them and, by the extra condition, never matches.
    A key that is merely frequent is split by AQE, since the other side holds
    it once.
    """
    stand_in = F.coalesce(F.col(key), F.concat(F.lit("\0"), spread_by.cast("string")))
    keyed = left.withColumn("__spread_key", stand_in)
    condition = (keyed["__spread_key"] == right[right_key]) & keyed[key].isNotNull()
    return keyed.join(right, condition, "left").drop("__spread_key", right_key)


def funnel_step(cfg: EngineConfig) -> tuple[Column, Column]:
    """Step number and name; NULL for events that are no step."""
    number = F.lit(None).cast("bigint")
    for i, step in enumerate(cfg.funnel_steps, 1):
        number = F.when(F.col("event_name") == step, F.lit(i).cast("bigint")).otherwise(number)
    name = F.when(F.col("event_name").isin(*cfg.funnel_steps), F.col("event_name"))
    return number, name


def fct_events(
    events: DataFrame, sessions: DataFrame, catalogue: DataFrame, cfg: EngineConfig
) -> DataFrame:
    """Every staged event once; those without a session keep NULL cohort columns."""
    context = sessions.select(
        F.col("session_key").alias("__session"), "ga_session_number", "is_first_session",
        "is_engaged_session", "days_since_first_session", "user_first_seen_at",
        "user_first_seen_date", "is_left_censored",
    )
    joined = left_join_spreading_nulls(
        events.drop("ga_session_number"), context, "session_key", "__session", F.col("event_key")
    ).join(catalogue.select("event_name", "feature_name", "is_user_initiated"), "event_name", "left")
    number, name = funnel_step(cfg)
    zero_filled = {c: F.coalesce(c, F.lit(0)) for c in ("purchase_revenue_usd", "total_item_quantity", "item_count")}
    false_filled = {
        c: F.coalesce(c, F.lit(False)) for c in ("is_first_session", "is_engaged_session", "is_left_censored")
    }
    return joined.withColumns(
        {
            **zero_filled,
            **false_filled,
            "has_full_d7_window": days_between(F.col("user_first_seen_date"), F.lit(cfg.window_end))
            >= ADOPTION_WINDOW_DAYS,
            "funnel_step_number": number,
            "funnel_step_name": name,
            "is_user_initiated_feature": F.coalesce("is_user_initiated", F.lit(False)),
        }
    ).select(*PUBLIC_COLUMNS["fct_events"])
