"""One typed, flat row per exported event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions.columns import composite_key, param_int, param_string, surrogate_key
from footfall.sources.schema import PUBLIC_COLUMNS


#: Columns of a staged event that its others give.
EVENT_KEYS = ("event_key", "session_key")


def with_event_keys(events: DataFrame) -> DataFrame:
    """The keys of staged events, from the columns they are made of."""
    identity = [F.col("user_pseudo_id"), F.col("ga_session_id"), F.unix_micros("event_at"), F.col("event_name"),
                F.col("event_bundle_sequence_id"), F.col("page_location")]
    return events.withColumns(
        {
            "event_key": surrogate_key(identity),
            "session_key": composite_key(F.col("user_pseudo_id"), F.col("ga_session_id")),
        }
    )


def stage_events(raw: DataFrame) -> DataFrame:
    """Rename, type and key the nested rows; no row is added or dropped.

    Flags keep the source's three states where it matters: a missing engaged
    parameter stays NULL, a missing entrance counts as no entrance.
    """
    flat = raw.select(
        "user_pseudo_id",
        param_int("ga_session_id").alias("ga_session_id"),
        param_int("ga_session_number").alias("ga_session_number"),
        "stream_id",
        "event_name",
        F.to_date("event_date", "yyyyMMdd").alias("event_date"),
        F.timestamp_micros("event_timestamp").alias("event_at"),
        "event_bundle_sequence_id",
        "event_value_in_usd",
        param_string("page_location").alias("page_location"),
        param_string("page_title").alias("page_title"),
        param_string("page_referrer").alias("page_referrer"),
        param_int("engagement_time_msec").alias("engagement_time_msec"),
        (param_string("session_engaged") == "1").alias("is_session_engaged_event"),
        (F.coalesce(param_int("entrances"), F.lit(0)) == 1).alias("is_entrance"),
        F.col("device.category").alias("device_category"),
        F.col("device.operating_system").alias("operating_system"),
        F.col("device.web_info.browser").alias("browser"),
        F.col("device.language").alias("device_language"),
        "platform",
        "geo.country",
        "geo.region",
        "geo.city",
        F.col("traffic_source.source").alias("first_touch_source"),
        F.col("traffic_source.medium").alias("first_touch_medium"),
        F.col("traffic_source.name").alias("first_touch_campaign"),
        F.timestamp_micros("user_first_touch_timestamp").alias("user_first_touch_at"),
        F.col("ecommerce.transaction_id").alias("transaction_id"),
        F.col("ecommerce.purchase_revenue_in_usd").alias("purchase_revenue_usd"),
        F.col("ecommerce.total_item_quantity").alias("total_item_quantity"),
        F.col("ecommerce.unique_items").alias("unique_items"),
        F.size("items").cast("bigint").alias("item_count"),
    )
    return with_event_keys(flat).select(*PUBLIC_COLUMNS["stg_events"])
