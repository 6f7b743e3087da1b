"""Declared schemas. Nothing is inferred at run time."""

from __future__ import annotations

from pyspark.sql import types as T

_VALUE = T.StructType(
    [
        T.StructField("string_value", T.StringType()),
        T.StructField("int_value", T.LongType()),
        T.StructField("float_value", T.DoubleType()),
        T.StructField("double_value", T.DoubleType()),
    ]
)

PARAMS = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", _VALUE)])
)


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# The nested event export, limited to the fields the engine reads.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_date", T.StringType()),
        T.StructField("event_timestamp", T.LongType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("event_bundle_sequence_id", T.LongType()),
        T.StructField("event_value_in_usd", T.DoubleType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("user_first_touch_timestamp", T.LongType()),
        T.StructField("stream_id", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("event_params", PARAMS),
        T.StructField(
            "device",
            T.StructType(
                _strings("category", "operating_system", "language")
                + [T.StructField("web_info", T.StructType(_strings("browser")))]
            ),
        ),
        T.StructField("geo", T.StructType(_strings("country", "region", "city"))),
        T.StructField("traffic_source", T.StructType(_strings("source", "medium", "name"))),
        T.StructField(
            "ecommerce",
            T.StructType(
                [
                    T.StructField("transaction_id", T.StringType()),
                    T.StructField("purchase_revenue_in_usd", T.DoubleType()),
                    T.StructField("total_item_quantity", T.LongType()),
                    T.StructField("unique_items", T.LongType()),
                ]
            ),
        ),
        T.StructField("items", T.ArrayType(T.StructType(_strings("item_id")))),
    ]
)

FEATURE_SCHEMA = T.StructType(
    _strings("event_name", "feature_name", "feature_description")
    + [T.StructField("is_user_initiated", T.BooleanType())]
)

# Public column order of each table.
_SESSION_DIMS = ["device_category", "operating_system", "browser", "platform", "country", "region", "city"]
_FIRST_TOUCH = ["first_touch_source", "first_touch_medium", "first_touch_campaign"]
_ACQUISITION = ["acquisition_source", "acquisition_medium", "acquisition_campaign"]

PUBLIC_COLUMNS: dict[str, list[str]] = {
    "stg_events": [
        "event_key", "session_key", "user_pseudo_id", "ga_session_id", "ga_session_number",
        "stream_id", "event_name", "event_date", "event_at", "event_bundle_sequence_id",
        "event_value_in_usd", "page_location", "page_title", "page_referrer",
        "engagement_time_msec", "is_session_engaged_event", "is_entrance", "device_category",
        "operating_system", "browser", "device_language", "platform", "country", "region", "city",
        *_FIRST_TOUCH, "user_first_touch_at", "transaction_id", "purchase_revenue_usd",
        "total_item_quantity", "unique_items", "item_count",
    ],
    "int_sessions": [
        "session_key", "user_pseudo_id", "ga_session_id", "ga_session_number",
        "session_started_at", "session_ended_at", "session_date", "session_duration_seconds",
        "events_in_session", "page_views", "distinct_pages_viewed", "engagement_time_seconds",
        "landing_page", "is_engaged_session", "is_engaged_session_derived", "inactivity_gaps",
        "is_split_by_inactivity_rule", "has_view_item", "has_add_to_cart", "has_begin_checkout",
        "has_purchase", "purchase_events", "transactions", "session_revenue_usd",
        *_SESSION_DIMS, *_FIRST_TOUCH, "user_first_seen_at", "user_first_seen_date",
        "user_first_touch_at", "days_since_first_session", "is_first_session", "is_left_censored",
    ],
    "fct_events": [
        "event_key", "session_key", "user_pseudo_id", "event_name", "event_date", "event_at",
        "user_first_seen_at", "user_first_seen_date", "days_since_first_session",
        "ga_session_number", "is_first_session", "is_engaged_session", "is_left_censored",
        "has_full_d7_window", "funnel_step_number", "funnel_step_name", "feature_name",
        "is_user_initiated_feature", *_SESSION_DIMS, *_FIRST_TOUCH, "page_location", "page_title",
        "engagement_time_msec", "transaction_id", "purchase_revenue_usd", "total_item_quantity",
        "item_count",
    ],
    "dim_users": [
        "user_pseudo_id", "first_seen_at", "first_seen_date", "first_touch_at", "last_seen_at",
        "last_seen_date", "lifespan_days", *_ACQUISITION, "first_device_category",
        "first_operating_system", "first_country", "first_landing_page", "sessions",
        "engaged_sessions", "active_days", "events", "page_views", "total_session_seconds",
        "sessions_with_view_item", "sessions_with_add_to_cart", "sessions_with_begin_checkout",
        "sessions_with_purchase", "transactions", "lifetime_revenue_usd", "features_adopted",
        "first_purchase_at", "days_to_first_purchase", "is_activated", "is_retained_d1",
        "is_retained_d7", "is_retained_d30", "has_full_activation_window", "has_full_d1_window",
        "has_full_d7_window", "has_full_d30_window", "is_left_censored", "is_cohort_eligible",
    ],
    "fct_sessions": [
        "session_key", "user_pseudo_id", "ga_session_id", "ga_session_number",
        "session_started_at", "session_ended_at", "session_date", "session_duration_seconds",
        "days_since_first_session", "user_first_seen_date", "is_first_session", *_SESSION_DIMS,
        "landing_page", *_ACQUISITION, "first_device_category", "first_country",
        "is_cohort_eligible", "user_is_left_censored", "is_engaged_session",
        "is_engaged_session_derived", "engagement_time_seconds", "inactivity_gaps",
        "is_split_by_inactivity_rule", "events_in_session", "page_views", "distinct_pages_viewed",
        "has_view_item", "has_add_to_cart", "has_begin_checkout", "has_purchase",
        "purchase_events", "transactions", "session_revenue_usd",
    ],
    "fct_funnel": [
        "funnel_key", "session_key", "user_pseudo_id", "session_date", "session_started_at",
        "days_since_first_session", "user_first_seen_date", "step_number", "step_name",
        "first_reached_at", "step_event_count", "is_reached", "seconds_from_session_start",
        "device_category", "operating_system", "browser", "country", *_ACQUISITION,
        "is_engaged_session", "is_cohort_eligible", "session_revenue_usd",
        "is_reached_in_sequence",
    ],
    "feature_catalogue": ["event_name", "feature_name", "feature_description", "is_user_initiated"],
    "time_spine": ["date_day"],
}
