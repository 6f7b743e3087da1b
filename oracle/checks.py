"""What the checks and report views say, written out on their own, so that a slip on either side shows."""

from __future__ import annotations

# ID, table, column, kind, severity, what is expected, which rows.
CHECKS = (
    ("Q01", "stg_events", "event_key", "not_null", "error", None, None),
    ("Q02", "stg_events", "event_key", "unique", "warn", None, None),
    ("Q03", "stg_events", "session_key", "not_null", "warn", None, None),
    ("Q04", "stg_events", "user_pseudo_id", "not_null", "error", None, None),
    ("Q05", "stg_events", "event_name", "not_null", "error", None, None),
    ("Q06", "stg_events", "event_date", "not_null", "error", None, None),
    ("Q07", "stg_events", "event_at", "not_null", "error", None, None),
    ('Q08', 'stg_events', 'device_category', 'accepted_values', 'warn', ('desktop', 'mobile', 'tablet'), None),
    ("Q09", "int_sessions", None, "expression_is_true", "error", "session_ended_at >= session_started_at", None),
    ("Q10", "int_sessions", None, "expression_is_true", "error", "page_views <= events_in_session", None),
    ("Q11", "int_sessions", None, "expression_is_true", "error", "not (has_purchase and session_revenue_usd < 0)", None),
    ("Q12", "int_sessions", "session_key", "unique", "error", None, None),
    ("Q13", "int_sessions", "session_key", "not_null", "error", None, None),
    ("Q14", "int_sessions", "user_pseudo_id", "not_null", "error", None, None),
    ('Q15', 'int_sessions', 'user_pseudo_id', 'relationships', 'error', ('stg_events', 'user_pseudo_id'), None),
    ("Q16", "int_sessions", "ga_session_id", "not_null", "error", None, None),
    ("Q17", "int_sessions", "session_started_at", "not_null", "error", None, None),
    ("Q18", "int_sessions", "session_ended_at", "not_null", "error", None, None),
    ("Q19", "int_sessions", "session_date", "not_null", "error", None, None),
    ("Q20", "int_sessions", "session_duration_seconds", "accepted_range", "error", 0, None),
    ("Q21", "int_sessions", "events_in_session", "accepted_range", "error", 1, None),
    ("Q22", "int_sessions", "is_engaged_session", "not_null", "error", None, None),
    ("Q23", "int_sessions", "is_engaged_session_derived", "not_null", "error", None, None),
    ("Q24", "int_sessions", "inactivity_gaps", "accepted_range", "error", 0, None),
    ('Q25', 'int_sessions', 'device_category', 'accepted_values', 'warn', ('desktop', 'mobile', 'tablet'), None),
    ("Q26", "int_sessions", "user_first_seen_at", "not_null", "error", None, None),
    ("Q27", "int_sessions", "user_first_seen_date", "not_null", "error", None, None),
    ("Q28", "int_sessions", "days_since_first_session", "accepted_range", "error", 0, None),
    ("Q29", "int_sessions", "is_left_censored", "not_null", "error", None, None),
    ("Q30", "fct_events", None, "expression_is_true", "error", "not (funnel_step_number is not null and funnel_step_name is null)", None),
    ("Q31", "fct_events", "event_key", "not_null", "error", None, None),
    ("Q32", "fct_events", "session_key", "not_null", "warn", None, None),
    ('Q33', 'fct_events', 'session_key', 'relationships', 'warn', ('fct_sessions', 'session_key'), None),
    ("Q34", "fct_events", "user_pseudo_id", "not_null", "error", None, None),
    ('Q35', 'fct_events', 'user_pseudo_id', 'relationships', 'error', ('dim_users', 'user_pseudo_id'), None),
    ("Q36", "fct_events", "event_name", "not_null", "error", None, None),
    ("Q37", "fct_events", "event_date", "not_null", "error", None, None),
    ("Q38", "fct_events", "event_at", "not_null", "error", None, None),
    ("Q39", "fct_events", "funnel_step_number", "accepted_values", "error", (1, 2, 3, 4, 5), "funnel_step_number is not null"),
    ('Q40', 'fct_events', 'funnel_step_name', 'accepted_values', 'error', ('session_start', 'view_item', 'add_to_cart', 'begin_checkout', 'purchase'), 'funnel_step_name is not null'),
    ('Q41', 'fct_events', 'feature_name', 'relationships', 'warn', ('feature_catalogue', 'feature_name'), 'feature_name is not null'),
    ("Q42", "fct_events", "is_user_initiated_feature", "not_null", "error", None, None),
    ("Q43", "fct_events", "purchase_revenue_usd", "not_null", "error", None, None),
    ("Q44", "dim_users", None, "expression_is_true", "error", "last_seen_at >= first_seen_at", None),
    ("Q45", "dim_users", None, "expression_is_true", "error", "engaged_sessions <= sessions", None),
    ("Q46", "dim_users", None, "expression_is_true", "error", "not (is_activated and first_purchase_at is null)", None),
    ("Q47", "dim_users", None, "expression_is_true", "error", "not (transactions > 0 and sessions_with_purchase = 0)", None),
    ("Q48", "dim_users", "user_pseudo_id", "unique", "error", None, None),
    ("Q49", "dim_users", "user_pseudo_id", "not_null", "error", None, None),
    ("Q50", "dim_users", "first_seen_at", "not_null", "error", None, None),
    ("Q51", "dim_users", "first_seen_date", "not_null", "error", None, None),
    ("Q52", "dim_users", "last_seen_at", "not_null", "error", None, None),
    ("Q53", "dim_users", "lifespan_days", "accepted_range", "error", 0, None),
    ('Q54', 'dim_users', 'first_device_category', 'accepted_values', 'warn', ('desktop', 'mobile', 'tablet'), None),
    ("Q55", "dim_users", "sessions", "accepted_range", "error", 1, None),
    ("Q56", "dim_users", "lifetime_revenue_usd", "accepted_range", "error", 0, None),
    ("Q57", "dim_users", "is_activated", "not_null", "error", None, None),
    ("Q58", "dim_users", "is_retained_d1", "not_null", "error", None, None),
    ("Q59", "dim_users", "is_retained_d7", "not_null", "error", None, None),
    ("Q60", "dim_users", "is_retained_d30", "not_null", "error", None, None),
    ("Q61", "dim_users", "has_full_activation_window", "not_null", "error", None, None),
    ("Q62", "dim_users", "has_full_d7_window", "not_null", "error", None, None),
    ("Q63", "dim_users", "is_left_censored", "not_null", "error", None, None),
    ("Q64", "dim_users", "is_cohort_eligible", "not_null", "error", None, None),
    ("Q65", "fct_sessions", None, "expression_is_true", "error", "page_views <= events_in_session", None),
    ("Q66", "fct_sessions", None, "expression_is_true", "error", "not (has_purchase = false and session_revenue_usd > 0)", None),
    ("Q67", "fct_sessions", "session_key", "unique", "error", None, None),
    ("Q68", "fct_sessions", "session_key", "not_null", "error", None, None),
    ("Q69", "fct_sessions", "user_pseudo_id", "not_null", "error", None, None),
    ('Q70', 'fct_sessions', 'user_pseudo_id', 'relationships', 'error', ('dim_users', 'user_pseudo_id'), None),
    ("Q71", "fct_sessions", "session_started_at", "not_null", "error", None, None),
    ("Q72", "fct_sessions", "session_date", "not_null", "error", None, None),
    ('Q73', 'fct_sessions', 'device_category', 'accepted_values', 'warn', ('desktop', 'mobile', 'tablet'), None),
    ("Q74", "fct_sessions", "is_engaged_session", "not_null", "error", None, None),
    ("Q75", "fct_sessions", "events_in_session", "accepted_range", "error", 1, None),
    ("Q76", "fct_sessions", "session_revenue_usd", "not_null", "error", None, None),
    ("Q77", "fct_funnel", None, "expression_is_true", "error", "not (is_reached_in_sequence and not is_reached)", None),
    ("Q78", "fct_funnel", None, "expression_is_true", "error", "not (is_reached and first_reached_at is null)", None),
    ("Q79", "fct_funnel", "funnel_key", "unique", "error", None, None),
    ("Q80", "fct_funnel", "funnel_key", "not_null", "error", None, None),
    ("Q81", "fct_funnel", "session_key", "not_null", "error", None, None),
    ('Q82', 'fct_funnel', 'session_key', 'relationships', 'error', ('fct_sessions', 'session_key'), None),
    ("Q83", "fct_funnel", "user_pseudo_id", "not_null", "error", None, None),
    ("Q84", "fct_funnel", "session_date", "not_null", "error", None, None),
    ("Q85", "fct_funnel", "step_number", "not_null", "error", None, None),
    ("Q86", "fct_funnel", "step_number", "accepted_values", "error", (1, 2, 3, 4, 5), None),
    ("Q87", "fct_funnel", "step_name", "not_null", "error", None, None),
    ('Q88', 'fct_funnel', 'step_name', 'accepted_values', 'error', ('session_start', 'view_item', 'add_to_cart', 'begin_checkout', 'purchase'), None),
    ("Q89", "fct_funnel", "step_event_count", "not_null", "error", None, None),
    ("Q90", "fct_funnel", "is_reached", "not_null", "error", None, None),
    ("Q91", "fct_funnel", "is_reached_in_sequence", "not_null", "error", None, None),
    ("Q92", "time_spine", "date_day", "unique", "error", None, None),
    ("Q93", "time_spine", "date_day", "not_null", "error", None, None),
    ("Q94", "feature_catalogue", "event_name", "unique", "error", None, None),
    ("Q95", "feature_catalogue", "event_name", "not_null", "error", None, None),
    ("Q96", "feature_catalogue", "feature_name", "not_null", "error", None, None),
    ("Q97", "feature_catalogue", "is_user_initiated", "not_null", "error", None, None),
)

# Fixed value: every table that must hold rows.
NON_EMPTY = ("stg_events", "int_sessions", "fct_events", "dim_users", "fct_sessions", "fct_funnel", "time_spine", "feature_catalogue")

# View, its table and its rows.
VIEWS = {
    "activation_users": ("dim_users", "is_cohort_eligible and has_full_activation_window"),
    "d7_users": ("dim_users", "is_cohort_eligible and has_full_d7_window"),
    "d30_users": ("dim_users", "is_cohort_eligible and has_full_d30_window"),
    "strict_funnel_steps": ("fct_funnel", "is_reached_in_sequence"),
    "early_feature_events": ("fct_events", "is_user_initiated_feature and days_since_first_session <= 7"),
}
