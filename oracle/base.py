"""DuckDB SQL for the public tables, written row by row with joins and windows.

It shares nothing with the Spark code: gaps come from ``lag`` over events, first
rows from ``row_number``, and the funnel from a join of sessions and steps.
"""

from __future__ import annotations

from footfall.config import FUNNEL_STEPS, EngineConfig

# Event, feature, description, is it a deliberate use?
_FEATURES = """
('view_search_results', 'site_search', 'A visitor looked at results of a search on the site', true),
('select_promotion', 'promotions', 'A visitor followed a promotion', true),
('view_promotion', 'promotions', 'A promotion came into view', false),
('select_item', 'product_list', 'A visitor picked a product from a list', true),
('view_item_list', 'product_list', 'A list of products came into view', false),
('click', 'outbound_click', 'A visitor left through a link to another site', true)"""
_STEPS = ", ".join(f"({i}, '{s}')" for i, s in enumerate(FUNNEL_STEPS, 1))


def _key(*parts: str) -> str:
    return "md5(concat_ws('-', " + ", ".join(f"coalesce(cast({p} as varchar), '<null>')" for p in parts) + "))"


def bound(cfg: EngineConfig) -> str:
    return f"DATE '{cfg.window_end}'"


def stg_events(cfg: EngineConfig) -> str:
    return f"""
flat AS (
  SELECT event_id, ts, user_id, event_type, value,
         cast(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events
),
owned AS (SELECT *, user_id || '-' || (k % 5) AS uid FROM flat),
touch AS (SELECT uid, min(ts) AS first_ts FROM owned GROUP BY uid),
shaped AS (
  SELECT o.*, t.first_ts,
    CASE WHEN k < 97 THEN date_diff('day', DATE '1970-01-01', cast(ts AS DATE)) // 4 END AS sid,
    CASE event_type
      WHEN 'view' THEN CASE WHEN k < 60 THEN 'session_start' WHEN k < 80 THEN 'page_view' ELSE 'view_promotion' END
      WHEN 'click' THEN CASE WHEN k < 70 THEN 'view_item' WHEN k < 90 THEN 'select_item' ELSE 'click' END
      WHEN 'signup' THEN CASE WHEN k < 80 THEN 'add_to_cart' ELSE 'view_search_results' END
      WHEN 'error' THEN CASE WHEN k < 80 THEN 'begin_checkout' ELSE 'select_promotion' END
      ELSE 'purchase' END AS ename,
    CASE WHEN k % 7 <> 0 THEN '/p/' || (k % 20) END AS page,
    event_type = 'purchase' AS bought
  FROM owned o JOIN touch t USING (uid)
  WHERE {"true" if cfg.every_row else f"cast(ts AS DATE) BETWEEN DATE '{cfg.window_start}' AND DATE '{cfg.window_end}'"}
),
stg_events AS (
  SELECT
    {_key('uid', 'sid', 'epoch_us(ts)', 'ename', 'event_id', 'page')} AS event_key,
    uid || '-' || sid AS session_key,
    uid AS user_pseudo_id, cast(sid AS BIGINT) AS ga_session_id,
    cast(sid - 4930 AS BIGINT) AS ga_session_number,
    '1' AS stream_id, ename AS event_name, cast(ts AS DATE) AS event_date, ts AS event_at,
    event_id AS event_bundle_sequence_id, cast(NULL AS DOUBLE) AS event_value_in_usd,
    page AS page_location, cast(NULL AS VARCHAR) AS page_title, cast(NULL AS VARCHAR) AS page_referrer,
    cast(floor(value * 1000) AS BIGINT) AS engagement_time_msec,
    CASE WHEN value >= 50 THEN true END AS is_session_engaged_event, false AS is_entrance,
    CASE user_id % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END AS device_category,
    'os_' || (user_id % 4) AS operating_system, 'browser_' || (user_id % 3) AS browser,
    cast(NULL AS VARCHAR) AS device_language, 'WEB' AS platform,
    'country_' || (user_id % 7) AS country, 'region_' || (user_id % 5) AS region,
    'city_' || (user_id % 11) AS city,
    'source_' || (user_id % 6) AS first_touch_source, 'medium_' || (user_id % 4) AS first_touch_medium,
    'campaign_' || (user_id % 3) AS first_touch_campaign, first_ts AS user_first_touch_at,
    CASE WHEN bought THEN 'T' || (k % 50) END AS transaction_id,
    CASE WHEN bought THEN value END AS purchase_revenue_usd,
    CASE WHEN bought THEN cast(1 + k % 3 AS BIGINT) END AS total_item_quantity,
    CASE WHEN bought THEN cast(1 AS BIGINT) END AS unique_items,
    CASE WHEN bought THEN cast(1 + k % 3 AS BIGINT) END AS item_count
  FROM shaped
),
feature_catalogue(event_name, feature_name, feature_description, is_user_initiated) AS (VALUES {_FEATURES}),
time_spine AS (
  SELECT cast(d AS DATE) AS date_day
  FROM generate_series(DATE '2019-01-01', DATE '2026-12-31', INTERVAL 1 DAY) AS g(d)
)"""


def sessions(cfg: EngineConfig) -> str:
    return f"""
in_session AS (SELECT * FROM stg_events WHERE ga_session_id IS NOT NULL),
ordered AS (
  SELECT *,
    lag(event_at) OVER (PARTITION BY session_key ORDER BY event_at, event_key) AS prev_at,
    row_number() OVER (PARTITION BY session_key
                       ORDER BY event_at, event_name NULLS FIRST, event_key) AS rn,
    row_number() OVER (PARTITION BY session_key, page_location IS NULL
                       ORDER BY event_at, page_location) AS page_rn
  FROM in_session
),
rolled AS (
  SELECT session_key, user_pseudo_id, ga_session_id,
    max(ga_session_number) AS ga_session_number,
    min(event_at) AS session_started_at, max(event_at) AS session_ended_at,
    cast(min(event_at) AS DATE) AS session_date,
    cast(date_sub('second', min(event_at), max(event_at)) AS BIGINT) AS session_duration_seconds,
    count(*) AS events_in_session,
    count(*) FILTER (WHERE event_name = 'page_view') AS page_views,
    count(DISTINCT page_location) AS distinct_pages_viewed,
    cast(sum(coalesce(engagement_time_msec, 0)) AS BIGINT) / 1000.0::DOUBLE AS engagement_time_seconds,
    max(page_location) FILTER (WHERE page_rn = 1 AND page_location IS NOT NULL) AS landing_page,
    coalesce(bool_or(is_session_engaged_event), false) AS is_engaged_session,
    count(*) FILTER (WHERE date_sub('minute', prev_at, event_at) > {cfg.session_gap_minutes}) AS inactivity_gaps,
    count(*) FILTER (WHERE event_name = 'view_item') > 0 AS has_view_item,
    count(*) FILTER (WHERE event_name = 'add_to_cart') > 0 AS has_add_to_cart,
    count(*) FILTER (WHERE event_name = 'begin_checkout') > 0 AS has_begin_checkout,
    count(*) FILTER (WHERE event_name = 'purchase') > 0 AS has_purchase,
    count(*) FILTER (WHERE event_name = 'purchase') AS purchase_events,
    count(DISTINCT transaction_id) FILTER (WHERE event_name = 'purchase') AS transactions,
    coalesce(sum(purchase_revenue_usd) FILTER (WHERE event_name = 'purchase'), 0.0) AS session_revenue_usd,
    min(user_first_touch_at) AS touched
  FROM ordered GROUP BY ALL
),
first_rows AS (SELECT * FROM ordered WHERE rn = 1),
anchors AS (
  SELECT user_pseudo_id, min(session_started_at) AS user_first_seen_at,
         cast(min(session_started_at) AS DATE) AS user_first_seen_date,
         min(touched) AS user_first_touch_at
  FROM rolled GROUP BY user_pseudo_id
),
int_sessions AS (
  SELECT r.session_key, r.user_pseudo_id, r.ga_session_id, r.ga_session_number, r.session_started_at,
    r.session_ended_at, r.session_date, r.session_duration_seconds, r.events_in_session, r.page_views,
    r.distinct_pages_viewed, r.engagement_time_seconds, r.landing_page, r.is_engaged_session,
    (r.session_duration_seconds >= {cfg.engaged_min_seconds}
     OR r.page_views >= {cfg.engaged_min_page_views} OR r.has_purchase) AS is_engaged_session_derived,
    r.inactivity_gaps, r.inactivity_gaps > 0 AS is_split_by_inactivity_rule,
    r.has_view_item, r.has_add_to_cart, r.has_begin_checkout, r.has_purchase, r.purchase_events,
    r.transactions, r.session_revenue_usd,
    f.device_category, f.operating_system, f.browser, f.platform, f.country, f.region, f.city,
    f.first_touch_source, f.first_touch_medium, f.first_touch_campaign,
    a.user_first_seen_at, a.user_first_seen_date, a.user_first_touch_at,
    date_diff('day', a.user_first_seen_date, r.session_date) AS days_since_first_session,
    r.session_started_at = a.user_first_seen_at AS is_first_session,
    coalesce(cast(a.user_first_touch_at AS DATE) < DATE '{cfg.window_start}', false) AS is_left_censored
  FROM rolled r JOIN first_rows f ON f.session_key = r.session_key
  JOIN anchors a ON a.user_pseudo_id = r.user_pseudo_id
)"""


def users(cfg: EngineConfig) -> str:
    """Users straight from their sessions: the opening session is marked, everything else is a filtered aggregate."""
    opening = {
        "first_touch_source": "acquisition_source", "first_touch_medium": "acquisition_medium",
        "first_touch_campaign": "acquisition_campaign", "device_category": "first_device_category",
        "operating_system": "first_operating_system", "country": "first_country", "landing_page": "first_landing_page",
    }
    sums = {
        "events_in_session": "events", "page_views": "page_views", "session_duration_seconds": "total_session_seconds",
        "transactions": "transactions",
    }
    closed = {"activation": cfg.activation_window_days, "d1": 1, "d7": 7, "d30": 30}
    parts = [f"max({c}) FILTER (WHERE opens) AS {name}" for c, name in opening.items()]
    parts += [f"cast(sum({c}) AS BIGINT) AS {name}" for c, name in sums.items()]
    parts += [f"count(*) FILTER (WHERE has_{c}) AS sessions_with_{c}" for c in ("view_item", "add_to_cart", "begin_checkout", "purchase")]
    parts += [f"bool_or(day_no > 0 AND day_no <= {n}) AS is_retained_d{n}" for n in (1, 7, 30)]
    flags = [f"observed >= {n} AS has_full_{name}_window" for name, n in closed.items()]
    return f"""
placed AS (
  SELECT *, days_since_first_session AS day_no,
    session_started_at = min(session_started_at) OVER own AND session_key = first_value(session_key) OVER own AS opens
  FROM int_sessions WINDOW own AS (PARTITION BY user_pseudo_id ORDER BY session_started_at, session_key
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
),
acts AS (
  SELECT e.user_pseudo_id, min(CASE e.event_name WHEN 'purchase' THEN e.event_at END) AS bought_at,
    count(DISTINCT CASE WHEN c.is_user_initiated THEN c.feature_name END) AS n_features
  FROM stg_events e LEFT JOIN feature_catalogue c ON c.event_name = e.event_name GROUP BY 1
),
grown AS (
  SELECT user_pseudo_id, count(*) AS sessions, count(*) FILTER (WHERE is_engaged_session) AS engaged_sessions,
    count(DISTINCT session_date) AS active_days, sum(session_revenue_usd) AS lifetime_revenue_usd,
    any_value(user_first_seen_at) AS first_seen_at, any_value(user_first_touch_at) AS first_touch_at,
    max(session_started_at) AS last_seen_at, any_value(is_left_censored) AS is_left_censored,
    {", ".join(parts)}
  FROM placed GROUP BY user_pseudo_id
),
dated AS (
  SELECT grown.*, cast(first_seen_at AS DATE) AS first_seen_date, cast(last_seen_at AS DATE) AS last_seen_date,
    bought_at AS first_purchase_at, coalesce(n_features, 0) AS features_adopted,
    date_diff('day', cast(first_seen_at AS DATE), cast(bought_at AS DATE)) AS days_to_first_purchase,
    date_diff('day', cast(first_seen_at AS DATE), {bound(cfg)}) AS observed
  FROM grown LEFT JOIN acts ON acts.user_pseudo_id = grown.user_pseudo_id
),
dim_users AS (
  SELECT *, date_diff('day', first_seen_date, last_seen_date) AS lifespan_days, NOT is_left_censored AS is_cohort_eligible,
    days_to_first_purchase IS NOT NULL AND days_to_first_purchase >= 0
      AND days_to_first_purchase <= {cfg.activation_window_days} AS is_activated,
    {", ".join(flags)}
  FROM dated
)"""


def facts(cfg: EngineConfig) -> str:
    return f"""
steps(step_number, step_name) AS (VALUES {_STEPS}),
fct_events AS (
  SELECT e.event_key, e.session_key, e.user_pseudo_id, e.event_name, e.event_date, e.event_at,
    s.user_first_seen_at, s.user_first_seen_date, s.days_since_first_session, s.ga_session_number,
    coalesce(s.is_first_session, false) AS is_first_session,
    coalesce(s.is_engaged_session, false) AS is_engaged_session,
    coalesce(s.is_left_censored, false) AS is_left_censored,
    date_diff('day', s.user_first_seen_date, {bound(cfg)}) >= 7 AS has_full_d7_window,
    cast(p.step_number AS BIGINT) AS funnel_step_number, p.step_name AS funnel_step_name,
    c.feature_name, coalesce(c.is_user_initiated, false) AS is_user_initiated_feature,
    e.device_category, e.operating_system, e.browser, e.platform, e.country, e.region, e.city,
    e.first_touch_source, e.first_touch_medium, e.first_touch_campaign, e.page_location, e.page_title,
    e.engagement_time_msec, e.transaction_id, coalesce(e.purchase_revenue_usd, 0) AS purchase_revenue_usd,
    coalesce(e.total_item_quantity, 0) AS total_item_quantity, coalesce(e.item_count, 0) AS item_count
  FROM stg_events e LEFT JOIN int_sessions s ON s.session_key = e.session_key
  LEFT JOIN steps p ON p.step_name = e.event_name
  LEFT JOIN feature_catalogue c ON c.event_name = e.event_name
),
fct_sessions AS (
  SELECT s.session_key, s.user_pseudo_id, s.ga_session_id, s.ga_session_number, s.session_started_at,
    s.session_ended_at, s.session_date, s.session_duration_seconds, s.days_since_first_session,
    s.user_first_seen_date, coalesce(s.is_first_session, false) AS is_first_session,
    s.device_category, s.operating_system, s.browser, s.platform, s.country, s.region, s.city,
    s.landing_page, u.acquisition_source, u.acquisition_medium, u.acquisition_campaign,
    u.first_device_category, u.first_country, coalesce(u.is_cohort_eligible, false) AS is_cohort_eligible,
    coalesce(u.is_left_censored, false) AS user_is_left_censored, s.is_engaged_session,
    s.is_engaged_session_derived, s.engagement_time_seconds, s.inactivity_gaps,
    s.is_split_by_inactivity_rule, s.events_in_session, s.page_views, s.distinct_pages_viewed,
    s.has_view_item, s.has_add_to_cart, s.has_begin_checkout, s.has_purchase, s.purchase_events,
    s.transactions, s.session_revenue_usd
  FROM int_sessions s LEFT JOIN dim_users u ON u.user_pseudo_id = s.user_pseudo_id
),
reached AS (
  SELECT session_key, funnel_step_number, min(event_at) AS first_reached_at, count(*) AS n
  FROM fct_events WHERE funnel_step_number IS NOT NULL AND session_key IS NOT NULL GROUP BY 1, 2
),
fct_funnel AS (
  SELECT {_key('s.session_key', 'p.step_number')} AS funnel_key, s.session_key, s.user_pseudo_id,
    s.session_date, s.session_started_at, s.days_since_first_session, s.user_first_seen_date,
    cast(p.step_number AS BIGINT) AS step_number, p.step_name, r.first_reached_at,
    coalesce(r.n, 0) AS step_event_count, r.n IS NOT NULL AS is_reached,
    cast(date_sub('second', s.session_started_at, r.first_reached_at) AS BIGINT) AS seconds_from_session_start,
    s.device_category, s.operating_system, s.browser, s.country, s.acquisition_source,
    s.acquisition_medium, s.acquisition_campaign, s.is_engaged_session, s.is_cohort_eligible,
    s.session_revenue_usd,
    count(r.n) OVER (PARTITION BY s.session_key ORDER BY p.step_number
                     ROWS UNBOUNDED PRECEDING) = p.step_number AS is_reached_in_sequence
  FROM fct_sessions s CROSS JOIN steps p
  LEFT JOIN reached r ON r.session_key = s.session_key AND r.funnel_step_number = p.step_number
)"""


def with_tables(cfg: EngineConfig, select: str) -> str:
    return f"WITH {stg_events(cfg)},{sessions(cfg)},{users(cfg)},{facts(cfg)}\n{select}"


def table_sql(cfg: EngineConfig, table: str, columns: list[str], doubles: tuple[str, ...] = ()) -> str:
    cols = ", ".join(f"round({c}, 7) AS {c}" if c in doubles else c for c in columns)
    return with_tables(cfg, f"SELECT {cols} FROM {table}")
