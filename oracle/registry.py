"""Oracle SQL under the names of the registered queries."""

from __future__ import annotations

from footfall.plans.models import MODELS
from footfall.queries import ALL, HALF_HOUR, MEASURE_IDS, METRIC_ORDER, METRIC_QUERIES, SHOWN_BY
from footfall.sources.driver_tables import W1, W2
from footfall.sources.schema import PUBLIC_COLUMNS
from oracle.base import stg_events, table_sql, with_tables
from oracle.checks import CHECKS, NON_EMPTY, VIEWS
from oracle.metrics import metric_sql

_DOUBLES = (
    "event_value_in_usd", "purchase_revenue_usd", "engagement_time_seconds", "session_revenue_usd",
    "lifetime_revenue_usd",
)


def _table(cfg, name):
    return table_sql(cfg, name, PUBLIC_COLUMNS[name], _DOUBLES)


def _gap_events(cfg) -> str:
    return f"""
marked AS (
  SELECT *, lag(event_at) OVER w AS prev_at FROM stg_events WHERE event_at IS NOT NULL
  WINDOW w AS (PARTITION BY user_pseudo_id ORDER BY event_at, event_key)
),
numbered AS (
  SELECT event_key, user_pseudo_id, event_at,
    cast(sum(CASE WHEN prev_at IS NULL OR date_sub('minute', prev_at, event_at) > {cfg.session_gap_minutes}
             THEN 1 ELSE 0 END) OVER (PARTITION BY user_pseudo_id ORDER BY event_at, event_key
                                      ROWS UNBOUNDED PRECEDING) AS BIGINT) AS gap_session_number
  FROM marked
)"""


def _gap_sessions(cfg) -> str:
    return f"""WITH {stg_events(cfg)},{_gap_events(cfg)}
SELECT user_pseudo_id, gap_session_number, min(event_at) AS session_started_at,
       max(event_at) AS session_ended_at, count(*) AS events_in_session
FROM numbered GROUP BY user_pseudo_id, gap_session_number"""


def _check_sql(check_id: str, table: str, column: str | None, kind: str, severity: str, expected, rows: str | None) -> str:
    rows = rows or "true"
    if kind == "not_null":
        text = f"SELECT count(*) AS f FROM {table} WHERE {column} IS NULL"
    elif kind == "unique":
        text = (f"SELECT count(*) AS f FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL"
                f" GROUP BY 1 HAVING count(*) > 1)")
    elif kind == "accepted_values":
        listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in expected)
        text = f"SELECT count(*) AS f FROM {table} WHERE {column} NOT IN ({listed}) AND ({rows})"
    elif kind == "relationships":
        parent, key = expected
        text = (f"SELECT count(*) AS f FROM {table} WHERE {column} IS NOT NULL AND ({rows}) AND"
                f" {column} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)")
    elif kind == "accepted_range":
        text = f"SELECT count(*) AS f FROM {table} WHERE {column} < {expected}"
    elif kind == "expression_is_true":
        text = f"SELECT count(*) AS f FROM {table} WHERE NOT ({expected})"
    else:
        text = f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END AS f FROM {table}"
    shown = f"'{column}'" if column else "cast(NULL AS VARCHAR)"
    return (f"SELECT '{check_id}' AS check_id, '{table}' AS \"table\", {shown} AS \"column\","
            f" '{kind}' AS kind, '{severity}' AS severity, cast(f AS BIGINT) AS failures,"
            f" f = 0 AS passed FROM ({text})")


def _checks(cfg, kind: str | None = None) -> str:
    chosen = [c for c in CHECKS if kind in (None, c[3])]
    if kind in (None, "non_empty"):
        chosen += [("Q98", table, None, "non_empty", "error", None, None) for table in NON_EMPTY]
    return with_tables(cfg, " UNION ALL ".join(_check_sql(*c) for c in chosen))


def _metric_query(arguments: dict, cfg) -> str:
    where = arguments.get("where")
    if where:
        where = where.replace("{{ Dimension('", "").replace("') }}", "")
    tail = ""
    if "limit" in arguments:
        order = [f"{f[1:]} DESC NULLS LAST" if f[0] == "-" else f"{f} NULLS FIRST" for f in arguments["order_by"].split(",")]
        tail = f"ORDER BY {', '.join(order)} LIMIT {arguments['limit']}"
    return metric_sql(
        cfg, arguments["metrics"].split(","), [g for g in arguments.get("group_by", "").split(",") if g],
        where, arguments.get("start_time"), arguments.get("end_time"), tail,
    )


_NET = "cast(l_extendedprice AS DECIMAL(12,2)) * (1 - cast(l_discount AS DECIMAL(4,2)))"
_VALUE = "sum(cast(o_totalprice AS DECIMAL(12,2)))"

_STAR = {
    "m_star_segment": f"""
WITH c AS (SELECT c_mktsegment AS g, count(*) AS customers FROM customer GROUP BY 1),
o AS (SELECT c_mktsegment AS g, count(*) AS orders, cast({_VALUE} AS DOUBLE) AS order_value
      FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1)
SELECT g AS user__segment, customers, orders, round(order_value, 4) AS order_value,
       round(order_value / orders, 4) AS average_order_value FROM c FULL JOIN o USING (g)""",
    "m_star_month": f"""
WITH o AS (SELECT cast(date_trunc('month', o_orderdate) AS DATE) AS g, count(*) AS orders,
             count(DISTINCT o_custkey) AS buyers,
             count(DISTINCT o_custkey) FILTER (WHERE o_totalprice > 200000) AS big
           FROM orders GROUP BY 1),
l AS (SELECT cast(date_trunc('month', l_shipdate) AS DATE) AS g, count(*) AS lines,
        cast(sum({_NET}) AS DOUBLE) AS net FROM lineitem GROUP BY 1)
SELECT g AS metric_time__month, orders, buyers, round(big / nullif(buyers, 0), 4) AS large_buyer_share,
       round(net, 4) AS net_revenue, round(lines / nullif(orders, 0), 4) AS lines_per_order
FROM o FULL JOIN l USING (g)""",
    "m_two_distincts": """
SELECT cast(date_trunc('month', o_orderdate) AS DATE) AS metric_time__month, count(DISTINCT o_custkey) AS buyers,
       count(DISTINCT o_custkey) FILTER (WHERE o_totalprice > 200000) AS large_order_buyers,
       count(DISTINCT o_orderstatus) AS order_statuses, count(*) AS orders FROM orders GROUP BY 1""",
    "m_star_lines": f"""
SELECT l_returnflag AS event__return_flag, l_linestatus AS event__line_status, count(*) AS lines,
       round(cast(sum({_NET}) AS DOUBLE), 4) AS net_revenue, round(avg(l_quantity), 4) AS avg_quantity,
       count(DISTINCT l_orderkey) AS shipped_orders FROM lineitem GROUP BY 1, 2""",
    "m_star_returned": f"""
SELECT o_orderpriority AS session__priority,
       round(count(*) FILTER (WHERE l_returnflag = 'R') / count(*), 4) AS returned_share,
       round(cast(sum({_NET}) AS DOUBLE), 4) AS net_revenue
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey GROUP BY 1""",
}


def oracle_sql() -> dict[str, str]:
    out = {
        "s01_window_scan": with_tables(W2, "SELECT event_date, count(*) AS n_events FROM stg_events GROUP BY 1"),
        "s04_partitioned_write": with_tables(
            W1, "SELECT event_date, event_name, count(*) AS n_events FROM stg_events"
            " WHERE event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-14' GROUP BY 1, 2"),
        "p01_staging": _table(ALL, "stg_events"),
        "p04_param_float": f"""WITH {stg_events(W1)}
SELECT CASE event_type
         WHEN 'view' THEN CASE WHEN k < 60 THEN 'session_start' WHEN k < 80 THEN 'page_view' ELSE 'view_promotion' END
         WHEN 'click' THEN CASE WHEN k < 70 THEN 'view_item' WHEN k < 90 THEN 'select_item' ELSE 'click' END
         WHEN 'signup' THEN CASE WHEN k < 80 THEN 'add_to_cart' ELSE 'view_search_results' END
         WHEN 'error' THEN CASE WHEN k < 80 THEN 'begin_checkout' ELSE 'select_promotion' END
         ELSE 'purchase' END AS event_name,
       sum(CASE WHEN k % 2 = 0 THEN k::DOUBLE ELSE k + 0.5::DOUBLE END) AS score, count(*) AS n_events
FROM flat GROUP BY 1""",
        "c01_sessions": _table(W1, "int_sessions"),
        "c01_sessions_w2": _table(W2, "int_sessions"),
        "c02_gap_disagreement": with_tables(
            ALL, "SELECT session_key, inactivity_gaps, is_split_by_inactivity_rule FROM int_sessions"),
        "c02_gap_half_hour": with_tables(
            HALF_HOUR, "SELECT session_key, inactivity_gaps, is_split_by_inactivity_rule FROM int_sessions"),
        "c03_gap_sessions": _gap_sessions(ALL),
        "t01_stream_sessions": f"SELECT * EXCLUDE (gap_session_number) FROM ({_gap_sessions(HALF_HOUR)}) WHERE user_pseudo_id IS NOT NULL",
        "c03_gap_sessions_half_hour": _gap_sessions(HALF_HOUR),
        "c03_gap_session_events": f"WITH {stg_events(HALF_HOUR)},{_gap_events(HALF_HOUR)}\n"
        "SELECT event_key, user_pseudo_id, gap_session_number FROM numbered UNION ALL"
        " SELECT event_key, user_pseudo_id, NULL FROM stg_events WHERE event_at IS NULL",
        "c04_engagement": with_tables(
            ALL, "SELECT is_engaged_session, is_engaged_session_derived, count(*) AS n_sessions"
            " FROM int_sessions GROUP BY 1, 2"),
        "c05_funnel_dense": _table(W1, "fct_funnel"),
        "c06_cohort_anchor": with_tables(
            W1, "SELECT session_key, user_first_seen_at, user_first_seen_date, days_since_first_session,"
            " is_first_session FROM int_sessions"),
        "c07_left_censoring": with_tables(W1, "SELECT user_pseudo_id, first_touch_at, is_left_censored FROM dim_users"),
        "c08_retention_flags": with_tables(
            W1, "SELECT user_pseudo_id, is_retained_d1, is_retained_d7, is_retained_d30, active_days FROM dim_users"),
        "c09_eligibility": with_tables(
            W2, "SELECT first_seen_date, " + ", ".join(
                f"count(*) FILTER (WHERE {c}) AS {c}" for c in (
                    "has_full_activation_window", "has_full_d1_window", "has_full_d7_window",
                    "has_full_d30_window", "is_cohort_eligible")) + " FROM dim_users GROUP BY 1"),
        "c10_activation": with_tables(
            W1, "SELECT user_pseudo_id, first_purchase_at, days_to_first_purchase, is_activated FROM dim_users"),
        "c11_acquisition": with_tables(
            W1, "SELECT user_pseudo_id, acquisition_source, acquisition_medium, acquisition_campaign,"
            " first_device_category, first_operating_system, first_country, first_landing_page FROM dim_users"),
        "c12_feature_adoption": with_tables(
            W1, "SELECT user_pseudo_id, n_features AS features_adopted FROM acts WHERE bought_at IS NOT NULL OR n_features > 0"),
        "c13_event_enrichment": _table(W1, "fct_events"),
        "c13_event_enrichment_w2": _table(W2, "fct_events"),
        "c14_session_mart": _table(W1, "fct_sessions"),
        "c15_user_mart": _table(W1, "dim_users"),
        "c15_user_mart_w2": _table(W2, "dim_users"),
        "t02_incremental_days": _table(W1, "dim_users"),
        "c16_transaction_counts": with_tables(
            ALL, """SELECT
  (SELECT cast(sum(purchase_events) AS BIGINT) FROM int_sessions) AS session_purchase_events,
  (SELECT cast(sum(transactions) AS BIGINT) FROM int_sessions) AS session_scoped_transactions,
  count(*) AS purchase_events, count(DISTINCT transaction_id) AS global_transactions
FROM stg_events WHERE event_name = 'purchase'"""),
        "c17_funnel_gap": with_tables(
            ALL, """SELECT step_name, permissive, strict, round((permissive - strict) / nullif(strict, 0), 7) AS gap
FROM (SELECT step_name, count(*) FILTER (WHERE is_reached) AS permissive,
             count(*) FILTER (WHERE is_reached_in_sequence) AS strict FROM fct_funnel GROUP BY 1)"""),
        "a14_row_counts": with_tables(ALL, " UNION ALL ".join(
            f"SELECT '{t}' AS \"table\", count(*) AS n_rows FROM {t}" for t in (
                "stg_events", "int_sessions", "fct_events", "dim_users", "fct_sessions", "fct_funnel"))),
        "j14_orphan_users": with_tables(
            ALL, "SELECT user_pseudo_id, count(*) AS n_events FROM fct_events e WHERE NOT EXISTS"
            " (SELECT 1 FROM dim_users u WHERE u.user_pseudo_id = e.user_pseudo_id) GROUP BY 1"),
        "j15_calendar_fill": with_tables(W1, """SELECT d.date_day AS metric_time,
  (SELECT count(*) FROM fct_sessions WHERE session_date = d.date_day) AS sessions,
  round(coalesce((SELECT sum(purchase_revenue_usd) FROM fct_events WHERE event_date = d.date_day), 0), 7) AS revenue,
  (SELECT round(count(*) FILTER (WHERE is_retained_d7) / nullif(cast(count(*) AS DOUBLE), 0), 7) FROM dim_users
   WHERE first_seen_date = d.date_day AND NOT is_left_censored AND has_full_d7_window) AS d7_retention_rate
FROM time_spine d WHERE d.date_day BETWEEN DATE '2023-12-25' AND DATE '2024-02-10'"""),
        "j15_fill_outside_calendar": with_tables(W1, """SELECT d.day AS metric_time,
  (SELECT count(*) FROM fct_sessions WHERE session_date = d.day) AS sessions,
  round(coalesce((SELECT sum(purchase_revenue_usd) FROM fct_events WHERE event_date = d.day), 0), 7) AS revenue
FROM (SELECT date_day AS day FROM time_spine WHERE date_day BETWEEN DATE '2023-12-25' AND DATE '2024-01-15'
      UNION SELECT session_date FROM fct_sessions UNION SELECT event_date FROM fct_events) d"""),
        "j15_fill_null_day": with_tables(W2, """SELECT d.day AS metric_time,
  count(DISTINCT user_pseudo_id) FILTER (WHERE NOT is_left_censored AND has_full_d7_window
    AND is_user_initiated_feature AND days_since_first_session BETWEEN 0 AND 7) AS feature_adopters_7d,
  count(DISTINCT user_pseudo_id) FILTER (WHERE NOT is_left_censored AND has_full_d7_window) AS adoption_base_users
FROM (SELECT date_day AS day FROM time_spine UNION SELECT user_first_seen_date FROM fct_events) d
LEFT JOIN fct_events e ON e.user_first_seen_date IS NOT DISTINCT FROM d.day GROUP BY 1"""),
        "r01_kpi": metric_sql(W1, ["activation_rate", "d7_retention_rate", "session_depth", "feature_adoption_rate"]),
        "r02_weekly_cohorts": metric_sql(
            W2, ["activation_rate", "d1_retention_rate", "d7_retention_rate"], ["metric_time__week"]),
        "r03_strict_funnel": with_tables(W1, """SELECT step_number, step_name, sessions,
  round(sessions / nullif(cast(lag(sessions) OVER (ORDER BY step_number) AS DOUBLE), 0), 7) AS share_of_previous
FROM (SELECT step_number, step_name, count(*) FILTER (WHERE is_reached_in_sequence) AS sessions
      FROM fct_funnel GROUP BY 1, 2)"""),
        "r04_feature_adoption": metric_sql(W1, [
            f"feature_adoption_rate_{f}" for f in ("site_search", "product_list", "promotions", "outbound_click")]),
        "r05_mobile_retention": metric_sql(
            W1, ["d7_retention_rate", "d7_eligible_users"], ["metric_time__month"], "user__first_device_category = 'mobile'"),
        "r06_event_inventory": with_tables(
            ALL, "SELECT event_name, count(*) AS events, round(count(*) / (SELECT count(*) FROM stg_events)::DOUBLE, 7)"
            " AS share FROM stg_events GROUP BY 1"),
        "r07_definition_gaps": with_tables(W1, """SELECT finding, round(cast(value AS DOUBLE), 7) AS value FROM (
  SELECT 'engaged_share_client' AS finding, avg(is_engaged_session::INT) AS value FROM int_sessions
  UNION ALL SELECT 'engaged_share_derived', avg(is_engaged_session_derived::INT) FROM int_sessions
  UNION ALL SELECT 'sessions_split_by_gap', count(*) FILTER (WHERE inactivity_gaps > 0) FROM int_sessions
  UNION ALL SELECT 'split_share', avg((inactivity_gaps > 0)::INT) FROM int_sessions
  UNION ALL SELECT 'session_scoped_transactions', sum(transactions) FROM int_sessions
  UNION ALL SELECT 'censored_users', count(*) FILTER (WHERE is_left_censored) FROM dim_users
  UNION ALL SELECT 'censored_share', avg(is_left_censored::INT) FROM dim_users
  UNION ALL SELECT 'purchase_events', count(*) FROM stg_events WHERE event_name = 'purchase'
  UNION ALL SELECT 'global_transactions', count(DISTINCT transaction_id) FROM stg_events WHERE event_name = 'purchase'
  UNION ALL SELECT 'sessions_without_entry_step', count(*) FROM fct_funnel WHERE step_number = 1 AND NOT is_reached
  UNION ALL SELECT 'permissive_' || step_name, count(*) FILTER (WHERE is_reached) FROM fct_funnel GROUP BY step_name
  UNION ALL SELECT 'strict_' || step_name, count(*) FILTER (WHERE is_reached_in_sequence) FROM fct_funnel GROUP BY step_name
)"""),
        "r08_window_sensitivity": with_tables(W1, " UNION ALL ".join(f"""
SELECT cast({n} AS BIGINT) AS window_days, count(*) AS eligible_users,
       count(*) FILTER (WHERE days_to_first_purchase BETWEEN 0 AND {n}) AS activated_users,
       round(count(*) FILTER (WHERE days_to_first_purchase BETWEEN 0 AND {n}) / nullif(count(*)::DOUBLE, 0), 7) AS activation_rate
FROM dim_users WHERE NOT is_left_censored AND date_diff('day', first_seen_date, DATE '{W1.window_end}') >= {n}"""
                                                                for n in (7, 30))),
    }
    for view, (table, rule) in VIEWS.items():
        out[f"r09_{view}"] = _table(W1, table) + f" WHERE {rule}"
    for model in MODELS:
        for measure in model.measures:
            out[MEASURE_IDS[measure.name]] = metric_sql(
                W1, [measure.name], [SHOWN_BY[model.name]], measures=True)
    for i, name in enumerate(METRIC_ORDER, 1):
        out[f"mt{i:02d}_{name}"] = metric_sql(W1, [name], ["metric_time__week"])
    for name, (arguments, cfg) in METRIC_QUERIES.items():
        out[name] = _metric_query(arguments, cfg)
    out.update(_STAR)
    kinds = ("not_null", "unique", "accepted_values", "relationships", "accepted_range", "expression_is_true", "non_empty")
    for n, kind in enumerate(kinds, 1):
        out[f"k{n:02d}_{kind}"] = _checks(ALL, kind)
    out["k04_relationships_w2"] = _checks(W2, "relationships")
    out["k_all_checks"] = _checks(ALL)
    return out
