"""DuckDB SQL for measures and metrics: one subquery per input, joined on the groups."""

from __future__ import annotations

import re

from footfall.config import EngineConfig
from oracle.base import with_tables

ENTITY = {"dim_users": "user", "fct_sessions": "session", "fct_events": "event", "fct_funnel": "funnel_step"}
CLOCK = {
    "dim_users": "first_seen_date", "fct_sessions": "session_date",
    "fct_events": "event_date", "fct_funnel": "session_date",
}


def _n(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


def _open(window: str) -> str:
    return f"NOT t.is_left_censored AND t.{window}"


_EARLY = (
    "t.is_user_initiated_feature AND t.days_since_first_session >= 0 AND t.days_since_first_session <= 7"
    " AND NOT t.is_left_censored AND t.has_full_d7_window"
)

# measure -> (table, aggregate[, own clock])
MEASURES: dict[str, tuple[str, ...]] = {
    "all_users": ("dim_users", "count(DISTINCT t.user_pseudo_id)"),
    "new_users": ("dim_users", _n("NOT t.is_left_censored")),
    "activation_eligible_users": ("dim_users", _n(_open("has_full_activation_window"))),
    "activated_users": ("dim_users", _n(f"t.is_activated AND {_open('has_full_activation_window')}")),
    "d1_eligible_users": ("dim_users", _n(_open("has_full_d1_window"))),
    "d1_retained_users": ("dim_users", _n(f"t.is_retained_d1 AND {_open('has_full_d1_window')}")),
    "d7_eligible_users": ("dim_users", _n(_open("has_full_d7_window"))),
    "d7_retained_users": ("dim_users", _n(f"t.is_retained_d7 AND {_open('has_full_d7_window')}")),
    "d30_eligible_users": ("dim_users", _n(_open("has_full_d30_window"))),
    "d30_retained_users": ("dim_users", _n(f"t.is_retained_d30 AND {_open('has_full_d30_window')}")),
    "user_lifetime_revenue": ("dim_users", "sum(t.lifetime_revenue_usd)"),
    "avg_days_to_first_purchase": ("dim_users", "avg(t.days_to_first_purchase)"),
    "sessions": ("fct_sessions", "count(DISTINCT t.session_key)"),
    "session_events": ("fct_sessions", "cast(sum(t.events_in_session) AS BIGINT)"),
    "session_page_views": ("fct_sessions", "cast(sum(t.page_views) AS BIGINT)"),
    "engaged_sessions": ("fct_sessions", _n("t.is_engaged_session")),
    "engaged_sessions_derived": ("fct_sessions", _n("t.is_engaged_session_derived")),
    "sessions_split_by_gap": ("fct_sessions", _n("t.is_split_by_inactivity_rule")),
    "session_duration_seconds": ("fct_sessions", "cast(sum(t.session_duration_seconds) AS BIGINT)"),
    "purchasing_sessions": ("fct_sessions", _n("t.has_purchase")),
    "session_revenue": ("fct_sessions", "sum(t.session_revenue_usd)"),
    "transactions": ("fct_sessions", "cast(sum(t.transactions) AS BIGINT)"),
    "events": ("fct_events", "count(t.event_key)"),
    "event_users": ("fct_events", "count(DISTINCT t.user_pseudo_id)"),
    "feature_adopters_7d": (
        "fct_events", f"count(DISTINCT t.user_pseudo_id) FILTER (WHERE {_EARLY})", "user_first_seen_date",
    ),
    "adoption_base_users": (
        "fct_events", f"count(DISTINCT t.user_pseudo_id) FILTER (WHERE {_open('has_full_d7_window')})",
        "user_first_seen_date",
    ),
    "event_revenue": ("fct_events", "sum(t.purchase_revenue_usd)"),
    "funnel_sessions_reached": ("fct_funnel", _n("t.is_reached")),
    "funnel_sessions_in_sequence": ("fct_funnel", _n("t.is_reached_in_sequence")),
}
DOUBLES = {"user_lifetime_revenue", "avg_days_to_first_purchase", "session_revenue", "event_revenue"}

_STRICT = "funnel_sessions_in_sequence"

# metric -> (measure, filter); the rest have the name of their measure
SIMPLE: dict[str, tuple[str, str | None]] = {
    "revenue": ("event_revenue", None),
    "sessions_starting_funnel": (_STRICT, "t.step_name = 'session_start'"),
    "sessions_reaching_view_item": (_STRICT, "t.step_name = 'view_item'"),
    "sessions_reaching_add_to_cart": (_STRICT, "t.step_name = 'add_to_cart'"),
    "sessions_reaching_begin_checkout": (_STRICT, "t.step_name = 'begin_checkout'"),
    "sessions_reaching_purchase": (_STRICT, "t.step_name = 'purchase'"),
}

# ratio -> (numerator, denominator[, numerator filter])
RATIOS: dict[str, tuple[str, ...]] = {
    "activation_rate": ("activated_users", "activation_eligible_users"),
    "d1_retention_rate": ("d1_retained_users", "d1_eligible_users"),
    "d7_retention_rate": ("d7_retained_users", "d7_eligible_users"),
    "d30_retention_rate": ("d30_retained_users", "d30_eligible_users"),
    "session_depth": ("session_events", "sessions"),
    "engagement_rate": ("engaged_sessions", "sessions"),
    "engagement_rate_derived": ("engaged_sessions_derived", "sessions"),
    "sessionisation_disagreement_rate": ("sessions_split_by_gap", "sessions"),
    "revenue_per_session": ("session_revenue", "sessions"),
    "average_order_value": ("session_revenue", "transactions"),
    "purchase_conversion_rate": ("sessions_reaching_purchase", "sessions_starting_funnel"),
    "checkout_completion_rate": ("sessions_reaching_purchase", "sessions_reaching_begin_checkout"),
    "feature_adoption_rate": ("feature_adopters_7d", "adoption_base_users"),
    **{
        f"feature_adoption_rate_{f}": ("feature_adopters_7d", "adoption_base_users", f"t.feature_name = '{f}'")
        for f in ("site_search", "promotions", "product_list", "outbound_click")
    },
}

_GRAINS = ("day", "week", "month", "quarter", "year")


def _column(name: str, table: str, clock: str) -> str:
    grain = None
    if name.rpartition("__")[2] in _GRAINS:
        name, _, grain = name.rpartition("__")
    if name == "metric_time":
        column = f"t.{clock}"
    else:
        entity, _, dim = name.partition("__")
        alias = "t" if ENTITY[table] == entity else {"user": "u", "session": "s"}[entity]
        column = f"cast({alias}.step_number AS VARCHAR)" if dim == "step_position" else f"{alias}.{dim}"
    return f"cast(date_trunc('{grain}', {column}) AS DATE)" if grain else column


def _input(measure: str, flt: str | None, groups: list[str], where: str | None, start: str | None, end: str | None) -> str:
    table, aggregate, *own = MEASURES[measure]
    clock = own[0] if own else CLOCK[table]
    text = f"SELECT {''.join(_column(g, table, clock) + f' AS {g}, ' for g in groups)}{aggregate} AS v FROM {table} t"
    if table != "dim_users":
        text += " LEFT JOIN dim_users u ON u.user_pseudo_id = t.user_pseudo_id"
    if table in ("fct_events", "fct_funnel"):
        text += " LEFT JOIN fct_sessions s ON s.session_key = t.session_key"
    conditions = [flt] if flt else []
    if where:
        conditions.append(re.sub(r"\b\w+__\w+\b|\bmetric_time\b", lambda m: _column(m.group(0), table, clock), where))
    if start:
        conditions.append(f"t.{clock} >= DATE '{start}'")
    if end:
        conditions.append(f"t.{clock} <= DATE '{end}'")
    if conditions:
        text += " WHERE " + " AND ".join(f"({c})" for c in conditions)
    return text + (f" GROUP BY {', '.join(str(i) for i in range(1, len(groups) + 1))}" if groups else "")


def _inputs_of(metric: str) -> tuple[tuple[str, str | None], ...]:
    if metric in RATIOS:
        num, den, *flt = RATIOS[metric]
        (n,), (d,) = _inputs_of(num), _inputs_of(den)
        return (n[0], " AND ".join(x for x in (n[1], *flt) if x) or None), d
    return (SIMPLE.get(metric, (metric, None)),)


def metric_sql(
    cfg: EngineConfig, metrics: list[str], groups: list[str] | None = None, where: str | None = None,
    start: str | None = None, end: str | None = None, tail: str = "", measures: bool = False,
) -> str:
    groups = groups or []
    inputs: dict[tuple[str, str | None], str] = {}
    shown = []
    for m in metrics:
        parts = ((m, None),) if measures else _inputs_of(m)
        names = [inputs.setdefault(p, f"i{len(inputs)}") for p in parts]
        if len(names) == 2:
            shown.append(f"round({names[0]}.v / nullif(cast({names[1]}.v AS DOUBLE), 0), 7) AS {m}")
        elif parts[0][0] in DOUBLES:
            shown.append(f"round({names[0]}.v, 7) AS {m}")
        else:
            shown.append(f"{names[0]}.v AS {m}")
    subqueries = [f"{a} AS ({_input(x, f, groups, where, start, end)})" for (x, f), a in inputs.items()]
    if groups:
        keys = " UNION ".join(f"SELECT {', '.join(groups)} FROM {a}" for a in inputs.values())
        joins = "".join(
            f" LEFT JOIN {a} ON " + " AND ".join(f"{a}.{g} IS NOT DISTINCT FROM keys.{g}" for g in groups)
            for a in inputs.values()
        )
        select = f"SELECT {', '.join('keys.' + g for g in groups)}, {', '.join(shown)} FROM ({keys}) keys{joins}"
    else:
        select = f"SELECT {', '.join(shown)} FROM {', '.join(inputs.values())}"
    return with_tables(cfg, "").rstrip() + ",\n" + ",\n".join(subqueries) + f"\n{select} {tail}"
