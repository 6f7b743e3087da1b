"""§2.10 and §2.11: the four semantic models with their 29 measures."""

from __future__ import annotations

from footfall.config import ADOPTION_WINDOW_DAYS
from footfall.plans.semantics import Dimension, ForeignEntity, Measure, SemanticModel


# What each dimension tells, under whatever model it is offered.
MEANING = {
    "acquisition_campaign": "Campaign that brought the user's first session.",
    "acquisition_medium": "Medium that brought the user's first session.",
    "acquisition_source": "Source that brought the user's first session.",
    "browser": "Browser of the first event.",
    "country": "Country of the first event, by address.",
    "device_category": "Desktop, mobile or tablet.",
    "event_date": "Day of the event, UTC.",
    "event_name": "What was logged.",
    "feature_name": "Feature that the event belongs to, if any.",
    "first_country": "Country of the user's first session.",
    "first_device_category": "Kind of device of the user's first session.",
    "first_operating_system": "System of the user's first session.",
    "first_seen_date": "Day of the user's first session inside the window.",
    "first_touch_medium": "Medium that the export attributes to the user.",
    "funnel_step_name": "Funnel step that the event is, if any.",
    "has_full_activation_window": "Were all days observed in which the user could become active?",
    "has_full_d30_window": "Were thirty days after arrival observed?",
    "has_full_d7_window": "Were seven days after arrival observed?",
    "has_purchase": "Did the session include a purchase?",
    "is_activated": "Did the user buy within the activation window?",
    "is_cohort_eligible": "May the user count as newly arrived?",
    "is_engaged_session": "Did the client flag the session as engaged?",
    "is_engaged_session_derived": "Is it engaged by length, page views or a purchase?",
    "is_first_session": "Is it the user's first one inside the window?",
    "is_left_censored": "Was the user there before the window began?",
    "is_retained_d7": "Did the user come back on days 1 to 7?",
    "is_split_by_inactivity_rule": "Does a pause inside the session exceed the limit?",
    "is_user_initiated_feature": "Is the event a deliberate use of its feature?",
    "landing_page": "First page of the session.",
    "last_seen_date": "Day of the user's last session inside the window.",
    "operating_system": "System of the device.",
    "session_date": "Day on which the session began, UTC.",
    "step_name": "Name of the funnel step.",
    "step_position": "Place of the step in the funnel, as text.",
    "user_first_seen_date": "Day on which the session's or event's user arrived.",
}


def _dims(*names: str) -> tuple[Dimension, ...]:
    return tuple(Dimension(n, description=MEANING[n]) for n in names)


def _times(*names: str) -> tuple[Dimension, ...]:
    return tuple(Dimension(n, "time", description=MEANING[n]) for n in names)


def _flag(name: str, condition: str, description: str) -> Measure:
    """Rows for which a condition holds; NULL counts as not holding."""
    return Measure(name, "sum", f"case when {condition} then 1 else 0 end", description=description)


def _cohort(name: str, window: str, also: str | None, description: str) -> Measure:
    """Eligibility is part of the measure, so no caller can leave it out."""
    parts = ([also] if also else []) + ["not is_left_censored", window]
    return _flag(name, " and ".join(parts), description)


USERS = SemanticModel(
    name="users",
    table="dim_users",
    entity="user",
    key="user_pseudo_id",
    time="first_seen_date",
    description="One row per user, dated by the day the user arrived.",
    dimensions=_times("first_seen_date", "last_seen_date")
    + _dims(
        "acquisition_source", "acquisition_medium", "acquisition_campaign", "first_device_category",
        "first_operating_system", "first_country", "is_left_censored", "has_full_activation_window",
        "has_full_d7_window", "has_full_d30_window", "is_cohort_eligible", "is_activated", "is_retained_d7",
    ),
    measures=(
        Measure("all_users", "count_distinct", "user_pseudo_id", description="Users, censored ones included."),
        _flag("new_users", "not is_left_censored", "Users first seen inside the window."),
        _cohort("activation_eligible_users", "has_full_activation_window", None, "New users whose activation window is over."),
        _cohort("activated_users", "has_full_activation_window", "is_activated", "Eligible users who bought in time."),
        _cohort("d1_eligible_users", "has_full_d1_window", None, "New users observed for a day."),
        _cohort("d1_retained_users", "has_full_d1_window", "is_retained_d1", "Of these, back on day 1."),
        _cohort("d7_eligible_users", "has_full_d7_window", None, "New users observed for seven days."),
        _cohort("d7_retained_users", "has_full_d7_window", "is_retained_d7", "Of these, back on days 1 to 7."),
        _cohort("d30_eligible_users", "has_full_d30_window", None, "New users observed for thirty days."),
        _cohort("d30_retained_users", "has_full_d30_window", "is_retained_d30", "Of these, back on days 1 to 30."),
        Measure("user_lifetime_revenue", "sum", "lifetime_revenue_usd", description="Revenue per user, summed."),
        Measure("avg_days_to_first_purchase", "average", "days_to_first_purchase", description="Mean over buyers."),
    ),
)

SESSIONS = SemanticModel(
    name="sessions",
    table="fct_sessions",
    entity="session",
    key="session_key",
    time="session_date",
    description="One row per session.",
    foreign=(ForeignEntity("user", "user_pseudo_id"),),
    dimensions=_times("session_date", "user_first_seen_date")
    + _dims(
        "device_category", "operating_system", "browser", "country", "acquisition_source",
        "acquisition_medium", "acquisition_campaign", "landing_page", "is_engaged_session",
        "is_engaged_session_derived", "is_first_session", "is_split_by_inactivity_rule",
        "is_cohort_eligible", "has_purchase",
    ),
    measures=(
        Measure("sessions", "count_distinct", "session_key", description="Sessions."),
        Measure("session_events", "sum", "events_in_session", description="Events in sessions."),
        Measure("session_page_views", "sum", "page_views", description="Page views in sessions."),
        _flag("engaged_sessions", "is_engaged_session", "Sessions the client flagged as engaged."),
        _flag("engaged_sessions_derived", "is_engaged_session_derived", "Sessions engaged by the recomputed rule."),
        _flag("sessions_split_by_gap", "is_split_by_inactivity_rule", "Sessions with an inactivity gap inside."),
        Measure("session_duration_seconds", "sum", "session_duration_seconds", description="Time between first and last event."),
        _flag("purchasing_sessions", "has_purchase", "Sessions with a purchase."),
        Measure("session_revenue", "sum", "session_revenue_usd", description="Revenue of sessions."),
        Measure("transactions", "sum", "transactions", description="Transactions, distinct within each session."),
    ),
)

EVENTS = SemanticModel(
    name="events",
    table="fct_events",
    entity="event",
    key="event_key",
    time="event_date",
    description="One row per event, with the cohort of its user.",
    foreign=(ForeignEntity("session", "session_key"), ForeignEntity("user", "user_pseudo_id")),
    dimensions=_times("event_date", "user_first_seen_date")
    + _dims(
        "event_name", "feature_name", "is_user_initiated_feature", "funnel_step_name", "device_category",
        "operating_system", "browser", "country", "first_touch_medium", "is_left_censored",
        "has_full_d7_window",
    ),
    measures=(
        Measure("events", "count", "event_key", description="Events."),
        Measure("event_users", "count_distinct", "user_pseudo_id", description="Users with any event."),
        Measure(
            "feature_adopters_7d", "count_distinct", "user_pseudo_id",
            when=f"is_user_initiated_feature and days_since_first_session between 0 and {ADOPTION_WINDOW_DAYS}"
            " and not is_left_censored and has_full_d7_window",
            time="user_first_seen_date",
            conditioned_on=("event__is_user_initiated_feature", "event__feature_name", "event__event_name"),
            description="Eligible users who chose to use a feature on days 0 to 7; dated by arrival.",
        ),
        Measure(
            "adoption_base_users", "count_distinct", "user_pseudo_id",
            when="not is_left_censored and has_full_d7_window",
            time="user_first_seen_date",
            description="Eligible users, as seen from events; dated by arrival.",
        ),
        Measure("event_revenue", "sum", "purchase_revenue_usd", description="Revenue of events."),
    ),
)

FUNNEL = SemanticModel(
    name="funnel",
    table="fct_funnel",
    entity="funnel_step",
    key="funnel_key",
    time="session_date",
    description="Five rows per session, one per funnel step.",
    foreign=(ForeignEntity("session", "session_key"), ForeignEntity("user", "user_pseudo_id")),
    dimensions=_times("session_date", "user_first_seen_date")
    + _dims("step_name")
    + (Dimension("step_position", expr="cast(step_number as string)", description=MEANING["step_position"]),)
    + _dims("device_category", "operating_system", "browser", "country", "acquisition_medium", "is_cohort_eligible"),
    measures=(
        _flag("funnel_sessions_reached", "is_reached", "Sessions that fired the step at all."),
        _flag("funnel_sessions_in_sequence", "is_reached_in_sequence", "Sessions that fired it and all before it."),
    ),
)

MODELS = (USERS, SESSIONS, EVENTS, FUNNEL)
