"""§2.12: the 42 metrics, each with the text that goes out with its numbers."""

from __future__ import annotations

from footfall.plans.semantics import Metric

_STEP = "funnel_step__step_name = '{}'"
_FEATURE = "event__feature_name = '{}'"
_WINDOW_END = "Nothing is known about a user after the last day of the window."


def _component(of: str) -> dict[str, str]:
    return {
        "tradeoff": f"Published so that both sides of {of} can be inspected.",
        "breaks_if": f"It is quoted alone; read it as a part of {of}.",
    }


_VOLUME = (
    Metric(
        "new_users", "New users", "user", "Users who were seen arriving inside the window.",
        definition="Users with a session in the window, without those first touched before it opened.",
        assumption="One id is one person. It is one browser on one device, and clearing cookies makes a new one.",
        tradeoff="Derived from sessions instead of a client-side first-visit event, which blockers swallow; totals differ from the vendor's screen.",
        breaks_if="Censored users are let in: old users then look like arrivals on the first days and drag early cohorts down.",
        measure="new_users",
    ),
    Metric(
        "sessions", "Sessions", "session", "Number of sessions.",
        definition="Distinct pairs of user id and client session id.",
        assumption="The browser ends sessions where a human would.",
        tradeoff="Client ids match what people see elsewhere, at the price of a split at midnight; sessionisation_disagreement_rate says how much a rule of our own would change.",
        breaks_if="Sessions are re-cut by inactivity without saying so: every per-session rate moves at once.",
        measure="sessions",
    ),
    Metric(
        "revenue", "Revenue (USD)", "event", "Purchase revenue, taken from events.",
        definition="Sum of purchase revenue in USD over all events, with or without a session.",
        assumption="Each purchase event is a completed order; refunds do not appear in the data.",
        tradeoff="Order totals rather than item lines avoid counting twice, so there is no split by product.",
        breaks_if="It is summed over funnel rows, where each session appears once per step.",
        measure="event_revenue",
    ),
    Metric(
        "transactions", "Transactions", "session", "Orders, distinct within a session.",
        definition="Distinct transaction ids on purchase events of a session, summed over sessions.",
        assumption="Each order carries one transaction id of its own.",
        tradeoff="Reloading a confirmation page in one visit counts once, reopening it in a later visit counts again; in return the number adds up over days and channels.",
        breaks_if="It is read as orders placed. That needs a distinct count over the whole period, which does not add up over time.",
        measure="transactions",
    ),
)

_ACTIVATION = (
    Metric(
        "activation_eligible_users", "Activation-eligible users", "user",
        "New users whose activation window is over.",
        definition="New users first seen at least the activation window's number of days before the window ends.",
        assumption=_WINDOW_END,
        tradeoff="The newest cohorts are left out although they are the ones people ask about.",
        breaks_if="Open windows are let in: the last points of every chart then fall for no reason in the product.",
        measure="activation_eligible_users",
    ),
    Metric(
        "activated_users", "Activated users", "user", "Eligible users who bought within the activation window.",
        definition="Eligible new users whose first purchase came on day 0 to N after first being seen; N is 7 by default.",
        assumption="Buying is the moment the product pays off for the user.",
        tradeoff="As for activation_rate.", breaks_if="As for activation_rate.",
        measure="activated_users",
    ),
    Metric(
        "activation_rate", "Activation rate", "user", "Share of new users who buy within the activation window.",
        definition="activated_users over activation_eligible_users; censored users and open windows are on neither side.",
        assumption="Interested buyers need no more than the window to decide.",
        tradeoff="A purchase is hard to fake, unlike a cart add, but slow buyers count as failures and a broken checkout lowers the rate.",
        breaks_if="The window is widened for a better number: fewer cohorts stay eligible and the series ends earlier.",
        numerator="activated_users", denominator="activation_eligible_users",
    ),
    Metric(
        "avg_days_to_first_purchase", "Average days to first purchase", "user", "Mean wait of those who bought.",
        definition="Mean of the days from first being seen to the first purchase, over users with a purchase.",
        assumption="Users who never bought are absent, not infinitely late.",
        tradeoff="A few slow buyers pull the mean; it helps to choose the activation window and is no target.",
        breaks_if="It is told as the wait of the average customer.",
        measure="avg_days_to_first_purchase",
    ),
)


def _retention(n: int, days: str, rate: Metric) -> tuple[Metric, ...]:
    return (
        Metric(
            f"d{n}_eligible_users", f"D{n}-eligible users", "user",
            f"New users observed for at least {n} day{'s' if n > 1 else ''}.",
            definition=f"New users first seen {n} or more days before the window ends.",
            assumption=_WINDOW_END, **_component(rate.name), measure=f"d{n}_eligible_users",
        ),
        Metric(
            f"d{n}_retained_users", f"D{n}-retained users", "user", f"Eligible users who came back on {days}.",
            definition=f"Eligible users with a session on {days} after the day they were first seen.",
            assumption="Any session is a return, however short.",
            **_component(rate.name), measure=f"d{n}_retained_users",
        ),
        rate,
    )


_RETENTION = (
    *_retention(
        7, "any of days 1 to 7",
        Metric(
            "d7_retention_rate", "D7 retention rate", "user", "Share of new users back within seven days.",
            definition="d7_retained_users over d7_eligible_users; the day of arrival does not count.",
            assumption="A short return is worth as much as a long one.",
            tradeoff="Any day of the week counts, which is steadier than day 7 alone but higher, so it does not compare with exact-day figures.",
            breaks_if="Day 0 is counted: every user has a session then and the rate is exactly 100 %.",
            numerator="d7_retained_users", denominator="d7_eligible_users",
        ),
    ),
    *_retention(
        1, "day 1",
        Metric(
            "d1_retention_rate", "D1 retention rate", "user", "Share of new users back the next day.",
            definition="d1_retained_users over d1_eligible_users; days are UTC calendar days.",
            assumption="A calendar day is a fair step.",
            tradeoff="Arriving just before midnight and returning just after counts as retained.",
            breaks_if="The day boundary moves to another time zone: history shifts with it.",
            numerator="d1_retained_users", denominator="d1_eligible_users",
        ),
    ),
    *_retention(
        30, "any of days 1 to 30",
        Metric(
            "d30_retention_rate", "D30 retention rate", "user", "Share of new users back within thirty days.",
            definition="d30_retained_users over d30_eligible_users.",
            assumption="The D7 reasoning holds over thirty days.",
            tradeoff="Needs thirty observed days, so a short window leaves few cohorts.",
            breaks_if="It is cut by several dimensions at once; the groups get too small.",
            numerator="d30_retained_users", denominator="d30_eligible_users",
        ),
    ),
)

_ENGAGEMENT = (
    Metric(
        "session_depth", "Session depth (events per session)", "session", "Events per session.",
        definition="session_events over sessions.",
        assumption="All events weigh the same, although automatic ones are a large part.",
        tradeoff="Sees activity on single-page flows that page views miss, but follows the tagging.",
        breaks_if="It is compared across a change of tagging.",
        numerator="session_events", denominator="sessions",
    ),
    Metric(
        "session_events", "Events in sessions", "session", "Events that belong to a session.",
        definition="Sum of events per session.", assumption="Each event belongs to the session it names.",
        tradeoff="Automatic events are in.", breaks_if="It is held against a differently filtered event count.",
        measure="session_events",
    ),
    Metric(
        "engagement_rate", "Engagement rate (client flag)", "session", "Share of sessions flagged as engaged.",
        definition="engaged_sessions over sessions, by the flag the client sends.",
        assumption="The flag arrived.",
        tradeoff="Matches the vendor's screen; engagement_rate_derived shows what a rule over the rows gives.",
        breaks_if="It is compared with the derived rate without saying which is which.",
        numerator="engaged_sessions", denominator="sessions",
    ),
    Metric(
        "engagement_rate_derived", "Engagement rate (derived)", "session", "Share of sessions engaged by the recomputed rule.",
        definition="engaged_sessions_derived over sessions.",
        assumption="Last event minus first event is the time on site; a single event has none.",
        tradeoff="A control on the client flag, not a headline.", breaks_if="It replaces the flag unannounced.",
        numerator="engaged_sessions_derived", denominator="sessions",
    ),
    Metric(
        "sessionisation_disagreement_rate", "Sessionisation disagreement rate", "session",
        "Share of sessions an inactivity rule would cut.",
        definition="sessions_split_by_gap over sessions.",
        assumption="A long pause means the user left; a tab in the background looks the same.",
        tradeoff="Measures the data, not the product: it backs the choice of client sessions with a number.",
        breaks_if="It lands on a business dashboard.",
        numerator="sessions_split_by_gap", denominator="sessions",
    ),
    Metric(
        "engaged_sessions", "Engaged sessions (client flag)", "session", "Sessions flagged as engaged by the client.",
        definition="Sessions with the engaged flag on at least one event.", assumption="The flag arrived.",
        **_component("engagement_rate"), measure="engaged_sessions",
    ),
    Metric(
        "engaged_sessions_derived", "Engaged sessions (derived)", "session", "Sessions engaged by the recomputed rule.",
        definition="Sessions of 10 seconds or more, or with two page views, or with a purchase.",
        assumption="Last event minus first event is the time on site.",
        **_component("engagement_rate_derived"), measure="engaged_sessions_derived",
    ),
    Metric(
        "sessions_split_by_gap", "Sessions a gap rule would split", "session", "Sessions with a long pause inside.",
        definition="Sessions in which more whole minutes than the threshold lie between two consecutive events.",
        assumption="A long pause means the user left.",
        **_component("sessionisation_disagreement_rate"), measure="sessions_split_by_gap",
    ),
    Metric(
        "session_revenue", "Session revenue (USD)", "session", "Purchase revenue, taken from sessions.",
        definition="Sum of the revenue of purchase events in sessions.",
        assumption="Revenue belongs to the session of the purchase.",
        tradeoff="Keeps both sides of per-session ratios on one grain; purchases without a session are only in revenue.",
        breaks_if="It is summed over funnel rows.",
        measure="session_revenue",
    ),
    Metric(
        "revenue_per_session", "Revenue per session (USD)", "session", "Session revenue per session.",
        definition="session_revenue over sessions.", assumption="Revenue belongs to the session of the purchase.",
        tradeoff="Earlier visits that led to the purchase get no credit.",
        breaks_if="Channels are compared with it: the channel is the user's first touch and keeps all later credit.",
        numerator="session_revenue", denominator="sessions",
    ),
    Metric(
        "average_order_value", "Average order value (USD)", "session", "Session revenue per transaction.",
        definition="session_revenue over transactions.", assumption="Both sides cover the same orders.",
        tradeoff="Session-scoped transactions stay right in any cut but exceed the number of orders, so the value is on the low side.",
        breaks_if="It is held against an order system, which counts each order once.",
        numerator="session_revenue", denominator="transactions",
    ),
)


def _reaching(step: str, position: int, words: str) -> Metric:
    return Metric(
        f"sessions_reaching_{step}", f"Sessions reaching {step.replace('_', ' ')}", "session",
        f"Sessions that {words}, after every earlier step.",
        definition=f"Sessions in sequence at step {position}.", assumption="The steps have one order.",
        tradeoff="As for purchase_conversion_rate.",
        breaks_if="It is mixed with the permissive count, which ignores earlier steps.",
        measure="funnel_sessions_in_sequence", where=_STEP.format(step),
    )


_FUNNEL = (
    _reaching("view_item", 2, "viewed an item"),
    _reaching("add_to_cart", 3, "added to the cart"),
    _reaching("begin_checkout", 4, "began checkout"),
    _reaching("purchase", 5, "purchased"),
    Metric(
        "sessions_starting_funnel", "Sessions entering the funnel", "session", "Sessions with the entry event.",
        definition="Sessions in sequence at step 1.",
        assumption="Each session fires the entry event; some lose it.",
        tradeoff="Used as the funnel's base instead of sessions, so that each step is measured alike.",
        breaks_if="It is swapped for sessions; the difference then reads as a loss at the first step.",
        measure="funnel_sessions_in_sequence", where=_STEP.format("session_start"),
    ),
    Metric(
        "purchase_conversion_rate", "Session purchase conversion rate", "session",
        "Share of funnel sessions that purchase in sequence.",
        definition="sessions_reaching_purchase over sessions_starting_funnel.",
        assumption="The whole journey happens in one session.",
        tradeoff="The strict count is on the low side, since carts outlive sessions; it never exceeds the step before.",
        breaks_if="The permissive flag is used on one side.",
        numerator="sessions_reaching_purchase", denominator="sessions_starting_funnel",
    ),
    Metric(
        "checkout_completion_rate", "Checkout completion rate", "session", "Share of checkouts that end in a purchase.",
        definition="sessions_reaching_purchase over sessions_reaching_begin_checkout.",
        assumption="A dropped checkout is a product matter; failed payments look the same.",
        tradeoff="The nearest pair of steps is easy to act on, with the smallest base.",
        breaks_if="It is cut finely on a single day.",
        numerator="sessions_reaching_purchase", denominator="sessions_reaching_begin_checkout",
    ),
)


def _adoption_of(feature: str, words: str, assumption: str, tradeoff: str, breaks_if: str) -> Metric:
    return Metric(
        f"feature_adoption_rate_{feature}", f"Feature adoption rate: {feature.replace('_', ' ')}", "user",
        f"Share of new users who {words} within seven days.",
        definition=f"feature_adoption_rate with only {feature} in the numerator; the base stays whole.",
        assumption=assumption, tradeoff=tradeoff, breaks_if=breaks_if,
        numerator="feature_adopters_7d", denominator="adoption_base_users",
        numerator_where=_FEATURE.format(feature),
    )


_ADOPTION = (
    Metric(
        "feature_adopters_7d", "Feature adopters (first 7 days)", "user", "Users who chose to use a feature early on.",
        definition="Distinct eligible users with a deliberate feature event on days 0 to 7.",
        assumption="Using a feature once is adopting it.",
        tradeoff="As for feature_adoption_rate.", breaks_if="As for feature_adoption_rate.",
        measure="feature_adopters_7d",
    ),
    Metric(
        "adoption_base_users", "Adoption base users", "user", "Eligible users: the base of adoption.",
        definition="Distinct users who are not censored and were observed for seven days.",
        assumption=_WINDOW_END,
        tradeoff="Counted on events, so that it shares path and date with the adopters.",
        breaks_if="new_users takes its place: the two differ a little and a small group can then exceed 1.",
        measure="adoption_base_users",
    ),
    Metric(
        "feature_adoption_rate", "Feature adoption rate (first 7 days)", "user",
        "Share of new users who chose to use any feature early on; do not group it by feature.",
        definition="feature_adopters_7d over adoption_base_users.",
        assumption="The feature catalogue is complete and tells actions from impressions.",
        tradeoff="Impressions are out, since they would lift adoption to nearly all; features meant to be seen cannot be measured so.",
        breaks_if="It is grouped by feature: the base then shrinks to the feature's own users and the rate runs to 1. Use the per-feature rates.",
        numerator="feature_adopters_7d", denominator="adoption_base_users",
    ),
    _adoption_of(
        "site_search", "searched the site", "Whoever sees results has searched.",
        "The clearest deliberate action; empty results count too.", "Suggestions while typing start to fire the event.",
    ),
    _adoption_of(
        "promotions", "clicked a promotion", "A click on a promotion is meant.",
        "Shows why views and clicks are kept apart.", "The view event is marked as deliberate.",
    ),
    _adoption_of(
        "product_list", "opened an item from a list", "Opening an item from a list is more than moving about.",
        "A weak signal of high volume, useful as a yardstick.", "It is taken as proof that discovery works.",
    ),
    _adoption_of(
        "outbound_click", "left by a link", "Leaving by a link is meant.",
        "Low volume, kept as an example of it.", "It is cut by anything.",
    ),
)

METRICS = _VOLUME + _ACTIVATION + _RETENTION + _ENGAGEMENT + _FUNNEL + _ADOPTION
