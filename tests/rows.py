"""Hand-made event rows in the export layout."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from footfall.sources.schema import EVENT_SCHEMA

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def micros(at: str) -> int:
    """'2020-12-01 10:00:00[.ffffff]' (UTC) as microseconds since the epoch."""
    return (datetime.fromisoformat(at).replace(tzinfo=timezone.utc) - _EPOCH) // timedelta(microseconds=1)


def param(key, text=None, number=None, single=None, double=None):
    return (key, (text, number, single, double))


def event(user, at, name="page_view", session=1, page="/home", engaged=None, msec=None, first_touch=None,
          transaction=None, revenue=None, device="desktop", source="google", extra=(), bundle=1):
    params = [param("page_title", text="t")]
    if session is not None:
        params += [param("ga_session_id", number=session), param("ga_session_number", number=1)]
    if page is not None:
        params.append(param("page_location", text=page))
    if engaged is not None:
        params.append(param("session_engaged", text=engaged))
    if msec is not None:
        params.append(param("engagement_time_msec", number=msec))
    params += list(extra)
    return (
        at[:10].replace("-", ""), micros(at), name, bundle, None, user,
        micros(first_touch) if first_touch else None, "s", "WEB", params,
        (device, "Linux", "en", ("Firefox",)), ("Chile", "r", "c"), (source, "organic", "(none)"),
        (transaction, revenue, 1 if transaction else None, 1 if transaction else None),
        [("i1",), ("i2",)] if transaction else None,
    )


def export(spark, rows):
    return spark.createDataFrame(rows, EVENT_SCHEMA)
