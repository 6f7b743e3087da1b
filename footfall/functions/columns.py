"""Column helpers. Everything here is a built-in Spark expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_TOKEN = "<null>"


# -- P02-P05: values out of the repeated key/value record ---------------------

def _first_param(key: str, params: str) -> Column:
    """First entry for ``key`` in array order; NULL when the key is absent.

    The array is not turned into a map: a key may repeat, and a map build
    raises on a repeated key. Position 0 means absent, and index -1 is NULL.
    Unlike a lambda over the array, this stays in generated code.
    """
    position = F.array_position(F.col(f"{params}.key"), key)
    return F.get(F.col(params), (position - 1).cast("int"))["value"]


def param_string(key: str, params: str = "event_params") -> Column:
    return _first_param(key, params)["string_value"]


def param_int(key: str, params: str = "event_params") -> Column:
    return _first_param(key, params)["int_value"]


def param_float(key: str, params: str = "event_params") -> Column:
    value = _first_param(key, params)
    return F.coalesce(value["float_value"], value["double_value"])


# -- P07, P08: keys ------------------------------------------------------------

def surrogate_key(columns: Sequence[Column]) -> Column:
    """Hash of several fields in which NULL and the empty string differ."""
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_TOKEN)) for c in columns]
    return F.md5(F.concat_ws("-", *parts))


def composite_key(left: Column, right: Column) -> Column:
    """``left-right``, NULL as soon as one side is NULL."""
    return F.concat(left, F.lit("-"), right.cast("string"))


# -- X03-X05: time arithmetic --------------------------------------------------

def utc_day(ts: Column) -> Column:
    return F.to_date(ts)


def whole_minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MINUTE", start, end)


def whole_seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def start_of(grain: str, day: Column) -> Column:
    """First day of the enclosing day, week (Monday), month, quarter or year."""
    return F.to_date(F.date_trunc(grain, day))


# -- X13 -----------------------------------------------------------------------

def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """NULL on an empty denominator, never an error or infinity."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
