"""The product-analytics layer bound to a set of marts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from footfall.plans.marts import Marts
from footfall.plans.metric_definitions import METRICS
from footfall.plans.metric_query import MetricLayer
from footfall.plans.models import MODELS
from footfall.plans.semantics import Definitions

PRODUCT_ANALYTICS = Definitions(MODELS, METRICS)


def metric_layer(marts: Marts, spine: Callable[[], DataFrame] | None = None) -> MetricLayer:
    """spine: a calendar other than the shared one."""
    return MetricLayer(PRODUCT_ANALYTICS, marts, spine=spine or (lambda: marts["time_spine"]))
