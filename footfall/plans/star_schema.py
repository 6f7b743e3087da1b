"""The metric layer bound to a second, unrelated source: customers, orders, lines.

Nothing in the resolver knows about web events; these definitions only name
other tables. Line rows have no unique column, so they get no key and are
counted as rows.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from footfall.plans.metric_query import MetricLayer
from footfall.plans.semantics import Definitions, Dimension, ForeignEntity, Measure, Metric, SemanticModel
from footfall.sources.driver_tables import read_table

_NET = "cast(l_extendedprice as decimal(12,2)) * (1 - cast(l_discount as decimal(4,2)))"

CUSTOMERS = SemanticModel(
    "customers", "customer", "user", "c_custkey", None,
    dimensions=(Dimension("segment", expr="c_mktsegment"), Dimension("nation", expr="cast(c_nationkey as bigint)")),
    measures=(
        Measure("customers", "count_distinct", "c_custkey"),
        Measure("account_balance", "sum", "cast(c_acctbal as decimal(12,2))"),
    ),
)

ORDERS = SemanticModel(
    "orders", "orders", "session", "o_orderkey", "cast(o_orderdate as date)",
    foreign=(ForeignEntity("user", "o_custkey"),),
    dimensions=(
        Dimension("order_date", "time", "cast(o_orderdate as date)"),
        Dimension("status", expr="o_orderstatus"),
        Dimension("priority", expr="o_orderpriority"),
    ),
    measures=(
        Measure("orders", "count_distinct", "o_orderkey"),
        Measure("order_value", "sum", "cast(o_totalprice as decimal(12,2))"),
        Measure("buyers", "count_distinct", "o_custkey"),
        Measure("order_statuses", "count_distinct", "o_orderstatus"),
        Measure("large_order_buyers", "count_distinct", "o_custkey", when="o_totalprice > 200000"),
    ),
)

LINES = SemanticModel(
    "lines", "lineitem", "event", None, "cast(l_shipdate as date)",
    foreign=(ForeignEntity("session", "l_orderkey"),),
    dimensions=(Dimension("return_flag", expr="l_returnflag"), Dimension("line_status", expr="l_linestatus")),
    measures=(
        Measure("lines", "count", "l_orderkey"),
        Measure("net_revenue", "sum", _NET),
        Measure("avg_quantity", "average", "l_quantity"),
        Measure("shipped_orders", "count_distinct", "l_orderkey"),
    ),
)


def _metric(name: str, grain: str, **kind: str) -> Metric:
    words = name.replace("_", " ")
    return Metric(
        name, words.capitalize(), grain, f"{words.capitalize()}.", definition=words,
        assumption="Keys are unique and none dangles.", tradeoff="None.", breaks_if="Keys repeat.", **kind,
    )


METRICS = (
    _metric("customers", "user", measure="customers"),
    _metric("orders", "session", measure="orders"),
    _metric("order_value", "session", measure="order_value"),
    _metric("buyers", "user", measure="buyers"),
    _metric("order_statuses", "session", measure="order_statuses"),
    _metric("large_order_buyers", "user", measure="large_order_buyers"),
    _metric("lines", "event", measure="lines"),
    _metric("net_revenue", "event", measure="net_revenue"),
    _metric("avg_quantity", "event", measure="avg_quantity"),
    _metric("shipped_orders", "session", measure="shipped_orders"),
    _metric("average_order_value", "session", numerator="order_value", denominator="orders"),
    _metric("lines_per_order", "event", numerator="lines", denominator="orders"),
    _metric("large_buyer_share", "user", numerator="large_order_buyers", denominator="buyers"),
    _metric(
        "returned_share", "event", numerator="lines", denominator="lines",
        numerator_where="event__return_flag = 'R'",
    ),
)

STAR = Definitions((CUSTOMERS, ORDERS, LINES), METRICS)


def star_layer(spark: SparkSession, sf_dir: str) -> MetricLayer:
    tables = {m.table: read_table(spark, sf_dir, m.table) for m in STAR.models.values()}
    return MetricLayer(STAR, tables)
