"""Binding of the driver's flat ``events`` table to the nested event export.

The flat rows are reshaped into the export's own layout (nested records, a
repeated key/value list), so every query below goes through the same staging
projection that real exports do.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.config import EngineConfig
from footfall.sources.readers import pin_utc
from footfall.sources.schema import PARAMS

# Two windows: the first closes every cohort, the second leaves some open.
W1 = EngineConfig(date(2024, 1, 3), date(2024, 2, 5), session_gap_minutes=1440)
W2 = EngineConfig(date(2024, 1, 3), date(2024, 1, 12), session_gap_minutes=1440)

_EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

_PARAM_VALUE = "struct<string_value:string,int_value:bigint,float_value:double,double_value:double>"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _flat_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = pin_utc(spark).read.schema(_EVENTS_DDL).parquet(f"{sf_dir}/events.parquet")
    return events.select(
        F.date_format("ts", "yyyyMMdd").alias("event_date"),
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    ).withColumn("user_pseudo_id", _user_pseudo_id())


def _user_pseudo_id() -> Column:
    return F.concat(F.col("user_id").cast("string"), F.lit("-"), (F.col("k") % 5).cast("string"))


def _event_name() -> Column:
    kind, k = F.col("event_type"), F.col("k")

    def pick(first_below: int, first: str, second_below: int, second: str, rest: str) -> Column:
        return F.when(k < first_below, first).when(k < second_below, second).otherwise(rest)

    return (
        F.when(kind == "view", pick(60, "session_start", 80, "page_view", "view_promotion"))
        .when(kind == "click", pick(70, "view_item", 90, "select_item", "click"))
        .when(kind == "signup", F.when(k < 80, "add_to_cart").otherwise("view_search_results"))
        .when(kind == "error", F.when(k < 80, "begin_checkout").otherwise("select_promotion"))
        .otherwise("purchase")
    )


def _param(key: str, **values: Column) -> Column:
    parts = [
        values.get(field, F.lit(None)).cast(kind).alias(field)
        for field, kind in (
            ("string_value", "string"), ("int_value", "bigint"),
            ("float_value", "double"), ("double_value", "double"),
        )
    ]
    return F.struct(F.lit(key).alias("key"), F.struct(*parts).cast(_PARAM_VALUE).alias("value"))


def _params_if(condition: Column, *params: Column) -> Column:
    return F.when(condition, F.array(*params)).otherwise(F.array().cast(PARAMS))


def _label(prefix: str, modulus: int) -> Column:
    return F.concat(F.lit(prefix), (F.col("user_id") % modulus).cast("string"))


def raw_events(
    spark: SparkSession, sf_dir: str, keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df
) -> DataFrame:
    """All driver events in the export layout. First touch is taken over the whole table.

    ``keep`` may write the first touches before they are joined. The join then
    shuffles both sides, which lets AQE split the events of a very busy user.
    It may also lay out the joined rows by day. They are flat still: the nested
    records, several times as wide, are made as the rows are read and meet no sort.
    """
    flat = _flat_events(spark, sf_dir)
    touch = keep("first_touch", flat.groupBy("user_pseudo_id").agg(F.min("ts").alias("first_ts")))
    k, value = F.col("k"), F.col("value")
    session = F.when(k < 97, F.expr("datediff(cast(ts as date), date'1970-01-01') div 4"))
    is_purchase = F.col("event_type") == "purchase"
    page = F.when(k % 7 != 0, F.concat(F.lit("/p/"), (k % 20).cast("string")))
    params = F.concat(
        _params_if(
            session.isNotNull(), _param("ga_session_id", int_value=session),
            _param("ga_session_number", int_value=session - 4930),
        ),
        _params_if(page.isNotNull(), _param("page_location", string_value=page)),
        # a repeated key, as the export may carry; the first one counts
        _params_if(page.isNotNull() & (k % 10 == 0), _param("page_location", string_value=F.lit("/again"))),
        _params_if(F.lit(True), _param("engagement_time_msec", int_value=F.floor(value * 1000))),
        _params_if(value >= 50, _param("session_engaged", string_value=F.lit("1"))),
        _params_if(k % 2 == 0, _param("score", double_value=k.cast("double"))),
        _params_if(k % 2 == 1, _param("score", float_value=k.cast("double") + 0.5)),
    )
    # the user's text is left out, as the columns it is made of are there
    joined = keep("export", flat.join(touch, "user_pseudo_id", "left").drop("user_pseudo_id")).withColumn("user_pseudo_id", _user_pseudo_id())
    return joined.select(
        "event_date",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("event_timestamp"),
        _event_name().alias("event_name"),
        F.col("event_id").alias("event_bundle_sequence_id"),
        F.lit(None).cast("double").alias("event_value_in_usd"),
        "user_pseudo_id",
        F.unix_micros(F.col("first_ts").cast("timestamp")).alias("user_first_touch_timestamp"),
        F.lit("1").alias("stream_id"),
        F.lit("WEB").alias("platform"),
        params.alias("event_params"),
        F.struct(
            F.when(F.col("user_id") % 3 == 0, "desktop")
            .when(F.col("user_id") % 3 == 1, "mobile").otherwise("tablet").alias("category"),
            _label("os_", 4).alias("operating_system"),
            F.lit(None).cast("string").alias("language"),
            F.struct(_label("browser_", 3).alias("browser")).alias("web_info"),
        ).alias("device"),
        F.struct(
            _label("country_", 7).alias("country"), _label("region_", 5).alias("region"),
            _label("city_", 11).alias("city"),
        ).alias("geo"),
        F.struct(
            _label("source_", 6).alias("source"), _label("medium_", 4).alias("medium"),
            _label("campaign_", 3).alias("name"),
        ).alias("traffic_source"),
        F.struct(
            F.when(is_purchase, F.concat(F.lit("T"), (k % 50).cast("string"))).alias("transaction_id"),
            F.when(is_purchase, value).alias("purchase_revenue_in_usd"),
            F.when(is_purchase, (1 + k % 3).cast("bigint")).alias("total_item_quantity"),
            F.when(is_purchase, F.lit(1).cast("bigint")).alias("unique_items"),
        ).alias("ecommerce"),
        F.when(
            is_purchase,
            F.array_repeat(F.struct(F.lit("sku").alias("item_id")), 1 + k % 3),
        ).alias("items"),
    )
