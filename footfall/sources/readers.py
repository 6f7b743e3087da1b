"""Scans and small declared relations."""

from __future__ import annotations

import csv
from datetime import date
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.config import EngineConfig
from footfall.sources.schema import EVENT_SCHEMA, FEATURE_SCHEMA

SHIPPED_SEED = Path(__file__).resolve().parent.parent / "seeds" / "feature_catalogue.csv"


def pin_utc(spark: SparkSession) -> SparkSession:
    """All days and instants are UTC; make the session agree."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def in_window(events: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Keep days between both ends of the window, inclusive; with ``every_row`` all rows, also those without a day.

    The bounds are literals on the raw day text, so a directory laid out by
    ``event_date`` is pruned when the plan is built.
    """
    if cfg.every_row:
        return events
    return events.where(F.col("event_date").between(cfg.window_start_text, cfg.window_end_text))


def read_export(spark: SparkSession, path: str) -> DataFrame:
    """The nested event export, as one Parquet directory for all days."""
    return pin_utc(spark).read.schema(EVENT_SCHEMA).parquet(path)


def read_events(spark: SparkSession, path: str, cfg: EngineConfig) -> DataFrame:
    """The export's days inside the window."""
    return in_window(read_export(spark, path), cfg)


def read_feature_catalogue(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Event -> feature mapping with declared types.

    Without a path the shipped seed is used; its few rows are read here, as
    executors need not have this package's files. No broadcast hint is given at
    the joins: both forms carry a size statistic, so Spark broadcasts them while
    they are under ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges a
    larger one.
    """
    if path is not None:
        return spark.read.schema(FEATURE_SCHEMA).csv(path, header=True)
    with SHIPPED_SEED.open(newline="") as file:
        quoted = [[F.lit(v) for v in row.values()] for row in csv.DictReader(file)]
    rows = [F.struct(*[v.cast(f.dataType).alias(f.name) for v, f in zip(row, FEATURE_SCHEMA, strict=True)]) for row in quoted]
    return spark.range(1).select(F.inline(F.array(*rows)))


# The first and the last day that a calendar has at least.
SPINE_START, SPINE_END = date(2019, 1, 1), date(2026, 12, 31)


def time_spine(spark: SparkSession, start: date = SPINE_START, end: date = SPINE_END) -> DataFrame:
    """One row per day, both ends included; wider than any window on purpose."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(days).alias("date_day"))
