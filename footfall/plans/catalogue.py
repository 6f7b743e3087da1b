"""The definitions themselves as DataFrames."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.plans.metric_query import MetricLayer, Refused, as_list
from footfall.plans.semantics import Definitions


def metric_catalogue(spark: SparkSession, definitions: Definitions) -> DataFrame:
    """One row per metric: text, inputs, built-in filter and the models behind it."""
    rows = [
        (
            m.name, m.label, m.type, m.grain, m.description, m.definition, m.assumption, m.tradeoff,
            m.breaks_if, m.measure, m.numerator, m.denominator, m.where or m.numerator_where,
            sorted(definitions.measures_behind(m.name)), sorted(definitions.models_behind(m.name)),
        )
        for m in definitions.metrics.values()
    ]
    return spark.createDataFrame(
        rows,
        "name string, label string, type string, grain string, description string, definition string,"
        " assumption string, tradeoff string, breaks_if string, measure string, numerator string,"
        " denominator string, built_in_filter string, measures array<string>, semantic_models array<string>",
    )


def list_metrics(spark: SparkSession, definitions: Definitions, search: str = "") -> DataFrame:
    """By name, optionally those whose name, label or description contain a text."""
    text = F.lower(F.concat_ws(" ", "name", "label", "description"))
    return (
        metric_catalogue(spark, definitions)
        .where(text.contains(search.lower().strip()))
        .select("name", "label", "type", "grain", "description")
        .orderBy("name")
    )


def _refusal(layer: MetricLayer, names: list[str]) -> dict[str, Any] | None:
    """An unknown name is answered with the payload of its refusal, not raised."""
    try:
        layer.check_metrics(names)
    except Refused as refusal:
        return refusal.payload
    return None


def describe_metric(spark: SparkSession, layer: MetricLayer, name: str) -> DataFrame | dict[str, Any]:
    """The one row of a metric; an unknown name is refused as data."""
    return _refusal(layer, [name]) or metric_catalogue(spark, layer.definitions).where(F.col("name") == name)


def governance(spark: SparkSession, layer: MetricLayer, metrics: str) -> DataFrame:
    """M12 as rows."""
    names = as_list(metrics)
    layer.check_metrics(names)
    return (
        metric_catalogue(spark, layer.definitions)
        .where(F.col("name").isin(names))
        .select("name", "label", "type", "grain", "definition", "assumption", "tradeoff", "breaks_if")
    )


def list_semantic_models(spark: SparkSession, definitions: Definitions) -> DataFrame:
    """M15."""
    rows = [
        (
            m.name, m.description, m.table, m.entity if m.key else None,
            [(m.entity, "primary")] * bool(m.key) + [(f.name, "foreign") for f in m.foreign],
            [(d.name, d.kind, d.description) for d in m.dimensions],
            [(x.name, x.agg, x.description) for x in m.measures],
        )
        for m in definitions.models.values()
    ]
    return spark.createDataFrame(
        rows,
        "name string, description string, table string, primary_entity string,"
        " entities array<struct<name:string,type:string>>,"
        " dimensions array<struct<name:string,type:string,description:string>>,"
        " measures array<struct<name:string,agg:string,description:string>>",
    )


def list_dimensions(spark: SparkSession, layer: MetricLayer, metrics: str) -> DataFrame | dict[str, Any]:
    """M16; unknown names are refused as data."""
    return _refusal(layer, as_list(metrics)) or spark.createDataFrame([(d,) for d in layer.dimensions_of(metrics)], "dimension string")


def metric_lineage(spark: SparkSession, definitions: Definitions) -> DataFrame:
    """Metric -> measure -> model, one row per step."""
    rows = [
        (m, measure, definitions.model_of[measure].name)
        for m in definitions.metrics for measure in sorted(definitions.measures_behind(m))
    ]
    return spark.createDataFrame(rows, "metric string, measure string, semantic_model string")
