"""Vocabulary of the metric layer: plain, immutable descriptions."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

GOVERNANCE_FIELDS = ("grain", "definition", "assumption", "tradeoff", "breaks_if")
TIME_GRAINS = ("day", "week", "month", "quarter", "year")


@dataclass(frozen=True)
class Dimension:
    name: str
    kind: str = "categorical"
    expr: str | None = None
    description: str = ""

    @property
    def sql(self) -> str:
        return self.expr or self.name


@dataclass(frozen=True)
class Measure:
    """One aggregate over a table.

    ``count_distinct`` counts values of ``expr`` on rows where ``when`` holds;
    the other kinds aggregate ``expr``. ``time`` overrides the model's own time
    column. ``conditioned_on`` names the dimensions that ``when`` fixes.
    """

    name: str
    agg: str
    expr: str
    when: str | None = None
    time: str | None = None
    conditioned_on: tuple[str, ...] = ()
    description: str = ""


@dataclass(frozen=True)
class ForeignEntity:
    name: str
    column: str


@dataclass(frozen=True)
class SemanticModel:
    """A table with its keys, the columns to group by and what may be aggregated.

    ``entity`` is the name own dimensions are addressed by. ``key`` is the
    unique column behind it, or None where the table has no unique column (it
    can then not be joined to). ``time`` is the day its measures are dated by,
    as a Spark SQL expression, or None for a table without one.
    """

    name: str
    table: str
    entity: str
    key: str | None
    time: str | None
    dimensions: tuple[Dimension, ...]
    measures: tuple[Measure, ...]
    foreign: tuple[ForeignEntity, ...] = ()
    description: str = ""


@dataclass(frozen=True)
class Metric:
    """A simple metric has a ``measure``; a ratio has ``numerator`` and ``denominator``.

    ``where`` limits a simple metric's rows; ``numerator_where`` limits only the
    numerator of a ratio, the denominator stays whole.
    """

    name: str
    label: str
    grain: str
    description: str
    definition: str
    assumption: str
    tradeoff: str
    breaks_if: str
    measure: str | None = None
    where: str | None = None
    numerator: str | None = None
    denominator: str | None = None
    numerator_where: str | None = None

    @property
    def type(self) -> str:
        return "simple" if self.measure else "ratio"

    def inputs(self) -> tuple[str, ...]:
        return (self.measure,) if self.measure else (self.numerator, self.denominator)


class Definitions:
    """All models and metrics of one layer, by name."""

    def __init__(self, models: Iterable[SemanticModel], metrics: Iterable[Metric]):
        self.models = {m.name: m for m in models}
        self.metrics = {m.name: m for m in metrics}
        self.measures = {x.name: x for m in self.models.values() for x in m.measures}
        self.model_of = {x.name: m for m in self.models.values() for x in m.measures}
        self.by_entity = {m.entity: m for m in self.models.values() if m.key}
        for m in self.metrics.values():
            nested = [x for x in m.inputs() if m.type == "ratio" and (x not in self.metrics or not self.metrics[x].measure)]
            if nested:
                raise ValueError(f"both sides of the ratio {m.name} must be simple metrics, not {', '.join(nested)}")

    def dimension(self, model: SemanticModel, name: str) -> tuple[SemanticModel, Dimension] | None:
        """``entity__dimension`` as seen from ``model``: the owning model and the dimension."""
        entity, _, rest = name.partition("__")
        owners = [model] if entity == model.entity else []
        owners += [self.by_entity[f.name] for f in model.foreign if f.name == entity and f.name in self.by_entity]
        for owner in owners:
            for dim in owner.dimensions:
                if dim.name == rest:
                    return owner, dim
        return None

    def reachable(self, model: SemanticModel) -> set[str]:
        """Own dimensions and those of every model a foreign entity is the key of."""
        names = {f"{model.entity}__{d.name}" for d in model.dimensions}
        if model.time:
            names.add("metric_time")
        for f in model.foreign:
            if f.name in self.by_entity:
                names |= {f"{f.name}__{d.name}" for d in self.by_entity[f.name].dimensions}
        return names

    def measures_behind(self, metric: str) -> set[str]:
        """The measures a metric is computed from: its own, or those of both sides of a ratio."""
        sides = [self.metrics[name] for name in self.metrics[metric].inputs()] if self.metrics[metric].type == "ratio" else [self.metrics[metric]]
        return {side.measure for side in sides}

    def models_behind(self, metric: str) -> set[str]:
        """The models that own these measures."""
        return {self.model_of[measure].name for measure in self.measures_behind(metric)}
