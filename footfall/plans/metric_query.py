"""Governed metric queries as lazy DataFrames.

A query names metrics and dimensions. Names are resolved to columns; each table
involved is scanned once and aggregated, dimensions of other tables are joined
to the aggregated rows, and ratios are divided last.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from footfall.functions.columns import safe_ratio, start_of
from footfall.plans.semantics import TIME_GRAINS, Definitions, SemanticModel
from footfall.sources.writers import DEFAULT_ROWS, MAX_ROWS, to_rows

_TEMPLATE = re.compile(r"\{\{\s*(?:Time)?Dimension\(\s*'([^']+)'\s*(?:,\s*'(\w+)'\s*)?\)\s*\}\}")
_NAME = re.compile(r"\b[A-Za-z]\w*__\w+\b|\bmetric_time\b")
_QUOTED = re.compile(r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*\"""", re.S)


# The length of each grain as an interval.
_GRAIN_STEPS = {"day": "1 day", "week": "7 days", "month": "1 month", "quarter": "3 months", "year": "1 year"}


class Refused(ValueError):
    """A query the layer does not answer; ``payload`` says why and what would work."""

    def __init__(self, payload: dict[str, Any]):
        super().__init__(payload["error"])
        self.payload = payload


@dataclass(frozen=True)
class _Input:
    """One measure under one row filter."""

    measure: str
    where: str | None = None


@dataclass(frozen=True)
class _Part:
    """How one input is aggregated in steps: partial values, merged, finished."""

    alias: str
    kind: str  # sum, count, average or distinct
    value: str
    when: str | None
    where: str | None

    def _columns(self) -> tuple[str, ...]:
        names = {"sum": ("sum",), "count": ("n",), "average": ("sum", "n"), "distinct": ("hit",)}[self.kind]
        return tuple(f"{self.alias}_{n}" for n in names)

    def partials(self, condition: Column | None, tracked: bool) -> list[Column]:
        value = F.col(f"{self.alias}_in")
        if condition is not None:
            value = F.when(condition, value)
        made = {"sum": F.sum(value), "n": F.count(value), "hit": F.max(value.isNotNull())}
        out = [made[name.rpartition("_")[2]].alias(name) for name in self._columns()]
        if tracked:
            seen = F.lit(True) if condition is None else condition
            out.append(F.bool_or(seen).alias(f"{self.alias}_seen"))
        return out

    def limited_to(self, condition: Column, tracked: bool) -> dict[str, Column]:
        """The partial values, kept only where a filter on the group's own columns holds."""
        names = [*self._columns(), *([f"{self.alias}_seen"] if tracked else [])]
        return {name: F.when(condition, F.col(name)) for name in names}

    def merged(self, tracked: bool, counting: bool = False) -> list[Column]:
        out = []
        for name in self._columns():
            if name.endswith("_hit"):
                out.append(F.count_if(name).alias(f"{self.alias}_n") if counting else F.bool_or(name).alias(name))
            else:
                out.append(F.sum(name).alias(name))
        if tracked:
            out.append(F.bool_or(f"{self.alias}_seen").alias(f"{self.alias}_seen"))
        return out

    def final(self, tracked: bool, grouped: bool) -> Column:
        """A filtered count is NULL, not 0, in a group without a row that passes."""
        if self.kind == "sum":
            return F.col(f"{self.alias}_sum")
        n = F.col(f"{self.alias}_n")
        if self.kind == "average":
            return safe_ratio(F.col(f"{self.alias}_sum"), n)
        if tracked:
            return F.when(F.col(f"{self.alias}_seen"), F.coalesce(n, F.lit(0)))
        return n if grouped else F.coalesce(n, F.lit(0))


def as_list(names: str | Iterable[str] | None) -> list[str]:
    if not names:
        return []
    parts = names.split(",") if isinstance(names, str) else names
    return list(dict.fromkeys(p.strip() for p in parts if p.strip()))


def _day(value: str | date | None) -> date | None:
    return value if value is None or isinstance(value, date) else date.fromisoformat(value)


def plain_filter(text: str | None) -> str | None:
    """Wrapped dimension names become plain ones; Spark reads the rest."""
    if not text:
        return None
    return _TEMPLATE.sub(lambda m: m.group(1) + (f"__{m.group(2)}" if m.group(2) else ""), text)


def names_in(text: str | None) -> set[str]:
    return set(_NAME.findall(_QUOTED.sub("''", text))) if text else set()


def _split_grain(name: str) -> tuple[str, str | None]:
    stem, _, last = name.rpartition("__")
    return (stem, last) if stem and last in TIME_GRAINS else (name, None)


class MetricLayer:
    """Definitions bound to tables. ``tables`` maps a model's table name to a DataFrame."""

    def __init__(self, definitions: Definitions, tables: Any, spine: Callable[[], DataFrame] | None = None):
        self.definitions, self.tables, self._spine = definitions, tables, spine

    # -- refusals, before any job starts ---------------------------------------

    def check_metrics(self, metrics: Sequence[str]) -> None:
        """M10."""
        if not metrics:
            raise ValueError("name at least one metric")
        known = self.definitions.metrics
        unknown = [m for m in metrics if m not in known]
        if unknown:
            raise Refused(
                {
                    "ok": False,
                    "refused": True,
                    "error": f"no such metric: {', '.join(unknown)}",
                    "reason": "only defined metrics are served; an undefined one is not approximated",
                    "next_step": "pick one of available_metrics, or have the metric defined and reviewed first",
                    "available_metrics": sorted(known),
                }
            )

    def check_dimensions(self, models: Iterable[SemanticModel], names: Iterable[str], metrics: Sequence[str]) -> None:
        """Every name must be reachable from every model involved."""
        models = list(models)
        bad = [n for n in names if not all(self._resolves(m, n) for m in models)]
        if bad:
            raise Refused(
                {
                    "ok": False,
                    "metrics": list(metrics),
                    "error": f"no path from these metrics to: {', '.join(bad)}",
                    "hint": "list_dimensions gives the dimensions valid for all of these metrics",
                    "governance": self.governance(metrics),
                }
            )

    def _resolves(self, model: SemanticModel, name: str) -> bool:
        stem, grain = _split_grain(name)
        if stem == "metric_time":
            return model.time is not None
        found = self.definitions.dimension(model, stem)
        return found is not None and (grain is None or found[1].kind == "time")

    def governance(self, metrics: Iterable[str]) -> dict[str, dict[str, str]]:
        """M12."""
        known = self.definitions.metrics
        return {
            m: {
                "label": known[m].label, "type": known[m].type, "grain": known[m].grain,
                "definition": known[m].definition, "assumption": known[m].assumption,
                "tradeoff": known[m].tradeoff, "breaks_if": known[m].breaks_if,
            }
            for m in metrics if m in known
        }

    def dimensions_of(self, metrics: str | Sequence[str]) -> list[str]:
        """Dimensions valid for all given metrics."""
        names = as_list(metrics)
        self.check_metrics(names)
        models = {x for m in names for x in self.definitions.models_behind(m)}
        return sorted(set.intersection(*(self.definitions.reachable(self.definitions.models[x]) for x in models)))

    def warnings(self, metrics: str | Sequence[str], group_by: str | Sequence[str]) -> list[str]:
        """Ratios grouped by something their numerator is conditioned on."""
        groups = {_split_grain(g)[0] for g in as_list(group_by)}
        out = []
        for name in as_list(metrics):
            metric = self.definitions.metrics[name]
            if metric.type != "ratio":
                continue
            fixed = {d for x in self.definitions.measures_behind(metric.numerator)
                     for d in self.definitions.measures[x].conditioned_on}
            for g in sorted(groups & fixed):
                out.append(f"{name} grouped by {g}: the denominator shrinks with the numerator")
        return out

    # -- M01 -------------------------------------------------------------------

    def query(
        self, metrics: str | Sequence[str], group_by: str | Sequence[str] = (),
        start_time: str | date | None = None, end_time: str | date | None = None,
        where: str | None = None, order_by: str | Sequence[str] = (), limit: int | None = None,
        fill_spine: bool = False,
    ) -> DataFrame:
        """Metrics as columns, one row per group. The query itself runs when it is read; shared tables it
        needs that are not there yet are built first.

        ``limit`` is a positive number of rows; without it all rows are in the result.
        """
        names, groups = as_list(metrics), as_list(group_by)
        self.check_metrics(names)
        start_time, end_time = _day(start_time), _day(end_time)
        leaves: dict[_Input, str] = {}
        parts: dict[str, tuple[str, ...]] = {}
        for name in names:
            parts[name] = tuple(leaves.setdefault(x, f"__i{len(leaves)}") for x in self._inputs(name))
        wide = self._aggregate(leaves, groups, start_time, end_time, where, names)
        if fill_spine:
            wide = self._onto_spine(wide, groups, start_time, end_time, list(leaves.values()))
        columns = [
            (F.col(cols[0]) if len(cols) == 1 else safe_ratio(F.col(cols[0]), F.col(cols[1]))).alias(name)
            for name, cols in parts.items()
        ]
        return self._ordered(wide.select(*groups, *columns), order_by, limit)

    def query_measures(
        self, measures: str | Sequence[str], group_by: str | Sequence[str] = (), where: str | None = None,
        order_by: str | Sequence[str] = (),
    ) -> DataFrame:
        """Measures themselves, including those no metric publishes."""
        names, groups = as_list(measures), as_list(group_by)
        wide = self._aggregate({_Input(n): n for n in names}, groups, None, None, where, ())
        return self._ordered(wide.select(*groups, *names), order_by, None)

    def _inputs(self, metric: str) -> tuple[_Input, ...]:
        """M02-M04."""
        m = self.definitions.metrics[metric]
        if m.measure:
            return (_Input(m.measure, m.where),)

        def side(name: str, extra: str | None) -> _Input:
            (part,) = self._inputs(name)
            filters = [f for f in (part.where, extra) if f]
            return _Input(part.measure, " and ".join(f"({f})" for f in filters) or None)

        return side(m.numerator, m.numerator_where), side(m.denominator, None)

    def _ordered(self, df: DataFrame, order_by: str | Sequence[str], limit: int | None) -> DataFrame:
        """O01, O02."""
        order = []
        for field in as_list(order_by):
            name = field.removeprefix("-")
            if name not in df.columns:
                raise ValueError(f"cannot order by {name}; columns are {', '.join(df.columns)}")
            order.append(F.col(name).desc_nulls_last() if field.startswith("-") else F.col(name).asc_nulls_first())
        if order:
            df = df.orderBy(*order)
        if limit is None:
            return df
        if limit < 1:
            raise ValueError(f"limit must be positive, not {limit}")
        return df.limit(limit)

    def _aggregate(
        self, leaves: dict[_Input, str], groups: list[str], start: date | None, end: date | None, where: str | None,
        metrics: Sequence[str],
    ) -> DataFrame:
        where = plain_filter(where)
        by_scan: dict[tuple, dict[_Input, str]] = {}
        timed = start or end or any(_split_grain(n)[0] == "metric_time" for n in {*groups, *names_in(where)})
        models = [self.definitions.model_of[leaf.measure] for leaf in leaves]
        named = [*groups, *sorted(names_in(where)), *(["metric_time"] if timed else [])]
        self.check_dimensions(models, dict.fromkeys(named), metrics)
        for leaf, alias in leaves.items():
            model, measure = self.definitions.model_of[leaf.measure], self.definitions.measures[leaf.measure]
            clock = (measure.time or model.time) if timed else None
            by_scan.setdefault((model.name, clock), {})[leaf] = alias
        answers = [
            self._one_scan(self.definitions.models[model], clock, some, groups, start, end, where)
            for (model, clock), inputs in by_scan.items() for some in self._by_distinct_column(model, inputs)
        ]
        if len(answers) == 1:
            return answers[0]
        # Each part has a group at most once, so max() only picks the value that is there
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), answers)
        return stacked.groupBy(*groups).agg(*[F.max(a).alias(a) for a in leaves.values()])

    def _by_distinct_column(self, model: str, inputs: dict[_Input, str]) -> list[dict[_Input, str]]:
        """Distinct counts over different columns need different combined rows, hence a scan each; everything
        else goes with the first."""
        by_column: dict[str | None, dict[_Input, str]] = {}
        for leaf, alias in inputs.items():
            part = self._part(self.definitions.models[model], leaf, alias)
            by_column.setdefault(part.value if part.kind == "distinct" else None, {})[leaf] = alias
        plain, scans = by_column.pop(None, {}), list(by_column.values())
        return [{**plain, **scans[0]}, *scans[1:]] if scans else [plain]

    def _one_scan(
        self, model: SemanticModel, clock: str | None, inputs: dict[_Input, str], groups: list[str],
        start: date | None, end: date | None, where: str | None,
    ) -> DataFrame:
        """All inputs of one table under one clock: one scan, one row per group.

        When dimensions of other models are involved, rows are first combined
        per foreign key and own dimension, and only the combined rows are
        joined. A user with a third of all events is then a handful of rows
        before the join, as are the events without a session.
        """
        parts = [self._part(model, leaf, alias) for leaf, alias in inputs.items()]
        named = names_in(where).union(*(names_in(p.where) for p in parts))
        own = {n for n in {*groups, *named} if self._is_own(model, n)}
        foreign = {*groups, *named} - own
        distinct = {p.value for p in parts if p.kind == "distinct"}
        entity = ["__entity"] if distinct else []

        rows = self._own_rows(model, clock, own, foreign, parts, distinct)
        if start:
            rows = rows.where(F.col("metric_time") >= F.lit(start))
        if end:
            rows = rows.where(F.col("metric_time") <= F.lit(end))
        if where and names_in(where) <= own:
            rows, where = rows.where(F.expr(where)), None
        early = {p for p in parts if p.where and names_in(p.where) <= own}
        # a group exists only through rows that some input takes
        drop_untaken = bool(groups) and all(p.where for p in parts)
        if drop_untaken and len(early) == len(parts):
            rows = rows.where(F.expr(" or ".join(dict.fromkeys(f"({p.where})" for p in parts))))
            drop_untaken = False
        tracked = {p for p in parts if p.where and groups and (drop_untaken or p.kind != "sum")}

        def first(p: _Part) -> list[Column]:
            condition = F.expr(p.where) if p in early else None
            return p.partials(condition, p in tracked)

        if not foreign:
            merged = rows.groupBy(*groups, *entity).agg(*[c for p in parts for c in first(p)])
        else:
            late = [p for p in parts if p.where and p not in early]
            needed = own & ({*groups, *names_in(where)}.union(*(names_in(p.where) for p in late)))
            links = [c for c in rows.columns if c.startswith("__fk_")]
            few = rows.groupBy(*sorted(needed), *links, *entity).agg(*[c for p in parts for c in first(p)])
            wide = self._with_foreign(model, few, foreign)
            if where:
                wide = wide.alias("exposed").where(F.expr(where))
            for p in late:
                wide = wide.withColumns(p.limited_to(F.expr(p.where), p in tracked))
            merged = wide.groupBy(*groups, *entity).agg(*[c for p in parts for c in p.merged(p in tracked)])
        if entity:
            # any number of distinct counts over one column: its values are
            # unique per group by now, so they only need counting
            merged = merged.groupBy(*groups).agg(
                *[c for p in parts for c in p.merged(p in tracked, counting=True)]
            )
        if drop_untaken:
            merged = merged.where(reduce(lambda x, y: x | y, [F.col(f"{p.alias}_seen") for p in parts]))
        return merged.select(*groups, *[p.final(p in tracked, bool(groups)).alias(p.alias) for p in parts])

    def _part(self, model: SemanticModel, leaf: _Input, alias: str) -> _Part:
        """A distinct count of a model's own key is a count: the key is unique by
        construction (and by check) and joins are many-to-one."""
        m = self.definitions.measures[leaf.measure]
        kind = {"count_distinct": "distinct"}.get(m.agg, m.agg)
        if kind == "distinct" and m.expr == model.key:
            kind = "count"
        return _Part(alias, kind, m.expr, m.when, plain_filter(leaf.where))

    def _is_own(self, model: SemanticModel, name: str) -> bool:
        stem, _ = _split_grain(name)
        return stem == "metric_time" or self.definitions.dimension(model, stem)[0] is model

    def _dimension_column(self, model: SemanticModel, name: str) -> tuple[SemanticModel, Column]:
        stem, grain = _split_grain(name)
        owner, dim = self.definitions.dimension(model, stem)
        column = F.expr(dim.sql)
        return owner, start_of(grain, column) if grain else column

    def _own_rows(
        self, model: SemanticModel, clock: str | None, own: set[str], foreign: set[str],
        parts: list[_Part], distinct: set[str],
    ) -> DataFrame:
        """The table reduced to the wanted dimensions (by public name), the time
        column, the keys to join on and the measure inputs: nothing else can be
        named in a filter."""
        columns: dict[str, Column] = {}
        for name in sorted(own):
            stem, grain = _split_grain(name)
            if stem == "metric_time":
                columns[name] = start_of(grain, F.expr(clock)) if grain else F.expr(clock)
            else:
                columns[name] = self._dimension_column(model, name)[1]
        if clock:
            columns["metric_time"] = F.expr(clock)
        for f in model.foreign:
            if any(n.startswith(f"{f.name}__") for n in foreign):
                columns[f"__fk_{f.name}"] = F.col(f.column)
        for p in parts:
            value = F.expr(p.value)
            columns[f"{p.alias}_in"] = F.when(F.expr(p.when), value) if p.when else value
        for value in distinct:
            columns["__entity"] = F.expr(value)
        rows = self.tables[model.table].select(*[c.alias(n) for n, c in columns.items()])
        # without the alias Spark looks for a missing column below the projection
        return rows.alias("exposed")

    def _with_foreign(self, model: SemanticModel, rows: DataFrame, foreign: set[str]) -> DataFrame:
        """Many-to-one joins on the entity keys, with only the wanted columns."""
        for f in model.foreign:
            names = sorted(n for n in foreign if n.startswith(f"{f.name}__"))
            if not names:
                continue
            target = self.definitions.by_entity[f.name]
            side = self.tables[target.table].select(
                F.col(target.key).alias("__key"),
                *[self._dimension_column(model, n)[1].alias(n) for n in names],
            )
            rows = rows.join(side, rows[f"__fk_{f.name}"] == side["__key"], "left").drop("__key")
        return rows

    # -- J15 -------------------------------------------------------------------

    def _onto_spine(
        self, wide: DataFrame, groups: list[str], start: date | None, end: date | None, filled: list[str]
    ) -> DataFrame:
        """Opt-in: one row per day (or week, ...) of the calendar, empty ones as 0. Where a bound is missing, the result
        goes on to the first or last day that has rows, also beyond the calendar, and is filled up to there."""
        if self._spine is None or len(groups) != 1 or _split_grain(groups[0])[0] != "metric_time":
            raise ValueError("fill_spine needs a calendar and metric_time as the only group")
        days = self._spine()
        if start and end:  # both given: these days, whatever the calendar holds
            span = F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))
            days = days.sparkSession.range(1).select(F.explode(span).alias("date_day"))
        elif start or end:
            inside = F.col("date_day") >= F.lit(start) if start else F.col("date_day") <= F.lit(end)
            bound = days.sparkSession.range(1).select(F.lit(start or end).alias("date_day"))
            days = days.where(inside).unionByName(bound)
        grain = _split_grain(groups[0])[1] or "day"
        dates = days.select(start_of(grain, F.col("date_day")).alias("__day")).distinct()
        # days beyond the calendar and rows without a day stay
        both = dates.join(wide, F.col("__day").eqNullSafe(F.col(groups[0])), "full").withColumn("__day", F.coalesce(groups[0], "__day"))
        # One row for each day or week: few enough for one task to look at the next.
        step = F.expr(f"interval {_GRAIN_STEPS[grain]}")
        both = both.withColumn("__next", F.lead("__day").over(Window.orderBy("__day")))
        until = F.greatest(F.col("__day"), F.coalesce((F.col("__next") - step).cast("date"), "__day"))
        no_day = F.array(F.lit(None).cast("date"))
        dense = both.withColumn("__each", F.explode(F.when(F.col("__day").isNull(), no_day).otherwise(F.sequence("__day", until, step))))
        own = F.col("__each").eqNullSafe(F.col("__day"))
        values = {c: F.when(own, F.col(c)) for c in wide.columns if c != groups[0]}
        values |= {c: F.coalesce(values[c], F.lit(0)) for c in filled}
        return dense.withColumns({groups[0]: F.col("__each"), **values}).drop("__day", "__next", "__each")

    # -- answers for people ----------------------------------------------------

    def answer(
        self, metrics: str, group_by: str = "", start_time: str = "", end_time: str = "",
        where: str = "", order_by: str = "", limit: int = DEFAULT_ROWS, at_most: int = MAX_ROWS,
    ) -> dict[str, Any]:
        """M01 with rows, refusals as data, and governance on every answer.

        Rows are brought to the caller, so ``limit`` is bounded by ``at_most``; ``truncated`` says whether more
        exist, and ``query`` gives them all.
        """
        names = as_list(metrics)
        if not names:
            raise ValueError("name at least one metric")
        try:
            df = self.query(names, group_by, start_time or None, end_time or None, where or None, order_by)
            rows, more = to_rows(df, limit, at_most)
        except Refused as refusal:
            return refusal.payload
        except (AnalysisException, ParseException, ValueError) as problem:
            return {
                "ok": False, "metrics": names, "error": str(problem),
                "hint": "filters name dimensions valid for these metrics, bounds are ISO dates,"
                " sort fields are result columns",
                "governance": self.governance(names),
            }
        return {
            "ok": True, "metrics": names, "group_by": as_list(group_by),
            "filters": {"where": where or None, "start_time": start_time or None, "end_time": end_time or None},
            "row_count": len(rows), "truncated": more, "rows": rows,
            "governance": self.governance(names), "warnings": self.warnings(names, group_by),
        }

    def explain(self, metrics: str | Sequence[str], group_by: str | Sequence[str] = (), **options: Any) -> dict[str, Any]:
        """How Spark would compute the query, with governance; refusals as data. Starts no job: tables that
        are not there yet are planned, not built."""
        names = as_list(metrics)
        planned = getattr(self.tables, "planned", None)
        layer = MetricLayer(self.definitions, planned() if planned else self.tables, self._spine)
        try:
            query = layer.query(names, group_by, **options)._jdf.queryExecution()
        except Refused as refusal:
            return refusal.payload
        except (AnalysisException, ParseException, ValueError) as problem:
            return {"ok": False, "metrics": names, "error": str(problem), "governance": self.governance(names)}
        return {
            "ok": True, "metrics": names, "group_by": as_list(group_by),
            "plan": query.toString(), "governance": self.governance(names), "warnings": self.warnings(names, group_by),
        }
