"""Data checks as Spark jobs, and §2.13's 98 checks of the public tables.

Each check counts offending rows. All row rules of a table share one pass over
it; only uniqueness and references shuffle, and they shuffle keys combined per
task first, so a key that fills a third of a table arrives as a few rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from footfall.config import FUNNEL_STEPS

# Fixed values.
DEVICES = ("desktop", "mobile", "tablet")
STEP_NAMES = FUNNEL_STEPS
STEP_NUMBERS = (1, 2, 3, 4, 5)


@dataclass(frozen=True)
class Check:
    check_id: str
    table: str
    column: str | None
    kind: str
    values: tuple = ()
    minimum: int | None = None
    rule: str | None = None
    parent: str | None = None
    parent_column: str | None = None
    where: str | None = None
    severity: str = "error"


# The checks of the public tables, by their IDs.
CHECKS: tuple[Check, ...] = (
    Check("Q01", "stg_events", "event_key", "not_null"),
    Check("Q02", "stg_events", "event_key", "unique", severity="warn"),
    Check("Q03", "stg_events", "session_key", "not_null", severity="warn"),
    Check("Q04", "stg_events", "user_pseudo_id", "not_null"),
    Check("Q05", "stg_events", "event_name", "not_null"),
    Check("Q06", "stg_events", "event_date", "not_null"),
    Check("Q07", "stg_events", "event_at", "not_null"),
    Check("Q08", "stg_events", "device_category", "accepted_values", values=DEVICES, severity="warn"),
    Check("Q09", "int_sessions", None, "expression_is_true", rule="session_ended_at >= session_started_at"),
    Check("Q10", "int_sessions", None, "expression_is_true", rule="page_views <= events_in_session"),
    Check("Q11", "int_sessions", None, "expression_is_true", rule="not (has_purchase and session_revenue_usd < 0)"),
    Check("Q12", "int_sessions", "session_key", "unique"),
    Check("Q13", "int_sessions", "session_key", "not_null"),
    Check("Q14", "int_sessions", "user_pseudo_id", "not_null"),
    Check("Q15", "int_sessions", "user_pseudo_id", "relationships", parent="stg_events", parent_column="user_pseudo_id"),
    Check("Q16", "int_sessions", "ga_session_id", "not_null"),
    Check("Q17", "int_sessions", "session_started_at", "not_null"),
    Check("Q18", "int_sessions", "session_ended_at", "not_null"),
    Check("Q19", "int_sessions", "session_date", "not_null"),
    Check("Q20", "int_sessions", "session_duration_seconds", "accepted_range", minimum=0),
    Check("Q21", "int_sessions", "events_in_session", "accepted_range", minimum=1),
    Check("Q22", "int_sessions", "is_engaged_session", "not_null"),
    Check("Q23", "int_sessions", "is_engaged_session_derived", "not_null"),
    Check("Q24", "int_sessions", "inactivity_gaps", "accepted_range", minimum=0),
    Check("Q25", "int_sessions", "device_category", "accepted_values", values=DEVICES, severity="warn"),
    Check("Q26", "int_sessions", "user_first_seen_at", "not_null"),
    Check("Q27", "int_sessions", "user_first_seen_date", "not_null"),
    Check("Q28", "int_sessions", "days_since_first_session", "accepted_range", minimum=0),
    Check("Q29", "int_sessions", "is_left_censored", "not_null"),
    Check("Q30", "fct_events", None, "expression_is_true", rule="not (funnel_step_number is not null and funnel_step_name is null)"),
    Check("Q31", "fct_events", "event_key", "not_null"),
    Check("Q32", "fct_events", "session_key", "not_null", severity="warn"),
    Check("Q33", "fct_events", "session_key", "relationships", parent="fct_sessions", parent_column="session_key", severity="warn"),
    Check("Q34", "fct_events", "user_pseudo_id", "not_null"),
    Check("Q35", "fct_events", "user_pseudo_id", "relationships", parent="dim_users", parent_column="user_pseudo_id"),
    Check("Q36", "fct_events", "event_name", "not_null"),
    Check("Q37", "fct_events", "event_date", "not_null"),
    Check("Q38", "fct_events", "event_at", "not_null"),
    Check("Q39", "fct_events", "funnel_step_number", "accepted_values", values=STEP_NUMBERS, where="funnel_step_number is not null"),
    Check("Q40", "fct_events", "funnel_step_name", "accepted_values", values=STEP_NAMES, where="funnel_step_name is not null"),
    Check("Q41", "fct_events", "feature_name", "relationships", parent="feature_catalogue", parent_column="feature_name", where="feature_name is not null", severity="warn"),
    Check("Q42", "fct_events", "is_user_initiated_feature", "not_null"),
    Check("Q43", "fct_events", "purchase_revenue_usd", "not_null"),
    Check("Q44", "dim_users", None, "expression_is_true", rule="last_seen_at >= first_seen_at"),
    Check("Q45", "dim_users", None, "expression_is_true", rule="engaged_sessions <= sessions"),
    Check("Q46", "dim_users", None, "expression_is_true", rule="not (is_activated and first_purchase_at is null)"),
    Check("Q47", "dim_users", None, "expression_is_true", rule="not (transactions > 0 and sessions_with_purchase = 0)"),
    Check("Q48", "dim_users", "user_pseudo_id", "unique"),
    Check("Q49", "dim_users", "user_pseudo_id", "not_null"),
    Check("Q50", "dim_users", "first_seen_at", "not_null"),
    Check("Q51", "dim_users", "first_seen_date", "not_null"),
    Check("Q52", "dim_users", "last_seen_at", "not_null"),
    Check("Q53", "dim_users", "lifespan_days", "accepted_range", minimum=0),
    Check("Q54", "dim_users", "first_device_category", "accepted_values", values=DEVICES, severity="warn"),
    Check("Q55", "dim_users", "sessions", "accepted_range", minimum=1),
    Check("Q56", "dim_users", "lifetime_revenue_usd", "accepted_range", minimum=0),
    Check("Q57", "dim_users", "is_activated", "not_null"),
    Check("Q58", "dim_users", "is_retained_d1", "not_null"),
    Check("Q59", "dim_users", "is_retained_d7", "not_null"),
    Check("Q60", "dim_users", "is_retained_d30", "not_null"),
    Check("Q61", "dim_users", "has_full_activation_window", "not_null"),
    Check("Q62", "dim_users", "has_full_d7_window", "not_null"),
    Check("Q63", "dim_users", "is_left_censored", "not_null"),
    Check("Q64", "dim_users", "is_cohort_eligible", "not_null"),
    Check("Q65", "fct_sessions", None, "expression_is_true", rule="page_views <= events_in_session"),
    Check("Q66", "fct_sessions", None, "expression_is_true", rule="not (has_purchase = false and session_revenue_usd > 0)"),
    Check("Q67", "fct_sessions", "session_key", "unique"),
    Check("Q68", "fct_sessions", "session_key", "not_null"),
    Check("Q69", "fct_sessions", "user_pseudo_id", "not_null"),
    Check("Q70", "fct_sessions", "user_pseudo_id", "relationships", parent="dim_users", parent_column="user_pseudo_id"),
    Check("Q71", "fct_sessions", "session_started_at", "not_null"),
    Check("Q72", "fct_sessions", "session_date", "not_null"),
    Check("Q73", "fct_sessions", "device_category", "accepted_values", values=DEVICES, severity="warn"),
    Check("Q74", "fct_sessions", "is_engaged_session", "not_null"),
    Check("Q75", "fct_sessions", "events_in_session", "accepted_range", minimum=1),
    Check("Q76", "fct_sessions", "session_revenue_usd", "not_null"),
    Check("Q77", "fct_funnel", None, "expression_is_true", rule="not (is_reached_in_sequence and not is_reached)"),
    Check("Q78", "fct_funnel", None, "expression_is_true", rule="not (is_reached and first_reached_at is null)"),
    Check("Q79", "fct_funnel", "funnel_key", "unique"),
    Check("Q80", "fct_funnel", "funnel_key", "not_null"),
    Check("Q81", "fct_funnel", "session_key", "not_null"),
    Check("Q82", "fct_funnel", "session_key", "relationships", parent="fct_sessions", parent_column="session_key"),
    Check("Q83", "fct_funnel", "user_pseudo_id", "not_null"),
    Check("Q84", "fct_funnel", "session_date", "not_null"),
    Check("Q85", "fct_funnel", "step_number", "not_null"),
    Check("Q86", "fct_funnel", "step_number", "accepted_values", values=STEP_NUMBERS),
    Check("Q87", "fct_funnel", "step_name", "not_null"),
    Check("Q88", "fct_funnel", "step_name", "accepted_values", values=STEP_NAMES),
    Check("Q89", "fct_funnel", "step_event_count", "not_null"),
    Check("Q90", "fct_funnel", "is_reached", "not_null"),
    Check("Q91", "fct_funnel", "is_reached_in_sequence", "not_null"),
    Check("Q92", "time_spine", "date_day", "unique"),
    Check("Q93", "time_spine", "date_day", "not_null"),
    Check("Q94", "feature_catalogue", "event_name", "unique"),
    Check("Q95", "feature_catalogue", "event_name", "not_null"),
    Check("Q96", "feature_catalogue", "feature_name", "not_null"),
    Check("Q97", "feature_catalogue", "is_user_initiated", "not_null"),
)

# Q98: every table must hold rows. The other kinds count offending rows and so
# pass on an empty table; without this one a run over nothing would look clean.
NON_EMPTY = tuple(Check("Q98", table, None, "non_empty") for table in dict.fromkeys(c.table for c in CHECKS))


def _offends(check: Check) -> Column | None:
    """Condition under which a row breaks a row rule; NULL values break only not_null."""
    if check.kind == "not_null":
        broken = F.col(check.column).isNull()
    elif check.kind == "accepted_values":
        broken = ~F.col(check.column).isin(*check.values)
    elif check.kind == "accepted_range":
        broken = F.col(check.column) < check.minimum
    elif check.kind == "expression_is_true":
        broken = ~F.expr(check.rule)
    else:
        return None
    return broken & F.expr(check.where) if check.where else broken


def _result(check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(check.check_id).alias("check_id"),
        F.lit(check.table).alias("table"),
        F.lit(check.column).cast("string").alias("column"),
        F.lit(check.kind).alias("kind"),
        F.lit(check.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
        (failures == 0).alias("passed"),
    )


def _with_non_empty(name: str, checks: Iterable[Check]) -> list[Check]:
    """The checks of a table that look at one row at a time, and the one that there is a row."""
    own = [c for c in checks if c.table == name and c.kind not in ("unique", "relationships", "non_empty")]
    return [*own, Check("Q98", name, None, "non_empty")]


def _row_counts(checks: list[Check]) -> list[Column]:
    return [
        (F.when(F.count("*") == 0, 1).otherwise(0) if c.kind == "non_empty" else F.count_if(_offends(c))).cast("bigint").alias(f"f{i}")
        for i, c in enumerate(checks)
    ]


def _row_rules(table: DataFrame, checks: list[Check]) -> DataFrame:
    """K01, K03, K05, K06, K07 of one table in one aggregate."""
    results = F.array(*[_result(c, F.col(f"f{i}")) for i, c in enumerate(checks)])
    return table.agg(*_row_counts(checks)).select(F.inline(results))


class WatchedChecks:
    """K01, K03, K05, K06, K07 while tables are written: their counts go along with the write, so that the rows need
    not be read again."""

    def __init__(self, checks: Iterable[Check] = CHECKS):
        self._checks = list(checks)
        self._seen: dict[str, Observation] = {}

    def watch(self, name: str, table: DataFrame) -> DataFrame:
        """The table, to be written once."""
        if name not in {c.table for c in self._checks}:
            return table
        self._seen[name] = Observation()
        return table.observe(self._seen[name], *_row_counts(_with_non_empty(name, self._checks)))

    def results(self) -> DataFrame:
        """One row per check of the tables written so far, as ``run_checks`` gives them."""
        rows = []
        for name, seen in self._seen.items():
            checks = _with_non_empty(name, self._checks)
            try:
                counts = seen.get
            except Py4JJavaError:  # a plan that turned out empty is replaced at run time, counts and all
                counts = {f"f{i}": int(c.kind == "non_empty") for i, c in enumerate(checks)}
            rows += [_result(c, F.lit(counts[f"f{i}"])) for i, c in enumerate(checks)]
        return SparkSession.active().range(1).select(F.inline(F.array(*rows)))


def _unique(table: DataFrame, check: Check) -> DataFrame:
    """Values that occur more than once; NULL is no value.

    Hashes are counted first, eight bytes a row; only values whose hash comes back are counted themselves.
    """
    keys = table.where(F.col(check.column).isNotNull()).select(F.col(check.column).alias("key"))
    hashed = keys.withColumn("hash", F.xxhash64("key"))
    again = hashed.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash")
    repeated = hashed.join(again, "hash", "left_semi").groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    return repeated.agg(F.count("*").alias("f")).select(F.inline(F.array(_result(check, F.col("f")))))


def _references(child: DataFrame, tables: Mapping[str, DataFrame], checks: list[Check]) -> DataFrame:
    """Rows of one table that refer to what the parents lack; NULL refers to nothing.

    All references of the table are looked at in one scan, as 128-bit hashes marked with their check, which are
    counted in the tasks before they meet those of the parents in one shuffle. A frequent key is one row a task, and
    text stays behind: a row is an orphan if no parent has its hash.
    """

    def hashes(key: Column) -> list[Column]:
        return [F.xxhash64(key).alias("h"), F.xxhash64(F.lit(1), key).alias("g")]

    def reference(i: int, c: Check) -> Column:
        present = F.col(c.column).isNotNull() & (F.expr(c.where) if c.where else F.lit(True))
        return F.when(present, F.struct(F.lit(i).alias("check"), *hashes(F.col(c.column))))

    sides = [child.select(F.explode(F.array(*[reference(i, c) for i, c in enumerate(checks)])).alias("r")).where("r is not null").select("r.*", F.lit(1).alias("n"))]
    for i, c in enumerate(checks):
        parent = tables[c.parent].where(F.col(c.parent_column).isNotNull())
        sides.append(parent.select(F.lit(i).alias("check"), *hashes(F.col(c.parent_column)), F.lit(None).cast("int").alias("n")))
    met = reduce(DataFrame.unionAll, sides).groupBy("check", "h", "g").agg(F.sum("n").alias("n"), F.count_if(F.col("n").isNull()).alias("parents"))
    lost = met.where("parents = 0").agg(*[F.coalesce(F.sum(F.when(F.col("check") == i, F.col("n"))), F.lit(0)).alias(f"f{i}") for i in range(len(checks))])
    return lost.select(F.inline(F.array(*[_result(c, F.col(f"f{i}")) for i, c in enumerate(checks)])))


def _key_rules(tables: Mapping[str, DataFrame], name: str, checks: Iterable[Check]) -> list[DataFrame]:
    """K02, K04 of one table."""
    own = [c for c in checks if c.table == name]
    parts = [_unique(tables[name], c) for c in own if c.kind == "unique"]
    references = [c for c in own if c.kind == "relationships"]
    return parts + ([_references(tables[name], tables, references)] if references else [])


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check] = CHECKS, watched: WatchedChecks | None = None) -> DataFrame:
    """One row per check. Every table checked also gets its non-empty check. Row rules that ``watched`` has counted while
    all these tables were written are not counted again."""
    checks = list(checks)
    parts = [] if watched is None else [watched.results()]
    for name in dict.fromkeys(c.table for c in checks):
        if watched is None:
            parts.append(_row_rules(tables[name], _with_non_empty(name, checks)))
        parts += _key_rules(tables, name, checks)
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return reduce(
        DataFrame.unionByName,
        [df.agg(F.lit(name).alias("table"), F.count("*").alias("n_rows")) for name, df in tables.items()],
    )


def fatal(results: DataFrame) -> DataFrame:
    """Failed checks of error severity; warnings are reported, not fatal."""
    return results.where((F.col("severity") == "error") & ~F.col("passed"))
