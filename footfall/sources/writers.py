"""Table materialisation and bounded result rows."""

from __future__ import annotations

import atexit
import contextlib
from collections.abc import Sequence

from py4j.protocol import Py4JError, Py4JNetworkError
from pyspark.sql import DataFrame, SparkSession

DEFAULT_ROWS = 100
MAX_ROWS = 500

# Partition column and clustering columns per table.
TABLE_LAYOUT: dict[str, tuple[str, tuple[str, ...]]] = {
    "export": ("event_date", ()),
    "stg_events": ("event_date", ("event_name", "user_pseudo_id")),
    "sessions_enriched": ("session_date", ("device_category", "first_touch_medium")),
    "int_sessions": ("session_date", ("device_category", "first_touch_medium")),
    "fct_events": ("event_date", ("event_name", "device_category")),
    "dim_users": ("first_seen_date", ("acquisition_medium", "first_device_category")),
    "fct_sessions": ("session_date", ("device_category", "acquisition_medium")),
    "fct_funnel": ("session_date", ("step_name", "device_category")),
}


def materialize(
    df: DataFrame, path: str, partition_by: str | None = None, cluster_by: Sequence[str] = ()
) -> None:
    """Full refresh of one table as Parquet.

    With ``partition_by`` the rows are rebalanced on it first, so each day lands
    in few files; the rebalance lets AQE split a day that holds far more rows
    than the others, where a plain ``repartition(day)`` would leave it to one
    task. ``cluster_by`` sorts inside each file, which gives row-group min/max
    ranges that scans can skip on.
    """
    if partition_by:
        df = df.hint("rebalance", partition_by)
    order = [*([partition_by] if partition_by else []), *cluster_by]
    if order:
        df = df.sortWithinPartitions(*order)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def to_rows(df: DataFrame, limit: int = DEFAULT_ROWS, at_most: int = MAX_ROWS) -> tuple[list[dict], bool]:
    """At most ``limit`` rows as dicts, and whether more exist.

    These rows come to the driver, so ``at_most`` bounds whatever is asked for; a caller with room may raise it.
    One row more than asked for is fetched, so an exactly full result is not reported as cut off.
    """
    n = max(1, min(int(limit), at_most))
    rows = [r.asDict() for r in df.limit(n + 1).toLocalIterator()]
    return rows[:n], len(rows) > n


def write_csv(df: DataFrame, path: str) -> None:
    """A result as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Removes a directory, wherever it is."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def delete_at_end(spark: SparkSession, path: str) -> str:
    """Removes a directory of this application when Python ends, also after the session was stopped."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def remove() -> None:
        with contextlib.suppress(Py4JError, Py4JNetworkError, OSError):  # the JVM may be gone already
            files.delete(where, True)

    atexit.register(remove)
    return path
