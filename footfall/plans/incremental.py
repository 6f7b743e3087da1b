"""Loads of some days instead of a full refresh.

A load brings all rows of the days that it names. It overwrites those days of the staged events, works out again the
sessions that had or have events there, and overwrites only the days on which such sessions begin. Users are put
together from stored rows per user and day, which are narrow and bounded by the days of the window; of those, too, only
the touched days are written. Files of all other days stay as they are.

Each table is replaced day by day, and a load that died is repeated: the same load again gives the same rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from footfall.config import EngineConfig
from footfall.operators.sessions import SESSION, session_core
from footfall.operators.staging import stage_events
from footfall.operators.users import behaviour_days, user_days, users_of_days
from footfall.sources.readers import read_feature_catalogue
from footfall.sources.writers import delete_folder


class IncrementalMarts:
    """Staged events, sessions and users under ``root``, kept up to date by loads of days."""

    def __init__(self, spark: SparkSession, root: str, cfg: EngineConfig, catalogue: DataFrame | None = None):
        self.spark, self.root, self.cfg = spark, root.rstrip("/"), cfg
        self.catalogue = catalogue if catalogue is not None else read_feature_catalogue(spark)

    # -- tables by day ---------------------------------------------------------

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _exists(self, path: str) -> bool:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where)

    def _stored(self, name: str, like: DataFrame, day: str) -> DataFrame:
        """The table as it lies there; empty before the first load."""
        if not self._exists(self._path(name)):
            return like.where("false")
        kept = [f for f in like.schema.fields if f.name != day]
        schema = StructType([*kept, StructField(day, DateType())])
        return self.spark.read.schema(schema).parquet(self._path(name)).select(*like.columns)

    def _overwrite(self, name: str, rows: DataFrame, day: str, days: Sequence[date]) -> None:
        """Exactly these days of the table become `rows`. A day that loses all its rows goes."""
        rows.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(self._path(name))
        there = {r[0] for r in rows.select(day).distinct().collect()}
        for gone in set(days) - there:
            delete_folder(self.spark, f"{self._path(name)}/{day}={gone}")

    # -- loading ---------------------------------------------------------------

    def load(self, raw: DataFrame, days: Sequence[date]) -> None:
        """``raw``: all rows of ``days`` in the export's layout; what was loaded of these days before is replaced."""
        days = sorted(set(days))
        of_days = F.col("event_date").isin(*days)
        scratch = self._path(f"_load-{uuid.uuid4().hex}")
        try:
            self._load(stage_events(raw).where(of_days), days, of_days, scratch)
        finally:
            delete_folder(self.spark, scratch)

    def _load(self, staged: DataFrame, days: list[date], of_days, scratch: str) -> None:
        def written(name: str, rows: DataFrame) -> DataFrame:
            rows.write.parquet(f"{scratch}/{name}")
            return self.spark.read.schema(rows.schema).parquet(f"{scratch}/{name}")

        fresh = written("events", staged)
        events = self._stored("stg_events", staged, "event_date")
        both = fresh.unionByName(events.where(of_days)).where(F.col("ga_session_id").isNotNull())
        touched = written("touched", both.select(*SESSION).distinct())

        # Sessions that go on beyond these days: the stored ones say which other days they reach.
        core = self._stored("session_core", session_core(staged, self.cfg), "session_date")
        before = written("before", core.join(touched, SESSION, "left_semi").select(*SESSION, "session_date", "session_started_at", "session_ended_at"))
        first, last = before.agg(F.min(F.to_date("session_started_at")), F.max(F.to_date("session_ended_at"))).first()
        others = events.where(~of_days)
        others = others.where(F.col("event_date").between(first, last)) if first else others.where("false")
        of_sessions = fresh.unionByName(others.join(touched, SESSION, "left_semi"))
        again = written("sessions", session_core(of_sessions, self.cfg))

        begin = before.select("session_date").unionByName(again.select("session_date")).distinct()
        session_days = sorted(r[0] for r in begin.collect())
        rest = core.where(F.col("session_date").isin(*session_days)) if session_days else core.where("false")
        sessions = written("session_days", rest.join(touched, SESSION, "left_anti").unionByName(again))

        self._overwrite("stg_events", fresh, "event_date", days)
        self._overwrite("behaviour_days", behaviour_days(fresh, self.catalogue), "event_date", days)
        self._overwrite("session_core", sessions, "session_date", session_days)
        self._overwrite("user_days", user_days(sessions), "session_date", session_days)

    # -- reading ---------------------------------------------------------------

    def events(self, like: DataFrame) -> DataFrame:
        """Staged events. ``like`` gives the export's layout."""
        return self._stored("stg_events", stage_events(like), "event_date")

    def sessions(self, like: DataFrame) -> DataFrame:
        return self._stored("session_core", session_core(stage_events(like), self.cfg), "session_date")

    def users(self, like: DataFrame) -> DataFrame:
        """One row per user, from the rows per user and day."""
        staged = stage_events(like)
        days = self._stored("user_days", user_days(session_core(staged, self.cfg)), "session_date")
        behaviour = self._stored("behaviour_days", behaviour_days(staged, self.catalogue), "event_date")
        return users_of_days(days, behaviour, self.cfg)
