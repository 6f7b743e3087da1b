"""From raw events to the public tables, layer by layer."""

from __future__ import annotations

import threading
import uuid
from collections import defaultdict
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.config import EngineConfig
from footfall.operators.event_facts import fct_events
from footfall.operators.funnel import fct_funnel
from footfall.operators.sessions import (
    SESSION_KEYS,
    enrich_sessions,
    fct_sessions,
    int_sessions,
    session_core,
    with_filled_flags,
    with_session_key,
)
from footfall.operators.staging import EVENT_KEYS, stage_events, with_event_keys
from footfall.operators.users import dim_users
from footfall.plans.checks import WatchedChecks, fatal
from footfall.sources.readers import SPINE_END, SPINE_START, in_window, read_export, read_feature_catalogue, time_spine
from footfall.sources.snapshots import Snapshots
from footfall.sources.writers import TABLE_LAYOUT, delete_at_end, delete_folder, materialize

PUBLIC_TABLES = (
    "stg_events", "int_sessions", "fct_events", "dim_users", "fct_sessions", "fct_funnel",
    "feature_catalogue", "time_spine",
)

Keep = Callable[[str, DataFrame], DataFrame]

# Tables that the queries of an application share are read whole, a window's rows each. Only the export holds more, so
# only it is dealt by day; to deal and sort the others, many times as wide, took half of all bytes shuffled.
SHARED_LAYOUT = {"export": TABLE_LAYOUT["export"]}

# Keys that a shared table is written without, and what gives them back as it is read. The hash of an event alone took
# most of the bytes of staged events.
SHARED_KEYS = {
    "stg_events": (EVENT_KEYS, with_event_keys),
    "session_core": (SESSION_KEYS, with_session_key),
    "sessions_enriched": (SESSION_KEYS, with_session_key),
}


def _lazy(name: str, df: DataFrame) -> DataFrame:
    return df


class Marts:
    """The tables of one source and window, each composed when first asked for.

    ``keep`` sees every relation that more than one later relation reads. The
    default leaves it lazy; ``TableFolder.keep`` writes it once as Parquet and
    reads it back, which also ends its lineage.
    """

    def __init__(
        self, spark: SparkSession, raw: DataFrame, cfg: EngineConfig,
        catalogue: DataFrame | None = None, keep: Keep = _lazy,
    ):
        self.spark, self.cfg = spark, cfg
        self.raw, self._catalogue, self._keep = raw, catalogue, keep
        self._tables: dict[str, DataFrame] = {}
        self._locks: defaultdict[str, threading.RLock] = defaultdict(threading.RLock)
        self._guard = threading.Lock()

    def __getitem__(self, name: str) -> DataFrame:
        with self._guard:
            lock = self._locks[name]
        with lock:  # a table is written once, also when queries run side by side; others are not held up
            if name not in self._tables:
                self._tables[name] = getattr(self, f"_{name}")()
            return self._tables[name]

    def planned(self) -> Marts:
        """The same tables without writing any: those already there, the others as lazy plans."""
        lazy = Marts(self.spark, self.raw, self.cfg, self._catalogue)
        lazy._tables = dict(self._tables)
        return lazy

    def public(self) -> dict[str, DataFrame]:
        return {name: self[name] for name in PUBLIC_TABLES}

    # shared relations
    def _stg_events(self) -> DataFrame:
        return self._keep("stg_events", stage_events(self.raw))

    def _session_core(self) -> DataFrame:
        return self._keep("session_core", session_core(self["stg_events"], self.cfg))

    def _dim_users(self) -> DataFrame:
        users = dim_users(self["session_core"], self["stg_events"], self["feature_catalogue"], self.cfg)
        return self._keep("dim_users", users)

    def _sessions_enriched(self) -> DataFrame:
        return self._keep("sessions_enriched", enrich_sessions(self["session_core"], self["dim_users"], self.cfg))

    def _fct_events(self) -> DataFrame:
        facts = fct_events(self["stg_events"], self["int_sessions"], self["feature_catalogue"], self.cfg)
        return self._keep("fct_events", facts)

    # narrow views of the above
    def _int_sessions(self) -> DataFrame:
        return int_sessions(self["sessions_enriched"])

    def _fct_sessions(self) -> DataFrame:
        return fct_sessions(self["sessions_enriched"])

    def _fct_funnel(self) -> DataFrame:
        return fct_funnel(with_filled_flags(self["sessions_enriched"]), self.cfg)

    def _feature_catalogue(self) -> DataFrame:
        return self._catalogue if self._catalogue is not None else read_feature_catalogue(self.spark)

    def _time_spine(self) -> DataFrame:
        """The usual calendar, longer where the window is."""
        if self.cfg.every_row:
            return time_spine(self.spark)
        return time_spine(self.spark, min(SPINE_START, self.cfg.window_start), max(SPINE_END, self.cfg.window_end))


def build_marts(
    spark: SparkSession, raw: DataFrame, cfg: EngineConfig, out: str | None = None,
    catalogue: DataFrame | None = None, watched: WatchedChecks | None = None,
) -> dict[str, DataFrame]:
    """Full refresh of all public tables.

    With ``out`` every table is written under it, one directory per table, and
    each layer reads the one before from there. Without it nothing runs yet.
    ``watched`` counts the broken row rules of each table while it is written.
    A refresh that must not disturb readers goes through ``publish_marts``.
    """
    if out is None:
        return Marts(spark, raw, cfg, catalogue).public()
    folder = TableFolder(spark, out, cfg, watched)
    marts = Marts(spark, raw, cfg, catalogue, folder.keep)

    def finished(name: str) -> DataFrame:
        df = marts[name]
        return df if name in folder.kept else folder.keep(name, df)

    marts["sessions_enriched"]  # what the other tables have in common, in order
    with ThreadPoolExecutor(len(PUBLIC_TABLES)) as pool:  # these do not depend on each other
        tables = dict(zip(PUBLIC_TABLES, pool.map(finished, PUBLIC_TABLES), strict=True))
    for name in folder.kept - set(PUBLIC_TABLES):
        delete_folder(spark, f"{folder.root}/{name}")
    return tables


def publish_marts(
    spark: SparkSession, raw: DataFrame, cfg: EngineConfig, root: str, catalogue: DataFrame | None = None, strict: bool = True,
) -> dict[str, DataFrame]:
    """Full refresh as a new version under ``root`` (see ``Snapshots``): readers of the one before are not disturbed,
    and a refresh that fails, or with ``strict`` one that breaks a row rule of error severity, is never published."""
    versions, watched = Snapshots(spark, root), WatchedChecks()
    with versions.refresh() as folder:
        tables = build_marts(spark, raw, cfg, folder, catalogue, watched)
        broken = [r["check_id"] for r in fatal(watched.results()).collect()] if strict else []
        if broken:
            raise ValueError(f"not published, checks failed: {', '.join(sorted(broken))}")
    return tables


class TableFolder:
    """S03-S05 applied to named tables under one directory."""

    def __init__(
        self, spark: SparkSession, root: str, cfg: EngineConfig, watched: WatchedChecks | None = None,
        layout: Mapping[str, tuple[str, tuple[str, ...]]] = TABLE_LAYOUT,
    ):
        self.spark, self.root, self.cfg, self.watched, self.layout = spark, root.rstrip("/"), cfg, watched, layout
        self.kept: set[str] = set()

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        day, cluster = self.layout.get(name, (None, ()))
        path = f"{self.root}/{name}"
        rows = self.watched.watch(name, df) if self.watched else df
        materialize(rows, path, day if self.cfg.enable_partitioning else None, cluster)
        self.kept.add(name)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)


# -- tables shared by the queries of one application ----------------------------


class Kept:
    """Relations kept for the queries of one application, the same way on every master: written where a shared folder
    is named, else persisted by the engine (lost parts are computed again). ``drop`` frees their storage."""

    def __init__(self, spark: SparkSession, cfg: EngineConfig):
        self._spark, self._cfg, self._folder = spark, cfg, shared_folder(spark)
        self._tables = TableFolder(spark, self._folder, cfg, layout=SHARED_LAYOUT) if self._folder else None
        self._persisted: list[DataFrame] = []

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        if self._tables and name in SHARED_KEYS:
            keys, with_keys = SHARED_KEYS[name]
            return with_keys(self._tables.keep(name, df.drop(*keys))).select(*df.columns)
        if self._tables:
            return self._tables.keep(name, df)
        self._persisted.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return df

    def by_day(self, rows: DataFrame) -> DataFrame:
        """An export laid out by day where a folder is named, so that a window reads only its own days. One made from
        rows that were kept here by day is so already."""
        if not self._folder or self._kept_by_day():
            return rows
        materialize(rows, f"{self._folder}/export", partition_by="event_date")
        return read_export(self._spark, f"{self._folder}/export")

    def _kept_by_day(self) -> bool:
        days = {SHARED_LAYOUT[name][0] for name in self._tables.kept if name in SHARED_LAYOUT}
        return self._cfg.enable_partitioning and "event_date" in days

    def drop(self) -> None:
        for df in self._persisted:
            df.unpersist()
        if self._folder:
            delete_folder(self._spark, self._folder)


_EXPORTS: dict[tuple, DataFrame] = {}
_SHARED: dict[tuple, Marts] = {}
_KEPT: dict[tuple, list[Kept]] = {}
_SHARED_LOCK = threading.Lock()
_SOURCE_LOCKS: defaultdict[tuple, threading.Lock] = defaultdict(threading.Lock)


def shared_folder(spark: SparkSession) -> str | None:
    """A new directory in the folder that ``spark.checkpoint.dir`` names, deleted when the application ends;
    None where it names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        return None
    return delete_at_end(spark, f"{named.rstrip('/')}/footfall-{uuid.uuid4().hex}")


def source_version(spark: SparkSession, path: str) -> tuple:
    """Tells states of the source apart. A file: when it last changed, and its length. A directory: number, length and
    hash of all files below it with their change times, from a listing that Spark makes; no file is read."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    status = where.getFileSystem(context._jsc.hadoopConfiguration()).getFileStatus(where)
    if not status.isDirectory():
        return status.getModificationTime(), status.getLen()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    seen = files.agg(F.count("*"), F.sum("length"), F.bit_xor(F.xxhash64("path", "modificationTime", "length")))
    return tuple(seen.first())


def shared_marts(
    spark: SparkSession, source: str, export: Callable[[Keep], DataFrame], cfg: EngineConfig, version: object = None
) -> Marts:
    """Marts that every query of this application over the same source reads.

    ``export`` gives the source in the event export's layout, laid out by day
    once where a shared folder is named, so that each window reads only its own
    days. A relation is kept the first time a query needs it. ``version`` tells
    states of the source apart; by default ``source_version`` of its path. Marts
    of an older version are dropped with what they have stored. A source is
    bound by one caller while the others wait for it, and for it alone.
    """
    home = (spark.conf.get("spark.app.id"), source)
    at = (*home, version if version is not None else source_version(spark, source))
    with _SHARED_LOCK:
        lock = _SOURCE_LOCKS[home]
    with lock:
        with _SHARED_LOCK:
            old = [k for k in (*_EXPORTS, *_SHARED) if k[:2] == home and k[:3] != at]
            for k in old:
                _EXPORTS.pop(k, None)
                _SHARED.pop(k, None)
            stale = [kept for k in set(old) for kept in _KEPT.pop(k, [])]
        for kept in stale:
            kept.drop()

        def kept_for(key: tuple) -> Kept:
            kept = Kept(spark, cfg)
            _KEPT.setdefault(key, []).append(kept)
            return kept

        if at not in _EXPORTS:
            first = kept_for(at)
            _EXPORTS[at] = first.by_day(export(first.keep))
        if (*at, cfg) not in _SHARED:
            _SHARED[(*at, cfg)] = Marts(spark, in_window(_EXPORTS[at], cfg), cfg, keep=kept_for((*at, cfg)).keep)
        return _SHARED[(*at, cfg)]
