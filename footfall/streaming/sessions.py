"""Sessions by the inactivity rule while events arrive, as a Structured Streaming query.

``session_window`` merges events that lie at most its gap apart. The rule cuts when N+1 minutes or more lie between
two events, so the gap is one microsecond less than that, and both agree to the microsecond. What differs from the
batch operator: a session comes out once the watermark has passed its end, numbers of sessions are not given (they
may change while older events arrive), and events that come later than the watermark allows are left out and counted
in the query's progress (``numRowsDroppedByWatermark``).

State holds the open sessions alone: the watermark drops those that are closed. Events are merged inside each task
before the shuffle, so a user with a third of all events sends one row per task and open session.
"""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.config import EngineConfig

#: Name of the made user whose one event closes what is still open.
CLOSING_USER = "\0closing"


def window_gap(cfg: EngineConfig) -> str:
    """The longest time between two events of one session."""
    return f"{cfg.session_gap_minutes} minutes 59 seconds 999 milliseconds 999 microseconds"


def stream_sessions(events: DataFrame, cfg: EngineConfig, delay: str = "1 hour") -> DataFrame:
    """One row per session from a stream (or table) of events with ``user_pseudo_id`` and ``event_at``. ``delay`` is how
    much later than the newest event another one may come and still count."""
    timed = events.select("user_pseudo_id", "event_at").withWatermark("event_at", delay)
    by_session = timed.groupBy("user_pseudo_id", F.session_window("event_at", window_gap(cfg)).alias("window"))
    merged = by_session.agg(
        F.min("event_at").alias("session_started_at"),
        F.max("event_at").alias("session_ended_at"),
        F.count("*").alias("events_in_session"),
    )
    return merged.drop("window")


def start(sessions: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Writes sessions as they close, each once, also over restarts; takes what is there and ends."""
    local = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"
    sessions.sparkSession.conf.set(local, "true")
    writer = sessions.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def closing_event(spark: SparkSession, events: DataFrame, cfg: EngineConfig, delay: timedelta) -> DataFrame:
    """One event of ``CLOSING_USER``, late enough to close every session of ``events``; no row where there is none."""
    far = delay + timedelta(minutes=cfg.session_gap_minutes + 2)
    newest = events.agg(F.max("event_at").alias("newest")).where("newest is not null")
    return newest.select(F.lit(CLOSING_USER).alias("user_pseudo_id"), (F.col("newest") + F.lit(far)).alias("event_at"))


def sessions_of_slices(spark: SparkSession, events: DataFrame, folder: str, cfg: EngineConfig, slices: int = 4) -> DataFrame:
    """The sessions of a finished table, through the stream: slices of its time arrive one after the other as files
    under ``folder``, each is taken by a run that goes on from the checkpoint of the run before, and a last event closes
    what is open. Nothing is late, as slices follow each other in time."""
    home, delay = f"{folder.rstrip('/')}/stream-{uuid.uuid4().hex}", timedelta(hours=1)
    narrow = events.where(F.col("user_pseudo_id").isNotNull() & F.col("event_at").isNotNull()).select("user_pseudo_id", "event_at")
    first, last = narrow.agg(F.min(F.unix_micros("event_at")), F.max(F.unix_micros("event_at"))).first()
    width = 0 if first is None else (last - first) // slices + 1
    micros = F.unix_micros("event_at") - F.lit(first)
    arriving = [narrow.where((micros >= k * width) & (micros < (k + 1) * width)) for k in range(slices if width else 0)]
    arriving.append(closing_event(spark, narrow, cfg, delay))
    for rows in arriving:
        rows.write.mode("append").parquet(f"{home}/in")
        source = spark.readStream.schema(narrow.schema).parquet(f"{home}/in")
        sessions = stream_sessions(source, cfg, f"{int(delay.total_seconds())} seconds")
        start(sessions, f"{home}/out", f"{home}/checkpoint").awaitTermination()
    return spark.read.schema(stream_sessions(narrow, cfg).schema).parquet(f"{home}/out").where(F.col("user_pseudo_id") != CLOSING_USER)
