"""Inactivity gaps without a window over raw events.

Two events are apart when more than N *whole* minutes lie between them, that is
when they differ by N+1 minutes or more. Cut time into blocks of exactly N+1
minutes: two events in one block always differ by less, so a gap can only fall
between consecutive non-empty blocks. It is enough to know the first and last
event of each block, which is an ordinary aggregate with map-side combine; a
user or session holding a third of all rows collapses to one row per block
before anything is ordered. Only the blocks (at most window / (N+1) minutes per
key) go through ``lag``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.config import EngineConfig
from footfall.functions.columns import whole_minutes_between

MICROS_PER_MINUTE = 60_000_000


def block_of(event_at: Column, cfg: EngineConfig) -> Column:
    """Start of the event's block, in microseconds; floor, also before 1970."""
    width = F.lit((cfg.session_gap_minutes + 1) * MICROS_PER_MINUTE)
    micros = F.unix_micros(event_at)
    return micros - F.pmod(micros, width)


def opens_after_gap(keys: Sequence[str], cfg: EngineConfig) -> Column:
    """W01 on blocks: did a gap precede this block? NULL for the key's first one."""
    order = Window.partitionBy(*keys).orderBy("block")
    return whole_minutes_between(F.lag("last_at").over(order), F.col("first_at")) > cfg.session_gap_minutes


def _user_blocks(events: DataFrame, cfg: EngineConfig) -> DataFrame:
    blocks = (
        events.where(F.col("user_pseudo_id").isNotNull() & F.col("event_at").isNotNull())
        .groupBy("user_pseudo_id", block_of(F.col("event_at"), cfg).alias("block"))
        .agg(
            F.min("event_at").alias("first_at"),
            F.max("event_at").alias("last_at"),
            F.count("*").alias("n_events"),
        )
    )
    running = Window.partitionBy("user_pseudo_id").orderBy("block").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    starts = F.coalesce(opens_after_gap(["user_pseudo_id"], cfg), F.lit(True))
    return blocks.withColumn("starts", starts).withColumn(
        "gap_session_number", F.count_if("starts").over(running)
    )


def gap_sessions(events: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Sessions by the inactivity rule alone, one row per session; events without a time or user are in none."""
    return (
        _user_blocks(events, cfg)
        .groupBy("user_pseudo_id", "gap_session_number")
        .agg(
            F.min("first_at").alias("session_started_at"),
            F.max("last_at").alias("session_ended_at"),
            F.sum("n_events").alias("events_in_session"),
        )
    )


def assign_gap_sessions(events: DataFrame, cfg: EngineConfig) -> DataFrame:
    """C03 on events: adds ``gap_session_number``; NULL for events without a user or a time.

    The lookup is keyed by user *and* block, so one busy user is spread over
    as many keys as that user has blocks; events without a user are spread by
    their own keys, which match nothing.
    """
    numbered = _user_blocks(events, cfg).select(
        F.col("user_pseudo_id").alias("__user"), F.col("block").alias("__block"), "gap_session_number"
    )
    block = block_of(F.col("event_at"), cfg)
    place = F.when(F.col("user_pseudo_id").isNotNull(), block).otherwise(F.xxhash64("event_key"))
    known = F.coalesce("user_pseudo_id", F.lit(""))
    keyed = events.withColumns({"__place": place, "__known": known})
    same = (F.col("__known") == F.col("__user")) & (F.col("__place") == F.col("__block")) & F.col("user_pseudo_id").isNotNull()
    return keyed.join(numbered, same, "left").drop("__user", "__block", "__place", "__known")
