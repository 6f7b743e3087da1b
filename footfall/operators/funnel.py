"""The dense funnel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.config import EngineConfig
from footfall.functions.columns import surrogate_key, whole_seconds_between
from footfall.sources.schema import PUBLIC_COLUMNS


def fct_funnel(wide_sessions: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row per session and step, reached or not.

    The sessions carry their step reach, so this is one narrow explode of literal
    steps: no join, no window and no shuffle. A step is in sequence when it and
    every earlier step were fired in the session; their order in time plays no part.
    """
    steps, in_sequence = [], F.lit(True)
    for i, name in enumerate(cfg.funnel_steps):
        at = F.col("step_reach")[i]["first_reached_at"]
        in_sequence = in_sequence & at.isNotNull()
        steps.append(
            F.struct(
                F.lit(i + 1).cast("bigint").alias("step_number"),
                F.lit(name).alias("step_name"),
                at.alias("first_reached_at"),
                F.col("step_reach")[i]["step_event_count"].alias("step_event_count"),
                at.isNotNull().alias("is_reached"),
                in_sequence.alias("is_reached_in_sequence"),
            )
        )
    rows = wide_sessions.select("*", F.inline(F.array(*steps)))
    return rows.withColumns(
        {
            "seconds_from_session_start": whole_seconds_between(F.col("session_started_at"), F.col("first_reached_at")),
            "funnel_key": surrogate_key([F.col("session_key"), F.col("step_number")]),
        }
    ).select(*PUBLIC_COLUMNS["fct_funnel"])
