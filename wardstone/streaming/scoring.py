"""Scoring encounters as they arrive.

Scoring a row needs nothing but the row, so the stream keeps no state and its
functions are the batch ones. The sink's checkpoint makes each input file count
once, also after a restart.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wardstone.operators.scoring import score_encounters

SCORED_COLUMNS = ["encounter_id", "patient_nbr", "encounter_ts", "score", "tier"]


def score_stream(
    stream: DataFrame,
    sink: str,
    checkpoint: str,
    score: Callable[[DataFrame], DataFrame] = score_encounters,
    columns: list[str] | None = None,
    once: bool = True,
) -> StreamingQuery:
    """Start scoring into a parquet folder; with ``once``, stop when the waiting input is done."""
    scored = score(stream).select(*(columns or SCORED_COLUMNS))
    writer = scored.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    writer = writer.outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")).start()
