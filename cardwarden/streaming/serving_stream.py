"""Continuous upkeep of the serving table from a scored stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources import versioned
from .run import start_batches


def start_serving(
    scored: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
    compact_every: int | None = 100,
) -> StreamingQuery:
    """Upserts every micro-batch into the versioned table at ``path``.

    Every ``compact_every`` micro-batches the open ones are folded into the base, so a
    reader opens the base and so many small folders, however old the stream is.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        versioned.upsert(batch, batch_id, path)
        if compact_every and (batch_id + 1) % compact_every == 0:
            versioned.compact(batch.sparkSession, path)

    return start_batches(scored, handle, checkpoint, trigger)
