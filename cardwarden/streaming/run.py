"""Starting streams, and sinks that survive a repeated micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

BATCH = "batch_id"


def _triggered(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """``trigger`` is an interval such as '10 seconds', or None to take what is there and stop."""
    if trigger is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def start(
    stream: DataFrame, path: str, checkpoint: str, trigger: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Appends a stream to a Parquet folder."""
    writer = stream.writeStream.format("parquet").outputMode("append").option(
        "checkpointLocation", checkpoint
    )
    if name:
        writer = writer.queryName(name)
    return _triggered(writer, trigger).start(path)


def start_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
    trigger: str | None = None,
) -> StreamingQuery:
    """Hands every micro-batch to ``handle(batch, batch_id)``."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return _triggered(writer, trigger).start()


def write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Stores one micro-batch in a folder of its own, so that a repeat replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All stored micro-batches."""
    return spark.read.option("basePath", path).parquet(path).drop(BATCH)


METRICS = "query_id string, name string, batch_id long, counts map<string,bigint>"


class RuleMetrics(StreamingQueryListener):
    """Adds the counts that observed streams report to a table, a row per name and micro-batch.

    A micro-batch that is repeated after a restart reports again; ``read_metrics`` takes
    one row of each.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        progress = event.progress
        rows = [
            (str(progress.id), name, progress.batchId, {k: v for k, v in row.asDict().items() if v is not None})
            for name, row in progress.observedMetrics.items()
        ]
        if rows:
            self.spark.createDataFrame(rows, METRICS).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, name, batch_id, counts): the stored counts, one row per name and micro-batch."""
    return spark.read.schema(METRICS).parquet(path).dropDuplicates(["query_id", "name", "batch_id"])
