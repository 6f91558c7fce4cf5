"""Keep-one-per-key operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _ordered(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The greatest row per key by ``order_by`` (nulls lose).

    Written as ``row_number() == 1`` so that Catalyst cuts each input partition
    to one row per key before the shuffle; many copies of one key never meet in
    one task. What ``order_by`` leaves equal is settled by all other columns that
    have an order, so the survivor never depends on the order of the input.
    """
    named = {*keys, *order_by}
    rest = [f.name for f in df.schema.fields if f.name not in named and _ordered(f.dataType)]
    newest = Window.partitionBy(*keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in [*order_by, *rest]]
    )
    return df.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


def union_distinct(dfs: Sequence[DataFrame], key: str) -> DataFrame:
    """Union of frames with one row per key, the earlier frame winning."""
    stacked = None
    for rank, df in enumerate(dfs):
        part = df.withColumn("_rank", F.lit(rank))
        stacked = part if stacked is None else stacked.unionByName(part)
    first = Window.partitionBy(key).orderBy("_rank")
    return (
        stacked.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn", "_rank")
    )


def dedup_stream(df: DataFrame, key: str, ts: str, delay: str, shares: int = 64) -> DataFrame:
    """Drops repeated deliveries of an event that arrive within the watermark delay.

    Two levels: the first copy of each id and share, where a share is some of the input
    partitions, then the first of each id. So an id that a third of all rows have meets
    in ``shares`` tasks, and only one row of each goes on to the last.
    """
    marked = df.withWatermark(ts, delay).withColumn("_share", F.spark_partition_id() % shares)
    once = marked.dropDuplicatesWithinWatermark([key, "_share"]).drop("_share")
    return once.dropDuplicatesWithinWatermark([key])
