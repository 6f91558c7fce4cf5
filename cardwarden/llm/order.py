"""Places of rows in a total order, without one task or one key holding many of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.frames import written

SPAN_BITS = 12  # a key's row is repeated once for so many places (2^12) of that key


def numbered(rows: DataFrame, order: list[str], name: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` stored with ``name``: their place from 0 in the order of ``order``, nulls first.

    Rows are sorted in ranges. Rows equal in all of ``order`` may lie in several
    ranges (the input place comes last in the order), so no key is one task. The
    places within a range are stored with the rows; what precedes a range is the sum
    of the sizes before it, one number for each range. ``drop`` names columns that
    only the order needs.
    """
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = written(
        rows.withColumn("_in", F.monotonically_increasing_id())
        .repartitionByRange(ranges, *order, "_in")
        .sortWithinPartitions(*order, "_in")
        .withColumn("_at", F.monotonically_increasing_id())
        .drop("_in", *drop)
    ).withColumn("_range", F.shiftright("_at", 33))
    before, offsets = 0, []
    for at, size in sorted(map(tuple, stored.groupBy("_range").count().collect())):
        offsets.append((at, before))
        before += size
    starts = spark.createDataFrame(offsets, "_range long, _before long")  # a row for each range
    local = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        stored.join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_before") + local)
        .drop("_range", "_at", "_before")
    )


def spans(rows: DataFrame, key: str, place: str) -> DataFrame:
    """(key, start, n): where each key's rows begin in an order that starts with the key."""
    return rows.groupBy(key).agg(F.min(place).alias("start"), F.count("*").alias("n"))


def with_key_columns(rows: DataFrame, place: str, keys: DataFrame, key: str) -> DataFrame:
    """Joins ``keys`` (key, start, n, ...) to the numbered rows of the key, nulls included.

    A key's row goes once to every 2^12 places of its span, so a key with many rows
    is as many join keys.
    """
    last = F.col("start") + F.col("n") - 1
    slices = keys.withColumn(
        "_slice", F.explode(F.sequence(F.shiftright("start", SPAN_BITS), F.shiftright(last, SPAN_BITS)))
    ).withColumnRenamed(key, "_key")
    left = rows.withColumn("_slice", F.shiftright(place, SPAN_BITS))
    met = left[key].eqNullSafe(slices["_key"]) & (left["_slice"] == slices["_slice"])
    return left.join(slices, met).drop("_slice", "_key")


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts put together."""
    return F.sha2(F.concat(*parts), 256)
