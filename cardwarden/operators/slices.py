"""Time slices for keys that hold too many rows for one task.

Ordered work per account (as-of match, running sums, previous row) is a window
over ``account_id``, so all rows of one account meet in one task. That is right
for ordinary accounts and wrong for one that holds a third of the data. Here the
busiest keys are cut into equal spans of time, the window runs over
``(key, slice)``, and what a slice needs from the earlier ones travels in as one
extra *seed* row. Cutting changes the layout only, never the result, so the
limits below are tuning values and not correctness limits:

* a key is cut into at most ``MAX_SLICES`` spans, so the pass that hands values
  from slice to slice sees at most that many rows per key.
* at most ``MAX_HOT_KEYS`` keys are cut, the biggest first. The table of cut
  keys is therefore small whatever the data size, and is safe to broadcast; a
  key that misses the table holds at most 1/MAX_HOT_KEYS of all rows.
* when no key is hot the table is empty, and adaptive execution drops the seed
  branch and the lookup join at run time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 200_000
SLICE_ROWS = 50_000
MAX_SLICES = 100_000
MAX_HOT_KEYS = 10_000
_NULL_KEY_SPREAD = 1024
FIRST = -(2**62)  # sorts before every timestamp, with room for offsets

SLICE = "_slice"


@dataclass(frozen=True)
class KeySplit:
    """Which keys are cut, and into how many spans.

    ``hot`` has one row per cut key with ``_cut``, the array (first microsecond,
    span length, number of spans). It is one column on purpose: every use reads
    the same columns, so Spark computes and broadcasts the table once per job.
    """

    by: str
    hot: DataFrame

    def slice(self, df: DataFrame, us: str, mirrored: bool = False) -> DataFrame:
        """Adds ``_slice`` from the microsecond column ``us``, and ``_cut`` (null unless cut).

        Rows outside the counted span fall into the first or last slice. Rows
        with a null key can match nothing and are spread evenly. ``mirrored``
        says that ``us`` runs backward (it holds minus the time); slices then
        count backward too.
        """
        time, sign = (f"-{us}", "-") if mirrored else (us, "")
        number = F.expr(f"""cast(CASE
            WHEN _cut IS NOT NULL THEN {sign}coalesce(
                least(greatest(floor(({time} - _cut[0]) / _cut[1]), 0), _cut[2] - 1), 0)
            WHEN {self.by} IS NULL THEN pmod(xxhash64({us}), {_NULL_KEY_SPREAD})
            ELSE 0 END AS bigint)""")
        return df.join(F.broadcast(self.hot), self.by, "left").withColumn(SLICE, number)

    def spread(self, dim: DataFrame) -> DataFrame:
        """Repeats each row of a one-row-per-key table for every slice of its key."""
        return (
            dim.join(F.broadcast(self.hot), self.by, "left")
            .withColumn(SLICE, F.expr("explode(sequence(0L, coalesce(_cut[2], 1L) - 1))"))
            .drop("_cut")
        )

    def join_dim(self, df: DataFrame, ts: str, dim: DataFrame) -> DataFrame:
        """Left join to a one-row-per-key table on (key, slice), so that a hot key stays spread."""
        sliced = self.slice(df.withColumn("_us", F.unix_micros(ts)), "_us").drop("_us", "_cut")
        return sliced.join(self.spread(dim), [self.by, SLICE], "left").drop(SLICE)

    def seeds(
        self,
        sliced: DataFrame,
        summaries: dict[str, Column],
        carry: Callable[[str], Column],
        mirrored: bool = False,
    ) -> DataFrame:
        """What the earlier slices of a cut key hand over to each of its slices.

        ``summaries`` are aggregates over one slice, combined before the shuffle;
        ``carry`` runs them over the earlier slices. Every slice gets its row,
        whether or not ``sliced`` has rows there, so frames that only receive
        need not be read. Per key there are as many rows as slices, never as
        many as input rows.
        """
        sign = "-" if mirrored else ""
        marks = self.hot.selectExpr(
            self.by, f"explode(transform(sequence(0L, _cut[2] - 1), i -> {sign}i)) AS {SLICE}",
            "true AS _mark",
        )
        earlier = (
            Window.partitionBy(self.by)
            .orderBy(SLICE)
            .rangeBetween(Window.unboundedPreceding, -1)
        )
        names = list(summaries)
        return (
            sliced.where(F.col("_cut").isNotNull())
            .groupBy(self.by, SLICE)
            .agg(*[col.alias(name) for name, col in summaries.items()])
            .unionByName(marks, allowMissingColumns=True)
            .select(self.by, SLICE, "_mark", *[carry(n).over(earlier).alias(n) for n in names])
            .where("_mark")
            .drop("_mark")
            .dropna("all", subset=names)
            .withColumn("_us", F.lit(FIRST))
        )


def split_hot_keys(
    frames: list[tuple[DataFrame, str]],
    by: str,
    hot_rows: int = HOT_ROWS,
    slice_rows: int = SLICE_ROWS,
    max_keys: int = MAX_HOT_KEYS,
) -> KeySplit:
    """Finds the keys with more than ``hot_rows`` rows over all frames.

    Each frame comes with its timestamp column. Reads two columns and combines
    counts before the shuffle. Slices are far smaller than ``hot_rows`` so that a
    burst inside a key still leaves slices a task can sort.
    """
    rows = None
    for df, ts in frames:
        part = df.selectExpr(by, f"unix_micros({ts}) AS _us")
        rows = part if rows is None else rows.unionByName(part)
    hot = (
        rows.where(f"{by} IS NOT NULL AND _us IS NOT NULL")
        .groupBy(by)
        .agg(F.count("*").alias("_n"), F.min("_us").alias("_lo"), F.max("_us").alias("_hi"))
        .where(f"_n > {hot_rows}")
        .orderBy(F.desc("_n"), by)
        .limit(max_keys)
        .selectExpr(by, "_lo", "_hi", f"least(ceil(_n / {slice_rows}), {MAX_SLICES}) AS _spans")
        .selectExpr(by, "array(_lo, ceil((_hi - _lo + 1) / _spans), _spans) AS _cut")
    )
    return KeySplit(by, hot)
