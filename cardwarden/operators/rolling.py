"""Sums over a moving span of time per key.

A sliding range frame is evaluated row by row over the frame, which is quadratic
for a busy account. Here each value enters a running sum at its own time and
leaves it again when the span has passed, so one ordered pass gives the answer,
and running sums can be cut into time slices (see ``slices``). Values are whole
numbers, which makes entering and leaving exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.risk import cents, minutes_between
from .asof import previous_row
from .slices import SLICE, KeySplit, split_hot_keys


@dataclass(frozen=True)
class Rolling:
    """Sum of ``value`` (a whole number) over the last ``seconds``.

    The span is closed on both ends; without ``current`` it ends one
    microsecond before the row.
    """

    name: str
    value: Column
    seconds: int
    current: bool = True

    @property
    def leaves_after(self) -> int:
        """Microseconds after its own time at which a value leaves the sum."""
        return self.seconds * 1_000_000 + (1 if self.current else 0)


def _sweep(
    probes: DataFrame, events: DataFrame | None, by: str, specs: Sequence[Rolling],
    split: KeySplit, mirrored: bool,
) -> DataFrame:
    """Adds the sums to ``probes``; ``events`` None means that the probes are the events.

    Both frames carry ``_us``, the events also ``_v<i>`` per spec.
    """
    values = [f"_v{i}" for i in range(len(specs))]
    entering = probes if events is None else events
    spans = sorted({s.leaves_after for s in specs})
    leaving = (
        entering.where(F.col(by).isNotNull() & F.col("_us").isNotNull())
        .select(by, "_us", *values, F.explode(F.array(*[F.lit(s) for s in spans])).alias("_span"))
        .select(
            by, (F.col("_us") + F.col("_span")).alias("_us"),
            *[
                F.when(F.col("_span") == s.leaves_after, -F.col(v)).otherwise(0).alias(v)
                for s, v in zip(specs, values)
            ],
        )
    )
    rows = probes.withColumn("_probe", F.lit(True)).unionByName(leaving, allowMissingColumns=True)
    if events is not None:
        rows = rows.unionByName(events.select(by, "_us", *values), allowMissingColumns=True)
    rows = split.slice(rows, "_us", mirrored)
    # What leaves a cut key's sums after its last probe serves none, and would pile up in one
    # slice. One row for each cut key, so it is as small as the table of cut keys.
    last = rows.where("_probe AND _cut IS NOT NULL").groupBy(by).agg(F.max("_us").alias("_last"))
    rows = (
        rows.join(F.broadcast(last), by, "left")
        .where("_probe OR _cut IS NULL OR _us <= _last")
        .drop("_last")
    )
    seeds = split.seeds(rows, {v: F.sum(v) for v in values}, F.sum, mirrored)
    ordered = Window.partitionBy(by, SLICE).orderBy("_us")
    sums = {}
    for spec, v in zip(specs, values):
        frame = ordered.rangeBetween(Window.unboundedPreceding, 0 if spec.current else -1)
        known = F.col("_us").isNotNull() & F.col(by).isNotNull()
        sums[spec.name] = F.when(known, F.coalesce(F.sum(v).over(frame), F.lit(0)))
    return (
        rows.unionByName(seeds, allowMissingColumns=True)
        .withColumns(sums)
        .where(F.col("_probe"))
        .drop("_us", "_probe", "_cut", SLICE, *values)
    )


def rolling_sums(
    df: DataFrame, by: str, ts: str, specs: Sequence[Rolling], split: KeySplit | None = None
) -> DataFrame:
    """Adds one bigint column per spec: the sum over the key's rows in the span up to the row."""
    split = split or split_hot_keys([(df, ts)], by)
    # A row without a time sorts before all others, and must not enter their sums.
    timed = F.col(ts).isNotNull()
    rows = df.withColumns({
        "_us": F.unix_micros(ts),
        **{
            f"_v{i}": F.when(timed, F.coalesce(s.value.cast("bigint"), F.lit(0))).otherwise(0)
            for i, s in enumerate(specs)
        },
    })
    return _sweep(rows, None, by, specs, split, mirrored=False)


def forward_sums(
    probes: DataFrame, events: DataFrame, by: str, probe_ts: str, event_ts: str,
    specs: Sequence[Rolling], split: KeySplit | None = None,
) -> DataFrame:
    """Adds to each probe row the sums over the key's events in the span that starts at it."""
    split = split or split_hot_keys([(probes, probe_ts), (events, event_ts)], by)
    entering = events.where(F.col(event_ts).isNotNull()).select(
        by, (-F.unix_micros(event_ts)).alias("_us"),
        *[
            F.coalesce(s.value.cast("bigint"), F.lit(0)).alias(f"_v{i}")
            for i, s in enumerate(specs)
        ],
    )
    asking = probes.withColumn("_us", -F.unix_micros(probe_ts))
    return _sweep(asking, entering, by, specs, split, mirrored=True)


def txn_velocity(df: DataFrame, seconds: int = 3600, split: KeySplit | None = None) -> DataFrame:
    """``txn_velocity_1h``: the account's transactions in the span, this one included."""
    return rolling_sums(
        df, "account_id", "txn_ts", [Rolling("txn_velocity_1h", F.lit(1), seconds)], split
    )


def _vs_avg(days: int) -> list[Rolling]:
    span = days * 86_400
    return [
        Rolling("_n", F.lit(1), span, current=False),
        Rolling("_c", cents("amount"), span, current=False),
    ]


def add_vs_avg(df: DataFrame) -> DataFrame:
    """amount / (sum / count) to 4 decimals, half up, in whole numbers: neither the size of
    the products nor the last bit of a quotient can spoil it."""
    ratio = F.expr("""(cast(_own AS decimal(19,0)) * cast(_n AS decimal(14,0)) * 20000 + _c)
        div (2 * nullif(_c, 0)) / 1e4""")
    return (
        df.withColumn("_own", cents("amount"))
        .withColumn("amount_vs_30d_avg", ratio)
        .drop("_n", "_c", "_own")
    )


def amount_vs_avg(df: DataFrame, days: int = 30, split: KeySplit | None = None) -> DataFrame:
    """``amount_vs_30d_avg``: amount over the account's mean amount before it; null without history."""
    return add_vs_avg(rolling_sums(df, "account_id", "txn_ts", _vs_avg(days), split))


def card_test_burst(
    df: DataFrame, max_amount: float = 10, seconds: int = 3600, min_count: int = 2,
    split: KeySplit | None = None,
) -> DataFrame:
    """Count of small amounts in the span, and ``card_test_burst`` where they reach the minimum."""
    small = (F.col("amount") < max_amount).cast("int")
    out = rolling_sums(
        df, "account_id", "txn_ts", [Rolling("small_txns_1h", small, seconds)], split
    )
    return out.withColumn("card_test_burst", (F.col("small_txns_1h") >= min_count).cast("int"))


def spend_features(df: DataFrame, split: KeySplit | None = None) -> DataFrame:
    """Velocity, amount against the 30-day mean and small-amount count in a single pass."""
    small = (F.col("amount") < 10).cast("int")
    specs = [
        Rolling("txn_velocity_1h", F.lit(1), 3600),
        Rolling("small_txns_1h", small, 3600),
        *_vs_avg(30),
    ]
    return add_vs_avg(rolling_sums(df, "account_id", "txn_ts", specs, split))


def failed_attempts(
    auth: DataFrame, seconds: int = 3600, split: KeySplit | None = None
) -> DataFrame:
    """``failed_in_span``: failed logins of the account in the span, for feeds that lack the count."""
    failure = (F.col("auth_result") == "failure").cast("int")
    return rolling_sums(
        auth, "account_id", "event_ts", [Rolling("failed_in_span", failure, seconds)], split
    )


def geo_impossible(
    auth: DataFrame, max_gap_seconds: int = 3600, split: KeySplit | None = None
) -> DataFrame:
    """Logins from another place than the account's previous login, too soon after it."""
    dated = auth.where(F.col("account_id").isNotNull() & F.col("event_ts").isNotNull())
    prev = {"event_id": "prev_event_id", "ip_geo": "prev_geo", "event_ts": "prev_ts"}
    moved = previous_row(dated, "account_id", "event_ts", "event_id", prev, split)
    gap = F.unix_micros("event_ts") - F.unix_micros("prev_ts")
    return moved.withColumn("gap_minutes", minutes_between("event_ts", "prev_ts")).where(
        (F.col("ip_geo") != F.col("prev_geo")) & (gap < max_gap_seconds * 1_000_000)
    )
