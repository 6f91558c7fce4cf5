"""Typed, rule-checked streams and windowed activity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.risk import cents
from ..operators.quality import RULES, apply_rules, observed, to_silver


def silver_stream(raw: DataFrame, feed: str, metrics: str | None = None) -> DataFrame:
    """The batch projection and drop rules on a stream; ``metrics`` names the per-batch counts."""
    typed = to_silver(raw, feed)
    if metrics:
        typed = observed(typed, RULES[feed], metrics)
    return apply_rules(typed, RULES[feed])


def with_open_windows(closed: DataFrame, txn: DataFrame, **spans: str) -> DataFrame:
    """The windows a stream has closed, and the others counted over the stored feed."""
    every = velocity_stream(txn, **spans)
    same = (every["window_start"] == closed["window_start"]) & every["account_id"].eqNullSafe(
        closed["account_id"]
    )
    return closed.unionByName(every.join(closed, same, "left_anti"))


def velocity_stream(
    txn: DataFrame, delay: str = "1 hour", span: str = "1 hour", every: str = "15 minutes"
) -> DataFrame:
    """Transactions and spend per account in overlapping windows, closed by the watermark."""
    return (
        txn.withWatermark("txn_ts", delay)
        .groupBy(F.window("txn_ts", span, every), "account_id")
        .agg(F.count("*").alias("n_txns"), F.sum(cents("amount")).alias("spend_cents"))
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
            "account_id", "n_txns", "spend_cents",
        )
    )
