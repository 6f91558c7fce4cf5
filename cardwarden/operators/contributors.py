"""Which features weigh most in a scored transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Importances of the published model card, in card order.
CARD_IMPORTANCES = {
    "amount": 0.8347,
    "minutes_since_new_device_login": 0.1542,
    "failed_logins_1h": 0.0093,
    "geo_mismatch_flag": 0.0017,
    "recent_ato_label": 0.0,
    "device_is_new": 0.0,
}


def _entry(pos: int, feature: str, known: bool, importance: float, floor: float) -> Column:
    value = F.coalesce(F.col(feature).cast("double"), F.lit(0.0)) if known else F.lit(0.0)
    fired = value != 0
    weight = F.when(fired, F.lit(max(importance, floor))).otherwise(F.lit(0.0))
    return F.struct(
        (-F.round(weight, 4)).alias("order1"),
        F.lit(-importance).alias("order2"),
        F.lit(pos).alias("order3"),
        F.lit(feature).alias("feature"),
        value.alias("value"),
        F.lit(importance).alias("importance"),
        F.round(weight, 4).alias("contribution"),
        F.when(fired, "Yes").otherwise("No").alias("fired"),
    )


def top_contributors(
    scored: DataFrame, importances: dict[str, float] | None = None, n: int = 5, floor: float = 0.05
) -> DataFrame:
    """The ``n`` heaviest features per transaction, one row each, ranked from 1.

    A feature with a nonzero value weighs its importance, but at least ``floor``;
    others weigh 0, and so does one the frame lacks. Ties keep card order. The few features are ranked inside the
    row, so nothing is shuffled.
    """
    card = importances or CARD_IMPORTANCES
    entries = F.array(*[
        _entry(i, name, name in scored.columns, float(imp), floor)
        for i, (name, imp) in enumerate(card.items())
    ])
    ranked = F.slice(F.array_sort(entries), 1, n)
    return (
        scored.select("txn_id", "account_id", F.posexplode(ranked).alias("_pos", "_e"))
        .select(
            "txn_id", "account_id", (F.col("_pos") + 1).alias("rank"),
            "_e.feature", "_e.value", "_e.importance", "_e.contribution", "_e.fired",
        )
    )
