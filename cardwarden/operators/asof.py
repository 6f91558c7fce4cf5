"""Time-ordered joins by account: as-of, latest-row, followed-by, previous row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .dedup import dedup_latest
from .slices import SLICE, KeySplit, split_hot_keys


def _match(
    left: DataFrame,
    right: DataFrame,
    by: str,
    left_ts: str,
    right_ts: str,
    right_cols: Sequence[str],
    tie: str,
    split: KeySplit,
    forward: bool,
) -> DataFrame:
    """Left rows with ``_match``: the nearest right row on the wanted side, or null.

    Both sides are stacked and sorted once per (key, slice); the last right row
    seen is carried along. Forward matching is the same on a mirrored clock.
    Equal times match. Among right rows of equal time the greatest ``tie`` wins
    backward, the smallest forward, that is the nearest in (time, tie) order.
    """
    found = F.struct(F.unix_micros(right_ts).alias("_at"), *[F.col(c) for c in right_cols])
    clock = (lambda ts: -F.unix_micros(ts)) if forward else F.unix_micros
    events = right.where(F.col(by).isNotNull() & F.col(right_ts).isNotNull()).select(
        F.col(by), clock(right_ts).alias("_us"), F.lit(0).alias("_side"),
        F.col(tie).alias("_tie"), found.alias("_found"),
    )
    probes = left.withColumns({"_us": clock(left_ts), "_side": F.lit(1)})
    events = split.slice(events, "_us", mirrored=forward)
    probes = split.slice(probes, "_us", mirrored=forward)
    pick = F.min_by if forward else F.max_by
    nearest = pick("_found", F.struct("_found._at", "_tie"))
    seeds = split.seeds(
        events, {"_found": nearest}, lambda c: F.last(c, ignorenulls=True), mirrored=forward
    ).withColumn("_side", F.lit(0))
    tie_order = F.col("_tie").desc() if forward else F.col("_tie").asc()
    seen = (
        Window.partitionBy(by, SLICE)
        .orderBy(F.col("_us").asc_nulls_first(), "_side", tie_order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        probes.drop("_cut")
        .unionByName(events.drop("_cut"), allowMissingColumns=True)
        .unionByName(seeds, allowMissingColumns=True)
        .withColumn("_match", F.last("_found", ignorenulls=True).over(seen))
        .where(F.col("_side") == 1)
        .drop("_found", "_side", "_tie")
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str,
    left_ts: str,
    right_ts: str,
    right_cols: Sequence[str],
    tie: str,
    tolerance_seconds: float | None = None,
    split: KeySplit | None = None,
    forward: bool = False,
    keep_slice: bool = False,
) -> DataFrame:
    """Left outer as-of join: each left row with the latest right row at or before it.

    ``right_cols`` come out under their own names, so they must not clash with
    left columns. With ``forward`` the earliest right row at or after is taken.
    A left row with a null key or time stays, unmatched. One shuffle of both
    sides; hot keys are cut into time slices (see ``slices``).
    """
    split = split or split_hot_keys([(left, left_ts), (right, right_ts)], by)
    out = _match(left, right, by, left_ts, right_ts, right_cols, tie, split, forward)
    kept = f"_match IS NOT NULL AND {by} IS NOT NULL"
    if tolerance_seconds is not None:
        limit = int(tolerance_seconds * 1_000_000)
        kept += f" AND abs(unix_micros({left_ts}) - _match._at) <= {limit}"
    extra = [SLICE] if keep_slice else []
    return out.selectExpr(
        *left.columns, *[f"CASE WHEN {kept} THEN _match.{c} END AS {c}" for c in right_cols], *extra
    )


def latest_join(
    left: DataFrame, right: DataFrame, by: str, left_ts: str, right_ts: str, tie: str,
    right_cols: Sequence[str], split: KeySplit | None = None,
) -> DataFrame:
    """Left outer join to each key's single latest right row, whatever its time.

    Answers "what is the account's login state now"; it looks into the future of
    older left rows, so it must not feed a model.
    """
    split = split or split_hot_keys([(left, left_ts)], by)
    dated = right.where(F.col(right_ts).isNotNull() & F.col(by).isNotNull())
    newest = dedup_latest(dated.select(by, right_ts, tie, *right_cols), [by], [right_ts, tie])
    return split.join_dim(left, left_ts, newest.select(by, *right_cols))


def previous_row(
    df: DataFrame, by: str, ts: str, tie: str, cols: dict[str, str], split: KeySplit | None = None
) -> DataFrame:
    """Adds columns of the key's previous row in (time, tie) order; ``cols`` is source -> new name."""
    split = split or split_hot_keys([(df, ts)], by)
    rows = split.slice(df.withColumn("_us", F.unix_micros(ts)), "_us").withColumn(
        "_row", F.struct(*cols)
    )
    seeds = split.seeds(
        rows,
        {"_row": F.max_by("_row", F.struct("_us", tie))},
        lambda c: F.last(c, ignorenulls=True),
    ).withColumn("_is_seed", F.lit(True))
    ordered = Window.partitionBy(by, SLICE).orderBy(F.col("_us").asc_nulls_first(), tie)
    return (
        rows.unionByName(seeds, allowMissingColumns=True)
        .withColumn("_prev", F.lag("_row").over(ordered))
        .where(F.col("_is_seed").isNull())
        .select(*df.columns, *[F.col(f"_prev.{src}").alias(new) for src, new in cols.items()])
    )


def followed_by(
    logins: DataFrame,
    purchases: DataFrame,
    within_seconds: int,
    split: KeySplit | None = None,
) -> DataFrame:
    """Logins followed by a purchase of the same account within the given time.

    One row per login that has a follower: the first such purchase, how many
    there are and what they sum to. Listing every (login, purchase) pair grows
    with the square of a busy account; this carries the same answer in one row.
    """
    from .rolling import Rolling, forward_sums

    split = split or split_hot_keys([(logins, "event_ts"), (purchases, "txn_ts")], "account_id")
    first = asof_join(
        logins, purchases.select("account_id", "txn_id", "txn_ts", "amount"),
        "account_id", "event_ts", "txn_ts", ["txn_id", "txn_ts", "amount"], "txn_id",
        tolerance_seconds=within_seconds, split=split, forward=True,
    ).where(F.col("txn_id").isNotNull())
    counted = forward_sums(
        first, purchases, "account_id", "event_ts", "txn_ts",
        [
            Rolling("n_purchases", F.lit(1), within_seconds),
            Rolling("spend_cents", F.round(F.col("amount") * 100).cast("bigint"), within_seconds),
        ],
        split,
    )
    return counted.withColumnsRenamed(
        {"txn_id": "first_txn_id", "txn_ts": "first_txn_ts", "amount": "first_amount"}
    )
