"""Counts, rates and losses. Money is summed in whole cents and reported in units."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.risk import cents, is_ato_linked_curated, split_codes
from ..operators.asof import followed_by
from ..operators.slices import KeySplit


def _is_fraud() -> Column:
    return F.col("fraud_label") == 1


def _declined() -> Column:
    return F.col("decision") == "decline"


def _approved() -> Column:
    return F.col("decision") == "approve"


def _false_decline() -> Column:
    return _declined() & (F.col("fraud_label") == 0)


def _sum_cents(cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, cents("amount"))), F.lit(0))


def _money(total: Column) -> Column:
    return total / F.lit(100.0)


def _ratio(num: Column, den: Column, digits: int = 6) -> Column:
    return F.round(F.try_divide(num.cast("double"), den.cast("double")), digits)


def _grouped(df: DataFrame, by: Sequence[str], *aggs: Column) -> DataFrame:
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def within_last(
    df: DataFrame, ts: str, seconds: int, clock: DataFrame | None = None
) -> DataFrame:
    """Rows of the last ``seconds`` before the newest time in the data, not in the wall clock.

    ``clock`` is a cheaper frame that holds the same newest time, such as the feed.
    """
    newest = (clock if clock is not None else df).agg(F.max(ts)).scalar()
    # The bare column on one side: files whose times are all older are not read.
    return df.where(F.col(ts) > newest - F.make_dt_interval(secs=F.lit(seconds)))


def on_last_day(df: DataFrame, ts: str, clock: DataFrame | None = None) -> DataFrame:
    """Rows of the newest calendar day in the data ("today")."""
    today = (clock if clock is not None else df).agg(F.date_trunc("day", F.max(ts))).scalar()
    return df.where(F.col(ts) >= today)


def profile(auth: DataFrame, txn: DataFrame, accounts: DataFrame) -> DataFrame:
    """One row that sums up the three feeds."""
    parts = [
        accounts.agg(F.count("*").alias("accounts")),
        auth.agg(
            F.count("*").alias("auth_events"), F.count_if(F.col("ato_label") == 1).alias("ato_logins")
        ),
        txn.agg(
            F.count("*").alias("card_transactions"),
            F.count_if(_is_fraud()).alias("fraud"),
            F.count_if(_declined()).alias("declines"),
            F.count_if(_false_decline()).alias("false_positive_declines"),
        ),
    ]
    names = [c for p in parts for c in p.columns]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    total = rows.agg(*[F.max(c).alias(c) for c in names])
    return total.withColumn("fraud_rate", _ratio(F.col("fraud"), F.col("card_transactions")))


def row_counts(dfs: dict[str, DataFrame]) -> DataFrame:
    """Rows per named frame."""
    out = None
    for name, df in dfs.items():
        part = df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


def label_counts(df: DataFrame, label: str = "fraud_label") -> DataFrame:
    """Rows per label value."""
    return df.groupBy(label).agg(F.count("*").alias("n"))


def fp_decline_rate(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Declines that were not fraud, over all declines."""
    out = _grouped(
        df, by, F.count_if(_declined()).alias("declines"),
        F.count_if(_false_decline()).alias("false_positive_declines"),
    )
    return out.withColumn(
        "fp_decline_rate", _ratio(F.col("false_positive_declines"), F.col("declines"))
    )


def net_fraud_loss(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Approved fraud, in money."""
    return _grouped(
        df, by, _money(_sum_cents(_is_fraud() & _approved())).alias("net_fraud_loss")
    )


def loss_bps(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Approved fraud over approved volume, in basis points."""
    out = _grouped(
        df, by, _sum_cents(_is_fraud() & _approved()).alias("_loss"),
        _sum_cents(_approved()).alias("_volume"),
    )
    return out.select(
        *by, _money(F.col("_loss")).alias("net_fraud_loss"),
        _money(F.col("_volume")).alias("approved_volume"),
        _ratio(F.col("_loss") * 10_000, F.col("_volume"), 4).alias("loss_bps"),
    )


def false_declines_per_fraud(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Good transactions declined for each fraud."""
    out = _grouped(
        df, by, F.count_if(_false_decline()).alias("false_declines"),
        F.count_if(_is_fraud()).alias("frauds"),
    )
    return out.withColumn(
        "false_declines_per_fraud", _ratio(F.col("false_declines"), F.col("frauds"))
    )


def mttd(fused: DataFrame, auth: DataFrame) -> DataFrame:
    """Mean minutes from a takeover login to the first transaction that carries its signal.

    ``fused`` is the as-of fusion with its login columns. Logins no transaction
    followed are counted but have no delay.
    """
    delay = F.unix_micros("txn_ts") - F.unix_micros("last_auth_ts")
    caught = (
        fused.where("recent_ato_label = 1").groupBy("last_event_id")
        .agg(F.min(delay).cast("decimal(20,0)").alias("_delay"))
        .agg(F.count("*").alias("n_detected"), F.sum("_delay").cast("double").alias("_sum"))
    )
    all_ato = auth.where("ato_label = 1").agg(F.count("*").alias("n_ato_logins"))
    both = caught.unionByName(all_ato, allowMissingColumns=True).agg(
        *[F.max(c).alias(c) for c in ("n_ato_logins", "n_detected", "_sum")]
    )
    mean = F.try_divide(F.col("_sum"), F.col("n_detected") * F.lit(60e6))
    return both.select(
        "n_ato_logins", "n_detected", F.round(mean, 4).alias("mean_minutes_to_detect")
    )


def shared_devices(
    auth: DataFrame, min_accounts: int = 5, approx: bool = False, today_only: bool = True
) -> DataFrame:
    """Devices seen on more than ``min_accounts`` accounts on the newest day.

    Exact counting first drops repeats of (device, account); ``approx`` keeps a
    small sketch per device instead.
    """
    logins = on_last_day(auth, "event_ts") if today_only else auth
    count = F.approx_count_distinct("account_id") if approx else F.count_distinct("account_id")
    return (
        logins.where(F.col("device_id").isNotNull()).groupBy("device_id")
        .agg(count.alias("n_accounts")).where(F.col("n_accounts") > min_accounts)
    )


def travel_fp_rate(df: DataFrame, travel_mcc: Sequence[str], today_only: bool = False) -> DataFrame:
    """False-positive decline rate on travel merchants."""
    rows = on_last_day(df, "txn_ts") if today_only else df
    return fp_decline_rate(rows.where(F.col("mcc").isin(*travel_mcc)))


def _avoided() -> Column:
    return _sum_cents(_is_fraud() & _declined())


def weekly_loss_avoided(df: DataFrame) -> DataFrame:
    """Declined fraud per week beside the week before. One row per week with transactions.

    The week before is the calendar week; if it has no transactions its sum and
    the change are null, as in the first week.
    """
    weekly = df.where(F.col("txn_ts").isNotNull()).groupBy(
        F.to_date(F.date_trunc("week", "txn_ts")).alias("week")
    ).agg(_avoided().alias("_c"))
    # The window runs over the weeks, not over the rows.
    weeks = Window.orderBy("week")
    adjoining = F.lag("week").over(weeks) == F.date_sub("week", 7)
    before = F.when(adjoining, F.lag("_c").over(weeks))
    return weekly.withColumn("_p", before).select(
        "week", _money(F.col("_c")).alias("loss_avoided"),
        _money(F.col("_p")).alias("loss_avoided_prev_week"),
        _money(F.col("_c") - F.col("_p")).alias("change"),
    )


def daily_loss_and_fp(df: DataFrame, days: int = 7) -> DataFrame:
    """Declined fraud and false-positive rate per day over the last days of the data."""
    recent = within_last(df, "txn_ts", days * 86_400)
    out = recent.groupBy(F.to_date("txn_ts").alias("day")).agg(
        _money(_avoided()).alias("loss_avoided"),
        F.count_if(_declined()).alias("declines"),
        F.count_if(_false_decline()).alias("false_positive_declines"),
    )
    return out.withColumn(
        "fp_decline_rate", _ratio(F.col("false_positive_declines"), F.col("declines"))
    )


def device_then_spend_trend(
    auth: DataFrame, txn: DataFrame, amount: float = 60, within_seconds: int = 7200,
    split: KeySplit | None = None,
) -> DataFrame:
    """Per day: new-device logins that a high-value purchase followed."""
    hits = followed_by(
        auth.where("device_is_new = 1").select("event_id", "account_id", "event_ts"),
        txn.where(F.col("amount") >= amount), within_seconds, split,
    )
    return hits.groupBy(F.to_date("event_ts").alias("day")).agg(
        F.count("*").alias("n_logins"),
        F.sum("n_purchases").alias("n_purchases"),
        _money(F.sum(cents("first_amount"))).alias("first_purchase_spend"),
    )


def ato_declines_by_region(
    fused: DataFrame, hours: int = 1, linked: Column | None = None, clock: DataFrame | None = None
) -> DataFrame:
    """Takeover-linked declines of the last hours of the data, by home place."""
    linked = is_ato_linked_curated() if linked is None else linked
    recent = within_last(fused, "txn_ts", hours * 3600, clock)
    return recent.where(_declined() & linked).groupBy("home_geo").agg(
        F.count("*").alias("n_declines"), _money(F.sum(cents("amount"))).alias("declined_amount")
    )


def avg_by_segment(df: DataFrame, col: str) -> DataFrame:
    """Mean of a column by segment, summed exactly to two decimals."""
    total = F.sum(F.col(col).cast("decimal(18,2)")).cast("double")
    return df.groupBy("segment").agg(
        F.count(col).alias("n"), F.round(F.try_divide(total, F.count(col)), 4).alias("mean")
    )


def _pilot(rows: DataFrame, by: Sequence[str], held: Column, weight: Column) -> DataFrame:
    def tally(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, weight)), F.lit(0)).cast("bigint")

    def money(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("_cents"))), F.lit(0)).cast("bigint")

    missed = _is_fraud() & _approved()
    good = F.col("fraud_label") == 0
    out = rows.groupBy(*by).agg(
        money(missed).alias("_loss"), money(missed & held).alias("_saved"),
        tally(good & _declined()).alias("false_declines_now"),
        tally(good & held).alias("false_holds_policy"),
        tally(good & _approved() & held).alias("added_false_holds"),
    )
    cut = _ratio(F.col("_saved"), F.col("_loss"))
    passes = (cut >= 0.15) & (F.col("false_holds_policy") <= F.col("false_declines_now"))
    return out.select(
        *by, _money(F.col("_loss")).alias("loss_now"),
        _money(F.col("_saved")).alias("loss_prevented"), cut.alias("loss_cut"),
        "false_declines_now", "false_holds_policy", "added_false_holds",
        F.coalesce(passes, F.lit(False)).cast("int").alias("pilot_pass"),
    )


def shadow_eval(scored: DataFrame, threshold: float, by: str = "segment") -> DataFrame:
    """What holding at a score threshold would have done, per segment.

    Passes with at least 15% of the loss cut and no more good transactions held
    than are declined today.
    """
    held = F.coalesce(F.col("risk_score") >= threshold, F.lit(False))
    return _pilot(scored.withColumn("_cents", cents("amount")), [by], held, F.lit(1))


def threshold_sweep(
    scored: DataFrame, thresholds: Sequence[float], by: str = "segment"
) -> DataFrame:
    """``shadow_eval`` at many thresholds.

    Rows are first summed per (segment, decision, label, number of thresholds the
    unrounded score reaches), and only those sums meet the thresholds.
    """
    steps = [float(t) for t in sorted(set(thresholds))]
    ordered = F.array(*[F.lit(t) for t in steps])
    reached = F.size(F.filter(ordered, lambda t: F.coalesce(F.col("risk_score") >= t, F.lit(False))))
    summed = scored.groupBy(by, "decision", "fraud_label", reached.alias("_reached")).agg(
        F.count("*").alias("_n"), F.sum(cents("amount")).alias("_cents")
    )
    grid = summed.select("*", F.posexplode(ordered).alias("_step", "threshold"))
    held = F.col("_reached") > F.col("_step")
    return _pilot(grid, [by, "threshold"], held, F.col("_n"))


def code_frequency(df: DataFrame) -> DataFrame:
    """How often each reason code fired."""
    return (
        df.select(F.explode(split_codes()).alias("reason_code"))
        .groupBy("reason_code").agg(F.count("*").alias("n"))
    )
