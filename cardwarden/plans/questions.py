"""The business questions as functions of the feeds and the scored table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.risk import has_ato_signal
from ..operators.slices import KeySplit
from . import cases as case_ops
from . import kpis
from .gold import join_cases


def q0_cases_of_account(scored: DataFrame, cases: DataFrame, account_id) -> DataFrame:
    """Takeover-linked cases of one account, with reason codes and narrative."""
    mine = scored.where((F.col("account_id") == F.lit(account_id)) & has_ato_signal())
    return join_cases(mine, cases.where(F.col("account_id") == F.lit(account_id)))


def q1_ato_declines_by_region(
    fused: DataFrame, hours: int = 1, clock: DataFrame | None = None
) -> DataFrame:
    """Takeover-linked declines in the last hour, by region."""
    return kpis.ato_declines_by_region(fused, hours, clock=clock)


def q2_shared_devices(auth: DataFrame, min_accounts: int = 5) -> DataFrame:
    """Device fingerprints on more than five accounts today."""
    return kpis.shared_devices(auth, min_accounts)


def q3_device_then_spend(
    auth: DataFrame, txn: DataFrame, amount: float = 60, within_seconds: int = 7200,
    split: KeySplit | None = None,
) -> DataFrame:
    """New-device logins followed by a high-value purchase, per day of the last week."""
    week = 7 * 86_400
    return kpis.device_then_spend_trend(
        kpis.within_last(auth, "event_ts", week), txn, amount, within_seconds, split
    )


def q4_travel_fp_rate(txn: DataFrame, travel_mcc: Sequence[str]) -> DataFrame:
    """Today's false-positive decline rate on travel merchants."""
    return kpis.travel_fp_rate(txn, travel_mcc, today_only=True)


def q5_top_risk_approved(scored: DataFrame, cases: DataFrame, n: int = 10) -> DataFrame:
    """The ten riskiest approved transactions with their narrative."""
    return case_ops.top_risk_approved(scored, cases, n)


def q6_loss_avoided(txn: DataFrame) -> DataFrame:
    """Fraud loss avoided, the newest week against the one before."""
    return kpis.weekly_loss_avoided(txn).orderBy(F.col("week").desc()).limit(1)


def q7_latency_by_segment(df: DataFrame, latency_col: str) -> DataFrame:
    """Mean decision latency by segment today; the feeds carry no latency, so the column is named."""
    return kpis.avg_by_segment(kpis.on_last_day(df, "txn_ts"), latency_col)


def q8_loss_and_fp(txn: DataFrame, days: int = 7) -> DataFrame:
    """Fraud loss avoided beside the false-positive rate, last seven days."""
    return kpis.daily_loss_and_fp(txn, days)
