"""Gold: one row per transaction with the features of its latest login."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.risk import (
    add_reason_codes, geo_mismatch, minutes_between, minutes_since, null_safe_counts,
)
from ..operators.asof import asof_join, latest_join
from ..operators.dedup import dedup_latest
from ..operators.slices import SLICE, KeySplit, split_hot_keys
from ..schemas import GOLD_COLUMNS

LOGIN_COLUMNS = ["device_is_new", "failed_attempts_1h", "ato_label", "ip_geo"]
ACCOUNT_COLUMNS = ["home_geo", "segment", "credit_limit"]


def dedup_accounts(accounts: DataFrame) -> DataFrame:
    """One row per account: the latest opened, then the greater token."""
    return dedup_latest(accounts, ["account_id"], ["open_date", "pan_token"])


def dedup_auth(auth: DataFrame) -> DataFrame:
    """One login per account and time: the greater event id."""
    return dedup_latest(auth, ["account_id", "event_ts"], ["event_id"])


def dedup_txn(txn: DataFrame) -> DataFrame:
    """One row per transaction id: the newest, equal times settled by the other columns."""
    return dedup_latest(txn, ["txn_id"], ["txn_ts", "amount", "decision", "mcc", "channel"])


def enrich_accounts(df: DataFrame, accounts: DataFrame, split: KeySplit | None = None) -> DataFrame:
    """Left join of transactions to the account master; hot accounts are spread over tasks."""
    split = split or split_hot_keys([(df, "txn_ts")], "account_id")
    return split.join_dim(df, "txn_ts", accounts.select("account_id", *ACCOUNT_COLUMNS))


def _features(df: DataFrame) -> DataFrame:
    return add_reason_codes(null_safe_counts(geo_mismatch(minutes_since(df))))


def fuse(
    txn: DataFrame,
    auth: DataFrame,
    accounts: DataFrame,
    split: KeySplit | None = None,
    dedup: bool = True,
) -> DataFrame:
    """As-of fusion with all helper columns (login id, places, code array) kept.

    Logins of equal account and time need no step of their own: the as-of order
    already lets the greater event id win. Without ``dedup`` the caller vouches
    for unique transactions and accounts.
    """
    split = split or split_hot_keys([(txn, "txn_ts"), (auth, "event_ts")], "account_id")
    if dedup:
        txn, accounts = dedup_txn(txn), dedup_accounts(accounts)
    logins = auth.select(
        "account_id", "event_ts", F.col("event_ts").alias("last_auth_ts"),
        F.col("event_id").alias("last_event_id"), *LOGIN_COLUMNS,
    )
    matched = asof_join(
        txn, logins, "account_id", "txn_ts", "event_ts",
        ["last_auth_ts", "last_event_id", *LOGIN_COLUMNS], "last_event_id",
        split=split, keep_slice=True,
    )
    # The rows lie by (account, slice) already, so the master comes to them.
    master = split.spread(accounts.select("account_id", *ACCOUNT_COLUMNS))
    return _features(matched.join(master, ["account_id", SLICE], "left").drop(SLICE))


def gold(
    txn: DataFrame, auth: DataFrame, accounts: DataFrame, split: KeySplit | None = None
) -> DataFrame:
    """The 15 gold columns."""
    return fuse(txn, auth, accounts, split).select(*GOLD_COLUMNS)


def fuse_latest(
    txn: DataFrame, auth: DataFrame, accounts: DataFrame, split: KeySplit | None = None
) -> DataFrame:
    """Fusion with each account's current login state instead of the as-of one."""
    split = split or split_hot_keys([(txn, "txn_ts")], "account_id")
    logins = auth.select(
        "account_id", "event_id", "event_ts", F.col("event_ts").alias("last_auth_ts"),
        *LOGIN_COLUMNS,
    )
    joined = latest_join(
        txn, logins, "account_id", "txn_ts", "event_ts", "event_id",
        ["last_auth_ts", *LOGIN_COLUMNS], split,
    )
    return _features(enrich_accounts(joined, accounts, split))


def since_new_device(
    txn: DataFrame, auth: DataFrame, tolerance_seconds: float | None = None,
    split: KeySplit | None = None,
) -> DataFrame:
    """``minutes_since_last_new_device``: only logins from a new device count."""
    fresh = auth.where("device_is_new = 1").select(
        "account_id", "event_ts", F.col("event_ts").alias("new_device_ts"), "event_id"
    )
    out = asof_join(
        txn, fresh, "account_id", "txn_ts", "event_ts", ["new_device_ts"], "event_id",
        tolerance_seconds, split,
    )
    return out.withColumn(
        "minutes_since_last_new_device", minutes_between("txn_ts", "new_device_ts")
    )


def join_cases(gold_df: DataFrame, cases: DataFrame) -> DataFrame:
    """Left join of gold to its case narratives."""
    return gold_df.join(cases.select("txn_id", "reason_narrative"), "txn_id", "left")
