"""Reads the ``events``, ``customer`` and ``nation`` tables as the three risk feeds.

The tables hold no card data, so the columns of the feeds are derived from the
event type, the value and ``k``, the number in the event's JSON properties.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.risk import ato_label, geo_is_new
from ..operators.slices import KeySplit, split_hot_keys

# Merchant category codes in published order.
MCC_CODES = ["5411", "5812", "5541", "7011", "4511", "5999", "7995", "5732"]
TRAVEL_MCC = ["7011", "4511"]

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)
CUSTOMER = (
    "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
)
NATION = "n_nationkey int, n_name string, n_regionkey int"

_K = "try_cast(get_json_object(props, '$.k') AS int) AS k"
_MCC = "element_at(array({}), k % 8 + 1) AS mcc".format(", ".join(f"'{m}'" for m in MCC_CODES))
_COUNTRY = "element_at(array('US', 'GB', 'CA'), k % 3 + 1) AS merchant_country"
_CHANNEL = "CASE WHEN k % 3 = 2 THEN 'card-present' ELSE 'ecom' END AS channel"
_DECISION = "CASE WHEN k % 7 = 0 THEN 'decline' ELSE 'approve' END AS decision"
_FRAUD = "cast(value >= 150 OR k % 25 = 0 AS int) AS fraud_label"


def _token(key: str) -> str:
    return f"concat('tok_', substring(sha2(concat('pan|', {key}, '|42'), 256), 1, 16)) AS pan_token"


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account master from ``customer`` and the small, fixed ``nation`` list."""
    customer = spark.read.schema(CUSTOMER).parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.schema(NATION).parquet(f"{sf_dir}/nation.parquet")
    return customer.join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    ).selectExpr(
        "c_custkey AS account_id",
        "date_add(DATE'2018-01-01', cast(c_custkey % 2500 AS int)) AS open_date",
        "c_acctbal AS credit_limit",
        "c_mktsegment AS segment",
        "n_regionkey AS home_geo",
        "concat('user', c_custkey, '@example.invalid') AS email",
        _token("c_custkey"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table, its schema given so that building a plan reads no file."""
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def auth_from(rows: DataFrame) -> DataFrame:
    """Login columns that follow from the event alone; batch or stream."""
    return (
        rows.where("event_type <> 'purchase'")
        .selectExpr("*", _K)
        .selectExpr(
            "event_id",
            "user_id AS account_id",
            "cast(ts AS timestamp) AS event_ts",
            "concat('dev_', k) AS device_id",
            "cast(k < 40 AS int) AS device_is_new",
            "CASE WHEN k % 10 <> 9 THEN k % 5 END AS ip_geo",
            "CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS auth_result",
            "CASE WHEN event_type = 'error' THEN k % 7 ELSE k % 2 END AS failed_attempts_1h",
            "k % 2 AS mfa_used",
        )
    )


def label_logins(auth: DataFrame, accts: DataFrame, split: KeySplit | None = None) -> DataFrame:
    """Adds the columns that need the home place: ``geo_is_new`` and ``ato_label``.

    A stream has no counts to split by, so it joins plainly.
    """
    home = accts.select("account_id", "home_geo")
    if split is None:
        placed = auth.join(home, "account_id", "left")
    else:
        placed = split.join_dim(auth, "event_ts", home)
    return ato_label(geo_is_new(placed)).drop("home_geo")


def txn_from(rows: DataFrame) -> DataFrame:
    """Card transactions; batch or stream."""
    return (
        rows.where("event_type = 'purchase' AND value > 0")
        .selectExpr("*", _K)
        .selectExpr(
            "event_id AS txn_id", "user_id AS account_id", "cast(ts AS timestamp) AS txn_ts",
            "value AS amount", _MCC, _COUNTRY, _CHANNEL, _token("user_id"), _DECISION, _FRAUD,
        )
    )


def raw_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All purchases as landing text, with the faults real landing files have."""
    return raw_txn_from(events(spark, sf_dir))


def raw_txn_from(rows: DataFrame) -> DataFrame:
    """The same from a given event frame; batch or stream."""
    return (
        rows.where("event_type = 'purchase'")
        .selectExpr("*", _K)
        .selectExpr(
            "CASE WHEN k % 29 <> 3 THEN cast(event_id AS string) END AS txn_id",
            "CASE WHEN k % 31 <> 5 THEN cast(user_id AS string) END AS account_id",
            "CASE WHEN k = 11 THEN 'yesterday' ELSE cast(ts AS string) END AS ts",
            "CASE WHEN k % 23 = 7 THEN 'n/a' ELSE cast(value AS string) END AS amount",
            _MCC, _COUNTRY, _CHANNEL, _token("user_id"), _DECISION,
            "cast(cast(value >= 150 OR k % 25 = 0 AS int) AS string) AS fraud_label",
        )
    )


def raw_auth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All logins as landing text, some without account or with an unreadable time or count."""
    typed = auth_from(events(spark, sf_dir))
    return typed.selectExpr("*", "cast(substring(device_id, 5) AS int) AS k").selectExpr(
        "cast(event_id AS string) AS event_id",
        "CASE WHEN k % 31 <> 5 THEN cast(account_id AS string) END AS account_id",
        "CASE WHEN k = 13 THEN '' ELSE cast(cast(event_ts AS timestamp_ntz) AS string) END AS ts",
        "device_id",
        "cast(device_is_new AS string) AS device_is_new",
        "cast(ip_geo AS string) AS ip_geo",
        "'0' AS geo_is_new",
        "auth_result",
        "CASE WHEN k = 17 THEN 'many' ELSE cast(failed_attempts_1h AS string) END"
        " AS failed_attempts_1h",
        "cast(mfa_used AS string) AS mfa_used",
        "'0' AS ato_label",
    )


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account master as landing text, some rows without key or with an unreadable limit."""
    return accounts(spark, sf_dir).selectExpr(
        "CASE WHEN account_id % 37 <> 1 THEN cast(account_id AS string) END AS account_id",
        "cast(open_date AS string) AS open_date",
        "CASE WHEN account_id % 41 = 2 THEN 'unlimited' ELSE cast(credit_limit AS string) END"
        " AS credit_limit",
        "segment", "cast(home_geo AS string) AS home_geo", "email", "pan_token",
    )


@dataclass(frozen=True)
class Feeds:
    """The three typed feeds of one data folder, and how their busiest accounts are cut."""

    auth: DataFrame
    txn: DataFrame
    accounts: DataFrame
    split: KeySplit


def load_feeds(spark: SparkSession, sf_dir: str, **split_sizes: int) -> Feeds:
    """All three feeds over the whole tables; ``split_sizes`` go to ``split_hot_keys``."""
    accts = accounts(spark, sf_dir)
    rows = events(spark, sf_dir)
    timed = rows.selectExpr("user_id AS account_id", "cast(ts AS timestamp) AS ts")
    split = split_hot_keys([(timed, "ts")], "account_id", **split_sizes)
    return Feeds(label_logins(auth_from(rows), accts, split), txn_from(rows), accts, split)
