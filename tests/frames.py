"""Small typed frames for the tests."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from cardwarden.operators.quality import to_silver
from cardwarden.schemas import ACCOUNTS_RAW, AUTH_RAW, TXN_RAW

T0 = datetime(2026, 9, 30, 18, 0)

AUTH = (
    "event_id string, account_id string, event_ts timestamp, device_id string, device_is_new int, "
    "ip_geo string, geo_is_new int, auth_result string, failed_attempts_1h int, mfa_used int, "
    "ato_label int"
)
TXN = (
    "txn_id string, account_id string, txn_ts timestamp, amount double, mcc string, "
    "merchant_country string, channel string, pan_token string, decision string, fraud_label int"
)
ACCOUNTS = (
    "account_id string, open_date date, credit_limit double, segment string, home_geo string, "
    "email string, pan_token string"
)


def at(minutes: float):
    """A time so many minutes after T0."""
    return T0 + timedelta(microseconds=round(minutes * 60_000_000))


def login(event_id, account, minutes, new=0, geo="US-NY", fails=0, ato=0, result="success",
          device="dev_a"):
    ts = None if minutes is None else at(minutes)
    return (event_id, account, ts, device, new, geo, 0, result, fails, 0, ato)


def spend(txn_id, account, minutes, amount=20.0, decision="approve", fraud=0, mcc="5411"):
    ts = None if minutes is None else at(minutes)
    return (txn_id, account, ts, amount, mcc, "US", "ecom", "tok_x", decision, fraud)


def account(account_id, home="US-NY", segment="mass"):
    return (account_id, date(2025, 1, 2), 2500.0, segment, home, "user1@example.invalid", "tok_1234abcd")


def auth_frame(spark, *rows):
    return spark.createDataFrame(list(rows), AUTH)


def txn_frame(spark, *rows):
    return spark.createDataFrame(list(rows), TXN)


def account_frame(spark, *rows):
    return spark.createDataFrame(list(rows), ACCOUNTS)


def demo(spark):
    """The published demo rows, from raw text to silver."""
    auth = spark.createDataFrame(
        [("EVT-DEMO-ATO", "ACC-100042", "2026-09-30T17:56:00+00:00", "dev_new_91f2", "1", "GB-LON",
          "1", "success", "4", "0", "1")], AUTH_RAW)
    txn = spark.createDataFrame(
        [("TXN-DEMO-ATO", "ACC-100042", "2026-09-30T18:00:00+00:00", "2318.47", "5732", "GB",
          "ecom", "tok_8238295cccb4d5b2", "approve", "1")], TXN_RAW)
    accounts = spark.createDataFrame(
        [("ACC-100042", "2025-01-02", "2500", "premium", "US-NY", "user100042@example.invalid",
          "tok_8238295cccb4d5b2")], ACCOUNTS_RAW)
    return to_silver(auth, "auth"), to_silver(txn, "txn"), to_silver(accounts, "accounts")
