"""Seeded feeds of any size with planted fraud patterns.

Every random number is a hash of (row, seed, purpose), so a row is the same
however the work is partitioned and rows need no look at one another. The
distributions follow the published generator; the values do not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.masks import pan_token
from ..schemas import ACCOUNTS_RAW, AUTH_RAW, RAW, TXN_RAW
from .driver_tables import MCC_CODES

# Fixed values of the published generator.
DEMO_ACCOUNT = "ACC-100042"
NOW = "2026-09-30T18:00:00+00:00"
SPAN_MINUTES = 14 * 24 * 60
HOME_GEOS = ["US-NY", "US-CA", "US-TX", "US-FL", "US-IL"]
GEOS = [*HOME_GEOS, "GB-LON", "DE-BER"]
LIMITS = [2500, 5000, 8000, 12000, 20000]
SEGMENTS = ["mass", "mass_affluent", "premium"]
NEW_DEVICE_RATE = 0.08
FOREIGN_GEO_RATE = 0.5
MFA_RATE = 0.7
CARD_TEST_RATE = 0.03
CARD_TEST_MCC = "7995"
FRAUD_RATE = 0.012
FALSE_DECLINE_RATE = 0.015
FRAUD_DECLINE_RATE = 0.35
FRAUD_REAPPROVE_RATE = 0.45
LOG_MEAN, LOG_SIGMA = 3.2, 0.9

DEMO_AUTH = (
    "EVT-DEMO-ATO", DEMO_ACCOUNT, "2026-09-30T17:56:00+00:00", "dev_new_91f2", "1", "GB-LON",
    "1", "success", "4", "0", "1",
)
DEMO_TXN = (
    "TXN-DEMO-ATO", DEMO_ACCOUNT, NOW, "2318.47", "5732", "GB", "ecom",
    "tok_8238295cccb4d5b2", "approve", "1",
)
DEMO_ROW = (
    DEMO_ACCOUNT, "2025-01-02", "2500", "premium", "US-NY", "user100042@example.invalid",
    "tok_8238295cccb4d5b2",
)


class _Dice:
    """Uniform numbers in [0, 1) from a key column."""

    def __init__(self, key: Column, seed: int, kind: str):
        self.key, self.seed, self.kind = key, seed, kind

    def uniform(self, purpose: str) -> Column:
        bits = F.xxhash64(self.key, F.lit(self.seed), F.lit(self.kind), F.lit(purpose))
        return F.pmod(bits, F.lit(2**53)) / F.lit(float(2**53))

    def below(self, purpose: str, n: int | Column) -> Column:
        return F.floor(self.uniform(purpose) * n).cast("int")

    def choice(self, purpose: str, values: list) -> Column:
        return F.element_at(
            F.array(*[F.lit(v) for v in values]), self.below(purpose, len(values)) + 1
        )

    def chance(self, purpose: str, rate: float) -> Column:
        return self.uniform(purpose) < rate


def _account_id(number: Column) -> Column:
    return F.concat(F.lit("ACC-"), (number + 200_000).cast("string"))


def _home(number: Column, seed: int) -> Column:
    return _Dice(number, seed, "account").choice("home", HOME_GEOS)


def _time(minutes_ago: Column) -> Column:
    at = F.timestamp_seconds(F.unix_timestamp(F.to_timestamp(F.lit(NOW))) - minutes_ago * 60)
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ssxxx")


def _as_text(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast("string").alias(f.name) for f in schema.fields])


def _accounts(spark: SparkSession, n: int, seed: int) -> DataFrame:
    number = F.col("id")
    dice = _Dice(number, seed, "account")
    rows = spark.range(1, n).select(
        _account_id(number).alias("account_id"),
        F.date_sub(F.to_date(F.lit(NOW[:10])), dice.below("age", 2321) + 180).alias("open_date"),
        dice.choice("limit", LIMITS).alias("credit_limit"),
        dice.choice("segment", SEGMENTS).alias("segment"),
        _home(number, seed).alias("home_geo"),
        F.concat(F.lit("user"), (number + 200_000), F.lit("@example.invalid")).alias("email"),
        pan_token(_account_id(number), seed).alias("pan_token"),
    )
    return _as_text(rows, ACCOUNTS_RAW).unionByName(
        spark.createDataFrame([DEMO_ROW], ACCOUNTS_RAW)
    )


def _auth(spark: SparkSession, n: int, n_accounts: int, seed: int) -> DataFrame:
    dice = _Dice(F.col("id"), seed, "auth")
    rows = spark.range(n - 1).withColumn("acct", dice.below("account", n_accounts - 1) + 1)
    home = _home(F.col("acct").cast("bigint"), seed)
    is_new = F.col("device_is_new") == 1
    rows = (
        rows.withColumn("device_is_new", dice.chance("new", NEW_DEVICE_RATE).cast("int"))
        .withColumn(
            "ip_geo",
            F.when(is_new & dice.chance("foreign", FOREIGN_GEO_RATE), dice.choice("geo", GEOS))
            .otherwise(home),
        )
        .withColumn("geo_is_new", (F.col("ip_geo") != home).cast("int"))
        .withColumn(
            "failed_attempts_1h",
            F.when(is_new, dice.below("fails", 7)).otherwise(dice.below("fails", 2)),
        )
        .select(
            F.format_string("EVT-%07d", "id").alias("event_id"),
            _account_id(F.col("acct")).alias("account_id"),
            _time(dice.below("time", SPAN_MINUTES + 1)).alias("ts"),
            F.when(is_new, F.format_string("dev_%04d", dice.below("device", 9000) + 1))
            .otherwise(F.concat(F.lit("dev_known_"), F.right(_account_id(F.col("acct")), F.lit(4))))
            .alias("device_id"),
            "device_is_new", "ip_geo", "geo_is_new",
            dice.choice("result", ["success", "success", "success", "failure"]).alias(
                "auth_result"
            ),
            "failed_attempts_1h",
            dice.chance("mfa", MFA_RATE).cast("int").alias("mfa_used"),
            (is_new & (F.col("geo_is_new") == 1) & (F.col("failed_attempts_1h") >= 3))
            .cast("int").alias("ato_label"),
        )
    )
    return _as_text(rows, AUTH_RAW).unionByName(spark.createDataFrame([DEMO_AUTH], AUTH_RAW))


def _txn(spark: SparkSession, n: int, n_accounts: int, seed: int) -> DataFrame:
    dice = _Dice(F.col("id"), seed, "txn")
    normal = F.sqrt(-2 * F.log(1 - dice.uniform("normal1"))) * F.cos(
        F.lit(6.283185307179586) * dice.uniform("normal2")
    )
    test, fraud = F.col("card_test"), F.col("fraud_label") == 1
    declined = (fraud & dice.chance("decline", FRAUD_DECLINE_RATE)) | (
        ~fraud & dice.chance("false_decline", FALSE_DECLINE_RATE)
    )
    waved = fraud & dice.chance("reapprove", FRAUD_REAPPROVE_RATE)
    rows = (
        spark.range(n - 1)
        .withColumn("acct", dice.below("account", n_accounts - 1) + 1)
        .withColumn("card_test", dice.chance("card_test", CARD_TEST_RATE))
        .withColumn(
            "fraud_label", (test | dice.chance("fraud", FRAUD_RATE)).cast("int")
        )
        .select(
            F.format_string("TXN-%07d", "id").alias("txn_id"),
            _account_id(F.col("acct")).alias("account_id"),
            _time(dice.below("time", SPAN_MINUTES + 1)).alias("ts"),
            F.when(test, F.round(1 + dice.uniform("small") * 8.99, 2))
            .otherwise(F.round(F.exp(LOG_MEAN + LOG_SIGMA * normal), 2)).alias("amount"),
            F.when(test, CARD_TEST_MCC).otherwise(dice.choice("mcc", MCC_CODES)).alias("mcc"),
            dice.choice("country", ["US", "US", "US", "GB", "CA"]).alias("merchant_country"),
            dice.choice("channel", ["ecom", "ecom", "card-present"]).alias("channel"),
            pan_token(_account_id(F.col("acct")), seed).alias("pan_token"),
            F.when(declined & ~waved, "decline").otherwise("approve").alias("decision"),
            "fraud_label",
        )
    )
    return _as_text(rows, TXN_RAW).unionByName(spark.createDataFrame([DEMO_TXN], TXN_RAW))


def generate(
    spark: SparkSession, n_accounts: int = 500, n_txns: int = 8000, n_auths: int = 3000,
    seed: int = 42,
) -> dict[str, DataFrame]:
    """The three raw feeds, the demo takeover among them."""
    return {
        "accounts": _accounts(spark, n_accounts, seed),
        "auth": _auth(spark, n_auths, n_accounts, seed),
        "txn": _txn(spark, n_txns, n_accounts, seed),
    }


def write_landing(feeds: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Writes the feeds as landing CSV folders and returns their paths."""
    paths = {}
    for name in RAW:
        paths[name] = f"{root}/{name}"
        feeds[name].write.mode("overwrite").option("header", True).csv(paths[name])
    return paths
