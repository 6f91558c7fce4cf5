"""The serving table: one row per account, laid out for key lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.risk import recommended_action, split_codes
from ..operators.dedup import dedup_latest
from ..schemas import SERVING_COLUMNS


def latest_per_account(scored: DataFrame) -> DataFrame:
    """The newest scored transaction per account; equal times go to the greater id."""
    return dedup_latest(
        scored.select(*SERVING_COLUMNS).where(F.col("account_id").isNotNull()),
        ["account_id"], ["txn_ts", "txn_id"],
    )


def write_serving(df: DataFrame, path: str) -> None:
    """Parquet in key order, so that a lookup opens few row groups."""
    df.repartitionByRange("account_id").sortWithinPartitions("account_id").write.mode(
        "overwrite"
    ).parquet(path)


def read_serving(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def lookup(serving: DataFrame, account_id) -> DataFrame:
    """The account's row, or no row."""
    return serving.where(F.col("account_id") == F.lit(account_id))


def lookup_many(serving: DataFrame, keys: DataFrame) -> DataFrame:
    """One row per key; a key without a serving row has nulls."""
    return keys.select("account_id").join(serving, "account_id", "left")


def payload_columns(rows: DataFrame) -> DataFrame:
    """The lookup answer as columns, codes as an array."""
    return recommended_action(rows).select(
        "account_id", "txn_id", F.col("risk_score").alias("score"),
        split_codes().alias("reason_codes"), "amount", F.col("txn_ts").alias("as_of"),
        "model_version", "recommended_action",
    )


def payload_json(rows: DataFrame) -> DataFrame:
    """The lookup answer as one JSON text per row."""
    answer = payload_columns(rows)
    return answer.select("account_id", F.to_json(F.struct(*answer.columns)).alias("payload"))
