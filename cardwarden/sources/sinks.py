"""Writers for gold, tables, JSON exports and the model card."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MODEL_CARD


def write_gold(
    df: DataFrame, path: str, partition_by: str | None = "txn_date", csv_path: str | None = None
) -> None:
    """Gold as Parquet, by day of the transaction unless told otherwise, and as CSV if wanted.

    The rebalance hint gathers the rows of a day, and adaptive execution then cuts
    a big day into tasks of the advisory size and joins small days, so files are
    of even size whatever the days look like.
    """
    out = df
    if partition_by:
        out = df.withColumn(partition_by, F.to_date("txn_ts"))
        out.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(
            partition_by
        ).parquet(path)
    else:
        out.write.mode("overwrite").parquet(path)
    if csv_path:  # copied from the stored table, so that gold is computed once
        stored = df.sparkSession.read.schema(out.schema).parquet(path).select(*df.columns)
        stored.write.mode("overwrite").option("header", True).csv(csv_path)


def write_table(df: DataFrame, path: str | None = None, name: str | None = None) -> None:
    """Create or replace a table from a query: a catalog table, or a Parquet folder."""
    if name:
        df.write.mode("overwrite").saveAsTable(name)
    else:
        df.write.mode("overwrite").parquet(path)


def as_json_lines(df: DataFrame) -> DataFrame:
    """One JSON object per row, absent values left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, written in parallel."""
    as_json_lines(df).write.mode("overwrite").text(path)


def json_array(df: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` rows of an ordered report as one JSON array in one row."""
    return df.limit(limit).agg(
        F.to_json(F.collect_list(F.struct(*df.columns))).alias("value")
    )


def read_model_card(spark: SparkSession, path: str, defaults: DataFrame) -> DataFrame:
    """The model card with each missing or unreadable field taken from ``defaults`` (one row).

    The card may be one line or indented, one file or a folder; without a card
    all fields are defaults. Of several cards the last by file name counts.
    """
    schema = T.StructType([*MODEL_CARD.fields, T.StructField("_corrupt_record", T.StringType())])
    try:
        files = spark.read.schema(schema).option("multiLine", True).json(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], schema).withColumn("_file", F.lit(""))
    else:
        files = files.withColumn("_file", F.col("_metadata.file_path"))
    card = files.orderBy(F.desc("_file"), F.to_json(F.struct(*MODEL_CARD.fieldNames()))).limit(1)
    card = card.withColumn("_one", F.lit(1))
    base = defaults.select(F.lit(1).alias("_one"), F.struct(*defaults.columns).alias("_d"))
    return base.join(card, "_one", "left").select(*[
        F.coalesce(F.col(n), F.col(f"_d.{n}")).alias(n) for n in MODEL_CARD.fieldNames()
    ])
