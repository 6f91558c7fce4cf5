"""What the text operators share: reading tables, keys of rows, cutting lineage."""

from __future__ import annotations

import contextlib
import ctypes
import sys
from types import ModuleType

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.session import enable_checkpoints

ROW = "_row"  # a whole input row as one struct, so that no input column can clash


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder, read by Spark."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` computed once and stored in the session's shared checkpoint folder."""
    enable_checkpoints(df.sparkSession)
    return df.checkpoint()


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, th, text): null text is empty; ``th`` tells apart rows that repeat a doc_id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text")
    )


def keyed_rows(docs: DataFrame) -> DataFrame:
    """Each row as one struct with its key (doc_id, th), as ``texts`` makes it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("th"),
    )


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Join condition on (doc_id, th); a null id equals a null id."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["th"] == right["th"])


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of an id written as text; null for a null id."""
    return F.crc32(F.col(column).cast("string"))


def process_table(name: str) -> dict:
    """A table that lives as long as the Python process; Spark's workers run many tasks in one.

    Functions that travel with a job get fresh module globals in every task, so
    the table hangs on a module name of its own.
    """
    module = sys.modules.setdefault(f"_cardwarden_{name}", ModuleType(name))
    return vars(module).setdefault("table", {})


def give_back() -> None:
    """Returns memory that the task is done with; its process lives on, beside other stages' data."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)
