"""Small filters and projections shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.risk import has_code


def filter_key(df: DataFrame, col: str, value) -> DataFrame:
    """Rows of one key; the comparison reaches the Parquet scan."""
    return df.where(F.col(col) == F.lit(value))


def nonempty_codes(df: DataFrame) -> DataFrame:
    """Rows on which at least one reason code fired."""
    return df.where(F.length(F.coalesce(F.col("reason_codes"), F.lit(""))) > 0)


def with_code(df: DataFrame, code: str) -> DataFrame:
    """Rows that carry exactly this code."""
    return df.where(has_code(code))


def select_as(df: DataFrame, mapping: dict[str, str | Column]) -> DataFrame:
    """Projection under new names: ``{new name: column}``."""
    return df.select(*[
        (F.col(src) if isinstance(src, str) else src).alias(new) for new, src in mapping.items()
    ])
