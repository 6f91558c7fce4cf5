"""Readers: landing CSV folders, tables, and the same as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _landed(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """The folder's columns in the order of its header, typed as in ``schema``, others as text.

    An empty folder has the schema's own order.
    """
    kinds = {f.name: f.dataType for f in schema.fields}
    names = spark.read.option("header", True).csv(path).columns or schema.names
    return T.StructType([T.StructField(n, kinds.get(n, T.StringType()), True) for n in names])


def _by_name(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order; a column the files lack is null."""
    return df.select(*[
        F.col(f"`{f.name}`") if f.name in df.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def read_feed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV folder with a header row; types are given, columns are found by name.

    All files of a folder must have the same header: one that differs is an
    error, never a silent swap of columns.
    """
    reader = spark.read.schema(_landed(spark, path, schema)).option("header", True)
    files = reader.option("mode", "PERMISSIVE").option("enforceSchema", False).csv(path)
    return _by_name(files, schema)


def stream_feed(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """The same folder as a stream of newly arrived files."""
    reader = spark.readStream.schema(_landed(spark, path, schema)).option("header", True)
    reader = reader.option("mode", "PERMISSIVE").option("enforceSchema", False)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _by_name(reader.csv(path), schema)


def read_table(
    spark: SparkSession, path: str, streaming: bool = False, schema: T.StructType | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """A Parquet table as a snapshot, or as a stream of newly arrived files."""
    if not streaming:
        return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
