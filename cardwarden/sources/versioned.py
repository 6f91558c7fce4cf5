"""The serving table as a log-structured merge: a base, the batches after it, and a pointer.

Folders below the table's path, each written once and never changed:

* ``bases/<name>``: one row per account, in key order,
* ``batches/<name>``: the newest rows per account of one upsert,
* ``log/segment=N``: a row (batch_id, folder) for every upsert made under version N,
* ``versions/version=N``: one row (base, folded): the base of version N, and which
  batches of segment N - 1 it holds already.

The greatest version is the table. A reader opens its base and the batches of its own
and the previous segment that are not folded; ``compact`` makes these a new base, and
the single row of the new version switches all readers at once. A compaction that dies
before that row leaves the table as it was; two that run side by side each bring a row
that is right, and the smaller name counts. An upsert says its batch again if the
version has moved meanwhile, so none falls between two versions.

The newest row per account is the same however often a batch is merged, so a repeated
micro-batch changes nothing.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .serving import latest_per_account

_LOG = "batch_id long, folder string, segment long"
_VERSIONS = "base string, folded array<long>, version long"


@dataclass(frozen=True)
class Version:
    """What the pointer says: 0 and no base before the first compaction."""

    number: int
    base: str | None
    folded: frozenset[int]


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def _rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small table of the manifest; empty before its first row."""
    hadoop, files = _path(spark, path)
    if not files.exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _new_name() -> str:
    return uuid.uuid4().hex


def _say(row: DataFrame, path: str) -> None:
    """Adds one row as one file, which is there whole or not at all."""
    row.coalesce(1).write.mode("append").parquet(path)


def _store(rows: DataFrame, path: str) -> None:
    rows.repartitionByRange("account_id").sortWithinPartitions("account_id").write.parquet(path)


def current(spark: SparkSession, path: str) -> Version:
    """The version readers see."""
    found = _rows(spark, f"{path}/versions", _VERSIONS).orderBy(F.desc("version"), "base").first()
    return Version(found.version, found.base, frozenset(found.folded)) if found else Version(0, None, frozenset())


def _open_batches(spark: SparkSession, path: str, version: Version) -> dict[str, int]:
    """folder -> batch, for the batches beside the base; as many as since the last compaction but one."""
    log = _rows(spark, f"{path}/log", _LOG).where(F.col("segment") >= version.number - 1).distinct()
    return {r.folder: r.batch_id for r in log.collect() if r.batch_id not in version.folded}


def _merged(spark: SparkSession, path: str, version: Version, folders: list[str]) -> DataFrame:
    if not version.base and not folders:
        raise ValueError(f"nothing has been written to {path}")
    base = spark.read.parquet(f"{path}/bases/{version.base}") if version.base else None
    if not folders:
        return base
    rows = spark.read.parquet(*[f"{path}/batches/{f}" for f in sorted(folders)])
    return latest_per_account(rows if base is None else rows.unionByName(base))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The newest row per account: the base as it is if nothing came after it."""
    version = current(spark, path)
    return _merged(spark, path, version, list(_open_batches(spark, path, version)))


def upsert(rows: DataFrame, batch_id: int, path: str) -> None:
    """Adds the newest rows per account of a scored (micro-)batch."""
    spark, folder = rows.sparkSession, _new_name()
    _store(latest_per_account(rows), f"{path}/batches/{folder}")
    said = None
    while (now := current(spark, path).number) != said:
        said = now
        _say(
            spark.createDataFrame([(batch_id, folder)], "batch_id long, folder string"),
            f"{path}/log/segment={now}",
        )


def publish(rows: DataFrame, path: str) -> None:
    """Replaces the whole table by ``rows``; readers see all of it or what was there before."""
    spark, name = rows.sparkSession, _new_name()
    version = current(spark, path)
    _store(latest_per_account(rows), f"{path}/bases/{name}")
    _switch(spark, path, version, name, _open_batches(spark, path, version))


def compact(spark: SparkSession, path: str) -> None:
    """Folds the base and the batches after it into a new base."""
    version, name = current(spark, path), _new_name()
    batches = _open_batches(spark, path, version)
    if not batches:
        return
    _store(_merged(spark, path, version, list(batches)), f"{path}/bases/{name}")
    _switch(spark, path, version, name, batches)


def _switch(spark: SparkSession, path: str, old: Version, base: str, batches: dict[str, int]) -> None:
    row = spark.createDataFrame([(base, sorted(set(batches.values())))], "base string, folded array<long>")
    _say(row, f"{path}/versions/version={old.number + 1}")


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Deletes what only versions before the last ``keep`` need; readers of those must be done."""
    version = current(spark, path)
    oldest = version.number - max(keep, 1) + 1
    if oldest <= 1:
        return
    versions = _rows(spark, f"{path}/versions", _VERSIONS).where(F.col("version") >= oldest).collect()
    log = _rows(spark, f"{path}/log", _LOG).collect()
    kept = {
        "bases": {r.base for r in versions},
        "batches": {r.folder for r in log if r.segment >= oldest - 1},
        "log": {f"segment={n}" for n in range(oldest - 1, version.number + 1)},
        "versions": {f"version={n}" for n in range(oldest, version.number + 1)},
    }
    known = {"batches": {r.folder for r in log}}  # a batch not yet in the log is being written
    for name, stay in kept.items():
        hadoop, files = _path(spark, f"{path}/{name}")
        if not files.exists(hadoop):
            continue
        for entry in files.listStatus(hadoop):
            own = entry.getPath().getName()
            if entry.isDirectory() and own not in stay and own in known.get(name, {own}):
                files.delete(entry.getPath(), True)
