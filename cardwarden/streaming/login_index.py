"""An index of logins by day, so that enriching a micro-batch does not read the history.

What the as-of join of a transaction on day D can need are the logins of D and the last
login before D. The index keeps, in day folders and per micro-batch of logins,

* ``logins``: the logins of the day, with the columns gold needs,
* ``last``: one row per account and day, its last login of that day,

and now and then ``carry``: one row per account, its last login before a day, which
spares the reader all earlier ``last`` folders (``roll``). A carry says up to which
micro-batch it was made, so logins that arrive later for earlier days are still found
in the ``last`` rows of their own micro-batch.

A repeated micro-batch replaces its own folders, and a reader takes the newest login
among what it reads, so repeats change nothing. Days are counted in UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dedup import dedup_latest
from ..plans.gold import LOGIN_COLUMNS
from .run import BATCH, start_batches

KEPT = ["account_id", "event_ts", "event_id", *LOGIN_COLUMNS]
_DAY_US = 86_400_000_000


def day_of(ts: str) -> Column:
    """The day in UTC, as a number."""
    return F.floor(F.unix_micros(ts) / _DAY_US).cast("int")


def _store(rows: DataFrame, path: str) -> None:
    rows.repartitionByRange("day", "account_id").sortWithinPartitions("day", "account_id").write.partitionBy(
        "day", BATCH
    ).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def add_logins(batch: DataFrame, batch_id: int, path: str) -> None:
    """Adds a micro-batch of typed logins to the index."""
    rows = batch.where("account_id IS NOT NULL AND event_ts IS NOT NULL").select(
        *KEPT, day_of("event_ts").alias("day"), F.lit(batch_id).cast("long").alias(BATCH)
    )
    _store(rows, f"{path}/logins")
    _store(_newest(rows, "day"), f"{path}/last")


def _newest(rows: DataFrame, *more_keys: str) -> DataFrame:
    return dedup_latest(rows, ["account_id", *more_keys], ["event_ts", "event_id"])


def start_index(
    logins: DataFrame, path: str, checkpoint: str, trigger: str | None = None
) -> StreamingQuery:
    """Keeps the index up to date from a stream of typed logins."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            add_logins(held, batch_id, path)
        finally:
            held.unpersist()

    return start_batches(logins, handle, checkpoint, trigger)


def _table(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """A folder of the index; empty if nothing was written to it yet."""
    root = f"{path}/{name}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(root)


def _schema(spark: SparkSession, path: str) -> str:
    """The stored columns, whose ids and places may be text or numbers."""
    stored = spark.read.parquet(f"{path}/last").select(*KEPT).schema
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stored.fields)


def _last_logins(spark: SparkSession, path: str, wanted: Column, carry_day: int, through: int | None = None) -> DataFrame:
    """The ``last`` rows that are ``wanted``; those before the latest carry up to ``carry_day`` as that carry.

    ``through`` leaves out micro-batches after it, and carries made with them.
    """
    kept = _schema(spark, path)
    rows = _table(spark, path, "last", f"{kept}, day int, {BATCH} long").where(wanted)
    known = _table(spark, path, "rolled", "before int, through long").where(F.col("before") <= carry_day)
    if through is not None:
        rows, known = rows.where(F.col(BATCH) <= through), known.where(F.col("through") <= through)
    newest = known.orderBy(F.desc("before"), F.desc("through")).first()  # one small row per carry
    if not newest:
        return rows.select(*KEPT)
    carried = _table(spark, path, "carry", f"{kept}, before int, through long").where(
        (F.col("before") == newest.before) & (F.col("through") == newest.through)
    )
    later = (F.col("day") >= newest.before) | (F.col(BATCH) > newest.through)
    return rows.where(later).select(*KEPT).unionByName(carried.select(*KEPT))


def roll(spark: SparkSession, path: str, day: int, through: int) -> None:
    """Makes the carry of a day from what the micro-batches up to ``through`` have brought.

    ``through`` must be a micro-batch that is done.
    """
    made = _newest(_last_logins(spark, path, F.col("day") < day, day, through))
    made.repartitionByRange("account_id").write.mode("overwrite").parquet(
        f"{path}/carry/before={day}/through={through}"
    )
    # The carry counts from the moment this one row is there.
    spark.createDataFrame([(day, through)], "before int, through long").coalesce(1).write.mode(
        "append"
    ).parquet(f"{path}/rolled")


def logins_for(batch: DataFrame, path: str) -> DataFrame:
    """The logins that the as-of join of a micro-batch of transactions can need.

    Reads the days of the batch, one row per account for each other day since the latest
    carry, and the carry.
    """
    spark = batch.sparkSession
    days = sorted(  # the days of one micro-batch
        r.day for r in batch.select(day_of("txn_ts").alias("day")).where("day IS NOT NULL").distinct().collect()
    )
    kept = _schema(spark, path)
    own = _table(spark, path, "logins", f"{kept}, day int, {BATCH} long")
    if not days:
        return own.where("false").select(*KEPT)
    others = (F.col("day") < days[-1]) & ~F.col("day").isin(days)
    return own.where(F.col("day").isin(days)).select(*KEPT).unionByName(
        _last_logins(spark, path, others, days[0])
    )
