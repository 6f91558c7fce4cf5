"""Gold by day with daily tiles, so that a 30-day mean does not read 30 days of rows.

A tile is one row per account and day: how many transactions, how many cents. The sum
over the 30 days before a transaction on day D is the tiles of D - 30 to D - 1, plus
the rows of D before it, less the rows of D - 30 that lie more than 30 days back. So
the features of a day need its own rows, those of the day 30 days earlier, 30 tiles
per account and, for the hourly count, the last hour of the day before.

Rows of an edge day are summed by hour first; what happens inside an hour is one window
per account and hour, so an account with a third of the rows is 24 tasks a day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.risk import cents
from ..operators.rolling import add_vs_avg
from ..operators.slices import FIRST
from ..schemas import GOLD_COLUMNS
from .scoring import rule_score

DAYS = 30
NO_DAY = -1_000_000  # rows without a time
_HOUR_US, _DAY_US = 3_600_000_000, 86_400_000_000

FEATURE_COLUMNS = [*GOLD_COLUMNS, "txn_velocity_1h", "amount_vs_30d_avg", "risk_score"]


def day_number() -> Column:
    """The transaction's day in UTC, as a number."""
    return F.coalesce(F.floor(F.unix_micros("txn_ts") / _DAY_US).cast("int"), F.lit(NO_DAY))


def daily_tiles(rows: DataFrame) -> DataFrame:
    """(account_id, day, n, c): transactions and cents of each account and day."""
    timed = rows.withColumn("day", day_number()).where((F.col("day") != NO_DAY) & F.col("account_id").isNotNull())
    return timed.groupBy("account_id", "day").agg(
        F.count("*").alias("n"), F.coalesce(F.sum(cents("amount")), F.lit(0)).alias("c")
    )


def _store(rows: DataFrame, path: str) -> None:
    rows.repartitionByRange("day", "account_id").sortWithinPartitions("day", "account_id").write.partitionBy(
        "day"
    ).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def write_days(gold: DataFrame, path: str) -> None:
    """Stores whole days of gold, their tiles first; a repeat replaces the days it brings."""
    _store(daily_tiles(gold), f"{path}/tiles")
    _store(gold.select(*GOLD_COLUMNS).withColumn("day", day_number()), f"{path}/rows")


def spend_history(rows: DataFrame, past: DataFrame, eve: DataFrame, tiles: DataFrame, days: int = DAYS) -> DataFrame:
    """Adds ``txn_velocity_1h`` and ``amount_vs_30d_avg`` to ``rows``: whole days, by the column ``day``.

    ``past`` are the rows of the days ``days`` earlier, ``eve`` those of the days before,
    ``tiles`` the tiles from the one to the other. Each value enters a running sum and
    leaves it when its span has passed: ``_n`` and ``_c`` count what lies before a row,
    ``_v`` the hour up to and with it.
    """
    known = F.col("account_id").isNotNull() & (F.col("day") != NO_DAY)
    us, c = F.unix_micros("txn_ts"), F.coalesce(cents("amount"), F.lit(0)).cast("long")
    one, end_of_day = F.lit(1).cast("long"), (F.col("day").cast("long") + 1) * _DAY_US
    after_hour = us + _HOUR_US + 1
    late = eve.where(known & (us >= end_of_day - _HOUR_US))  # still counts on the next day
    sums = ("_n", "_c", "_v")

    def event(source: DataFrame, day: Column, at: Column, **values: Column) -> DataFrame:
        return source.select("account_id", day.alias("day"), at.alias("_us"), *[
            values.get(v, F.lit(0).cast("long")).alias(v) for v in sums
        ])

    probes = rows.where(known).withColumns({"_us": us, "_n": one, "_c": c, "_v": one, "_probe": F.lit(True)})
    same_day = rows.where(known & (after_hour < end_of_day))
    leaving = (
        event(past.where(known), F.col("day") + days, us + days * _DAY_US, _n=-one, _c=-c)
        .unionByName(event(same_day, F.col("day"), after_hour, _v=-one))
        .unionByName(event(late, F.col("day") + 1, after_hour, _v=-one))
    )
    hour = F.floor(F.col("_us") / _HOUR_US) - F.col("day").cast("long") * 24
    events = probes.unionByName(leaving, allowMissingColumns=True).withColumn("_hour", hour)
    before = Window.partitionBy("account_id").orderBy("day").rangeBetween(-days, -1)  # a row a day
    # What a day finds as its hour -1: the tiles, and the last hour of the day before.
    found = tiles.select(
        "account_id", "day", F.sum("n").over(before).alias("_n"), F.sum("c").over(before).alias("_c"), F.lit(0).alias("_v")
    ).unionByName(event(late, F.col("day") + 1, us, _v=one).drop("_us"))
    by_hour = events.select("account_id", "day", "_hour", *sums).unionByName(
        found.withColumn("_hour", F.lit(-1).cast("long"))
    ).groupBy("account_id", "day", "_hour").agg(*[F.sum(v).alias(v) for v in sums])
    earlier = Window.partitionBy("account_id", "day").orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    seeds = (  # what each hour finds: at most 25 rows a day
        by_hour.select("account_id", "day", "_hour", *[F.sum(v).over(earlier).alias(v) for v in sums])
        .where("_hour >= 0")
        .withColumn("_us", F.lit(FIRST))
    )
    inside = Window.partitionBy("account_id", "day", "_hour").orderBy("_us")
    frame = {v: inside.rangeBetween(Window.unboundedPreceding, 0 if v == "_v" else -1) for v in sums}
    summed = events.unionByName(seeds, allowMissingColumns=True).withColumns({
        v: F.coalesce(F.sum(v).over(frame[v]), F.lit(0)) for v in sums
    })
    nothing = rows.where(~known).withColumns({v: F.lit(None).cast("long") for v in sums})
    probed = summed.where("_probe").drop("_us", "_hour", "_probe").unionByName(nothing)
    return add_vs_avg(probed.withColumnRenamed("_v", "txn_velocity_1h"))


def features(spark: SparkSession, path: str, days: list[int] | None = None) -> DataFrame:
    """Stored gold of the given days (all if None) with velocity, 30-day ratio and rule score."""
    stored, tiles = spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/tiles")
    rows = past = eve = stored
    if days is not None:
        day = F.col("day")
        rows, past, eve = (stored.where(day.isin([d - back for d in days])) for back in (0, DAYS, 1))
        tiles = tiles.where(day.between(min(days) - DAYS, max(days)))
    return rule_score(spend_history(rows, past, eve, tiles)).select(*FEATURE_COLUMNS)
