"""Exact transactions per hour for every transaction of a stream, late ones included.

A transaction is told at once with the account's count in the hour up to it. One that
arrives late also raises the count of those up to an hour after it; they are told again
with the next ``revision``. ``settled`` takes the last revision of each.

State is kept per bin of accounts and hour of the clock, so one busy account is many
keys and ordinary ones share the cost of a key: a transaction goes to its own hour and,
as history, to the next one, and no hour needs another's state. Within a key, each
account's rows lie in buckets of a minute; a count adds up whole minutes and looks only
into the two at its ends. An hour's state goes as a whole, some time after the watermark
has passed it.
"""

from __future__ import annotations

import sys
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from .asof_stream import Buckets, Head

cloudpickle.register_pickle_by_value(sys.modules[__name__])

HOUR, MINUTE = 3_600_000_000, 60_000_000
BINS = 64
BIN_ROWS = 4_096  # rows of one bin and hour that lie in one value
_KEY = ("account_id", "clock_hour")
_TOLD = T.StructType([
    T.StructField("row_no", T.LongType()), T.StructField("revision", T.LongType()),
    T.StructField("txn_velocity_1h", T.LongType()), T.StructField("whole_history", T.BooleanType()),
])


class HourCounter(StatefulProcessor):
    """Counts per row of the accounts of one bin and clock hour.

    Rows in state are (time, number, revision, count); history has number -1.
    """

    def __init__(self, out_names: list[str], own_names: list[str], keep: int):
        self.out_names, self.own_names, self.keep = out_names, own_names, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = Head(handle)

    @staticmethod
    def _ranks(held: Buckets, minutes: list[int]) -> dict[int, int]:
        """How many rows lie before each minute."""
        before, found = 0, {}
        for minute in minutes:
            found[minute] = before
            before += len(held.rows(minute))
        found[-1] = before
        return found

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        over = (int(key[1]) + 1) * HOUR + self.keep  # when this hour's state goes
        number, known = self.head.get((0, {}))
        accounts: dict[object, Buckets] = {}
        for batch in rows:
            touched: dict[object, tuple[list[int], dict[int, tuple]]] = {}
            values = batch[self.own_names].astype(object).where(batch[self.own_names].notna(), None)
            each = zip(
                batch["account_id"].tolist(), batch["us"].tolist(), batch["own"].tolist(),
                values.itertuples(index=False, name=None), strict=True,
            )
            for account, at, mine, row in each:
                if account not in accounts:
                    accounts[account] = Buckets(self.head, str(account), MINUTE, known.get(account))
                accounts[account].add(at, (at, number if mine else -1, 0, None))
                times, told = touched.setdefault(account, ([], {}))
                times.append(at)
                if mine:
                    told[number] = row
                    number += 1
            out = []
            for account, (times, told) in touched.items():
                out += self._changed((account, key[1]), accounts[account], min(times), told, over > passed)
            if out:
                yield pd.DataFrame(out, columns=self.out_names, dtype=object)
        if not known:  # else a timer waits
            self.handle.registerTimer(max(over // 1000, timerValues.getCurrentWatermarkInMs() + 1))
        known |= {account: held.pack() for account, held in accounts.items()}
        if sum(len(rows) for _, near in known.values() for rows in near.values()) > BIN_ROWS:
            known = {a: Buckets(self.head, str(a), MINUTE, packed).pack(0) for a, packed in known.items()}
        self.head.put((number, known))

    def _changed(self, key, held: Buckets, earliest: int, new: dict[int, tuple], whole: bool) -> list[tuple]:
        """Told anew: the account's rows from ``earliest`` on whose count is another one now."""
        minutes = held.all()
        before = self._ranks(held, minutes)

        def rank(at: int, side) -> int:
            minute = at // MINUTE
            there = bisect_left(minutes, minute)
            if there < len(minutes) and minutes[there] == minute:
                return before[minute] + side(held.rows(minute), at, key=lambda r: r[0])
            return before[minutes[there]] if there < len(minutes) else before[-1]

        out, nothing = [], (None,) * len(self.own_names)
        for minute in minutes[bisect_left(minutes, earliest // MINUTE):]:
            fresh, any_new = [], False
            for at, number, revision, count in held.rows(minute):
                now = rank(at, bisect_right) - rank(at - HOUR, bisect_left) if number >= 0 else None
                if number >= 0 and now != count:
                    any_new = True
                    revision += count is not None
                    out.append((*key, number, revision, now, whole, *new.get(number, nothing)))
                fresh.append((at, number, revision, now))
            if any_new:
                held.put(minute, fresh)
        return out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        number, known = self.head.get((0, {}))
        if any(len(near) < len(order) for order, near in known.values()):
            self.head.lists.clear()
        self.head.put((number, {}))
        return iter([])

    def close(self) -> None:
        pass


def velocity_per_row(txn: DataFrame, delay: str = "1 hour", keep_hours: int = 24, bins: int = BINS) -> DataFrame:
    """(account_id, clock_hour, row_no, revision, txn_velocity_1h, whole_history, ``txn``'s other columns).

    Counts are exact, whenever a row arrives, until ``keep_hours`` after the watermark
    has passed its clock hour; after that a row is counted among those that come as late
    as itself, and ``whole_history`` is false. The other columns are there in revision 0
    only. Rows without an account or time pass by with nulls. Needs the RocksDB store.

    ``bins`` is how many keys the accounts of an hour are dealt over, at least the tasks
    that shall work on one hour at a time. It belongs to the checkpoint.
    """
    keyed = F.col("account_id").isNotNull() & F.col("txn_ts").isNotNull()
    own = [c for c in txn.columns if c != "account_id"]
    kinds = {f.name: f.dataType for f in txn.schema.fields}
    marked = txn.withWatermark("txn_ts", delay).where(keyed).withColumn("us", F.unix_micros("txn_ts"))
    # Text travels unharmed through gaps and big numbers; the time's mark stays behind,
    # or the engine would drop late rows.
    carried = marked.select(
        "account_id", F.floor(F.col("us") / HOUR).alias("at_hour"), "us",
        *[(F.unix_micros(c) if isinstance(kinds[c], T.TimestampType) else F.col(c)).cast("string").alias(c) for c in own],
    )
    copies = carried.select(
        "account_id", F.explode(F.array(F.col("at_hour"), F.col("at_hour") + 1)).alias("clock_hour"), "at_hour", "us", *own
    ).withColumn("bin", F.pmod(F.xxhash64("account_id"), F.lit(bins)).cast("int")).withColumn("own", F.col("clock_hour") == F.col("at_hour")).drop("at_hour")
    sent = {f.name: T.StructField(f.name, f.dataType) for f in copies.schema.fields}
    out = T.StructType([sent[c] for c in _KEY] + _TOLD.fields + [sent[c] for c in own])
    counted = copies.groupBy("bin", "clock_hour").transformWithStateInPandas(
        statefulProcessor=HourCounter(out.names, own, keep_hours * HOUR),
        outputStructType=out, outputMode="Append", timeMode="EventTime",
    )
    restored = [
        (F.timestamp_micros(F.col(c).cast("long")) if isinstance(kinds[c], T.TimestampType) else F.col(c).cast(kinds[c])).alias(c)
        for c in own
    ]
    aside = txn.where(~keyed).withColumn("txn_ts", F.timestamp_micros(F.unix_micros("txn_ts")))
    return counted.select(*_KEY, *_TOLD.names, *restored).unionByName(aside, allowMissingColumns=True)


def settled(told: DataFrame) -> DataFrame:
    """Every transaction once, with its last count."""
    own = [c for c in told.columns if c not in (*_KEY, *_TOLD.names)]
    row = F.struct(*own)
    last = told.where("row_no IS NOT NULL").groupBy(*_KEY, "row_no").agg(
        F.max_by("txn_velocity_1h", "revision").alias("txn_velocity_1h"),
        F.max_by("whole_history", "revision").alias("whole_history"),
        F.min_by(row, "revision").alias("row"),
    )
    shown = ["account_id", "txn_velocity_1h", "whole_history"]
    return last.select(*shown, "row.*").unionByName(told.where("row_no IS NULL").select(*shown, *own))
