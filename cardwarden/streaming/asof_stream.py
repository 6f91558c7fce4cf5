"""Stream-stream as-of join: every transaction comes out, and again whenever its login changes.

A transaction is told at once with the latest login known for it, and told anew with
the next ``revision`` when a login that arrives later belongs to it. Nothing waits for
the watermark and nothing is dropped: rows behind it are matched with what the state
still holds, rows without an account or time pass by the state. ``settled`` takes the
last revision of every row: as many rows as went in, at any moment of the stream.

State per key is rows in time buckets, for open transactions and for logins. Those of
an ordinary key are one value; a key with many rows has a map from bucket to rows
(``Buckets``). A transaction is open, that is, revised by late logins, until the
watermark has passed its bucket; the key's one timer waits for the first bucket to drop.
Logins older than ``keep`` behind the watermark are folded into the newest of them.
"""

from __future__ import annotations

import pickle
import sys
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

MAX_HOT_ACCOUNTS = 10_000
_CARRIED = (T.StringType, T.NumericType, T.BooleanType)
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """The state store that keyed state with timers needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


# The processor travels to the executors with the job, so they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


PACKED = T.StructType([T.StructField("packed", T.BinaryType())])
_PLACE = T.StructType([T.StructField("part", T.StringType()), T.StructField("bucket", T.LongType())])
HEAD_ROWS = 256  # rows of one part that lie in the key's head


class Head:
    """What a key's state begins with: one value, read and written once for each touch of the key.

    The lists that are too long for it lie in a map state beside it.
    """

    def __init__(self, handle: StatefulProcessorHandle):
        self.value = handle.getValueState("head", PACKED)
        self.lists = handle.getMapState("lists", _PLACE, PACKED)

    def get(self, nothing: tuple) -> tuple:
        there = self.value.get()
        return pickle.loads(there[0]) if there is not None else nothing

    def put(self, parts: tuple) -> None:
        self.value.update((pickle.dumps(parts),))


class Buckets:
    """Rows of one part of a key's state, a list for each span of ``width`` microseconds.

    The lists lie in the head as long as they have few rows together. When they have
    more, all of them move to the map state: there only lists that are asked for are
    read, and only those that changed are written.
    """

    def __init__(self, head: Head, part: str, width: int, packed: tuple[list, dict] | None = None):
        self.lists, self.part, self.width = head.lists, part, width
        self.order, self.near = packed or ([], {})  # which buckets there are, in order; the head's lists
        self.far: dict[int, list] = {}  # lists read from the map
        self.changed: set[int] = set()  # of ``far``

    def all(self) -> list[int]:
        return self.order

    def rows(self, bucket: int) -> list:
        if bucket in self.near:
            return self.near[bucket]
        if bucket not in self.far:
            there = bisect_left(self.order, bucket)
            if there == len(self.order) or self.order[there] != bucket:
                return []
            self.far[bucket] = pickle.loads(self.lists.getValue((self.part, bucket))[0])
        return self.far[bucket]

    def add(self, at: int, row: tuple) -> int:
        """Puts the row in order among those of its bucket; returns the bucket."""
        bucket = at // self.width
        rows = self.rows(bucket)
        if not rows:
            insort(self.order, bucket)
            self.near[bucket] = rows
        insort(rows, row, key=lambda r: r[0])
        if bucket in self.far:
            self.changed.add(bucket)
        return bucket

    def put(self, bucket: int, rows: list) -> None:
        if bucket in self.near:
            self.near[bucket] = rows
        else:
            self.far[bucket] = rows
            self.changed.add(bucket)

    def drop(self, passed: int) -> None:
        """Forgets the buckets before ``passed``."""
        gone = bisect_left(self.order, passed)
        for bucket in self.order[:gone]:
            if self.near.pop(bucket, None) is None:
                self.far.pop(bucket, None)
                self.changed.discard(bucket)
                self.lists.removeKey((self.part, bucket))
        del self.order[:gone]

    def size(self) -> int:
        """Rows in the head."""
        return sum(map(len, self.near.values()))

    def pack(self, most: int | None = None) -> tuple[list, dict]:
        """What belongs into the head, at most ``most`` rows; the rest is written to the map."""
        if self.size() > (HEAD_ROWS if most is None else most):
            self.far |= self.near
            self.changed |= set(self.near)
            self.near = {}
        for bucket in self.changed:
            self.lists.updateValue((self.part, bucket), (pickle.dumps(self.far[bucket]),))
        self.changed = set()
        return self.order, self.near


class LoginMatcher(StatefulProcessor):
    """Matches transactions as they come and revises open ones when logins come later.

    Rows are tuples that begin with their time in microseconds, logins go on with
    their id. An open transaction is (time, its number, revision, its row, the login
    told last). Numbers count the transactions of the key.
    """

    def __init__(
        self, txn_schema: T.StructType, login_schema: T.StructType, out_names: list[str],
        numeric_id: bool, width: int, keep: int,
    ):
        self.txn_schema = txn_schema
        self.login_schema = login_schema
        self.out_names = out_names
        self.numeric_id = numeric_id
        self.width, self.keep = width, keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = Head(handle)

    def _load(self) -> None:
        # ``oldest`` is the newest of the folded logins, ``due`` the time of the timer to come.
        self.number, self.oldest, self.due, spends, logins = self.head.get((0, None, None, None, None))
        self.open = Buckets(self.head, "open", self.width, spends)
        self.logins = Buckets(self.head, "logins", self.width, logins)

    def _store(self) -> None:
        """Writes the state; one timer waits for the first bucket that ends."""
        ends = [(order[0] + 1) * self.width + more for order, more in ((self.open.all(), 0), (self.logins.all(), self.keep)) if order]
        due = min(ends, default=None)
        if due is not None and due != self.due:
            self.handle.registerTimer(due // 1000)
        self.due = due
        self.head.put((self.number, self.oldest, due, self.open.pack(), self.logins.pack()))

    @staticmethod
    def _rows(frame: pd.DataFrame, schema: T.StructType, those: list[int]) -> list[tuple]:
        """Tuples in schema order of the rows ``those``, None for what is missing.

        A batch column of whole numbers with gaps arrives as floats, so each value is
        made whole again.
        """
        columns = []
        for field in schema.fields if those else ():
            col = frame[field.name]
            values, gone = col.tolist(), col.isna().tolist()
            if isinstance(field.dataType, T.IntegralType):
                columns.append([None if gone[i] else int(values[i]) for i in those])
            else:
                columns.append([None if gone[i] else values[i] for i in those])
        return list(zip(*columns))

    def _order(self, login: tuple) -> tuple:
        """Time, then id; as the lists hold it in front of the login."""
        return login[0], int(login[1]) if self.numeric_id else login[1] or ""

    def _latest(self, at: int) -> tuple | None:
        """The latest login at or before a time, as far as the state knows."""
        bucket = at // self.width
        rows = self.logins.rows(bucket)
        found = bisect_right(rows, at, key=lambda r: r[0][0])
        if found:
            return rows[found - 1][1]
        order = self.logins.all()
        before = bisect_left(order, bucket)
        if before:
            return self.logins.rows(order[before - 1])[-1][1]
        return self.oldest if self.oldest and self.oldest[0] <= at else None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        self._load()
        for batch in rows:
            is_txn = batch["is_txn"].tolist()
            out: list[tuple] = []
            logins = self._rows(batch, self.login_schema, [i for i, mine in enumerate(is_txn) if not mine])
            changed = {self._add_login(login, passed) for login in logins}
            if changed:
                out += self._revised(key, min(changed))
            for txn in self._rows(batch, self.txn_schema, [i for i, mine in enumerate(is_txn) if mine]):
                login = self._latest(txn[0])
                late = txn[0] <= passed
                out.append(self._told(key, self.number, 0, late, txn, login))
                if not late:
                    self.open.add(txn[0], (txn[0], self.number, 0, txn, login))
                self.number += 1
            if out:
                yield pd.DataFrame(out, columns=self.out_names, dtype=object)
        self._store()

    def _told(self, key, number: int, revision: int, late: bool, txn: tuple, login: tuple | None) -> tuple:
        nothing = (None,) * len(self.login_schema.fields)
        return (*key, number, revision, late, *txn, *(login or nothing))

    def _add_login(self, login: tuple, passed: int) -> int:
        """Keeps a login; returns the first bucket whose transactions it may belong to."""
        bucket = login[0] // self.width
        if (bucket + 1) * self.width + self.keep <= passed:  # older than what is kept apart
            self._fold(login)
        else:
            self.logins.add(login[0], (self._order(login), login))
        return bucket

    def _fold(self, login: tuple) -> None:
        if not self.oldest or self._order(self.oldest) < self._order(login):
            self.oldest = login

    def _revised(self, key, first: int) -> list[tuple]:
        """Open transactions from a bucket on whose login is another one now."""
        out = []
        order = self.open.all()
        for bucket in order[bisect_left(order, first):]:
            fresh, any_new = [], False
            for at, number, revision, txn, told in self.open.rows(bucket):
                login = self._latest(at)
                if login != told:
                    any_new, revision = True, revision + 1
                    out.append(self._told(key, number, revision, False, txn, login))
                fresh.append((at, number, revision, txn, login))
            if any_new:
                self.open.put(bucket, fresh)
        return out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        self._load()
        self.open.drop(passed // self.width)
        old = (passed - self.keep) // self.width  # the first bucket of logins that is kept apart
        order = self.logins.all()
        if order and order[0] < old:
            self._fold(self.logins.rows(order[bisect_left(order, old) - 1])[-1][1])
            self.logins.drop(old)
        self._store()
        return iter([])

    def close(self) -> None:
        pass


LOGIN_COLUMNS = ("device_is_new", "failed_attempts_1h", "ato_label", "ip_geo")


TOLD = ("row_no", "revision", "late")
_ROW = ("account_id", "key_share", "row_no")


def settled(told: DataFrame) -> DataFrame:
    """The last revision of every transaction that ``fuse_stream`` has told, in its other columns.

    Rows without an account or time have no number and are told once.
    """
    last = Window.partitionBy(*_ROW).orderBy(F.col("revision").desc())
    numbered = told.where("row_no IS NOT NULL").withColumn("_n", F.row_number().over(last))
    rows = numbered.where("_n = 1").drop("_n").unionByName(told.where("row_no IS NULL"))
    return rows.drop("key_share", *TOLD)


def fuse_stream(
    txn: DataFrame, auth: DataFrame, delay: str = "1 hour",
    login_cols: Sequence[str] = LOGIN_COLUMNS,
    hot: DataFrame | None = None,
    keep_hours: int = 7 * 24, bucket_minutes: int = 60,
) -> DataFrame:
    """Each transaction with its latest login at or before it, told at once and revised later.

    Returns the columns of ``txn``, the login's, and ``key_share``, ``row_no``,
    ``revision``, ``late`` (see ``settled``). A login that arrives later revises the
    transactions whose bucket of ``bucket_minutes`` the watermark has not passed. A
    transaction behind the watermark is matched once (``late``), exactly as long as its
    time is within ``keep_hours`` of it; before that only the newest of the older logins
    is known, and none is told where that one came after the transaction.

    ``hot`` is a short static table (account_id, shares) of accounts too busy for one
    task: their transactions are dealt out over ``shares`` keys and their logins copied
    to each. The table belongs to the checkpoint: keep it as it is over restarts.
    """
    keyed = F.col("account_id").isNotNull() & F.col("txn_ts").isNotNull()
    txns = txn.withWatermark("txn_ts", delay).where(keyed)
    logins = auth.where("account_id IS NOT NULL AND event_ts IS NOT NULL").withWatermark(
        "event_ts", delay
    )
    share, shares = F.lit(0), F.array(F.lit(0))
    if hot is not None:
        if hot.limit(MAX_HOT_ACCOUNTS + 1).count() > MAX_HOT_ACCOUNTS:
            raise ValueError(f"hot may name at most {MAX_HOT_ACCOUNTS} accounts")
        txns = txns.join(F.broadcast(hot), "account_id", "left")
        logins = logins.join(F.broadcast(hot), "account_id", "left")
        count = F.coalesce(F.col("shares"), F.lit(1))
        share = F.pmod(F.xxhash64(*txn.columns), count).cast("int")
        shares = F.sequence(F.lit(0), (count - 1).cast("int"))
    own = [c for c in txn.columns if c not in ("account_id", "txn_ts")]
    kinds = {f.name: f.dataType for f in auth.schema.fields + txn.schema.fields}
    for c in (*own, "event_id", *login_cols):
        if not isinstance(kinds[c], _CARRIED):
            raise TypeError(f"{c}: only text, numbers and booleans can be carried along")

    def carried(c: str) -> Column:
        # Floats hold whole numbers up to 2**53 only, hence big ids travel as text.
        return F.col(c).cast("string") if isinstance(kinds[c], T.LongType) else F.col(c)

    # The times that carry the watermark stay behind, or the engine would drop late rows.
    left = txns.select(
        "account_id", share.alias("key_share"),
        F.lit(True).alias("is_txn"), F.unix_micros("txn_ts").alias("txn_us"), *[carried(c).alias(c) for c in own],
    )
    right = logins.select(
        "account_id", F.explode(shares).alias("key_share"),
        F.lit(False).alias("is_txn"), F.unix_micros("event_ts").alias("login_us"),
        carried("event_id").alias("last_event_id"), *[carried(c).alias(c) for c in login_cols],
    )
    both = left.unionByName(right, allowMissingColumns=True)
    sent = {f.name: T.StructField(f.name, f.dataType) for f in both.schema.fields}
    txn_schema = T.StructType([sent[c] for c in ("txn_us", *own)])
    login_schema = T.StructType([sent[c] for c in ("login_us", "last_event_id", *login_cols)])
    told = T.StructType.fromDDL("row_no long, revision long, late boolean")
    out = T.StructType([sent["account_id"], sent["key_share"]] + told.fields + txn_schema.fields + login_schema.fields)
    matched = both.groupBy("account_id", "key_share").transformWithStateInPandas(
        statefulProcessor=LoginMatcher(
            txn_schema, login_schema, out.names, isinstance(kinds["event_id"], T.LongType),
            bucket_minutes * 60_000_000, keep_hours * 3_600_000_000,
        ),
        outputStructType=out,
        outputMode="Append",
        timeMode="EventTime",
    )

    def restored(c: str, source: str | None = None) -> Column:
        return F.col(c).cast(kinds[source or c])

    keyed_rows = matched.select(
        *[
            F.timestamp_micros("txn_us").alias("txn_ts") if c == "txn_ts" else restored(c)
            for c in txn.columns
        ],
        F.timestamp_micros("login_us").alias("last_auth_ts"),
        restored("last_event_id", "event_id"), *[restored(c) for c in login_cols],
        "key_share", *TOLD,
    )
    # A plain copy of the time: rows that pass by must not be taken for late ones.
    aside = txn.where(~keyed).withColumn("txn_ts", F.timestamp_micros(F.unix_micros("txn_ts")))
    return keyed_rows.unionByName(aside.select(*txn.columns), allowMissingColumns=True)
