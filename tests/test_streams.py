"""Streams against batch: same rows, no repeats after a restart."""

import random
import time
from datetime import datetime, timedelta
from functools import reduce
from pathlib import Path

import pytest
from frames import account, account_frame, at, auth_frame, login, spend, txn_frame
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.operators.dedup import dedup_stream
from cardwarden.operators.quality import RULES, apply_rules, to_silver
from cardwarden.plans import gold as g
from cardwarden.plans import scoring
from cardwarden.schemas import TXN_RAW
from cardwarden.session import scratch_path
from cardwarden.sources import driver_tables as tables
from cardwarden.sources import versioned
from cardwarden.sources.feeds import read_table, stream_feed
from cardwarden.sources.serving import latest_per_account
from cardwarden.streaming import asof_stream, enrich, login_index, row_velocity, run, serving_stream, silver

SF = "/root/testdata/sf0.001"


def finish(query):
    query.awaitTermination()
    return query


def parts(df, path, n):
    """Writes a frame in n files, in order of time."""
    df.repartitionByRange(n, df.columns[0]).write.parquet(path)


def test_csv_stream_equals_batch_and_restart_adds_nothing(spark):
    root = scratch_path(spark, "csv")
    raw = tables.raw_txn(spark, SF)
    raw.repartition(3).write.option("header", True).csv(f"{root}/landing")
    metrics = run.RuleMetrics(spark, f"{root}/metrics")
    spark.streams.addListener(metrics)

    def once():
        stream = silver.silver_stream(
            stream_feed(spark, f"{root}/landing", TXN_RAW, max_files=1), "txn", "txn_rules"
        )
        return finish(run.start(stream, f"{root}/out", f"{root}/cp"))

    assert len({p["batchId"] for p in once().recentProgress if p["numInputRows"]}) == 3
    want = apply_rules(to_silver(raw, "txn"), RULES["txn"])
    for _ in range(2):
        got = spark.read.schema(want.schema).parquet(f"{root}/out")
        assert got.count() == want.count() and got.exceptAll(want).count() == 0
        once()
    extra = raw.limit(1).withColumn("txn_id", F.lit("new")).withColumns(
        {"account_id": F.lit("1"), "amount": F.lit("5")}
    )
    extra.write.mode("append").option("header", True).csv(f"{root}/landing")
    once()
    assert spark.read.parquet(f"{root}/out").where("txn_id = 'new'").count() == 1
    def counted():
        if not Path(root, "metrics").exists():
            return 0
        rows = run.read_metrics(spark, f"{root}/metrics").where("name = 'txn_rules'").collect()
        return sum(r.counts["n_in"] for r in rows)

    deadline = time.time() + 30  # progress reports arrive a little after the batch
    while counted() < raw.count() + 1 and time.time() < deadline:
        time.sleep(0.5)
    spark.streams.removeListener(metrics)
    assert counted() == raw.count() + 1


def test_enrich_stream_equals_batch(spark, feeds):
    root = scratch_path(spark, "enrich")
    parts(feeds.txn, f"{root}/txn", 3)
    txn = read_table(spark, f"{root}/txn", streaming=True, max_files=1)
    for _ in range(2):
        finish(enrich.start_enrich(
            txn, lambda batch: feeds.auth, lambda s: feeds.accounts, f"{root}/out", f"{root}/cp"
        ))
        got = run.read_batches(spark, f"{root}/out")
        want = g.gold(feeds.txn, feeds.auth, feeds.accounts)
        assert sorted(got.select(*want.columns).collect()) == sorted(want.collect())


def test_login_index_reads_own_days_and_the_carry(spark):
    root = scratch_path(spark, "index")
    day = 24 * 60
    rng = random.Random(6)
    logins = [login(f"e{i}", rng.choice("ABCDE"), rng.uniform(0, 40 * day), fails=i % 5) for i in range(600)]
    late = [login("late", "F", 3 * day, fails=9), login("none", None, 0), login("untimed", "A", None)]
    first, second = logins[:400], logins[400:] + late
    login_index.add_logins(auth_frame(spark, *first), 0, root)
    login_index.roll(spark, root, _day(30), 0)
    for _ in range(2):  # a repeated micro-batch
        login_index.add_logins(auth_frame(spark, *second), 1, root)
    everything = auth_frame(spark, *logins, *late)
    accounts = account_frame(spark, *[account(a) for a in "ABCDEF"])
    spends = [spend(f"t{i}", rng.choice("ABCDEF"), rng.uniform(33 * day, 35 * day), float(i)) for i in range(60)]
    batches = {
        "new": spends, "with old ones": [*spends[:5], spend("o1", "A", 31 * day), spend("o2", "F", 2 * day),
                                        spend("o3", "F", 4 * day), spend("o4", "B", 20 * day), spend("o5", None, day)],
        "untimed": [spend("u", "A", None)],
    }
    for name, rows in batches.items():
        batch = txn_frame(spark, *rows)
        want = g.gold(batch, everything, accounts)
        got = enrich.fuse_microbatch(batch, login_index.logins_for(batch, root), accounts)
        assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str), name

    batch = txn_frame(spark, *spends)
    days = {r.d for r in batch.select(login_index.day_of("txn_ts").alias("d")).collect()}
    stored = sum(f.stat().st_size for f in Path(root, "logins").rglob("*.parquet"))
    read = _read(spark, login_index.logins_for(batch, root))
    assert 0 < read["logins"][0] <= 2 * len(days) and 0 < read["logins"][1] < stored * (len(days) + 1) / 40
    assert read["carry"][0] > 0
    # One row per account for the days since the carry, and for those of later micro-batches.
    folders = Path(root, "last").glob("day=*/batch_id=*/*.parquet")
    open_days = [f for f in folders if int(f.parts[-3][4:]) >= _day(30) or f.parts[-2] == "batch_id=1"]
    assert 0 < read["last"][0] <= len(open_days)
    login_index.roll(spark, root, _day(33), 1)  # a carry made from the carry before it
    again = login_index.logins_for(batch, root)
    got = enrich.fuse_microbatch(batch, again, accounts)
    assert sorted(got.collect()) == sorted(g.gold(batch, everything, accounts).collect())
    assert _read(spark, login_index.logins_for(batch, root))["last"][0] <= 2


def _read(spark, df):
    """(files, bytes) that a query read, by the folder below the index."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.collect()
        leaves, found = df._jdf.queryExecution().executedPlan().collectLeaves(), {}
        for i in range(leaves.size()):
            if (leaf := leaves.apply(i)).nodeName().startswith("Scan parquet"):
                folder = leaf.relation().location().rootPaths().head().getName()
                files, size = found.get(folder, (0, 0))
                count = lambda name: leaf.metrics().apply(name).value()  # noqa: E731, B023
                found[folder] = files + count("numFiles"), size + count("filesSize")
        return found
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def _day(n):
    """The day of the time n days after T0."""
    return int((at(n * 24 * 60) - datetime(1970, 1, 1)).days)


def test_repeated_batch_is_replaced(spark):
    root = scratch_path(spark, "repeat")
    for _ in range(2):
        run.write_batch(spark.range(3), 0, root)
    run.write_batch(spark.range(2), 1, root)
    assert run.read_batches(spark, root).count() == 5


def test_serving_versions(spark, feeds, monkeypatch):
    root = scratch_path(spark, "serving")
    scored = scoring.rule_score(g.fuse(feeds.txn, feeds.auth, feeds.accounts)).persist()
    parts = [scored.where(F.pmod(F.xxhash64("txn_id"), F.lit(5)) == i) for i in range(5)]

    def holds(*batches):
        want = latest_per_account(reduce(DataFrame.unionByName, [parts[i] for i in batches]))
        table = versioned.read(spark, root)
        assert sorted(table.collect()) == sorted(want.collect())
        return table

    with pytest.raises(ValueError):
        versioned.read(spark, root)
    versioned.upsert(parts[0], 0, root)
    versioned.upsert(parts[0], 0, root)  # a repeated micro-batch
    holds(0)
    versioned.upsert(parts[1], 1, root)
    versioned.compact(spark, root)
    first = versioned.current(spark, root)
    assert (first.number, first.folded) == (1, {0, 1})
    folder = f"/bases/{first.base}/"
    assert all(folder in f for f in holds(0, 1).inputFiles())  # the base alone
    versioned.upsert(parts[1], 1, root)  # repeated after it was folded
    versioned.upsert(parts[2], 2, root)
    read = {f.rsplit("/", 2)[0].rsplit("/", 1)[1] for f in holds(0, 1, 2).inputFiles()}
    assert read == {"bases", "batches"}

    # A compaction that dies before the switch leaves the table as it was.
    with monkeypatch.context() as broken:
        broken.setattr(versioned, "_switch", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            versioned.compact(spark, root)
    assert versioned.current(spark, root) == first
    holds(0, 1, 2)

    # An upsert while a compaction runs is in neither its base nor its list, and stays.
    store = versioned._store

    def slow(rows, path):
        store(rows, path)
        if "/bases/" in path:
            monkeypatch.setattr(versioned, "_store", store)
            versioned.upsert(parts[3], 3, root)

    monkeypatch.setattr(versioned, "_store", slow)
    versioned.compact(spark, root)
    assert versioned.current(spark, root).number == 2
    holds(0, 1, 2, 3)
    # Two compactions side by side: both bring a row of one version, either is right.
    before = versioned.current(spark, root)
    versioned.compact(spark, root)
    batches = versioned._open_batches(spark, root, before)
    store(holds(0, 1, 2, 3), f"{root}/bases/0")
    versioned._switch(spark, root, before, "0", batches)
    assert versioned.current(spark, root).base == "0"
    versioned.upsert(parts[4], 4, root)
    versioned.compact(spark, root)
    versioned.vacuum(spark, root, keep=1)
    holds(0, 1, 2, 3, 4)
    assert len(list(Path(root, "bases").iterdir())) == len(list(Path(root, "versions").iterdir())) == 1
    versioned.publish(parts[2], root)
    holds(2)
    scored.unpersist()


def test_serving_upsert_says_again_when_the_version_moves(spark, feeds, monkeypatch):
    root = scratch_path(spark, "serving-moves")
    scored = scoring.rule_score(g.fuse(feeds.txn, feeds.auth, feeds.accounts))
    versioned.upsert(scored.where("txn_id % 2 = 0"), 0, root)
    say, done = versioned._say, []

    def later(row, path):
        if not done:  # the version moves between the look and the word
            done.append(1)
            versioned.compact(spark, root)
            versioned.compact(spark, root)
        say(row, path)

    monkeypatch.setattr(versioned, "_say", later)
    versioned.upsert(scored.where("txn_id % 2 = 1"), 1, root)
    assert sorted(versioned.read(spark, root).collect()) == sorted(latest_per_account(scored).collect())


def test_serving_stream_compacts(spark, feeds):
    root = scratch_path(spark, "serving-stream")
    scored = scoring.rule_score(g.fuse(feeds.txn, feeds.auth, feeds.accounts))
    scored.repartition(4).write.parquet(f"{root}/in")
    stream = read_table(spark, f"{root}/in", streaming=True, max_files=1)
    finish(serving_stream.start_serving(stream, f"{root}/table", f"{root}/cp", compact_every=2))
    assert versioned.current(spark, f"{root}/table").number == 2
    want = latest_per_account(spark.read.parquet(f"{root}/in"))
    assert sorted(versioned.read(spark, f"{root}/table").collect()) == sorted(want.collect())


def test_stream_dedup(spark):
    root = scratch_path(spark, "dedup")
    rows = txn_frame(spark, spend("a", "A", 0), spend("a", "A", 1), spend("b", "A", 2))
    rows.repartition(1).write.parquet(f"{root}/in")
    stream = dedup_stream(read_table(spark, f"{root}/in", streaming=True), "txn_id", "txn_ts", "1 hour")
    finish(run.start(stream, f"{root}/out", f"{root}/cp"))
    assert sorted(r.txn_id for r in spark.read.parquet(f"{root}/out").collect()) == ["a", "b"]


def test_stream_dedup_of_a_hot_id(spark):
    root = scratch_path(spark, "dedup-hot")
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("event_id"), F.lit(at(0)).alias("ts")
    )
    for _ in range(2):  # the copies go on in the next micro-batch
        rows.repartition(8).write.mode("append").parquet(f"{root}/in")
        stream = dedup_stream(read_table(spark, f"{root}/in", streaming=True), "event_id", "ts", "1 hour", shares=4)
        finish(run.start(stream, f"{root}/out", f"{root}/cp"))
    ids = [r.event_id for r in spark.read.parquet(f"{root}/out").collect()]
    assert len(ids) == len(set(ids)) == 2001


def released(spark, root, batches, hot=None):
    """Runs the stream-stream join over batches of (spends, logins); the login told last of each spend."""
    asof_stream.use_rocksdb(spark)
    for i, (spends, logins) in enumerate(batches):
        txn_frame(spark, *spends).coalesce(1).write.mode("append").parquet(f"{root}/txn")
        auth_frame(spark, *logins).coalesce(1).write.mode("append").parquet(f"{root}/auth")
        stream = asof_stream.fuse_stream(
            read_table(spark, f"{root}/txn", streaming=True),
            read_table(spark, f"{root}/auth", streaming=True), "10 minutes", hot=hot,
        )
        finish(run.start(stream, f"{root}/out", f"{root}/cp"))
    rows = asof_stream.settled(spark.read.parquet(f"{root}/out")).collect()
    return {r.txn_id: r.last_event_id for r in rows}


def test_stream_asof_waits_for_late_logins_over_restarts(spark):
    batches = [
        ([spend("t1", "A", 0), spend("t2", "A", 6)], [login("e1", "A", -5), login("e9", "B", 0)]),
        # e2 is late for t2 but within the delay; it must win.
        ([spend("t3", "B", 12)], [login("e2", "A", 5), login("e3", "B", 11)]),
        ([spend("t4", "A", 40)], [login("e4", "A", 40)]),
        ([spend("end", "Z", 90)], [login("eend", "Z", 90)]),
    ]
    want = {"t1": "e1", "t2": "e2", "t3": "e3", "t4": "e4", "end": "eend"}
    assert released(spark, scratch_path(spark, "asof"), batches) == want
    hot = spark.createDataFrame([("A", 3)], "account_id string, shares int")
    assert released(spark, scratch_path(spark, "asof-hot"), batches, hot) == want


def test_stream_asof_loses_no_row(spark):
    """Late, repeated and keyless rows come out of the stream alone, over restarts; plain version beside it."""
    rng, batches, logins, spends = random.Random(4), [], [], []
    for batch in range(5):
        start = batch * 240
        minutes = lambda: start + rng.randrange(-300, 60)  # noqa: E731, B023 - up to five hours late
        new_logins = [login(f"e{batch}-{i}", rng.choice("ABC"), minutes(), fails=i) for i in range(25)]
        new_spends = [spend(rng.choice(["same", None, f"t{batch}-{i}"]), rng.choice("ABC"), minutes(), float(i)) for i in range(25)]
        new_spends += [spend(f"n{batch}", None, minutes()), spend("n", "A", None), spend(None, None, None)]
        batches.append((new_spends, [*new_logins, login(f"x{batch}", None, 0), login(f"y{batch}", "A", None)]))
        logins += [(r, batch) for r in new_logins]
        spends += [(r, batch) for r in new_spends]
    root = scratch_path(spark, "asof-all")
    released(spark, root, batches)
    told = spark.read.parquet(f"{root}/out")
    rows = asof_stream.settled(told).collect()
    assert len(rows) == len(spends)

    # Plain version: what a spend is told depends on the watermark at its batch.
    seen, mark, want = [], None, []
    marks = []
    for batch in range(5):
        marks.append(mark)
        times = [[r[2] for r, b in kind if b <= batch and r[1] and r[2]] for kind in (spends, logins)]
        mark = min(max(t) for t in times) - timedelta(minutes=10)
        seen = [r for r, b in logins if b <= batch]
    for r, b in spends:
        found = None
        if r[1] and r[2]:
            # revised by logins of later batches until the watermark passes the spend's hour
            hour = r[2].replace(minute=0, second=0, microsecond=0) + timedelta(hours=1)
            late = marks[b] is not None and r[2] <= marks[b]
            last = b if late else max(k for k in range(b, 5) if k == b or marks[k] < hour)
            known = [(x[2], x[0]) for x, k in logins if k <= last and x[1] == r[1] and x[2] <= r[2]]
            found = max(known, default=(None, None))[1]
        want.append((r[0], r[1], r[2], r[3], found))
    got = [(r.txn_id, r.account_id, r.txn_ts, r.amount, r.last_event_id) for r in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert told.where("late").count() and told.where("revision > 0").count()


def test_stream_asof_folds_old_logins(spark):
    root = scratch_path(spark, "asof-fold")
    asof_stream.use_rocksdb(spark)
    steps = [
        ([spend("t1", "A", 0)], [login("e1", "A", -50), login("e2", "A", -5), login("z", "Z", 0)]),
        ([spend("t2", "Z", 900)], [login("z9", "Z", 900)]),  # e1 and e2 are folded into e2
        ([spend("t3", "A", 300), spend("t4", "A", -20), spend("t5", "A", 905)], [login("e0", "A", -60)]),
        ([spend("end", "Z", 2000)], [login("z10", "Z", 2000)]),
    ]
    for spends, logins in steps:
        txn_frame(spark, *spends).coalesce(1).write.mode("append").parquet(f"{root}/txn")
        auth_frame(spark, *logins).coalesce(1).write.mode("append").parquet(f"{root}/auth")
        stream = asof_stream.fuse_stream(
            read_table(spark, f"{root}/txn", streaming=True),
            read_table(spark, f"{root}/auth", streaming=True), "10 minutes", keep_hours=2,
        )
        finish(run.start(stream, f"{root}/out", f"{root}/cp"))
    rows = asof_stream.settled(spark.read.parquet(f"{root}/out")).where("account_id = 'A'").collect()
    assert {r.txn_id: r.last_event_id for r in rows} == {"t1": "e2", "t3": "e2", "t4": None, "t5": "e2"}


def test_stream_asof_keeps_gaps_and_big_ids(spark):
    root = scratch_path(spark, "asof-gaps")
    big = 2**53 + 1
    logins = auth_frame(
        spark, login("0", "A", -9, geo="x", fails=3), login("1", "A", -5, geo=None, fails=None),
        login("2", "A", 2, geo="y", fails=7), login("9", "Z", 90),
    ).withColumn("event_id", F.col("event_id").cast("bigint") + big)
    spends = txn_frame(
        spark, spend("0", "A", -6, None), spend("1", "A", 0, 2.5), spend("2", "A", 3), spend("9", "Z", 90)
    ).withColumn("txn_id", F.col("txn_id").cast("bigint") + big)
    logins.coalesce(1).write.parquet(f"{root}/auth")
    spends.coalesce(1).write.parquet(f"{root}/txn")
    asof_stream.use_rocksdb(spark)
    stream = asof_stream.fuse_stream(
        read_table(spark, f"{root}/txn", streaming=True),
        read_table(spark, f"{root}/auth", streaming=True), "10 minutes",
    )
    finish(run.start(stream, f"{root}/out", f"{root}/cp"))
    told = asof_stream.settled(spark.read.parquet(f"{root}/out"))
    rows = told.where("account_id = 'A'").orderBy("txn_ts").collect()
    assert [(r.txn_id - big, r.last_event_id - big, r.failed_attempts_1h, r.ip_geo, r.amount) for r in rows] == [
        (0, 0, 3, "x", None), (1, 1, None, None, 2.5), (2, 2, 7, "y", 20.0),
    ]


def test_velocity_per_row_with_late_rows(spark):
    rng, root, every = random.Random(9), scratch_path(spark, "row-velocity"), []
    asof_stream.use_rocksdb(spark)
    for batch in range(3):
        start = batch * 120
        rows = [spend(f"t{batch}-{i}", rng.choice("AAB"), start + rng.choice([-200, -90, -30, 0]) + rng.random() * 60, float(i))
                for i in range(30)]
        rows += [spend("same", "A", start, 1.0), spend("same", "A", start, 1.0), spend(None, "B", start + 60)]
        rows += [spend("n", None, start), spend("m", "A", None)]
        every += rows
        txn_frame(spark, *rows).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = row_velocity.velocity_per_row(read_table(spark, f"{root}/in", streaming=True), "10 minutes")
        finish(run.start(stream, f"{root}/out", f"{root}/cp"))
    told = spark.read.parquet(f"{root}/out")
    hour = timedelta(hours=1)
    want = [
        (r[0], r[1], r[2], r[3], None if None in r[1:3] else sum(
            o[1] == r[1] and o[2] is not None and r[2] - hour <= o[2] <= r[2] for o in every))
        for r in every
    ]
    got = [(r.txn_id, r.account_id, r.txn_ts, r.amount, r.txn_velocity_1h) for r in row_velocity.settled(told).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert told.where("revision > 0").count() and not told.where("NOT whole_history").count()


def test_velocity_windows(spark):
    root = scratch_path(spark, "velocity")
    txn_frame(spark, spend("a", "A", 0, 1.0), spend("b", "A", 20, 2.0), spend("z", "B", 600)).coalesce(
        1
    ).write.parquet(f"{root}/in")
    stream = silver.velocity_stream(read_table(spark, f"{root}/in", streaming=True))
    finish(run.start(stream, f"{root}/out", f"{root}/cp"))
    rows = spark.read.parquet(f"{root}/out").where("account_id = 'A'").collect()
    assert {(r.window_start, r.n_txns, r.spend_cents) for r in rows} == {
        (at(-45), 1, 100), (at(-30), 2, 300), (at(-15), 2, 300), (at(0), 2, 300), (at(15), 1, 200),
    }
