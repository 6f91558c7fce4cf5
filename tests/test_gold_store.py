"""Gold by day with tiles against moving sums over all rows."""

import random

from frames import account, account_frame, auth_frame, login, spend, txn_frame

from cardwarden.operators.rolling import amount_vs_avg, txn_velocity
from cardwarden.plans import gold, gold_store
from cardwarden.plans.scoring import rule_score
from cardwarden.session import scratch_path

DAY = 24 * 60


def spends(rng):
    rows = [spend(f"t{i}", rng.choice("AAAB"), rng.uniform(0, 36 * DAY), rng.randrange(1, 500) / 4) for i in range(300)]
    for i, minutes in enumerate([0, 30 * DAY, 31 * DAY, 1 * DAY, 360, 30 * DAY + 360]):
        # exactly 30 days apart, at midnight, and several at one time
        rows += [spend(f"x{i}-{k}", "C", minutes, 10.0 + k) for k in range(2)]
    rows += [spend("d1", "D", 20 * DAY + 355), spend("d2", "D", 20 * DAY + 365)]  # over midnight in UTC
    return [*rows, spend("n1", None, DAY), spend("n2", "A", None), spend("n3", "A", 5 * DAY, None)]


def test_days_equal_moving_sums(spark):
    rng = random.Random(2)
    txn = txn_frame(spark, *spends(rng))
    auth = auth_frame(spark, *[login(f"e{i}", "A", rng.uniform(0, 36 * DAY), new=1, fails=4, ato=1) for i in range(40)])
    whole = gold.gold(txn, auth, account_frame(spark, *[account(a) for a in "ABCD"]))
    path = scratch_path(spark, "gold-days")
    for _ in range(2):  # a repeat replaces its days
        gold_store.write_days(whole, path)
    want = rule_score(amount_vs_avg(txn_velocity(whole))).withColumn("day", gold_store.day_number()).collect()
    plain = [tuple(r[c] for c in gold_store.FEATURE_COLUMNS) for r in want]
    assert sorted(map(tuple, gold_store.features(spark, path).collect()), key=str) == sorted(plain, key=str)

    timed = sorted({r.day for r in want} - {gold_store.NO_DAY})
    of_day = {d: [p for p, r in zip(plain, want, strict=True) if r.day == d] for d in (*timed, gold_store.NO_DAY)}
    for some in ([timed[31]], [timed[30], timed[21], timed[20], timed[0], gold_store.NO_DAY]):
        got = sorted(map(tuple, gold_store.features(spark, path, some).collect()), key=str)
        assert got == sorted((r for d in some for r in of_day[d]), key=str)


def test_a_day_reads_tiles_and_edge_days(spark):
    path = scratch_path(spark, "gold-read")
    whole = gold.gold(txn_frame(spark, *spends(random.Random(2))), auth_frame(spark), account_frame(spark))
    gold_store.write_days(whole, path)
    days = sorted(r.day for r in whole.where("txn_ts IS NOT NULL").select(gold_store.day_number().alias("day")).distinct().collect())
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        one = gold_store.features(spark, path, [days[33]])
        one.collect()
        leaves, read = one._jdf.queryExecution().executedPlan().collectLeaves(), {}
        for i in range(leaves.size()):
            if (leaf := leaves.apply(i)).nodeName().startswith("Scan parquet"):
                folder = leaf.relation().location().rootPaths().head().getName()
                read[folder] = max(read.get(folder, 0), leaf.metrics().apply("numPartitions").value())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert read["rows"] == 1 and read["tiles"] <= 31  # each scan of rows reads one day
