"""As-of fusion: published rows, edge rows, and independence from the layout."""

import pytest
from frames import account, account_frame, auth_frame, demo, login, spend, txn_frame
from pyspark.sql import functions as F

from cardwarden.functions.risk import add_reason_codes, recommended_action, split_codes
from cardwarden.operators.asof import asof_join, followed_by
from cardwarden.operators.slices import split_hot_keys
from cardwarden.plans import gold as g

ALL_FOUR = "new_device_recent,geo_mismatch,failed_logins_burst,ato_signal"
LAST_THREE = "geo_mismatch,failed_logins_burst,ato_signal"


def fused(spark, logins, spends, accounts=None):
    accounts = accounts if accounts is not None else [account("A"), account("B")]
    out = g.fuse(
        txn_frame(spark, *spends), auth_frame(spark, *logins), account_frame(spark, *accounts)
    )
    return {r.txn_id: r for r in out.collect()}


def test_demo_row(spark):
    auth, txn, accounts = demo(spark)
    row = g.gold(txn, auth, accounts).collect()[0]
    assert row.minutes_since_new_device_login == 4.0
    assert (row.geo_mismatch_flag, row.failed_logins_1h, row.recent_ato_label) == (1, 4, 1)
    assert row.device_is_new == 1 and row.segment == "premium"
    assert row.reason_codes == ALL_FOUR


@pytest.mark.parametrize("minutes,geo,fails,ato,new,codes", [
    (4.0, 1, 4, 1, 1, ALL_FOUR),
    (315.0, 1, 4, 1, 1, LAST_THREE),
    (277.0, 1, 3, 1, 1, LAST_THREE),
    (741.0, 1, 5, 1, 1, LAST_THREE),
    (1865.0, 1, 3, 1, 1, LAST_THREE),
    (15.0, 0, 0, 0, 1, "new_device_recent"),
    (15.01, 0, 0, 0, 1, ""),
    (10.0, 0, 2, 0, 0, ""),
    (None, 0, 0, 0, 0, ""),
    (-1.0, 0, 0, 0, 1, ""),
])
def test_codes(spark, minutes, geo, fails, ato, new, codes):
    df = spark.createDataFrame(
        [(minutes, geo, fails, ato, new)],
        "minutes_since_new_device_login double, geo_mismatch_flag int, failed_logins_1h int, "
        "recent_ato_label int, device_is_new int",
    )
    assert add_reason_codes(df).first().reason_codes == codes


def test_equal_time_matches_and_a_microsecond_later_does_not(spark):
    logins = [login("E1", "A", 0), login("E2", "B", 1 / 60_000_000)]
    rows = fused(spark, logins, [spend("T1", "A", 0), spend("T2", "B", 0)])
    assert rows["T1"].last_event_id == "E1" and rows["T1"].minutes_since_new_device_login == 0.0
    assert rows["T2"].last_event_id is None


def test_greater_event_id_wins_at_equal_time(spark):
    rows = fused(spark, [login("E1", "A", 0), login("E2", "A", 0, fails=3)], [spend("T", "A", 5)])
    assert rows["T"].last_event_id == "E2" and rows["T"].failed_logins_1h == 3


def test_no_login_unknown_account_null_geo_null_time(spark):
    logins = [
        login("E1", "A", 10, new=1, geo="GB-LON", fails=5), login("E2", "B", -5, geo=None),
        login("E3", "B", None, fails=6), login("E4", "C", -1, geo="GB-LON"),
        login("E5", None, -1),
    ]
    spends = [
        spend("early", "A", 0), spend("nogeo", "B", 0), spend("stranger", "C", 0),
        spend("notime", "B", None), spend("nokey", None, 0),
    ]
    rows = fused(spark, logins, spends)
    assert len(rows) == 5
    early = rows["early"]
    assert early.minutes_since_new_device_login is None and early.reason_codes == ""
    assert (early.failed_logins_1h, early.device_is_new, early.recent_ato_label) == (0, 0, 0)
    assert rows["nogeo"].last_event_id == "E2" and rows["nogeo"].geo_mismatch_flag == 0
    assert rows["stranger"].segment is None and rows["stranger"].geo_mismatch_flag == 0
    assert rows["notime"].last_event_id is None
    assert rows["nokey"].last_event_id is None


def test_fraction_of_a_second_and_rounding(spark):
    rows = fused(spark, [login("E", "A", 0, new=1)], [spend("T", "A", 15.004)])
    assert rows["T"].minutes_since_new_device_login == 15.0
    assert rows["T"].reason_codes == "new_device_recent"


def test_duplicate_transaction_keeps_the_newest(spark):
    rows = fused(spark, [], [spend("T", "A", 0, 5.0), spend("T", "A", 3, 7.0)])
    assert len(rows) == 1 and rows["T"].amount == 7.0


def test_later_logins_change_latest_row_but_not_asof(spark, feeds):
    newest = feeds.txn.agg(F.max("txn_ts")).first()[0]
    late = feeds.auth.limit(50).withColumns({
        "event_ts": F.lit(newest) + F.expr("INTERVAL 1 DAY"),
        "event_id": F.col("event_id") + 10_000_000,
        "failed_attempts_1h": F.lit(9),
    })
    more = feeds.auth.unionByName(late)
    before = sorted(g.gold(feeds.txn, feeds.auth, feeds.accounts).collect())
    assert sorted(g.gold(feeds.txn, more, feeds.accounts).collect()) == before
    state = lambda a: sorted(
        g.fuse_latest(feeds.txn, a, feeds.accounts).select("txn_id", "failed_logins_1h").collect()
    )
    assert state(more) != state(feeds.auth)


def test_result_does_not_depend_on_partitions_or_slices(spark, feeds):
    want = sorted(g.gold(feeds.txn, feeds.auth, feeds.accounts).collect())
    mixed = g.gold(feeds.txn.repartition(7), feeds.auth.repartition(5), feeds.accounts)
    assert sorted(mixed.collect()) == want
    frames = [(feeds.txn, "txn_ts"), (feeds.auth, "event_ts")]
    for slice_rows in (1, 4, 30):
        split = split_hot_keys(frames, "account_id", hot_rows=20, slice_rows=slice_rows)
        assert split.hot.count() > 5
        assert sorted(g.gold(feeds.txn, feeds.auth, feeds.accounts, split).collect()) == want
    few = split_hot_keys(frames, "account_id", hot_rows=0, slice_rows=3, max_keys=2)
    assert few.hot.count() == 2
    assert sorted(g.gold(feeds.txn, feeds.auth, feeds.accounts, few).collect()) == want


def brute_asof(left, right, forward, tolerance):
    out = {}
    for t in left:
        if forward:
            near = [r for r in right if r[1] == t[1] and r[2] >= t[2]]
            best = min(near, key=lambda r: (r[2], r[0]), default=None)
        else:
            near = [r for r in right if r[1] == t[1] and r[2] <= t[2]]
            best = max(near, key=lambda r: (r[2], r[0]), default=None)
        if best and tolerance and abs((best[2] - t[2]).total_seconds()) > tolerance:
            best = None
        out[t[0]] = best and best[0]
    return out


@pytest.mark.parametrize("forward", [False, True])
@pytest.mark.parametrize("tolerance", [None, 3600])
@pytest.mark.parametrize("hot_rows,slice_rows", [(10**9, 1), (3, 2), (0, 1)])
def test_asof_against_brute_force(spark, forward, tolerance, hot_rows, slice_rows):
    import random

    rng = random.Random(7)
    # Few distinct times, so that ties and empty slices occur; one account holds most rows.
    who = lambda: "A" if rng.random() < 0.6 else rng.choice("BCDE")
    logins = [login(f"E{i:03d}", who(), rng.randrange(0, 600, 10)) for i in range(80)]
    spends = [spend(f"T{i:03d}", who(), rng.randrange(-50, 700, 5)) for i in range(120)]
    left, right = txn_frame(spark, *spends), auth_frame(spark, *logins)
    split = split_hot_keys(
        [(left, "txn_ts"), (right, "event_ts")], "account_id", hot_rows, slice_rows
    )
    got = asof_join(
        left, right, "account_id", "txn_ts", "event_ts", ["event_id"], "event_id", tolerance,
        split, forward,
    )
    assert {r.txn_id: r.event_id for r in got.collect()} == brute_asof(
        spends, logins, forward, tolerance
    )


@pytest.mark.parametrize("hot_rows", [10**9, 2])
def test_followed_by_against_brute_force(spark, hot_rows):
    import random

    rng = random.Random(3)
    logins = [login(f"E{i}", rng.choice("AAAB"), rng.randrange(0, 300, 5)) for i in range(40)]
    spends = [
        spend(f"T{i:02d}", rng.choice("AAAB"), rng.randrange(0, 400, 5), float(i)) for i in range(60)
    ]
    a, t = auth_frame(spark, *logins).select("event_id", "account_id", "event_ts"), txn_frame(
        spark, *spends
    )
    split = split_hot_keys([(a, "event_ts"), (t, "txn_ts")], "account_id", hot_rows, 3)
    got = {r.event_id: r for r in followed_by(a, t, 1800, split).collect()}
    want = {}
    for e in logins:
        hits = [
            s for s in spends if s[1] == e[1] and 0 <= (s[2] - e[2]).total_seconds() <= 1800
        ]
        if hits:
            want[e[0]] = (
                min(hits, key=lambda s: (s[2], s[0]))[0], len(hits), sum(round(s[3] * 100) for s in hits)
            )
    assert {k: (r.first_txn_id, r.n_purchases, r.spend_cents) for k, r in got.items()} == want


def test_actions(spark):
    df = spark.createDataFrame(
        [(0.9, ALL_FOUR), (0.8, "geo_mismatch"), (0.5, ""), (0.49, "ato_signal"), (None, "ato_signal")],
        "risk_score double, reason_codes string",
    )
    assert [r.recommended_action for r in recommended_action(df).collect()] == [
        "Hold + step-up authentication", "Escalate to fraud analyst", "Escalate to fraud analyst",
        "Approve", None,
    ]


def test_split_codes(spark):
    df = spark.createDataFrame([("a,b",), ("",), (None,)], "reason_codes string")
    assert [r.c for r in df.select(split_codes().alias("c")).collect()] == [["a", "b"], [], []]


def test_plan_has_one_big_shuffle_and_prunes_the_scan(spark, feeds):
    plan = g.gold(feeds.txn, feeds.auth, feeds.accounts, feeds.split)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "pan_token" not in text.split("FileScan")[-1]
    assert "EqualTo(event_type,purchase)" in text
