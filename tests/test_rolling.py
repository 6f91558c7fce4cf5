"""Moving sums against brute force, whole and cut into slices."""

import random

import pytest
from frames import auth_frame, login, spend, txn_frame

from cardwarden.operators import rolling
from cardwarden.operators.slices import split_hot_keys

CUTS = [(10**9, 1), (5, 3), (0, 1)]


def random_spends(seed, n=150):
    rng = random.Random(seed)
    return [
        spend(f"T{i:03d}", rng.choice("AAAAB"), rng.randrange(0, 300, 4), rng.randrange(1, 4000) / 100)
        for i in range(n)
    ]


@pytest.mark.parametrize("hot_rows,slice_rows", CUTS)
def test_spend_features(spark, hot_rows, slice_rows):
    spends = random_spends(1)
    df = txn_frame(spark, *spends)
    split = split_hot_keys([(df, "txn_ts")], "account_id", hot_rows, slice_rows)
    got = {r.txn_id: r for r in rolling.spend_features(df, split).collect()}
    assert len(got) == len(spends)
    for t in spends:
        near = [s for s in spends if s[1] == t[1] and 0 <= (t[2] - s[2]).total_seconds() <= 3600]
        before = [s for s in spends if s[1] == t[1] and s[2] < t[2]]
        row = got[t[0]]
        assert row.txn_velocity_1h == len(near)
        assert row.small_txns_1h == sum(s[3] < 10 for s in near)
        if before:
            mean = sum(s[3] for s in before) / len(before)
            assert row.amount_vs_30d_avg == pytest.approx(t[3] / mean, abs=1e-4)
        else:
            assert row.amount_vs_30d_avg is None


@pytest.mark.parametrize("hot_rows,slice_rows", CUTS)
def test_short_span_forgets(spark, hot_rows, slice_rows):
    spends = random_spends(2)
    df = txn_frame(spark, *spends)
    split = split_hot_keys([(df, "txn_ts")], "account_id", hot_rows, slice_rows)
    got = {r.txn_id: r.txn_velocity_1h for r in rolling.txn_velocity(df, 480, split).collect()}
    for t in spends:
        near = [s for s in spends if s[1] == t[1] and 0 <= (t[2] - s[2]).total_seconds() <= 480]
        assert got[t[0]] == len(near)


@pytest.mark.parametrize("hot_rows,slice_rows", CUTS)
def test_geo_impossible_and_failures(spark, hot_rows, slice_rows):
    rng = random.Random(5)
    logins = [
        login(f"E{i:03d}", rng.choice("AAAB"), rng.randrange(0, 3000, 7), geo=rng.choice(["x", "y", None]),
              result=rng.choice(["success", "failure"]))
        for i in range(120)
    ]
    df = auth_frame(spark, *logins)
    split = split_hot_keys([(df, "event_ts")], "account_id", hot_rows, slice_rows)
    want = set()
    for who in "AB":
        mine = sorted((e for e in logins if e[1] == who), key=lambda e: (e[2], e[0]))
        for p, e in zip(mine, mine[1:]):
            moved = p[5] and e[5] and p[5] != e[5]
            if moved and (e[2] - p[2]).total_seconds() < 3600:
                want.add((e[0], p[0]))
    got = rolling.geo_impossible(df, split=split).collect()
    assert {(r.event_id, r.prev_event_id) for r in got} == want
    counted = {r.event_id: r.failed_in_span for r in rolling.failed_attempts(df, 3600, split).collect()}
    for e in logins:
        near = [x for x in logins if x[1] == e[1] and 0 <= (e[2] - x[2]).total_seconds() <= 3600]
        assert counted[e[0]] == sum(x[7] == "failure" for x in near)


def test_card_test_burst(spark):
    df = txn_frame(spark, spend("a", "A", 0, 2.0), spend("b", "A", 1, 3.0), spend("c", "A", 2, 50.0),
                   spend("d", "A", 100, 2.0))
    out = {r.txn_id: (r.small_txns_1h, r.card_test_burst) for r in rolling.card_test_burst(df).collect()}
    assert out == {"a": (1, 0), "b": (2, 1), "c": (2, 1), "d": (1, 0)}
