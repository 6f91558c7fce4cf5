"""Contributors, masks, model metrics, cases, narratives and KPIs."""

import math

import pandas as pd
import pytest
from frames import at, demo, spend, txn_frame
from pyspark.sql import functions as F

from cardwarden.functions.masks import mask_email, mask_pan, pan_token
from cardwarden.operators.contributors import top_contributors
from cardwarden.plans import cases, governance, kpis, scoring
from cardwarden.plans import gold as g
from cardwarden.schemas import FEATURES, GOLD_COLUMNS


def test_masks_and_token(spark):
    df = spark.createDataFrame(
        [("ACC-100042", "user100042@example.invalid", "tok_8238295cccb4d5b2"), ("x", None, None)],
        "account_id string, email string, pan_token string",
    )
    rows = df.select(
        mask_email("email").alias("e"), mask_pan("pan_token").alias("p"),
        pan_token("account_id").alias("t"),
    ).collect()
    assert tuple(rows[0]) == ("us***@***.invalid", "tok_****d5b2", "tok_8238295cccb4d5b2")
    assert rows[1].e is None and rows[1].p is None


def test_policy_masks_tags_and_privilege(spark, feeds):
    shown = governance.apply_policy(feeds.accounts, "accounts", "analyst")
    assert governance.tags_of(shown)["email"] == {"pii": "email", "division": "credit"}
    assert shown.where("email NOT LIKE 'us***@***.invalid'").count() == 0
    open_policy = [governance.ColumnPolicy("accounts", "email", {}, mask_email, ("steward",))]
    clear = governance.apply_policy(feeds.accounts, "accounts", "steward", open_policy)
    assert clear.where("email LIKE 'user%'").count() == feeds.accounts.count()
    assert governance.row_filter(feeds.accounts) is feeds.accounts
    assert governance.row_filter(feeds.accounts, "home_geo = 1").count() < feeds.accounts.count()


def test_division_views_do_not_overlap_on_signals(spark, feeds):
    scored = scoring.rule_score(g.fuse(feeds.txn, feeds.auth, feeds.accounts))
    cyber = governance.division_view(scored, "cyber").columns
    credit = governance.division_view(scored, "credit").columns
    assert "amount" not in cyber and "geo_mismatch_flag" not in credit
    assert set(governance.division_view(scored, "shared").columns) == {
        "txn_id", "account_id", "txn_ts", "risk_score", "reason_codes"
    }


def test_contributors_of_the_demo_case(spark):
    auth, txn, accounts = demo(spark)
    rows = top_contributors(g.fuse(txn, auth, accounts)).orderBy("rank").collect()
    assert [(r.feature, r.value, r.importance, r.contribution, r.fired) for r in rows] == [
        ("amount", 2318.47, 0.8347, 0.8347, "Yes"),
        ("minutes_since_new_device_login", 4.0, 0.1542, 0.1542, "Yes"),
        ("failed_logins_1h", 4.0, 0.0093, 0.05, "Yes"),
        ("geo_mismatch_flag", 1.0, 0.0017, 0.05, "Yes"),
        ("recent_ato_label", 1.0, 0.0, 0.05, "Yes"),
    ]


def test_metrics_of_a_known_confusion_matrix(spark):
    parts = [(0, 0.1, 1894), (0, 0.9, 16), (1, 0.1, 87), (1, 0.9, 3)]
    rows = [(label, score) for label, score, n in parts for _ in range(n)]
    df = spark.createDataFrame(rows, "fraud_label int, risk_score double")
    pr = scoring.precision_recall(df).first()
    assert pr.precision == 0.15789473684210525 and pr.recall == 0.03333333333333333
    cells = {(r.label, r.predicted): r.n for r in scoring.confusion(df).collect()}
    assert cells == {(0, 0): 1894, (0, 1): 16, (1, 0): 87, (1, 1): 3}
    none = scoring.precision_recall(df, threshold=2.0).first()
    assert none.precision == 0.0 and none.recall == 0.0


def test_auc_against_all_pairs(spark):
    rows = [(i % 3 == 0 and 1 or 0, round(((i * 37) % 11) / 10, 1)) for i in range(60)]
    df = spark.createDataFrame(rows, "fraud_label int, risk_score double")
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert scoring.roc_auc(df).first().roc_auc == pytest.approx(want, abs=1e-6)
    one = scoring.roc_auc(df.where("fraud_label = 1")).first()
    assert one.roc_auc is None


def test_exact_split_sizes(spark):
    df = spark.range(1000).selectExpr(
        "concat('T', id) AS txn_id", "cast(id % 10 = 0 AS int) AS fraud_label"
    )
    split = scoring.stratified_split(df)
    counts = {(r.fraud_label, r.split): r["count"] for r in split.groupBy("fraud_label", "split").count().collect()}
    assert counts == {(0, "test"): 225, (0, "train"): 675, (1, "test"): 25, (1, "train"): 75}
    again = scoring.stratified_split(df.repartition(5))
    assert split.exceptAll(again).count() == 0


def test_gbt_learns_and_scores_keep_the_frame(spark, feeds):
    gold = g.gold(feeds.txn, feeds.auth, feeds.accounts).persist()
    model = scoring.train_gbt(gold, max_iter=5)
    scored = scoring.score(model, gold)
    assert scored.columns == [*GOLD_COLUMNS, "risk_score", "model_version"]
    assert scored.select(*GOLD_COLUMNS).exceptAll(gold).count() == 0
    assert scoring.roc_auc(scored).first().roc_auc > 0.5
    weights = scoring.importances(model)
    assert set(weights) == set(FEATURES) and sum(weights.values()) == pytest.approx(1, abs=1e-3)
    assert scoring.importance_rows(spark, model).count() == len(FEATURES)
    gold.unpersist()


def test_assemble_fill_and_flag(spark):
    df = spark.createDataFrame(
        [(1.0, None, 1, 2, 0, 1)],
        "amount double, minutes_since_new_device_login double, geo_mismatch_flag int, "
        "failed_logins_1h int, recent_ato_label int, device_is_new int",
    )
    row = scoring.assemble(df, null_fill=-1, has_login_flag=True).first()
    assert row.minutes_since_new_device_login == -1.0 and row.has_login == 0.0


def test_psi_is_zero_for_equal_halves(spark, feeds):
    gold = g.gold(feeds.txn, feeds.auth, feeds.accounts)
    twice = gold.withColumn("cur", F.lit(False)).unionByName(gold.withColumn("cur", F.lit(True)))
    assert all(r.psi == 0 for r in scoring.psi(twice, F.col("cur")).collect())


def scored_rows(spark, *rows):
    return spark.createDataFrame(
        [(t, a, at(m), amount, s, codes, d) for t, a, m, amount, s, codes, d in rows],
        "txn_id string, account_id string, txn_ts timestamp, amount double, risk_score double, "
        "reason_codes string, decision string",
    )


def test_no_code_no_story(spark):
    df = scored_rows(
        spark, ("t1", "A", 0, 12.5, 0.9, "geo_mismatch,ato_signal", "approve"),
        ("t2", "A", 1, 9.0, 0.1, "", "approve"),
    )
    told = {r.txn_id: r.reason_narrative for r in cases.add_narrative(df).collect()}
    assert told["t2"] is None
    assert told["t1"] == (
        "Account A spent $12.50 after a login away from the home place, "
        "an account-takeover signal. Codes: geo_mismatch,ato_signal."
    )
    own = cases.add_narrative(df, lambda pdf: pd.Series(["told " + t for t in pdf["txn_id"]], index=pdf.index))
    assert {r.txn_id: r.reason_narrative for r in own.collect()} == {"t1": "told t1", "t2": None}
    table = cases.build_cases(df).collect()
    assert [(r.case_id, r.analyst_status) for r in table] == [("CASE-t1", "open")]


def test_queue_order(spark):
    rows = [(f"t{i}", "A", i, 1.0, i / 10, "ato_signal", "approve") for i in range(5)]
    rows.append(("demo", "D", 0, 1.0, 0.0, "", "decline"))
    df = scored_rows(spark, *rows)
    queue = cases.case_queue(df, cases.build_cases(df), "demo", 3).collect()
    assert {r.txn_id for r in queue} == {"demo", "t4", "t3"}
    assert [r.txn_id for r in cases.flagged(df, 2).collect()] == ["t4", "t3"]
    picked = cases.queue_from_table(df, "demo", 2).collect()
    assert {r.txn_id for r in picked} == {"demo", "t0", "t1"}
    top = cases.top_risk_approved(df, cases.build_cases(df), 2).collect()
    assert {r.txn_id for r in top} == {"t4", "t3"} and all(r.reason_narrative for r in top)


def test_kpis_by_hand(spark):
    df = txn_frame(
        spark,
        spend("a", "A", 0, 100.0, "approve", 1), spend("b", "A", 1, 50.0, "decline", 0, "7011"),
        spend("c", "A", 2, 30.0, "decline", 1), spend("d", "A", 3, 900.0, "approve", 0),
    )
    assert kpis.fp_decline_rate(df).first().fp_decline_rate == 0.5
    assert kpis.net_fraud_loss(df).first().net_fraud_loss == 100.0
    bps = kpis.loss_bps(df).first()
    assert (bps.approved_volume, bps.loss_bps) == (1000.0, 1000.0)
    assert kpis.false_declines_per_fraud(df).first().false_declines_per_fraud == 0.5
    assert kpis.travel_fp_rate(df, ["7011", "4511"]).first().fp_decline_rate == 1.0
    assert kpis.travel_fp_rate(df, ["none"]).first().fp_decline_rate is None
    week = kpis.weekly_loss_avoided(df).first()
    assert week.loss_avoided == 30.0 and week.loss_avoided_prev_week is None
    empty = kpis.fp_decline_rate(df.where("false")).first()
    assert empty.declines == 0 and empty.fp_decline_rate is None


def test_shared_devices_exact_and_sketch_agree(spark, feeds):
    exact = {r.device_id: r.n_accounts for r in kpis.shared_devices(feeds.auth, 3, today_only=False).collect()}
    rough = kpis.shared_devices(feeds.auth, 0, approx=True, today_only=False).collect()
    assert exact and all(abs(exact.get(r.device_id, r.n_accounts) - r.n_accounts) <= 1 for r in rough)


def test_sweep_agrees_with_single_threshold(spark, feeds):
    scored = scoring.rule_score(g.fuse(feeds.txn, feeds.auth, feeds.accounts))
    one = kpis.shadow_eval(scored, 0.3)
    many = kpis.threshold_sweep(scored, [0.1, 0.3]).where("threshold = 0.3").drop("threshold")
    assert sorted(one.collect()) == sorted(many.select(*one.columns).collect())


def test_auc_ranges_follow_the_scores(spark):
    # Nine tenths of the scores lie in a ten-thousandth of their span.
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 9, 0.5 + F.col("id") / 1e9).otherwise(F.col("id") / 20_000).alias("_s")
    )
    sizes = [r["count"] for r in scoring.score_ranges(rows).groupBy("_range").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 3 * 20_000 / len(sizes) and len(sizes) > 1
    odd = spark.createDataFrame([(None, 1), (0.1, 0), (float("nan"), 1), (0.1, 1)], "risk_score double, fraud_label int")
    assert scoring.roc_auc(odd).first().n_pos == 3
    assert scoring.roc_auc(odd.limit(0)).first().roc_auc is None


def test_psi_counts_bins_that_are_empty_on_both_sides(spark):
    rows = spark.createDataFrame([(1.0, False), (1.0, True), (1.0, True), (9.0, True)], "x double, cur boolean")
    got = scoring.psi(rows, F.col("cur"), {"x": [0, 5, 100]}).first()
    base, cur = [0, 0, 1, 0, 0], [0, 0, 2, 1, 0]  # missing, below 0, to 5, to 100, above
    p, q = [(n + 0.5) / 3.5 for n in base], [(n + 0.5) / 5.5 for n in cur]
    assert got.psi == pytest.approx(sum((b - a) * math.log(b / a) for a, b in zip(p, q)), abs=1e-6)
    assert (got.n_base, got.n_current) == (1, 3)
