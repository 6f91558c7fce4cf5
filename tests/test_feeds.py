"""Typed projection, rules, readers, sinks, serving, and the generator."""

import json

import pytest
from frames import demo, spend, txn_frame
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cardwarden.operators.dedup import union_distinct
from cardwarden.operators.quality import (
    RULES, apply_rules, flag_warnings, observed, rule_report, to_silver,
)
from cardwarden.operators.select import filter_key, nonempty_codes, select_as, with_code
from cardwarden.plans import gold as g
from cardwarden.plans import scoring
from cardwarden.plans.kpis import profile
from cardwarden.schemas import AUTH_RAW, FEATURES, GOLD_COLUMNS, MODEL_CARD, RAW, TXN_RAW
from cardwarden.session import scratch_path
from cardwarden.sources import serving, sinks, synthetic
from cardwarden.sources.feeds import read_feed, read_table


def raw_txns(spark, *amounts):
    return spark.createDataFrame(
        [(f"T{i}", "A", "2026-09-30T18:00:00Z", a, "5411", "US", "ecom", "tok", "approve", "0")
         for i, a in enumerate(amounts)], TXN_RAW,
    )


def test_bad_amounts_are_dropped_and_counted(spark):
    silver = to_silver(raw_txns(spark, "12.5", "0", "-1", None, "abc"), "txn")
    assert [r.amount for r in apply_rules(silver, RULES["txn"]).collect()] == [12.5]
    report = {r.rule: r for r in rule_report(silver, "txn", RULES["txn"]).collect()}
    assert (report["valid_amount"].n_in, report["valid_amount"].n_pass) == (5, 1)
    assert report["valid_txn"].pass_pct == 100.0 and report["valid_amount"].pass_pct == 20.0


def test_empty_feed_has_no_percent(spark):
    silver = to_silver(spark.createDataFrame([], TXN_RAW), "txn")
    assert all(r.pass_pct is None and r.n_in == 0
               for r in rule_report(silver, "txn", RULES["txn"]).collect())
    assert apply_rules(silver, RULES["txn"]).count() == 0


def test_warn_rule_keeps_the_row(spark):
    raw = spark.createDataFrame(
        [("E1", "A", "not a time", "d", "1", "US", "0", "success", "x", "0", "0"),
         ("E2", None, "2026-09-30T18:00:00Z", "d", "1", "US", "0", "success", "1", "0", "0")],
        AUTH_RAW,
    )
    kept = flag_warnings(apply_rules(to_silver(raw, "auth"), RULES["auth"]), RULES["auth"]).collect()
    assert [(r.event_id, r.violates_ts_present, r.failed_attempts_1h) for r in kept] == [("E1", 1, None)]


def test_counts_while_writing(spark):
    seen = Observation("rules")
    silver = to_silver(raw_txns(spark, "1", "x"), "txn")
    apply_rules(observed(silver, RULES["txn"], seen), RULES["txn"]).write.format("noop").mode(
        "overwrite"
    ).save()
    assert seen.get == {"n_in": 2, "pass_valid_txn": 2, "pass_valid_amount": 1}


def test_small_selects(spark):
    df = spark.createDataFrame(
        [("t1", "ato_signal,geo_mismatch"), ("t2", ""), ("t3", None), ("t4", "no_ato_signal")],
        "txn_id string, reason_codes string",
    )
    assert [r.txn_id for r in nonempty_codes(df).collect()] == ["t1", "t4"]
    assert [r.txn_id for r in with_code(df, "ato_signal").collect()] == ["t1"]
    assert filter_key(df, "txn_id", "t2").count() == 1
    assert select_as(df, {"id": "txn_id", "one": F.lit(1)}).columns == ["id", "one"]


def test_union_distinct_first_frame_wins(spark):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    b = spark.createDataFrame([("x", 2), ("y", 2)], "k string, v int")
    assert sorted(map(tuple, union_distinct([a, b], "k").collect())) == [("x", 1), ("y", 2)]


def test_key_filter_reaches_the_scan(spark):
    path = scratch_path(spark, "pushdown")
    txn_frame(spark, spend("T", "A", 0)).write.parquet(path)
    plan = filter_key(read_table(spark, path), "account_id", "A").select("txn_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(account_id,A)" in text
    assert "ReadSchema: struct<txn_id:string,account_id:string>" in text


@pytest.fixture(scope="module")
def scored(spark):
    auth, txn, accounts = demo(spark)
    return g.fuse(txn, auth, accounts).withColumns(
        {"risk_score": F.lit(0.9), "model_version": F.lit("fused_gbm_v1")}
    )


def test_payload(spark, scored):
    rows = serving.latest_per_account(scored)
    got = json.loads(serving.payload_json(serving.lookup(rows, "ACC-100042")).first().payload)
    assert got == {
        "account_id": "ACC-100042", "txn_id": "TXN-DEMO-ATO", "score": 0.9,
        "reason_codes": ["new_device_recent", "geo_mismatch", "failed_logins_burst", "ato_signal"],
        "amount": 2318.47, "as_of": "2026-09-30T18:00:00.000Z", "model_version": "fused_gbm_v1",
        "recommended_action": "Hold + step-up authentication",
    }
    assert serving.lookup(rows, "nobody").count() == 0
    keys = spark.createDataFrame([("ACC-100042",), ("nobody",)], "account_id string")
    assert {r.account_id: r.txn_id for r in serving.lookup_many(rows, keys).collect()} == {
        "ACC-100042": "TXN-DEMO-ATO", "nobody": None,
    }


def test_serving_table_is_unique_and_newest(spark):
    df = spark.createDataFrame(
        [("A", "t1", 1, 0.1), ("A", "t3", 5, 0.3), ("A", "t2", 5, 0.2), ("B", "t4", 1, 0.4)],
        "account_id string, txn_id string, sec int, risk_score double",
    ).select(
        "account_id", "txn_id", "risk_score", F.lit("").alias("reason_codes"),
        F.lit(1.0).alias("amount"), F.timestamp_seconds("sec").alias("txn_ts"),
        F.lit("v").alias("model_version"),
    )
    path = scratch_path(spark, "serving")
    serving.write_serving(serving.latest_per_account(df), path)
    assert sorted(r.txn_id for r in serving.read_serving(spark, path).collect()) == ["t3", "t4"]


def test_gold_and_json_round_trip(spark, scored):
    gold, path = scored.select(*GOLD_COLUMNS), scratch_path(spark, "gold")
    sinks.write_gold(gold, path, csv_path=f"{path}-csv")
    back = read_table(spark, path).drop("txn_date")
    assert back.collect() == gold.collect()
    assert spark.read.option("header", True).csv(f"{path}-csv").columns == GOLD_COLUMNS
    sinks.write_json(gold, f"{path}-json")
    line = json.loads(spark.read.text(f"{path}-json").first().value)
    assert line["txn_id"] == "TXN-DEMO-ATO"
    array = json.loads(sinks.json_array(gold.select("txn_id"), 5).first().value)
    assert array == [{"txn_id": "TXN-DEMO-ATO"}]


def test_table_is_replaced(spark):
    path = scratch_path(spark, "table")
    for n in (3, 2):
        sinks.write_table(spark.range(n).toDF("n"), path)
    assert read_table(spark, path).count() == 2


def test_model_card_defaults(spark, scored):
    auc = spark.createDataFrame([(0.7,)], "roc_auc double")
    card = scoring.model_card(scored, "v1", {"amount": 0.8}, auc, "TXN-DEMO-ATO")
    row = card.first()
    assert row.features == FEATURES and row.demo_feature_values["failed_logins_1h"] == 4.0
    assert row.roc_auc == 0.7 and row.demo_risk_score == 0.9
    path = scratch_path(spark, "card")
    sinks.write_json(card.select("model_version", "roc_auc"), path)
    defaults = spark.createDataFrame(
        [("none", ["amount"], {"amount": 1.0}, 0.5, "t", "a", 0.1, {"amount": 2.0})], MODEL_CARD
    )
    read = sinks.read_model_card(spark, path, defaults).first()
    assert (read.model_version, read.roc_auc, read.demo_txn_id) == ("v1", 0.7, "t")
    assert read.feature_importances == {"amount": 1.0}


def test_generated_feeds(spark):
    feeds = synthetic.generate(spark, 300, 20_000, 20_000, seed=42)
    again = synthetic.generate(spark, 300, 20_000, 20_000, seed=42)
    assert feeds["txn"].exceptAll(again["txn"].repartition(3)).count() == 0
    path = scratch_path(spark, "landing")
    paths = synthetic.write_landing(feeds, path)
    silver = {
        n: apply_rules(to_silver(read_feed(spark, paths[n], RAW[n]), n), RULES[n]) for n in RAW
    }
    p = profile(silver["auth"], silver["txn"], silver["accounts"]).first()
    assert (p.accounts, p.auth_events, p.card_transactions) == (300, 20_000, 20_000)
    assert 0.03 < p.fraud_rate < 0.055
    assert 0.2 < p.false_positive_declines / p.declines < 0.95
    assert 0.008 < p.ato_logins / p.auth_events < 0.03
    rows = g.gold(silver["txn"], silver["auth"], silver["accounts"])
    demo_row = rows.where("account_id = 'ACC-100042'").collect()
    assert [r.reason_codes for r in demo_row] == [
        "new_device_recent,geo_mismatch,failed_logins_burst,ato_signal"
    ]
    median = silver["txn"].selectExpr("median(amount)").first()[0]
    assert 20 < median < 29  # exp(3.2) = 24.5, less the small test amounts
