"""Columns by header, total orders, thresholds, cards, weeks, and complete streams."""

import json

import pytest
from pyspark.sql import functions as F

from cardwarden.operators.contributors import top_contributors
from cardwarden.operators.dedup import dedup_latest
from cardwarden.operators.rolling import Rolling, rolling_sums
from cardwarden.operators.slices import split_hot_keys
from cardwarden.plans import kpis, scoring
from cardwarden.schemas import MODEL_CARD, RAW
from cardwarden.sources import feeds, sinks


def test_csv_columns_are_found_by_name(spark, tmp_path):
    folder = tmp_path / "txn"
    folder.mkdir()
    (folder / "a.csv").write_text("account_id,extra,txn_id,amount\nA1,zz,T1,5\n")
    row = feeds.read_feed(spark, str(folder), RAW["txn"]).collect()[0]
    assert (row.txn_id, row.account_id, row.amount, row.mcc) == ("T1", "A1", "5", None)
    stream = feeds.stream_feed(spark, str(folder), RAW["txn"])
    query = stream.writeStream.format("memory").queryName("by_name").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("by_name").collect() == [row]
    (folder / "b.csv").write_text("txn_id,account_id,extra,amount\nT2,A2,y,6\n")
    with pytest.raises(Exception, match="(?i)header|read"):
        feeds.read_feed(spark, str(folder), RAW["txn"]).collect()


def test_the_survivor_does_not_depend_on_input_order(spark):
    rows = [(1, 5, "mass", 2.0), (1, 5, "premium", 1.0), (1, 4, "z", 9.0)]
    kept = {
        tuple(dedup_latest(spark.createDataFrame(r, "k int, t int, s string, x double"), ["k"], ["t"]).first())
        for r in (rows, rows[::-1])
    }
    assert kept == {(1, 5, "premium", 1.0)}


@pytest.mark.parametrize("exact", [True, False])
def test_unlabelled_rows_stay_in_both_splits(spark, exact):
    df = spark.createDataFrame([(f"t{i}", i % 3 if i % 3 < 2 else None) for i in range(60)], "txn_id string, fraud_label int")
    out = scoring.stratified_split(df, exact=exact)
    assert out.count() == 60
    assert out.where("fraud_label IS NULL AND split IS NULL").count() == 20
    assert out.where("fraud_label IS NOT NULL AND split IS NULL").count() == 0


def test_sweep_and_shadow_agree_beside_a_threshold(spark):
    rows = [(s, "approve", f, 10.0, sc) for s in ("a", "b") for f in (0, 1) for sc in (0.29996, 0.3, 0.300001, None, 0.9)]
    df = spark.createDataFrame(rows, "segment string, decision string, fraud_label int, amount double, risk_score double")
    swept = kpis.threshold_sweep(df, [0.9, 0.3])
    for t in (0.3, 0.9):
        one = kpis.shadow_eval(df, t).orderBy("segment").collect()
        many = swept.where(F.col("threshold") == t).drop("threshold").orderBy("segment").collect()
        assert [r.asDict() for r in one] == [r.asDict() for r in many]


def test_auc_of_unrounded_scores(spark):
    pos, neg = [0.30001, 0.30003, 0.9], [0.30002, 0.3, 0.30001]
    df = spark.createDataFrame([(1, s) for s in pos] + [(0, s) for s in neg], "fraud_label int, risk_score double")
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / 9
    assert scoring.roc_auc(df).first().roc_auc == pytest.approx(won, abs=1e-6)


def test_model_card_is_read_as_people_write_it(spark, tmp_path):
    defaults = spark.createDataFrame(
        [tuple(None for _ in MODEL_CARD.fields)], MODEL_CARD
    ).withColumn("model_version", F.lit("none"))
    card = tmp_path / "card.json"
    card.write_text(json.dumps({"model_version": "v9", "roc_auc": 0.75}, indent=2))
    assert sinks.read_model_card(spark, str(card), defaults).first().model_version == "v9"
    card.write_text("{ not json")
    assert sinks.read_model_card(spark, str(card), defaults).first().model_version == "none"
    assert sinks.read_model_card(spark, str(tmp_path / "absent"), defaults).first().model_version == "none"


def test_week_before_is_the_calendar_week(spark):
    days = ["2024-01-01", "2024-01-09", "2024-01-30"]
    df = spark.createDataFrame([(d, "decline", 1, 5.0) for d in days], "d string, decision string, fraud_label int, amount double")
    rows = kpis.weekly_loss_avoided(df.withColumn("txn_ts", F.to_timestamp("d"))).orderBy("week").collect()
    assert [r.loss_avoided_prev_week for r in rows] == [None, 5.0, None]


def test_a_feature_the_frame_lacks_does_not_fire(spark):
    df = spark.createDataFrame([("t", "a", 5.0)], "txn_id string, account_id string, amount double")
    rows = top_contributors(df, n=6).collect()
    assert {r.feature: r.fired for r in rows if r.fired == "Yes"} == {"amount": "Yes"} and len(rows) == 6


def test_time_filters_reach_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select(F.timestamp_micros(F.col("id") * 3_600_000_000).alias("txn_ts")).write.parquet(path)
    df = spark.read.parquet(path)
    assert kpis.within_last(df, "txn_ts", 3 * 3600).count() == 3
    assert kpis.on_last_day(df, "txn_ts").count() == 4
    plan = kpis.within_last(df, "txn_ts", 60)._jdf.queryExecution().executedPlan().toString()
    assert "unix_micros" not in plan.split("Subquery")[0] and "txn_ts" in plan


def test_sums_of_a_cut_key_whose_values_never_leave(spark):
    df = spark.range(2000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id") * 60).alias("ts"), F.lit(1).alias("v"))
    split = split_hot_keys([(df, "ts")], "k", hot_rows=100, slice_rows=100)
    out = rolling_sums(df, "k", "ts", [Rolling("n", F.col("v"), 30 * 86400)], split)
    assert sorted(r.n for r in out.collect()) == list(range(1, 2001))
