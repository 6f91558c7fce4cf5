"""Every operator as a query over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import masks, risk
from .operators import asof, dedup, rolling
from .operators import select as sel
from .operators.contributors import top_contributors
from .operators.quality import RULES, apply_rules, flag_warnings, rule_report, to_silver
from .plans import cases as case_ops
from .plans import gold as gold_ops
from .plans import gold_store, governance, kpis, questions, scoring
from .schemas import GOLD_COLUMNS, TXN_RAW
from .session import configure, enable_checkpoints, scratch_path
from .sources import driver_tables as tables
from .sources import feeds as feed_io
from .sources import serving, sinks, versioned
from .sources.driver_tables import Feeds, load_feeds
from .streaming import asof_stream, enrich, login_index, row_velocity, run, silver

Query = Callable[[SparkSession, str], DataFrame]

# The account that single-account queries ask for, and the score cut of the pilot.
ACCOUNT = 7
PILOT_THRESHOLD = 0.3

_QUERIES: dict[str, Query] = {}
_PLAIN: dict[str, Callable] = {}  # the functions as they are written below


def query(name: str) -> Callable[[Callable], Callable]:
    """Registers a function of (feeds) or (spark, folder) under a name."""

    def keep(fn: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            wants = fn.__code__.co_varnames[: fn.__code__.co_argcount]
            args = (load_feeds(spark, sf_dir),) if wants == ("f",) else (spark, sf_dir)
            return portable(fn(*args))

        _QUERIES[name] = run
        _PLAIN[name] = fn
        return fn

    return keep


def portable(df: DataFrame) -> DataFrame:
    """Zone-free times and comma-joined arrays, so that another engine can compare the rows."""

    def plain(field: T.StructField):
        col = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return col.cast("timestamp_ntz").alias(field.name)
        if isinstance(field.dataType, T.ArrayType):
            return F.concat_ws(",", col).alias(field.name)
        return col

    return df.select(*[plain(f) for f in df.schema.fields])


def _fused(f: Feeds) -> DataFrame:
    return gold_ops.fuse(f.txn, f.auth, f.accounts, f.split)


def _scored(f: Feeds) -> DataFrame:
    return scoring.rule_score(_fused(f))


def _cases(f: Feeds) -> DataFrame:
    return case_ops.build_cases(_scored(f))


def _first_txn(f: Feeds):
    return f.txn.agg(F.min("txn_id")).scalar()


# --- typed projection, rules, filters ------------------------------------------------


@query("p1_silver_auth")
def _(spark, sf_dir):
    return to_silver(tables.raw_auth(spark, sf_dir), "auth")


@query("p1_silver_txn")
def _(spark, sf_dir):
    return to_silver(tables.raw_txn(spark, sf_dir), "txn")


@query("p1_silver_accounts")
def _(spark, sf_dir):
    return to_silver(tables.raw_accounts(spark, sf_dir), "accounts")


@query("p2_drop_rules_txn")
def _(spark, sf_dir):
    return apply_rules(to_silver(tables.raw_txn(spark, sf_dir), "txn"), RULES["txn"])


@query("p2_drop_rules_accounts")
def _(spark, sf_dir):
    silver = to_silver(tables.raw_accounts(spark, sf_dir), "accounts")
    return apply_rules(silver, RULES["accounts"])


@query("p3_warn_rule")
def _(spark, sf_dir):
    silver = to_silver(tables.raw_auth(spark, sf_dir), "auth")
    flagged = flag_warnings(apply_rules(silver, RULES["auth"]), RULES["auth"])
    return flagged.groupBy("violates_ts_present").agg(F.count("*").alias("n"))


@query("p4_rule_report")
def _(spark, sf_dir):
    reports = [
        rule_report(to_silver(raw, feed), feed, RULES[feed])
        for feed, raw in [
            ("auth", tables.raw_auth(spark, sf_dir)),
            ("txn", tables.raw_txn(spark, sf_dir)),
            ("accounts", tables.raw_accounts(spark, sf_dir)),
        ]
    ]
    return reports[0].unionByName(reports[1]).unionByName(reports[2])


@query("p5_filter_account")
def _(f):
    mine = sel.filter_key(f.txn, "account_id", ACCOUNT)
    return mine.select("txn_id", "account_id", "txn_ts", "amount")


@query("p6_nonempty_codes")
def _(f):
    return sel.nonempty_codes(_fused(f)).select("txn_id", "reason_codes")


@query("p7_code_membership")
def _(f):
    return sel.with_code(_fused(f), risk.ATO_SIGNAL).select("txn_id", "reason_codes")


@query("p8_p9_pruned_renamed")
def _(f):
    return sel.select_as(
        _fused(f),
        {"transaction": "txn_id", "failed_logins": "failed_logins_1h", "home": "home_geo"},
    )


# --- deduplication -------------------------------------------------------------------


@query("u1_dedup_txn")
def _(f):
    again = f.txn.withColumns({
        "txn_ts": F.col("txn_ts") + F.expr("INTERVAL 1 SECOND"), "amount": F.col("amount") + 1
    })
    return gold_ops.dedup_txn(f.txn.unionByName(again)).select(
        "txn_id", "account_id", "txn_ts", "amount"
    )


@query("u1_dedup_auth")
def _(f):
    again = f.auth.withColumn("event_id", F.col("event_id") + 1_000_000_000)
    return gold_ops.dedup_auth(f.auth.unionByName(again)).select(
        "event_id", "account_id", "event_ts", "ato_label"
    )


@query("u2_dedup_accounts")
def _(f):
    again = f.accounts.withColumns({
        "open_date": F.date_add("open_date", 30), "segment": F.lower("segment")
    })
    return gold_ops.dedup_accounts(f.accounts.unionByName(again)).select(
        "account_id", "open_date", "segment"
    )


@query("u3_named_then_earliest")
def _(f):
    return case_ops.queue_from_table(_scored(f), _first_txn(f), 8).select(
        "txn_id", "account_id", "txn_ts", "risk_score", "reason_codes"
    )


# --- joins ---------------------------------------------------------------------------


@query("j1_asof_fuse")
def _(f):
    return _fused(f).select(*GOLD_COLUMNS)


@query("j1_since_new_device")
def _(f):
    return gold_ops.since_new_device(f.txn, f.auth, split=f.split).select(
        "txn_id", "new_device_ts", "minutes_since_last_new_device"
    )


@query("j1_asof_tolerance")
def _(f):
    return gold_ops.since_new_device(f.txn, f.auth, 7200, f.split).select(
        "txn_id", "minutes_since_last_new_device"
    )


@query("j2_latest_join")
def _(f):
    return gold_ops.fuse_latest(f.txn, f.auth, f.accounts, f.split).select(
        "txn_id", "last_auth_ts", "minutes_since_new_device_login", "geo_mismatch_flag",
        "reason_codes",
    )


@query("j3_enrich_accounts")
def _(f):
    return gold_ops.enrich_accounts(f.txn, f.accounts, f.split).select(
        "txn_id", "home_geo", "segment", "credit_limit"
    )


@query("j4_gold_with_cases")
def _(f):
    return gold_ops.join_cases(_fused(f), _cases(f)).select(
        "txn_id", "reason_codes", "reason_narrative"
    )


@query("j7_login_then_spend")
def _(f):
    logins = f.auth.where("device_is_new = 1").select("event_id", "account_id", "event_ts")
    return asof.followed_by(logins, f.txn.where("amount >= 60"), 7200, f.split)


@query("j8_lookup")
def _(f):
    return serving.lookup(serving.latest_per_account(_scored(f)), ACCOUNT)


@query("j8_lookup_many")
def _(f):
    return serving.lookup_many(serving.latest_per_account(_scored(f)), f.accounts).select(
        "account_id", "txn_id", "risk_score", "reason_codes"
    )


# --- features ------------------------------------------------------------------------


@query("f1_minutes_since")
def _(f):
    return _fused(f).select("txn_id", "last_auth_ts", "minutes_since_new_device_login")


@query("f2_geo_mismatch")
def _(f):
    return _fused(f).select("txn_id", "ip_geo", "home_geo", "geo_mismatch_flag")


@query("f3_null_safe_counts")
def _(f):
    return _fused(f).select("txn_id", "failed_logins_1h", "recent_ato_label", "device_is_new")


@query("f4_reason_codes")
def _(f):
    return _fused(f).select("txn_id", "reason_codes", F.size("codes").alias("n_codes"))


@query("f5_split_codes")
def _(f):
    parts = risk.split_codes()
    return _fused(f).select(
        "txn_id", F.size(parts).alias("n_codes"), F.try_element_at(parts, F.lit(1)).alias("first_code")
    )


@query("f6_f7_login_labels")
def _(f):
    return f.auth.select("event_id", "ip_geo", "geo_is_new", "ato_label")


@query("f8_txn_velocity")
def _(f):
    return rolling.txn_velocity(f.txn, split=f.split).select("txn_id", "txn_velocity_1h")


@query("f9_amount_vs_avg")
def _(f):
    return rolling.amount_vs_avg(f.txn, split=f.split).select("txn_id", "amount_vs_30d_avg")


@query("f9_w3_gold_tiles")
def _(spark, sf_dir):
    f, path = load_feeds(spark, sf_dir), scratch_path(spark, "gold-store")
    gold_store.write_days(gold_ops.gold(f.txn, f.auth, f.accounts, f.split), path)
    return gold_store.features(spark, path)


@query("f10_card_test_burst")
def _(f):
    out = rolling.card_test_burst(f.txn, seconds=86_400, split=f.split)
    return out.select("txn_id", "small_txns_1h", "card_test_burst")


@query("f8_f9_f10_spend_features")
def _(f):
    return rolling.spend_features(f.txn, f.split).select(
        "txn_id", "txn_velocity_1h", "small_txns_1h", "amount_vs_30d_avg"
    )


@query("f11_geo_impossible")
def _(f):
    return rolling.geo_impossible(f.auth, split=f.split).select(
        "event_id", "account_id", "prev_event_id", "prev_geo", "ip_geo", "gap_minutes"
    )


@query("f12_failed_attempts")
def _(f):
    out = rolling.failed_attempts(f.auth, seconds=86_400, split=f.split)
    return out.select("event_id", "failed_in_span")


@query("f13_tokenize")
def _(f):
    return masks.tokenize(f.accounts.select("account_id"), "account_id", salt=42)


@query("f14_actions")
def _(f):
    return risk.recommended_action(_scored(f)).select(
        "txn_id", "risk_score", "recommended_action", "action_rationale"
    )


# --- KPIs ----------------------------------------------------------------------------


@query("a1_profile")
def _(f):
    return kpis.profile(f.auth, f.txn, f.accounts)


@query("a2_row_counts")
def _(f):
    return kpis.row_counts({"gold": _fused(f), "auth": f.auth, "accounts": f.accounts})


@query("a3_label_counts")
def _(f):
    return kpis.label_counts(_fused(f))


@query("a4_latest_per_account")
def _(f):
    return serving.latest_per_account(_scored(f))


@query("a5_fp_decline_rate")
def _(f):
    return kpis.fp_decline_rate(_fused(f), ["segment"])


@query("a6_shared_devices")
def _(f):
    return kpis.shared_devices(f.auth, today_only=False)


@query("a7_net_fraud_loss")
def _(f):
    return kpis.net_fraud_loss(_fused(f), ["segment"])


@query("a8_loss_bps")
def _(f):
    return kpis.loss_bps(f.txn, ["channel"])


@query("a9_false_declines_per_fraud")
def _(f):
    return kpis.false_declines_per_fraud(f.txn)


@query("a10_mean_time_to_detect")
def _(f):
    return kpis.mttd(_fused(f), f.auth)


@query("a11_travel_fp_rate")
def _(f):
    return kpis.travel_fp_rate(f.txn, tables.TRAVEL_MCC)


@query("a12_weekly_loss_avoided")
def _(f):
    return kpis.weekly_loss_avoided(f.txn)


@query("a13_daily_loss_and_fp")
def _(f):
    return kpis.daily_loss_and_fp(f.txn)


@query("a14_device_then_spend_trend")
def _(f):
    return kpis.device_then_spend_trend(f.auth, f.txn, split=f.split)


@query("a15_ato_declines_by_region")
def _(f):
    return kpis.ato_declines_by_region(
        _fused(f), hours=24 * 14, linked=risk.has_ato_signal(), clock=f.txn
    )


@query("a16_avg_by_segment")
def _(f):
    return kpis.avg_by_segment(_fused(f), "minutes_since_new_device_login")


@query("a17_shadow_eval")
def _(f):
    return kpis.shadow_eval(_scored(f), PILOT_THRESHOLD)


@query("a17_threshold_sweep")
def _(f):
    return kpis.threshold_sweep(_scored(f), [0.2, 0.3, 0.4, 0.5, 0.8])


@query("a21_code_frequency")
def _(f):
    return kpis.code_frequency(_fused(f))


# --- ordered reports -----------------------------------------------------------------


@query("t1_case_queue")
def _(f):
    return case_ops.case_queue(_scored(f), _cases(f), _first_txn(f)).select(
        "txn_id", "account_id", "risk_score", "reason_codes", "reason_narrative"
    )


@query("t2_flagged")
def _(f):
    return case_ops.flagged(_scored(f), 10, ACCOUNT).select(
        "txn_id", "account_id", "risk_score", "reason_codes"
    )


@query("t4_head_by_time")
def _(f):
    return case_ops.head_by_time(sel.with_code(_fused(f), risk.ATO_SIGNAL), 8).select(
        "txn_id", "txn_ts", "reason_codes"
    )


@query("t5_top_risk_approved")
def _(f):
    return case_ops.top_risk_approved(_scored(f), _cases(f)).select(
        "txn_id", "risk_score", "amount", "reason_narrative"
    )


@query("t6_top_contributors")
def _(f):
    return top_contributors(_fused(f))


# --- governance ----------------------------------------------------------------------


@query("g1_g2_masks")
def _(f):
    return governance.apply_policy(f.accounts, "accounts", governance.SHARED).select(
        "account_id", "email", "pan_token"
    )


@query("g4_division_cyber")
def _(f):
    return governance.division_view(_scored(f), governance.CYBER)


@query("g4_division_credit")
def _(f):
    return governance.division_view(_scored(f), governance.CREDIT)


@query("g4_division_shared")
def _(f):
    return governance.division_view(_scored(f), governance.SHARED)


@query("g5_row_filter")
def _(f):
    rows = governance.row_filter(_scored(f), "reason_codes <> ''")
    return governance.division_view(rows, governance.SHARED)


# --- model ---------------------------------------------------------------------------


@query("m1_feature_frame")
def _(f):
    return scoring.assemble(_fused(f)).select("txn_id", *scoring.FEATURES)


@query("m2_split_exact")
def _(f):
    return scoring.stratified_split(_fused(f)).select("txn_id", "fraud_label", "split")


@query("m2_split_hash")
def _(f):
    return scoring.stratified_split(_fused(f), exact=False).select(
        "txn_id", "fraud_label", "split"
    )


@query("m6_roc_auc")
def _(f):
    return scoring.roc_auc(_scored(f))


@query("m7_precision_recall")
def _(f):
    return scoring.precision_recall(_scored(f), PILOT_THRESHOLD)


@query("m8_confusion")
def _(f):
    return scoring.confusion(_scored(f), PILOT_THRESHOLD)


@query("m10_psi")
def _(f):
    newest = f.txn.agg(F.max(F.unix_micros("txn_ts"))).scalar()
    two_weeks = F.lit(14 * 86_400 * 1_000_000)
    return scoring.psi(_fused(f), F.unix_micros("txn_ts") > newest - two_weeks)


@query("m11_rule_score")
def _(f):
    return _scored(f).select("txn_id", "risk_score", "model_version")


# --- narratives, questions, payload --------------------------------------------------


@query("n1_narratives")
def _(f):
    return case_ops.add_narrative(_scored(f)).select("txn_id", "reason_narrative")


@query("n2_n3_case_table")
def _(f):
    return _cases(f)


@query("n4_q0_cases_of_account")
def _(f):
    return questions.q0_cases_of_account(_scored(f), _cases(f), ACCOUNT).select(
        "txn_id", "account_id", "amount", "reason_codes", "reason_narrative", "decision"
    )


@query("n4_q1_ato_declines_by_region")
def _(f):
    return questions.q1_ato_declines_by_region(_fused(f), clock=f.txn)


@query("n4_q2_shared_devices")
def _(f):
    return questions.q2_shared_devices(f.auth)


@query("n4_q3_device_then_spend")
def _(f):
    return questions.q3_device_then_spend(f.auth, f.txn, split=f.split)


@query("n4_q4_travel_fp_rate")
def _(f):
    return questions.q4_travel_fp_rate(f.txn, tables.TRAVEL_MCC)


@query("n4_q5_top_risk_approved")
def _(f):
    return questions.q5_top_risk_approved(_scored(f), _cases(f)).select(
        "txn_id", "account_id", "risk_score", "reason_narrative"
    )


@query("n4_q6_loss_avoided")
def _(f):
    return questions.q6_loss_avoided(f.txn)


@query("n4_q7_latency_by_segment")
def _(f):
    return questions.q7_latency_by_segment(_fused(f), "minutes_since_new_device_login")


@query("n4_q8_loss_and_fp")
def _(f):
    return questions.q8_loss_and_fp(f.txn)


@query("n5_payload")
def _(f):
    return serving.payload_columns(serving.latest_per_account(_scored(f)))


# --- sources and sinks: write, read back ---------------------------------------------


@query("s1_csv_feed")
def _(spark, sf_dir):
    path = scratch_path(spark, "landing")
    tables.raw_txn(spark, sf_dir).write.option("header", True).csv(path)
    landed = feed_io.read_feed(spark, path, TXN_RAW)
    return apply_rules(to_silver(landed, "txn"), RULES["txn"])


@query("s4_gold_sink")
def _(spark, sf_dir):
    f, path = load_feeds(spark, sf_dir), scratch_path(spark, "gold")
    sinks.write_gold(_fused(f).select(*GOLD_COLUMNS), path)
    return feed_io.read_table(spark, path).drop("txn_date")


@query("s5_serving_sink")
def _(spark, sf_dir):
    f, path = load_feeds(spark, sf_dir), scratch_path(spark, "serving")
    versioned.publish(_scored(f), path)
    return versioned.read(spark, path)


@query("s6_case_table_sink")
def _(spark, sf_dir):
    f, path = load_feeds(spark, sf_dir), scratch_path(spark, "cases")
    sinks.write_table(_cases(f), path)
    return feed_io.read_table(spark, path)


@query("s8_json_export")
def _(spark, sf_dir):
    f, path = load_feeds(spark, sf_dir), scratch_path(spark, "export")
    rows = _scored(f).select("txn_id", "account_id", "amount", "risk_score", "reason_codes")
    sinks.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


# --- trained model -------------------------------------------------------------------


def _trained(spark: SparkSession, sf_dir: str):
    """Stored gold, and a model fitted to its training rows."""
    enable_checkpoints(spark)
    f, path = load_feeds(spark, sf_dir), scratch_path(spark, "features")
    rows = _fused(f).select(*GOLD_COLUMNS)
    scoring.stratified_split(rows, exact=False).write.parquet(path)
    stored = spark.read.parquet(path)
    return stored, scoring.train_gbt(stored.where("split = 'train'"))


@query("m3_m4_gbt_scores")
def _(spark, sf_dir):
    stored, model = _trained(spark, sf_dir)
    return scoring.score(model, stored.drop("split")).select(
        "txn_id", "fraud_label", "risk_score", "model_version"
    )


@query("m5_m9_model_card")
def _(spark, sf_dir):
    stored, model = _trained(spark, sf_dir)
    scored = scoring.score(model, stored)
    auc = scoring.roc_auc(scored.where("split = 'test'"))
    first = stored.agg(F.min("txn_id")).scalar()
    card = scoring.model_card(
        scored, scoring.MODEL_VERSION, scoring.importances(model), auc, first
    )
    return card.select(
        "model_version", F.array_join("features", ",").alias("features"),
        F.to_json("feature_importances").alias("feature_importances"), "roc_auc",
        "demo_txn_id", "demo_risk_score",
    )


# --- the same queries with busy accounts cut into many slices, as on a large cluster -----

SLICED = ("j1_asof_fuse", "j7_login_then_spend", "f9_amount_vs_avg", "f11_geo_impossible")


def _register_sliced(name: str, plain: Callable) -> None:
    @query(f"{name}_sliced")
    def _(spark, sf_dir):
        return plain(load_feeds(spark, sf_dir, hot_rows=40, slice_rows=8))


for _name in SLICED:
    _register_sliced(_name, _PLAIN[_name])


# --- streams: run over what is there, then read the result ---------------------------


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A stream source wants a folder or a pattern, also for a table of one file.
    return spark.readStream.schema(tables.EVENTS).parquet(f"{sf_dir}/events.parquet*")


@query("st2_silver_stream")
def _(spark, sf_dir):
    root = scratch_path(spark, "silver")
    stream = silver.silver_stream(
        tables.raw_txn_from(_event_stream(spark, sf_dir)), "txn", "txn_rules"
    )
    run.start(stream, f"{root}/data", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/data")


@query("u4_dedup_stream")
def _(spark, sf_dir):
    root = scratch_path(spark, "dedup")
    events = _event_stream(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    twice = events.unionByName(events).select("event_id", "ts", "user_id")
    stream = dedup.dedup_stream(twice, "event_id", "ts", "1 hour")
    run.start(stream, f"{root}/data", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/data")


@query("j5_st3_stream_enrich")
def _(spark, sf_dir):
    root = scratch_path(spark, "enrich")
    logins = tables.label_logins(tables.auth_from(_event_stream(spark, sf_dir)), tables.accounts(spark, sf_dir))
    login_index.start_index(logins, f"{root}/index", f"{root}/logins-checkpoint").awaitTermination()
    enrich.start_enrich(
        tables.txn_from(_event_stream(spark, sf_dir)),
        lambda batch: login_index.logins_for(batch, f"{root}/index"),
        lambda s: tables.accounts(s, sf_dir),
        f"{root}/data", f"{root}/checkpoint",
    ).awaitTermination()
    return run.read_batches(spark, f"{root}/data")


@query("j6_st5_stream_asof")
def _(spark, sf_dir):
    asof_stream.use_rocksdb(spark)
    root = scratch_path(spark, "asof")
    accts = tables.accounts(spark, sf_dir)
    logins = tables.auth_from(_event_stream(spark, sf_dir))
    stream = asof_stream.fuse_stream(
        tables.txn_from(_event_stream(spark, sf_dir)).select("txn_id", "account_id", "txn_ts"),
        tables.label_logins(logins, accts),
    )
    run.start(stream, f"{root}/data", f"{root}/checkpoint").awaitTermination()
    return asof_stream.settled(spark.read.schema(stream.schema).parquet(f"{root}/data"))


@query("st6_velocity_stream")
def _(spark, sf_dir):
    root = scratch_path(spark, "velocity")
    stream = silver.velocity_stream(tables.txn_from(_event_stream(spark, sf_dir)))
    run.start(stream, f"{root}/data", f"{root}/checkpoint").awaitTermination()
    closed = spark.read.schema(stream.schema).parquet(f"{root}/data")
    return silver.with_open_windows(closed, load_feeds(spark, sf_dir).txn)


@query("st6_velocity_per_row")
def _(spark, sf_dir):
    asof_stream.use_rocksdb(spark)
    root = scratch_path(spark, "row-velocity")
    txn = tables.txn_from(_event_stream(spark, sf_dir)).select("txn_id", "account_id", "txn_ts")
    stream = row_velocity.velocity_per_row(txn)
    run.start(stream, f"{root}/data", f"{root}/checkpoint").awaitTermination()
    told = spark.read.schema(stream.schema).parquet(f"{root}/data")
    return row_velocity.settled(told).select("txn_id", "txn_velocity_1h")


@query("st7_serving_upsert")
def _(spark, sf_dir):
    root = scratch_path(spark, "upsert")

    def handle(batch: DataFrame, batch_id: int) -> None:
        # Three upserts of a micro-batch, two of them folded: readers see base and open batch.
        f, held, parts = load_feeds(batch.sparkSession, sf_dir), batch.persist(), 3
        try:
            scored = scoring.rule_score(enrich.fuse_microbatch(held, f.auth, f.accounts))
            for part in range(parts):
                own = scored.where(F.pmod(F.xxhash64("txn_id"), F.lit(parts)) == part)
                versioned.upsert(own, batch_id * parts + part, root)
                if part < parts - 1:
                    versioned.compact(batch.sparkSession, root)
        finally:
            held.unpersist()

    run.start_batches(
        tables.txn_from(_event_stream(spark, sf_dir)), handle, f"{root}/checkpoint"
    ).awaitTermination()
    return versioned.read(spark, root)


def queries() -> dict[str, Query]:
    """All registered queries."""
    return dict(_QUERIES)
