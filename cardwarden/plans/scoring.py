"""Train, score and evaluate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.risk import split_codes
from ..schemas import FEATURES, MODEL_CARD
from ..session import enable_checkpoints

MODEL_VERSION = "fused_gbm_v1"
RULE_VERSION = "rule_points_v1"
LABEL_FEATURES = ["recent_ato_label"]

# Points per fired code for the rule score, on a scale of 100.
RULE_POINTS = {
    "new_device_recent": 35,
    "geo_mismatch": 15,
    "failed_logins_burst": 20,
    "ato_signal": 25,
}
BASE_POINTS = 5
MAX_AMOUNT_POINTS = 20
AMOUNT_PER_POINT = 25

_SPLIT_DIGITS = 4  # hex digits, so 65,536 hash buckets per class


def assemble(df: DataFrame, null_fill: float = 0.0, has_login_flag: bool = False) -> DataFrame:
    """The model's columns as doubles, nulls filled. A filled 0 reads as "just logged in";
    ``has_login_flag`` adds a column that tells the two apart."""
    known = F.col("minutes_since_new_device_login").isNotNull().cast("double")
    if has_login_flag:
        df = df.withColumn("has_login", known)
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.lit(float(null_fill))) for c in FEATURES
    })


def _hash_order(seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.col("txn_id").cast("string"), F.lit(str(seed))))


def stratified_split(
    df: DataFrame, label: str = "fraud_label", frac: float = 0.25, seed: int = 42,
    exact: bool = True, classes: Sequence[int] = (0, 1),
) -> DataFrame:
    """Adds ``split`` ('test'/'train'), stratified and repeatable.

    Exact: per class the ``round(frac * n)`` rows first in order of a salted hash
    are the test rows. A class is far too big for one task, so rows are ranked
    inside hash buckets and the bucket totals (at most 65,536 per class, hence
    safe to broadcast) give the rank of each bucket's first row. Otherwise a
    plain hash threshold: no shuffle, sizes right to within sampling noise. Rows
    without a label of ``classes`` stay, and their split is null.
    """
    hashed = df.withColumn("_h", _hash_order(seed))
    known = F.coalesce(F.col(label).isin(*classes), F.lit(False))
    if not exact:
        share = F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint") / F.lit(float(16**8))
        return hashed.withColumn(
            "split", F.when(known, F.when(share < frac, "test").otherwise("train"))
        ).drop("_h")
    hashed = hashed.withColumn("_b", F.substring("_h", 1, _SPLIT_DIGITS))
    by_class = Window.partitionBy(label)
    totals = (
        hashed.where(known).groupBy(label, "_b").agg(F.count("*").alias("_n"))
        .withColumn("_total", F.sum("_n").over(by_class))
        .withColumn("_upto", F.sum("_n").over(by_class.orderBy("_b")))
        .select(label, "_b", (F.col("_upto") - F.col("_n")).alias("_before"), "_total")
    )
    in_bucket = Window.partitionBy(label, "_b").orderBy("_h", "txn_id")
    rank = F.col("_before") + F.col("_rn")
    return (
        hashed.withColumn("_rn", F.row_number().over(in_bucket))
        .join(F.broadcast(totals), [label, "_b"], "left")
        .withColumn(
            "split",
            F.when(
                known, F.when(rank <= F.round(F.col("_total") * frac), "test").otherwise("train")
            ),
        )
        .drop("_h", "_b", "_rn", "_before", "_total")
    )


def train_gbt(
    df: DataFrame, max_iter: int = 100, max_depth: int = 3, step: float = 0.1, seed: int = 42,
    exclude_label_features: bool = False,
) -> PipelineModel:
    """Gradient-boosted trees on the gold features.

    ``recent_ato_label`` is a label as well as a feature; leave it out with
    ``exclude_label_features`` when the label is not known at scoring time.
    The training frame is read once per boosting round, so give a stored table.
    """
    columns = [c for c in FEATURES if not (exclude_label_features and c in LABEL_FEATURES)]
    return Pipeline(stages=[
        VectorAssembler(inputCols=columns, outputCol="features"),
        GBTClassifier(
            labelCol="fraud_label", featuresCol="features", maxIter=max_iter,
            maxDepth=max_depth, stepSize=step, seed=seed,
        ),
    ]).fit(assemble(df))


def score(model: PipelineModel, df: DataFrame, version: str = MODEL_VERSION) -> DataFrame:
    """Adds ``risk_score``, the rounded probability of fraud, and ``model_version``.

    The frame's own columns, nulls included, come out unchanged.
    """
    own = [F.col(f"_own_{c}").alias(c) if c in FEATURES else F.col(c) for c in df.columns]
    kept = df.withColumns({f"_own_{c}": F.col(c) for c in FEATURES})
    probability = vector_to_array("probability")[1]
    return model.transform(assemble(kept)).select(
        *own,
        F.round(probability, 4).alias("risk_score"),
        F.lit(version).alias("model_version"),
    )


def importances(model: PipelineModel) -> dict[str, float]:
    """Feature importances, rounded, heaviest first."""
    names = model.stages[0].getInputCols()
    weights = model.stages[-1].featureImportances.toArray()
    ranked = sorted(zip(names, weights), key=lambda x: -x[1])
    return {n: round(float(w), 4) for n, w in ranked}


def importance_rows(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """The importances as rows, ranked from 1."""
    rows = [(i + 1, n, w) for i, (n, w) in enumerate(importances(model).items())]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")


def rule_score(df: DataFrame, version: str = RULE_VERSION) -> DataFrame:
    """A model-free score: points per fired code plus points for the amount, capped at 1."""
    codes = F.col("codes") if "codes" in df.columns else split_codes()
    points = F.lit(BASE_POINTS) + F.least(
        F.lit(MAX_AMOUNT_POINTS), F.floor(F.col("amount") / AMOUNT_PER_POINT)
    )
    for code, weight in RULE_POINTS.items():
        points = points + F.when(F.array_contains(codes, code), weight).otherwise(0)
    return df.withColumn("risk_score", F.least(F.lit(100), points) / F.lit(100.0)).withColumn(
        "model_version", F.lit(version)
    )


def score_ranges(per_score: DataFrame) -> DataFrame:
    """Rows dealt out in ranges of ``_s`` that follow its distribution, numbered by ``_range`` and stored."""
    spark = per_score.sparkSession
    enable_checkpoints(spark)
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = per_score.repartitionByRange(ranges, "_s").withColumn("_range", F.spark_partition_id())
    return dealt.checkpoint()  # the ranges follow a sample, so they are settled once


def roc_auc(df: DataFrame, label: str = "fraud_label", score_col: str = "risk_score") -> DataFrame:
    """Exact area under the ROC curve of the unrounded score, ties counted half.

    Rows are first counted per score value. The values are dealt out in ranges that hold
    about as many values each, however the scores are distributed; each range orders its
    own, and one small ordered pass over the ranges adds what lies below each.
    """
    wide = "decimal(19,0)"
    per_score = score_ranges(df.groupBy(F.col(score_col).alias("_s")).agg(
        F.count_if(F.col(label) == 1).cast("decimal(18,0)").alias("pos"),
        F.count_if(F.col(label) == 0).cast(wide).alias("neg"),
    ))
    below = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = per_score.groupBy("_range").agg(F.sum("neg").alias("_all")).select(
        "_range", F.coalesce(F.sum("_all").over(below), F.lit(0)).alias("_below")
    )
    inside = Window.partitionBy("_range").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.coalesce(F.sum("neg").over(inside), F.lit(0)) + F.col("_below")
    won = F.col("pos") * (2 * lower + F.col("neg")).cast(wide)
    pairs = per_score.join(ranges, "_range").withColumn("_won", won).agg(
        F.sum("_won").cast("double").alias("won"),
        F.sum("pos").cast("bigint").alias("n_pos"),
        F.sum("neg").cast("bigint").alias("n_neg"),
    )
    total = 2.0 * F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return pairs.select(
        "n_pos", "n_neg", F.round(F.try_divide(F.col("won"), total), 6).alias("roc_auc")
    )


def _cells(df: DataFrame, threshold: float, label: str, score_col: str) -> DataFrame:
    hit = F.coalesce(F.col(score_col) >= threshold, F.lit(False))
    real = F.col(label) == 1
    return df.where(F.col(label).isin(0, 1)).agg(
        F.count_if(~real & ~hit).alias("tn"), F.count_if(~real & hit).alias("fp"),
        F.count_if(real & ~hit).alias("fn"), F.count_if(real & hit).alias("tp"),
    )


def precision_recall(
    df: DataFrame, threshold: float = 0.5, label: str = "fraud_label",
    score_col: str = "risk_score",
) -> DataFrame:
    """Precision and recall at a threshold; 0 where there is nothing to divide by."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return _cells(df, threshold, label, score_col).select(
        F.lit(threshold).cast("double").alias("threshold"),
        F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0)).alias("recall"),
    )


def confusion(
    df: DataFrame, threshold: float = 0.5, label: str = "fraud_label",
    score_col: str = "risk_score",
) -> DataFrame:
    """The confusion matrix as four rows, empty cells included."""
    cells = F.array(*[
        F.struct(F.lit(y).alias("label"), F.lit(p).alias("predicted"), F.col(c).alias("n"))
        for y, p, c in [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    ])
    return _cells(df, threshold, label, score_col).select(F.inline(cells))


def model_card(
    scored: DataFrame, version: str, weights: dict[str, float], auc: DataFrame, demo_txn
) -> DataFrame:
    """One row: version, features, importances, AUC, and one transaction's score and values.

    Without that transaction its fields are null; the card has its row all the same.
    """
    values = F.create_map(*[
        x for c in FEATURES for x in (F.lit(c), F.col(c).cast("double"))
    ])
    card = scored.sparkSession.range(1).select(
        F.lit(version).alias("model_version"),
        F.array(*[F.lit(c) for c in FEATURES]).alias("features"),
        F.create_map(*[
            x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))
        ]).alias("feature_importances"),
    )
    shown = scored.where(F.col("txn_id") == F.lit(demo_txn)).select(
        F.col("txn_id").cast("string").alias("demo_txn_id"),
        F.col("account_id").cast("string").alias("demo_account_id"),
        F.col("risk_score").alias("demo_risk_score"),
        values.alias("demo_feature_values"),
    )
    return card.join(shown, F.lit(True), "left").withColumn("roc_auc", auc.select("roc_auc").scalar()).select(
        *MODEL_CARD.fieldNames()
    )


# Bin edges per feature; a value belongs to the bin of the last edge at or below it.
PSI_EDGES = {
    "amount": [10, 25, 50, 100, 150, 250],
    "minutes_since_new_device_login": [15, 60, 240, 1440, 4320],
    "geo_mismatch_flag": [1],
    "failed_logins_1h": [1, 3, 5],
    "recent_ato_label": [1],
    "device_is_new": [1],
}


def psi(
    df: DataFrame, is_current: Column, edges: dict[str, list[float]] | None = None,
    smooth: float = 0.5,
) -> DataFrame:
    """Population stability index per feature between the base rows and the current rows.

    One pass: every row adds one count per feature, combined before the shuffle.
    A missing value has a bin of its own (-1); ``smooth`` is added to each count, and a
    bin that is empty on both sides counts like any other.
    """
    edges = edges or PSI_EDGES
    bins, bin_counts = [], F.lit(0)
    for name, cuts in edges.items():
        number = F.lit(0)
        for cut in cuts:
            number = number + (F.col(name) >= cut).cast("int")
        bins.append(F.struct(
            F.lit(name).alias("feature"), F.coalesce(number, F.lit(-1)).alias("bin")
        ))
        bin_counts = F.when(F.col("feature") == name, len(cuts) + 2).otherwise(bin_counts)
    counts = (
        df.select(is_current.alias("_cur"), F.explode(F.array(*bins)).alias("_f"))
        .groupBy("_f.feature", "_f.bin")
        .agg(
            F.count_if(~F.col("_cur")).alias("n_base"), F.count_if(F.col("_cur")).alias("n_cur")
        )
    )
    zero = F.lit(0).cast("long")
    every = df.sparkSession.createDataFrame(
        [(name, b) for name, cuts in edges.items() for b in range(-1, len(cuts) + 1)], "feature string, bin int"
    ).withColumns({"n_base": zero, "n_cur": zero})
    counts = counts.unionByName(every).groupBy("feature", "bin").agg(
        F.sum("n_base").alias("n_base"), F.sum("n_cur").alias("n_cur")
    )
    whole = Window.partitionBy("feature")
    share = {
        side: (F.col(f"n_{side}") + smooth)
        / (F.sum(f"n_{side}").over(whole) + smooth * bin_counts)
        for side in ("base", "cur")
    }
    part = (F.col("p_cur") - F.col("p_base")) * F.log(F.col("p_cur") / F.col("p_base"))
    return (
        counts.withColumns({"p_base": share["base"], "p_cur": share["cur"]})
        .groupBy("feature")
        .agg(
            F.sum("n_base").alias("n_base"), F.sum("n_cur").alias("n_current"),
            F.round(F.sum(part), 6).alias("psi"),
        )
    )
