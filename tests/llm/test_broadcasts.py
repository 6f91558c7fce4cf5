"""What Spark broadcasts by its own estimate stays within the limit it was given."""

import random
import string
from contextlib import contextmanager

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from cardwarden.llm import components, frames, simhash, suffixes


def broadcasts(plan) -> list[tuple[int, str]]:
    """The rows of every broadcast in a plan that has run, and the names of its columns."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return broadcasts(plan.executedPlan())
    if "QueryStage" in name:
        return broadcasts(plan.plan())
    own = []
    if name.startswith("BroadcastExchange"):
        own = [(plan.metrics().apply("numOutputRows").value(), plan.output().toString())]
    below = plan.children()
    return own + [x for i in range(below.size()) for x in broadcasts(below.apply(i))]


def broadcast_by(df) -> list[tuple[int, str]]:
    """As ``broadcasts``, of a query that has run."""
    return broadcasts(df._jdf.queryExecution().executedPlan())


def most_rows(*frames) -> int:
    return max((n for df in frames for n, _ in broadcast_by(df)), default=0)


def stored_by(monkeypatch, *modules) -> list:
    """What the modules store from now on, as it comes: queries that have run."""
    kept = []

    def written(df):
        kept.append(df)
        return frames.written(df)

    for module in modules:
        monkeypatch.setattr(module, "written", written)
    return kept


@contextmanager
def broadcast_limit(spark, size: str):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_copies_of_fingerprints_are_not_broadcast(spark):
    rng = np.random.default_rng(1)
    codes = rng.integers(-(2**63), 2**63, 2_000, dtype=np.int64)
    near = codes[:300] ^ (1 << rng.integers(0, 63, 300))
    rows = [(int(c),) for c in np.concatenate([codes, near])]
    # Once they have been counted, the fingerprints are below the limit; their 34 copies are far above.
    distinct = spark.createDataFrame(rows, "fp long").distinct()
    with broadcast_limit(spark, "150k"):
        found = simhash.links(distinct)
        pairs = {frozenset((r.a, r.b)) for r in found.collect()}
        assert most_rows(found) <= 2 * len(rows)
    assert {frozenset((int(a), int(b))) for a, b in zip(codes[:300], near)} <= pairs


def test_near_duplicates_of_the_pipeline_broadcast_little(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(150)), "en") for i in range(2_000)]
    rows += [(5_000 + 100 * k + i, f"{text} end{k}", "en") for k in range(3) for i, text, _ in rows[:100]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = stored_by(monkeypatch, simhash, components)
    with broadcast_limit(spark, "150k"):
        left = corpus_pipeline.near_duplicates(spark, docs, "")
        ids = {r.doc_id for r in left.collect()}
    assert set(range(2_000)) <= ids and len(ids) < 2_100
    assert len(kept) > 2
    assert most_rows(*kept, left) <= 2 * len(rows)


def test_repeated_strings_of_the_pipeline_broadcast_no_texts(spark, monkeypatch, tmp_path):
    rng = random.Random(3)
    passage = ["".join(rng.choices(string.ascii_letters, k=2_000)) for _ in range(40)]
    # What repeats within a text is small on disk, by which Spark sizes the table.
    rows = [(i, f"{i} " + passage[i % 40] * 30, "en") for i in range(160)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    kept = stored_by(monkeypatch, suffixes)
    with broadcast_limit(spark, "1m"):
        left = corpus_pipeline.repeated_strings(spark, docs, "")
        assert left.agg(F.max(F.length("text"))).first()[0] < 200
        left.collect()
    found = [x for df in [*kept, left] for x in broadcast_by(df)]
    assert not any("text" in columns or "_row" in columns for _, columns in found)
    assert most_rows(*kept, left) < 40_000  # there are 10 MB of text, and a run for about 85 bytes
