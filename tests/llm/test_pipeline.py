"""The pipeline as a whole, on the smallest tables."""

import corpus_pipeline
from tests_llm_frames import awkward

SF = "/root/testdata/sf0.001"


def test_stages_run_in_order_and_keep_columns(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.columns
    counts = [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < 4:
            assert docs.columns == before
            counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.6 * counts[0]
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "repeated_strings", "decontaminated", "sequences",
    ]
    assert docs.select("doc_id").distinct().count() == counts[-1]


def test_stages_take_awkward_and_empty_rows(spark):
    docs = awkward(spark)
    for rows in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, rows, SF).count()
