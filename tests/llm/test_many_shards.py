"""Nearest neighbours over many shards: what reaches the merge, and whole answers."""

import numpy as np
from pyspark.sql import functions as F

from cardwarden.llm import hnsw


def test_answers_do_not_grow_with_the_number_of_shards(spark, monkeypatch):
    rng = np.random.default_rng(5)
    matrix = rng.normal(size=(1_200, 8))
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(matrix.tolist())], "vec_id long, embedding array<double>")
    merged, ask = [], hnsw._answers
    monkeypatch.setattr(hnsw, "_answers", lambda *given: merged.append(ask(*given)) or merged[-1])
    found = hnsw.search(frame, F.col("vec_id") % 100 == 0, k=3, shard_points=20)  # 60 shards
    per_query = [r["count"] for r in merged[0].groupBy("query_id").count().collect()]
    assert len(per_query) == 12 and max(per_query) <= 16 * 4

    answers = {}
    for r in found.orderBy("rank").collect():
        answers.setdefault(r.query_id, []).append((r.vec_id, r.score))
    for q in range(0, 1_200, 100):
        score = np.array([np.dot(v, matrix[q]) for v in matrix])
        best = [i for i in np.lexsort((np.arange(1_200), -score)).tolist() if i != q][:3]
        assert answers[q] == [(i, score[i]) for i in best]


def test_a_block_of_queries_finds_what_each_finds_alone():
    rng = np.random.default_rng(6)
    points = rng.normal(size=(2_000, 12)).astype(np.float32)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    graph = hnsw.Graph(points)
    graph.build(48)
    assert all((near[graph.level < at] == -1).all() for at, near in enumerate(graph.near))
    queries = points[::7]
    found, value = graph.nearest(queries, 40)
    alone = np.concatenate([graph.nearest(q[None], 40)[0] for q in queries])
    assert (np.sort(found, axis=1) == np.sort(alone, axis=1)).mean() > 0.99
    assert all(len(set(row)) == 40 for row in found.tolist()) and (np.diff(value, axis=1) <= 0).all()
    best = np.argsort(-(queries @ points.T), axis=1)[:, :10]
    assert np.mean([len(set(b) & set(f)) for b, f in zip(best.tolist(), found.tolist())]) > 9.8
    few = hnsw.Graph(points[:3])
    few.build(48)
    assert sorted(few.nearest(points[:1], 40)[0][0].tolist())[-3:] == [0, 1, 2]


def test_lengths_far_from_one_are_searched_as_well(spark):
    rng = np.random.default_rng(7)
    matrix = rng.normal(size=(300, 6))
    for size in (1e-30, 1e60):
        rows = [(i, (size * v).tolist()) for i, v in enumerate(matrix)]
        frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        found = hnsw.search(frame, F.col("vec_id") < 10, k=5, shard_points=100).collect()
        for q in range(10):
            order = [i for i in np.argsort(-(matrix @ matrix[q])).tolist() if i != q][:5]
            assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] == order


def test_products_beyond_doubles_still_give_rows(spark):
    rows = [(i, [1e200 * (-1) ** i, 1e200]) for i in range(8)] + [(8, [-1e200, -1e200])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = hnsw.search(frame, F.col("vec_id") == 0, k=20, shard_points=2).collect()
    assert sorted(r.vec_id for r in found) == list(range(1, 9))
