"""Licenses, decontamination, nearest neighbours and quotations."""

import random

import numpy as np

from cardwarden.llm import decontam, hnsw, licenses, quotes
from tests_llm_frames import awkward, empty, sentence


def slow_alignment(item, text):
    best, table = 0, [[0] * (len(text) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            table[i][j] = max(
                0, table[i - 1][j - 1] + (2 if a == b else -1), table[i - 1][j] - 1, table[i][j - 1] - 1
            )
            best = max(best, table[i][j])
    return best


def test_alignment_matches_the_textbook():
    rng = np.random.default_rng(4)
    for _ in range(200):
        item, text = rng.integers(0, 4, rng.integers(1, 12)), rng.integers(-1, 4, rng.integers(1, 25))
        score, lo, hi = decontam.align(item, text)
        assert score == slow_alignment(item.tolist(), text.tolist())
        if score:
            assert slow_alignment(item.tolist(), text[lo:hi].tolist()) == score


def test_copies_are_found_and_clean_texts_left(spark):
    rng = random.Random(6)
    items = [(i, sentence(rng, 30)) for i in range(12)] + [(90, None), (91, ""), (92, "two words")]
    items.append((93, items[0][1].upper() + "!"))
    rows = []
    for i in range(60):
        words = [f"w{rng.randrange(5000)}" for _ in range(80)]
        if i < 24:
            copy = items[i % 12][1].split()
            if i >= 12:  # edited: some words go, some change, some come in
                for k in (3, 11, 20):
                    copy[k] = f"x{k}"
                del copy[7]
                copy.insert(15, "inserted")
            words[40:40] = copy
        rows.append((300 + i, " ".join(words), None))
    docs = awkward(spark, rows)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontam.contaminated(docs, bench).collect()}
    want = {(300 + i, i % 12) for i in range(24)} | {(300, 93), (312, 93)}
    assert set(found) == want
    assert all(found[300 + i, i].score == 1.0 for i in range(12))
    assert all(0.5 <= found[312 + i, i].score < 1.0 for i in range(12))
    kept = decontam.without_items(docs, bench)
    assert kept.columns == docs.columns and kept.count() == docs.count() - 24
    assert decontam.contaminated(empty(spark), bench).count() == 0
    assert decontam.contaminated(docs, bench.limit(0)).count() == 0


def test_dense_edits_are_found(spark):
    rng = random.Random(8)
    items = [(i, " ".join(f"i{i}w{k}" for k in range(30))) for i in range(3)]
    rows = []
    for i, (_, text) in enumerate(items):
        words = text.split()
        edited = [
            [f"x{k}" if k % 3 == 2 else w for k, w in enumerate(words)],  # every third word replaced
            [v for k, w in enumerate(words) for v in ((w, f"x{k}") if k % 2 else (w,))],  # one put in after two
            [v for k, w in enumerate(words) for v in (w, f"x{k}")],  # one put in after each
        ][i]
        noise = [f"w{rng.randrange(500)}" for _ in range(40)]
        rows.append((i, " ".join(noise + edited + noise), None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.score for r in decontam.contaminated(docs, bench).collect()}
    assert set(found) == {(0, 0), (1, 1), (2, 2)} and min(found.values()) >= 0.5


def test_patience_alignment():
    left, right = "x a b c d e y".split(), "a b q d e".split()
    assert licenses.matched(left, right) == [(1, 0), (2, 1), (4, 3), (5, 4)]
    assert licenses.matched(["the"] * 4, ["the"] * 2) == [(0, 0), (3, 1)] or len(
        licenses.matched(["the"] * 4, ["the"] * 2)
    ) == 2
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.choice("abcdefgh") for _ in range(rng.randrange(14))] for _ in range(2))
        pairs = licenses.matched(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_licenses_whole_and_edited(spark):
    mit = licenses.TEMPLATES["MIT/text"]
    edited = mit.replace("Software", "Program").replace("sublicense, and/or sell", "sell")
    rows = [
        (400, "words before. " * 30 + licenses.TEMPLATES["GPL-3.0/line"] + " and after", None),
        (401, "header\n" + edited + "\ncode follows " * 20, None),
        (402, (licenses.TEMPLATES["MIT/line"] + " the of and license under version ") * 3, None),
        (403, "the license of the work under which and or any " * 20, None),
    ]
    docs = awkward(spark, rows)
    found = {(r.doc_id, r.license, r.form): r for r in licenses.licenses(docs).collect()}
    assert set(found) == {(400, "GPL-3.0", "line"), (401, "MIT", "text"), (402, "MIT", "line")}
    assert found[400, "GPL-3.0", "line"].coverage == 1.0 and found[400, "GPL-3.0", "line"].first_word == 60
    assert 0.8 <= found[401, "MIT", "text"].coverage < 1.0
    assert licenses.licenses(empty(spark)).count() == 0


def test_neighbouring_licenses_are_told_apart(spark):
    text = licenses.TEMPLATES
    lines = [
        ("Released under the BSD License.", {"LicenseRef-BSD"}),
        ("It was released under the license.", set()),
        ("Licensed under CC BY 4.0.", {"CC-BY-4.0"}),
        ("Licensed under CC BY-NC 4.0.", {"CC-BY-NC-4.0"}),
        ("This work is licensed under the GNU General Public License, version 2.", {"GPL-2.0"}),
        ("This work is licensed under version 3 of the GNU General Public License.", {"GPL-3.0"}),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", {"LGPL-3.0"}),
        ("This work is licensed under the GNU General Public License, version 2. This work is licensed "
         "under the GNU Lesser General Public License, version 3.", {"GPL-2.0", "LGPL-3.0"}),
        ("// SPDX-License-Identifier: AGPL-3.0-or-later", {"AGPL-3.0"}),
        ("// SPDX-License-Identifier: Apache-2.0 OR MIT", {"Apache-2.0", "MIT"}),
        ("// SPDX-License-Identifier: MIT-0", {"MIT-0"}),
    ]
    lines += [(f"code\n{t} and more code", {name.partition("/")[0]}) for name, t in text.items()]
    rows = [(i, line, None) for i, (line, _) in enumerate(lines)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {i: set() for i in range(len(lines))}
    for r in licenses.licenses(docs).collect():
        found[r.doc_id].add(r.license)
    wrong = {lines[i][0][:90]: kinds for i, kinds in found.items() if kinds != lines[i][1]}
    assert not wrong


def vectors(spark, n=900, hot=60):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(size=16)).astype("float32").tolist()) for i in range(n)]
    rows += [(n + i, rows[5][1]) for i in range(hot)]  # one vector many times
    rows += [
        (5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (5060, [None] * 16),
        (5080, [float("inf")] * 16), (None, rows[7][1]), (5100, []), (20, rows[20][1]),
    ]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumnRenamed(
        "extra", "point"
    )


def test_neighbours_against_brute_force(spark):
    rows, frame = vectors(spark)
    good = [(i, v) for i, v in rows if i is not None and i < 5000]
    ids, matrix = np.array([i for i, _ in good]), np.array([v for _, v in good], dtype=np.float32).astype(float)
    from pyspark.sql import functions as F

    found = {}
    for r in hnsw.search(frame, F.col("vec_id") % 20 == 0, k=10, shard_points=300).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    asked = sorted({i for i in ids.tolist() if i % 20 == 0})
    assert sorted(found) == asked
    hits = 0
    for q in asked:
        query = matrix[ids.tolist().index(q)]
        score = matrix @ query
        order = [k for k in np.lexsort((ids, -score)) if ids[k] != q][:10]
        assert len(found[q]) == 10
        hits += len({v for v, _ in found[q]} & set(ids[order].tolist()))
        exact = dict(zip(ids.tolist(), score))
        assert all(abs(s - exact[v]) < 1e-9 for v, s in found[q])
        pairs = [(-s, v) for v, s in found[q]]
        assert pairs == sorted(pairs)
    assert hits >= 0.9 * 10 * len(asked)
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [2.0, 0.0])], "vec_id long, embedding array<float>")
    assert [(r.vec_id, r.rank) for r in hnsw.search(few, F.col("vec_id") == 0).orderBy("rank").collect()] == [(2, 1), (1, 2)]
    assert hnsw.search(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_quotes_link_to_what_was_said(spark):
    rows = [
        (1, 0, "user", "Where is the lamp?\nIt was here."),
        (1, 1, "assistant", "In the garden, by the old stone."),
        (1, 2, "user", "It was here."),
        (1, 3, "assistant", "On Monday Ann wrote:\n> Where is  the LAMP?\n> It was here.\nStill in the garden."),
        (1, 4, "user", "> Still in the garden.\n>> It was here.\nNo, it is not."),
        (1, 5, "user", "> nobody said this\nHello"),
        (2, 0, "user", "> It was here.\nAn answer to nothing"),
        (2, 1, "user", None),
        (None, None, None, ""),
        (2, 1, "user", None),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr(
        "*", "1 AS c", "2 AS m", "'x' AS depth"
    )
    found = quotes.conversations(frame).collect()
    assert len(found) == len(rows)
    by = {(r.conv_id, r.turn): r for r in found}
    assert [by[1, t].parent_turn for t in range(6)] == [None, 0, 1, 0, 3, 4]
    assert [by[1, t].linked for t in range(6)] == [False, False, False, True, True, False]
    assert [by[1, t].depth for t in range(6)] == [0, 1, 2, 1, 2, 3]
    assert by[1, 3].text == "Still in the garden." and by[1, 4].text == "No, it is not."
    assert (by[1, 4].n_quotes, by[1, 4].n_linked) == (2, 2)
    assert (by[1, 5].n_quotes, by[1, 5].n_linked) == (1, 0)
    assert by[2, 0].parent_turn is None and by[2, 0].text == "An answer to nothing"
    assert sorted(r.position for r in found if r.conv_id == 2) == [1, 2, 3]
    assert by[None, None].depth == 0 and by[None, None].text == ""
    assert quotes.conversations(frame.limit(0)).count() == 0


def test_blocks_do_not_change_conversations(spark, monkeypatch):
    rng = random.Random(9)
    rows, said = [], []
    for t in range(120):
        body = f"line {rng.randrange(30)} of text"
        quote = f"> {rng.choice(said)}\n" if said and t % 3 == 0 else ""
        rows.append((7, t * 3, "user", quote + body))
        said.append(body)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = sorted(map(tuple, quotes.conversations(frame).collect()))
    latest = {}
    for _, t, _, text in rows:
        if text.startswith("> "):
            assert next(r[4] for r in whole if r[1] == t) == latest[text.split("\n")[0][2:]]
        latest[text.split("\n")[-1]] = t
    monkeypatch.setattr(quotes, "BLOCK", 10)
    assert sorted(map(tuple, quotes.conversations(frame).collect())) == whole
