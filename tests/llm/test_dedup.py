"""SimHash near-duplicates and repeated strings against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from cardwarden.llm import components, simhash, suffixes
from tests_llm_frames import awkward, empty, sentence


def slow_fingerprint(text, n=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in words.encode().replace(b"\x0b", b" ").replace(b"\x0c", b" ").split() if w]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    codes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(c >> b & 1 for c in codes) > len(codes))


def slow_components(codes, max_bits):
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(codes):
        for j in range(i):
            if (a ^ codes[j]).bit_count() <= max_bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(codes))]


def near_copies(rng, groups=12, copies=6):
    rows, i = [], 100
    for _ in range(groups):
        words = sentence(rng, rng.randrange(3, 120)).split()
        for _ in range(copies):
            changed = list(words)
            for _ in range(rng.randrange(3)):
                changed[rng.randrange(len(changed))] = f"new{rng.randrange(99)}"
            rows.append((i, " ".join(changed), None))
            i += 1
    return rows


def test_fingerprint_and_spark_hash(spark):
    texts = ["", "One", "ONE two Three", "É É ü\x0bx y\x85z w", "a b c d " * 9]
    for text in texts:
        assert simhash.fingerprint(text) == slow_fingerprint(text)
    rows = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr("t", "xxhash64(t) AS h")
    for t, h in rows.collect():
        assert h % (1 << 64) == xxhash.xxh64_intdigest(t.encode(), 42)


def test_every_near_half_shares_an_anchor():
    rng = np.random.default_rng(1)
    import pyarrow as pa

    for _ in range(300):
        a = int(rng.integers(0, 1 << 63))
        b = a
        for bit in rng.choice(63, size=4, replace=False):
            b ^= 1 << int(bit)
        batch = pa.RecordBatch.from_arrays([pa.array([a, b], pa.int64())], ["fp"])
        found = {a: set(), b: set()}
        for out in simhash._anchors(iter([batch])):
            for anchor, fp in zip(*(out.column(k).to_pylist() for k in range(2))):
                found[fp].add(anchor)
        assert found[a] & found[b]


@pytest.mark.parametrize("block", [2, 1024])
def test_near_duplicates_match_brute_force(spark, block):
    docs = awkward(spark, near_copies(random.Random(3)))
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    codes = [slow_fingerprint(t) for _, t in rows]
    for bits in (0, 3, 4):
        roots = slow_components(codes, bits)
        ids = {}
        for (i, _), r in zip(rows, roots):
            ids.setdefault(r, []).append(i)
        smallest = {r: min((i for i in own if i is not None), default=None) for r, own in ids.items()}
        want = sorted((str(i), c, str(smallest[r])) for (i, _), c, r in zip(rows, codes, roots))
        found = simhash.near_duplicates(docs, max_bits=bits, block=block)
        assert want == sorted(
            (str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in found.collect()
        )


def test_one_document_stays_of_each_component(spark):
    docs = awkward(spark, near_copies(random.Random(4)))
    groups = simhash.near_duplicates(docs).select("root").distinct().count()
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == groups
    assert simhash.keep_one(empty(spark)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 80)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (None, 3)], "a long, b long")
    found = {r.node: r.root for r in components.components(links).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(80)}}


def slow_removal(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = {}
    for b in data:
        for p in range(len(b) - length + 1):
            seen[b[p : p + length]] = seen.get(b[p : p + length], 0) + 1
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, dtype=bool)
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = True
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length", [9, 20, 200])
def test_buckets_are_in_suffix_order(length):
    data = np.random.default_rng(2).choice(np.frombuffer(b"abc", np.uint8), 1500)
    data = np.concatenate([data, data[100:700]])
    pointer = suffixes.string_buckets(data, length)
    places = range(len(data) - length + 1)
    of = {}
    for p in places:
        of.setdefault(data[p : p + length].tobytes(), set()).add(int(pointer[p]))
    assert all(len(v) == 1 for v in of.values())
    order = [min(of[s]) for s in sorted(of)]
    assert order == sorted(set(order)) and len(order) == len(of)


@pytest.mark.parametrize("many", [10**6, 2, 0])
def test_removal_matches_brute_force(spark, many):
    rng = random.Random(8)
    base = [sentence(rng, 50) for _ in range(4)]
    extra = []
    for i in range(40):
        b, k = rng.choice(base), rng.randrange(200)
        extra.append((200 + i, sentence(rng, rng.randrange(9)) + b[k : k + rng.randrange(250)] + "é" * rng.randrange(80), None))
    docs = awkward(spark, extra).where("doc_id IS NULL OR doc_id NOT IN (6, 7)")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = sorted((str(i), *x) for (i, _), x in zip(rows, slow_removal([t for _, t in rows], 60)))
    found = suffixes.removal_report(docs, 60, 16, many)
    assert want == sorted((str(r[0]), *r[1:]) for r in found.collect())
    assert any(w[2] for w in want)


def test_texts_without_repeats_keep_rows_and_columns(spark):
    docs = awkward(spark)
    kept = suffixes.without_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    by_id = {r.doc_id: r.text for r in kept.collect()}
    assert by_id[2] is None and by_id[7] is not None and len(by_id[7]) < 200
    assert suffixes.without_repeats(empty(spark)).count() == 0
