"""Decontamination against the alignment of every item with every text."""

import random

import numpy as np
import pytest

from cardwarden.llm import chunks, decontam

WORDS = [f"w{i}" for i in range(60)]


def edited(rng, words, rate):
    out = []
    for w in words:
        kind = rng.random()
        if kind < rate / 3:
            out.append(rng.choice(WORDS))  # another word
        elif kind < 2 * rate / 3:
            out += [w, rng.choice(WORDS)]  # a word put in
        elif kind >= rate:
            out.append(w)  # or left out
    return out


def tables(spark, seed):
    rng = random.Random(seed)
    items = {i: [rng.choice(WORDS) for _ in range(rng.choice([6, 7, 10, 25, 60]))] for i in range(25)}
    docs = {}
    for d in range(60):
        text = [rng.choice(WORDS) for _ in range(rng.randrange(120))]
        for _ in range(rng.choice([0, 1, 1, 2])):
            at = rng.randrange(len(text) + 1)
            text[at:at] = edited(rng, items[rng.randrange(len(items))], rng.choice([0, 0.2, 0.4, 0.6]))
        docs[d] = text
    for d in range(60, 90):  # so that some phrases are common
        docs[d] = items[0][:4] + [rng.choice(WORDS) for _ in range(5)]
    glue = [" ", ", ", "\n", " - "]
    frame = spark.createDataFrame([(d, "".join(w.upper() + rng.choice(glue) for w in t)) for d, t in docs.items()], "doc_id long, text string")
    bench = spark.createDataFrame([(i, "\t".join(w)) for i, w in items.items()], "item_id long, text string")
    number = {w: i for i, w in enumerate(WORDS)}
    want = {}
    for d, text in docs.items():
        coded = np.array([number[w] for w in text], dtype=np.int64)
        for i, item in items.items():
            score = decontam.align(np.array([number[w] for w in item]), coded)[0] / (2 * len(item))
            if score >= 0.5:
                want[d, i] = round(score, 6)
    return frame, bench, want


@pytest.mark.parametrize("seed, part", [(1, None), (2, None), (3, 300)])
def test_finds_every_alignment(spark, seed, part, monkeypatch):
    if part:  # every text is long: it is read in parts, alone
        monkeypatch.setattr(decontam, "_PART", part)
        monkeypatch.setattr(chunks, "TOGETHER", 1)
    docs, bench, want = tables(spark, seed)
    found = {(r.doc_id, r.item_id): round(r.score, 6) for r in decontam.contaminated(docs, bench).collect()}
    assert found == want and len(want) > 20


def test_long_runs_of_seeds_are_cut_with_room_to_align():
    size = 10
    windows = decontam._windows(list(range(0, 2000, 3)), size, 2000)
    assert all(b - a <= 8 * size + 64 + 4 * size for a, b in windows)
    for first in range(0, 1980):  # an alignment spans twice the item's length at most
        assert any(a <= first and first + 2 * size <= b for a, b in windows)


def test_words_of_chunks_are_those_of_whole_texts():
    import pyarrow as pa

    odd = ["Σας ΣΑΣ ΑΣ' x_y 12.5 é×É ÷ µm ªº \x1c a\x85b", "", " \t", "İstanbul ﬁne 你好 世界。好 it's"]
    seeds = decontam.Seeds([decontam.words_of(" ".join(odd))], 3)
    found = [coded for group in seeds.segments(pa.array(odd), 9) for _, _, coded in group]
    assert [c.tolist() for c in found] == [seeds.coded_text(decontam.words_of(t)).tolist() for t in odd]


def test_equal_items_under_many_ids(spark):
    docs = spark.createDataFrame([(1, "one two three four five six seven"), (2, "nothing")], "doc_id long, text string")
    text = "One two three, four five six!"
    items = spark.createDataFrame([(i, text) for i in range(500)] + [(500, text.lower()), (None, text)], "item_id long, text string")
    found = decontam.contaminated(docs, items).collect()
    assert sorted(str(r.item_id) for r in found) == sorted(map(str, [*range(501), None])) and {r.doc_id for r in found} == {1}
