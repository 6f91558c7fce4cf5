"""Token counts and packing against the tokenizer library and the packing rules."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cardwarden.llm import bpe_count, packing
from tests_llm_frames import awkward, empty

BYTES, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
COUNTER, IDS = bpe_count.Counter(BYTES), packing.Ids(WORD)
BYTE_TOKENIZER, WORD_TOKENIZER = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORD)

ODD = [
    "a<|endoftext|>b <|endoftext|><|endoftext|>", "<|startoftext|> it's WE'LL they're 12.5", "",
    "  \n\n \t x y z \x1c \x85", "İstanbul ΣΑΣ ﬁne é ñandú Straße 你好世界 🙂🙂", "a" * 5000,
    "!!'s...'re", "''ll 's 't",
]
TEXT = st.text(alphabet=st.sampled_from("ab 'streÉß.!1\ńİ|<>"), max_size=40)


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_any_text_is_tokenized_as_the_library_does(text):
    assert COUNTER.count(text) == len(BYTE_TOKENIZER.encode(text, add_special_tokens=False).ids)
    want = np.array(WORD_TOKENIZER.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
    assert IDS.of([text]) == [want]


def test_odd_texts():
    for text in ODD:
        assert COUNTER.count(text) == len(BYTE_TOKENIZER.encode(text, add_special_tokens=False).ids)
    want = [WORD_TOKENIZER.encode(t, add_special_tokens=False).ids for t in ODD]
    assert IDS.of(ODD) == [np.array(w, dtype="<u4").tobytes() for w in want]


def test_counts_of_awkward_rows(spark):
    docs = awkward(spark)
    want = sorted(
        (str(r.doc_id), len((r.text or "").encode()), n, n > 1024)
        for r in docs.collect()
        for n in [len(BYTE_TOKENIZER.encode(r.text or "", add_special_tokens=False).ids)]
    )
    found = bpe_count.token_counts(docs, BYTES).collect()
    assert want == sorted((str(r[0]), *r[1:]) for r in found)
    assert bpe_count.token_counts(empty(spark), BYTES).count() == 0


def check_packed(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing_of_awkward_rows(spark):
    docs = awkward(spark, [(50 + i, "word " * (i % 7 * 9), None) for i in range(60)])
    rows = packing.packed(docs, WORD, capacity=64).collect()
    check_packed(rows, 64)
    found = defaultdict(list)
    for r in rows:
        found[str(r.doc_id), r.th].append((r.piece, r.start, r.length, r.ids_crc32))
    want = defaultdict(list)
    for r in docs.selectExpr("doc_id", "coalesce(text, '') AS text", "xxhash64(coalesce(text, '')) AS th").collect():
        ids = np.array([*WORD_TOKENIZER.encode(r.text, add_special_tokens=False).ids, 1], dtype="<u4")
        for piece, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            want[str(r.doc_id), r.th].append((piece, at, len(part), zlib.crc32(part.tobytes())))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}
    assert packing.packed(empty(spark), WORD).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=25))
def test_plans_use_every_piece_once_and_fill_well(histogram):
    used = defaultdict(int)
    sequences = 0
    for pattern, copies in packing.plan(histogram, 40):
        assert sum(pattern) <= 40 and copies > 0
        sequences += copies
        for length in pattern:
            used[length] += copies
    assert used == {k: v for k, v in histogram.items() if v}
    total = sum(k * v for k, v in histogram.items())
    if total:
        # First fit of any kind stays below twice the bound; exact fills are far better.
        assert sequences <= 2 * -(-total // 40)


def test_exact_complements_leave_no_gap():
    histogram = {30: 5, 10: 5, 25: 4, 8: 4, 7: 4, 20: 2, 9: 2, 6: 2, 5: 2}
    plan = packing.plan(histogram, 40)
    assert sum(c for _, c in plan) == sum(k * v for k, v in histogram.items()) // 40
