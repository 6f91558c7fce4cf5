"""SimHash near-duplicates by anchor-point covering.

A document's fingerprint has 64 bits. Two fingerprints link when they differ in
at most ``max_bits`` (up to 5) places; then one of their 32-bit halves differs in
at most two. Anchors for a half are the words of a covering code: the perfect
[31, 26] Hamming code next to one free bit, covering radius 1. Halves at distance
two have a word between them, one step from either; the anchor that covers it
lies within the covering radius plus each side's share of the threshold,
1 + 1, of both. So each half is replicated to every anchor within distance two
(17 of 2^27), fingerprints meet per anchor, and no link is lost.

Equal fingerprints are one node, whatever their number. An anchor with two
fingerprints is one comparison, done in the aggregate that finds it. Fuller
anchors are compared in blocks of bounded size: beyond ``BLOCK`` fingerprints,
every pair of blocks is its own group, in whatever task it falls, and each group
gives a forest of its links, never all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm.components import components
from cardwarden.llm.frames import ROW, give_back, keyed_rows, same_row, texts, written

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
BLOCK = 1024  # fingerprints of one anchor that are compared at once

_STEP = 50_000  # shingles hashed at a time, so that a long text needs bounded memory


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """64 bits, each set when over half the shingles' XXH64 have it; 0 without words.

    A-Z are lower-cased, words are runs without ASCII white space, shingles keep
    repeats, and a text with fewer words than a shingle is one shingle.
    """
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    if not tokens:
        return 0
    hashed = xxhash.xxh64_intdigest
    total = max(1, len(tokens) - words + 1)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, total, _STEP):
        some = tokens[start : min(start + _STEP, total) + words - 1]
        shingles = zip(*[some[i:] for i in range(min(words, len(some)))])
        codes = np.array([hashed(b" ".join(s), SEED) for s in shingles], dtype="<u8")
        bits = np.unpackbits(codes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, th, fp) for every row; ``fp`` is the fingerprint as a signed long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [fingerprint(t.as_py(), words) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("th"),
                    pa.array(np.array(codes, dtype=np.uint64).view(np.int64)),
                ],
                ["doc_id", "th", "fp"],
            )
        give_back()

    return texts(docs).mapInArrow(compute, "doc_id long, th long, fp long")


def _anchor_masks() -> np.ndarray:
    """For each syndrome of the Hamming code, what to flip in a half to get its anchors.

    Positions 1 to 31 are the coded bits and position 0 is none; flipping a pair
    of positions that add up (xor) to the syndrome gives a code word. Each such
    pair is one anchor; the last is the nearest word with the free bit flipped.
    For syndrome 0 the word is itself the only one in reach, so its row repeats.
    """
    bit = np.array([0, *(1 << np.arange(31))], dtype=np.int64)
    masks = np.zeros((32, 17), dtype=np.int64)
    for syndrome in range(32):
        pairs = [p for p in range(32) if p < p ^ syndrome] or [0]
        flips = [bit[p] ^ bit[p ^ syndrome] for p in pairs]
        free = bit[syndrome] ^ (1 << 31)
        masks[syndrome] = [*flips, *[flips[0]] * (16 - len(flips)), free]
    return masks


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, fp): both halves of every fingerprint at each anchor within distance two."""
    masks, position = _anchor_masks(), np.arange(1, 32)
    for batch in batches:
        codes = batch.column(0).to_numpy(zero_copy_only=False)
        for side, half in enumerate((codes & 0xFFFFFFFF, codes >> 32 & 0xFFFFFFFF)):
            bits = half[:, None] >> (position - 1) & 1
            syndrome = np.bitwise_xor.reduce(bits * position, axis=1)
            anchors = half[:, None] ^ masks[syndrome] | side << 32
            keep = np.ones(anchors.shape, dtype=bool)
            keep[syndrome == 0, 1:16] = False
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors[keep]), pa.array(np.repeat(codes, keep.sum(axis=1)))],
                ["anchor", "fp"],
            )


def links(distinct: DataFrame, max_bits: int = MAX_BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) that join exactly the fingerprints (column ``fp``, distinct) within reach.

    Per group of compared fingerprints the links are a forest: two fingerprints
    within ``max_bits`` bits are connected through them, not always directly.
    """
    if not 0 <= max_bits <= 5:
        raise ValueError("anchors within radius two of a half cover at most five differing bits")
    placed = distinct.mapInArrow(_anchors, "anchor long, fp long")
    full = placed.groupBy("anchor").agg(
        F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")
    )
    near = f"bit_count(a ^ b) <= {max_bits}"
    twos = full.where("n = 2").where(near).select("a", "b")

    # Spark sizes ``placed`` as if it had a row a fingerprint, and would broadcast all the copies.
    many = placed.join(full.where("n > 2").select("anchor", "n").hint("merge"), "anchor")
    blocks = F.ceil(F.col("n") / block).cast("long")
    grouped = (
        many.withColumn("own", F.pmod(F.xxhash64("fp", F.lit(1)), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .select(
            "anchor", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "fp"
        )
        .repartition("anchor", "p", "q")
        .sortWithinPartitions("anchor", "p", "q", "fp")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes in _runs(batches):
            hop = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= max_bits
            root = _forest(hop)
            far = np.flatnonzero(root != np.arange(len(codes)))
            if len(far):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(codes[root[far]].view(np.int64)), pa.array(codes[far].view(np.int64))],
                    ["a", "b"],
                )

    return twos.union(grouped.mapInArrow(compare, "a long, b long")).distinct()


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The fingerprints of each (anchor, p, q), which may go on into the next batch."""
    rest, key = [], None
    for batch in batches:
        keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
        codes = batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(codes)]):
            if hi == lo:
                continue
            if key is not None and tuple(keys[lo]) != key:
                yield np.concatenate(rest)
                rest = []
            key = tuple(keys[lo])
            rest.append(codes[lo:hi])
    if rest:
        yield np.concatenate(rest)


def _forest(hop: np.ndarray) -> np.ndarray:
    """For each node of a small symmetric matrix, the first node of its component."""
    root = np.full(len(hop), -1)
    for start in range(len(hop)):
        if root[start] >= 0:
            continue
        reach = hop[start] & (root < 0)
        root[start] = start
        while reach.any():
            new = np.flatnonzero(reach & (root < 0))
            root[new] = start
            reach = hop[new].any(axis=0) & (root < 0) if len(new) else np.zeros(len(hop), bool)
    return root


def near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, block: int = BLOCK
) -> DataFrame:
    """(doc_id, th, fp, component_id) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id that links reach from the row, itself
    included. Null text counts as empty; texts without words have fingerprint 0
    and link like others. Repeated rows stay and share a component. A null doc_id
    is never the smallest; a component that has no other id gets null. An empty
    table gives no rows; further columns are ignored.
    """
    printed = written(fingerprints(docs, words))
    distinct = printed.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = components(links(distinct.select("fp"), max_bits, block))
    rooted = distinct.join(found, distinct["fp"] == found["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    member = rooted.select("fp", "root").join(smallest, "root").select("fp", "root", "component_id")
    return printed.join(member, "fp").select("doc_id", "th", "fp", "root", "component_id")


def keep_one(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest doc_id.

    Rows that agree in doc_id are ordered by a hash of their text, then by their
    other columns, so that the same one stays in every run.
    """
    found = near_duplicates(docs, words, max_bits)
    first = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("f")
    )
    chosen = first.select("f.doc_id", "f.th").distinct()
    rows = keyed_rows(docs)
    # One more row number: rows that repeat both id and text are one document.
    again = Window.partitionBy("doc_id", "th").orderBy(F.xxhash64(ROW), F.to_json(ROW))
    return (
        rows.join(chosen, same_row(rows, chosen), "left_semi")
        .withColumn("_n", F.row_number().over(again))
        .where("_n = 1")
        .select(f"{ROW}.*")
    )


def fingerprint_hex(column: str = "fp") -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(column)), 16, "0")
