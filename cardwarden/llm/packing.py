"""Packing token sequences of bounded length by exact complements.

Pieces differ only in length as far as packing goes, so it is planned on the
histogram of lengths, at most ``capacity`` numbers whatever the corpus size.
For the longest length still available, the gap it leaves is looked up among the
available single lengths, then pair sums, then triple sums; a combination that
fills the gap exactly is used as often as its members' counts allow, which
empties at least one length (or leaves one piece of it). What finds no exact
complement goes through best fit, longest first, also in whole counts.

The plan is a list of patterns with a number of copies. Copy j of a pattern takes
the j-th piece of a run of pieces of each length, so a join on length and rank
gives every piece its sequence and place. Ranks are counted inside hash buckets
of each length and shifted by the buckets before, so a length that holds a third
of the pieces is ranked in many tasks.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm.chunks import groups, offsets, taken
from cardwarden.llm.frames import give_back, process_table, written

CAPACITY = 4096
END_ID = 1  # closes every document
KEPT_WORDS = 250_000  # words whose ids a task remembers, besides those of the texts at hand
COMMON_WORDS = 60_000  # words that a Python process remembers from task to task
RANK_BUCKETS = 64

# Fixed: how the vocabulary splits lower-cased text, for the characters of plain text (below).
WORDS = re.compile(r"[a-zß-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\x20\x09-\x0Da-z0-9ß-öø-ÿ]+")
# Text whose normal form is its lower case: ASCII and accented letters of one character,
# without an added token's string.
_OTHER = re.compile(r"[^\x00-\x7FÀ-ÖØ-öø-ÿ]|<\|")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_PART = 1 << 20  # characters of a very long text taken at a time
_ASKED = 2000  # new words given to the tokenizer at a time


class Ids:
    """The ids of texts, from the tokenizer itself.

    No word of the vocabulary crosses ASCII white space, so a text's ids are those of
    its chunks between it, in order, and the vocabulary splits a chunk into words before
    any merge. Arrow splits many texts at once into chunks and their distinct chunks
    into words; distinct words are looked up one by one, and ids are gathered by number,
    from words to chunks and from chunks to texts. New words are given to the
    tokenizer's merges many at a time. A chunk that is not plain counts as one word and
    goes to the whole tokenizer as it stands.

    Words' ids lie one after another in ``flat``. A full table drops the words it has met
    once, and then the least met, down to half its size.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks fill the cores
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        # The same merges, for words that are split and lower-cased already.
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = Sequence(
            [WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        # Which ids close a word, by the vocabulary's mark.
        mark, tokens = self.tokenizer.model.end_of_word_suffix, self.tokenizer.get_vocab()
        self.last = np.zeros(max(tokens.values(), default=0) + 1, dtype=bool)
        if mark:
            self.last[[n for token, n in tokens.items() if token.endswith(mark)]] = True
        self.number: dict[str, int] = {}  # word -> its place in the arrays
        self.start, self.size, self.met = (np.zeros(0, np.int64) for _ in range(3))
        self.flat = np.zeros(0, "<u4")

    def forget(self, most: int) -> None:
        """Keeps words met more than once, ``most`` of them at most, the most often met."""
        often = np.partition(self.met, -most)[-most] if len(self.met) > most else 0
        kept = np.flatnonzero(self.met > max(1, often))
        words = list(self.number)
        self.number = {words[k]: n for n, k in enumerate(kept.tolist())}
        self.flat, stops = taken(self.flat, self.start, self.size, kept)
        self.start, self.size, self.met = stops[:-1], np.diff(stops), self.met[kept] // 2 + 1

    def of(self, texts: list[str]) -> list[bytes]:
        """All ids of each text as little-endian 32-bit numbers."""
        return [ids.tobytes() for ids in self.arrays(pa.array(texts, pa.string()))]

    def arrays(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """All ids of each text, in order."""
        for first, last in groups(texts):
            if last == first + 1 and len(text := texts[first].as_py()) > _PART:
                parts = [self._gather(pa.array([part], pa.string()))[0] for part in _parts(text)]
                yield np.concatenate(parts)
            else:
                yield from self._gather(texts.slice(first, last - first))

    def _gather(self, texts: pa.Array) -> list[np.ndarray]:
        split = pc.ascii_split_whitespace(texts)
        chunks = split.flatten().dictionary_encode()
        flat, edges = self._chunks(chunks.dictionary)
        ids, stops = taken(flat, edges[:-1], np.diff(edges), chunks.indices.to_numpy())
        return np.split(ids, stops[offsets(split)[1:-1]])

    def _chunks(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all chunks one after another, and where each begins and ends."""
        spaced = pc.replace_substring_regex(pc.utf8_lower(chunks), WORDS.pattern, r"\0 ")
        other = pc.match_substring_regex(chunks, _OTHER.pattern)
        split = pc.ascii_split_whitespace(pc.if_else(other, chunks, spaced))
        words = split.flatten().dictionary_encode()
        ids, stops = taken(*self._places(words.dictionary.to_pylist()), words.indices.to_numpy())
        return ids, stops[offsets(split)]

    def _places(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The table, and where it has the ids of each word."""
        found = list(map(self.number.get, words))
        new = [word for word, n in zip(words, found) if n is None]
        if new:
            if len(self.number) + len(new) > KEPT_WORDS:
                self.forget(KEPT_WORDS // 2)
                new = [word for word in words if word not in self.number]
            self._learn(new)
            found = list(map(self.number.__getitem__, words))
        at = np.array(found, np.int64)
        self.met[at] += 1
        return self.flat, self.start[at], self.size[at]

    def _learn(self, words: list[str]) -> None:
        made = dict.fromkeys(words, b"")
        plain = [word for word in words if word and _plain(word)]
        made.update(zip(plain, self._merged(plain)))
        for word in words:
            if word and not _plain(word):
                ids = self.tokenizer.encode(word, add_special_tokens=False).ids
                made[word] = np.array(ids, "<u4").tobytes()
        size = np.array([len(made[word]) // 4 for word in words], np.int64)
        n = len(self.number)
        self.number.update(zip(words, range(n, n + len(words))))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.met = np.concatenate([self.met, np.zeros(len(words), np.int64)])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(made.values()), "<u4")])

    def _merged(self, words: list[str]) -> list[bytes]:
        """Each plain word's ids, as bytes."""
        found: list[bytes] = []
        for at in range(0, len(words), _ASKED):
            asked = words[at : at + _ASKED]
            (code,) = self.merges.encode_batch_fast([" ".join(asked)], add_special_tokens=False)
            ids = np.array(code.ids, dtype="<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(asked):  # no mark of a word's end to go by
                code = self.merges.encode(" ".join(asked), add_special_tokens=False)
                ids = np.array(code.ids, dtype="<u4")
                ends = np.searchsorted(np.array(code.word_ids), np.arange(len(asked)), side="right")
            data, ends = ids.tobytes(), (ends * 4).tolist()
            found += [data[lo:hi] for lo, hi in zip([0, *ends], ends)]
        return found


def _plain(text: str) -> bool:
    return "<|" not in text if text.isascii() else not _OTHER.search(text)


def _parts(text: str) -> Iterator[str]:
    """The text, cut at ASCII white space if it is very long."""
    at = 0
    while len(text) - at > _PART:
        cut = _SPACE.search(text, at + _PART)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


def pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """(doc_id, th, piece, start, length, ids_crc32): documents cut at ``capacity`` ids.

    A document is its ids and then ``end_id``, so an empty one has one id.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text")
    )
    last = np.array([end_id], dtype="<u4")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = process_table("token_ids")
        for batch in batches:
            if vocabulary not in kept:
                kept[vocabulary] = Ids(vocabulary)
            out = []
            doc_ids, hashes = (batch.column(k).to_pylist() for k in range(2))
            for doc, th, ids in zip(doc_ids, hashes, kept[vocabulary].arrays(batch.column(2))):
                ids = np.concatenate([ids, last])
                for piece, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    out.append((doc, th, piece, at, len(part), zlib.crc32(part)))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names
                )
        if vocabulary in kept:
            kept[vocabulary].forget(COMMON_WORDS)
            give_back()

    names = ["doc_id", "th", "piece", "start", "length", "ids_crc32"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    return rows.mapInArrow(
        cut, "doc_id long, th long, piece int, start long, length long, ids_crc32 long"
    )


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how often each is used; together they use up the histogram."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in histogram.items():
        left[length] = count
    out: list[tuple[tuple[int, ...], int]] = []
    alone: list[int] = []  # lengths, longest first, whose gap no combination fills
    if left[capacity]:
        out.append(((capacity,), int(left[capacity])))
        left[capacity] = 0
    for longest in range(capacity - 1, 0, -1):
        while left[longest]:
            left[longest] -= 1  # one is in use, so that a complement cannot take it
            found = _complement(left, capacity - longest)
            left[longest] += 1
            if not found:
                alone.append(longest)
                break
            pattern = (longest, *found)
            need = {n: pattern.count(n) for n in pattern}
            copies = int(min(left[n] // k for n, k in need.items()))
            for n, k in need.items():
                left[n] -= copies * k
            out.append((pattern, copies))
    return out + _best_fit({n: int(left[n]) for n in alone if left[n]}, capacity)


def _complement(left: np.ndarray, gap: int) -> tuple[int, ...]:
    """A single length, a pair or a triple available now that adds up to ``gap``; else ()."""
    if left[gap]:
        return (gap,)
    if pair := _pair(left, gap):
        return pair
    for first in np.flatnonzero(left[1 : gap - 1])[::-1] + 1:  # long pieces first
        if 3 * first < gap:
            break  # the longest of a triple is at least a third of the gap
        left[first] -= 1
        pair = _pair(left, gap - int(first))
        left[first] += 1
        if pair:
            return (int(first), *pair)
    return ()


def _pair(left: np.ndarray, total: int) -> tuple[int, ...]:
    """Two available lengths with the given sum, as unequal as can be; else ()."""
    if total < 2:
        return ()
    small = np.arange(1, total // 2 + 1)
    both = (left[small] > 0) & (left[total - small] > 0)
    if total % 2 == 0 and left[total // 2] < 2:
        both[-1] = False
    found = np.flatnonzero(both)
    return (total - int(small[found[0]]), int(small[found[0]])) if len(found) else ()


def _best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first: each length goes where the least room stays, in whole counts."""
    room: dict[int, list[list]] = {}  # room left -> [pattern, copies]
    for length in sorted(counts, reverse=True):
        todo = counts[length]
        while todo:
            fits = [r for r in room if r >= length and room[r]]
            if not fits:
                per = capacity // length
                full, rest = divmod(todo, per)
                for pattern, copies in (((length,) * per, full), ((length,) * rest, 1)):
                    if copies and pattern:
                        room.setdefault(capacity - sum(pattern), []).append([pattern, copies])
                break
            tight = min(fits)
            pattern, copies = room[tight].pop()
            used = min(copies, todo)
            if used < copies:
                room[tight].append([pattern, copies - used])
            room.setdefault(tight - length, []).append([(*pattern, length), used])
            todo -= used
    return [(pattern, copies) for found in room.values() for pattern, copies in found]


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset: its place in a sequence of at most ``capacity``.

    Ties between pieces of one length are settled by a hash, doc_id and piece.
    """
    bucket = F.pmod(F.xxhash64("doc_id", "th", "piece"), F.lit(RANK_BUCKETS))
    rows = pieces.withColumn("_b", bucket)
    sizes = rows.groupBy("length", "_b").agg(F.count("*").alias("n"))
    # At most capacity x RANK_BUCKETS rows, whatever the corpus size.
    counted = sizes.collect()
    histogram: dict[int, int] = {}
    first = []
    for length, part, n in sorted(tuple(r) for r in counted):
        first.append((length, part, histogram.get(length, 0)))
        histogram[length] = histogram.get(length, 0) + n

    spans: dict[int, list[tuple[int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for pattern, copies in plan(histogram, capacity):
        at = 0
        for length in pattern:
            lo = taken.get(length, 0)
            taken[length] = lo + copies
            spans.setdefault(length, []).append((lo, sequence - lo, at))
            at += length
        sequence += copies

    spark = pieces.sparkSession
    starts = spark.createDataFrame(first, "length long, _b long, _first long")
    # Per length its spans in order of rank: a piece's span is the last that begins at or before it.
    table = spark.createDataFrame(
        list(spans.items()), "length long, _spans array<struct<lo:long,shift:long,at:long>>"
    )
    order = Window.partitionBy("length", "_b").orderBy("doc_id", "piece", "th")
    ranked = (
        rows.withColumn("_n", F.row_number().over(order))
        .join(F.broadcast(starts), ["length", "_b"])
        .withColumn("_rank", F.col("_first") + F.col("_n") - 1)
        .drop("_b", "_n", "_first")
    )
    span = F.expr("element_at(filter(_spans, s -> s.lo <= _rank), -1)")
    return (
        ranked.join(F.broadcast(table), "length")
        .withColumn("_s", span)
        .withColumn("sequence_id", F.col("_rank") + F.col("_s.shift"))
        .withColumn("offset", F.col("_s.at"))
        .drop("_rank", "_s", "_spans")
    )


def packed(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """(doc_id, th, piece, start, length, ids_crc32, sequence_id, offset) of whole documents.

    Null text counts as empty: one piece that holds ``end_id``. A null doc_id
    stays null, repeated rows are packed each, an empty table gives no rows, and
    further columns are ignored. Pieces are stored once in the shared folder,
    since both the histogram and the assignment read them.
    """
    return pack(written(pieces(docs, vocabulary, capacity, end_id)), capacity)
