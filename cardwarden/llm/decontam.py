"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The word n-grams of the test items are the seeds. One pass over the training texts
counts in how many of them each seed occurs, and keeps the places around shared seeds
that have enough of an item's words to reach the threshold at all, with the seeds that
led there. A phrase that a hundredth of all texts have starts nothing, unless it is no
more common than ``COMMON_TIMES`` the upper quartile of its item's phrases: an item that
leaked into very many texts, whole or edited, keeps its seeds. Places with a rare seed
are aligned with the item, word by word, and the best local alignment, as a share of a
perfect one, is the score.

Dense edits leave no phrase whole, so pairs of words that follow each other in an
item are seeds as well, next to each other in the text or with one word between. An
alignment that reaches the threshold has many of them close together (``_enough``),
whatever the edits; only such places are aligned, however common the pairs are.

Items are taken in blocks whose seeds have a bounded size and travel to the
texts; texts never move.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.chunks import groups, numbered_words
from cardwarden.llm.frames import give_back, keyed_rows, same_row, texts, written

SEED_WORDS = 3
SHORT_ITEM = 6  # an item with fewer words is only found by its phrases
THRESHOLD = 0.5  # share of a perfect alignment from which a text counts as contaminated
MATCH, MISMATCH, GAP = 2, -1, -1
COMMON_SHARE, COMMON_TIMES = 0.01, 20
BLOCK_BYTES = 4_000_000  # of the texts of items taken together, about

_WORD = re.compile(r"\w+")
_PART = 1 << 20  # characters of a text looked at together
# Chunks of ASCII and accented letters of one character split at these signs; others one by one.
_OTHER = r"[^\x00-\x7FÀ-ÖØ-öø-ÿ]"
_BETWEEN = r"[^0-9a-z_ß-öø-ÿ]+"


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return _WORD.findall(text.lower())


def _words_of_chunks(chunks: pa.Array) -> pa.ListArray:
    """``words_of`` each chunk."""
    plain = pc.replace_substring_regex(pc.utf8_lower(chunks), _BETWEEN, " ")
    other = pc.match_substring_regex(chunks, _OTHER)
    slow = [" ".join(words_of(chunk)) for chunk in chunks.filter(other).to_pylist()]
    return pc.ascii_split_whitespace(pc.replace_with_mask(plain, other, pa.array(slow, pa.string())))


class Seeds:
    """The n-grams of a block of items, and where each occurs in which item."""

    def __init__(self, items: list[list[str]], n: int):
        self.items, self.n = items, n
        self.number: dict[str, int] = {}
        for words in items:
            for w in words:
                self.number.setdefault(w, len(self.number))
        self.coded = [np.array([self.number[w] for w in words], dtype=np.int64) for words in items]
        table: dict[int, dict[tuple, list[tuple[int, int]]]] = {}
        for i, words in enumerate(items):
            size = min(n, len(words))  # a shorter item is one seed
            for at in range(len(words) - size + 1 if size else 0):
                gram = tuple(self.coded[i][at : at + size].tolist())
                table.setdefault(size, {}).setdefault(gram, []).append((i, at))
        self.grams = [(size, gram) for size in sorted(table) for gram in sorted(table[size])]
        self.places = [table[size][gram] for size, gram in self.grams]
        flat = [place for places in self.places for place in places]
        self.place_item, self.place_at = np.array(flat, dtype=np.int64).reshape(-1, 2).T
        self.place_first = np.cumsum([0, *map(len, self.places)])
        self.codes: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # size -> sorted codes, their numbers
        for size in table:
            own = [(self._code(g), k) for k, (s, g) in enumerate(self.grams) if s == size]
            own.sort()
            self.codes[size] = (np.array([c for c, _ in own]), np.array([k for _, k in own]))

        pairs = [
            (self._code((a, b)), i, at)
            for i, words in enumerate(self.coded)
            if len(words) >= SHORT_ITEM
            for at, (a, b) in enumerate(zip(words.tolist(), words[1:].tolist()))
        ]
        table_of_pairs = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 3)
        self.pair_codes, first = np.unique(table_of_pairs[:, 0], return_index=True)
        self.pair_first = np.append(first, len(pairs))
        self.pair_item, self.pair_at = table_of_pairs[:, 1], table_of_pairs[:, 2]

    def _code(self, gram: tuple) -> int:
        code = 0
        for w in gram:
            code = code * (len(self.number) + 1) + w
        return code

    def segments(self, texts: pa.Array, overlap: int) -> Iterator[list[tuple[int, int, np.ndarray]]]:
        """Texts in groups: (row, number of the first word, numbers as ``coded_text`` gives them).

        A very long text comes as groups of one part each.
        """
        for first, last in groups(texts):
            if last == first + 1 and len(text := texts[first].as_py()) > _PART:
                for before, words in _parts(text, overlap):
                    yield [(first, before, self.coded_text(words))]
                continue
            words, at, edges = numbered_words(texts.slice(first, last - first), _words_of_chunks)
            coded = self.coded_text(words)[at]
            yield [(first + k, 0, coded[lo:hi]) for k, (lo, hi) in enumerate(zip(edges[:-1], edges[1:]))]

    def coded_text(self, words: list[str]) -> np.ndarray:
        """Each word's number; -1 for words that no item has."""
        numbers = map(self.number.get, words, repeat(-1))
        return np.fromiter(numbers, dtype=np.int64, count=len(words))

    def hits(self, coded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Seeds that occur in a text: (place, seed's number)."""
        places, found = [], []
        known = coded >= 0
        for size, (codes, numbers) in self.codes.items():
            if len(coded) < size:
                continue
            last = len(coded) - size + 1
            run = known[:last].copy()
            for j in range(1, size):
                run &= known[j : last + j]
            at = np.flatnonzero(run)
            code = np.zeros(len(at), dtype=np.int64)
            for j in range(size):
                code = code * (len(self.number) + 1) + coded[at + j]
            spot = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            same = codes[spot] == code
            places.append(at[same])
            found.append(numbers[spot[same]])
        if not places:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate(places), np.concatenate(found)

    def items_of(self, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every place in an item of each seed: (which of ``seeds``, item, place in the item)."""
        n = self.place_first[seeds + 1] - self.place_first[seeds]
        rows = np.repeat(self.place_first[seeds] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(np.arange(len(seeds)), n), self.place_item[rows], self.place_at[rows]

    def crowded(
        self, coded: np.ndarray, enough: np.ndarray, span: np.ndarray, begins: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where ``enough`` pairs of an item lie within ``span`` words of one segment.

        (place, item, where the item would begin) of these pairs; segments start at ``begins``.
        """
        items, places, ats = [], [], []
        for step in (1, 2):
            left, right = coded[:-step], coded[step:]
            at = np.flatnonzero((left >= 0) & (right >= 0))
            if not len(at) or not len(self.pair_codes):
                continue
            code = left[at] * (len(self.number) + 1) + right[at]
            spot = np.minimum(np.searchsorted(self.pair_codes, code), len(self.pair_codes) - 1)
            same = self.pair_codes[spot] == code
            at, spot = at[same], spot[same]
            n = self.pair_first[spot + 1] - self.pair_first[spot]
            rows = np.repeat(self.pair_first[spot] - np.cumsum(n) + n, n) + np.arange(n.sum())
            items.append(self.pair_item[rows])
            places.append(np.repeat(at, n))
            ats.append(self.pair_at[rows])
        if not items:
            return (np.zeros(0, dtype=np.int64),) * 3
        item, place, at = (np.concatenate(c) for c in (items, places, ats))
        many = (np.bincount(item, minlength=len(enough)) >= enough)[item]
        item, place, at = item[many], place[many], at[many]
        order = np.lexsort((place, item))
        item, place, at = item[order], place[order], at[order]
        first = np.arange(len(item))
        last = first + enough[item] - 1
        inside = last < len(item)
        first, last = first[inside], last[inside]
        near = (item[first] == item[last]) & (place[last] - place[first] < span[item[first]])
        segment = np.searchsorted(begins, place, side="right")
        near &= segment[first] == segment[last]
        edges = np.zeros(len(item) + 1, dtype=np.int64)
        np.add.at(edges, first[near], 1)
        np.add.at(edges, last[near] + 1, -1)
        crowd = np.cumsum(edges[:-1]) > 0
        return place[crowd], item[crowd], (place - at)[crowd]


def _enough(size: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """How many pairs an alignment at ``threshold`` has at least, and how many words of text it spans.

    With M words matched, E changed or left out and I put in, 2M - E - I is at
    least 2 * threshold * size and M + E at most size, so E is at most two thirds
    of (1 - threshold) * size. Of the M - 1 steps from match to match, E and I
    spoil at most E + I / 2, which leaves (threshold - (1 - threshold) / 3) * size - 1.
    """
    pairs = np.ceil(size * (threshold - (1 - threshold) / 3) - 1 - 1e-9)
    return np.maximum(pairs, 1).astype(np.int64), np.ceil(size * (3 - 2 * threshold)).astype(np.int64)


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two coded word lists: (score, first, last+1 in ``text``)."""
    size = len(text)
    step = np.arange(1, size + 1) * -GAP
    row = np.zeros(size + 1, dtype=np.int64)
    begin = np.arange(size + 1)  # where the alignment that ends here begins
    best, lo, hi = 0, 0, 0
    for word in item:
        down, down_begin = row[1:] + GAP, begin[1:]
        slant = row[:-1] + np.where(text == word, MATCH, MISMATCH)
        take = slant >= down
        value, origin = np.where(take, slant, down), np.where(take, begin[:-1], down_begin)
        fresh = value <= 0
        value, origin = np.where(fresh, 0, value), np.where(fresh, np.arange(1, size + 1), origin)
        # Gaps along the row: the best earlier value less its distance.
        level = value + step
        top = np.maximum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == top, np.arange(size), 0))
        row = np.concatenate([[0], top - step])
        begin = np.concatenate([[0], origin[source]])
        at = int(row.argmax())
        if row[at] > best:
            best, lo, hi = int(row[at]), int(begin[at]), at
    return best, lo, hi


def _parts(text: str, overlap: int) -> Iterator[tuple[int, list[str]]]:
    """(number of the first word, words) of parts of a text that overlap by ``overlap`` words."""
    held: list[str] = []
    before = at = 0
    while True:
        end = at + _PART
        cut = re.compile(r"\W").search(text, end) if end < len(text) else None
        stop = cut.start() if cut else len(text)
        held += words_of(text[at:stop])
        yield before, held
        if stop >= len(text):
            return
        before += max(0, len(held) - overlap)
        held, at = held[-overlap:], stop


class Reach:
    """Whether the item's words that are in a stretch of text at all could give the threshold."""

    def __init__(self, seeds: Seeds, threshold: float):
        self.items, self.threshold = seeds.coded, threshold
        self.present = np.zeros(len(seeds.number) + 1, dtype=bool)  # the last is for words of no item

    def __call__(self, item: int, window: np.ndarray) -> bool:
        words = self.items[item]
        self.present[window] = True
        share = np.count_nonzero(self.present[words]) / len(words)
        self.present[window] = False
        return share >= self.threshold


FOUND = pa.schema([
    ("seed", pa.int32()), ("n", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64()), ("item", pa.int32()),
    ("windows", pa.list_(pa.struct([
        ("first", pa.int64()), ("words", pa.binary()), ("starts", pa.binary()), ("seeds", pa.binary())
    ]))),
])
FOUND_SQL = (
    "seed int, n long, doc_id long, th long, item int, "
    "windows array<struct<first:long,words:binary,starts:binary,seeds:binary>>"
)


def _search(seeds: Seeds, threshold: float):
    """(doc_id, th, text) -> places to align, and how many texts have each seed.

    A row with ``seed`` counts texts (the last seed all of them), combined within the
    task; the others hold the stretches of one text that may align with one item: the
    first word's number, the words, where the item would begin and the seed that says
    so (-1 for crowded pairs), as 32-bit numbers.
    """
    sizes = np.array([len(i) for i in seeds.items])
    enough, span = _enough(sizes, threshold)
    overlap = 4 * int(sizes.max(initial=0)) + 64
    reach = Reach(seeds, threshold)

    def places(segments: list[tuple[int, int, np.ndarray]], total: np.ndarray, seen: dict, out: dict) -> None:
        """Adds what the segments hold to ``total`` and to ``out``: (row, item) -> windows.

        ``seen`` holds the seeds that the last row's parts have had already.
        """
        rows = np.array([row for row, _, _ in segments])
        length = np.array([len(coded) for _, _, coded in segments])
        begins = np.cumsum(length + 2) - length - 2
        whole = np.full(int(length.sum()) + 2 * len(segments), -1, dtype=np.int64)  # two strangers between segments
        for begin, (_, _, coded) in zip(begins, segments):
            whole[begin : begin + len(coded)] = coded
        at, seed = seeds.hits(whole)
        row = rows[np.searchsorted(begins, at, side="right") - 1]
        seed_of = np.unique(np.stack([row, seed]), axis=1)[1]
        if len(segments) == 1:
            had = seen.get(int(rows[0]), seed_of[:0])
            seed_of = np.setdiff1d(seed_of, had)
            seen.clear()
            seen[int(rows[0])] = np.concatenate([had, seed_of])
        np.add.at(total, seed_of, 1)
        which, item, inside = seeds.items_of(seed)
        place, crowd, start = seeds.crowded(whole, enough, span, begins)
        segment = np.searchsorted(begins, np.concatenate([at[which], place]), side="right") - 1
        item, start = np.concatenate([item, crowd]), np.concatenate([at[which] - inside, start]) - begins[segment]
        by = np.concatenate([seed[which], np.full(len(crowd), -1)])
        order = np.lexsort((start, item, segment))
        segment, item, start, by = segment[order], item[order], start[order], by[order]
        edges = np.flatnonzero(np.diff(segment, prepend=-1) | np.diff(item, prepend=-1))
        for lo, hi in zip(edges.tolist(), [*edges[1:].tolist(), len(item)]):
            row, before, coded = segments[segment[lo]]
            i, starts = int(item[lo]), start[lo:hi]
            for a, b in _windows(starts.tolist(), len(seeds.coded[i]), len(coded)):
                if reach(i, coded[a:b]):
                    near = (starts > a - 2 * sizes[i] - 8) & (starts < b)
                    out.setdefault((row, i), []).append({
                        "first": before + a, "words": coded[a:b].astype("<i4").tobytes(),
                        "starts": (starts[near] - a).astype("<i4").tobytes(),
                        "seeds": by[lo:hi][near].astype("<i4").tobytes(),
                    })

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(seeds.grams) + 1, dtype=np.int64)  # the last counts texts
        for batch in batches:
            total[-1] += batch.num_rows
            out: dict[tuple[int, int], list[dict]] = {}
            seen: dict[int, np.ndarray] = {}
            for segments in seeds.segments(batch.column("text"), overlap):
                places(segments, total, seen, out)
            ids, hashes = batch.column("doc_id").to_pylist(), batch.column("th").to_pylist()
            found = [
                {"doc_id": ids[row], "th": hashes[row], "item": item, "windows": windows}
                for (row, item), windows in out.items()
            ]
            if found:
                yield pa.RecordBatch.from_pylist(found, FOUND)
        seen = np.flatnonzero(total).tolist()
        yield pa.RecordBatch.from_pylist([{"seed": k, "n": int(total[k])} for k in seen], FOUND)
        give_back()

    return search


def _best(seeds: Seeds, rare: np.ndarray, threshold: float):
    """(doc_id, th, item, windows) -> the best alignment, where it reaches ``threshold``."""
    reach = Reach(seeds, threshold)

    def align_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, th, item, windows in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "item", "windows"))):
                words, best = seeds.coded[item], (0.0, 0, 0)
                for window in windows:
                    text, starts, by = (np.frombuffer(window[k], "<i4").astype(np.int64) for k in ("words", "starts", "seeds"))
                    starts = starts[(by < 0) | rare[by]]
                    for lo, hi in _windows(starts.tolist(), len(words), len(text)):
                        if reach(item, text[lo:hi]):
                            score, a, b = align(words, text[lo:hi])
                            share = score / (MATCH * len(words))
                            if share > best[0]:
                                best = share, window["first"] + lo + a, window["first"] + lo + b
                if best[0] >= threshold:
                    out.append((doc, th, item, *best))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                    ["doc_id", "th", "item", "score", "first_word", "last_word"],
                )

    return align_all


def _windows(starts: list[int], size: int, end: int) -> list[tuple[int, int]]:
    """Stretches of a text to align with an item that seeds place at ``starts``; overlaps joined.

    Half the item's length to each side leaves room for inserted words. A stretch that
    grows too long is cut, and the next begins twice the item's length before the cut,
    more than any alignment at half of a perfect score spans.
    """
    room = size // 2 + 4
    out: list[list[int]] = []
    for start in sorted(starts):
        lo, hi = max(0, start - room), min(end, start + size + room)
        if not out or lo > out[-1][1]:
            out.append([lo, hi])
        elif hi - out[-1][0] <= 8 * size + 64:
            out[-1][1] = max(hi, out[-1][1])
        else:
            out.append([max(out[-1][0], min(lo, out[-1][1] - 2 * size)), hi])
    return [(lo, hi) for lo, hi in out]


def _rare(seeds: Seeds, counts: dict[int, int], total: int) -> np.ndarray:
    """Which seeds are rare enough for at least one item they occur in."""
    of_item: dict[int, list[int]] = {}
    for seed, places in enumerate(seeds.places):
        for item in {i for i, _ in places}:
            of_item.setdefault(item, []).append(seed)
    rare = np.zeros(len(seeds.grams), dtype=bool)
    for own in of_item.values():
        n = np.array([counts.get(s, 0) for s in own])
        usual = COMMON_TIMES * np.quantile(n, 0.75)
        rare[np.array(own)[n <= max(usual, COMMON_SHARE * total, 1)]] = True
    return rare


def contaminated(
    docs: DataFrame, items: DataFrame, n: int = SEED_WORDS, threshold: float = THRESHOLD
) -> DataFrame:
    """(doc_id, th, item_id, score, first_word, last_word): texts of ``docs`` that hold test items.

    ``items`` has (item_id, text); equal items are compared once and reported each.
    Null or wordless items and texts match nothing. A row that repeats in ``docs``
    is reported as often. A null doc_id or item_id stays null. Empty tables give
    no rows; further columns are ignored. ``first_word`` and ``last_word`` count
    the text's words from 0; ``last_word`` is one past the end.
    """
    spark = docs.sparkSession
    text = texts(docs)
    known = items.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text IS NOT NULL")
    key = F.sha2("text", 256)
    different = known.select("text").distinct()
    size = different.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    out = None
    for block in range(blocks):
        own = different.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        groups_of: dict[tuple, list[str]] = {}
        for t, k in own.select("text", key).collect():  # about BLOCK_BYTES
            if words := tuple(words_of(t)):
                groups_of.setdefault(words, []).append(k)
        if not groups_of:
            continue
        ordered = sorted(groups_of)
        seeds = Seeds([list(w) for w in ordered], n)
        places = written(text.mapInArrow(_search(seeds, threshold), FOUND_SQL))
        counts = places.where("seed IS NOT NULL").groupBy("seed").agg(F.sum("n").alias("n"))
        totals = dict(counts.collect())  # one row a seed
        rare = _rare(seeds, totals, totals.get(len(seeds.grams), 0))
        found = places.where("seed IS NULL").select("doc_id", "th", "item", "windows").mapInArrow(
            _best(seeds, rare, threshold),
            "doc_id long, th long, item int, score double, first_word long, last_word long",
        )
        keys = spark.createDataFrame(
            [(i, k) for i, w in enumerate(ordered) for k in groups_of[w]], "item int, key string"
        )
        ids = known.select("item_id", key.alias("key")).join(F.broadcast(keys), "key").drop("key")
        part = found.join(ids, "item").select(
            "doc_id", "th", "item_id", "score", "first_word", "last_word"
        )
        out = part if out is None else out.union(part)
    if out is None:
        return spark.createDataFrame(
            [], "doc_id long, th long, item_id long, score double, first_word long, last_word long"
        )
    return out


def without_items(
    docs: DataFrame, items: DataFrame, n: int = SEED_WORDS, threshold: float = THRESHOLD
) -> DataFrame:
    """``docs`` without the rows that hold a test item; all columns stay."""
    rows = keyed_rows(docs)
    found = contaminated(docs, items, n, threshold).select("doc_id", "th").distinct()
    return rows.join(found, same_row(rows, found), "left_anti").select("_row.*")
