"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lower-cases, composes accents, takes invisible characters out, maps
look-alike letters of other scripts and digits or signs inside words to the
letters they stand for, and leaves one space between words. The lexicon's entries are whole words and beginnings of
words; each has a weight, the log-odds of label 1 among the labelled texts that
have it. Exception phrases, two words of which one is an entry, take their
entry's weight back: those that only untroubled texts use. A text's weight is
divided by a measure of its length, and a two-number logistic curve, fitted on
the labelled rows, turns that into a score.

Document counts of words and beginnings are aggregated by Spark over a bounded
sample of labelled rows; the lexicon is bounded too, so it can travel. The sample
has both labels in equal numbers on large tables; in the curve each label weighs
as often as it occurs in all labelled rows, so that scores mean the same at any size.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm.frames import crc_of_id, texts, written

SAMPLE = 12_000  # labelled rows the lexicon and the curve are learned from, at most
CANDIDATES = 4_000  # entries looked at, at most
LEXICON = 400  # entries kept, at most
EXCEPTIONS = 400  # exception phrases, at most
SHORTEST = 4  # letters of the shortest entry
LEAST = 4  # toxic sample texts an entry must occur in
ODDS = 4.0  # how much more frequent an entry must be in toxic texts
SHORT_TEXT = 50  # words added to every length, so that one hit in a line is no certainty
THRESHOLD = 0.3

_PART = 1 << 20

# Fixed: letters of other scripts that look like Latin ones, and what digits and signs stand for.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "з": "3", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h",
    "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "ѕ": "s", "ԁ": "d", "ԛ": "q",
    "ԝ": "w", "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g",
}
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}

_HOMOGLYPHS = str.maketrans(HOMOGLYPHS)
_DIGITS = str.maketrans(DIGITS)
_IGNORED = regex.compile(r"\p{Cf}+")
# A digit or sign is a letter's stand-in only right beside a letter.
_LEET = regex.compile(r"(?:\p{L}[0-9@$]*|[0-9@$]+(?=\p{L}))+")
_REST = regex.compile(r"[^\p{L}\p{M}]+")
_MARK = regex.compile(r"[0-9@$]")
_SPACE = regex.compile(r"\s")


def fold(text: str) -> str:
    """The words of a text as plain letters, each with one space before and after."""
    if not text.isascii():
        text = _IGNORED.sub("", unicodedata.normalize("NFKC", text)).lower().translate(_HOMOGLYPHS)
    else:
        text = text.lower()
    text = _LEET.sub(lambda m: m[0].translate(_DIGITS), text) if _MARK.search(text) else text
    return f" {_REST.sub(' ', text).strip()} "


def _folded(text: str) -> Iterator[str]:
    """Folded parts of a text, cut at white space if it is very long."""
    at = 0
    while len(text) - at > _PART:
        cut = _SPACE.search(text, at + _PART)
        if not cut:
            break
        yield fold(text[at : cut.start()])
        at = cut.end()
    yield fold(text[at:])


@dataclass
class Lexicon:
    """Entries begin with a space; a whole word also ends with one."""

    weights: dict[str, float]
    exceptions: list[str] = field(default_factory=list)
    slope: float = 1.0
    shift: float = 0.0

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight, False))
        for phrase in self.exceptions:
            found.add_word(f" {phrase} ", (len(phrase) + 2, 0.0, True))
        if len(found):
            found.make_automaton()
        return found

    def feature(self, text: str, automaton: ahocorasick.Automaton) -> float:
        """Weight of the words that have an entry for each 1000 words, as a logarithm.

        A word counts once, with its heaviest entry; one inside an exception
        phrase does not count.
        """
        total, words = 0.0, 0
        for part in _folded(text):
            words += max(0, part.count(" ") - 1)
            if not len(automaton):
                continue
            heaviest: dict[int, float] = {}  # where a word begins -> weight
            excused: list[tuple[int, int]] = []
            for end, (size, weight, exception) in automaton.iter(part):
                start = end - size + 1
                if exception:
                    excused.append((start, end))
                elif weight > heaviest.get(start, 0.0):
                    heaviest[start] = weight
            total += sum(
                w for at, w in heaviest.items() if not any(lo <= at < hi for lo, hi in excused)
            )
        return math.log1p(1000.0 * total / (words + SHORT_TEXT))

    def score(self, feature: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-700.0, min(700.0, self.slope * feature + self.shift))))


def sample_of(docs: DataFrame, labels: DataFrame, learnable: Column, size: int) -> DataFrame:
    """(doc_id, th, text, toxic, weight): at most ``size`` labelled rows, both labels in turn.

    ``weight`` is how many labelled rows a row of its label stands for: 1 as long
    as the sample is all of them.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("toxic IN (0, 1)")
        .where(learnable)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))  # a row marked both ways is marked
    )
    order = F.xxhash64("doc_id")
    turn = Window.partitionBy("toxic").orderBy(order, "doc_id")
    picked = (
        known.withColumn("turn", F.row_number().over(turn))
        .where(F.col("turn") <= size)
        .orderBy("turn", order)
        .limit(size)
        .select("doc_id", "toxic")
    )
    picked = written(picked)
    every, taken = (
        {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}  # two labels
        for rows in (known, picked)
    )
    weight = F.when(F.col("toxic") == 1, F.lit(every.get(1, 0) / taken.get(1, 1))).otherwise(
        F.lit(every.get(0, 0) / taken.get(0, 1))
    )
    return texts(docs).join(F.broadcast(picked.withColumn("weight", weight)), "doc_id")  # at most ``size`` rows


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, sample: int = SAMPLE) -> Lexicon:
    """A lexicon and its curve from the labelled rows for which ``learnable`` holds.

    Without labelled rows of both kinds the lexicon is empty and scores are the
    share of label 1, or 0 without any.
    """
    rows = written(sample_of(docs, labels, learnable, sample))
    sizes = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return Lexicon({}, shift=20.0 if bad else -20.0)

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column("text"), batch.column("toxic")):
                words = {w for part in _folded(text.as_py()) for w in part.split()}
                found = {f" {w} " for w in words if len(w) >= SHORTEST}
                found.update(f" {w[:n]}" for w in words for n in range(SHORTEST, min(len(w), 8) + 1))
                for entry in found:
                    counts.setdefault(entry, [0, 0])[toxic.as_py()] += 1
                if len(counts) > 500_000:
                    yield from _counted(counts)
                    counts = {}
        yield from _counted(counts)

    odds = F.expr(f"((toxic + 0.5) / {bad + 1}) / ((clean + 0.5) / {good + 1})")
    best = (
        rows.select("text", "toxic")
        .mapInArrow(entries, "entry string, clean long, toxic long")
        .groupBy("entry")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(f"toxic >= {LEAST}")
        .withColumn("odds", odds)
        .where(F.col("odds") >= ODDS)
        .withColumn("gain", F.expr("toxic * ln(odds)"))
        .orderBy(F.desc("gain"), F.length("entry"), "entry")
        .limit(CANDIDATES)
        .collect()  # at most CANDIDATES rows
    )
    lexicon = Lexicon(_cover(rows, {r.entry: math.log(r.odds) for r in best}, bad / good))
    lexicon.exceptions = _exceptions(rows, lexicon)
    _curve(rows, lexicon)
    return lexicon


def _cover(rows: DataFrame, weights: dict[str, float], ratio: float) -> dict[str, float]:
    """The candidates that explain the toxic sample, one after the other.

    Each step takes the entry with the most toxic texts that no earlier entry is
    in, less twice the clean ones it is in (scaled to equal numbers of both). Entries
    that only go along with others, as in copies of one text, explain nothing new.
    """
    entries = list(weights)

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ahocorasick.Automaton()
        for i, entry in enumerate(entries):
            automaton.add_word(entry, i)
        automaton.make_automaton()
        for batch in batches:
            found = [
                sorted({i for part in _folded(t.as_py()) for _, i in automaton.iter(part)})
                for t in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int64())), batch.column("toxic")], ["found", "toxic"]
            )

    if not entries:
        return {}
    texts_of: list[set[int]] = [set() for _ in entries]
    clean = np.zeros(len(entries))
    # At most the sample's rows, each with candidates only.
    collected = rows.select("text", "toxic").mapInArrow(hits, "found array<long>, toxic int").collect()
    for row, (found, toxic) in enumerate(collected):
        for i in found:
            if toxic:
                texts_of[i].add(row)
            else:
                clean[i] += 1
    kept: dict[str, float] = {}
    explained: set[int] = set()
    while len(kept) < LEXICON:
        gains = [len(t - explained) - c * ratio * 2 for t, c in zip(texts_of, clean)]
        best = max(range(len(entries)), key=lambda i: (gains[i], -len(entries[i]), entries[i]))
        if gains[best] < LEAST / 2:
            return kept
        kept[entries[best]] = weights[entries[best]]
        explained |= texts_of[best]
    return kept


def _counted(counts: dict[str, list[int]]) -> Iterator[pa.RecordBatch]:
    if counts:
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(counts), pa.string()),
                pa.array([c[0] for c in counts.values()], pa.int64()),
                pa.array([c[1] for c in counts.values()], pa.int64()),
            ],
            ["entry", "clean", "toxic"],
        )


def _exceptions(rows: DataFrame, lexicon: Lexicon) -> list[str]:
    """Pairs of words with an entry that occur in LEAST or more clean texts and no toxic one."""

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column("text"), batch.column("toxic")):
                found = set()
                for part in _folded(text.as_py()):
                    starts = {end - size + 1 for end, (size, _, _) in automaton.iter(part)}
                    for at in starts:
                        after = part[at + 1 : at + 200].split(" ")[:2]
                        before = part[max(0, at - 200) : at].split(" ")[-1:]
                        found.update(" ".join(p) for p in (after, [*before, *after[:1]]) if all(p) and len(p) == 2)
                for phrase in found:
                    counts.setdefault(phrase, [0, 0])[toxic.as_py()] += 1
            yield from _counted(counts)

    if not lexicon.weights:
        return []
    best = (
        rows.select("text", "toxic")
        .mapInArrow(phrases, "entry string, clean long, toxic long")
        .groupBy("entry")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(f"toxic = 0 AND clean >= {LEAST}")
        .orderBy(F.desc("clean"), "entry")
        .limit(EXCEPTIONS)
        .collect()  # at most EXCEPTIONS rows
    )
    return [r.entry for r in best]


def _curve(rows: DataFrame, lexicon: Lexicon) -> None:
    """Fits slope and shift of the logistic curve, both labels weighing as they occur in all labelled rows."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            found = [lexicon.feature(t.as_py(), automaton) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.float64()), batch.column("toxic"), batch.column("weight")],
                ["x", "toxic", "weight"],
            )

    found = (
        rows.select("text", "toxic", "weight")
        .mapInArrow(features, "x double, toxic int, weight double")
        .collect()
    )
    weight = np.array([r.weight for r in found])
    weight *= len(weight) / weight.sum()  # the penalty stays as small for any table
    x, y = np.array([r.x for r in found]), np.array([r.toxic for r in found], dtype=float)
    w = np.zeros(2)
    design = np.stack([x, np.ones_like(x)], axis=1)
    penalty = np.array([1e-3, 1e-3])  # keeps a perfect split from running away
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (weight * (p - y)) + penalty * w
        bend = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(penalty)
        step = np.linalg.solve(bend, slope)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    lexicon.slope, lexicon.shift = float(max(w[0], 0.0)), float(w[1])


def scores(docs: DataFrame, lexicon: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, th, score, predicted) for every row of ``docs`` (doc_id, text), from text alone.

    Null and empty texts have no weight and get the curve's lowest score.
    Repeated rows get equal scores; a null doc_id stays null; an empty table gives
    no rows; further columns are not looked at.
    """

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = lexicon.automaton()
        for batch in batches:
            found = [lexicon.score(lexicon.feature(t.as_py(), automaton)) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "th")),
                    pa.array(found, pa.float64()),
                    pa.array([int(s >= threshold) for s in found], pa.int32()),
                ],
                ["doc_id", "th", "score", "predicted"],
            )

    return texts(docs).mapInArrow(rate, "doc_id long, th long, score double, predicted int")


def held_out() -> Column:
    """Rows that labels are not learned from: crc32(doc_id) mod 4 is 2."""
    return F.coalesce(crc_of_id() % 4 == 2, F.lit(False))
