"""Language identification: sparse multinomial logistic regression on character n-grams.

Features are the character 1-, 2- and 3-grams of the whole lower-cased text,
hashed into ``BUCKETS`` counts, weighted by TF-IDF and scaled to length one. The
document frequencies behind the IDF cover every learnable document. The weights
are learned from a bounded sample of labelled rows by follow-the-regularised-
leader (per-coordinate steps, L1 for sparsity, L2 for size): a fixed number of
shards learn side by side and their states are averaged after every epoch. A
part of the sample is left out of that and sets the temperature, a single number
that scales the logits so that the scores are probabilities one can trust. The
sample of a large table has languages more evenly than the table; what it has too
much of a language is taken off its logit, so that scores mean the same at any size.

The model has ``BUCKETS`` x languages numbers, and the languages are at most the
sample's rows, so what travels to the executors is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm.frames import ROW, crc_of_id, read_table, texts, written

BUCKETS = 1 << 14
SAMPLE = 6_000  # labelled rows the weights and the temperature are fitted on, at most
SHARDS = 6
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2e-3, 1e-4  # step size and penalties
UNKNOWN = "und"
REJECT_BELOW = 0.5  # the filter drops texts whose best language is less likely than this

_PART = 1 << 20  # characters taken at a time
_LETTER = regex.compile(r"\p{L}")


def grams(text: str, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's character n-grams, and how often each occurs."""
    low, counts = text.lower(), np.zeros(buckets, dtype=np.int64)
    for start in range(0, len(low), _PART):
        part = low[start : start + _PART + 2]
        own = min(_PART, len(part))  # n-grams that begin here; the next part has the others
        code = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        code = code + np.uint64(1)
        rolling = np.zeros(len(code), dtype=np.uint64)
        for n in range(3):
            if len(code) <= n:
                break
            rolling = rolling[: len(code) - n] * np.uint64(0x100000001B3) + code[n:]
            mixed = rolling[:own] * np.uint64(0x9E3779B97F4A7C15)
            counts += np.bincount((mixed >> np.uint64(40)).astype(np.int64) % buckets, minlength=buckets)
    index = np.flatnonzero(counts)
    return index, counts[index]


@dataclass
class Model:
    """What a prediction needs; ``weights`` is buckets x languages."""

    languages: list[str]
    weights: np.ndarray
    idf: np.ndarray
    temperature: float
    shift: np.ndarray | float = 0.0  # log of how many rows a sampled row of each language stands for

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        index, count = grams(text, len(self.idf))
        return index, _scaled(count, self.idf[index])

    def predict(self, text: str) -> tuple[str, float]:
        """The likeliest language and its probability; ``und`` with 0 if there is no letter."""
        if not self.languages or not _LETTER.search(text):
            return UNKNOWN, 0.0
        index, value = self.features(text)
        share = _softmax(value @ self.weights[index] / self.temperature + self.shift)
        best = int(share.argmax())  # ties go to the first language in order
        return self.languages[best], float(share[best])


def _scaled(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    value = (1 + np.log(count)) * idf
    size = np.sqrt((value * value).sum())
    return value / size if size else value


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def document_frequencies(text: DataFrame, buckets: int) -> tuple[int, np.ndarray]:
    """How many texts there are, and in how many each bucket occurs; over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, found = 0, np.zeros(buckets + 1, dtype=np.int64)
        for batch in batches:
            for t in batch.column("text"):
                found[grams(t.as_py(), buckets)[0]] += 1
                total += 1
        found[buckets] = total
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(buckets + 1)), pa.array(found)], ["bucket", "n"]
        )

    rows = (
        text.select("text")
        .mapInArrow(count, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .collect()  # buckets + 1 rows, whatever the corpus size
    )
    table = np.zeros(buckets + 1, dtype=np.int64)
    for bucket, n in rows:
        table[bucket] = n
    return int(table[buckets]), table[:buckets]


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """FTRL's weights from its state: zero where the L1 penalty holds."""
    step = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    return np.where(np.abs(z) <= L1, 0.0, step)


def _learn(rows: pd.DataFrame, z: np.ndarray, n: np.ndarray, idf: np.ndarray) -> None:
    """One pass of FTRL over a shard's rows; changes z and n."""
    for index, count, label in zip(rows["index"], rows["count"], rows["label"]):
        index = np.asarray(index)
        value = _scaled(np.asarray(count), idf[index])
        w = _weights(z[index], n[index])
        share = _softmax(value @ w)
        share[label] -= 1.0
        slope = value[:, None] * share[None, :]
        before = n[index]
        after = before + slope * slope
        z[index] += slope - (np.sqrt(after) - np.sqrt(before)) / ALPHA * w
        n[index] = after


def _epoch(z: np.ndarray, n: np.ndarray, idf: np.ndarray, epoch: int):
    """One shard's pass from the given state, in an order that depends on the epoch alone."""

    def learn(shard: pd.DataFrame) -> pd.DataFrame:
        own_z, own_n = z.copy(), n.copy()
        shard = shard.sort_values("doc_id").sample(frac=1.0, random_state=epoch)
        _learn(shard, own_z, own_n, idf)
        return pd.DataFrame({"z": [own_z.tobytes()], "n": [own_n.tobytes()]})

    return learn


def fit(
    docs: DataFrame, learnable: Column, buckets: int = BUCKETS, sample: int = SAMPLE
) -> Model:
    """A model from the rows of ``docs`` (doc_id, text, lang) for which ``learnable`` holds.

    The sample takes languages in turn, each in the order of a hash of doc_id, so
    that rare ones are in it. Without labelled rows the model knows no language.
    """
    usable = docs.where(learnable).where("lang IS NOT NULL AND text IS NOT NULL")
    total, frequency = document_frequencies(texts(usable), buckets)
    idf = np.log((1 + total) / (1 + frequency)) + 1

    order = F.xxhash64("doc_id")
    turn = Window.partitionBy("lang").orderBy(order, "doc_id")
    known = written(usable.select(F.col("doc_id").cast("long").alias("doc_id"), "lang").distinct())
    picked = (
        known.withColumn("turn", F.row_number().over(turn))
        .where(F.col("turn") <= sample)
        .orderBy("turn", order, "lang")
        .limit(sample)
        .select("doc_id", "lang", (F.pmod(order, F.lit(SHARDS + 1))).alias("shard"))
    )
    picked = written(picked)
    taken = dict(picked.groupBy("lang").agg(F.count("*")).collect())  # <= sample
    languages = sorted(taken)
    if not languages:
        return Model([], np.zeros((buckets, 0)), idf, 1.0)
    every = dict(
        known.groupBy("lang")
        .agg(F.count("*"))
        .join(F.broadcast(picked.select("lang").distinct()), "lang")
        .collect()  # <= sample
    )
    shift = np.log([every[lang] / taken[lang] for lang in languages])
    number = {lang: i for i, lang in enumerate(languages)}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [grams(t.as_py(), buckets) for t in batch.column("text")]
            labels = [number[v.as_py()] for v in batch.column("lang")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("shard"),
                    batch.column("doc_id"),
                    pa.array([f[0] for f in found], pa.list_(pa.int64())),
                    pa.array([f[1] for f in found], pa.list_(pa.int64())),
                    pa.array(labels, pa.int32()),
                ],
                ["shard", "doc_id", "index", "count", "label"],
            )

    rows = written(
        usable.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"), "lang")
        .join(F.broadcast(picked), ["doc_id", "lang"])  # at most ``sample`` rows
        .select("shard", "doc_id", "text", "lang")
        .mapInArrow(
            features, "shard long, doc_id long, index array<long>, count array<long>, label int"
        )
    )
    shape = (buckets, len(languages))
    z, n = np.zeros(shape), np.zeros(shape)
    for epoch in range(EPOCHS):
        states = (
            rows.where(F.col("shard") < SHARDS)
            .groupBy("shard")
            .applyInPandas(_epoch(z, n, idf, epoch), "z binary, n binary")
            .collect()  # one state of fixed size from each of SHARDS shards
        )
        if not states:
            break
        z = np.mean([np.frombuffer(s.z).reshape(shape) for s in states], axis=0)
        n = np.mean([np.frombuffer(s.n).reshape(shape) for s in states], axis=0)
    weights = _weights(z, n)

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for index, count in zip(batch.column("index"), batch.column("count")):
                at = np.asarray(index.as_py(), dtype=np.int64)
                value = _scaled(np.asarray(count.as_py(), dtype=np.float64), idf[at])
                out.append((value @ weights[at]).tolist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.list_(pa.float64())), batch.column("label")], ["logits", "label"]
            )

    held = (
        rows.where(F.col("shard") == SHARDS)
        .select("index", "count", "label")
        .mapInArrow(logits, "logits array<double>, label int")
        .collect()  # at most ``sample`` rows
    )
    return Model(languages, weights, idf, _temperature(held, shift), shift)


def _temperature(held: list, shift: np.ndarray) -> float:
    """What the logits are divided by so that left-out labels are likeliest (golden section).

    A row weighs as many rows as it stands for.
    """
    if not held:
        return 1.0
    logits = np.array([r.logits for r in held])
    labels = np.array([r.label for r in held])

    weight = np.exp(shift)[labels]

    def loss(log_t: float) -> float:
        share = _softmax(logits / np.exp(log_t) + shift)
        return -np.average(np.log(np.maximum(share[np.arange(len(labels)), labels], 1e-300)), weights=weight)

    lo, hi, ratio = np.log(0.02), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = hi - ratio * (hi - lo), lo + ratio * (hi - lo)
        lo, hi = (lo, b) if loss(a) <= loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def _predictor(model: Model):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("doc_id", "th")),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                ["doc_id", "th", "lang_pred", "score"],
            )

    return predict


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, th, lang_pred, score) for every row of ``docs`` (doc_id, text).

    Null texts and texts without a letter are ``und`` with score 0, and so is
    everything under a model that knows no language. Repeated rows get equal
    predictions; a null doc_id stays null; an empty table gives no rows; further
    columns, ``lang`` and ``source`` too, are not looked at.
    """
    return texts(docs).mapInArrow(
        _predictor(model), "doc_id long, th long, lang_pred string, score double"
    )


def not_held_out() -> Column:
    """The rows a model may learn from: crc32(doc_id) mod 3 is not 1."""
    return F.coalesce(crc_of_id() % 3 != 1, F.lit(False))


def accepted(docs: DataFrame, model: Model, reject_below: float = REJECT_BELOW) -> DataFrame:
    """``docs`` without the rows that have no letter or no language of at least that probability."""
    text = F.coalesce(F.col(f"{ROW}.text").cast("string"), F.lit(""))

    @F.pandas_udf("boolean")
    def likely(text: pd.Series) -> pd.Series:
        return text.map(lambda t: model.predict(t)[1] >= reject_below).astype(bool)

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW))
    return rows.where(likely(text)).select(f"{ROW}.*")


def fit_documents(spark, sf_dir: str) -> Model:
    """The model of the folder's ``documents``."""
    return fit(read_table(spark, sf_dir, "documents"), not_held_out())
