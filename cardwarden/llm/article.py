"""Main text of web pages: a recurrent network labels every block of a page.

A page is a sequence of leaf blocks (``blocks``). A bidirectional LSTM in numpy reads
each block's hashed tag path and hashed words, forwards and backwards over the whole
page, and says which blocks belong to the article, so that a block is judged by what
stands anywhere before and after it. The article's blocks, in the order of the page,
with a line feed between them, are the text.

The network is trained here, on ``PAGES`` pages that ``layouts`` makes up from a seed
(no page of the table has labels): articles in many containers, with and without
telling tags and classes, among menus, headers, footers, sidebars, notices, adverts,
forms and reader comments. That bound is a parameter and does not depend on the table.

Every page is labelled by itself in any task. Pages are read in groups of about
``CELLS`` blocks; a longer page is read in steps of so many blocks, and only the
network's states are kept for all of it. A null page, and a page without an article,
gives an empty text; rows that repeat an id are pages of their own; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm import layouts
from cardwarden.llm.blocks import FIGURES, PATH, WORDS, Block, blocks, features

PAGES = 2_500  # made-up pages the network learns from
HIDDEN = 24  # states of the network in each direction
CELLS = 8_192  # blocks read at a time
INPUTS = PATH + WORDS + FIGURES
SIDES = ("f", "b")  # forwards, backwards


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _start(rng: np.random.Generator) -> dict[str, np.ndarray]:
    def spread(*shape: int) -> np.ndarray:
        return rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

    made = {"out": spread(2 * HIDDEN), "skip": spread(INPUTS) * 0.1, "bias": np.zeros(1, np.float32)}
    for side in SIDES:
        made |= {f"x{side}": spread(INPUTS, 4 * HIDDEN), f"h{side}": spread(HIDDEN, 4 * HIDDEN)}
        made[f"a{side}"] = np.zeros(4 * HIDDEN, np.float32)
        made[f"a{side}"][HIDDEN : 2 * HIDDEN] = 1  # remember at first
    return made


def _steps(net: dict, side: str, x: np.ndarray, live: np.ndarray, state: tuple, keep: list | None = None) -> tuple:
    """The hidden states of one side over x (time, page, inputs); ``live`` marks real blocks.

    Returns them with the state after the last step; ``keep`` collects what training needs.
    """
    given = x @ net[f"x{side}"] + net[f"a{side}"]
    hidden = np.zeros((len(x), x.shape[1], HIDDEN), np.float32)
    h, c = state
    order = range(len(x)) if side == "f" else range(len(x) - 1, -1, -1)
    for t in order:
        gates = given[t] + h @ net[f"h{side}"]
        ifo, g = _sigmoid(gates[:, : 3 * HIDDEN]), np.tanh(gates[:, 3 * HIDDEN :])
        i, f, o = np.split(ifo, 3, axis=1)
        before = h, c
        c = (f * c + i * g) * live[t][:, None]
        squashed = np.tanh(c)
        h = o * squashed * live[t][:, None]
        hidden[t] = h
        if keep is not None:
            keep.append((t, before, i, f, o, g, squashed))
    return hidden, (h, c)


def _zero(pages: int) -> tuple:
    return np.zeros((pages, HIDDEN), np.float32), np.zeros((pages, HIDDEN), np.float32)


def _back(net: dict, side: str, x: np.ndarray, live: np.ndarray, keep: list, wanted: np.ndarray, grads: dict) -> None:
    """Gradients of one side, from those of its hidden states (``wanted``)."""
    dh, dc = _zero(x.shape[1])
    d_gates = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
    for t, (h0, c0), i, f, o, g, squashed in reversed(keep):
        on = live[t][:, None]
        dh = (dh + wanted[t]) * on
        dc = (dc + dh * o * (1 - squashed**2)) * on
        d = np.concatenate(
            [dc * g * i * (1 - i), dc * c0 * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1
        )
        d_gates[t] = d
        grads[f"h{side}"] += h0.T @ d
        dh, dc = d @ net[f"h{side}"].T, dc * f
    flat = d_gates.reshape(-1, 4 * HIDDEN)
    grads[f"x{side}"] += x.reshape(-1, INPUTS).T @ flat
    grads[f"a{side}"] += flat.sum(0)


def _padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    x = np.zeros((max(map(len, rows)), len(rows), rows[0].shape[1]), np.float32)
    live = np.zeros(x.shape[:2], np.float32)
    for k, row in enumerate(rows):
        x[: len(row), k], live[: len(row), k] = row, 1
    return x, live


@lru_cache(maxsize=4)
def fit(pages: int = PAGES, rounds: int = 7, seed: int = 11) -> dict[str, np.ndarray]:
    """The network, trained with Adam on ``pages`` made-up pages."""
    rng = np.random.default_rng(seed)
    net = _start(rng)
    made = [blocks(page, layouts.MARK) for page in layouts.pages(pages, seed)]
    made = [found for found in made if found]
    rows = [(features(found, [len(found)]), np.array([b.mark == "1" for b in found], np.float32)) for found in made]
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.items()}
    steps, batch = 0, 32
    for turn in range(rounds):
        order = rng.permutation(len(rows))
        for first in range(0, len(rows), batch):
            picked = [rows[k] for k in order[first : first + batch]]
            x, live = _padded([r[0] for r in picked])
            wanted = _padded([r[1][:, None] for r in picked])[0][..., 0]
            # Blocks lose part of their description, so that the rest must do.
            x[..., :PATH] *= rng.random((*x.shape[:2], 1)) > 0.1
            x[..., PATH : PATH + WORDS] *= rng.random((*x.shape[:2], 1)) > 0.1
            grads = {k: np.zeros_like(v) for k, v in net.items()}
            kept: dict[str, list] = {side: [] for side in SIDES}
            hidden = np.concatenate(
                [_steps(net, side, x, live, _zero(x.shape[1]), kept[side])[0] for side in SIDES], axis=2
            )
            told = _sigmoid(hidden @ net["out"] + x @ net["skip"] + net["bias"])
            d = (told - wanted) * live / live.sum()
            grads["out"] += np.einsum("tb,tbh->h", d, hidden)
            grads["skip"] += np.einsum("tb,tbi->i", d, x)
            grads["bias"] += d.sum()
            d_hidden = d[..., None] * net["out"]
            for k, side in enumerate(SIDES):
                _back(net, side, x, live, kept[side], d_hidden[..., k * HIDDEN : (k + 1) * HIDDEN], grads)
            steps += 1
            rate = 0.01 * (1 - turn / rounds)
            for name, g in grads.items():
                g = np.clip(g, -1, 1)
                m, v = moments[name]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                net[name] -= rate * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-7)
    return net


def score(net: dict[str, np.ndarray], pages: list[list[Block]]) -> list[np.ndarray]:
    """For each page, how likely each of its blocks belongs to the article."""
    found: list[np.ndarray] = [np.zeros(0, np.float32) for _ in pages]
    order = sorted((k for k, page in enumerate(pages) if page), key=lambda k: len(pages[k]))
    first = 0
    while first < len(order):
        last = first + 1
        while last < len(order) and len(pages[order[last]]) * (last + 1 - first) <= CELLS:
            last += 1
        group = order[first:last]
        for k, told in zip(group, _score_group(net, [pages[k] for k in group]), strict=True):
            found[k] = told
        first = last
    return found


def _score_group(net: dict[str, np.ndarray], pages: list[list[Block]]) -> list[np.ndarray]:
    """Pages of similar length side by side, in spans of ``CELLS`` blocks at most."""
    length = len(pages[-1])
    spans = range(0, length, max(1, CELLS // len(pages)))

    def read(first: int) -> tuple[np.ndarray, np.ndarray]:
        parts = [page[first : first + spans.step] for page in pages]
        sizes = [len(part) for part in parts]
        rows = features([block for part in parts for block in part], sizes, first == 0)
        return _padded(np.split(rows, np.cumsum(sizes)[:-1]))

    whole = read(0) if len(spans) == 1 else None  # a longer page is read once for each side
    logits = np.zeros((length, len(pages)), np.float32)
    for k, side in enumerate(SIDES):
        state = _zero(len(pages))
        for first in spans if side == "f" else reversed(spans):
            x, live = whole or read(first)
            hidden, state = _steps(net, side, x, live, state)
            part = hidden @ net["out"][k * HIDDEN : (k + 1) * HIDDEN]
            if side == "f":
                part = part + x @ net["skip"] + net["bias"]
            logits[first : first + len(x)] += part
    told = _sigmoid(logits)
    return [told[: len(page), k] for k, page in enumerate(pages)]


def _groups(pages: list[str | None]) -> Iterator[list[list[Block]]]:
    """The blocks of the pages, so many pages at a time that they hold about ``CELLS`` blocks."""
    group: list[list[Block]] = []
    size = 0
    for page in pages:
        group.append(blocks(page or ""))
        size += len(group[-1])
        if size >= CELLS:
            yield group
            group, size = [], 0
    if group:
        yield group


def label_blocks(pages: DataFrame, net: dict[str, np.ndarray]) -> DataFrame:
    """(page_id, url, block, text, score): every block with its place and its score."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, urls = batch.column("page_id").to_pylist(), batch.column("url").to_pylist()
            k = 0
            for group in _groups(batch.column("html").to_pylist()):
                rows = [
                    (ids[k + p], urls[k + p], b, block.text, float(s))
                    for p, (page, told) in enumerate(zip(group, score(net, group), strict=True))
                    for b, (block, s) in enumerate(zip(page, told, strict=True))
                ]
                k += len(group)
                names = ("page_id", "url", "block", "text", "score")
                types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.float64())
                columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return _read(pages).mapInArrow(label, "page_id long, url string, block long, text string, score double")


def extract(pages: DataFrame, net: dict[str, np.ndarray], least: float = 0.5) -> DataFrame:
    """(page_id, url, text): the blocks that score at least ``least``, a line each."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = 0
            for group in _groups(batch.column("html").to_pylist()):
                found = [
                    "\n".join(block.text for block, s in zip(page, told, strict=True) if s >= least)
                    for page, told in zip(group, score(net, group), strict=True)
                ]
                part = batch.slice(first, len(group))
                first += len(group)
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(found, pa.string())], ["page_id", "url", "text"]
                )

    return _read(pages).mapInArrow(texts, "page_id long, url string, text string")


def _read(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
    )
