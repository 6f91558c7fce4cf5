"""Words of many texts at once: Arrow splits and numbers, numpy gathers.

What lies between ASCII white space is a chunk. Chunks repeat, so only the distinct
ones of the texts at hand are split into words, and only distinct words become Python
strings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOGETHER = 1 << 21  # bytes of text whose chunks are numbered together


def taken(flat: np.ndarray, start: np.ndarray, size: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` numbered ``at``, one after another, and where they end, from 0."""
    start, size = start[at], size[at]
    stops = np.concatenate([[0], np.cumsum(size)])
    return flat[np.repeat(start - stops[:-1], size) + np.arange(stops[-1])], stops


def offsets(lists: pa.ListArray) -> np.ndarray:
    found = lists.offsets.to_numpy()
    return found - found[0]


def groups(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, last + 1) of texts that are about ``TOGETHER`` bytes, or one longer text."""
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(ends, ends[first] - size[first] + TOGETHER, side="right"))
        yield first, max(first + 1, last)
        first = max(first + 1, last)


def numbered_words(
    texts: pa.Array, separate: Callable[[pa.Array], pa.ListArray]
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct words, the number of each word of the texts, where the texts begin and end).

    ``separate`` gives the words of each chunk; empty ones are left out.
    """
    split = pc.ascii_split_whitespace(texts)
    chunks = split.flatten().dictionary_encode()
    lists = separate(chunks.dictionary)
    flat = lists.flatten()
    real = pc.not_equal(flat, "")
    edges = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])[offsets(lists)]
    words = flat.filter(real).dictionary_encode()
    numbers, stops = taken(words.indices.to_numpy(), edges[:-1], np.diff(edges), chunks.indices.to_numpy())
    return words.dictionary.to_pylist(), numbers, stops[offsets(split)]
