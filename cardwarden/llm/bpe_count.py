"""Token counts by heap-and-linked-list byte-pair merging.

A word's bytes are a doubly linked list of symbols. A heap holds the adjacent
pairs that have a merge rank, lowest rank first, leftmost first among equals; a
popped pair that no longer stands as it was pushed is skipped. Each merge joins
two neighbours and offers the two new pairs beside them. The count of a word is
its bytes minus its merges: no token id is ever looked up. A word of n bytes
takes n log n steps, so a very long run of letters is no trouble.

Words repeat, so their counts are kept in a table of bounded size per process.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.frames import process_table

LIMIT = 1024  # more tokens than this is over the limit
KEPT_WORDS = 500_000  # words whose counts a Python process remembers
_LONG = 1_000_000  # characters from which words are taken one at a time

# Fixed: how byte-level vocabularies split a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_symbols() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves; the others take the characters from
    256 on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = (b for b in range(256) if b not in plain)
    moved = {b: 256 + i for i, b in enumerate(others)}
    return [chr(moved.get(b, b)) for b in range(256)]


class Counter(dict):
    """word -> number of tokens, computed at first use.

    Symbols are numbers: the bytes, then one for each distinct merged string.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        known = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        self.ranks: dict[int, int] = {}  # left << 32 | right -> rank
        self.made: list[int] = []  # rank -> symbol
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks[known[left] << 32 | known[right]] = rank
            self.made.append(known.setdefault(left + right, len(known)))
        self.words = regex.compile(WORDS)
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        data = word.encode("utf-8", "surrogatepass")
        count = self[word] = len(data) - self.merges(data)
        return count

    def merges(self, data: bytes) -> int:
        """How many merges the bytes of one word allow."""
        rank_of, made, size = self.ranks.get, self.made, len(data)
        symbols = [*data, -1]  # the end marker forms no pair
        heap = [
            rank << 32 | i
            for i in range(size - 1)
            if (rank := rank_of(data[i] << 32 | data[i + 1])) is not None
        ]
        heapify(heap)
        after, before = [*range(1, size + 1)], [*range(-1, size)]
        done = 0
        while heap:
            entry = heappop(heap)
            rank, left = entry >> 32, entry & 0xFFFFFFFF
            if symbols[left] < 0:
                continue  # merged into its left neighbour meanwhile
            right = after[left]
            if right == size or rank_of(symbols[left] << 32 | symbols[right]) != rank:
                continue  # one side has changed since
            done += 1
            whole = symbols[left] = made[rank]
            symbols[right] = -1
            last = after[left] = after[right]
            before[last] = left
            if last < size and (new := rank_of(whole << 32 | symbols[last])) is not None:
                heappush(heap, new << 32 | left)
            first = before[left]
            if first >= 0 and (new := rank_of(symbols[first] << 32 | whole)) is not None:
                heappush(heap, new << 32 | first)
        return done

    def count(self, text: str) -> int:
        """Tokens of a whole text; an added token's string inside it is one token."""
        if self.added is None or not self.added.search(text):
            return self._plain(text)
        parts = self.added.split(text)
        return len(parts) - 1 + sum(map(self._plain, parts))

    def _plain(self, text: str) -> int:
        if len(text) < _LONG:
            return sum(map(self.__getitem__, self.words.findall(text)))
        return sum(self[m.group()] for m in self.words.finditer(text))


def token_counts(docs: DataFrame, vocabulary: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs`` (doc_id, text).

    ``vocabulary`` is a byte-level BPE file that every executor can open. Counts
    equal the tokenizer library's for the whole text, without added special
    tokens. Null and empty texts have 0 bytes and 0 tokens; a null doc_id stays
    null; repeated rows stay; an empty table gives no rows; further columns are
    ignored. No row depends on another, so there is no shuffle.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = process_table("token_counts")
        for batch in batches:
            if vocabulary not in kept:
                kept[vocabulary] = Counter(vocabulary)
            counter = kept[vocabulary]
            found = [t.as_py() for t in batch.column("text")]
            sizes = [len(t.encode("utf-8", "surrogatepass")) for t in found]
            tokens = [counter.count(t) for t in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
