"""Nearest neighbours by inner product: a navigable small-world graph per shard.

Equal vectors are one point that knows its smallest ids, however many rows hold
it. Points fall into shards by hash; each shard's points become a hierarchical
graph, stored as one row of flat arrays (vectors, levels, neighbours). Queries
travel in blocks to every bundle of shards; a block searches the bundle's graphs
one after another and keeps the best of them all, and the bundles' answers are
merged, best first. Scores are inner products of the original vectors in double
precision.

Inner product is no distance, so points get one more component that brings them
to equal length, and a query gets 0 there: the nearest point is then the one
with the largest inner product.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm.frames import written

SHARD_POINTS = 4096  # points of a shard, about
LINKS = 16  # neighbours of a point on the upper levels; twice as many on the lowest
BUILD_WIDTH = 48  # candidates kept while a point is put in
SEARCH_WIDTH = 160  # candidates kept while a query is answered
QUERY_PART = 4096  # queries that search one shard together, about
BUNDLES = 16  # tasks among which the shards are dealt for each such block of queries
BUNDLE_SHARDS = 64  # shards that one task holds, at most
K = 20

TOGETHER = 256  # beams that take their steps together, at most
TABLE = 4_000_000  # products of such beams with a graph's points that are held at once, about
STEPS = 16  # points of a beam whose neighbours are met in one step


class Graph:
    """A hierarchical navigable small-world graph over a matrix of points.

    Points are put in, and queries answered, many at a time: each has a beam of its own,
    and all beams take their steps together, so that a step is a few calls on arrays.
    """

    def __init__(self, points: np.ndarray, links: int = LINKS):
        self.points = points
        self.links = links
        # A point's level comes from its place alone, so a rebuilt shard is the same.
        rng = np.random.default_rng(7)
        self.level = np.minimum(
            (-np.log(1.0 - rng.random(len(points))) / np.log(links)).astype(np.int64), 8
        )
        # Level by level: neighbours of a point side by side, -1 where there are fewer.
        # While the graph is built there is room for more, so that a full list is thinned out rarely.
        self.room = [2 * links if at == 0 else links for at in range(int(self.level.max(initial=0)) + 1)]
        self.near = [np.full((len(points), room + links), -1, dtype=np.int32) for room in self.room]
        self.count = np.zeros((len(self.room), len(points)), dtype=np.int64)
        self.entry = 0

    def build(self, width: int) -> None:
        done = 1
        while done < len(self.points):
            size = min(max(1, done // 4), self._together(), len(self.points) - done)
            self._insert(np.arange(done, done + size), width)
            done += size
        for at, room in enumerate(self.room):
            self._thin(at, np.flatnonzero(self.count[at] > room))
            self.near[at] = self.near[at][:, :room].copy()

    def _together(self) -> int:
        """How many points or queries take their steps together."""
        return max(1, min(TOGETHER, TABLE // max(1, len(self.points))))

    def _insert(self, new: np.ndarray, width: int) -> None:
        """Puts in points that also meet those before them in ``new``."""
        level, top = self.level[new], int(self.level[self.entry])
        likeness, start = self._products(self.points[new]), np.full(len(new), self.entry)
        for at in range(max(top, int(level.max())), -1, -1):
            here, passing = np.flatnonzero(level >= at), np.flatnonzero(level < at)
            before = np.where(np.tri(len(here), k=-1, dtype=bool), new[here], -1)
            found, best = before, np.where(before < 0, -np.inf, likeness[here][:, new[here]])
            if at <= top:
                start[passing] = self._descend(likeness[passing], start[passing], at)
                ids, values = self._search(likeness[here], start[here], width, at)
                start[here] = ids[:, 0]
                found, best = np.concatenate([ids, found], axis=1), np.concatenate([values, best], axis=1)
            if not len(here):
                continue
            likest = np.argsort(-best, axis=1, kind="stable")[:, :width]
            found, best = np.take_along_axis(found, likest, 1), np.take_along_axis(best, likest, 1)
            chosen = self._spread(found, best, self.links)
            self.near[at][new[here], : chosen.shape[1]] = chosen
            self.count[at][new[here]] = (chosen >= 0).sum(axis=1)
            row, column = np.nonzero(chosen >= 0)
            self._link(chosen[row, column].astype(np.int64), new[here][row], at)
        if level.max() > top:
            self.entry = int(new[level.argmax()])

    def _likeness(self, ids: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Products of each row's points with the row's vector."""
        return np.matmul(self.points[ids], to[:, :, None])[:, :, 0]

    def _link(self, point: np.ndarray, new: np.ndarray, at: int) -> None:
        """Adds ``new`` to the neighbours of ``point``, pair by pair."""
        room = self.near[at].shape[1]
        while len(point):
            order = np.argsort(point, kind="stable")
            point, new = point[order], new[order]
            first = np.flatnonzero(np.diff(point, prepend=-1))
            rank = np.arange(len(point)) - np.repeat(first, np.diff([*first, len(point)]))
            place = self.count[at][point] + rank
            fits = place < room
            self.near[at][point[fits], place[fits]] = new[fits]
            np.add.at(self.count[at], point[fits], 1)
            point, new = point[~fits], new[~fits]
            self._thin(at, np.unique(point))

    def _thin(self, at: int, full: np.ndarray) -> None:
        """Leaves the points of ``full`` as many neighbours as the level has room for."""
        for some in np.array_split(full, -(-len(full) // TOGETHER)) if len(full) else ():
            ids = self.near[at][some].astype(np.int64)
            likeness = self._likeness(ids, self.points[some])
            likeness[ids < 0] = -np.inf
            order = np.argsort(-likeness, axis=1, kind="stable")
            kept = self._spread(np.take_along_axis(ids, order, 1), np.take_along_axis(likeness, order, 1), self.room[at])
            self.near[at][some] = -1
            self.near[at][some, : kept.shape[1]] = kept
            self.count[at][some] = (kept >= 0).sum(axis=1)

    def _spread(self, found: np.ndarray, likeness: np.ndarray, room: int) -> np.ndarray:
        """From a row's candidates, likest first: those closer to its point than to one taken before.

        All points have one length, so the larger product is the nearer. Free
        places go to the likest of the rest.
        """
        if found.shape[1] <= room:
            return found
        there = self.points[found]
        among = np.matmul(there, there.transpose(0, 2, 1))
        valid = found >= 0
        taken, closest = np.zeros(found.shape, dtype=bool), np.full(found.shape, -np.inf, dtype=among.dtype)
        for k in range(found.shape[1]):
            take = valid[:, k] & (closest[:, k] <= likeness[:, k]) & (taken.sum(axis=1) < room)
            taken[:, k] = take
            closest[take] = np.maximum(closest[take], among[take, k])
        order = np.argsort(np.where(taken, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :room]
        return np.take_along_axis(found, order, 1)

    def _products(self, vectors: np.ndarray) -> np.ndarray:
        """Of each vector with every point: together the beams of a block meet nearly all of them.

        One more column, the one that -1 points at, is for neighbours that are not there.
        """
        out = np.empty((len(vectors), len(self.points) + 1), dtype=np.float32)
        np.matmul(vectors, self.points.T, out=out[:, :-1])
        out[:, -1] = -np.inf
        return out

    def _descend(self, likeness: np.ndarray, start: np.ndarray, at: int) -> np.ndarray:
        """For each row, from its start, the point none of whose neighbours on a level is likelier."""
        best, open_ = start.copy(), np.arange(len(start))
        while len(open_):
            met = self.near[at][best[open_]]
            value = likeness[open_[:, None], met]
            pick = value.argmax(axis=1)
            better = value[np.arange(len(open_)), pick] > likeness[open_, best[open_]]
            open_, met, pick = open_[better], met[better], pick[better]
            best[open_] = met[np.arange(len(open_)), pick]
        return best

    def _search(self, likeness: np.ndarray, start: np.ndarray, width: int, at: int) -> tuple[np.ndarray, np.ndarray]:
        """For each row the ``width`` likest points found on a level, likest first; -1 where there are fewer.

        ``likeness`` is used up: what a row has met is struck out.
        """
        size, flat = likeness.shape[0], likeness.reshape(-1)
        met_at = np.empty(len(flat), dtype=np.int32)
        near = np.concatenate([self.near[at], np.full((1, self.near[at].shape[1]), -1, dtype=np.int32)])  # the last, of no point
        out = np.empty((size, width), dtype=np.int32), np.empty((size, width), dtype=np.float32)
        # A beam: values, and for each the point's number times two, plus one if its neighbours are still to be met.
        best, code = np.full((size, width), -np.inf, dtype=np.float32), np.full((size, width), -2, dtype=np.int32)
        rows = np.arange(size)
        best[:, 0], code[:, 0] = np.nan_to_num(likeness[rows, start]), 2 * start + 1
        likeness[rows, start] = -np.inf
        steps = min(STEPS, width)
        while len(rows):
            own = np.arange(len(rows))[:, None]
            waiting = np.where(code & 1, best, -np.inf)
            pick = np.argpartition(-waiting, steps - 1, axis=1)[:, :steps]
            picked = code[own, pick]
            code[own, pick] = picked & -2
            met = near[np.where(picked & 1, picked >> 1, -1)].reshape(len(rows), -1)
            place = (rows * likeness.shape[1])[:, None] + met
            value = flat[place]
            flat[place] = -np.inf
            row, column = np.nonzero(value > best.min(axis=1)[:, None])
            place, value, point = place[row, column], value[row, column], met[row, column]
            # A point that several neighbours led to in this step counts once.
            met_at[place] = np.arange(len(place), dtype=np.int32)
            once = met_at[place] == np.arange(len(place))
            row, value, point = row[once], value[once], point[once]
            slot = width + np.arange(len(row)) - np.searchsorted(row, np.arange(len(rows)))[row]
            if len(row):
                more = ((0, 0), (0, int(slot.max()) + 1 - width))
                best, code = np.pad(best, more, constant_values=-np.inf), np.pad(code, more, constant_values=-2)
                best[row, slot], code[row, slot] = value, 2 * point + 1
                kept = np.argpartition(-best, width - 1, axis=1)[:, :width]
                best, code = best[own, kept], code[own, kept]
            open_ = (code & 1).any(axis=1)
            if not open_.all():
                out[0][rows[~open_]], out[1][rows[~open_]] = code[~open_] >> 1, best[~open_]
                rows, best, code = rows[open_], best[open_], code[open_]
        order = np.lexsort((out[0], -out[1]), axis=1)
        return np.take_along_axis(out[0], order, 1), np.take_along_axis(out[1], order, 1)

    def nearest(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the likest points found for each query, -1 where there are fewer, and their products."""
        ids, best = [], []
        for some in np.array_split(queries, max(1, -(-len(queries) // self._together()))):
            likeness, start = self._products(some), np.full(len(some), self.entry)
            for at in range(int(self.level[self.entry]), 0, -1):
                start = self._descend(likeness, start, at)
            found = self._search(likeness, start, width, 0)
            ids.append(found[0])
            best.append(found[1])
        return np.concatenate(ids), np.concatenate(best)


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v): vectors as doubles, without null, empty, zero and non-finite ones."""
    v = F.col(vector_column).cast("array<double>")
    fine = (
        "v IS NOT NULL AND vec_id IS NOT NULL AND size(v) > 0 AND exists(v, x -> x <> 0) AND "
        "forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    )
    return vectors.select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v")).where(fine)


def points_of(vectors: DataFrame, k: int) -> DataFrame:
    """(point, v, ids): each distinct vector with its k + 1 smallest ids; ``point`` is the first."""
    first = Window.partitionBy("v").orderBy("vec_id")
    return (
        vectors.withColumn("n", F.row_number().over(first))
        .where(F.col("n") <= k + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .select(F.col("ids")[0].alias("point"), "v", "ids")
    )


def index(points: DataFrame, shards: int, width: int = BUILD_WIDTH) -> DataFrame:
    """One row a shard: (shard, point ids, vectors, levels, neighbours, counts, entry)."""

    def build(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values("point", ignore_index=True)
        vectors = np.stack(shard["v"].to_numpy())
        scaled = vectors / np.abs(vectors).max()
        length = np.einsum("ij,ij->i", scaled, scaled)
        even = np.concatenate([scaled, np.sqrt(length.max() - length)[:, None]], axis=1)
        graph = Graph(even.astype(np.float32))
        graph.build(width)
        single = vectors.astype(np.float32)
        return pd.DataFrame(
            {
                "shard": shard["shard"].iloc[:1],
                "ids": [shard["point"].to_numpy().tobytes()],
                # In single precision where that loses nothing: the row travels to every block of queries.
                "vectors": [(single if (single == vectors).all() else vectors).tobytes()],
                "size": [vectors.shape[1]],
                "levels": [graph.level.tobytes()],
                # Of the upper levels only the points that are on them.
                "near": [b"".join(n[graph.level >= at].tobytes() for at, n in enumerate(graph.near))],
                "entry": [graph.entry],
            }
        )

    return (
        points.withColumn("shard", F.pmod(F.xxhash64("point"), F.lit(shards)))
        .groupBy("shard")
        .applyInPandas(
            build,
            "shard long, ids binary, vectors binary, size int, levels binary, near binary, entry long",
        )
    )


def _opened(row: pd.Series) -> tuple[Graph, np.ndarray, np.ndarray, float]:
    """(graph, vectors, ids, scale): the graph's points are the vectors divided by ``scale``."""
    ids = np.frombuffer(row["ids"], dtype=np.int64)
    single = len(row["vectors"]) == 4 * len(ids) * row["size"]
    vectors = np.frombuffer(row["vectors"], "<f4" if single else "<f8").astype(np.float64).reshape(len(ids), row["size"])
    graph = Graph.__new__(Graph)
    scale = float(np.abs(vectors).max())
    graph.points = (vectors / scale).astype(np.float32)  # a query has 0 in the added component, so it is not needed
    graph.level = np.frombuffer(row["levels"], dtype=np.int64)
    flat, graph.near = np.frombuffer(row["near"], dtype=np.int32), []
    wide = 2 * LINKS
    for at in range(int(graph.level.max(initial=0)) + 1):
        here = np.flatnonzero(graph.level >= at)
        near = np.full((len(ids), wide), -1, dtype=np.int32)
        near[here] = flat[: len(here) * wide].reshape(len(here), wide)
        graph.near.append(near)
        flat, wide = flat[len(here) * wide :], LINKS
    graph.entry = row["entry"]
    return graph, vectors, ids, scale


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = K,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    width: int = SEARCH_WIDTH,
    shard_points: int = SHARD_POINTS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest rows, itself left out.

    ``is_query`` is a condition on ``vec_id``. Null, zero and non-finite vectors
    take no part, nor do rows without an id; vectors of another length than the
    most common one are neighbours of none but their own kind. Equal scores are
    ranked by vec_id; rows that repeat an id count each. An empty table gives no
    rows, and fewer candidates than ``k`` are all returned; further columns are
    ignored.
    """
    rows = usable(vectors, id_column, vector_column).withColumn("size", F.size("v"))
    points = written(points_of(rows.select("vec_id", "v"), k))
    kinds = (
        points.groupBy(F.size("v").alias("size"))
        .agg(F.count("*").alias("n"))
        .orderBy("size")
        .collect()  # one row for each number of components
    )
    answers = None
    for kind in kinds:
        shards = -(-kind.n // shard_points)
        own = points.where(F.size("v") == kind.size)
        graphs = written(index(own, shards))
        asked = (
            rows.where((F.col("size") == kind.size) & is_query)
            .select(F.col("vec_id").alias("query_id"), "v")
            .distinct()
        )
        part = _answers(graphs, asked, shards, k, max(width, k + 1))
        answers = part if answers is None else answers.union(part)
    if answers is None:
        return vectors.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score double"
        )
    # A point stands for a row at least, but those of the query's own id may have no other row.
    own = F.when(F.col("point") == F.col("query_id"), F.col("score"))
    first = Window.partitionBy("query_id", own).orderBy(F.desc("score"), "point")
    likest = answers.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    # A point stands for up to k + 1 rows; the query's own row is left out.
    candidates = (
        likest.join(points.select("point", "ids"), "point")
        .select("query_id", "score", F.explode("ids").alias("vec_id"))
        .where("vec_id <> query_id")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        candidates.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _answers(graphs: DataFrame, asked: DataFrame, shards: int, k: int, width: int) -> DataFrame:
    """(query_id, point, score): the k + 1 likest points that each bundle of shards finds for each query."""
    parts = max(1, -(-asked.count() // QUERY_PART))
    bundles = max(min(shards, BUNDLES), -(-shards // BUNDLE_SHARDS))
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))
    sent = asked.withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(parts))).withColumn(
        "bundle", spread(bundles)
    )
    held = graphs.withColumn("part", spread(parts)).withColumn("bundle", F.pmod("shard", F.lit(bundles)))

    def answer(queries: pd.DataFrame, graphs: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(graphs):
            return pd.DataFrame({"query_id": [], "point": [], "score": []})
        ids, vectors = queries["query_id"].to_numpy(), np.stack(queries["v"].to_numpy())
        order = np.lexsort((*vectors.T[::-1], ids))  # blocks of the same queries whatever the order of rows
        ids, vectors = ids[order], vectors[order]
        best = _Best(len(ids), k + 1)
        for _, row in graphs.sort_values("shard").iterrows():
            _ask(row, vectors, width, best)
        row, point, score = best.rows()
        return pd.DataFrame({"query_id": ids[row], "point": point, "score": score})

    return (
        sent.groupBy("bundle", "part")
        .cogroup(held.groupBy("bundle", "part"))
        .applyInPandas(answer, "query_id long, point long, score double")
    )


class _Best:
    """The likest points of each query so far; equal scores by point."""

    def __init__(self, queries: int, most: int):
        self.point = np.zeros((queries, most), dtype=np.int64)
        self.score = np.full((queries, most), -np.inf)
        self.held = np.zeros((queries, most), dtype=bool)

    def add(self, row: np.ndarray, point: np.ndarray, score: np.ndarray) -> None:
        """``row`` comes in order."""
        queries, most = self.score.shape
        place = np.arange(len(row)) - np.searchsorted(row, np.arange(queries))[row]
        more = int(place.max(initial=-1)) + 1
        points = np.concatenate([self.point, np.zeros((queries, more), dtype=np.int64)], axis=1)
        scores = np.concatenate([self.score, np.full((queries, more), -np.inf)], axis=1)
        held = np.concatenate([self.held, np.zeros((queries, more), dtype=bool)], axis=1)
        points[row, most + place], scores[row, most + place], held[row, most + place] = point, score, True
        order = np.lexsort((points, -scores, ~held), axis=1)[:, :most]
        self.point, self.score, self.held = (np.take_along_axis(a, order, 1) for a in (points, scores, held))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        row, place = np.nonzero(self.held)
        return row, self.point[row, place], self.score[row, place]


def _ask(shard: pd.Series, queries: np.ndarray, width: int, best: _Best) -> None:
    """Adds to ``best`` what the queries find in a shard."""
    graph, vectors, ids, scale = _opened(shard)
    largest = np.abs(queries).max(axis=1)
    places, likeness = graph.nearest((queries / largest[:, None]).astype(np.float32), width)
    # Beams have single precision; the exact product is made of all that may be among the best by it.
    most = best.score.shape[1]
    longest = np.linalg.norm(vectors / scale, axis=1).max()
    error = 1.2e-7 * (vectors.shape[1] + 4) * longest * np.linalg.norm(queries / largest[:, None], axis=1)
    least = best.score[:, -1] / scale / largest
    least[~np.isfinite(least)] = -np.inf  # nothing to compare with yet, or beyond what doubles hold
    if likeness.shape[1] >= most:
        least = np.maximum(least, likeness[:, most - 1])
    row, column = np.nonzero((places >= 0) & (likeness >= (least - error)[:, None]))
    place = places[row, column]
    # One product at a time adds up in one order, whatever the shard.
    score = np.array([np.dot(vectors[p], queries[r]) for p, r in zip(place.tolist(), row.tolist())], dtype=np.float64)
    best.add(row, ids[place], score)
