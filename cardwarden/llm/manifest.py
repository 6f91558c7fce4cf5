"""Merkle manifest of a data set, with a proof for every document.

Every document is a leaf. The leaves of a source, in the order of their ids, are
cut into partitions of ``FANOUT ** LEVELS`` aligned leaves, and each partition folds
its own lowest levels. Then the partitions exchange subtree roots like a butterfly:
in each round the partitions below ``FANOUT`` neighbouring nodes deal their nodes
over lanes, a lane hears every one of these nodes once, and each partition in it
hashes the common parent for itself. So after the last round every partition knows
the root and all siblings on the way to it, and nothing has to travel down again.
Where a node has fewer partitions than its neighbours (the last run of a level, or a
small source beside a big one) its partitions speak in several lanes.

The rounds within sources end in one root per source; rounds over the sources, in
the order of their names, end in the root of the whole. What is grouped holds at
most ``FANOUT`` rows, whatever a source's share of the documents.

Null ids and sources are a place of their own before all others, null values are
written as ``-``. Rows that repeat an id are leaves of their own, in the order of
their hashes. An empty table gives no rows. Columns not named here are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm.frames import written
from cardwarden.llm.order import digest, numbered, spans, with_key_columns

FANOUT = 16
LEVELS = 3  # a partition holds FANOUT ** LEVELS leaves
LANE_BITS = 10  # lanes of one node that share a join key

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(value: Column) -> Column:
    """A value with its length in bytes before it; null is ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """The hash of a document's columns, some of them given anew."""
    return digest(*[encoded(changed.get(c, F.col(c))) for c in LEAF_COLUMNS])


def _hash_run(nodes: Column) -> Column:
    return F.sha2(F.concat_ws("", nodes), 256)


def _runs(nodes: Column) -> Column:
    firsts = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FANOUT).cast("int"))
    return F.transform(firsts, lambda k: _hash_run(F.slice(nodes, k * FANOUT + 1, FANOUT)))


def siblings(level: Column) -> Column:
    """The other nodes of a level's run, left to right."""
    return F.concat(
        F.slice(level["run"], F.lit(1), level["place"]),
        F.slice(level["run"], level["place"] + 2, F.lit(FANOUT)),
    )


def all_siblings(proof: Column) -> Column:
    """The siblings of all levels, level by level."""
    return F.flatten(F.transform(proof, siblings))


def folded(node: Column, proof: Column) -> Column:
    """The root that follows from a leaf and the siblings of its proof."""

    def up(node: Column, level: Column) -> Column:
        left = F.slice(level["run"], F.lit(1), level["place"])
        right = F.slice(level["run"], level["place"] + 2, F.lit(FANOUT))
        return _hash_run(F.concat(left, F.array(node), right))

    return F.aggregate(proof, node, up)


def prove(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The rows of ``leaves`` (doc_id, source, leaf, ...) with subroot, root and proof.

    ``proof`` is an array of (place, run), from the leaf's level up to the root: the
    nodes hashed together there and the own place among them, from 0. Levels that
    only one node is left of do not occur.
    """
    carried = [c for c in leaves.columns if c not in ("source", "leaf")]
    span = FANOUT**levels
    placed = numbered(leaves, ["source", "doc_id", "leaf"], "_place")
    sources = numbered(spans(placed, "source", "_place"), ["start"], "s")
    n_sources, most = sources.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    index = F.col("_place") - F.col("start")
    blocks = _blocks(
        with_key_columns(placed, "_place", sources, "source").select(
            "s", "n", F.floor(index / span).alias("p"), (index % span).alias("i"),
            F.struct("source", "leaf", *carried).alias("row"),
        ),
        levels,
    )
    states = blocks.select(
        "s", "p", F.ceil(F.col("n") / span).alias("parts"), F.col("top").alias("node"),
        F.array().cast("array<struct<place:int,run:array<string>>>").alias("upper"),
    )
    states = _over_sources(_within_sources(states, -(-most // span)), sources, n_sources, span)
    return (
        blocks.drop("top")
        .join(states.select("s", "p", "subroot", F.col("node").alias("root"), "upper"), ["s", "p"])
        .select("subroot", "root", "upper", F.inline("leaves"))
        .select("row.*", "subroot", "root", F.concat("lower", "upper").alias("proof"))
    )


def _blocks(rows: DataFrame, levels: int) -> DataFrame:
    """A row for each partition: its leaves with their lower proofs, and its top node."""
    n = F.col("n")
    many = n > FANOUT**levels  # then all partitions of the source rise through all levels
    found = rows.groupBy("s", "p", "n").agg(F.sort_array(F.collect_list(F.struct("i", "row"))).alias("rows"))
    found = found.withColumn("level0", F.transform("rows", lambda r: r["row"]["leaf"]))
    for j in range(levels):
        rises = many | (n > FANOUT**j)
        found = found.withColumn(f"level{j + 1}", F.when(rises, _runs(F.col(f"level{j}"))).otherwise(F.col(f"level{j}")))

    def lower(i: Column) -> Column:
        steps = []
        for j in range(levels):
            at = F.floor(i / FANOUT**j).cast("int")
            run = F.slice(F.col(f"level{j}"), F.floor(at / FANOUT).cast("int") * FANOUT + 1, FANOUT)
            step = F.array(F.struct((at % FANOUT).alias("place"), run.alias("run")))
            steps.append(F.when(many | (n > FANOUT**j), step).otherwise(F.array().cast(
                "array<struct<place:int,run:array<string>>>")))
        return F.concat(*steps)

    kept = written(found.select("s", "p", "n", "rows", *[f"level{j}" for j in range(levels + 1)]))
    # The lower proofs are slices of the stored levels, made where the rows are used.
    return kept.select(
        "s", "p", "n", F.col(f"level{levels}")[0].alias("top"),
        F.transform("rows", lambda r: F.struct(r["row"].alias("row"), lower(r["i"]).alias("lower"))).alias("leaves"),
    )


def _exchange(states: DataFrame) -> DataFrame:
    """One round: (tree, a, low, m, most, node, upper, ...) with the parents' nodes.

    ``a`` is the node's place in its level, ``low`` the partition's place among the
    ``m`` partitions below the node, ``most`` the greatest ``m`` of the node's run.
    """
    kept = [c for c in states.columns if c not in ("tree", "a", "low", "m", "most", "lane")]
    sent = states.withColumn("lane", F.explode(F.sequence("low", F.col("most") - 1, "m")))
    heard = sent.groupBy("tree", F.floor(F.col("a") / FANOUT).alias("up"), "lane").agg(
        F.sort_array(F.collect_list(F.struct(
            "a", (F.col("lane") == F.col("low")).alias("own"), "node", F.struct(*kept).alias("state")
        ))).alias("heard")
    )
    run = F.transform("heard", lambda x: x["node"])
    members = heard.select(
        "tree", "up", run.alias("run"), F.explode(F.filter("heard", lambda x: x["own"])).alias("x")
    ).withColumn("parent", _hash_run(F.col("run")))
    step = F.array(F.struct((F.col("x.a") % FANOUT).cast("int").alias("place"), "run"))
    return members.select(
        *[F.col(f"x.state.{c}").alias(c) for c in kept if c not in ("node", "upper")],
        F.col("parent").alias("node"), F.concat("x.state.upper", step).alias("upper"),
    )


def _within_sources(states: DataFrame, most: int) -> DataFrame:
    """Rounds until every partition has its source's root, as node and as subroot."""
    width = 1  # partitions below a full node of this round
    while width < most:
        a, full = F.floor(F.col("p") / width), F.lit(width).cast("long")
        first = F.floor(a / FANOUT) * FANOUT * width  # the run's first node is its widest
        rising = F.col("parts") > width
        told = states.where(rising).select(
            "*", F.col("s").alias("tree"), a.alias("a"), (F.col("p") % width).alias("low"),
            F.least(full, F.col("parts") - a * width).alias("m"),
            F.least(full, F.col("parts") - first).alias("most"),
        )
        states = _exchange(told).unionByName(states.where(~rising))
        width *= FANOUT
    return states.withColumn("subroot", F.col("node"))


def _over_sources(states: DataFrame, sources: DataFrame, n_sources: int, span: int) -> DataFrame:
    """Rounds over the sources' roots; a node's partitions are those of all its sources."""
    level = sources.select(F.col("s").alias("a"), F.ceil(F.col("n") / span).alias("m"))
    states = states.withColumn("a", F.col("s")).withColumn("low", F.col("p"))
    while n_sources > 1:
        run = Window.partitionBy(F.floor(F.col("a") / FANOUT))  # FANOUT rows at most
        earlier = run.orderBy("a").rowsBetween(Window.unboundedPreceding, -1)
        told = level.select(
            "a", "m", F.max("m").over(run).alias("most"), F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("off")
        )
        # A node's row is repeated for every 2^10 of its partitions, so that no join key is hot.
        told = told.withColumn(
            "_lanes", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("m") - 1, LANE_BITS)))
        )
        states = (
            states.withColumn("_lanes", F.shiftright("low", LANE_BITS))
            .join(told, ["a", "_lanes"])
            .drop("_lanes")
            .withColumn("tree", F.lit(0))
            .withColumn("next", F.struct(
                F.floor(F.col("a") / FANOUT).alias("a"), (F.col("off") + F.col("low")).alias("low")
            ))
            .drop("off")
        )
        states = _exchange(states).select("*", "next.*").drop("next")
        level = level.groupBy(F.floor(F.col("a") / FANOUT).alias("a")).agg(F.sum("m").alias("m"))
        n_sources = -(-n_sources // FANOUT)
    return states
