"""Prefix trie of conversations, by van Emde Boas recursion.

A sequence is cut at half its depth, the upper halves form one trie, the lower halves
one forest below each cut prefix, and every piece is cut again, down to pieces of
``PIECE`` turns that one row holds. All pieces of one height are rows of the same
table, so upper trie and lower forests are built side by side: the names of pieces
are put together pair by pair on the way up, and the names of the cut prefixes follow
on the way down (``_starts``). Equal prefixes get equal names (SHA-256 of what they
hold), so a name is a node and needs no shuffle to be given out. Totals are summed
within the pieces first; then, height by height, the totals below a cut are grafted
onto all nodes above it in the upper piece (``totals``). That is a logarithmic number
of rounds, and each round moves at most one row for each turn of a distinct path.

A long conversation is many rows, a common prefix is summed before the shuffle, and a
prefix with very many children meets them by broadcast (10,000 such prefixes at most,
as their children's shares add up to one).

A null role or text is empty. Turns are ordered by turn (null first), role and text;
rows that repeat a turn are turns of their own, equal ones included. Rows without a
conv_id belong to no conversation. An empty table gives no nodes. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwarden.llm.frames import written
from cardwarden.llm.order import digest, numbered, spans, with_key_columns

PIECE = 4  # turns of the smallest piece, one row
CHUNK = 1_000  # ids that are joined to one text before they meet those of other chunks
COMMON = 4_096  # children from which on a prefix may be common
SHARES = 10_000  # a common prefix has at least this part of all nodes as children
ROOT = hashlib.sha256(b"root").hexdigest()


def rebuilt(messages: DataFrame, group: int, head: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that share the opening of the first of their group.

    Conversation c starts with the first h turns of conversation c - c % ``group``
    (h = crc32 of c as text, modulo ``head``) and goes on with its own turns after
    its first h. Returns the turns (c, q, turn, chars, ends) and the conversations
    without turns (c). ``turn`` is the hash of role and text, ``chars`` the text's
    code points, ``ends`` marks a conversation's last turn.
    """
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    rows = messages.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("at"),
        role.alias("role"), text.alias("text"),
    ).withColumns({
        "turn": digest(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")),
        "chars": F.char_length("text").cast("long"),
    })
    placed = numbered(rows, ["c", "at", "role", "text"], "_place", drop=("at", "role", "text"))
    known = spans(placed, "c", "_place").withColumns({
        "h": F.crc32(F.col("c").cast("string")) % head,
        "base": F.col("c") - F.col("c") % group,
    })
    # The first turns of conversations that others start with: fewer than ``head`` each.
    first = placed.where(F.col("c") % group == 0)
    first = (
        with_key_columns(first, "_place", spans(first, "c", "_place"), "c")
        .withColumn("q", F.col("_place") - F.col("start"))
        .where(F.col("q") < head - 1)
        .groupBy(F.col("c").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("q", "turn", "chars"))).alias("first"))
    )
    nothing = F.array().cast("array<struct<q:bigint,turn:string,chars:bigint>>")
    known = known.join(first, "base", "left").withColumn(
        "first", F.slice(F.coalesce("first", nothing), F.lit(1), F.col("h").cast("int"))
    )
    known = written(known.withColumn("given", F.size("first").cast("long")))
    alone = F.col("n") <= F.col("h")  # nothing of its own is left
    opening = known.select("c", "given", alone.alias("alone"), F.inline("first")).select(
        "c", "q", "turn", "chars", (F.col("alone") & (F.col("q") == F.col("given") - 1)).alias("ends")
    )
    place = F.col("_place") - F.col("start")
    own = (
        with_key_columns(placed, "_place", known.select("c", "start", "n", "h", "given"), "c")
        .where(place >= F.col("h"))
        .select("c", (F.col("given") + place - F.col("h")).alias("q"), "turn", "chars",
                (place == F.col("n") - 1).alias("ends"))
    )
    return opening.unionByName(own), known.where(alone & (F.col("given") == 0)).select("c")


def trie(named: DataFrame, turnless: DataFrame, piece: int = PIECE) -> DataFrame:
    """The nodes of the trie over the pieces that ``pieces`` made with the same ``piece``.

    (name, parent, depth, c, n_convs, n_children, parent_c, n_leaves, saved): ``c`` is
    the smallest conversation that starts with the prefix, ``saved`` the sum over the
    subtree of (n_convs - 1) times the code points of a node's last text.
    """
    nodes = _nodes(named)
    children = nodes.groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = written(
        nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    )
    told = totals(nodes, named, piece)
    return _with_parents(written(told.unionByName(_root(told, members(named, turnless)))))


def members(named: DataFrame, turnless: DataFrame) -> DataFrame:
    """(name, c): the node that each conversation ends at."""
    return (
        named.where(F.exists("turns", lambda t: t["ends"]))
        .select(F.element_at("names", -1).alias("name"), "c")
        .unionByName(turnless.select(F.lit(ROOT).alias("name"), "c"))
    )


def pieces(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """A row for each piece of the conversations in ``turns`` (c, q, turn, chars, ends).

    (c, b, turns, names, before), stored.

    ``names`` are the names of the prefixes that end in the piece, ``before`` that of
    the prefix one turn before it.
    """
    cut = turns.groupBy("c", F.floor(F.col("q") / piece).alias("b")).agg(
        F.sort_array(F.collect_list(F.struct("q", "turn", "chars", "ends"))).alias("turns")
    )
    found = written(cut.withColumn("name", F.sha2(F.concat_ws("", F.col("turns.turn")), 256)))
    height = (found.agg(F.max("b")).first()[0] or 0) + 1
    starts = _starts(found.select("c", F.col("b").alias("i"), "name"), height)
    ids = F.col("turns.turn")
    named = written(
        found.drop("name")
        .join(starts.withColumnRenamed("i", "b"), ["c", "b"])
        .withColumn("names", F.transform(
            F.sequence(F.lit(1), F.size("turns")),
            lambda k: digest(F.col("start"), F.concat_ws("", F.slice(ids, F.lit(1), k))),
        ))
        .drop("start")
    )
    ends = named.select("c", (F.col("b") + 1).alias("b"), F.element_at("names", -1).alias("before"))
    later = named.where("b > 0").join(ends, ["c", "b"])
    return written(named.where("b = 0").withColumn("before", F.lit(ROOT)).unionByName(later))


def _starts(segments: DataFrame, height: int) -> DataFrame:
    """(c, i, start): the name of the prefix in front of each segment (c, i, name).

    Two neighbouring segments are the halves of one; the recursion names what lies in
    front of that, and the cut between the halves is named from it and the upper half.
    """
    if height <= 1:
        return segments.select("c", "i", F.lit(ROOT).alias("start"))
    upper = F.col("i") % 2 == 0
    halves = written(
        segments.groupBy("c", F.shiftright("i", 1).alias("up")).agg(
            F.max(F.when(upper, F.col("name"))).alias("left"), F.max(F.when(~upper, F.col("name"))).alias("right")
        )
    )
    whole = halves.select("c", F.col("up").alias("i"), digest(F.col("left"), F.coalesce("right", F.lit(""))).alias("name"))
    starts = _starts(whole, (height + 1) // 2).withColumnRenamed("i", "up")
    both = halves.join(starts, ["c", "up"])
    # One row is both halves: read twice, each level would double the plan of those above it.
    i = F.col("up") * 2
    first = F.struct(i.alias("i"), F.col("start"))
    second = F.struct((i + 1).alias("i"), digest(F.col("start"), F.col("left")).alias("start"))
    return both.select("c", F.inline(F.when(F.col("right").isNull(), F.array(first)).otherwise(F.array(first, second))))


def _nodes(named: DataFrame) -> DataFrame:
    """(name, parent, depth, c, n_convs, chars): a row for each distinct prefix."""
    each = F.transform(
        "names",
        lambda name, k: F.struct(
            name.alias("name"),
            F.when(k == 0, F.col("before")).otherwise(F.get(F.col("names"), k - 1)).alias("parent"),
            (F.get(F.col("turns"), k)["q"] + 1).alias("depth"),
            F.get(F.col("turns"), k)["chars"].alias("chars"),
        ),
    )
    return (
        named.select("c", F.inline(each))
        .groupBy("name")
        .agg(
            F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("c").alias("c"),
            F.count("*").alias("n_convs"), F.max("chars").alias("chars"),
        )
    )


def totals(nodes: DataFrame, named: DataFrame, piece: int) -> DataFrame:
    """Adds n_leaves and saved, summed over each node's subtree; drops ``chars``."""
    q = F.col("depth") - 1
    own = nodes.select(
        "c", F.floor(q / piece).alias("b"), (q % piece + 1).cast("int").alias("k"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
        (F.col("n_children") == 0).cast("long").alias("n_leaves"),
    )
    paths = named.select("c", "b", "names")
    within = own.join(paths, ["c", "b"]).select(
        F.explode(F.slice("names", F.lit(1), F.col("k"))).alias("name"), "saved", "n_leaves"
    )
    found = nodes.drop("chars").join(_summed(within), "name")
    height = piece
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    while height < deepest:
        found = written(found)
        # Roots of lower pieces: the nodes right below a cut at half depth.
        lower = found.where((q % height == 0) & (F.floor(q / height) % 2 == 1))
        cuts = lower.groupBy("parent").agg(
            F.min("c").alias("c"), F.max(F.floor(q / piece)).alias("below"),
            F.sum("saved").alias("saved"), F.sum("n_leaves").alias("n_leaves"),
        )
        above = F.explode(F.sequence(F.col("below") - height // piece, F.col("below") - 1))
        grafts = (
            cuts.select("c", above.alias("b"), "saved", "n_leaves")
            .join(paths, ["c", "b"])
            .select(F.explode("names").alias("name"), "saved", "n_leaves")
        )
        more = _summed(grafts).withColumnsRenamed({"saved": "more", "n_leaves": "leaves"})
        found = found.join(more, "name", "left").withColumns({
            "saved": F.col("saved") + F.coalesce("more", F.lit(0)),
            "n_leaves": F.col("n_leaves") + F.coalesce("leaves", F.lit(0)),
        }).drop("more", "leaves")
        height *= 2
    return written(found)


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("name").agg(F.sum("saved").alias("saved"), F.sum("n_leaves").alias("n_leaves"))


def _root(nodes: DataFrame, ends: DataFrame) -> DataFrame:
    """The node of the empty prefix, where there is any conversation."""
    top = nodes.where("depth = 1").select("saved", "n_leaves")
    both = ends.select("c").unionByName(top, allowMissingColumns=True).agg(
        F.min("c").alias("c"), F.count("c").alias("n_convs"), F.count("saved").alias("n_children"),
        F.coalesce(F.sum("saved"), F.lit(0)).alias("saved"), F.coalesce(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"),
    )
    return both.where("n_convs > 0").select(
        F.lit(ROOT).alias("name"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("depth"), "*"
    )


def _with_parents(nodes: DataFrame) -> DataFrame:
    """Adds parent_c, the smallest conversation below the parent."""
    bound = max(COMMON, nodes.count() // SHARES)
    parents = nodes.select(F.col("name").alias("parent"), F.col("c").alias("parent_c"), "n_children")
    few = F.col("n_children") <= bound
    common = parents.where(~few).drop("n_children")  # at most SHARES rows
    met = nodes.join(F.broadcast(common), "parent", "left")
    known = F.col("parent_c").isNotNull()
    rest = met.where(~known).drop("parent_c").join(parents.where(few).drop("n_children"), "parent", "left")
    return met.where(known).unionByName(rest)


def id_digests(ends: DataFrame) -> DataFrame:
    """(name, ends_sha256): SHA-256 of a node's ids ``c``, ascending, with commas between.

    Ids are sorted in ranges and joined to texts of at most ``CHUNK`` of them, so that
    a node many conversations end at brings few rows to the one task that must hash
    them in order; that task reads them as a stream.
    """
    ranges = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = (
        ends.repartitionByRange(ranges, "name", "c")
        .sortWithinPartitions("name", "c")
        .mapInArrow(_chunks, "name string, first long, ids string")
    )
    return (
        chunks.repartition("name")
        .sortWithinPartitions("name", "first")
        .mapInArrow(_hashes, "name string, ends_sha256 string")
    )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made(rows: list[tuple[str, list[int]]]) -> pa.RecordBatch:
        columns = [r[0] for r in rows], [r[1][0] for r in rows], [",".join(map(str, r[1])) for r in rows]
        types = pa.string(), pa.int64(), pa.string()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["name", "first", "ids"]
        )

    name, ids = None, []
    for batch in batches:
        done = []
        for n, c in zip(batch.column("name").to_pylist(), batch.column("c").to_pylist(), strict=True):
            if n != name or len(ids) == CHUNK:
                if ids:
                    done.append((name, ids))
                name, ids = n, []
            ids.append(c)
        if done:
            yield made(done)
    if ids:
        yield made([(name, ids)])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made(rows: list[tuple[str, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)], ["name", "ends_sha256"]
        )

    name, state = None, None
    for batch in batches:
        done = []
        for n, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if n != name:
                if state:
                    done.append((name, state.hexdigest()))
                name, state = n, hashlib.sha256(ids.encode())
            else:
                state.update(f",{ids}".encode())
        if done:
            yield made(done)
    if state:
        yield made([(name, state.hexdigest())])


def hash_of_nothing() -> Column:
    """The digest where no conversation ends."""
    return F.lit(hashlib.sha256(b"").hexdigest())
