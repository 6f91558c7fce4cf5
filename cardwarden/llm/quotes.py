"""Quotation linking: reply-ordered conversations without quotes.

A line that begins with ``>`` marks is quoted, its level is their number.
Neighbouring lines of one level are a passage. Quoted passages, whole and line by
line, are normalised (lower case, single spaces) and hashed, and so are the whole
own text, the paragraphs and the lines of every message. A quote belongs to the
latest earlier message of its conversation that has its hash. The message a reply
answers is the one most of its first-level quotes belong to, or the message
before it if nothing links. Depths follow from jumping along the answers, which
doubles the distance with every round.

Everything is built-in expressions. What depends on order within a conversation
(previous message, latest earlier message with a hash, position) runs in blocks
of ``BLOCK`` turns with one carried value per block, so a conversation that holds
a third of all messages is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwarden.llm.frames import written

BLOCK = 4096  # turns of a conversation ordered in one task

# Fixed: what a mail or chat client puts in front of a quote.
MARKS = r"^(?:[ \t]*>)+"
ATTRIBUTION = r"(?i)^[ \t]*(?:on|am|le|el) .* (?:wrote|schrieb|a écrit|escribió):[ \t]*$"

_FIRST, _LAST = -(2**63), 2**63 - 1


def _messages(messages: DataFrame) -> DataFrame:
    """(c, t, m, conv_id, turn, role, lines): null ids and turns get a place of their own.

    ``m`` tells apart rows that repeat (conv_id, turn); equal rows share it.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return messages.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(_FIRST)).alias("c"),
        F.coalesce(F.col("turn").cast("long"), F.lit(_LAST)).alias("t"),
        F.xxhash64("role", text).alias("m"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.split(text, "\r?\n").alias("lines"),
    )


def _quoted(line: Column) -> Column:
    return line.rlike(MARKS)


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def _own_lines(lines: Column) -> Column:
    """A message's own lines: no quotes, and no attribution line right before one."""
    return F.filter(
        lines,
        lambda x, i: ~_quoted(x)
        & ~(x.rlike(ATTRIBUTION) & _quoted(F.coalesce(F.get(lines, i + 1), F.lit("")))),
    )


def _own_text(lines: Column) -> Column:
    return F.regexp_replace(F.array_join(_own_lines(lines), "\n"), r"^\s+|\s+$", "")


def passages(messages: DataFrame) -> DataFrame:
    """(c, t, m, passage, level, body, lines): quoted passages of every message, in order.

    ``body`` is the normalised passage and ``lines`` its normalised lines.
    """
    line = (
        _messages(messages)
        .where(F.exists("lines", _quoted))
        .select("c", "t", "m", "lines")
        .distinct()
        .select("c", "t", "m", F.posexplode("lines").alias("n", "line"))
        .withColumn("level", F.length(F.regexp_replace(F.regexp_extract("line", MARKS, 0), "[^>]", "")))
        .withColumn("body", _normal(F.regexp_replace("line", MARKS, "")))
    )
    message = Window.partitionBy("c", "t", "m").orderBy("n")
    new = F.coalesce((F.lag("level").over(message) != F.col("level")).cast("int"), F.lit(1))
    return (
        line.withColumn("new", new)
        .withColumn("passage", F.sum("new").over(message))
        .where("level > 0 AND body <> ''")
        .groupBy("c", "t", "m", "passage", "level")
        .agg(F.sort_array(F.collect_list(F.struct("n", "body"))).alias("found"))
        .select(
            "c", "t", "m", "passage", "level",
            F.array_join("found.body", " ").alias("body"), F.col("found.body").alias("lines"),
        )
    )


def _originals(messages: DataFrame) -> DataFrame:
    """(c, h, t): hashes of what each message says itself: whole, by paragraph and by line."""
    own = _own_lines(F.col("lines"))
    blocks = F.split(F.array_join(own, "\n"), r"\n[ \t]*\n")
    parts = F.concat(F.array(F.array_join(own, " ")), blocks, own)
    units = F.array_distinct(F.filter(F.transform(parts, _normal), lambda u: u != ""))
    return (
        _messages(messages)
        .select("c", "t", F.explode(F.transform(units, lambda u: F.xxhash64(u))).alias("h"))
        .distinct()
    )


def latest_before(rows: DataFrame, keys: list[str], source: str, out: str) -> DataFrame:
    """Adds ``out``: the greatest ``t`` of earlier rows with equal keys where ``source`` is true.

    Rows with the same ``t`` are not earlier. Works in blocks of turns and hands
    one value from block to block.
    """
    blocked = rows.withColumn("_b", F.floor(F.col("t") / BLOCK)).withColumn(
        "_v", F.when(F.col(source), F.col("t"))
    )
    inner = Window.partitionBy(*keys, "_b").orderBy("t").rangeBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        blocked.groupBy(*keys, "_b")
        .agg(F.max("_v").alias("_top"))
        .withColumn("_carry", F.max("_top").over(earlier))
        .drop("_top")
    )
    return (
        blocked.withColumn("_own", F.max("_v").over(inner))
        .join(carried, [*keys, "_b"])
        .withColumn(out, F.coalesce("_own", "_carry"))
        .drop("_b", "_v", "_own", "_carry")
    )


def links(messages: DataFrame) -> DataFrame:
    """(c, t, m, passage, level, kind, origin): the message each quote, or line of it, belongs to.

    ``kind`` 1 is a whole passage and 0 one of its lines; ``origin`` is the turn
    of the original, null where no earlier message of the conversation says it.
    """
    quoted = passages(messages).select(
        "c", "t", "m", "passage", "level",
        F.explode(
            F.concat(
                F.array(F.struct(F.lit(1).alias("kind"), F.xxhash64("body").alias("h"))),
                F.transform("lines", lambda x: F.struct(F.lit(0).alias("kind"), F.xxhash64(x).alias("h"))),
            )
        ).alias("u"),
    ).select("c", "t", "m", "passage", "level", "u.kind", "u.h")
    wanted = quoted.select("c", "h").distinct()
    said = _originals(messages).join(wanted, ["c", "h"], "left_semi")
    both = quoted.withColumn("said", F.lit(False)).unionByName(
        said.withColumn("said", F.lit(True)), allowMissingColumns=True
    )
    return (
        latest_before(both, ["c", "h"], "said", "origin")
        .where("NOT said")
        .select("c", "t", "m", "passage", "level", "kind", "origin")
    )


def _depths(nodes: DataFrame) -> DataFrame:
    """(c, t, depth, root_turn) from (c, t, parent): answers above a message, and the first of them."""
    now = nodes.select(
        "c", "t", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(1).alias("depth"),
        F.coalesce("parent", "t").alias("root_turn"),
    )
    while True:
        now = written(now)
        if not now.where("up IS NOT NULL").limit(1).count():
            return now.select("c", "t", "depth", "root_turn")
        above = now.select(
            "c", F.col("t").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_depth"),
            F.col("root_turn").alias("_root"),
        )
        now = now.join(above, ["c", "up"], "left").select(
            "c", "t", F.col("_up").alias("up"),
            (F.col("depth") + F.coalesce("_depth", F.lit(0))).alias("depth"),
            F.coalesce("_root", "root_turn").alias("root_turn"),
        )


def conversations(messages: DataFrame) -> DataFrame:
    """One row for each message, without quotes, with what it answers.

    ``messages`` has (conv_id, turn, role, text). Returns conv_id, turn, role,
    text (own words), parent_turn (null for the first), linked (whether a quote
    chose the parent), depth, root_turn, position (from 1 within the
    conversation; a parent always comes before its answers), n_quotes (passages)
    and n_linked (passages that found their original, whole or by a line).

    Null text is empty; an empty message answers and is answered like others. A
    null conv_id is a conversation of its own, a null turn comes last. Rows that
    repeat (conv_id, turn) stay, share parent and depth where their quotes agree,
    and are ordered by role and text. An empty table gives no rows; further
    columns are ignored.
    """
    rows = _messages(messages)
    found = links(messages)
    per_passage = found.groupBy("c", "t", "m", "passage", "level").agg(
        F.max(F.col("origin").isNotNull().cast("int")).alias("ok")
    )
    counted = per_passage.groupBy("c", "t", "m").agg(
        F.count("*").alias("n_quotes"), F.sum("ok").alias("n_linked")
    )
    # Of the first level: whole passages first, then the number of lines, then the latest.
    chosen = (
        found.where("level = 1 AND origin IS NOT NULL")
        .groupBy("c", "t", "origin")
        .agg(F.sum("kind").alias("whole"), F.count("*").alias("n"))
        .groupBy("c", "t")
        .agg(F.max(F.struct("whole", "n", "origin")).alias("best"))
        .select("c", "t", F.col("best.origin").alias("linked_turn"))
    )
    nodes = latest_before(
        rows.select("c", "t").distinct().withColumn("any", F.lit(True)), ["c"], "any", "previous"
    )
    parents = written(
        nodes.join(chosen, ["c", "t"], "left").select(
            "c", "t", F.coalesce("linked_turn", "previous").alias("parent"),
            F.col("linked_turn").isNotNull().alias("linked"),
        )
    )
    ranked = _positions(rows.withColumn("text", _own_text(F.col("lines"))).drop("lines"))
    told = (
        ranked.join(parents, ["c", "t"])
        .join(_depths(parents), ["c", "t"])
        .join(counted, ["c", "t", "m"], "left")
    )
    return told.select(
        "conv_id", "turn", "role", "text", _turn("parent").alias("parent_turn"), "linked",
        F.col("depth").cast("long").alias("depth"), _turn("root_turn").alias("root_turn"), "position",
        F.coalesce("n_quotes", F.lit(0).cast("long")).alias("n_quotes"),
        F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
    )


def _turn(column: str) -> Column:
    return F.when(F.col(column) != _LAST, F.col(column))


def _positions(rows: DataFrame) -> DataFrame:
    """Adds the place of each message in its conversation, counted in blocks of turns."""
    blocked = rows.withColumn("_b", F.floor(F.col("t") / BLOCK))
    earlier = Window.partitionBy("c").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        blocked.groupBy("c", "_b")
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    inner = Window.partitionBy("c", "_b").orderBy("t", "role", "text", "m")
    return (
        blocked.withColumn("_place", F.row_number().over(inner))
        .join(before, ["c", "_b"])
        .withColumn("position", (F.col("_before") + F.col("_place")).cast("long"))
        .drop("_b", "_before", "_place")
    )
