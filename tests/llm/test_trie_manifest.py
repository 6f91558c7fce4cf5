"""The conversation trie and the Merkle manifest against plain versions."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from tests_llm_frames import awkward, empty, sentence

from cardwarden.llm import manifest, order, trie

CONVERSATIONS = "conv_id long, turn long, role string, text string, c long, q string, name int, ends boolean"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_trie(rows, group=100, head=6):
    convs = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    said = {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}
    built = {}
    for c in said:
        h = zlib.crc32(str(c).encode()) % head
        built[c] = tuple(said.get(c - c % group, [])[:h] + said[c][h:])
    below = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            below[turns[:d]].append(c)
    found = []
    for node, members in below.items():
        children = [x for x in below if len(x) == len(node) + 1 and x[:-1] == node]
        subtree = [x for x in below if x[: len(node)] == node]
        leaves = [x for x in subtree if not any(len(y) == len(x) + 1 and y[:-1] == x for y in subtree)]
        saved = sum((len(below[x]) - 1) * len(x[-1][1]) for x in subtree if x)
        ends = sorted(c for c in members if len(built[c]) == len(node))
        found.append((
            min(members), len(node), min(below[node[:-1]]) if node else None, len(members), len(children),
            len(leaves), saved, sha(",".join(map(str, ends))),
        ))
    return sorted(found, key=str)


def spark_trie(df, piece):
    turns, turnless = trie.rebuilt(df, 100, 6)
    named = trie.pieces(turns, piece)
    ends = trie.id_digests(trie.members(named, turnless))
    nodes = trie.trie(named, turnless, piece).join(ends, "name", "left")
    nodes = nodes.select(
        "c", "depth", "parent_c", "n_convs", "n_children", "n_leaves", "saved",
        F.coalesce("ends_sha256", trie.hash_of_nothing()),
    )
    return sorted(map(tuple, nodes.collect()), key=str)


def chats(rng):
    rows = []
    for c in [*range(60), 100, 101, 102, 110, 199, 205, 211]:  # 200 is absent
        for turn in range(rng.choice([1, 2, 3, 5, 9])):
            rows.append((c, turn, rng.choice(["user", "bot"]), rng.choice(["hi", "so", "Ünï", "a b"])))
    rows += [(300, t, "user", sentence(rng, 2)) for t in range(70)]  # one very long conversation
    rows += [(301, t, "user", f"turn {t}") for t in range(9)]
    rows += [(302, None, None, None), (302, None, "user", ""), (302, 1, "user", "x"), (302, 1, "user", "x")]
    rows += [(302, 1, "bot", "x"), (None, 0, "user", "lost"), (None, None, None, None), (303, 4, None, "y" * 50_000)]
    return [(*r, 7, "clash", 1, True) for r in rows]


@pytest.mark.parametrize("piece", [1, 4])
def test_trie_equals_plain_version(spark, piece):
    rows = chats(random.Random(3))
    assert spark_trie(spark.createDataFrame(rows, CONVERSATIONS), piece) == plain_trie(rows)


def test_trie_with_common_prefixes_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(trie, "COMMON", 3)
    monkeypatch.setattr(trie, "CHUNK", 4)
    rows = [(c, t, "user", f"{t if t < 3 else c % 7} said") for c in range(300, 360) for t in range(5)]
    rows = [(*r, 7, "clash", 1, True) for r in rows]
    assert spark_trie(spark.createDataFrame(rows, CONVERSATIONS), 4) == plain_trie(rows)
    assert spark_trie(spark.createDataFrame([], CONVERSATIONS), 4) == []


def test_plan_grows_with_the_levels_of_a_long_conversation(spark):
    segments = 64  # six levels
    rows = [(c, i, sha(f"{i}" if i < 40 else f"{c} {i}")) for c in (1, 2) for i in range(segments)]
    starts = trie._starts(spark.createDataFrame(rows, "c long, i long, name string"), segments)
    assert starts._jdf.queryExecution().optimizedPlan().toString().count("Join") <= 6
    found = {(r.c, r.i): r.start for r in starts.collect()}
    assert set(found) == {(c, i) for c in (1, 2) for i in range(segments)}
    assert [found[1, i] == found[2, i] for i in range(segments)] == [i <= 40 for i in range(segments)]
    assert len(set(found.values())) == 41 + 2 * 23


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_manifest(rows, changed):
    """(doc_id, leaf) -> (subroot, root, siblings of all levels), and each folded root."""

    def levels(nodes):
        while len(nodes) > 1:
            yield nodes
            nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        yield nodes

    sources = defaultdict(list)
    for row in rows:
        sources[row[1]].append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
        trees[s] = list(levels([r[2] for r in sources[s]]))
    top = list(levels([trees[s][-1][0] for s in names]))
    found = []
    for at, s in enumerate(names):
        for i, row in enumerate(sources[s]):
            steps = []
            for place, tree in ((i, trees[s]), (at, top)):
                for nodes in tree[:-1]:
                    first = place - place % 16
                    steps.append((nodes[first:place], nodes[place + 1 : first + 16]))
                    place //= 16
            node = changed.get(row, row[2])
            for left, right in steps:
                node = sha("".join([*left, node, *right]))
            proof = sha("".join(x for left, right in steps for x in left + right))
            found.append((row[0], row[2], trees[s][-1][0], top[-1][0], proof, node))
    return sorted(found, key=str)


def spark_manifest(df, levels):
    proved = manifest.prove(df, levels)
    return sorted(map(tuple, proved.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.concat_ws("", manifest.all_siblings(F.col("proof"))), 256),
        manifest.folded(F.coalesce("changed", "leaf"), F.col("proof")),
    ).collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2])
def test_manifest_equals_plain_version(spark, levels):
    rng = random.Random(8)
    rows, changed = [], {}
    # one source with most rows, a null source, many small ones, sizes around the fanout
    sizes = {"hot": 4200, None: 20, "one": 1, "ab": 16, "ä": 17, "Z": 257, "": 2}
    sizes |= {f"s{i}": rng.randrange(1, 4) for i in range(290)}
    for source, n in sizes.items():
        for i in range(n):
            doc_id = None if i == 1 else (i // 2 if i < 12 else i * 3)  # ids that repeat
            row = (doc_id, source, sha(f"{source} {i // 3 if i < 12 else i}"))
            rows.append(row)
            if rng.random() < 0.2:
                changed[row] = sha(f"changed {i}")
    rows = sorted(set(rows), key=str)  # repeated rows are tested below
    df = spark.createDataFrame(
        [(*r, changed.get(r)) for r in rows], "doc_id long, source string, leaf string, changed string"
    )
    assert spark_manifest(df, levels) == plain_manifest(rows, changed)


def test_manifest_of_awkward_rows(spark):
    docs = awkward(spark).withColumn("source", F.lit("x")).withColumn("n_chars", F.col("fp"))
    leaves = docs.select("doc_id", "source", manifest.leaf().alias("leaf"), F.lit(None).cast("string").alias("changed"))
    rows = [tuple(r)[:3] for r in leaves.collect()]
    text = docs.where("doc_id = 3").first()
    assert (3, "x", sha("".join(map(encoded, (3, "x", text.lang, text.n_chars, text.text))))) in rows
    none = docs.where("doc_id = 2").select(manifest.leaf()).first()[0]
    assert none == sha("1:2" + "1:x" + "-" + "1:1" + "-")
    assert spark_manifest(leaves, 1) == plain_manifest(rows, {})
    nothing = empty(spark).withColumn("n_chars", F.lit(1))
    none = nothing.select("doc_id", "source", manifest.leaf().alias("leaf"), F.lit("").alias("changed"))
    assert spark_manifest(none, 3) == []
    one = leaves.where("doc_id = 3")
    found = spark_manifest(one, 3)[0]
    assert found[1] == found[2] == found[3] == found[5] and found[4] == sha("")


def test_numbered_spreads_one_key(spark):
    rows = spark.range(20_000).select(F.lit("k").alias("key"), (F.col("id") % 3).alias("x"))
    placed = order.numbered(rows, ["key", "x"], "at")
    assert [r.at for r in placed.orderBy("x", "at").select("at").collect()] == list(range(20_000))
    keys = order.spans(placed, "key", "at")
    assert order.with_key_columns(placed, "at", keys, "key").count() == 20_000
