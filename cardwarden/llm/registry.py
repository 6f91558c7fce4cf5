"""The queries of this folder, and the SQL twins of those that SQL can express."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwarden.llm import (
    article, bpe_count, decontam, hnsw, langid, licenses, manifest, packing, quotes, simhash, suffixes, toxicity, trie, twins,
)
from cardwarden.llm.frames import crc_of_id, read_table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id"
    )


def vocabulary(name: str) -> str:
    """The path of a public tokenizer's file, the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return bpe_count.token_counts(docs, vocabulary("byte_bpe_50k.json"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs, langid.not_held_out()))
    return found.select("doc_id", (~langid.not_held_out()).alias("held_out"), "lang_pred", "score")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removal_report(read_table(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(read_table(spark, sf_dir, "documents")).drop("th")


def op6_quotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(read_table(spark, sf_dir, "conversations"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return packing.packed(docs, vocabulary("word_bpe_49k.json")).drop("th")


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return hnsw.search(vectors, F.col("vec_id") % 20 == 0)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (read_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return decontam.contaminated(docs, items).drop("th")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (read_table(spark, sf_dir, t) for t in ("documents", "labels"))
    lexicon = toxicity.fit(docs, labels, ~toxicity.held_out())
    return toxicity.scores(docs, lexicon).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", "predicted"
    )


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = article.extract(read_table(spark, sf_dir, "pages"), article.fit())
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, turnless = trie.rebuilt(read_table(spark, sf_dir, "conversations"), group=100, head=6)
    named = trie.pieces(turns)
    nodes = trie.trie(named, turnless)
    ends = trie.id_digests(trie.members(named, turnless))
    return nodes.join(ends, "name", "left").select(
        F.col("c").alias("conv_id"), "depth", F.col("parent_c").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", trie.hash_of_nothing()).alias("ends_sha256"),
    )


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    tampered = F.coalesce(crc_of_id() % 5 == 0, F.lit(False))
    leaves = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        manifest.leaf().alias("leaf"), F.when(tampered, manifest.leaf(text=lowered)).alias("changed"),
    )
    proved = manifest.prove(leaves)
    folded = manifest.folded(F.coalesce("changed", "leaf"), F.col("proof"))
    return proved.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(F.concat_ws("", manifest.all_siblings(F.col("proof"))), 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One query for each operator, over its whole table."""
    found = (
        op1_simhash,
        op2_token_counts,
        op3_language_id,
        op4_suffix_dedup,
        op5_licenses,
        op6_quotations,
        op7_packing,
        op8_nearest_neighbours,
        op9_decontamination,
        op10_toxicity,
        op11_main_text,
        op12_conversation_trie,
        op13_manifest,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op12_conversation_trie": twins.TRIE, "op13_manifest": twins.MANIFEST}
