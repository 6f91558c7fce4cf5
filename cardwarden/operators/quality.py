"""Typed projection and row rules. Everything here also runs on a streaming frame."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import CASTS


@dataclass(frozen=True)
class Rule:
    """A row predicate. ``drop`` rules remove failing rows, ``warn`` rules only count them."""

    name: str
    predicate: str
    action: str = "drop"

    def passes(self) -> Column:
        """True where the predicate holds; a null outcome is a failure."""
        return F.coalesce(F.expr(self.predicate), F.lit(False))


RULES = {
    "auth": [
        Rule("valid_account", "account_id IS NOT NULL"),
        Rule("ts_present", "event_ts IS NOT NULL", "warn"),
    ],
    "txn": [
        Rule("valid_txn", "txn_id IS NOT NULL AND account_id IS NOT NULL"),
        Rule("valid_amount", "amount > 0"),
    ],
    "accounts": [Rule("valid_acct_master", "account_id IS NOT NULL")],
}


def _typed(raw: str, kind: str) -> Column:
    if kind == "timestamp":
        return F.try_to_timestamp(F.col(raw))
    return F.col(raw).try_cast(kind)


def to_silver(df: DataFrame, feed: str) -> DataFrame:
    """Raw text columns to typed ones. Text that does not parse becomes null, so that a
    rule can drop the row; a plain cast would fail the job."""
    return df.select(*[_typed(raw, kind).alias(name) for raw, name, kind in CASTS[feed]])


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Removes rows that fail a ``drop`` rule."""
    for rule in rules:
        if rule.action == "drop":
            df = df.where(rule.passes())
    return df


def flag_warnings(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``violates_<rule>`` (0/1) per ``warn`` rule; no row is removed."""
    flags = {
        f"violates_{r.name}": (~r.passes()).cast("int") for r in rules if r.action == "warn"
    }
    return df.withColumns(flags) if flags else df


def _tallies(rules: Sequence[Rule]) -> list[Column]:
    return [F.count("*").alias("n_in")] + [
        F.count_if(r.passes()).alias(f"pass_{r.name}") for r in rules
    ]


def rule_report(df: DataFrame, feed: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per rule: rows in, rows passing, percent. One pass; no rows gives a null percent.

    The row ``all_drop_rules`` is the share that survives every ``drop`` rule.
    """
    kept = F.lit(True)
    for r in rules:
        if r.action == "drop":
            kept = kept & r.passes()
    counts = df.agg(*_tallies(rules), F.count_if(kept).alias("pass_all_drop_rules"))
    names = [r.name for r in rules] + ["all_drop_rules"]
    lines = F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(f"pass_{n}").alias("n_pass")) for n in names
    ])
    return counts.select("n_in", F.explode(lines).alias("line")).select(
        F.lit(feed).alias("feed"),
        F.col("line.rule").alias("rule"),
        "n_in",
        F.col("line.n_pass").alias("n_pass"),
        F.round(F.try_divide(F.lit(100.0) * F.col("line.n_pass"), F.col("n_in")), 4).alias(
            "pass_pct"
        ),
    )


def observed(df: DataFrame, rules: Sequence[Rule], into: Observation | str) -> DataFrame:
    """Counts the rules while the frame is written, at no extra pass.

    ``into`` is an ``Observation`` for a batch job, or a name under which a
    stream reports the counts per micro-batch.
    """
    return df.observe(into, *_tallies(rules))
