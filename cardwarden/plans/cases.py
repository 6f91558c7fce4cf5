"""Case queue, narratives and the flagged-case table."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.risk import REASON_CODES, has_code, split_codes
from ..operators.dedup import union_distinct
from ..operators.select import nonempty_codes, with_code

# Wording of the template narrative, one phrase per reason code.
PHRASES = {
    "new_device_recent": "a login from a new device shortly before",
    "geo_mismatch": "a login away from the home place",
    "failed_logins_burst": "a burst of failed logins",
    "ato_signal": "an account-takeover signal",
}


def _first_then_risk(first: Column) -> list[Column]:
    return [
        F.when(first, 0).otherwise(1).asc(), F.col("risk_score").desc_nulls_last(),
        F.col("txn_ts").desc_nulls_last(), F.col("txn_id").asc(),
    ]


def _never() -> Column:
    return F.lit(False)


def _with_narrative(top: DataFrame, cases: DataFrame, order: list[Column]) -> DataFrame:
    """Adds the narratives of a short, already cut list.

    The case table is first reduced to the listed ids. The list has a fixed
    number of rows, so broadcasting its ids is safe and the big table is not
    shuffled.
    """
    wanted = cases.select("txn_id", "reason_narrative").join(
        F.broadcast(top.select("txn_id")), "txn_id", "left_semi"
    )
    joined = top.join(wanted, "txn_id", "left")
    return joined.orderBy(*order)  # a join keeps no order


def case_queue(scored: DataFrame, cases: DataFrame, first_txn=None, n: int = 12) -> DataFrame:
    """Transactions with the takeover signal, a named one first, then by risk; with narrative.

    The queue is cut to ``n`` before the narratives are looked up.
    """
    first = F.col("txn_id") == F.lit(first_txn) if first_txn is not None else _never()
    top = scored.where(first | has_code("ato_signal")).orderBy(*_first_then_risk(first)).limit(n)
    return _with_narrative(top, cases, _first_then_risk(first))


def flagged(scored: DataFrame, n: int = 10, first_account=None) -> DataFrame:
    """The ``n`` riskiest transactions with a reason code, a named account's first."""
    first = F.col("account_id") == F.lit(first_account) if first_account is not None else _never()
    return nonempty_codes(scored).orderBy(*_first_then_risk(first)).limit(n)


def head_by_time(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` earliest transactions."""
    return df.orderBy("txn_ts", "txn_id").limit(n)


def queue_from_table(scored: DataFrame, first_txn, n: int = 8) -> DataFrame:
    """A named transaction together with the ``n`` earliest that carry the signal, each once."""
    named = scored.where(F.col("txn_id") == F.lit(first_txn))
    both = union_distinct([named, head_by_time(with_code(scored, "ato_signal"), n)], "txn_id")
    return both.orderBy(F.col("txn_id") != F.lit(first_txn), "txn_ts", "txn_id")


def top_risk_approved(scored: DataFrame, cases: DataFrame, n: int = 10) -> DataFrame:
    """The riskiest approved transactions with their narrative."""
    top = (
        scored.where(F.col("decision") == "approve").orderBy(*_first_then_risk(_never())).limit(n)
    )
    return _with_narrative(top, cases, _first_then_risk(_never()))


def narrative() -> Column:
    """Template text from the fired codes; null when none fired, so no story is made up."""
    said = F.create_map(*[x for c in REASON_CODES for x in (F.lit(c), F.lit(PHRASES[c]))])
    fired = F.array_compact(F.transform(split_codes(), lambda c: F.try_element_at(said, c)))
    text = F.concat(
        F.lit("Account "), F.col("account_id").cast("string"), F.lit(" spent $"),
        F.format_string("%.2f", "amount"), F.lit(" after "), F.array_join(fired, ", "),
        F.lit(". Codes: "), F.col("reason_codes"), F.lit("."),
    )
    return F.when(F.size(fired) > 0, text)


def add_narrative(
    df: DataFrame, narrator: Callable[[pd.DataFrame], pd.Series] | None = None
) -> DataFrame:
    """Adds ``reason_narrative``.

    ``narrator`` gets a batch of flagged rows and returns their texts, for users
    with a text service; the default is the template, which stays in the JVM.
    """
    if narrator is None:
        return df.withColumn("reason_narrative", narrative())

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            wanted = batch["reason_codes"].fillna("") != ""
            texts = pd.Series([None] * len(batch), index=batch.index, dtype=object)
            if wanted.any():
                texts[wanted] = narrator(batch[wanted])
            yield batch.assign(reason_narrative=texts)

    schema = df.withColumn("reason_narrative", F.lit(None).cast("string")).schema
    return df.mapInPandas(tell, schema)


def build_cases(
    scored: DataFrame, n: int | None = None, first_account=None,
    narrator: Callable[[pd.DataFrame], pd.Series] | None = None,
) -> DataFrame:
    """The case table: flagged transactions with narrative and analyst columns.

    All flagged rows by default; with ``n`` the riskiest ones. Rows without a
    code never become a case.
    """
    rows = nonempty_codes(scored) if n is None else flagged(scored, n, first_account)
    return add_narrative(rows, narrator).select(
        F.concat(F.lit("CASE-"), F.col("txn_id").cast("string")).alias("case_id"),
        "txn_id", "account_id", "amount", "risk_score", "reason_codes", "reason_narrative",
        F.lit("open").alias("analyst_status"), F.lit("shared").alias("division_view"),
    )


def case_export(queue: DataFrame) -> DataFrame:
    """The queue's columns as exported, codes as an array."""
    return queue.select(
        "account_id", "txn_id", "amount", "risk_score", "model_version",
        split_codes().alias("reason_codes"), "reason_narrative",
        F.col("txn_ts").alias("as_of"), "decision", "minutes_since_new_device_login",
        "geo_mismatch_flag", "failed_logins_1h", "recent_ato_label", "device_is_new",
    )
