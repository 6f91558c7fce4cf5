"""Stream-static gold: each micro-batch of transactions against what has landed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.gold import fuse
from ..schemas import GOLD_COLUMNS
from .run import start_batches, write_batch


def fuse_microbatch(batch: DataFrame, logins: DataFrame, accounts: DataFrame) -> DataFrame:
    """Gold for one micro-batch; only its accounts' logins and master rows go on."""
    ours = batch.select("account_id").distinct()
    logins = logins.join(ours, "account_id", "left_semi")
    accounts = accounts.join(ours, "account_id", "left_semi")
    return fuse(batch, logins, accounts).select(*GOLD_COLUMNS)


def start_enrich(
    txn: DataFrame,
    logins_of: Callable[[DataFrame], DataFrame],
    read_accounts: Callable[[SparkSession], DataFrame],
    path: str,
    checkpoint: str,
    trigger: str | None = None,
) -> StreamingQuery:
    """Enriches a transaction stream and stores gold per micro-batch.

    ``logins_of`` gives the logins that a micro-batch can need, as ``login_index.logins_for``
    does from an index; both it and the master are asked anew for every batch. A transaction is enriched once,
    with the logins landed by then, and not revised when a login arrives late;
    ``asof_stream.fuse_stream`` waits for late logins instead.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        held = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            gold = fuse_microbatch(held, logins_of(held), read_accounts(spark))
            write_batch(gold, batch_id, path)
        finally:
            held.unpersist()

    return start_batches(txn, handle, checkpoint, trigger)
