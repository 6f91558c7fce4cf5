"""How much state the keyed streams keep, and that lists too long for a key's head lose nothing."""

import pytest
import test_streams as plain
from frames import auth_frame, login, spend, txn_frame

from cardwarden.session import scratch_path
from cardwarden.sources.feeds import read_table
from cardwarden.streaming import asof_stream, row_velocity, run


def most_rows(query):
    """The most entries that the stream's state had after a micro-batch."""
    query.awaitTermination()
    return max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress)


def test_accounts_of_an_hour_share_state(spark):
    asof_stream.use_rocksdb(spark)
    root, accounts = scratch_path(spark, "row-velocity"), 400
    txn_frame(spark, *[spend(f"t{i}", f"A{i}", i % 60) for i in range(accounts)]).coalesce(1).write.parquet(f"{root}/in")
    stream = row_velocity.velocity_per_row(read_table(spark, f"{root}/in", streaming=True))
    assert most_rows(run.start(stream, f"{root}/out", f"{root}/cp")) < 2 * accounts
    told = row_velocity.settled(spark.read.parquet(f"{root}/out"))
    assert {(r.txn_id, r.account_id, r.txn_velocity_1h) for r in told.collect()} == {
        (f"t{i}", f"A{i}", 1) for i in range(accounts)
    }


def test_an_ordinary_account_is_one_value(spark):
    asof_stream.use_rocksdb(spark)
    root, hours = scratch_path(spark, "asof"), 100
    txn_frame(spark, *[spend(f"t{i}", "A", 60 * i) for i in range(hours)]).coalesce(1).write.parquet(f"{root}/txn")
    auth_frame(spark, *[login(f"e{i}", "A", 60 * i) for i in range(hours)]).coalesce(1).write.parquet(f"{root}/auth")
    stream = asof_stream.fuse_stream(
        read_table(spark, f"{root}/txn", streaming=True), read_table(spark, f"{root}/auth", streaming=True)
    )
    assert most_rows(run.start(stream, f"{root}/out", f"{root}/cp")) < hours
    rows = asof_stream.settled(spark.read.parquet(f"{root}/out")).collect()
    assert {(r.txn_id, r.last_event_id) for r in rows} == {(f"t{i}", f"e{i}") for i in range(hours)}


@pytest.mark.parametrize("most", [2])
def test_long_lists_lie_beside_the_head(spark, monkeypatch, most):
    monkeypatch.setattr(asof_stream, "HEAD_ROWS", most)
    plain.test_stream_asof_loses_no_row(spark)
    plain.test_stream_asof_folds_old_logins(spark)
    plain.test_velocity_per_row_with_late_rows(spark)


def test_bins_with_many_rows_lie_beside_the_head(spark, monkeypatch):
    monkeypatch.setattr(row_velocity, "BIN_ROWS", 5)
    monkeypatch.setattr(row_velocity, "BINS", 1)
    plain.test_velocity_per_row_with_late_rows(spark)
