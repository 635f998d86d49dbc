"""Tables that a stream writes while others read them: whole versions, retried batches, bounded size."""

import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from bourse import schemas
from bourse.operators.analytics import sma, top_n
from bourse.session import folder_names, scratch_path
from bourse.streaming.jobs import order_table, run_matcher, run_ranking, run_window_upserts, sma_top_stream, window_table
from bourse.streaming.registered import _stream
from bourse.streaming.snapshots import KeyedTable, SnapshotTable, read_snapshot
from tests.helpers import T0, frame, order

ROW = "k string, n long"


def _table(spark, name, cls=SnapshotTable, **how):
    schema = spark.createDataFrame([], ROW).schema
    return cls(spark, scratch_path(spark, name), schema, **how)


def _rows(df):
    return sorted((r.k, r.n) for r in df.collect())


def test_a_version_shows_only_once_it_is_committed(spark):
    t = _table(spark, "t-commit")
    assert t.last_commit() is None and t.read().count() == 0
    with pytest.raises(ValueError, match="nothing committed"):
        read_snapshot(spark, t.path)
    t.replace(spark.createDataFrame([("a", 1)], ROW), 0)
    t._write(spark.createDataFrame([("a", 2), ("b", 2)], ROW), 1)  # a batch that fails here has no commit
    assert _rows(t.read()) == [("a", 1)] and _rows(read_snapshot(spark, t.path)) == [("a", 1)]
    t.replace(spark.createDataFrame([("c", 3)], ROW), 1)  # and is written anew
    assert _rows(t.read()) == [("c", 3)]
    t.replace(spark.createDataFrame([("d", 4)], ROW), 1)  # a batch run again after its commit writes nothing
    assert _rows(t.read()) == [("c", 3)]


def test_old_versions_go_and_a_planned_read_still_ends(spark):
    t = _table(spark, "t-keep", keep=2)
    for v in range(3):
        t.replace(spark.createDataFrame([("a", v)], ROW), v)
    planned = t.read()
    t.replace(spark.createDataFrame([("a", 3)], ROW), 3)
    assert _rows(planned) == [("a", 2)]
    assert [n for n in folder_names(spark, t.path) if n.startswith("version=")] == ["version=2", "version=3"]
    assert len([n for n in folder_names(spark, f"{t.path}/_commits") if n.isdigit()]) == 2


def test_upserts_last_batch_wins_and_compaction_changes_no_row(spark):
    t = _table(spark, "t-upsert", KeyedTable, key=["k"], compact_every=2)
    batches = [[("a", 1), ("b", 1)], [("a", 2)], [], [("c", 5), ("b", 7)], [("a", None)]]
    for i, rows in enumerate(batches):
        t.upsert(spark.createDataFrame(rows, ROW), i)
        t.upsert(spark.createDataFrame([("z", 9)], ROW), i)  # run again: no change
        before = {(r.k, r.n) for r in t.current().collect()}
        t.compact(i)
        assert {(r.k, r.n) for r in t.current().collect()} == before
        assert len(t.state()["versions"]) <= 3
    assert {(r.k, r.n) for r in t.current().collect()} == {("a", None), ("b", 7), ("c", 5)}
    assert t.compact(9, force=True) and t.read().count() == 3


def test_a_table_belongs_to_one_checkpoint(spark):
    base = scratch_path(spark, "t-own")
    frame(spark, [order("b1", "Buy", 1, 1)]).write.parquet(f"{base}/in/a")
    run = dict(window="1 hour", slide="1 hour", emit="on_update", trigger={"availableNow": True})
    stream = _stream(spark, base, schemas.ORDER)
    run_matcher(stream, f"{base}/out", f"{base}/ck", **run).awaitTermination()
    run_matcher(stream, f"{base}/out", f"{base}/ck", **run).awaitTermination()
    with pytest.raises(ValueError, match="new checkpoint"):
        run_matcher(stream, f"{base}/out", f"{base}/other", **run)


def _trades(spark, n, start):
    return spark.createDataFrame(
        [("AB"[i % 2], f"b{i}", float(start + i), f"s{i}", 1.0, 1, T0 + dt.timedelta(minutes=start + i % 7)) for i in range(n)], schemas.TRADE
    )


def test_a_reader_during_a_ranking_run_always_sees_one_whole_version(spark):
    base = scratch_path(spark, "t-reader")
    for i in range(6):
        _trades(spark, 20, 10 * i).write.parquet(f"{base}/in/s{i}")
    q = run_ranking(
        sma_top_stream(_stream(spark, base, schemas.TRADE, 1), "10 minutes", "10 minutes"), "snapshot",
        checkpoint=f"{base}/ck", path=f"{base}/top", trigger={"availableNow": True},
    )
    seen, wrong, done = [], [], threading.Event()

    def read():
        while not done.is_set():
            try:
                seen.append(read_snapshot(spark, f"{base}/top").count())
            except ValueError:
                pass  # nothing committed yet
            except Exception as e:  # noqa: BLE001
                wrong.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    q.awaitTermination()
    done.set()
    reader.join()
    assert not wrong and set(seen) <= {2, 4} and seen  # two instruments a window, top 4
    every = spark.read.schema(schemas.TRADE).parquet(f"{base}/in/*")
    want = top_n(sma(every, "10 minutes", "10 minutes"), 4, "sma_price").collect()
    assert sorted(map(str, read_snapshot(spark, f"{base}/top").collect())) == sorted(map(str, want))


def test_window_upserts_survive_a_failure_before_the_commit(spark):
    base = scratch_path(spark, "t-up-fail")
    for i in range(5):
        _trades(spark, 12, 15 * i).write.parquet(f"{base}/in/s{i}")
    calls = []

    def fault(batch_id):
        calls.append(batch_id)
        if len(calls) in (1, 4):
            raise RuntimeError("stopped before the commit")

    for _ in range(3):
        q = run_window_upserts(
            _stream(spark, base, schemas.TRADE, 1), f"{base}/t", f"{base}/ck", "sma", "10 minutes", "5 minutes", "1 day",
            compact_every=2, trigger={"availableNow": True}, before_commit=fault,
        )
        try:
            q.awaitTermination()
        except Exception:  # noqa: BLE001
            assert q.exception() is not None
    table = window_table(spark, f"{base}/t")
    every = spark.read.schema(schemas.TRADE).parquet(f"{base}/in/*")
    want = sma(every, "10 minutes", "5 minutes").collect()
    got = table.current().collect()
    assert {(r.instrument, r.w_start_time, round(r.sma_price, 9)) for r in got} == {(r.instrument, r.w_start_time, round(r.sma_price, 9)) for r in want}
    assert len(got) == len(want) and len(calls) > 5 and len(table.state()["versions"]) <= 3


def test_order_table_drops_closed_windows_and_stays_small(spark):
    base = scratch_path(spark, "t-expiry")
    days = 7
    for d in range(days):
        at = T0 + dt.timedelta(days=d)
        rows = [order(f"o{d}-{i}", "Buy" if i % 2 else "Sell", 5 + i % 3, 2, expiry=at + dt.timedelta(days=9))._replace(order_time=at, initial_order_time=at) for i in range(10)]
        frame(spark, rows).write.parquet(f"{base}/in/s{d:02d}")
    run = dict(window="1 hour", slide="1 hour", watermark="10 minutes", emit="on_update", compact_every=1)
    q = run_matcher(_stream(spark, base, schemas.ORDER, 1), f"{base}/out", f"{base}/ck", trigger={"availableNow": True}, **run)
    q.awaitTermination()
    table = order_table(spark, f"{base}/out")
    kept = table.read()
    # each day's orders close the windows of the days before; the watermark lags two batches behind
    assert kept.select("w_start").distinct().count() <= 4 < days
    assert kept.count() <= 40 and len(table.state()["versions"]) <= 2
    assert len([n for n in folder_names(spark, table.path) if n.startswith("version=")]) <= 4
    from bourse.streaming.jobs import last_emission

    trades = last_emission(spark, f"{base}/out")
    # the rule gives every buy of a day the first sells at or below its price
    assert trades.select("w_start").distinct().count() == days
    assert trades.groupBy("w_start").count().select(F.countDistinct("count")).first()[0] == 1
