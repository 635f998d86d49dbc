"""Several queries as one job, late rows counted, order entry and the feedback loop."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from bourse import schemas
from bourse.cli import run
from bourse.functions import encode
from bourse.operators import assign_windows, carry_forward, match_orders, validate
from bourse.plans import sizing
from bourse.session import path_exists, scratch_path
from bourse.sources import message_dir_stream
from bourse.streaming.jobs import feedback_trades, run_feedback, run_ingest, run_matcher, window_table
from bourse.streaming.registered import _stream
from bourse.streaming.sinks import start
from bourse.streaming.supervise import QueryFailed, log_progress, read_metrics, supervise
from tests.helpers import T0, frame, order


def _numbers(spark, base, name, fail=False):
    def sink(batch, batch_id):
        if fail:
            raise RuntimeError("this sink is broken")
        batch.write.mode("append").parquet(f"{base}/{name}")

    rate = spark.readStream.format("rate").option("rowsPerSecond", 5).load()
    return start(rate, "foreach_batch", f"{base}/ck-{name}", foreach_batch=sink, query_name=name)


def test_one_failure_stops_the_others_with_its_cause(spark):
    base = scratch_path(spark, "t-supervise")
    good = _numbers(spark, base, "good_one")
    bad = _numbers(spark, base, "bad_one", fail=True)
    with pytest.raises(QueryFailed, match="this sink is broken") as e:
        supervise(spark, [good, bad], timeout=60)
    assert e.value.query == "bad_one" and not good.isActive


def test_supervision_waits_for_all_and_may_time_out(spark):
    base = scratch_path(spark, "t-supervise")
    q = _numbers(spark, base, "endless")
    assert supervise(spark, [q], timeout=2) is False and q.isActive
    q.stop()
    assert supervise(spark, [q]) is True and supervise(spark, []) is True


def test_cli_windows_two_queries_and_a_broken_one(spark):
    base = scratch_path(spark, "t-cli-w")
    t0 = dt.datetime(2024, 1, 1)
    rows = [("A", f"b{i}", 5.0 + i, f"s{i}", 4.0, 1, t0 + dt.timedelta(minutes=i)) for i in range(20)]
    encode(spark.createDataFrame(rows, schemas.TRADE), ["buy_order_id"]).select("value").write.text(f"{base}/in")
    job = ["stream-windows", "--input", f"{base}/in", "--out", f"{base}/out", "--window", "10 minutes", "--slide", "10 minutes", "--trigger", "available-now"]
    assert supervise(spark, run([*job, "--checkpoint", f"{base}/ck"], spark))
    assert [r.sma_price for r in window_table(spark, f"{base}/out/sma").current().orderBy("w_start_time").collect()] == [9.5, 19.5]
    profit = window_table(spark, f"{base}/out/profit", "profit").current().orderBy("w_start_time").collect()
    assert [r.profit for r in profit] == [5.5, 15.5]


def test_cli_match_keeps_rejects_in_the_same_query_and_a_broken_rejects_sink_ends_the_job(spark):
    base = scratch_path(spark, "t-cli-r")
    from bourse.functions import encode_wire_orders

    orders = [order("b1", "Buy", 10, 5, 0), order("s1", "Sell", 8, 3, 10), order("x", "buy", 1, 1, 20)]
    encode_wire_orders(frame(spark, orders)).select("value").write.text(f"{base}/in")
    job = ["stream-match", "--input", f"{base}/in", "--window", "1 hour", "--slide", "1 hour", "--emit", "on_update", "--trigger", "available-now"]
    supervise(spark, [run([*job, "--checkpoint", f"{base}/ck", "--out", f"{base}/out"], spark)])
    assert [(r.order_id, r.reject_reason) for r in spark.read.parquet(f"{base}/out/rejected").collect()] == [("x", "unknown_side")]
    assert spark.read.parquet(f"{base}/out/trades").count() == 1
    scratch = scratch_path(spark, "t-broken")
    with open(_local(scratch), "w") as fh:
        fh.write("a file where the rejects folder should be")
    with pytest.raises(QueryFailed):
        supervise(spark, [run([*job, "--checkpoint", f"{base}/ck2", "--out", scratch], spark)])


def _local(path):
    import os

    os.makedirs(path, exist_ok=True)
    return f"{path}/rejected"


def test_progress_log_counts_late_rows(spark):
    base = scratch_path(spark, "t-metrics")
    at = lambda d: T0 + dt.timedelta(days=d)
    for i, day in enumerate([0, 3, 4, 0]):
        o = order(f"o{i}", "Buy", 1, 1, expiry=at(9))._replace(order_time=at(day), initial_order_time=at(day))
        frame(spark, [o, o._replace(order_id=f"p{i}")]).write.parquet(f"{base}/in/s{i}")
    log = log_progress(spark, f"{base}/metrics", "late_counts")
    q = run_matcher(
        _stream(spark, base, schemas.ORDER, 1), f"{base}/out", f"{base}/ck", "1 hour", "1 hour", query_name="late_counts", trigger={"availableNow": True}
    )
    q.awaitTermination()
    log.close()
    lines = read_metrics(spark, f"{base}/metrics")
    assert lines.agg(F.sum("late_rows"), F.sum("input_rows")).first()[:] == (2, 8)
    assert lines.select("batch_id").distinct().count() == lines.count()


def test_validation_of_a_stream_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(sizing, "STREAM_SALTS", 3)
    base = scratch_path(spark, "t-val-stream")
    later, as_of = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 1)
    rows = [(f"o{i}", "A" if i % 4 else "Z", 90.0 + i, 10, later, "Buy") for i in range(60)]
    spark.createDataFrame(rows, schemas.BULK_ORDER).write.parquet(f"{base}/in/a")
    listed = spark.createDataFrame([("A", 100.0, 10, None), ("B", 1.0, 1, None)], schemas.INSTRUMENT)
    stream = spark.readStream.schema(schemas.BULK_ORDER).parquet(f"{base}/in/*")
    got = []
    for name, part in zip(("a", "r"), validate(stream, listed, as_of, broadcast_max_rows=1)):
        part.writeStream.option("checkpointLocation", f"{base}/ck{name}").trigger(availableNow=True).format("parquet").start(f"{base}/{name}").awaitTermination()
        got.append(sorted(r.order_id for r in spark.read.parquet(f"{base}/{name}").collect()))
    want = [sorted(r.order_id for r in part.collect()) for part in validate(spark.createDataFrame(rows, schemas.BULK_ORDER), listed, as_of)]
    assert got == want and all(want)


def test_ingest_keeps_keys_and_a_retried_batch_shows_its_messages_once(spark):
    base = scratch_path(spark, "t-ingest")
    later, as_of = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 1, 0, 0, 7)
    spark.createDataFrame([("b1", "A", 12.0, 10, later, "Buy"), ("z", "Z", 1.0, 1, later, "Buy")], schemas.BULK_ORDER).write.option("header", True).csv(f"{base}/in")
    listed = spark.createDataFrame([("A", 10.0, 10, None)], schemas.INSTRUMENT)
    from bourse.sources import bulk_order_stream

    def go(**how):
        return run_ingest(bulk_order_stream(spark, f"{base}/in"), listed, f"{base}/out", f"{base}/ck", as_of, trigger={"availableNow": True}, **how)

    def fault(batch_id):
        raise RuntimeError("stopped before the commit")

    with pytest.raises(Exception, match="before the commit"):
        go(before_commit=fault).awaitTermination()
    files = [r[0] for r in spark.read.parquet(f"{base}/out/orders").select(F.input_file_name()).collect()]
    go().awaitTermination()
    assert [r[0] for r in spark.read.parquet(f"{base}/out/orders").select(F.input_file_name()).collect()] == files
    assert [(r.order_id, r.reject_reason) for r in spark.read.parquet(f"{base}/out/rejected").collect()] == [("z", "invalid_instrument")]
    sink = message_dir_stream(spark, f"{base}/out/orders").writeStream.format("parquet").option("checkpointLocation", f"{base}/ck-r")
    sink.trigger(availableNow=True).start(f"{base}/read").awaitTermination()
    row = spark.read.parquet(f"{base}/read").first()
    assert row.key == "b1_1704067207" and '"order_id":"b1"' in row.value


@pytest.mark.parametrize("policy", ["independent", "depleting"])
def test_feedback_equals_explicit_rounds_and_goes_on_after_a_stop(spark, policy):
    rnd = random.Random(6)
    day = dt.timedelta(days=1)
    orders = [order(f"o{i}", rnd.choice(["Buy", "Sell"]), rnd.randint(1, 9), rnd.randint(1, 9), rnd.randint(0, 3 * 3600), f"I{i % 2}", expiry=T0 + 9 * day) for i in range(40)]
    times = [T0 + n * day for n in (1, 2, 3, 4)]
    base = scratch_path(spark, "t-feedback")
    frame(spark, orders).write.parquet(f"{base}/in/a")
    how = dict(window="1 hour", slide="1 hour", policy=policy)
    stream = _stream(spark, base, schemas.ORDER)
    assert run_feedback(stream, f"{base}/out", f"{base}/ck", as_of=times, max_rounds=1, **how) == 1  # stopped after a round
    rounds = run_feedback(stream, f"{base}/out", f"{base}/ck", as_of=times, **how)
    want, now = [], frame(spark, orders)
    for r in range(rounds):
        m = match_orders(assign_windows(now, window="1 hour", slide="1 hour"), as_of=times[r], policy=policy)
        want += [(r, t.buy_order_id, t.sell_order_id, t.trade_volume) for t in m.trades.collect()]
        now = carry_forward(m.remaining).checkpoint()
    got = [(t["round"], t.buy_order_id, t.sell_order_id, t.trade_volume) for t in feedback_trades(spark, f"{base}/out", rounds).collect()]
    assert sorted(got) == sorted(want) and rounds > 1
    assert path_exists(spark, f"{base}/out/_rounds/0")
