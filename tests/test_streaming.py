import datetime as dt
import json
import os
import random

from pyspark.sql import functions as F

from bourse import schemas
from bourse.operators import assign_windows, match_orders
from bourse.session import scratch_path
from bourse.sources import json_dir_stream
from bourse.streaming.jobs import run_matcher
from bourse.streaming.registered import _end_of_stream, _stream
from tests.helpers import T0, frame, order

AVAILABLE_NOW = {"availableNow": True}


def _wire(o):
    return json.dumps(
        {
            "order_id": o.order_id, "instrument": o.instrument, "price": o.price, "volume": o.volume,
            "expiry": o.expiry.strftime("%Y-%m-%d %H:%M:%S"), "buy_sell": o.buy_sell,
            "order_time": int(o.order_time.replace(tzinfo=dt.timezone.utc).timestamp()),
            "initial_order_time": int(o.initial_order_time.replace(tzinfo=dt.timezone.utc).timestamp()),
        }
    )


def _land_json(path, batches):
    os.makedirs(path, exist_ok=True)
    for i, rows in enumerate(batches):
        f = os.path.join(path, f"part-{i:03d}.json")
        with open(f, "w") as fh:
            fh.write("\n".join(_wire(o) for o in rows) + "\n")
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))


def _trades(spark, out):
    return [
        (r.w_start, r.buy_order_id, r.sell_order_id, r.trade_volume)
        for r in spark.read.parquet(f"{out}/trades").collect()
    ]


def test_g6_late_data_is_dropped(spark):
    base = scratch_path(spark, "t-late")
    at = lambda h, m, s=0: T0.replace(hour=h, minute=m, second=s)
    b1 = order("b1", "Buy", 10, 5, expiry=at(23, 59) + dt.timedelta(hours=3))._replace(order_time=at(22, 15), initial_order_time=at(22, 15))
    s2 = b1._replace(order_id="s2", buy_sell="Sell", price=9.0, volume=2, order_time=at(22, 15, 20), initial_order_time=at(22, 15, 20))
    b9 = b1._replace(order_id="b9", order_time=at(23, 36, 40), initial_order_time=at(23, 36, 40))
    late1 = s2._replace(order_id="late1", price=8.0, volume=1, order_time=at(22, 15), initial_order_time=at(22, 15))
    late2 = late1._replace(order_id="late2")
    _land_json(f"{base}/in", [[b1], [s2], [b9], [late1], [], [late2]])
    q = run_matcher(
        json_dir_stream(spark, f"{base}/in", max_files_per_trigger=1),
        out_dir=f"{base}/out", checkpoint=f"{base}/ckpt",
        window="10 minutes", slide="5 minutes", watermark="10 minutes", trigger=AVAILABLE_NOW,
    )
    q.awaitTermination()
    got = _trades(spark, f"{base}/out")
    pairs = {(b, s) for _, b, s, _ in got}
    assert ("b1", "s2") in pairs
    assert {w.strftime("%H:%M") for w, b, s, _ in got if (b, s) == ("b1", "s2")} == {"22:10", "22:15"}
    assert not any(s == "late2" for _, _, s, _ in got)


def _books_over_hours(seed, n=400):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        t = rnd.randint(0, 5 * 3600)
        side = "Buy" if rnd.random() < 0.5 else "Sell"
        out.append(order(f"o{i}", side, round(rnd.uniform(1, 50), 2), rnd.randint(1, 20), t, f"I{i % 3}", expiry_h=12))
    return out


def _batch_trades(spark, orders):
    m = match_orders(assign_windows(frame(spark, orders), window="1 hour", slide="30 minutes"))
    return sorted((r.w_start, r.buy_order_id, r.sell_order_id, r.trade_volume) for r in m.trades.collect())


def _land_slices(spark, df, base, lo_hi_slices, first=0):
    for i, (lo, hi) in enumerate(lo_hi_slices, start=first):
        df.where((F.col("order_time") >= F.lit(lo)) & (F.col("order_time") < F.lit(hi))).write.parquet(f"{base}/in/s{i:03d}")


def test_stream_equals_batch_and_survives_restart(spark):
    orders = _books_over_hours(11)
    df = frame(spark, orders)
    base = scratch_path(spark, "t-restart")
    hour = dt.timedelta(hours=1)
    slices = [(T0 + hour * i, T0 + hour * (i + 1)) for i in range(6)]

    def run():
        q = run_matcher(
            _stream(spark, base, schemas.ORDER), out_dir=f"{base}/out", checkpoint=f"{base}/ckpt",
            window="1 hour", slide="30 minutes", watermark="10 minutes", trigger=AVAILABLE_NOW,
        )
        q.awaitTermination()

    _land_slices(spark, df, base, slices[:3])
    run()  # first run stops after three slices
    _land_slices(spark, df, base, slices[3:], first=3)
    _end_of_stream(spark, base, df)
    run()  # restart from the same checkpoint
    got = sorted(_trades(spark, f"{base}/out"))
    assert got == _batch_trades(spark, orders)
    assert len(got) > 0


def test_g7_update_mode_rematches_changed_books(spark):
    base = scratch_path(spark, "t-update")
    b1 = order("b1", "Buy", 10, 5, 0, expiry_h=30)
    s1 = order("s1", "Sell", 8, 3, 10, expiry_h=30)
    s2 = order("s2", "Sell", 9, 3, 20, expiry_h=30)
    _land_json(f"{base}/in", [[b1, s1], [s2]])
    q = run_matcher(
        json_dir_stream(spark, f"{base}/in", max_files_per_trigger=1),
        out_dir=f"{base}/out", checkpoint=f"{base}/ckpt", window="10 minutes", slide="5 minutes",
        watermark="10 minutes", emit="on_update", trigger=AVAILABLE_NOW,
    )
    q.awaitTermination()
    rows = spark.read.parquet(f"{base}/out/trades").collect()
    per_batch = {}
    for r in rows:
        per_batch.setdefault(r.batch_id, set()).add((r.w_start.strftime("%H:%M"), r.buy_order_id, r.sell_order_id))
    assert per_batch[0] == {("21:55", "b1", "s1"), ("22:00", "b1", "s1")}
    assert per_batch[1] == {(w, "b1", s) for w in ("21:55", "22:00") for s in ("s1", "s2")}


def test_feedback_loop_reenters_leftovers(spark):
    """Leftovers written to the re-order folder come back through the second source of the same stream."""
    base = scratch_path(spark, "t-loop2")
    day = dt.timedelta(days=1)
    carry_at = T0 + 2 * day  # leftovers re-enter at this time (the matcher's as_of)
    b1 = order("b1", "Buy", 10, 5, 0, expiry=T0 + 5 * day)
    s1 = order("s1", "Sell", 8, 3, 10, expiry=T0 + 5 * day)
    mark1 = order("m1", "Sell", 1, 1, instrument="M", expiry=T0 + 5 * day)._replace(
        order_time=T0 + day, initial_order_time=T0 + day)
    os.makedirs(f"{base}/reorders/none", exist_ok=True)
    _land_json(f"{base}/in", [[b1, s1, mark1]])

    def run():
        orders = json_dir_stream(spark, f"{base}/in").unionByName(json_dir_stream(spark, f"{base}/reorders/*"))
        q = run_matcher(orders, out_dir=f"{base}/out", checkpoint=f"{base}/ckpt", window="1 hour", slide="1 hour",
                        as_of=carry_at, reorder_dir=f"{base}/reorders", trigger=AVAILABLE_NOW)
        q.awaitTermination()

    run()
    first = spark.read.parquet(f"{base}/out/trades").collect()
    assert [(r.buy_order_id, r.sell_order_id, r.trade_volume) for r in first] == [("b1", "s1", 3)]
    # next session: a new sell arrives after the carried buy, and a later order closes its window
    s2 = order("s2", "Sell", 3, 1, expiry=T0 + 5 * day)._replace(
        order_time=carry_at + dt.timedelta(minutes=5), initial_order_time=carry_at + dt.timedelta(minutes=5))
    mark2 = mark1._replace(order_id="m2", order_time=T0 + 3 * day, initial_order_time=T0 + 3 * day)
    path = f"{base}/in/part-{9:03d}.json"
    with open(path, "w") as fh:
        fh.write("\n".join(_wire(o) for o in [s2, mark2]) + "\n")
    run()
    trades = spark.read.parquet(f"{base}/out/trades").where("sell_order_id = 's2'").collect()
    # the carried buy keeps its total price 10 for its remaining 2 units: 10 / 2 per unit
    assert [(r.buy_order_id, r.trade_volume, r.per_volume_buy_price) for r in trades] == [("b1", 1, 5.0)]
    rest = spark.read.parquet(f"{base}/out/remaining").where("order_id = 'b1' AND volume = 1").collect()
    assert len(rest) == 1 and rest[0].initial_order_time == T0


def test_micro_batches_are_whole_slices(spark, tmp_path):
    """However many files a table's partitions make, a slice is never split over micro-batches."""
    from bourse.streaming import registered

    orders = frame(spark, [order(f"o{i}", "Buy", 10, 1, 60 * i) for i in range(40)]).repartition(3)
    base = registered.land_in_time_order(spark, orders, "order_time", "t-slices")
    registered._end_of_stream(spark, base, orders)
    names = [f"s{i:03d}" for i in range(registered.SLICES)] + ["zz-end"]
    assert [registered._files(spark, f"{base}/in/{n}") for n in names] == [3] * 5
    seen = []
    stream = registered._stream(spark, base, schemas.ORDER, files_per_batch=2)
    q = stream.writeStream.foreachBatch(lambda b, i: seen.append(sorted(int(r[0][1:]) for r in b.select("order_id").collect() if r[0] != "end-of-stream")))
    q.option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start().awaitTermination()
    assert seen == [list(range(10 * i, 10 * i + 10)) for i in range(4)] + [[]]
