import datetime as dt
import json

from pyspark.sql import functions as F

from bourse import schemas
from bourse.functions import decode_wire_orders, encode_wire_orders, message_key, quarantine
from bourse.operators import assign_windows, carry_forward, union_orders, validate
from tests.helpers import T0, frame, order


def test_g3_decode_and_quarantine(spark):
    good = {"order_id": "b1", "instrument": "A", "price": 10.0, "volume": 5, "expiry": "2024-01-02 00:00:00",
            "buy_sell": "Buy", "order_time": 1704146400, "initial_order_time": 1704146400}
    rows = [
        json.dumps(good),
        "not json",
        json.dumps({**good, "order_id": "t", "order_time": "bad"}),
        json.dumps({**good, "order_id": "v3", "volume": 3.0}),
        json.dumps({**good, "order_id": "v0", "volume": 0}),
        json.dumps({k: v for k, v in good.items() if k != "price"} | {"order_id": "np"}),
        "null",
    ]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    dec = decode_wire_orders(df)
    ok, bad = quarantine(dec)
    got = ok.collect()
    assert len(got) == 1 and got[0].order_id == "b1"
    assert got[0].order_time == dt.datetime(2024, 1, 1, 22, 0, 0)
    assert got[0].expiry == dt.datetime(2024, 1, 2, 0, 0, 0)
    reasons = {r.order_id: r.reject_reason for r in bad.collect()}
    assert reasons["t"] == "missing_order_time"
    assert reasons["v3"] == "missing_volume"
    assert reasons["v0"] == "non_positive_volume"
    assert reasons["np"] == "missing_price"
    assert bad.count() == 6


def test_wire_roundtrip_and_keys(spark):
    o = [order("b1", "Buy", 10, 5, 7)]
    env = encode_wire_orders(frame(spark, o))
    r = env.first()
    assert r.key == f"b1_{int((T0 + dt.timedelta(seconds=7)).replace(tzinfo=dt.timezone.utc).timestamp())}"
    back = decode_wire_orders(env).first()
    assert back.order_time == T0 + dt.timedelta(seconds=7) and back.volume == 5
    k = spark.range(1).select(message_key(F.lit("a"), F.lit(None).cast("string")).alias("k")).first().k
    assert k is None


def test_g4_validation(spark):
    inst = spark.createDataFrame([("A", 100.0, 10, None)], schemas.INSTRUMENT)
    as_of = dt.datetime(2024, 1, 1, 12, 0, 0)
    past = dt.datetime(2024, 1, 1, 11, 0, 0)
    rows = [
        ("u", "Z", 1.0, 1, past, "Buy"),       # unknown and expired -> invalid_instrument
        ("e", "A", 1.0, 10, past, "Buy"),      # expired and cheap -> expired
        ("c", "A", 99.0, 10, as_of + dt.timedelta(hours=1), "Buy"),   # 9.90 < 10.00
        ("ok", "A", 100.0, 10, as_of + dt.timedelta(hours=1), "Buy"),
        ("cs", "A", 99.0, 10, as_of + dt.timedelta(hours=1), "Sell"),
        ("eq", "A", 100.0, 10, as_of, "Sell"),  # expiry == as_of is accepted
    ]
    orders = spark.createDataFrame(rows, schemas.BULK_ORDER)
    acc, rej = validate(orders, inst, as_of)
    reasons = {r.order_id: r.reject_reason for r in rej.collect()}
    assert reasons == {"u": "invalid_instrument", "e": "expired", "c": "below_market", "cs": "below_market"}
    a = {r.order_id: r for r in acc.collect()}
    assert set(a) == {"ok", "eq"}
    assert a["ok"].order_time == as_of and a["ok"].initial_order_time == as_of
    assert a["eq"].expiry_text == "2024-01-01 12:00:00"


def test_g5_windows(spark):
    df = frame(spark, [order("a", "Buy", 1, 1, 15 * 60), order("b", "Buy", 1, 1, 18 * 60 + 30)])
    nul = spark.createDataFrame([("n", "A", "Buy", 1.0, 1, T0, None, None)], schemas.ORDER)
    w = assign_windows(df.unionByName(nul), window="10 minutes", slide="5 minutes")
    got = sorted((r.order_id, r.w_start.strftime("%H:%M"), r.w_end.strftime("%H:%M")) for r in w.collect())
    assert got == [
        ("a", "22:10", "22:20"), ("a", "22:15", "22:25"),
        ("b", "22:10", "22:20"), ("b", "22:15", "22:25"),
    ]


def test_carry_forward_union(spark):
    rem = spark.createDataFrame(
        [("A", "s2", 1, 9.0, "Sell", T0, T0 - dt.timedelta(hours=1), T0 + dt.timedelta(hours=2))], schemas.REMAINING
    )
    c = carry_forward(rem).first()
    assert c.order_time == T0 and c.initial_order_time == T0 - dt.timedelta(hours=1) and c.volume == 1
    u = union_orders(frame(spark, [order("b1", "Buy", 10, 5)]), carry_forward(rem))
    assert u.count() == 2 and u.columns == schemas.ORDER_COLS


def test_decode_accepts_iso_reorder_messages(spark):
    from bourse.functions import encode

    rem = spark.createDataFrame(
        [("A", "s2", 1, 9.0, "Sell", T0, T0 - dt.timedelta(hours=1), T0 + dt.timedelta(hours=2))], schemas.REMAINING
    )
    back = decode_wire_orders(encode(rem, ["order_id", "order_time"])).first()
    assert back.order_time == T0 and back.initial_order_time == T0 - dt.timedelta(hours=1)
    assert back.expiry == T0 + dt.timedelta(hours=2) and back.volume == 1 and back.buy_sell == "Sell"


def test_validation_without_broadcast_matches(spark):
    inst = spark.createDataFrame([("A", 100.0, 10, None), ("B", 5.0, 1, None)], schemas.INSTRUMENT)
    as_of = dt.datetime(2024, 1, 1, 12, 0, 0)
    later = as_of + dt.timedelta(hours=1)
    rows = [(f"o{i}", "A" if i % 3 else "Z", 90.0 + i, 10, later, "Buy") for i in range(30)]
    orders = spark.createDataFrame(rows, schemas.BULK_ORDER)
    a1, r1 = validate(orders, inst, as_of)
    a2, r2 = validate(orders, inst, as_of, broadcast_max_rows=1)  # forces the salted shuffle join
    assert sorted(a1.collect()) == sorted(a2.collect()) and sorted(r1.collect()) == sorted(r2.collect())


def test_order_book_pages(spark):
    from bourse.operators import order_book

    orders = [order(f"o{i}", "Buy" if i % 2 else "Sell", 10 + i, 1, t=i) for i in range(7)]
    w = assign_windows(frame(spark, orders), window="1 hour", slide="1 hour")
    one = order_book(w).collect()
    assert len(one) == 1 and [e.order_id for e in one[0].book] == [f"o{i}" for i in range(7)]
    pages = sorted(order_book(w, page_size=3).collect(), key=lambda r: r.page)
    assert [r.page for r in pages] == [0, 1, 2] and [r.n_orders for r in pages] == [3, 3, 1]
    assert [e.order_id for r in pages for e in r.book] == [f"o{i}" for i in range(7)]


def test_nan_price_is_rejected(spark):
    o = spark.createDataFrame([tuple(order("n", "Sell", float("nan"), 1))], schemas.ORDER)
    good, bad = quarantine(o)
    assert good.count() == 0 and bad.first().reject_reason == "invalid_price"
    inst = spark.createDataFrame([("A", 1.0, 1, None)], schemas.INSTRUMENT)
    bulk = spark.createDataFrame([("n", "A", float("nan"), 1, T0, "Buy")], schemas.BULK_ORDER)
    _, rej = validate(bulk, inst, T0 - dt.timedelta(hours=1))
    assert rej.first().reject_reason == "malformed"


def test_copies_of_a_large_lookup_table_are_not_broadcast(spark, tmp_path, capsys):
    orders = spark.createDataFrame([("o1", "A", 10.0, 1, T0, "Buy")], schemas.BULK_ORDER)
    orders.write.parquet(str(tmp_path / "in"))
    listed = spark.createDataFrame([("A", 1.0, 1, None), ("B", 1.0, 1, None)], schemas.INSTRUMENT)
    stream = spark.readStream.schema(schemas.BULK_ORDER).parquet(str(tmp_path / "in"))
    accepted, _ = validate(stream, listed, T0, broadcast_max_rows=1)
    q = accepted.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ckpt"))
    q = q.trigger(availableNow=True).start(str(tmp_path / "out"))
    q.awaitTermination()
    capsys.readouterr()
    q.explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    batch, _ = validate(orders, listed, T0, broadcast_max_rows=1)
    assert "SortMergeJoin [instrument" in batch._jdf.queryExecution().executedPlan().toString()
