import datetime as dt

from bourse import schemas
from bourse.cli import run
from bourse.session import scratch_path
from tests.helpers import frame, order


def test_cli_match_and_stream_match(spark):
    base = scratch_path(spark, "t-cli")
    orders = [order("b1", "Buy", 10, 5, 0), order("s1", "Sell", 8, 3, 10), order("x", "buy", 1, 1, 20)]
    frame(spark, orders).write.parquet(f"{base}/orders")
    run(["match", "--orders", f"{base}/orders", "--out", f"{base}/batch", "--window", "1 hour", "--slide", "1 hour"], spark)
    t = spark.read.parquet(f"{base}/batch/trades").collect()
    assert [(r.buy_order_id, r.sell_order_id, r.trade_volume) for r in t] == [("b1", "s1", 3)]
    assert spark.read.parquet(f"{base}/batch/rejected").first().reject_reason == "unknown_side"


def test_cli_validate_then_stream(spark):
    base = scratch_path(spark, "t-cli2")
    as_of = dt.datetime(2024, 1, 1, 22, 0, 0)
    spark.createDataFrame([("A", 10.0, 10, None)], schemas.INSTRUMENT).write.option("header", True).csv(f"{base}/inst")
    later = as_of + dt.timedelta(hours=3)
    spark.createDataFrame(
        [("b1", "A", 12.0, 10, later, "Buy"), ("s1", "A", 11.0, 10, later, "Sell")], schemas.BULK_ORDER
    ).write.option("header", True).csv(f"{base}/bulk")
    run(["validate", "--orders", f"{base}/bulk", "--instruments", f"{base}/inst", "--as-of", as_of.isoformat(),
         "--out", f"{base}/v"], spark)
    # the same orders accepted two hours later move the watermark past the first window
    run(["validate", "--orders", f"{base}/bulk", "--instruments", f"{base}/inst",
         "--as-of", (as_of + dt.timedelta(hours=2)).isoformat(), "--out", f"{base}/v2"], spark)
    q = run(["stream-match", "--input", f"{base}/v*/orders", "--checkpoint", f"{base}/ck", "--out", f"{base}/m",
             "--window", "1 hour", "--slide", "1 hour", "--trigger", "available-now"], spark)
    q.awaitTermination()
    t = spark.read.parquet(f"{base}/m/trades").collect()
    assert sorted((r.buy_order_id, r.sell_order_id) for r in t) == [("b1", "s1")]


def test_cli_stream_sma_snapshot(spark):
    from bourse.functions import encode

    base = scratch_path(spark, "t-cli3")
    t0 = dt.datetime(2024, 1, 1, 0, 0)
    trades = spark.createDataFrame(
        [
            ("A", "b1", 5.0, "s1", 4.0, 1, t0 + dt.timedelta(minutes=1)),
            ("B", "b2", 7.0, "s2", 1.0, 1, t0 + dt.timedelta(minutes=2)),
            ("A", "b3", 3.0, "s3", 2.0, 1, t0 + dt.timedelta(minutes=11)),
        ],
        schemas.TRADE,
    )
    encode(trades, ["buy_order_id", "sell_order_id", "execution_time"]).select("value").write.text(f"{base}/trades")
    q = run(["stream-sma", "--input", f"{base}/trades", "--checkpoint", f"{base}/ck", "--sink", "snapshot",
             "--out", f"{base}/top", "--window", "10 minutes", "--slide", "10 minutes", "--trigger", "available-now"], spark)
    q.awaitTermination()
    got = [(r.instrument, r.sma_price, r.w_start_time.minute) for r in spark.read.parquet(f"{base}/top").collect()]
    assert sorted(got, key=lambda x: (-x[2], -x[1])) == [("A", 3.0, 10), ("B", 7.0, 0), ("A", 5.0, 0)]
