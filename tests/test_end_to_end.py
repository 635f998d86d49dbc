"""The reference's whole flow: bulk CSV -> validation -> order messages -> streamed matcher -> rankings."""

import datetime as dt

from bourse import schemas
from bourse.operators import sma, top_n, validate
from bourse.session import scratch_path
from bourse.sources import json_dir_stream, read_bulk_orders, read_instruments
from bourse.streaming.jobs import run_matcher
from bourse.streaming.sinks import publish_orders


def test_csv_to_trades_to_ranking(spark):
    base = scratch_path(spark, "t-e2e")
    as_of = dt.datetime(2024, 1, 1, 10, 0, 7)
    spark.createDataFrame(
        [("A", 10.0, 10, None), ("B", 50.0, 5, None)], schemas.INSTRUMENT
    ).write.option("header", True).csv(f"{base}/instruments")
    later = as_of + dt.timedelta(hours=2)
    spark.createDataFrame(
        [
            ("b1", "A", 12.0, 10, later, "Buy"),
            ("s1", "A", 11.0, 4, later, "Sell"),
            ("s2", "A", 10.0, 10, later, "Sell"),
            ("x1", "A", 5.0, 10, later, "Buy"),  # below market
            ("z1", "Z", 5.0, 1, later, "Buy"),  # unknown instrument
            ("b2", "B", 60.0, 5, later, "Buy"),
            ("s3", "B", 55.0, 5, later, "Sell"),
        ],
        schemas.BULK_ORDER,
    ).write.option("header", True).csv(f"{base}/bulk")
    accepted, rejected = validate(
        read_bulk_orders(spark, f"{base}/bulk"), read_instruments(spark, f"{base}/instruments"), as_of
    )
    assert {r.order_id: r.reject_reason for r in rejected.collect()} == {"x1": "below_market", "z1": "invalid_instrument"}
    publish_orders(accepted, path=f"{base}/landing")
    # a later message closes the window (end of the trading session)
    next_day = as_of + dt.timedelta(days=1)
    closing = spark.createDataFrame(
        [("close", "C", "Sell", 1.0, 1, next_day + dt.timedelta(days=1), next_day, next_day)], schemas.ORDER
    )
    publish_orders(closing, path=f"{base}/landing")
    q = run_matcher(json_dir_stream(spark, f"{base}/landing"), out_dir=f"{base}/out", checkpoint=f"{base}/ckpt",
                    window="1 hour", slide="1 hour", trigger={"availableNow": True})
    q.awaitTermination()
    trades = spark.read.parquet(f"{base}/out/trades")
    got = sorted((r.buy_order_id, r.sell_order_id, r.trade_volume) for r in trades.collect())
    # b1 (12 for 10) takes s1 (11 for 4) then s2 (10 for 10); b2 takes s3
    assert got == [("b1", "s1", 4), ("b1", "s2", 6), ("b2", "s3", 5)]
    best = top_n(sma(trades, "1 hour", "1 hour"), 4, "sma_price").collect()
    assert [r.instrument for r in best] == ["B", "A"]
