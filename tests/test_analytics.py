import datetime as dt

from bourse import schemas
from bourse.operators import profit, sma, top_n

D0 = dt.datetime(2024, 1, 1, 0, 0)


def _trades(spark):
    rows = []
    # older window (00:00-00:10): three instruments
    for inst, bp, sp in [("A", 5.0, 4.0), ("B", 7.0, 1.0), ("C", 6.0, 5.5)]:
        rows.append((inst, "b", bp, "s", sp, 1, D0 + dt.timedelta(minutes=1)))
    # newest window (00:10-00:20): two instruments
    for inst, bp, sp in [("A", 3.0, 2.0), ("B", 9.0, 8.5)]:
        rows.append((inst, "b", bp, "s", sp, 1, D0 + dt.timedelta(minutes=11)))
    rows.append(("B", "b", 1.0, "s", 1.0, 5, D0 + dt.timedelta(minutes=12)))
    return spark.createDataFrame(rows, schemas.TRADE)


def test_g8_top_n_spills_into_older_window(spark):
    s = sma(_trades(spark), "10 minutes", "10 minutes")
    got = [(r.instrument, r.sma_price, r.w_start_time.minute) for r in top_n(s, 4, "sma_price").collect()]
    # unweighted by volume: B newest = (9 + 1) / 2
    assert got == [("B", 5.0, 10), ("A", 3.0, 10), ("B", 7.0, 0), ("C", 6.0, 0)]


def test_g8_profit_top1(spark):
    p = profit(_trades(spark), "10 minutes", "10 minutes")
    got = top_n(p, 1, "profit").collect()
    assert len(got) == 1 and got[0].instrument == "A" and got[0].profit == 1.0
    assert got[0].closing_sma_price == 3.0 and got[0].opening_sma_price == 2.0


def test_sliding_counts_each_trade_twice(spark):
    s = sma(_trades(spark), "10 minutes", "5 minutes")
    assert s.count() == 3 * 2 + 2 * 2 - 0  # A,B,C in two windows each; A,B newest in two windows (B merges)
