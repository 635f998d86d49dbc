"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the driver tables.

Times are returned as ``timestamp_ntz`` and averages as ``decimal(18,6)`` so
results compare value-for-value with the SQL oracle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse.functions.codec import decode, decode_wire_orders, encode, encode_reorders, encode_wire_orders, quarantine
from bourse.functions.columns import PROFIT_TOP_N, SMA_TOP_N, TRADE_KEY, message_key, order_id_expr
from bourse.operators.analytics import profit, sma, top_n
from bourse.operators.book import assign_windows, order_book, price_ladder
from bourse.operators.matching import match_orders, reference_view
from bourse.operators.orders import carry_forward, live, split_sides, union_orders, validate
from bourse import schemas
from bourse.session import prepare, scratch_path
from bourse.sources.files import read_bulk_orders, read_instruments
from bourse.sources.tables import (
    M1_SLIDE,
    M1_WINDOW,
    M3_SLIDE,
    M3_WINDOW,
    instruments_from_parts,
    orders_from_events,
    orders_from_lineitem,
    read_table,
    trades_from_lineitem,
)

# M2 validation instant: lines shipped before it are expired orders
M2_AS_OF = dt.datetime(1995, 6, 17, 0, 0, 0)


def ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in cols else F.col(c) for c in df.columns])


def dec6(df: DataFrame, *cols: str) -> DataFrame:
    """Averages to 6 decimals, half up.

    Float sums differ in the last bits with summation order; rounding to 9
    decimals first absorbs that, so an average lying exactly half-way at the
    6th decimal rounds the same way whatever the order of the sum.
    """
    def r6(c: str):
        return F.col(c).cast("decimal(18,9)").cast("decimal(18,6)").alias(c)

    return df.select(*[r6(c) if c in cols else F.col(c) for c in df.columns])


# ---------- shared inputs ----------

def m1_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_from_events(read_table(prepare(spark), sf_dir, "events"))


def m1_good_windowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = quarantine(m1_orders(spark, sf_dir))
    return assign_windows(good, "order_time", M1_WINDOW, M1_SLIDE)


def m1_match(spark: SparkSession, sf_dir: str):
    return match_orders(m1_good_windowed(spark, sf_dir))


def m3_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades_from_lineitem(read_table(prepare(spark), sf_dir, "lineitem"))


# ---------- codec ----------

def q_decode_orders(spark, sf_dir):
    wire = encode_wire_orders(m1_orders(spark, sf_dir))
    out = decode_wire_orders(wire)
    return ntz(out, "expiry", "order_time", "initial_order_time")


def q_quarantine(spark, sf_dir):
    _, bad = quarantine(m1_orders(spark, sf_dir))
    return bad.select("order_id", "instrument", "buy_sell", "volume", "reject_reason")


def q_envelope_roundtrip(spark, sf_dir):
    env = encode(m3_trades(spark, sf_dir), ["buy_order_id", "sell_order_id", "execution_time"])
    out = decode(env, schemas.TRADE)
    return ntz(out, "execution_time")


def q_order_id(spark, sf_dir):
    o = m1_orders(spark, sf_dir)
    return o.select(
        "order_id",
        order_id_expr("buy_sell", "instrument", "order_time").alias("wire_order_id"),
        message_key("order_id", F.unix_timestamp("order_time")).alias("producer_key"),
    )


def q_message_key(spark, sf_dir):
    t = m3_trades(spark, sf_dir)
    return t.select(
        "buy_order_id",
        message_key("buy_order_id", "sell_order_id", "execution_time").alias("trade_key"),
    )


# ---------- intake ----------

def _m2(spark, sf_dir):
    prepare(spark)
    orders = orders_from_lineitem(read_table(spark, sf_dir, "lineitem"))
    inst = instruments_from_parts(read_table(spark, sf_dir, "part"))
    return validate(orders, inst, M2_AS_OF)


def q_validate_csv(spark, sf_dir):
    """Validation fed through the CSV sources: bulk orders and instruments are landed as CSV files
    (under the shared checkpoint folder) and read back with the declared schemas."""
    base = scratch_path(prepare(spark), "csv")
    orders = orders_from_lineitem(read_table(spark, sf_dir, "lineitem"))
    orders.select(*[f.name for f in schemas.BULK_ORDER.fields]).write.option("header", True).csv(f"{base}/orders")
    instruments_from_parts(read_table(spark, sf_dir, "part")).write.option("header", True).csv(f"{base}/instruments")
    acc, _ = validate(read_bulk_orders(spark, f"{base}/orders"), read_instruments(spark, f"{base}/instruments"), M2_AS_OF)
    return ntz(acc, "expiry", "order_time", "initial_order_time")


def q_validate_accept(spark, sf_dir):
    acc, _ = _m2(spark, sf_dir)
    return ntz(acc, "expiry", "order_time", "initial_order_time")


def q_validate_reject(spark, sf_dir):
    _, rej = _m2(spark, sf_dir)
    return rej.select("order_id", "instrument", "buy_sell", "reject_reason")


def q_live_orders(spark, sf_dir):
    lv = live(m1_good_windowed(spark, sf_dir), "window_end")
    buys, sells = split_sides(lv)
    out = buys.unionByName(sells).select(
        "w_start", "w_end", "instrument", "order_id", "buy_sell", "price", "volume", "expiry"
    )
    return ntz(out, "w_start", "w_end", "expiry")


def q_order_book(spark, sf_dir):
    book = order_book(m1_good_windowed(spark, sf_dir))
    out = book.select(
        "w_start",
        "w_end",
        "instrument",
        "page",
        "n_orders",
        F.array_join(F.transform("book", lambda e: e["order_id"]), ",").alias("order_ids"),
        F.aggregate("book", F.lit(0).cast("bigint"), lambda acc, e: acc + e["volume"]).alias("book_volume"),
    )
    return ntz(out, "w_start", "w_end")


def q_price_ladder(spark, sf_dir):
    return ntz(price_ladder(m1_good_windowed(spark, sf_dir)), "w_start", "w_end")


# ---------- matching ----------

def q_match_trades(spark, sf_dir):
    return ntz(m1_match(spark, sf_dir).trades, "w_start", "w_end", "execution_time")


def q_match_ladder(spark, sf_dir):
    """The tier of books beyond one task, forced: price levels ranked across tasks and joined back."""
    m = match_orders(m1_good_windowed(spark, sf_dir), book_rows=0, ladder_rows=0)
    return ntz(m.trades, "w_start", "w_end", "execution_time")


def q_match_salted(spark, sf_dir):
    """The tier of hot keys, forced: salted joins and sums across tasks for large buys."""
    m = match_orders(m1_good_windowed(spark, sf_dir), book_rows=0, ladder_rows=0, hot_rows=16)
    return ntz(m.trades, "w_start", "w_end", "execution_time")


def q_match_whale(spark, sf_dir):
    """M1 and, per instrument, one buy that wants far more than its book holds."""
    orders = m1_orders(spark, sf_dir)
    last = orders.groupBy("instrument").agg(F.max("order_time").alias("order_time"))
    whales = last.select(
        F.concat(F.lit("whale-"), "instrument").alias("order_id"), "instrument", F.lit("Buy").alias("buy_sell"),
        F.lit(1_000_000.0).alias("price"), F.lit(50_000_000).alias("volume"),
        (F.col("order_time") + F.expr("INTERVAL 30 HOURS")).alias("expiry"), "order_time",
        F.col("order_time").alias("initial_order_time"),
    )
    good, _ = quarantine(orders.unionByName(whales))
    m = match_orders(assign_windows(good, "order_time", M1_WINDOW, M1_SLIDE))
    return ntz(m.trades, "w_start", "w_end", "execution_time")


def q_match_depleting(spark, sf_dir):
    """Sold volume is gone: buys in arrival order share the sells."""
    return ntz(match_orders(m1_good_windowed(spark, sf_dir), policy="depleting").trades, "w_start", "w_end", "execution_time")


def q_remaining_depleting(spark, sf_dir):
    rem = match_orders(m1_good_windowed(spark, sf_dir), policy="depleting").remaining
    return ntz(rem, "w_start", "w_end", "order_time", "initial_order_time", "expiry")


def q_remaining_repriced(spark, sf_dir):
    """Leftovers whose total price shrinks with their volume."""
    rem = match_orders(m1_good_windowed(spark, sf_dir), reprice=True).remaining
    return ntz(rem, "w_start", "w_end", "order_time", "initial_order_time", "expiry")


def q_match_explode(spark, sf_dir):
    """Trades in the reference's flat shape."""
    return ntz(reference_view(m1_match(spark, sf_dir)).trades, "execution_time")


def q_reorder_wire(spark, sf_dir):
    """Leftovers as re-order messages, key and value text."""
    return encode_reorders(carry_forward(m1_match(spark, sf_dir).remaining))


def q_order_book_paged(spark, sf_dir):
    """Books beyond one page (here of 16 entries), with every entry's fields."""
    book = order_book(m1_good_windowed(spark, sf_dir), page_size=16)
    entry = F.transform(
        "book",
        lambda e: F.concat_ws(
            "/", e["order_id"], F.round(e["price"] * 100).cast("long").cast("string"), e["volume"].cast("string"),
            e["buy_sell"], F.unix_seconds(e["expiry"]).cast("string"),
        ),
    )
    out = book.select("w_start", "w_end", "instrument", "page", "n_orders", F.array_join(entry, ",").alias("entries"))
    return ntz(out, "w_start", "w_end")


def q_remaining(spark, sf_dir):
    rem = m1_match(spark, sf_dir).remaining
    return ntz(rem, "w_start", "w_end", "order_time", "initial_order_time", "expiry")


def q_trade_keys(spark, sf_dir):
    """Trades in the reference's flat shape (no window columns) with their message keys."""
    flat = reference_view(m1_match(spark, sf_dir)).trades
    return flat.select(
        "instrument",
        "buy_order_id",
        "sell_order_id",
        "trade_volume",
        message_key(*TRADE_KEY).alias("trade_key"),
    )


def q_carry_forward(spark, sf_dir):
    carried = carry_forward(m1_match(spark, sf_dir).remaining)
    return ntz(carried, "expiry", "order_time", "initial_order_time")


def q_union_orders(spark, sf_dir):
    good, _ = quarantine(m1_orders(spark, sf_dir))
    carried = carry_forward(m1_match(spark, sf_dir).remaining)
    out = union_orders(good, carried)
    return ntz(out, "expiry", "order_time", "initial_order_time")


# ---------- analytics ----------

def _sma_m1(spark, sf_dir):
    return sma(m1_match(spark, sf_dir).trades, M1_WINDOW, M1_SLIDE)


def _profit_m1(spark, sf_dir):
    return profit(m1_match(spark, sf_dir).trades, M1_WINDOW, M1_SLIDE)


def _shown(df):
    """Rounded for comparison, after any ranking."""
    measures = [c for c in ("sma_price", "profit", "closing_sma_price", "opening_sma_price") if c in df.columns]
    return dec6(ntz(df, "w_start_time", "w_end_time"), *measures)


def q_sma(spark, sf_dir):
    return _shown(_sma_m1(spark, sf_dir))


def q_sma_top(spark, sf_dir):
    return _shown(top_n(_sma_m1(spark, sf_dir), SMA_TOP_N, "sma_price"))


def q_profit(spark, sf_dir):
    return _shown(_profit_m1(spark, sf_dir))


def q_profit_top(spark, sf_dir):
    return _shown(top_n(_profit_m1(spark, sf_dir), PROFIT_TOP_N, "profit"))


def q_sma_lineitem(spark, sf_dir):
    s = sma(m3_trades(spark, sf_dir), M3_WINDOW, M3_SLIDE)
    return dec6(ntz(s, "w_start_time", "w_end_time"), "sma_price")


def q_profit_lineitem_top(spark, sf_dir):
    return _shown(top_n(profit(m3_trades(spark, sf_dir), M3_WINDOW, M3_SLIDE), 10, "profit"))


def q_sma_nulls_last(spark, sf_dir):
    """A ranking in which most averages are null: within a window they come last."""
    t = m3_trades(spark, sf_dir)
    priced = F.when(F.expr("cast(substring(instrument, 5) as int) % 5 = 1"), F.col("per_volume_buy_price"))
    s = sma(t.withColumn("per_volume_buy_price", priced), M3_WINDOW, M3_SLIDE)
    return _shown(top_n(s, 12, "sma_price"))


BATCH_QUERIES = {
    "q_decode_orders": q_decode_orders,
    "q_quarantine": q_quarantine,
    "q_envelope_roundtrip": q_envelope_roundtrip,
    "q_order_id": q_order_id,
    "q_message_key": q_message_key,
    "q_validate_accept": q_validate_accept,
    "q_validate_reject": q_validate_reject,
    "q_validate_csv": q_validate_csv,
    "q_live_orders": q_live_orders,
    "q_order_book": q_order_book,
    "q_price_ladder": q_price_ladder,
    "q_match_trades": q_match_trades,
    "q_match_ladder": q_match_ladder,
    "q_match_salted": q_match_salted,
    "q_match_whale": q_match_whale,
    "q_match_depleting": q_match_depleting,
    "q_remaining_depleting": q_remaining_depleting,
    "q_remaining_repriced": q_remaining_repriced,
    "q_match_explode": q_match_explode,
    "q_order_book_paged": q_order_book_paged,
    "q_reorder_wire": q_reorder_wire,
    "q_remaining": q_remaining,
    "q_trade_keys": q_trade_keys,
    "q_carry_forward": q_carry_forward,
    "q_union_orders": q_union_orders,
    "q_sma": q_sma,
    "q_sma_top": q_sma_top,
    "q_profit": q_profit,
    "q_profit_top": q_profit_top,
    "q_sma_lineitem": q_sma_lineitem,
    "q_profit_lineitem_top": q_profit_lineitem_top,
    "q_sma_nulls_last": q_sma_nulls_last,
}
