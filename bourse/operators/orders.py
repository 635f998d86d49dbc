"""Order intake: validation against the instrument table, live filter, sides, carry-forward."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse import schemas
from bourse.functions.columns import BUY, SELL, WIRE_TIME_FORMAT, round_price, time_literal_or_col
from bourse.plans.sizing import DEFAULT_BROADCAST_MAX_ROWS, lookup_join

ORDER_FIELDS = ["order_id", "instrument", "price", "volume", "expiry", "buy_sell"]


def _market(instruments: DataFrame) -> DataFrame:
    """One market row per instrument (the cheapest listing if an instrument is listed twice)."""
    best = F.min_by(F.struct("price", "volume"), "price")
    return (
        instruments.groupBy("instrument")
        .agg(best.alias("_m"))
        .select("instrument", F.col("_m.price").alias("_mkt_price"), F.col("_m.volume").alias("_mkt_volume"))
    )


def validate(
    orders: DataFrame,
    instruments: DataFrame,
    as_of,
    broadcast_max_rows: int = DEFAULT_BROADCAST_MAX_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Check incoming orders against the instrument table; the first failing rule wins.

    Rules, in order: ``invalid_instrument`` (no listing), ``malformed`` (null
    or NaN price, null volume/expiry, volume <= 0), ``expired`` (as_of after expiry; equal
    passes), ``below_market`` (unit price rounded to cents below the market unit
    price; applies to buys and sells alike).

    Returns ``(accepted, rejected)``.  Accepted orders are stamped with
    ``order_time = initial_order_time = as_of`` (whole seconds) and carry the
    expiry both as a timestamp and as wire text ``expiry_text``.
    """
    as_of_col = time_literal_or_col(as_of)
    # equal orders must spread too; a stream has no row ids
    row = [] if orders.isStreaming else [F.monotonically_increasing_id()]
    spread = F.xxhash64("order_id", "price", "volume", "expiry", "buy_sell", *row)
    j = lookup_join(orders, _market(instruments), ["instrument"], spread, "left", broadcast_max_rows)
    unit = round_price(F.try_divide(F.col("price"), F.col("volume")))
    market_unit = round_price(F.try_divide(F.col("_mkt_price"), F.col("_mkt_volume")))
    malformed = (
        F.col("price").isNull()
        | F.isnan("price")
        | F.col("volume").isNull()
        | F.col("expiry").isNull()
        | (F.col("volume") <= 0)
    )
    reason = (
        F.when(F.col("_mkt_price").isNull(), F.lit("invalid_instrument"))
        .when(malformed, F.lit("malformed"))
        .when(as_of_col > F.col("expiry"), F.lit("expired"))
        .when(unit < market_unit, F.lit("below_market"))
    )
    tagged = j.withColumn("reject_reason", reason)
    stamp = F.timestamp_seconds(F.unix_timestamp(as_of_col))
    accepted = tagged.where(F.col("reject_reason").isNull()).select(
        *ORDER_FIELDS,
        F.date_format("expiry", WIRE_TIME_FORMAT).alias("expiry_text"),
        stamp.alias("order_time"),
        stamp.alias("initial_order_time"),
    )
    rejected = tagged.where(F.col("reject_reason").isNotNull()).select(*ORDER_FIELDS, "reject_reason")
    return accepted, rejected


def live(orders: DataFrame, as_of="window_end") -> DataFrame:
    """Orders still live at ``as_of`` (strictly before expiry).

    ``as_of`` is a column name (``window_end`` = the end of each order's
    window), a Column, a datetime, or ``"now"``.
    """
    if isinstance(as_of, str) and as_of == "window_end":
        col = F.col("w_end") if "w_end" in orders.columns else F.col("window.end")
    else:
        col = time_literal_or_col(as_of)
    return orders.where(F.col("expiry") > col)


def split_sides(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(buys, sells): exact, case-sensitive side labels; anything else is in neither."""
    return orders.where(F.col("buy_sell") == BUY), orders.where(F.col("buy_sell") == SELL)


def carry_forward(remaining: DataFrame, order_time=None) -> DataFrame:
    """Leftovers back into ORDER rows for the next matching round.

    ``order_time`` defaults to the time the matcher stamped (the round's
    ``as_of``); ``initial_order_time`` keeps the first arrival.  The total price
    is carried unchanged while the volume shrank, as the reference does.
    """
    ot = F.col("order_time") if order_time is None else time_literal_or_col(order_time)
    return remaining.select(
        "order_id",
        "instrument",
        "buy_sell",
        "price",
        "volume",
        "expiry",
        ot.cast("timestamp").alias("order_time"),
        "initial_order_time",
    )


def union_orders(*frames: DataFrame) -> DataFrame:
    """New orders UNION ALL re-entered orders, by column name."""
    cols = schemas.ORDER_COLS
    out = frames[0].select(*cols)
    for f in frames[1:]:
        out = out.unionByName(f.select(*cols))
    return out
