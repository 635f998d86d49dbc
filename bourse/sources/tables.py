"""Mappings from the driver's parquet tables to the exchange records.

M1  events            -> orders   (matching, book, analytics)
M2  lineitem + part   -> orders + instruments (validation)
M3  lineitem          -> trades   (analytics at larger volume)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse.functions.columns import BUY, SELL

# M1 parameters (fixed for the test mapping)
M1_INSTRUMENTS = 20
M1_WINDOW = "1 day"
M1_SLIDE = "12 hours"
# M3 parameters
M3_WINDOW = "30 days"
M3_SLIDE = "15 days"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_from_events(events: DataFrame) -> DataFrame:
    """M1: one order per event.

    Even event ids buy, odd ones sell; a buy is priced one unit above the
    event value so that books cross; volume is ``props.k`` (zero volumes are
    left in and fall to the quarantine).
    """
    is_buy = F.col("event_id") % 2 == 0
    ts = F.col("ts").cast("timestamp")
    return events.select(
        F.col("event_id").cast("string").alias("order_id"),
        F.concat(F.lit("INSTR"), (F.col("user_id") % M1_INSTRUMENTS).cast("string")).alias("instrument"),
        F.when(is_buy, F.lit(BUY)).otherwise(F.lit(SELL)).alias("buy_sell"),
        (F.col("value") + F.when(is_buy, 1.0).otherwise(0.0)).cast("decimal(18,2)").cast("double").alias("price"),
        F.get_json_object("props", "$.k").cast("int").alias("volume"),
        F.timestamp_add("HOUR", 6 + (F.col("event_id") % 5) * 6, ts).alias("expiry"),
        ts.alias("order_time"),
        ts.alias("initial_order_time"),
    )


def orders_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """M2 orders: one order per line item on instrument ``l_partkey``.

    Total price = extended price, volume = quantity, expiry = ship date; odd
    line numbers buy, even ones sell.  Seventh lines name a share class that is
    not listed (``<l_partkey>-X``), so unknown instruments exist.
    """
    ship = F.col("l_shipdate").cast("timestamp")
    return lineitem.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("order_id"),
        F.concat(F.col("l_partkey").cast("string"), F.when(F.col("l_linenumber") == 7, "-X").otherwise("")).alias("instrument"),
        F.when(F.col("l_linenumber") % 2 == 1, F.lit(BUY)).otherwise(F.lit(SELL)).alias("buy_sell"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").cast("int").alias("volume"),
        ship.alias("expiry"),
    )


def instruments_from_parts(part: DataFrame) -> DataFrame:
    """M2 instruments: every part is listed with its retail price for one unit."""
    return part.select(
        F.col("p_partkey").cast("string").alias("instrument"),
        F.col("p_retailprice").alias("price"),
        F.lit(1).cast("int").alias("volume"),
        F.lit(None).cast("timestamp").alias("expiry"),
    )


def trades_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """M3: one trade per line item on instrument ``SUPP<l_suppkey>``.

    Buy unit price = extended price / quantity; sell unit price = the same
    after discount; executed at the ship date.
    """
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    oid = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return lineitem.select(
        F.concat(F.lit("SUPP"), F.col("l_suppkey").cast("string")).alias("instrument"),
        F.concat(F.lit("B"), oid).alias("buy_order_id"),
        unit.alias("per_volume_buy_price"),
        F.concat(F.lit("S"), oid).alias("sell_order_id"),
        (unit * (1 - F.col("l_discount"))).alias("per_volume_sell_price"),
        F.col("l_quantity").cast("int").alias("trade_volume"),
        F.col("l_shipdate").cast("timestamp").alias("execution_time"),
    )
