"""Wire codec: Kafka-style key/value envelopes, JSON decode, and the quarantine of bad orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bourse import schemas
from bourse.functions.columns import BUY, REORDER_KEY, SELL, WIRE_TIME_FORMAT, message_key


def decode(df: DataFrame, schema: StructType, value_col: str = "value") -> DataFrame:
    """``CAST(value AS STRING)`` -> ``from_json`` (PERMISSIVE) -> top-level columns."""
    parsed = F.from_json(F.col(value_col).cast("string"), schema)
    return df.select(parsed.alias("_data")).select("_data.*")


def decode_wire_orders(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Decode order messages into the ORDER record.

    Times are read as timestamps, which accepts both encodings in use: integer
    epoch seconds and 'yyyy-MM-dd HH:mm:ss' text from the order producer, ISO
    text from re-emitted leftovers (text in the session time zone).  A missing
    initial_order_time falls back to order_time.
    """
    w = decode(df, schemas.ORDER, value_col)
    return w.select(
        *[c for c in schemas.ORDER_COLS if c != "initial_order_time"],
        F.coalesce("initial_order_time", "order_time").alias("initial_order_time"),
    )


# ISO-8601 with the whole fraction; Spark's own default stops at milliseconds.
ISO_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def encode(df: DataFrame, key_cols: list[str] | None) -> DataFrame:
    """``key`` = parts joined by '_' (null if a part is null); ``value`` = ``to_json(struct(*))``, times in full precision."""
    key = message_key(*key_cols) if key_cols else F.lit(None).cast("string")
    return df.select(key.alias("key"), F.to_json(F.struct(*[F.col(c) for c in df.columns]), ISO_TIME).alias("value"))


def encode_reorders(orders: DataFrame) -> DataFrame:
    """Leftovers -> re-order envelope: key ``<order_id>_<order_time>``, JSON value with ISO times in full precision.

    A leftover keeps its arrival rank and its expiry to the microsecond when it comes back.
    """
    return encode(orders.select(*schemas.ORDER_COLS), REORDER_KEY)


def encode_wire_orders(orders: DataFrame) -> DataFrame:
    """Orders -> wire envelope: key ``<order_id>_<order_time epoch s>``, JSON value."""
    wire = orders.select(
        "order_id",
        "instrument",
        "price",
        "volume",
        F.date_format("expiry", WIRE_TIME_FORMAT).alias("expiry"),
        "buy_sell",
        F.unix_timestamp("order_time").alias("order_time"),
        F.unix_timestamp("initial_order_time").alias("initial_order_time"),
    )
    return encode(wire, REORDER_KEY)


REQUIRED_ORDER_FIELDS = ["order_id", "instrument", "buy_sell", "price", "volume", "expiry", "order_time"]


def reject_reason() -> Column:
    """First failing rule, or null for a good order."""
    expr = None
    for name in REQUIRED_ORDER_FIELDS:
        cond = F.col(name).isNull()
        expr = F.when(cond, F.lit(f"missing_{name}")) if expr is None else expr.when(cond, F.lit(f"missing_{name}"))
    # NaN sorts above every number in Spark, so a NaN price would look eligible
    expr = expr.when(F.isnan("price"), F.lit("invalid_price"))
    expr = expr.when(F.col("volume") <= 0, F.lit("non_positive_volume"))
    expr = expr.when(~F.col("buy_sell").isin(BUY, SELL), F.lit("unknown_side"))
    return expr


def quarantine(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split decoded orders into (good, rejected).

    Rows that would crash or silently misbehave in matching (null keys, prices
    or times, zero/negative volume, a side other than exactly 'Buy'/'Sell') go
    to the rejected frame with a ``reject_reason``.  One projection, no shuffle.
    """
    tagged = orders.withColumn("reject_reason", reject_reason())
    good = tagged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    good = good.withColumn("initial_order_time", F.coalesce("initial_order_time", "order_time"))
    bad = tagged.where(F.col("reject_reason").isNotNull())
    return good, bad
