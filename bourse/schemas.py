"""Record types of the exchange (all fields nullable, as declared by the reference)."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


# An order as the matcher reads it.  ``price`` is the TOTAL price of the order;
# the unit price is always price / volume.
ORDER = _s(
    ("order_id", StringType()),
    ("instrument", StringType()),
    ("buy_sell", StringType()),
    ("price", DoubleType()),
    ("volume", IntegerType()),
    ("expiry", TimestampType()),
    ("order_time", TimestampType()),
    ("initial_order_time", TimestampType()),
)

TRADE = _s(
    ("instrument", StringType()),
    ("buy_order_id", StringType()),
    ("per_volume_buy_price", DoubleType()),
    ("sell_order_id", StringType()),
    ("per_volume_sell_price", DoubleType()),
    ("trade_volume", IntegerType()),
    ("execution_time", TimestampType()),
)

REMAINING = _s(
    ("instrument", StringType()),
    ("order_id", StringType()),
    ("volume", IntegerType()),
    ("price", DoubleType()),
    ("buy_sell", StringType()),
    ("order_time", TimestampType()),
    ("initial_order_time", TimestampType()),
    ("expiry", TimestampType()),
)

INSTRUMENT = _s(
    ("instrument", StringType()),
    ("price", DoubleType()),
    ("volume", IntegerType()),
    ("expiry", TimestampType()),
)

BULK_ORDER = _s(
    ("order_id", StringType()),
    ("instrument", StringType()),
    ("price", DoubleType()),
    ("volume", IntegerType()),
    ("expiry", TimestampType()),
    ("buy_sell", StringType()),
)

SMA = _s(
    ("instrument", StringType()),
    ("sma_price", DoubleType()),
    ("w_start_time", TimestampType()),
    ("w_end_time", TimestampType()),
)

PROFIT = _s(
    ("instrument", StringType()),
    ("profit", DoubleType()),
    ("closing_sma_price", DoubleType()),
    ("opening_sma_price", DoubleType()),
    ("w_start_time", TimestampType()),
    ("w_end_time", TimestampType()),
)

ORDER_COLS = [f.name for f in ORDER.fields]
TRADE_COLS = [f.name for f in TRADE.fields]
REMAINING_COLS = [f.name for f in REMAINING.fields]
