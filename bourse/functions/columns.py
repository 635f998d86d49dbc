"""Scalar column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: these must equal the reference for equal results ----
BUY = "Buy"
SELL = "Sell"
KEY_SEPARATOR = "_"
ORDER_ID_SEPARATOR = "-"
WIRE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DEFAULT_WINDOW = "10 minutes"
DEFAULT_SLIDE = "5 minutes"
DEFAULT_WATERMARK = "10 minutes"
SMA_TOP_N = 4
PROFIT_TOP_N = 1
TRADE_KEY = ["buy_order_id", "sell_order_id", "execution_time"]
REORDER_KEY = ["order_id", "order_time"]
# ---- end of fixed values ----


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def unit_price(price="price", volume="volume") -> Column:
    """Unit price of an order: its total price over its volume."""
    return _c(price) / _c(volume)


def round_price(x) -> Column:
    """Round to cents, half up, over decimal(18,6) so ties do not depend on binary doubles."""
    return F.round(_c(x).try_cast("decimal(18,6)"), 2)


def message_key(*cols) -> Column:
    """Message key ``a_b_c`` of the parts cast to text; null if any part is null."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(KEY_SEPARATOR))
        parts.append(_c(c).cast("string"))
    return F.concat(*parts)


def order_id_expr(buy_sell="buy_sell", instrument="instrument", ts="order_time") -> Column:
    """Order id ``<side>-<instrument>-<epoch millis>`` (not unique: same-millisecond orders collide)."""
    return F.concat_ws(ORDER_ID_SEPARATOR, _c(buy_sell), _c(instrument), F.unix_millis(_c(ts)).cast("string"))


def time_literal_or_col(value, default_col: str | None = None) -> Column:
    """Resolve an ``as_of`` style argument: a column, a column name, a Python datetime or 'now'."""
    if value is None:
        return F.col(default_col)
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        if value == "now":
            return F.current_timestamp()
        return F.col(value)
    return F.lit(value).cast("timestamp")
