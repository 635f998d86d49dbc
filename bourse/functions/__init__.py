from bourse.functions.columns import (
    BUY,
    SELL,
    DEFAULT_SLIDE,
    DEFAULT_WATERMARK,
    DEFAULT_WINDOW,
    message_key,
    order_id_expr,
    round_price,
    unit_price,
)
from bourse.functions.codec import decode, decode_wire_orders, encode, encode_wire_orders, quarantine

__all__ = [
    "BUY",
    "SELL",
    "DEFAULT_WINDOW",
    "DEFAULT_SLIDE",
    "DEFAULT_WATERMARK",
    "message_key",
    "order_id_expr",
    "round_price",
    "unit_price",
    "decode",
    "decode_wire_orders",
    "encode",
    "encode_wire_orders",
    "quarantine",
]
