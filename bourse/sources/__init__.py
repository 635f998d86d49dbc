from bourse.sources.files import (
    bulk_order_stream,
    json_dir_stream,
    message_dir_stream,
    read_bulk_orders,
    read_instruments,
    read_wire_orders,
)
from bourse.sources.kafka import kafka_options, kafka_stream
from bourse.sources.tables import (
    instruments_from_parts,
    orders_from_events,
    orders_from_lineitem,
    read_table,
    trades_from_lineitem,
)

__all__ = [
    "bulk_order_stream",
    "json_dir_stream",
    "message_dir_stream",
    "read_bulk_orders",
    "read_instruments",
    "read_wire_orders",
    "kafka_options",
    "kafka_stream",
    "instruments_from_parts",
    "orders_from_events",
    "orders_from_lineitem",
    "read_table",
    "trades_from_lineitem",
]
