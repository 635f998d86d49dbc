"""File sources: instrument and bulk-order CSVs, JSON order messages (batch and file stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bourse import schemas
from bourse.functions.codec import decode_wire_orders


def read_instruments(spark: SparkSession, path: str) -> DataFrame:
    """Instrument reference table (CSV with header, declared schema, no inference)."""
    return spark.read.schema(schemas.INSTRUMENT).option("header", True).csv(path)


def read_bulk_orders(spark: SparkSession, path: str) -> DataFrame:
    """Bulk order upload (CSV with header: order_id, instrument, price, volume, expiry, buy_sell)."""
    return spark.read.schema(schemas.BULK_ORDER).option("header", True).csv(path)


def read_wire_orders(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines order messages (one message per line) decoded into ORDER rows."""
    return decode_wire_orders(spark.read.text(path))


def json_dir_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A landing folder of JSON-lines order files as an unbounded order stream.

    Stands in for a Kafka topic where no broker is at hand: each new file is a
    batch of messages, each line one ``value``.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return decode_wire_orders(reader.load(path))


def bulk_order_stream(spark: SparkSession, path: str) -> DataFrame:
    """A landing folder of bulk-order CSV files as a stream; ``validate`` takes it like a batch."""
    return spark.readStream.schema(schemas.BULK_ORDER).option("header", True).csv(path)


def message_dir_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of keyed messages (parquet files of ``key`` and ``value``) as a stream, as a topic would give them."""
    reader = spark.readStream.schema("key string, value string")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path).select("key", "value")
