"""One way to start a streaming sink, whatever the format."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from bourse.streaming.snapshots import SnapshotTable

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
HEAP_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
# State that grows with the rows of the open windows lies in RocksDB, which spills to local disk; all stores of an
# executor share this much memory.  Spark's own choice keeps every row on the heap.
BOUNDED_STATE = {
    STATE_STORE: "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "300",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def start(
    df: DataFrame,
    fmt: str,
    checkpoint: str | None,
    output_mode: str = "append",
    path: str | None = None,
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
    trigger: dict | None = None,
    query_name: str | None = None,
    state: dict[str, str] | None = None,
    **options,
) -> StreamingQuery:
    """Start ``df`` into a sink.

    ``fmt``: ``console`` | ``memory`` | ``kafka`` (``df`` must hold ``key``/``value``;
    pass ``topic`` and the ``kafka.*`` options) | ``parquet`` / ``json`` (append
    only) | ``snapshot`` (each micro-batch becomes the table at ``path``; for complete
    mode results; read it with ``snapshots.read_snapshot``, which always sees one whole
    version) | ``foreach_batch`` (call ``foreach_batch(df, batch_id)``).
    ``trigger``: e.g. ``{"availableNow": True}`` or ``{"processingTime": "5 seconds"}``.
    ``state``: settings of the state store for this query (see ``BOUNDED_STATE``), unless the session chooses a
    store itself; a query that goes on from a checkpoint keeps the store it began with.
    """
    w = df.writeStream.outputMode(output_mode)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if trigger:
        w = w.trigger(**trigger)
    if fmt == "foreach_batch":
        w = w.foreachBatch(foreach_batch)
    elif fmt == "snapshot":
        table = SnapshotTable(df.sparkSession, path, df.schema)
        if checkpoint:
            table.must_belong_to(checkpoint)
        w = w.foreachBatch(table.replace)
    else:
        w = w.format(fmt)
        if fmt == "console":
            w = w.option("truncate", False)
        if path:
            w = w.option("path", path)
    for k, v in options.items():
        w = w.option(k, v)
    with _set_for_now(df.sparkSession, state or {}):  # a query keeps the settings that it was started with
        return w.start()


@contextmanager
def _set_for_now(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings that are there inside and gone afterwards; none of them if the session has a state store of its own."""
    new = {} if spark.conf.get(STATE_STORE, None) not in (None, HEAP_STORE) else settings
    before = {k: spark.conf.get(k, None) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_kafka(envelope: DataFrame, topic: str, options: dict[str, str]) -> None:
    """Batch write of a ``key``/``value`` frame to a Kafka topic (e.g. inside ``foreachBatch``)."""
    envelope.write.format("kafka").options(**options).option("topic", topic).save()


def publish_orders(
    accepted: DataFrame, path: str | None = None, kafka: dict | None = None, messages: str | None = None
) -> None:
    """Order ingest: validated orders as key/value order messages.

    ``path``: JSON-lines files (one message per line, no keys) for a file-stream
    landing folder; ``messages``: parquet files of ``key`` and ``value`` (see
    ``sources.message_dir_stream``); ``kafka={"options": {...}, "topic": ...}``: a Kafka topic.
    """
    from bourse.functions.codec import encode_wire_orders

    env = encode_wire_orders(accepted)
    if path:
        env.select("value").write.mode("append").text(path)
    if messages:
        env.write.mode("append").parquet(messages)
    if kafka:
        write_kafka(env, kafka["topic"], kafka["options"])
