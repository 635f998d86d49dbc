"""Kafka source and sink options (the connector jar must be on the cluster's classpath)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(
    bootstrap_servers: str,
    security_protocol: str | None = None,
    sasl_mechanism: str | None = None,
    username: str | None = None,
    password: str | None = None,
    **client_options,
) -> dict[str, str]:
    """Connection options; Kafka client settings get the ``kafka.`` prefix Spark forwards."""
    opts = {"kafka.bootstrap.servers": bootstrap_servers}
    if security_protocol:
        opts["kafka.security.protocol"] = security_protocol
    if sasl_mechanism:
        opts["kafka.sasl.mechanism"] = sasl_mechanism
    if username is not None:
        opts["kafka.sasl.jaas.config"] = (
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            f'username="{username}" password="{password}";'
        )
    for k, v in client_options.items():
        key = k if k.startswith("kafka.") else f"kafka.{k}"
        opts[key] = str(v)
    return opts


def kafka_stream(
    spark: SparkSession,
    topic: str,
    options: dict[str, str],
    starting_offsets: str = "latest",
    fail_on_data_loss: bool = False,
    group_id: str | None = None,
) -> DataFrame:
    """``readStream.format("kafka")`` on one topic; decode ``value`` with ``codec.decode*``."""
    reader = (
        spark.readStream.format("kafka")
        .options(**options)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
    )
    if group_id:
        reader = reader.option("kafka.group.id", group_id)
    return reader.load()
