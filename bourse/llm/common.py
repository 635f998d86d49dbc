"""Helpers shared by the training-data operators."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The ASCII white space that ends a word in these operators; bytes.split() splits at the same six bytes.
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` also changes letters outside ASCII)."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def row_key(row_id: str, text: str) -> Column:
    """A key of (id, text) that is never null, so rows without an id join like all others.

    Repeated rows share it; they have equal results.  Two texts under one id
    would have to collide in 64 bits to be confused.
    """
    return F.concat_ws(
        ":", F.coalesce(F.col(row_id).cast("string"), F.lit("-")), F.hex(F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    )


def text_bytes(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The UTF-8 bytes of a string column; null becomes empty."""
    return [t or b"" for t in batch.column(column).cast(pa.binary()).to_pylist()]


def write_blobs(df: DataFrame, column: str, path: str, last_byte: str, one_per_file: bool = False) -> None:
    """Write binary values as raw files through Spark's own committed text writer.

    The writer ends each value with ``last_byte``, so values are handed over
    without their last byte, which must be that one.  Going through Spark's
    writer gives the output commit: a lost or repeated task leaves no partial file.
    """
    cut = F.expr(f"substring(`{column}`, 1, octet_length(`{column}`) - 1)")
    writer = df.select(cut.cast("string").alias("value")).write.option("lineSep", last_byte).mode("error")
    (writer.option("maxRecordsPerFile", 1) if one_per_file else writer).text(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where the body uses it many times."""
    return F.transform(F.array(value), body)[0]


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """A checkpointed table, marked for broadcast only if it was counted to hold at most ``max_rows`` rows."""
    return F.broadcast(df) if df.count() <= max_rows else df


def fresh(columns: list[str], *names: str) -> list[str]:
    """``names``, each with as many underscores before it as make it new among ``columns`` (in any case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out
