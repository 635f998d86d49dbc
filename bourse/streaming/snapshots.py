"""Tables in the shared folder that a stream writes and others read at the same time.

A table is a folder of version folders (plain parquet) and of small commit files::

    <path>/version=<n>/...        rows written at once
    <path>/_commits/<n>           the versions that make up the table after commit n

A commit file appears whole or not at all and is written last, so a reader, which
follows the newest one, always gets one whole state of the table.  A micro-batch that is run again
finds its commit and writes nothing; one that failed before its commit writes its version folder anew.
Version folders that none of the last ``keep`` commits name are removed, so a reader
that planned its read has ``keep - 1`` further commits of time to finish it.

A table belongs to one stream and its checkpoint: versions count that stream's batches.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bourse.session import delete_folder, folder_names, path_exists, read_small_file, write_small_file

KEEP = 3


class SnapshotTable:
    """See the module docstring.  ``schema`` has the partition columns too (but not ``version``)."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, partition_by: list[str] | None = None, keep: int = KEEP):
        if keep < 1:
            raise ValueError("the newest commit must be kept")
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.partition_by, self.keep = partition_by or [], keep

    def _commits(self) -> list[int]:
        return sorted(int(n) for n in folder_names(self.spark, f"{self.path}/_commits") if n.isdigit())

    def last_commit(self) -> int | None:
        done = self._commits()
        return done[-1] if done else None

    def committed(self, version: int) -> bool:
        last = self.last_commit()
        return last is not None and version <= last

    def state(self) -> dict:
        """``versions`` of the newest commit, and the note left with it."""
        last = self.last_commit()
        return {"versions": [], "note": {}} if last is None else self._state(last)

    def _state(self, commit: int) -> dict:
        return json.loads(read_small_file(self.spark, f"{self.path}/_commits/{commit:012d}"))

    def read(self) -> DataFrame:
        """The rows of the newest commit, with the ``version`` that wrote them."""
        return self.read_versions(self.state()["versions"])

    def read_versions(self, versions: list[int]) -> DataFrame:
        schema = StructType([*self.schema.fields]).add("version", "long")
        if not versions:
            return self.spark.createDataFrame([], schema)
        folders = [f"{self.path}/version={v}" for v in versions]
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*folders)

    def append(self, rows: DataFrame, version: int, note: Callable[[DataFrame, dict], dict] | None = None) -> None:
        """Add ``rows`` as a version; nothing is written if that version is committed already.

        ``note(written rows, last note)`` makes the note that the commit carries.
        """
        if self.committed(version):
            self._run_through(rows)
            return
        state = self.state()
        self._write(rows, version)
        left = note(self.read_versions([version]), state["note"]) if note else state["note"]
        self._commit(version, [*state["versions"], version], left)

    def replace(self, rows: DataFrame, version: int) -> None:
        """Make ``rows`` the whole table (they may be read from it); nothing is written if that version is committed already."""
        if self.committed(version):
            self._run_through(rows)
            return
        self._write(rows, version)
        self._commit(version, [version], self.state()["note"])

    @staticmethod
    def _run_through(rows: DataFrame) -> None:
        """Compute rows that need not be written: a batch that is run again must still bring its state up to date."""
        rows.write.format("noop").mode("overwrite").save()

    def _write(self, rows: DataFrame, version: int) -> None:
        columns = [f.name for f in self.schema.fields]
        writer = rows.select(*columns).write.mode("overwrite")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.path}/version={version}")

    def _commit(self, version: int, versions: list[int], note: dict) -> None:
        write_small_file(self.spark, f"{self.path}/_commits/{version:012d}", json.dumps({"versions": versions, "note": note}))
        done = self._commits()
        for old in done[: -self.keep]:
            delete_folder(self.spark, f"{self.path}/_commits/{old:012d}")
        used = {v for c in done[-self.keep :] for v in self._state(c)["versions"]}
        for name in folder_names(self.spark, self.path):
            if name.startswith("version=") and int(name[8:]) not in used:
                delete_folder(self.spark, f"{self.path}/{name}")

    def must_belong_to(self, checkpoint: str) -> None:
        """Refuse a table that another checkpoint's stream has written: its batch numbers would be taken for this one's."""
        if self.last_commit() is not None and not path_exists(self.spark, f"{checkpoint}/metadata"):
            raise ValueError(f"{self.path} holds commits, but {checkpoint} is a new checkpoint; use a new folder")


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version that a ``snapshot`` sink has committed at ``path``."""
    path = path.rstrip("/")
    done = sorted(n for n in folder_names(spark, f"{path}/_commits") if n.isdigit())
    if not done:
        raise ValueError(f"nothing committed at {path} yet")
    (version,) = json.loads(read_small_file(spark, f"{path}/_commits/{done[-1]}"))["versions"]
    return spark.read.parquet(f"{path}/version={version}")


def last_wins(rows: DataFrame, key: list[str]) -> DataFrame:
    """One row per key, that of the latest version."""
    rest = [c for c in rows.columns if c not in (*key, "version")]
    best = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "version").alias("_row"), F.max("version").alias("version"))
    return best.select(*key, *[F.col("_row")[c].alias(c) for c in rest], "version")


class KeyedTable(SnapshotTable):
    """A table with one row per key: batches are upserts, the last batch wins.

    Batch ``n`` is version ``2 n``.  After every ``compact_every`` batches the versions are merged
    into one, version ``2 n + 1``, so neither their number nor the rows behind a key grow with the stream.
    """

    def __init__(self, spark, path, schema, key: list[str], compact_every: int = 10, **how):
        super().__init__(spark, path, schema, **how)
        self.key, self.compact_every = key, compact_every

    def upsert(self, rows: DataFrame, batch_id: int, note: Callable[[DataFrame, dict], dict] | None = None) -> None:
        self.append(rows, 2 * batch_id, note)

    def compact(self, batch_id: int, merged: Callable[[DataFrame], DataFrame] | None = None, force: bool = False) -> bool:
        """Merge all versions into one, if it is time; ``merged`` makes the rows to keep (default: the last per key)."""
        if not force and len(self.state()["versions"]) <= self.compact_every:
            return False
        rows = self.read()
        self.replace(merged(rows) if merged else last_wins(rows, self.key), 2 * batch_id + 1)
        return True

    def current(self) -> DataFrame:
        return last_wins(self.read(), self.key).drop("version")
