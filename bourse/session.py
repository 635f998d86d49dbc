"""Session helpers: the caller owns the SparkSession; these only read or fill in settings."""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session used with this library should carry.  UTC keeps the
# timestamp <-> text and epoch conversions of the wire format stable.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Runtime re-planning: coalesce small shuffle partitions, split skewed join
# partitions (a hot instrument or price level), convert joins to broadcast only
# after the actual size of a side is known.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Set when the session starts: Kryo serializes the matcher's checkpointed rows
# and other RDD-level data faster than Java serialization (~20% on the matcher).
STARTUP_CONF = {
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "bourse") -> SparkSession:
    """A local session for tests and the bench (a cluster session comes from the caller)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in {**REQUIRED_CONF, **RECOMMENDED_CONF, **STARTUP_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Make a caller's session fit the library: UTC session time, a checkpoint folder."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and only read here; without it a
    cluster session is refused, since a machine-local folder would lose files.
    A bare local session (tests) gets a private temporary folder.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="bourse-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (landing files, sink tables, stream checkpoints)."""
    return f"{shared_dir(spark)}/bourse/{name}-{uuid.uuid4().hex[:12]}"


def _place(spark: SparkSession, path: str):
    """(file system, path) of Hadoop, through which Spark itself reads and writes."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, asked through Spark's file systems."""
    fs, place = _place(spark, path)
    return fs.exists(place)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    fs, place = _place(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(place)) if fs.exists(place) else []


def read_small_file(spark: SparkSession, path: str) -> str:
    fs, place = _place(spark, path)
    stream = fs.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small_file(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole or not at all: written under a hidden name, then renamed."""
    folder, name = path.rsplit("/", 1)
    fs, hidden = _place(spark, f"{folder}/.{name}-{uuid.uuid4().hex[:8]}")
    stream = fs.create(hidden, True)
    stream.write(text.encode())
    stream.close()
    target = _place(spark, path)[1]
    if not fs.rename(hidden, target):  # some file systems do not rename onto a file
        fs.delete(target, False)
        if not fs.rename(hidden, target):
            raise OSError(f"cannot write {path}")


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, place = _place(spark, path)
    fs.delete(place, True)


def drop_unused_files(spark: SparkSession) -> None:
    """Have Spark delete the shuffle and checkpoint files that no plan refers to any more.

    Spark does so when the driver collects garbage, which it has no reason to do while executors fill their disks.
    Steps that move much and end in a checkpoint call this.
    """
    spark.sparkContext._jvm.System.gc()


def scale_conf(input_bytes: int, partition_bytes: int = 256 << 20, streaming: bool = False) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of order data.

    Shuffle partitions are sized so a partition is about ``partition_bytes``
    after the sliding-window expansion (each order sits in ``window/slide``
    books, 2 by default); AQE coalesces small ones and splits skewed join
    partitions at run time.  Streaming state goes to RocksDB, which spills to
    local disk instead of holding all state on the JVM heap; note that a
    stream's shuffle partition count is fixed by its checkpoint.
    """
    parts = max(200, math.ceil(2 * input_bytes / partition_bytes))
    conf = {
        **REQUIRED_CONF,
        **RECOMMENDED_CONF,
        **STARTUP_CONF,
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        # streams checkpoint every micro-batch of orders: drop what no plan refers to any more
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if streaming:
        conf["spark.sql.streaming.stateStore.providerClass"] = (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        )
    return conf
