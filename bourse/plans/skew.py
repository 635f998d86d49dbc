"""Skew-safe building blocks: joins on hot keys, and ranks over groups too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bourse.plans.sizing import bounded_broadcast
from bourse.session import drop_unused_files

# A key with more rows than this on the big side of a join is split over
# ceil(rows / ROWS_PER_TASK) tasks.
ROWS_PER_TASK = 1 << 20


def salted_join(
    big: DataFrame,
    small: DataFrame,
    keys: list[str],
    spread: Column,
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    merge: bool = False,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Equi-join where ``small`` has few rows per key and ``big`` may have very many.

    Keys holding more than ``rows_per_task`` rows of ``big`` are hot: their big
    rows are spread over ``ceil(rows / rows_per_task)`` salts by ``spread`` (a
    per-row value such as a row id), and their small rows are copied once per
    salt.  Other keys join unchanged.  The hot-key table, at most
    ``rows(big) / rows_per_task`` rows, is broadcast only after its rows were counted.
    ``merge``: never broadcast the copies, which the planner judges by the rows they come from.
    ``counted``: a frame that holds each key as often as ``big`` does; give one that is cheaper, since
    counting computes it once more.
    """
    counts = (big if counted is None else counted).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > rows_per_task).select(
        *keys, F.ceil(F.col("_n") / F.lit(rows_per_task)).cast("int").alias("_salts")
    )
    hot = bounded_broadcast(hot.checkpoint())
    big_s = (
        big.join(hot, keys, "left")
        .withColumn(
            "_salt",
            F.when(F.col("_salts").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64(spread), F.col("_salts"))).cast("int"),
        )
        .drop("_salts")
    )
    small_s = (
        small.join(hot, keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)))
        .drop("_salts")
    )
    return big_s.join(small_s.hint("merge") if merge else small_s, keys + ["_salt"], how).drop("_salt")


def ranked_within_groups(
    df: DataFrame,
    group: list[str],
    order: list[Column],
    measure: str,
    parts: int,
    keep: list[str] | None = None,
) -> DataFrame:
    """Running and total sum of ``measure`` per group in ``order``, without one task per group.

    The rows are range-partitioned on (group, order) so a large group spans
    many partitions; each (group, partition) slice is summed locally, and the sums are
    frozen with a checkpoint, so whoever reads the result moves no row again.  A group in several
    partitions adds the sums of its earlier slices; two rows at most for each border between
    partitions, so these are broadcast.  Adds ``run_sum`` (inclusive) and ``group_sum`` columns.
    Order keys must be unique within a group.

    ``keep``: the columns wanted beside those of the group and ``run_sum``; ``group_sum`` is
    among them if it is wanted.  Default: all.
    """
    slice_of = [*group, "_pid"]
    in_slice = Window.partitionBy(*slice_of)
    so_far = in_slice.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keep = [*[c for c in df.columns if c not in group], "group_sum"] if keep is None else keep
    total = "group_sum" in keep
    kept = [c for c in keep if c != "group_sum"]
    rows = df.repartitionByRange(parts, *[F.col(c) for c in group], *order).withColumn("_pid", F.spark_partition_id())
    rows = rows.withColumn("_local", F.sum(measure).over(so_far))
    if total:
        rows = rows.withColumn("_all", F.sum(measure).over(in_slice))
    value = [] if measure in [*slice_of, *kept] else [measure]
    local = rows.select(*slice_of, *kept, *value, "_local", *["_all"] * total).checkpoint(eager=True)
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    borders = (
        local.groupBy(*slice_of)
        .agg(F.sum(measure).alias("_slice"))
        .select(
            *[F.col(c).alias("_r_" + c) for c in slice_of],
            F.coalesce(F.sum("_slice").over(before), F.lit(0)).alias("_offset"),
            F.sum("_slice").over(whole).alias("_total"),
            F.count(F.lit(1)).over(whole).alias("_slices"),
        )
        .where(F.col("_slices") > 1)
        .drop("_slices")
        .checkpoint(eager=True)
    )
    drop_unused_files(df.sparkSession)
    # null-safe: a null in a group column is a group like any other
    same = [F.col(c).eqNullSafe(F.col("_r_" + c)) for c in slice_of]
    sums = [(F.col("_local") + F.coalesce("_offset", F.lit(0))).alias("run_sum")]
    if total:
        sums.append(F.coalesce("_total", "_all").alias("group_sum"))
    return local.join(F.broadcast(borders), same, "left").select(*group, *kept, *sums)
