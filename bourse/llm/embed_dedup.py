"""Near-duplicate vectors by sorted projection passes.

Each pass orders all vectors lexicographically by (label, dimension, concatenated random hashes) and
compares every vector with its neighbours in a window of that order; pairs at or above the
cosine threshold are links, and the links of all passes are united into components.

One hash of a vector is the random direction, of ``DIRECTIONS``, with the largest absolute
projection, and its sign.  Vectors at a cosine of 0.93 share one hash about six times in
ten, so ``hashes`` of them in a row bring near copies together in some pass.

The order of a pass is a range partitioning with exact ranks, cut into blocks of
``block`` ranks; a block also gets the first ``window`` vectors of the next one, so each window
is complete in one task whatever the partitioning.  Equal vectors are one class from the
start and never meet in a window.  A block returns at most one link a vector (its
group in the block and the group's first vector), so a group of very many near copies sends
rows in proportion to its size.

A window is a bound, so a group of near copies larger than it would lose links.  The
exact way for the rest: every pair inside a component is verified, small components
whole and large ones in pairs of member blocks, and only counts per vector come out.  What
remains approximate is whether two components with a link between them meet in any
pass; each further pass lowers that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.llm.components import components
from bourse.plans.skew import ranked_within_groups, salted_join

MIN_COSINE = 0.93
PASSES = 8
HASHES = 6
DIRECTIONS = 64
WINDOW = 32
BLOCK = 4096
# Components with more classes than this are verified in pairs of blocks of this many members.
MEMBERS = 512
# Rows of one class joined in one task when the results go back to the rows.
HOT_ROWS = 1 << 17


def usable(vec: Column, label: Column) -> Column:
    """Vectors that may link: with a label, at least one component, all finite, not all zero."""

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))

    sound = F.forall(vec, finite) & F.exists(vec, lambda x: x != F.lit(0.0))
    return F.coalesce(label.isNotNull() & sound, F.lit(False))


def unit_rows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of one dimension as a matrix of unit rows in double precision."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def hash_keys(x: np.ndarray, one_pass: int, hashes: int, seed: int) -> np.ndarray:
    """One row of ``hashes`` bytes per vector: the direction with the largest projection, and its sign."""
    out = np.empty((len(x), hashes), np.uint8)
    for k in range(hashes):
        directions = np.random.default_rng([seed, one_pass, k]).standard_normal((x.shape[1], DIRECTIONS))
        y = x @ directions
        best = np.abs(y).argmax(axis=1)
        out[:, k] = 2 * best + (y[np.arange(len(x)), best] > 0)
    return out


def _key_batches(batches: Iterator[pa.RecordBatch], passes: int, hashes: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims = batch.column("dim").to_numpy(zero_copy_only=False)
        for dim in np.unique(dims):
            rows = pa.array(np.flatnonzero(dims == dim))
            part = batch.take(rows)
            x = unit_rows(part.column("vec"))
            for p in range(passes):
                keys = hash_keys(x, p, hashes, seed).tobytes()
                cut = pa.Array.from_buffers(pa.binary(hashes), len(x), [None, pa.py_buffer(keys)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("cls"), part.column("label"), part.column("dim"), pa.array(np.full(len(x), p, np.int32)), cut],
                    names=["cls", "label", "dim", "p", "hashes"],
                )


def groups_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` items reaches over the links ``a[i] - b[i]``."""
    root = np.arange(n)
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        np.minimum.at(root, high, low)  # trees hang under lower trees
        while (root[root] != root).any():
            root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return root


def _window_links(table: pa.Table, window: int, min_cosine: float) -> pa.Table:
    """Links found in one block: each linked vector with the first vector of its group."""
    table = table.sort_by("rank")
    x = unit_rows(table.column("vec"))
    label = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    n, a, b = len(x), [], []
    for step in range(1, min(window, n - 1) + 1):
        near = np.einsum("ij,ij->i", x[:-step], x[step:]) >= min_cosine
        at = np.flatnonzero(near & (label[:-step] == label[step:]))
        a.append(at)
        b.append(at + step)
    root = groups_of(n, np.concatenate(a), np.concatenate(b)) if a else np.arange(n)
    cls = table.column("cls").to_numpy()
    linked = np.flatnonzero(root != np.arange(n))
    return pa.table({"a": cls[root[linked]], "b": cls[linked]})


def _count(x: np.ndarray, y: np.ndarray, weight: np.ndarray, min_cosine: float) -> np.ndarray:
    """Per row of ``x``: how many rows (``weight`` a class) of ``y`` link with it."""
    return ((x @ y.T) >= min_cosine).astype(np.int64) @ weight


def _small_counts(table: pa.Table, min_cosine: float) -> pa.Table:
    """Exact link counts of whole components."""
    table = table.sort_by([("comp", "ascending"), ("dim", "ascending")])
    cls, n, comp = (table.column(c).to_numpy() for c in ("cls", "n", "comp"))
    vec = table.column("vec").combine_chunks()
    cut = np.flatnonzero(np.diff(comp)) + 1
    found = np.empty(len(cls), np.int64)
    for lo, hi in zip([0, *cut], [*cut, len(cls)], strict=True):
        x = unit_rows(vec.slice(lo, hi - lo))
        found[lo:hi] = _count(x, x, n[lo:hi], min_cosine) - n[lo:hi]
    return pa.table({"cls": cls, "found": found})


def _block_counts(table: pa.Table, min_cosine: float) -> pa.Table:
    """Exact link counts between two blocks of one component (or inside one)."""
    cls, n, block = (table.column(c).to_numpy() for c in ("cls", "n", "block"))
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    x = unit_rows(table.column("vec"))
    left, right = block == i, block == j
    if i == j:
        found = _count(x, x, n, min_cosine) - n
    else:
        found = np.empty(len(cls), np.int64)
        found[left] = _count(x[left], x[right], n[right], min_cosine)
        found[right] = _count(x[right], x[left], n[left], min_cosine)
    return pa.table({"cls": cls, "found": found})


def _component_links(members: DataFrame, order: DataFrame, min_cosine: float, members_per_block: int, parts: int) -> DataFrame:
    """``cls, found``: links with other classes, of every class that is in a component.

    ``members`` has cls, comp, dim, n, vec; ``order`` the rank of a class in one pass.
    """
    sizes = members.groupBy("comp").agg(F.count(F.lit(1)).alias("size")).checkpoint()
    large = sizes.where(F.col("size") > members_per_block)
    total = sizes.agg(F.sum("size")).first()[0] or 0
    buckets = max(1, -(-total // (4 * members_per_block)))
    small = members.join(sizes.where(F.col("size") <= members_per_block), "comp").withColumn(
        "bucket", F.pmod(F.xxhash64("comp"), F.lit(buckets))
    )
    counts = small.groupBy("bucket").applyInArrow(
        lambda t: _small_counts(t, min_cosine), "cls long, found long"
    )
    if large.isEmpty():
        return counts
    # member blocks follow the order of a pass; ranks are taken across tasks
    ids = members.select("cls", "comp").join(large, "comp").join(order, "cls").withColumn("one", F.lit(1))
    ranked = ranked_within_groups(ids, ["comp"], [F.col("rank")], "one", parts)
    block = F.floor((F.col("run_sum") - 1) / members_per_block)
    last = F.floor((F.col("size") - 1) / members_per_block)
    blocks = ranked.select("cls", block.alias("block"), last.alias("last"))
    pairs = (
        members.select("cls", "comp", "n", "vec")
        .join(blocks, "cls")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .drop("other", "last")
    )
    in_blocks = pairs.groupBy("comp", "i", "j").applyInArrow(
        lambda t: _block_counts(t, min_cosine), "cls long, found long"
    )
    return counts.unionByName(in_blocks).groupBy("cls").agg(F.sum("found").alias("found"))


def near_duplicate_vectors(
    vecs: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    min_cosine: float = MIN_COSINE,
    passes: int = PASSES,
    hashes: int = HASHES,
    window: int = WINDOW,
    block: int = BLOCK,
    members_per_block: int = MEMBERS,
    seed: int = 13,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` per row of ``vecs``.

    Vectors of equal label (and equal dimension) link at a cosine of ``min_cosine`` or more,
    in double precision.  A vector that is null, empty or zero, holds null, NaN or an infinity,
    or has a null label, links with nothing and is kept.  Repeated rows are vectors of their own that link with each
    other.  A row with a null id links like any other but names no component: components get
    their smallest id that is not null, and of a component without any id all rows are kept.  Other columns
    are not read; an empty table gives no rows.

    Equal vectors are found by 128 bits of hash of (label, vector).  Sums to
    the driver are counts alone; all tables between the steps are checkpointed.
    """
    if window < 1 or block < window:
        raise ValueError("the window must hold at least one neighbour and fit a block")
    parts = int(vecs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = vecs.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"), F.col(label_col).alias("label"))
    ok = usable(F.col("vec"), F.col("label"))
    keyed = rows.select(
        "id",
        "vec",
        F.col("label").cast("string").alias("label"),
        F.when(ok, F.xxhash64(F.col("label"), F.col("vec"))).alias("c1"),
        F.when(ok, F.xxhash64(F.col("vec"), F.lit("second"), F.col("label"))).alias("c2"),
    )
    classes = (
        keyed.where("c1 IS NOT NULL")
        .groupBy("c1", "c2")
        .agg(F.min("id").alias("min_id"), F.count(F.lit(1)).alias("n"), F.first("vec").alias("vec"), F.first("label").alias("label"))
        .withColumn("dim", F.size("vec"))
        .withColumn("cls", F.monotonically_increasing_id())
        .checkpoint()
    )
    vectors = classes.select("cls", "label", "dim", "vec")
    keys = vectors.mapInArrow(
        lambda b: _key_batches(b, passes, hashes, seed), "cls long, label string, dim int, p int, hashes binary"
    )
    in_order = ranked_within_groups(
        keys.withColumn("one", F.lit(1)), ["p"], [F.col(c) for c in ("label", "dim", "hashes", "cls")], "one", parts
    )
    order = in_order.select("cls", "p", (F.col("run_sum") - 1).alias("rank")).checkpoint()
    home = F.floor(F.col("rank") / block)
    visits = F.when((F.col("rank") % block < window) & (home > 0), F.array(home, home - 1)).otherwise(F.array(home))
    links = (
        order.withColumn("block", F.explode(visits))
        .join(vectors, "cls")
        .groupBy("p", "dim", "block")
        .applyInArrow(lambda t: _window_links(t, window, min_cosine), "a long, b long")
    )
    found = components(links, "a", "b").select(F.col("node").alias("cls"), F.col("label").alias("comp"))
    members = found.join(classes.select("cls", "dim", "n", "vec"), "cls")
    first_pass = order.where("p = 0").select("cls", "rank")
    counts = _component_links(members, first_pass, min_cosine, members_per_block, parts)
    names = found.join(classes.select("cls", "min_id"), "cls").groupBy("comp").agg(F.min("min_id").alias("component"))
    linked = found.join(names, "comp").join(counts, "cls")
    known = (
        classes.select("cls", "c1", "c2", "n", "min_id")
        .join(linked, "cls", "left")
        .where((F.col("n") > 1) | F.col("comp").isNotNull())
        .select(
            "c1",
            "c2",
            (F.col("n") - 1 + F.coalesce("found", F.lit(0))).alias("n_links"),
            F.when(F.col("comp").isNull(), F.col("min_id")).otherwise(F.col("component")).alias("component"),
            F.lit(True).alias("known"),
        )
        .checkpoint()
    )
    # rows that cannot link carry no second hash, so they match nothing; a first one spreads them over the tasks
    spread = keyed.select("id", F.coalesce("c1", F.xxhash64(F.monotonically_increasing_id())).alias("c1"), "c2")
    joined = salted_join(
        spread, known, ["c1", "c2"], F.monotonically_increasing_id(), "left", HOT_ROWS
    )
    component = F.when(F.col("known"), F.col("component")).otherwise(F.col("id"))
    return joined.select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, component.isNull()).alias("kept"),
    )
