"""SimHash near-duplicates: fingerprints linked at a small bit distance, found through anchor points.

Fingerprints.  Bit b of a text's fingerprint is set if it is set in over half
of the 64-bit hashes of the text's word shingles.

Links.  The anchors are the words of a covering code.  The 64 bits are cut into
``blocks`` nearly equal blocks; two fingerprints that differ in at most
``max_bits`` bits differ in at most t = max_bits // blocks bits of some block.
In each block the code is a perfect Hamming code on the first 2^m - 1 bits and
every pattern on the rest: covering radius R = 1.  Every fingerprint goes to
its own nearest anchor (as *home*) and to every anchor within R + t of it (as
*visitor*).  If x and y differ in at most t bits of a block, then y is within
R + t of the home of x, so the two meet there; at each anchor the homes are
compared with the visitors over all 64 bits.  No pair within max_bits is lost.

One code over all 64 bits would need, by the sphere-covering bound, about 900
visits a fingerprint for 2^32 anchors; three blocks of 21 or 22 bits (15 bits
Hamming, 2^17 anchors or more each) need 43, two blocks of 32 bits (31 bits
Hamming, 2^27 anchors each) 346.  Two blocks pay off when comparisons
dominate, beyond about 10^8 different fingerprints.

Work per anchor is spread: equal fingerprints are one row, anchors with many
homes are cut into slices (each slice meets all visitors, which stream past
its homes), and an anchor returns a spanning forest of its links instead of
all pairs.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import fresh, row_key, text_bytes
from bourse.llm.components import components

SEED = 42
HOMES_PER_SLICE = 2048
ROWS_HELD = 1 << 17  # of one anchor's slice at a time
PAIRS_AT_ONCE = 1 << 21


def fingerprint(text: bytes, k: int) -> int:
    """The SimHash of a whole UTF-8 text; a text without words has 0."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= k:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[: -k] + 1]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends[k - 1 :].tolist(), strict=True)), np.uint64, len(starts)
    )
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``doc_id, key, fp``: one row per input row; fp is the fingerprint as a signed long."""

    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t, k) for t in text_bytes(b, "_text")), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), pa.array(fp.view(np.int64))], ["doc_id", "key", "fp"])

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), row_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("_text")
    )
    return rows.mapInArrow(run, "doc_id long, key string, fp long")


class BlockCode:
    """The covering code of one block of ``width`` bits: a Hamming code and free bits."""

    def __init__(self, shift: int, width: int, threshold: int):
        self.shift, self.width = shift, width
        self.hamming = (1 << ((width + 1).bit_length() - 1)) - 1  # its length, 2^m - 1
        m = (self.hamming + 1).bit_length() - 1
        # the errors of up to R + t bits, by the syndrome they leave: an anchor lies at
        # fingerprint ^ error exactly if the two have equal syndromes
        self.errors: list[list[int]] = [[] for _ in range(1 << m)]
        for weight in range(0, 1 + threshold + 1):
            for bits in itertools.combinations(range(width), weight):
                syndrome = 0
                for b in bits:
                    syndrome ^= b + 1 if b < self.hamming else 0
                self.errors[syndrome].append(sum(1 << b for b in bits))
        self.masks = [
            np.uint64(sum(1 << b for b in range(self.hamming) if (b + 1) >> j & 1)) for j in range(m)
        ]

    def cut(self, fp: np.ndarray) -> np.ndarray:
        return (fp >> np.uint64(self.shift)) & np.uint64((1 << self.width) - 1)

    def syndrome(self, v: np.ndarray) -> np.ndarray:
        s = np.zeros(len(v), dtype=np.int64)
        for j, mask in enumerate(self.masks):
            s |= (np.bitwise_count(v & mask).astype(np.int64) & 1) << j
        return s

    def visits(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the fingerprint, its anchor, and whether that anchor is its home."""
        v = self.cut(fp)
        s = self.syndrome(v)
        index, anchor, home = [], [], []
        for value in range(len(self.errors)):
            at = np.flatnonzero(s == value)
            if not len(at):
                continue
            e = np.array(self.errors[value], dtype=np.uint64)
            nearest = np.uint64(1 << (value - 1) if value else 0)
            index.append(np.repeat(at, len(e)))
            anchor.append((v[at][:, None] ^ e[None, :]).ravel())
            home.append(np.tile(e == nearest, len(at)))
        if not index:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, bool)
        return np.concatenate(index), np.concatenate(anchor), np.concatenate(home)


def block_codes(max_bits: int, blocks: int) -> list[BlockCode]:
    at = [round(64 * i / blocks) for i in range(blocks + 1)]
    return [BlockCode(a, b - a, max_bits // blocks) for a, b in itertools.pairwise(at)]


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A spanning forest of the links (a, b), as rows (node, smallest node of its group)."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        new = new[new]
        new = np.minimum(new, new[label])
        if (new == label).all():
            break
        label = new
    off = label != np.arange(len(nodes))
    return np.stack([nodes[off], nodes[label[off]]], axis=1)


def _compare(key: np.ndarray, fp: np.ndarray, home: np.ndarray, max_bits: int) -> np.ndarray:
    """Forest links among rows sorted by key: homes against all rows of the same key."""
    change = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[change, len(key)])
    group = np.repeat(np.arange(len(change)), size)
    h = np.flatnonzero(home & (size[group] > 1))
    todo = size[group[h]]
    links: list[np.ndarray] = []
    at = 0
    while at < len(h):
        # as many homes as make PAIRS_AT_ONCE pairs, one at least
        upto = at + max(1, int(np.searchsorted(np.cumsum(todo[at : at + PAIRS_AT_ONCE]), PAIRS_AT_ONCE)))
        n = todo[at:upto]
        left = np.repeat(h[at:upto], n)
        right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(change[group[h[at:upto]]], n)
        near = np.bitwise_count(fp[left] ^ fp[right]) <= max_bits
        near &= fp[left] != fp[right]
        if near.any():
            links.append(_forest(fp[left[near]], fp[right[near]]))
        at = upto
    if not links:
        return np.zeros((0, 2), dtype=np.uint64)
    all_ = np.concatenate(links)
    return _forest(all_[:, 0], all_[:, 1]) if len(links) > 1 else all_


def near_links(fps: DataFrame, max_bits: int = 4, blocks: int = 3) -> DataFrame:
    """Links ``a, b`` that connect exactly the fingerprints (column ``fp``, all different) within ``max_bits``."""

    def replicate(batches):
        codes = block_codes(max_bits, blocks)
        for batch in batches:
            whole = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for low in range(0, len(whole), 4096):
                fp = whole[low : low + 4096]
                for i, code in enumerate(codes):
                    index, anchor, home = code.visits(fp)
                    key = anchor.astype(np.int64) | np.int64(i << 40)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(fp[index].view(np.int64)), pa.array(home)], ["key", "fp", "home"]
                    )

    def compare(batches):
        names = ("key", "fp", "home", "slice")
        held = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                rows = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
                held = rows if held is None else [np.concatenate(x) for x in zip(held, rows, strict=True)]
            if held is None or not len(held[0]):
                continue
            cut = len(held[0])
            if batch is not None:  # the last key may go on in the next batch
                last = (held[0] == held[0][-1]) & (held[3] == held[3][-1])
                cut = int(np.flatnonzero(~last)[-1]) + 1 if not last.all() else 0
                if len(last) - cut > ROWS_HELD:
                    # homes come first: they stay, the visitors so far are done
                    some = [x[cut:] for x in held]
                    out = _compare(np.zeros(len(some[0])), some[1].view(np.uint64), some[2], max_bits).view(np.int64)
                    held = [np.concatenate([x[:cut], y[some[2]]]) for x, y in zip(held, some, strict=True)]
                    yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])
            if cut:
                # key and slice together tell groups apart: neighbours differ in one of them
                new = np.r_[True, (held[0][1:cut] != held[0][: cut - 1]) | (held[3][1:cut] != held[3][: cut - 1])]
                out = _compare(np.cumsum(new), held[1][:cut].view(np.uint64), held[2][:cut], max_bits).view(np.int64)
                held = [x[cut:] for x in held]
                yield pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])

    visits = fps.select("fp").mapInArrow(replicate, "key long, fp long, home boolean")
    many = (
        visits.where("home").groupBy("key").count().where(F.col("count") > HOMES_PER_SLICE)
        .select("key", F.ceil(F.col("count") / HOMES_PER_SLICE).cast("int").alias("slices"))
    )
    own = F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int")
    dealt = (
        visits.join(many, "key", "left")
        .withColumn("slices", F.coalesce("slices", F.lit(1)))
        .withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
        .select("key", "fp", (F.col("home") & (own == F.col("slice"))).alias("home"), "slice")
    )
    placed = dealt.repartition("key", "slice").sortWithinPartitions("key", "slice", F.desc("home"))
    return placed.mapInArrow(compare, "a long, b long")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, max_bits: int = 4, blocks: int = 3
) -> DataFrame:
    """``doc_id, fingerprint, component_id, label, key`` per input row.

    ``component_id`` is the smallest doc_id among all rows reachable over links
    (null only if all their ids are null); ``label`` is the component's smallest
    fingerprint, which also tells groups without ids apart.  Null and wordless
    texts have fingerprint zero and link like any other; repeated rows fall
    into one component; columns other than id and text are not read.
    """
    rows = fingerprints(docs, id_col, text_col, k).checkpoint()
    texts = rows.groupBy("fp").agg(F.min("doc_id").alias("first")).checkpoint()
    found = components(near_links(texts, max_bits, blocks), "a", "b").withColumnsRenamed({"node": "fp"})
    classes = texts.join(found, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    least = classes.groupBy("label").agg(F.min("first").alias("component_id"))
    classes = classes.select("fp", "label").join(least, "label")
    return rows.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "label", "key"
    )


def one_per_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, max_bits: int = 4, blocks: int = 3
) -> DataFrame:
    """The rows of ``docs``, all columns unchanged whatever their names, that stay: of each component the row with the smallest id.

    Rows without an id come last, ties go to the smaller text hash, and of
    repeated rows one stays.  Null and wordless texts form a component like any other; an empty table stays empty.
    """
    found = simhash_components(docs, id_col, text_col, k, max_bits, blocks)
    first = found.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("m"))
    (key,) = fresh(docs.columns, "_row_key")
    keep = first.select(F.col("m.key").alias(key))
    keyed = docs.withColumn(key, row_key(id_col, text_col))
    return keyed.join(keep, key, "left_semi").dropDuplicates([key]).select(*docs.columns)
