"""Token ids on disk as one compressed wavelet matrix per shard, with rank and select.

A wavelet matrix stores a sequence of ids as one bit-plane per bit of an id,
highest bit first; each plane is in the order that a stable partition by the
planes above has left.  With the number of ones before each chunk of a plane
at hand, single ids are read, ids are counted and their places looked up from
the planes alone, decoding only the chunks that are touched.

File: magic, header length (u32), header (JSON), then the sections that the
header names by offset: the document table and the chunks of every plane, each
compressed on its own with zstandard.  The last byte is a line feed.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import types
import zlib
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bourse.llm.common import row_key, write_blobs
from bourse.session import scratch_path

MAGIC = b"WVLTMTX1"
CHUNK_BITS = 1 << 18
SHARD_TOKENS = 1 << 21
CACHED_PIECES = 150_000  # a worker keeps up to twice as many between tasks
SLICE_BYTES, SLICE_WORDS = 4 << 20, 1 << 16  # texts whose words are numbered at once; words that are looked up or laid out at once
CACHED_CHUNKS = 256


# --- text to ids -------------------------------------------------------------------------------

# Words made of these characters only are split here as the tokenizer splits them; all others go
# through the whole tokenizer.  Composed Latin-1 letters stay as they are under its normalisation.
PLAIN = re.compile(r"[!-;=-~À-ÖØ-öø-ÿ]+")
OTHER = re.compile(r"[^ !-;=-~À-ÖØ-öø-ÿ]")
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ a-zß-öø-ÿ0-9]+| ")  # of words with single spaces between
GAP = 0xFFFFFFFF  # ends a word's ids; no id is that large
# What a tokenizer file must say for the splitting above to be its own.
NORMALIZES = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
SPLITS = {
    "type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True
}


def byte_letters() -> dict[int, str]:
    """The letter that byte-level BPE writes for each byte: itself if printable, else the next one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return {b: chr(b) if b in own else chr(next(rest)) for b in range(256)}


class _Kept(dict):
    """A dict that computes what it lacks; when it is full, only what is used again before it next fills stays."""

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute, self.most, self.old = compute, most, {}

    def __missing__(self, key):
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        value = self.old.get(key)
        value = self[key] = self.compute(key) if value is None else value
        return value


class WordEncoder:
    """Ids of whole texts, as little-endian unsigned 32-bit numbers, with words looked up once.

    The word tokenizer never merges over white space, so a text's ids are its
    words' ids one after the other.  The different words of many texts are encoded together.  A
    tokenizer file with other rules than ``NORMALIZES`` and ``SPLITS`` encodes whole texts instead.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        # the parts' own state: the whole file as JSON would hold every word once more
        normalizes, splits = (json.loads(p.__getstate__()) if p else None for p in (self.whole.normalizer, self.whole.pre_tokenizer))
        first = ((splits or {}).get("pretokenizers") or [None])[0]
        self.by_words = normalizes == NORMALIZES and first == SPLITS and type(self.whole.model).__name__ == "BPE"
        model, letters = self.whole.model, byte_letters()

        four = [i.to_bytes(4, "little") for i in range(self.whole.get_vocab_size())]
        gap = GAP.to_bytes(4, "little")

        def of_piece(piece: str) -> bytes:
            """A space is the gap between words; what is not plain is a whole word."""
            if piece == " ":
                return gap
            if not (piece.isascii() and piece.isalpha()) and not PLAIN.fullmatch(piece):
                return b"".join([four[i] for i in self.whole.encode(piece, add_special_tokens=False).ids])
            shown = piece if piece.isascii() else "".join([letters[b] for b in piece.encode()])
            return b"".join([four[t.id] for t in model.tokenize(shown)])

        self.pieces = _Kept(of_piece, CACHED_PIECES)

    def encode(self, text: bytes) -> bytes:
        return self.encode_all(pa.array([text], pa.binary()))[0].tobytes()

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (binary, no nulls) one after the other, and every text's number of ids."""
        if not self.by_words:
            rows = [np.array(self.whole.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids, "<u4") for t in texts.to_pylist()]
            return np.concatenate([np.empty(0, "<u4"), *rows]), np.array([len(r) for r in rows], np.int64)
        # The tokenizer lower-cases too; doing it here makes fewer different words.  Not where capitals
        # keep a special token's name from being one, or carry a combining mark (U+0300 to U+036F).
        as_is = pc.or_(pc.match_substring(texts, b"<"), pc.or_(pc.match_substring(texts, b"\xcc"), pc.match_substring(texts, b"\xcd")))
        texts = texts.view(pa.string())
        split = pc.ascii_split_whitespace(pc.if_else(as_is, texts, pc.ascii_lower(texts)))
        words, offsets = split.values.dictionary_encode(), split.offsets.to_numpy()
        del split
        found = [self._of_words(words.dictionary.slice(lo, SLICE_WORDS)) for lo in range(0, len(words.dictionary), SLICE_WORDS)]
        if not found:
            return np.empty(0, "<u4"), np.zeros(len(texts), np.int64)
        bases = np.cumsum([0] + [len(f) for f, _, _ in found])
        flat, lengths = np.concatenate([f for f, _, _ in found]), np.concatenate([n for _, _, n in found])
        starts = np.concatenate([at + base for (_, at, _), base in zip(found, bases, strict=False)])
        codes = words.indices.to_numpy()
        before = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(lengths[codes], out=before[1:])
        ids = np.empty(before[-1], "<u4")
        for lo in range(0, len(codes), SLICE_WORDS):
            some = codes[lo : lo + SLICE_WORDS]
            a, b = before[lo], before[lo + len(some)]
            at = np.repeat(starts[some] - before[lo : lo + len(some)], lengths[some])
            at += np.arange(a, b)
            ids[a:b] = flat.take(at)
        return ids, np.diff(before[offsets])

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where each word's begin in them and how many they are."""
        whole = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words)
        text, rest, order = pc.binary_join(whole, " ").view(pa.binary())[0].as_py().decode("utf-8", "replace"), [], None
        if OTHER.search(text):
            shown = text.split(" ")
            plain = [PLAIN.fullmatch(w) is not None for w in shown]
            text = " ".join([w for w, p in zip(shown, plain, strict=True) if p])
            rest = [w for w, p in zip(shown, plain, strict=True) if not p]
            order = np.argsort(~np.array(plain), kind="stable")
        pieces = PIECES.findall(text.lower() + " ") if len(rest) < len(words) else []
        for w in rest:
            pieces += [w, " "]
        flat = np.frombuffer(b"".join(map(self.pieces.__getitem__, pieces)), "<u4")
        ends = np.flatnonzero(flat == GAP)
        starts = np.concatenate([[0], ends[:-1] + 1])
        if order is not None:
            back = np.argsort(order)
            starts, ends = starts[back], ends[back]
        return flat, starts, ends - starts


def tokenizer_file(name: str) -> str:
    """The place of an installed public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str) -> WordEncoder:
    """This Python worker's encoder: kept between tasks, as its word table fills with use."""
    held = sys.modules.setdefault("_word_encoders", types.ModuleType("_word_encoders"))
    if path not in held.__dict__:
        held.__dict__[path] = WordEncoder(path)
    return held.__dict__[path]


# --- the file ----------------------------------------------------------------------------------


def build(ids: np.ndarray, doc_ids: list, lengths: np.ndarray, order: str, bits: int) -> bytes:
    """One shard's file: ``ids`` of documents ``doc_ids`` of ``lengths`` ids each."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    sections: list[bytes] = []
    at = 0

    def put(data: bytes) -> list[int]:
        nonlocal at
        data = squeeze(data)
        sections.append(data)
        at += len(data)
        return [at - len(data), len(data)]

    header: dict = {"n": len(ids), "bits": bits, "chunk_bits": CHUNK_BITS, "order": order, "planes": []}
    header["doc_ids"] = put(json.dumps(doc_ids).encode())
    header["lengths"] = put(np.asarray(lengths, dtype="<i8").tobytes())
    a = ids.astype(np.uint16 if bits <= 16 else np.uint32)
    for k in range(bits - 1, -1, -1):
        one = (a & a.dtype.type(1 << k)) != 0
        packed = np.packbits(one, bitorder="little")
        ones, chunks = [0], []
        for lo in range(0, len(packed), CHUNK_BITS // 8):
            part = packed[lo : lo + CHUNK_BITS // 8]
            ones.append(ones[-1] + int(np.bitwise_count(part).sum(dtype=np.int64)))
            chunks.append(put(part.tobytes()))
        header["planes"].append({"bit": k, "ones": ones, "chunks": chunks})
        a = np.concatenate([a.take(np.flatnonzero(~one)), a.take(np.flatnonzero(one))])
    head = json.dumps(header).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *sections, b"\n"])


class WaveletShard:
    """A shard read from its file's bytes; chunks are decoded when they are needed."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a wavelet shard")
        (size,) = struct.unpack_from("<I", data, 8)
        self.header = json.loads(bytes(data[12 : 12 + size]))
        self.data, self.base = data, 12 + size
        self.n, self.bits, self.order = self.header["n"], self.header["bits"], self.header["order"]
        self.planes = self.header["planes"]
        self.ones = [np.array(p["ones"], dtype=np.int64) for p in self.planes]
        self.zeros = [self.n - int(o[-1]) for o in self.ones]
        self.expand = zstandard.ZstdDecompressor().decompress
        self.held: OrderedDict = OrderedDict()

    def _section(self, place: list[int]) -> bytes:
        lo = self.base + place[0]
        return self.expand(bytes(self.data[lo : lo + place[1]]))

    def documents(self) -> tuple[list, np.ndarray]:
        """Document ids and their numbers of ids, in file order."""
        return json.loads(self._section(self.header["doc_ids"])), np.frombuffer(self._section(self.header["lengths"]), "<i8")

    def _chunk(self, plane: int, c: int) -> np.ndarray:
        if (plane, c) not in self.held:
            size = min(CHUNK_BITS, self.n - c * CHUNK_BITS)
            raw = np.frombuffer(self._section(self.planes[plane]["chunks"][c]), np.uint8)
            self.held[plane, c] = np.unpackbits(raw, bitorder="little", count=size)
            if len(self.held) > CACHED_CHUNKS:
                self.held.popitem(last=False)
        return self.held[plane, c]

    def _rank(self, plane: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        c, off = divmod(i, CHUNK_BITS)
        return int(self.ones[plane][c]) + (int(np.count_nonzero(self._chunk(plane, c)[:off])) if off else 0)

    def _select(self, plane: int, bit: int, j: int) -> int:
        """Place of the j-th (from 0) bit of a plane that equals ``bit``."""
        before = self.ones[plane] if bit else np.minimum(np.arange(len(self.ones[plane])) * CHUNK_BITS, self.n) - self.ones[plane]
        c = int(np.searchsorted(before, j, side="right")) - 1
        return c * CHUNK_BITS + int(np.flatnonzero(self._chunk(plane, c) == bit)[j - int(before[c])])

    def access(self, i: int) -> int:
        """The id at place i."""
        value = 0
        for p in range(self.bits):
            c, off = divmod(i, CHUNK_BITS)
            bit, ones = int(self._chunk(p, c)[off]), self._rank(p, i)
            value = value << 1 | bit
            i = self.zeros[p] + ones if bit else i - ones
        return value

    def _range(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        for p in range(self.bits):
            a, b = self._rank(p, lo), self._rank(p, hi)
            one = value >> (self.bits - 1 - p) & 1
            lo, hi = (self.zeros[p] + a, self.zeros[p] + b) if one else (lo - a, hi - b)
        return lo, hi

    def count(self, value: int, lo: int = 0, hi: int | None = None) -> int:
        """How often an id occurs at places lo to hi (exclusive)."""
        if not 0 <= value < 1 << self.bits:
            return 0
        a, b = self._range(value, lo, self.n if hi is None else hi)
        return b - a

    def find(self, value: int, j: int) -> int:
        """The place of an id's j-th occurrence (from 0)."""
        if not 0 <= j < self.count(value):
            raise IndexError(j)
        i = self._range(value, 0, self.n)[0] + j
        for p in range(self.bits - 1, -1, -1):
            one = value >> (self.bits - 1 - p) & 1
            i = self._select(p, one, i - self.zeros[p] if one else i)
        return i

    def ids(self) -> np.ndarray:
        """All ids in order: the planes' partitions undone from the last to the first."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        value = np.zeros(self.n, dtype=kind)
        for p in range(self.bits - 1, -1, -1):
            raw = [self._section(c) for c in self.planes[p]["chunks"]]  # every chunk but the last is whole bytes
            one = np.unpackbits(np.frombuffer(b"".join(raw), np.uint8), bitorder="little", count=self.n).view(bool)
            up = np.empty_like(value)
            up[np.flatnonzero(~one)] = value[: self.zeros[p]]  # places are faster than a mask
            up[np.flatnonzero(one)] = value[self.zeros[p] :] | kind(1 << (self.bits - 1 - p))
            value = up
        return value


# --- the jobs ----------------------------------------------------------------------------------


def slices(batch: pa.RecordBatch, column: str, size: int):
    """A batch's rows in order, in parts whose texts begin in the same ``size`` bytes of the column."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = (np.cumsum(lengths) - lengths) // size
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        if lo < hi:
            yield batch.slice(lo, hi - lo)


def write_shards(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    vocabulary: int = 1 << 16,
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Write every text's ids and the end id, in ascending id order, one file per shard.

    Rows are dealt by ranges of (id, text hash, row number), so rows without an id (they
    come first), repeated ids and repeated rows spread like all others.  A shard is named by its
    partition and its number there, which is the order of the documents.  It closes at
    ``shard_tokens`` ids; a longer document has one of its own.  Null and empty
    texts have the end id alone; an empty table writes no shard.
    """
    bits = max(1, (vocabulary - 1).bit_length())

    def run(batches):
        enc = encoder(tokenizer_path)
        parts: list[np.ndarray] = []
        doc_ids: list = []
        lengths: list[int] = []
        held, shards = 0, 0
        partition = TaskContext.get().partitionId()

        def shard():
            name = f"{partition:09d}-{shards:09d}"
            blob = build(np.concatenate(parts), doc_ids, np.array(lengths), name, bits)
            return pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], ["blob"])

        for b in batches:
            for part in slices(b, "_text", SLICE_BYTES):
                ids, sizes = enc.encode_all(pc.fill_null(part.column("_text").cast(pa.binary()), b""))
                ids = np.insert(ids, np.cumsum(sizes), end_id)
                at = 0
                for i, size in zip(part.column("_id").to_pylist(), (sizes + 1).tolist(), strict=True):
                    if parts and held + size > shard_tokens:
                        yield shard()
                        shards += 1
                        parts, doc_ids, lengths, held = [], [], [], 0
                    parts.append(ids[at : at + size])
                    doc_ids.append(i)
                    lengths.append(size)
                    at += size
                    held += size
        if parts:
            yield shard()

    # a key whose text order is the order of the ids: sign, then 19 digits
    i = F.col("_id")
    order = F.when(i.isNull(), "0").when(
        i < 0, F.concat(F.lit("1"), F.lpad((i - F.lit(-(1 << 63))).cast("string"), 19, "0"))
    ).otherwise(F.concat(F.lit("2"), F.lpad(i.cast("string"), 19, "0")))
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    rows = rows.withColumn("_order", F.concat_ws(":", order, row_key("_id", "_text"))).withColumn("_row", F.monotonically_increasing_id())
    placed = rows.repartitionByRange("_order", "_row").sortWithinPartitions("_order", "_row")
    blobs = placed.select("_id", "_text").mapInArrow(run, "blob binary")
    write_blobs(blobs, "blob", path, "\n", one_per_file=True)


def read_documents(spark, path: str) -> DataFrame:
    """``shard, place, doc_id, local_start, n_tokens, ids_crc32`` for every document in the files."""

    def run(batches):
        names = ["shard", "place", "doc_id", "local_start", "n_tokens", "ids_crc32"]
        for b in batches:
            for data in b.column("content"):
                shard = WaveletShard(data.as_py())
                doc_ids, lengths = shard.documents()
                raw = memoryview(shard.ids().astype("<u4").tobytes())
                ends = np.cumsum(lengths)
                starts = ends - lengths
                crc = [zlib.crc32(raw[4 * s : 4 * e]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard.order] * n, pa.string()), pa.array(range(n), pa.int64()), pa.array(doc_ids, pa.int64()),
                        pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(crc, pa.int64()),
                    ],
                    names,
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(run, "shard string, place long, doc_id long, local_start long, n_tokens long, ids_crc32 long")


def token_table(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1, path: str | None = None, **how
) -> DataFrame:
    """Write the shards (to ``path``, else a scratch folder) and return what the files hold.

    ``doc_id, start, n_tokens, ids_crc32`` per row; ``start`` counts the ids of
    all documents before it.  Rows that repeat are written and returned each.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_shards(docs, path, tokenizer_path, id_col, text_col, end_id, **how)
    found = read_documents(spark, path).checkpoint()
    shards = found.groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard of 2^21 ids
    starts = shards.select("shard", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    return found.join(starts, "shard").select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )
