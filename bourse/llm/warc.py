"""WARC archives: a writer with revisit records and a splittable reader.

Archives are sequences of gzip members, one per record, written through Spark's
text writer with the record's gzip bytes as the line and a zero byte as the
line end: a gzip member ends with its length's highest byte, zero for every
member below 16 MiB; a larger one is followed by an empty member, which ends in
zero too.  The files are plain ``.warc.gz`` data, committed like any Spark output.

The reader deals byte ranges of the files to tasks.  A task looks for the gzip
magic in its range, decodes a little at each candidate, and accepts it if a
WARC version line and headers come out.  It owns the records that start inside
its range and reads each to its end, beyond the range if need be, so every
record is read once whatever the split.  Compressed bytes that look like the
magic fail the decoding and are passed over.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse.llm.common import write_blobs

SPLIT_BYTES = 8 << 20
MOST_TASKS = 100_000  # of one read; beyond, a task reads several ranges
FILES = "{part-*,*.warc.gz}"  # written by Spark, or ordinary archives
LEAST_PAYLOAD = 1000
MAGIC = b"\x1f\x8b\x08"
READ_BYTES = 1 << 20
BATCH_BYTES = 4 << 20
HEADER_BYTES = 1 << 16  # a candidate must show its version line, and here or further on its whole header
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of capture


# --- records -----------------------------------------------------------------------------------


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """The gzip bytes of one record, ending in a zero byte."""
    sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{sha1}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="".join(map(chr, range(33, 127)))))
    if revisit:
        head += [f"WARC-Refers-To: {_urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    block = http if revisit else http + payload
    head.append(f"Content-Length: {len(block)}")
    whole = "\r\n".join(head).encode("ascii") + b"\r\n\r\n" + block + b"\r\n\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = pack.compress(whole) + pack.flush()
    if out[-1]:
        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
        out += pack.flush()
    return out


def parse(data: bytes) -> dict | None:
    """Headers of a record (names in lower case) and its ``block``; None if it isn't one."""
    top, gap, rest = data.partition(b"\r\n\r\n")
    lines = top.split(b"\r\n")
    if not gap or not re.fullmatch(rb"WARC/\d+\.\d+", lines[0]):
        return None
    out: dict = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        out[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not out.get("content-length", "").isdigit():
        return None
    out["block"] = rest[: int(out["content-length"])]
    return out


# --- reading -----------------------------------------------------------------------------------


def _shows_header(data: bytes) -> bool:
    """Whether a gzip member that begins here decodes to a WARC header, or to the start of one that goes on."""
    try:
        start = zlib.decompressobj(31).decompress(data, HEADER_BYTES)
    except zlib.error:
        return False
    top, gap, _ = start.partition(b"\r\n\r\n")
    if re.match(rb"WARC/\d+\.\d+\r\n", top) is None:
        return False
    # a longer header is judged when the whole record is read
    return not gap or b"\r\nwarc-type:" in top.lower()


def scan(file, start: int, end: int) -> Iterator[tuple[int, dict]]:
    """Offset and content of the records of an open file that start in [start, end).

    Holds one read window and one record at a time.
    """
    at, window, low = start, b"", start  # window: the file's bytes from low on
    size = file.size()

    def bytes_at(place: int, n: int) -> bytes:
        nonlocal window, low
        if place < low or place + n > low + len(window):
            file.seek(place)
            window, low = file.read(max(n, READ_BYTES)), place
        return window[place - low : place - low + n]

    while at < end:
        step = min(READ_BYTES // 2, size - at)
        if step < len(MAGIC):
            return
        found = bytes_at(at, step).find(MAGIC)
        if found < 0:
            at += step - len(MAGIC) + 1
            continue
        at += found
        if at >= end:
            return
        if not _shows_header(bytes_at(at, min(2 * HEADER_BYTES, size - at))):
            at += 1
            continue
        unpack, parts, place, broken = zlib.decompressobj(31), [], at, False
        while not unpack.eof and place < size:
            data = bytes_at(place, min(READ_BYTES // 4, size - place))
            try:
                parts.append(unpack.decompress(data))
            except zlib.error:
                broken = True
                break
            place += len(data)
        content = None if broken or not unpack.eof else parse(b"".join(parts))
        if content is None:
            at += 1
            continue
        yield at, content
        at = place - len(unpack.unused_data)


def _page_id(urn: str) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+)>", urn)
    return int(m[1]) if m else None


def read_warc(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, files: str = FILES) -> DataFrame:
    """``file, offset, record_type, page_id, url, payload_digest, refers_to, payload`` of every record under ``path``,
    in files whose names match ``files``.

    ``payload`` is the HTTP body of a response, null for a revisit;
    ``payload_digest`` is hex SHA-1, taken from the payload where there is one
    and checked against the header.  Empty and foreign files give no records.
    """

    def run(batches):
        from pyarrow import fs

        rows: list[tuple] = []
        held = 0
        names = ["file", "offset", "record_type", "page_id", "url", "payload_digest", "payload_bytes", "refers_to", "payload"]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), TYPES, strict=True)], names)

        for b in batches:
            for name, start, end in zip(*(b.column(c).to_pylist() for c in ("path", "start", "end")), strict=True):
                system, place = fs.FileSystem.from_uri(name)
                with system.open_input_file(place) as file:
                    for offset, r in scan(file, start, end):
                        kind = r.get("warc-type", "")
                        digest = r.get("warc-payload-digest", "").removeprefix("sha1:")
                        digest = base64.b32decode(digest).hex() if re.fullmatch("[A-Z2-7]{32}", digest) else digest.lower()
                        head, gap, body = r["block"].partition(b"\r\n\r\n")
                        length = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", head)
                        payload = None
                        if kind == "response":
                            payload = body if head.startswith(b"HTTP/") and gap else r["block"]
                            own = hashlib.sha1(payload).hexdigest()
                            if digest and own != digest:
                                raise ValueError(f"{name} at {offset}: payload and digest differ")
                            digest = own
                        n = len(payload) if payload is not None else int(length[1]) if length else None
                        row = (
                            name, offset, kind, _page_id(r.get("warc-record-id", "")), r.get("warc-target-uri"),
                            digest, n, _page_id(r.get("warc-refers-to", "")), payload,
                        )
                        rows.append(row)
                        held += len(payload or b"")
                        if held > BATCH_BYTES or len(rows) >= 1024:
                            yield batch(rows)
                            rows, held = [], 0
        if rows:
            yield batch(rows)

    found = spark.read.format("binaryFile").option("pathGlobFilter", files).load(path).select("path", "length").where("length > 0")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))
    ranges = found.select("path", "length", F.explode(starts).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + split_bytes, F.col("length")).alias("end"))
    # a task per range; a stated number is not merged at run time, however few bytes the range rows have
    placed = ranges.repartition(max(1, min(ranges.count(), MOST_TASKS)), "path", "start")
    return placed.mapInArrow(
        run,
        "file string, offset long, record_type string, page_id long, url string, payload_digest string, "
        "payload_bytes long, refers_to long, payload binary",
    )


TYPES = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]


# --- writing -----------------------------------------------------------------------------------


def write_warc(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_PAYLOAD
) -> None:
    """Write one record per row.  Of rows with equal payloads of ``least`` bytes or more the largest id is
    the response and the others are revisits of it.

    A null payload is empty.  Rows without an id are revisits if an equal
    payload has an id, else all are responses; repeated rows with the largest
    id are responses each.  Other columns are not read.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"),
    )
    # who revisits whom is found on narrow rows; the payloads are shuffled once, by row and not by digest
    narrow = rows.select("id", F.sha1(F.encode("html", "UTF-8")).alias("digest"), F.octet_length("html").alias("n")).where(F.col("n") >= least)
    last = narrow.groupBy("digest").agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("copies")).where("copies > 1 and last is not null")
    key = F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("-")), F.col("digest"))
    again = narrow.join(last.select("digest", "last"), "digest").where("id is null or id <> last").select(key.alias("key"), "last").distinct()
    keyed = rows.withColumn("key", F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("-")), F.sha1(F.encode("html", "UTF-8"))))
    ready = keyed.join(again, "key", "left").select("id", "url", "html", "last")

    def run(batches):
        for b in batches:
            columns = (b.column("id").to_pylist(), b.column("url").to_pylist(), b.column("html").cast(pa.binary()).to_pylist(), b.column("last").to_pylist())
            for at in range(0, b.num_rows, 256):
                part = zip(*(c[at : at + 256] for c in columns), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([record(i, u, h, l, l is not None) for i, u, h, l in part], pa.binary())], ["blob"]
                )

    write_blobs(ready.mapInArrow(run, "blob binary"), "blob", path, "\x00")


def oracle(least: int = LEAST_PAYLOAD) -> str:
    """What a round trip of ``pages`` gives, as DuckDB SQL."""
    return f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
q AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha1(b) AS payload_digest,
             CASE WHEN octet_length(b) >= {least} THEN max(page_id) OVER (PARTITION BY b) END AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last <> page_id THEN last END AS refers_to
FROM q"""
