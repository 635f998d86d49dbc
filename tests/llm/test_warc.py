import gzip
import io
import os

from pyspark.sql import functions as F

from bourse.llm import warc
from bourse.session import scratch_path

PAGES = "page_id long, url string, html string, payload string, last long, key string"


def _pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", -1, "k") for i, u, h in rows], PAGES)


def _round(spark, rows, split=warc.SPLIT_BYTES):
    path = scratch_path(spark, "t-warc")
    warc.write_warc(_pages(spark, rows), path)
    got = warc.read_warc(spark, path, split)
    return path, sorted(got.collect(), key=lambda r: (r.page_id is None, r.page_id, r.offset))


def test_round_trip_and_edges(spark):
    big, other = "é<p>" * 400, "b" * 1000
    rows = [
        (1, "http://a/x y\r\nz?é", big), (5, "u5", big), (3, None, big), (None, "n", big), (7, "u7", None), (8, "u8", ""),
        (9, "u9", "short"), (10, "u10", "short"), (11, "u", other), (11, "u", other), (None, None, "c" * 2000),
        (12, "u12", "z" * 3_000_000), (-4, "u", "b" * 999), (13, "u", "b" * 999),
    ]
    _, got = _round(spark, rows)
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append((r.record_type, r.refers_to, r.payload_bytes))
    n = len(big.encode())
    assert by[1] == by[3] == [("revisit", 5, n)] and by[5] == [("response", None, n)]
    assert sorted(by[None], key=str) == [("response", None, 2000), ("revisit", 5, n)]
    assert by[7] == by[8] == [("response", None, 0)] and by[9] == by[10] == [("response", None, 5)]
    assert by[11] == [("response", None, 1000)] * 2 and by[12] == [("response", None, 3_000_000)]
    assert by[-4] == by[13] == [("response", None, 999)]
    texts = {r.page_id: bytes(r.payload).decode() for r in got if r.record_type == "response" and r.page_id is not None}
    assert texts[5] == big and texts[12] == "z" * 3_000_000 and texts[7] == ""
    assert all(r.payload is None for r in got if r.record_type == "revisit")
    assert "\r" not in [r.url for r in got if r.page_id == 1][0]


def test_any_split_gives_every_record_once(spark):
    rows = [(i, f"u{i}", f"text {i} " * (i * 7 % 90)) for i in range(60)]
    path, whole = _round(spark, rows)
    for split in (100, 777, 5000):
        got = warc.read_warc(spark, path, split).collect()
        assert sorted((r.page_id, r.payload_digest, r.file, r.offset) for r in got) == sorted(
            (r.page_id, r.payload_digest, r.file, r.offset) for r in whole
        )
    files = [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-")]
    plain = b"".join(gzip.open(f"{path.removeprefix('file:')}/{f}").read() for f in files)  # ordinary gzip files
    assert plain.count(b"WARC/1.1\r\n") == 60


class _File(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_false_magic_is_passed_over():
    one = warc.record(1, "u", b"x" * 50, None, False)
    noise = b"\x1f\x8b\x08" + b"junk" * 9 + gzip.compress(b"not a warc record") + one[:40]
    data = noise + one + b"\x1f\x8b" + warc.record(2, None, b"", 1, True)
    found = list(warc.scan(_File(data), 0, len(data)))
    assert [o for o, _ in found] == [len(noise), len(noise) + len(one) + 2]
    assert [r["warc-type"] for _, r in found] == ["response", "revisit"]


def test_empty_table(spark):
    path = scratch_path(spark, "t-warc")
    warc.write_warc(_pages(spark, [(1, "u", "x")]).where(F.lit(False)), path)
    assert warc.read_warc(spark, path).count() == 0


def test_long_headers_and_ordinary_file_names(spark, tmp_path):
    rows = [(1, "data:" + "é" * 40_000, "x"), (2, "u2", "y"), (3, "data:" + "".join(chr(0x4E00 + i % 9000) for i in range(60_000)), "z")]
    _, got = _round(spark, rows)
    assert [r.page_id for r in got] == [1, 2, 3]
    (tmp_path / "crawl.warc.gz").write_bytes(b"".join(warc.record(i, u, h.encode(), None, False) for i, u, h in rows))
    (tmp_path / "notes.txt").write_bytes(b"no records")
    assert sorted(r.page_id for r in warc.read_warc(spark, str(tmp_path)).collect()) == [1, 2, 3]


def test_a_read_has_a_task_per_range(spark):
    pages = spark.range(3000).selectExpr("id as page_id", "concat('http://x/', id) as url", "repeat(md5(string(id)), 40) as html")
    path = scratch_path(spark, "t-warc-tasks")
    warc.write_warc(pages.repartition(4), path)
    found = warc.read_warc(spark, path, split_bytes=1 << 14)
    spread = found.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in spread) == 3000
    assert len(spread) > 8 and max(r["count"] for r in spread) < 1000
