"""Benchmark decontamination by winnowing, in DataFrame functions only.

A text is a sequence of lower-cased words.  Of every run of ``window`` words
the smallest hash among its k-grams is kept as a fingerprint (winnowing with
windows of ``window - k + 1`` k-grams).  Two texts that share ``window``
consecutive words have equal k-gram hashes there, hence share that minimum: no
shared run of that length can be missed, while a text keeps only about
2 / (window - k + 2) of its hashes.  Fingerprints common to a document and an item make the
document a candidate; in candidates the hits are extended to whole windows, word for word.

Items of fewer words than ``window`` are one window of their own length; for
each such length the same winnowing runs with that length as the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import ascii_lower, broadcast_if_small, fresh, let, row_key

# Everything in ASCII that is not a digit or a lower-case letter separates words.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Sides with at most this many rows (of some dozen bytes) are broadcast.
BROADCAST_ROWS = 200_000


def words(text: Column) -> Column:
    """The words of a text after lower-casing A-Z; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, -1), "")


def _runs(hashes: Column, n: int, combine) -> Column:
    """``combine`` of each ``n`` consecutive elements."""
    return F.transform(
        F.slice(hashes, 1, F.greatest(F.size(hashes) - (n - 1), F.lit(0))),
        lambda x, i: combine([x, *(F.get(hashes, i + j) for j in range(1, n))]),
    )


def winnow(word_list: Column, window: int, k: int) -> Column:
    """The distinct fingerprints of a word array that cover every run of ``window`` words."""
    k = min(k, window)

    def of_hashes(h: Column) -> Column:
        grams = _runs(h, k, lambda c: F.xxhash64(F.lit(window), *c))
        span = window - k + 1
        if span == 1:
            return F.array_distinct(grams)
        return let(grams, lambda g: F.array_distinct(_runs(g, span, lambda c: F.least(*c))))

    return let(F.transform(word_list, lambda w: F.xxhash64(w)), of_hashes)


def _windows(word_list: Column, length: int) -> Column:
    """Structs of position and text of every run of ``length`` words."""
    starts = F.when(F.size(word_list) >= length, F.sequence(F.lit(0), F.size(word_list) - length)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(
        starts, lambda i: F.struct(i.alias("at"), F.concat_ws(" ", F.slice(word_list, i + 1, length)).alias("run"))
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    k: int = 5,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``doc_id, key, n_words, n_hit, n_items, items_sha256, contaminated`` per row of ``docs``.

    ``n_hit`` counts the words inside any occurrence of an item's window,
    ``n_items`` the items with such windows.  Null and wordless texts have no
    words and no hits; items without words match nothing; repeated rows and
    items each give their result; with an empty benchmark nothing is hit.
    Other columns are not read.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), words(F.col(item_text_col)).alias("w"))
    items = items.where(F.size("w") > 0).withColumn("length", F.least(F.size("w"), F.lit(window))).checkpoint()
    lengths = sorted(r["length"] for r in items.select("length").distinct().collect())  # at most ``window`` numbers

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"), row_key(id_col, text_col).alias("key"))
    rows = rows.withColumn("w", words(F.col("t")))
    counted = rows.select("doc_id", "key", F.size("w").cast("long").alias("n_words"))

    # fingerprints of both sides, joined
    prints = F.flatten(F.array(*(winnow(F.col("w"), n, k) for n in lengths))) if lengths else F.array().cast("array<bigint>")
    own = None
    for n in lengths:
        some = items.where(F.col("length") == n).select(F.explode(winnow(F.col("w"), n, k)).alias("fp"))
        own = some if own is None else own.unionByName(some)
    if own is None:
        own = items.select(F.lit(0).cast("long").alias("fp"))
    own = broadcast_if_small(own.distinct().checkpoint(), broadcast_rows)
    candidates = rows.select("key", F.explode(prints).alias("fp")).join(own, "fp", "left_semi").select("key").distinct()
    candidates = broadcast_if_small(candidates.checkpoint(), broadcast_rows)

    # whole windows in the candidates, word for word
    near = rows.join(candidates, "key", "left_semi").select("key", "w").dropDuplicates(["key"])

    def runs_of(frame: DataFrame, name: str, n: int) -> DataFrame:
        return frame.select(name, F.explode(_windows(F.col("w"), n)).alias("x")).select(
            name, F.lit(n).alias("length"), "x.at", "x.run"
        )

    hits = None
    for n in lengths:
        item_runs = runs_of(items.where(F.col("length") == n), "item", n).select("item", "run").distinct()
        item_runs = broadcast_if_small(item_runs.checkpoint(), broadcast_rows)
        found = runs_of(near, "key", n).join(item_runs, "run").select("key", "item", "at", "length")
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        hits = near.select("key", F.lit("").alias("item"), F.lit(0).alias("at"), F.lit(1).alias("length")).where("false")
    hits = hits.checkpoint()

    hit_words = (
        hits.select("key", "at", "length").distinct()
        .select("key", F.explode(F.sequence("at", F.col("at") + F.col("length") - 1)).alias("p")).distinct()
        .groupBy("key").agg(F.count("p").alias("n_hit"))
    )
    hit_items = hits.groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    found = hit_words.join(hit_items, "key")
    return counted.join(found, "key", "left").select(
        "doc_id",
        "key",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, all columns unchanged whatever their names, without a benchmark window.

    Null and empty texts are clean and stay; repeated rows stay or go together; with no benchmark items all rows stay.
    """
    (key,) = fresh(docs.columns, "_row_key")
    bad = decontaminate(docs, benchmark, id_col, text_col, **how).where("contaminated").select(F.col("key").alias(key))
    bad = broadcast_if_small(bad.distinct().checkpoint(), how.get("broadcast_rows", BROADCAST_ROWS))
    return docs.withColumn(key, row_key(id_col, text_col)).join(bad, key, "left_anti").drop(key).select(*docs.columns)


def oracle(window: int = 10) -> str:
    """The same result as DuckDB SQL over the tables ``documents`` and ``benchmark``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    cut = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {cut} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {cut} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item, len, array_to_string(w[s + 1 : s + len], ' ') AS run
  FROM (SELECT item, w, least(len(w), {window}) AS len, unnest(range(0, len(w) - least(len(w), {window}) + 1)) AS s
        FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT len FROM iw),
dw AS (
  SELECT rid, len, s, array_to_string(w[s + 1 : s + len], ' ') AS run
  FROM (SELECT rid, w, len, unnest(range(0, len(w) - len + 1)) AS s FROM d, lens WHERE len(w) >= len)),
h AS (SELECT rid, item, s, dw.len AS len FROM dw JOIN iw ON dw.run = iw.run AND dw.len = iw.len),
p AS (SELECT rid, count(*) AS n_hit
      FROM (SELECT DISTINCT rid, unnest(range(s, s + len)) AS pos FROM (SELECT DISTINCT rid, s, len FROM h)) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT rid, item FROM h) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN p USING (rid) LEFT JOIN t USING (rid)"""
