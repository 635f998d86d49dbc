"""How five filters interact: what each removes in every order, and its Shapley value.

Each document is tested by all five filters once, which gives a mask of five bits.  Per part
(source) the 32 coalition values are tabulated: how many documents a set of filters removes
together, in all, of good and of toxic ones.  Everything else follows from that small table:

* a step of an order removes the difference of two coalition values;
* the Shapley value is the solution of a least-squares problem: additive values phi per
  filter, fitted to the coalition values under the Shapley kernel weights, subject to efficiency
  (they sum to what all filters remove together).  Its normal equations are solved in
  rationals once, for every unit right-hand side, so a part's values are integer
  combinations of its coalition values and exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import comb

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bourse.llm.common import text_bytes

FILTERS = "ABCDE"
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_UPPER_PERCENT = 5
SYMBOLS = b"#$%&*|"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
REPEATED = 1 << FILTERS.index("E")


def text_mask(text: bytes, code_points: int) -> int:
    """Bits of the filters A to D that a text fails."""
    words = text.split()  # at ASCII white space, as bytes do
    failed = len(words) < MIN_WORDS
    failed |= (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
    failed |= (100 * (len(text) - len(text.translate(None, UPPER))) > MAX_UPPER_PERCENT * code_points) << 2
    return failed | (len(text.translate(None, SYMBOLS)) < len(text)) << 3


def _tested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = text_bytes(batch, "text")
        points = pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id"),
                batch.column("part"),
                pa.array([text_mask(t, n) for t, n in zip(texts, points, strict=True)], pa.int32()),
                pa.array([xxhash.xxh3_128_digest(t) for t in texts], pa.binary()),
            ],
            names=["id", "part", "failed", "h"],
        )


def shapley_weights(filters: int = len(FILTERS)) -> list[list[Fraction]]:
    """``w[i][S]``: the Shapley value of filter i is the sum over coalitions S of w[i][S] * value(S).

    The normal equations of the kernel-weighted fit with the efficiency constraint
    (a Lagrange multiplier as last unknown), by Gauss-Jordan elimination in rationals.
    """
    everyone = (1 << filters) - 1
    member = [[Fraction(s >> i & 1) for i in range(filters)] for s in range(everyone + 1)]
    size = [sum(m) for m in member]
    kernel = [
        Fraction(filters - 1) / (comb(filters, int(k)) * k * (filters - k)) if 0 < k < filters else Fraction(0) for k in size
    ]
    rows = []
    for i in range(filters):
        left = [sum(kernel[s] * member[s][i] * member[s][j] for s in range(everyone + 1)) for j in range(filters)]
        rows.append([*left, Fraction(1), *(kernel[s] * member[s][i] for s in range(everyone + 1))])
    rows.append([*[Fraction(1)] * filters, Fraction(0), *(Fraction(s == everyone) for s in range(everyone + 1))])
    for c in range(filters + 1):
        pivot = next(r for r in range(c, filters + 1) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [x / rows[c][c] for x in rows[c]]
        for r in range(filters + 1):
            if r != c:
                times = rows[r][c]
                rows[r] = [x - times * y for x, y in zip(rows[r], rows[c], strict=True)]
    return [row[filters + 1 :] for row in rows[:filters]]


def _order_weights() -> list[list[int]]:
    """The weights times the number of orders; whole numbers."""
    scaled = [[w * len(ORDERS) for w in row] for row in shapley_weights()]
    if any(w.denominator != 1 for row in scaled for w in row):
        raise ArithmeticError("the sum over all orders is not a whole number")
    return [[int(w) for w in row] for row in scaled]


def masks(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """``part, failed, n, good, toxic``: documents of each part by the set of filters they fail."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField("id", id_type),
            T.StructField("part", T.StringType()),
            T.StructField("failed", T.IntegerType()),
            T.StructField("h", T.BinaryType()),
        ]
    )
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part")
    )
    once = rows.mapInArrow(_tested, schema).groupBy("h", "failed", "part", "id").agg(F.count(F.lit(1)).alias("n"))
    # rows without an id have no label; their key spreads them over the tasks
    key = F.coalesce(F.col("id").cast("string"), F.concat(F.lit("none "), F.hex("h")))
    judged = (
        labels.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("string").alias("key"))
        .agg(F.max((F.col("quality") == 1).cast("int")).alias("is_good"), F.max((F.col("toxic") == 1).cast("int")).alias("is_toxic"))
    )
    counted = once.withColumn("key", key).join(judged, "key", "left").select(
        "h", "failed", "part", "id",
        F.struct(
            "n", (F.col("n") * F.coalesce("is_good", F.lit(0))).alias("good"), (F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic")
        ).alias("c"),
    )

    def total(of: Column) -> list[Column]:
        return [F.coalesce(F.sum(of[c]), F.lit(0)).alias(c) for c in ("n", "good", "toxic")]

    # equal texts fail A to D alike; per part only the rows of the smallest id can be first of their text
    groups = counted.groupBy("h", "failed", "part").agg(
        *total(F.col("c")),
        F.struct(*total(F.when(F.col("id").isNull(), F.col("c")))).alias("no_id"),
        F.min("id").alias("first_id"),
        F.min_by("c", "id").alias("first"),
    )
    of_all = F.min("first_id").over(Window.partitionBy("h"))  # one row per part and text
    groups = groups.withColumn("is_first", F.coalesce(F.col("first_id") == of_all, F.lit(False)))

    def sides(c: str) -> tuple[Column, Column]:
        kept = F.col("no_id")[c] + F.when(F.col("is_first"), F.col("first")[c]).otherwise(0)
        return kept.alias(c), (F.col(c) - kept).alias(c)

    both = [sides(c) for c in ("n", "good", "toxic")]
    split = F.array(
        F.struct(F.col("failed").alias("failed"), *(k for k, _ in both)),
        F.struct(F.col("failed").bitwiseOR(F.lit(REPEATED)).alias("failed"), *(r for _, r in both)),
    )
    return (
        groups.select("part", F.inline(split))
        .groupBy("part", "failed")
        .agg(*[F.sum(c).cast("long").alias(c) for c in ("n", "good", "toxic")])
    )


def coalitions(by_mask: DataFrame) -> DataFrame:
    """``part, docs, removed, good, toxic``: arrays over the 32 coalitions of what each removes."""
    many = 1 << len(FILTERS)
    hit = (F.col("failed").bitwiseAND(F.col("coalition")) != 0).cast("long")
    by = by_mask.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit(many - 1)))).groupBy("part", "coalition")
    values = by.agg(
        F.sum("n").alias("docs"), *[F.sum(F.col(c) * hit).alias(o) for c, o in (("n", "removed"), ("good", "good"), ("toxic", "toxic"))]
    )
    row = F.sort_array(F.collect_list(F.struct("coalition", "removed", "good", "toxic")))
    listed = values.groupBy("part").agg(F.max("docs").alias("docs"), row.alias("row"))
    return listed.select("part", "docs", *[F.col("row")[c].alias(c) for c in ("removed", "good", "toxic")])


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``.

    600 rows a part: each of the 120 orders of the filters, step by step.  Failure conditions: A under 50
    words; B fewer than 65 distinct words in 100; C more than 5 A-Z in 100 code points; D any of ``#$%&*|``;
    E the text of a row with a smaller id, in any part.  Null text is empty, and equal to an empty
    one; a null part is the part named by the empty string.  A row with a null id never
    fails E and makes no other row fail it; rows that repeat an id do not fail E by each other.  A label counts if any row
    of ``labels`` for that id has it (``quality``, ``toxic``); null labels and ids count for nothing.
    Other columns are not read.  No documents: no parts and no rows.

    Texts are compared by 128 bits of hash.  Copies are pre-aggregated before each shuffle.
    """
    table = coalitions(masks(docs, labels, id_col, text_col, part_col))
    everyone = (1 << len(FILTERS)) - 1

    def dot(weights: list[int]) -> Column:
        products = F.zip_with("removed", F.array(*[F.lit(w).cast("long") for w in weights]), lambda v, w: v * w)
        return F.aggregate(products, F.lit(0).cast("long"), lambda a, x: a + x)

    def at(values: str, coalition: Column) -> Column:
        return F.element_at(values, coalition + 1)

    # the orders and their coalitions are the same for every part: one literal table of 600 small rows
    steps = [
        (order, k, FILTERS.index(order[k - 1]), sum(1 << FILTERS.index(f) for f in order[: k - 1])) for order in ORDERS for k in range(1, 6)
    ]
    listed = F.from_json(
        F.lit("[" + ",".join(f'{{"o":"{o}","s":{k},"f":{f},"b":{b}}}' for o, k, f, b in steps) + "]"),
        "array<struct<o:string,s:int,f:int,b:int>>",
    )
    every = table.withColumn("values", F.array(*[dot(w) for w in _order_weights()])).select("*", F.inline(listed))
    bit = F.expr("shiftleft(1, f)")
    after = F.col("b").bitwiseOR(bit)
    removed = at("removed", after) - at("removed", F.col("b"))
    return every.select(
        "part",
        F.col("o").alias("filter_order"),
        F.col("s").alias("step"),
        (F.col("docs") - at("removed", after)).alias("kept"),
        removed.alias("removed"),
        (at("removed", bit) - removed).alias("redundant"),
        (at("removed", F.lit(everyone)) - at("removed", F.lit(everyone) - bit)).alias("unique_fails"),
        (at("good", after) - at("good", F.col("b"))).alias("good_lost"),
        (at("toxic", after) - at("toxic", F.col("b"))).alias("toxic_lost"),
        F.element_at("values", F.col("f") + 1).alias("shapley"),
    )


def oracle() -> str:
    """The result as DuckDB SQL: every order is walked step by step, Shapley sums are taken over all orders."""
    return r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
f AS (SELECT d.doc_id, part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  (CASE WHEN len(w) < 50 THEN 'A' ELSE '' END)
  || (CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END)
  || (CASE WHEN 100 * len(regexp_replace(x, '[^A-Z]', '', 'g')) > 5 * len(x) THEN 'C' ELSE '' END)
  || (CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 'D' ELSE '' END)
  || (CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY x) THEN 'E' ELSE '' END) AS fails
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
m AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT a.c || b.c || e.c || g.c || h.c AS filter_order FROM c a, c b, c e, c g, c h
  WHERE a.c NOT IN (b.c, e.c, g.c, h.c) AND b.c NOT IN (e.c, g.c, h.c) AND e.c NOT IN (g.c, h.c) AND g.c <> h.c),
s AS (SELECT filter_order, step, filter_order[step] AS letter, filter_order[1:step - 1] AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, letter, fails, n, good, toxic, contains(fails, letter) AS failing,
  before <> '' AND regexp_matches(fails, '[' || before || 'x]') AS gone FROM m, s),
t AS (SELECT part, filter_order, step, letter,
  sum(CASE WHEN NOT gone AND NOT failing THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN NOT gone AND failing THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN gone AND failing THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN NOT gone AND failing THEN good ELSE 0 END) AS good_lost,
  sum(CASE WHEN NOT gone AND failing THEN toxic ELSE 0 END) AS toxic_lost
  FROM r GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley FROM t"""
