import random
from fractions import Fraction
from itertools import permutations

from pyspark.sql import functions as F

from bourse.llm.filter_audit import filter_audit, shapley_weights
from tests.llm.conftest import sentence

DOCS = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def fails(rows):
    """The letters of the filters that each row fails, from the rules as stated."""
    out = []
    for i, text, _ in rows:
        x = text or ""
        words = [w for w in x.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]
        f = "A" if len(words) < 50 else ""
        f += "B" if 100 * len(set(words)) < 65 * len(words) else ""
        f += "C" if 100 * sum("A" <= c <= "Z" for c in x) > 5 * len(x) else ""
        f += "D" if any(c in "#$%&*|" for c in x) else ""
        smaller = [j for j, t, _ in rows if i is not None and j is not None and j < i and (t or "") == x]
        out.append(f + ("E" if smaller else ""))
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    failed, out, shapley = fails(rows), {}, {}
    for part in {s or "" for _, _, s in rows}:
        mine = [(r[0], f) for r, f in zip(rows, failed) if (r[2] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for k, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                failing = [d for d in mine if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                out[part, order, k] = (
                    len(left), len(gone), len(failing) - len(gone), sum(d[1] == letter for d in mine),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone),
                )
                shapley[part, letter] = shapley.get((part, letter), 0) + len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def result(df):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in df.collect()}


def some_rows():
    rnd = random.Random(3)
    texts = [sentence(n, rnd.choice([3, 49, 50, 120])) for n in range(12)]
    texts += [t.upper() for t in texts[:3]] + [t + " 5 % & more" for t in texts[3:6]] + ["one two " * 60, "", None, "É x y \U0001d400 A", "long " * 30000]
    return [(i if i % 9 else None, rnd.choice(texts), rnd.choice(["a", "b", None, "", "hot", "hot", "hot"])) for i in range(160)]


def test_equals_every_order_walked(spark):
    rows = some_rows()
    rows += rows[5:9] + [(None, None, None)] * 3  # repeated rows and ids
    labels = [(i, i % 2, None if i % 5 else 1) for i in range(0, 150, 3)] + [(None, 1, 1), (3, 1, 1), (3, None, None)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(-1) for c in ("n", "h", "failed", "first", "o", "good", "key")})
    got = filter_audit(docs, spark.createDataFrame(labels, LABELS).withColumn("n", F.lit(7)))
    assert result(got) == brute(rows, labels)


def test_parts_do_not_share_but_texts_do(spark):
    rows = [(1, "x", "a"), (2, "x", "b"), (3, "x", "b")]
    got = result(filter_audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS)))
    assert got["a", "EABCD", 1][1] == 0 and got["b", "EABCD", 1][1] == 2
    assert got == brute(rows, [])


def test_no_documents(spark):
    assert filter_audit(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)).count() == 0


def test_least_squares_gives_the_average_over_orders():
    rnd = random.Random(1)
    for filters in (2, 3, 5):
        value = [0] + [rnd.randint(0, 1000) for _ in range(2**filters - 1)]
        for i, weights in enumerate(shapley_weights(filters)):
            added = []
            for order in permutations(range(filters)):
                before = sum(1 << f for f in order[: order.index(i)])
                added.append(value[before | 1 << i] - value[before])
            assert sum(w * v for w, v in zip(weights, value)) == Fraction(sum(added), len(added))
