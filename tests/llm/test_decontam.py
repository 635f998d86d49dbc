import hashlib
import random
import re

from bourse.llm.decontam import clean_documents, decontaminate
from tests.llm.conftest import sentence


def words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    w, hit, met = words(text), set(), set()
    for item, t in items:
        v = words(t)
        n = min(10, len(v))
        runs = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
        for i in range(len(w) - n + 1 if n else 0):
            if tuple(w[i : i + n]) in runs:
                hit |= set(range(i, i + n))
                met.add(str(item))
    return len(w), len(hit), len(met), hashlib.sha256(",".join(sorted(met)).encode()).hexdigest(), bool(hit)


def _bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_equal_to_brute_force(spark, make_docs):
    rnd = random.Random(2)
    items = [(i, sentence(100 + i, rnd.randint(8, 40))) for i in range(12)]
    items += [(90, "only, three WORDS"), (91, "one"), (92, None), (93, "... !"), (94, items[0][1]), (95, "a b a b a b a b a b a b")]
    pairs = []
    for i in range(60):
        parts = [sentence(1000 + i, rnd.randint(0, 60))]
        for _ in range(rnd.randint(0, 3)):
            v = words(rnd.choice(items)[1]) or ["x"]
            lo = rnd.randrange(len(v))
            parts += [rnd.choice([" ", "\n", ", ", "--"]).join(v[lo : lo + rnd.randint(1, 14)]).upper(), sentence(2000 + i, rnd.randint(0, 5))]
        pairs.append((i, " ".join(parts)))
    pairs += [(70, None), (71, ""), (72, "!!"), (73, "b a " * 30), (5, pairs[5][1]), (None, items[1][1]), (74, "é " + items[2][1] + " é"), (75, sentence(8, 30_000) + " " + items[3][1])]
    want = sorted((str(i), *brute(t, items)) for i, t in pairs)
    for rows in (200_000, 0):  # broadcast and shuffled
        got = decontaminate(make_docs(pairs), _bench(spark, items), broadcast_rows=rows)
        got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got.collect())
        assert got == want
    kept = clean_documents(make_docs(pairs), _bench(spark, items))
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(w[0] for w in want if not w[-1])


def test_empty_tables(spark, make_docs):
    docs, bench = make_docs([(1, sentence(1, 30))]), _bench(spark, [(1, sentence(1, 30))])
    assert [r.contaminated for r in decontaminate(docs, bench.where("false")).collect()] == [False]
    assert decontaminate(docs.where("false"), bench).count() == 0
    assert [r.n_hit for r in decontaminate(docs, bench).collect()] == [30]
