import zlib

import numpy as np

from bourse.llm import toxicity as T
from tests.llm.conftest import sentence


def _corpus(make_docs, spark):
    bad = ["slurgo", "slurgan", "vilepi", "vileka"]
    pairs, labels = [], []
    for i in range(600):
        toxic = i % 6 == 0
        text = sentence(i, 40) + (f" {bad[i // 6 % 4]}, {bad[i // 12 % 4].title()}" if toxic else "")
        pairs.append((i, text))
        if i % 4 < 2:
            labels.append((i, 1, int(toxic)))
    return pairs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_rows(spark, make_docs):
    pairs, labels = _corpus(make_docs, spark)
    docs = make_docs(pairs + [(1000, None), (1001, ""), (1002, sentence(7, 30_000) + " slurgo slurgan"), (None, "you vilepi"), (0, pairs[0][1])])
    model = T.train(docs, labels)
    rows = T.score_toxicity(docs, model).collect()
    assert len(rows) == 605 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    wrong = [r.doc_id for r in rows if r.doc_id is not None and r.doc_id < 600 and r.predicted != (r.doc_id % 6 == 0)]
    assert len(wrong) <= 3
    by = {r.doc_id: r for r in rows}
    assert by[1000].score == by[1001].score < 0.3 and by[1002].predicted == 1 and not by[None].held_out


def test_risk_stays_non_negative_and_separates():
    rng = np.random.default_rng(0)
    x_p = np.c_[np.ones((80, 1)), rng.integers(0, 2, (80, 5))].astype(float)
    x_u = np.c_[rng.random((800, 1)) < 0.1, rng.integers(0, 2, (800, 5))].astype(float)
    w, b = T.fit_nnpu(x_p, x_u, 0.1)
    hit, miss = 1 / (1 + np.exp(-(w[0] + b + x_u[:, 1:] @ w[1:]))), 1 / (1 + np.exp(-(b + x_u[:, 1:] @ w[1:])))
    assert hit.min() > 0.5 and miss.max() < 0.3


def test_edges(spark, make_docs):
    docs = make_docs([(1, "a b"), (None, None)])
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.predicted for r in T.score_toxicity(docs, T.train(docs, labels)).collect()} == {0}
    odd = spark.createDataFrame([(1, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    assert T.train(docs.where("false"), odd).weights == {}
    assert T.score_toxicity(docs.where("false"), T.train(docs, odd)).count() == 0


def test_several_words_of_one_root():
    own = T.features("Slurgan, slurgo vile")
    assert {"slurgan", "slurgo", "slurg*", "slurg**", "vile", "vile*"} <= own and "vile**" not in own and "slurga**" not in own
    assert "slurg**" not in T.features("slurgo Slurgo slurgo")
    # clean texts hold one word of a root, toxic ones several
    forms = ["baxo", "baxil", "baxent", "baxur"]
    positive = [T.features(f"{forms[i % 4]} {forms[(i + 1) % 4]} {sentence(i, 20)}") for i in range(60)]
    rest = [T.features(f"{forms[i % 4]} {sentence(i, 20)}") for i in range(1000, 1400)]
    everything = rest + [T.features(f"{forms[i % 4]} {forms[(i + 2) % 4]} {sentence(i, 20)}") for i in range(2000, 2040)]
    names = T.select_features(positive, everything, 0.1, 100)
    w, b = T.fit_nnpu(T._matrix(positive, names), T._matrix(everything, names), 0.1)
    score = T.Model(dict(zip(names, w.tolist(), strict=True)), b).scorer()
    assert "bax**" in names and score(f"baxor {sentence(9, 20)}") < 0.3 < score(f"baxor baxim {sentence(9, 20)}")


def brute_risk(w, x_p, x_u, prior, l2):
    def loss(z):
        return np.logaddexp(0, -z)

    g_p, g_u = x_p @ w[:-1] + w[-1], x_u @ w[:-1] + w[-1]
    return prior * loss(g_p).mean() + max(0, loss(-g_u).mean() - prior * loss(-g_p).mean()) + l2 / 2 * (w[:-1] ** 2).sum()


def test_fit_reaches_the_least_risk():
    """On data whose risk on negatives stays positive, no nearby weights have a smaller risk."""
    rng = np.random.default_rng(3)
    x_u = rng.integers(0, 2, (400, 4)).astype(float)
    x_p = (rng.random((100, 4)) < [0.8, 0.6, 0.5, 0.3]).astype(float)
    w, b = T.fit_nnpu(x_p, x_u, 0.3, steps=3000, rate=0.02, l2=1e-3)
    best = np.r_[w, b]
    least = brute_risk(best, x_p, x_u, 0.3, 1e-3)
    assert all(brute_risk(best + 0.05 * d, x_p, x_u, 0.3, 1e-3) > least for d in rng.normal(size=(200, 5)))
