import gc
import math
import zlib
from collections import Counter

import numpy as np
import pytest

from bourse.llm import lm
from tests.llm.conftest import sentence


def _words(text):
    return (text or "").encode().lower().split() + ["end"]


def _base(pairs):
    c = Counter()
    for i, t in pairs:
        if i is None or zlib.crc32(str(i).encode()) % 10:
            c.update(_words(t))
    n, v = sum(c.values()), len(c)
    out = {}
    for i, t in pairs:
        w = _words(t)
        out[i, t] = (len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w))
    return out


@pytest.mark.parametrize("common", [1 << 17, 5])
def test_base_scores_equal_brute_force(spark, make_docs, common):
    pairs = [(i, " ".join(sentence(i % 9, 30).split()[: i % 30]) + (" The the é\xa0x" if i % 3 else "")) for i in range(80)]
    pairs += [(200, None), (201, ""), (None, "the x"), (202, sentence(77, 5000)), pairs[5], pairs[5]]
    want = _base(pairs)
    rows = lm.score_texts(make_docs(pairs), vocabulary=8, common_words=common, width=4, rounds=1).collect()
    assert len(rows) == len(pairs)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    assert got == sorted((str(i), *want[i, t][:3], round(want[i, t][3], 6)) for i, t in pairs)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in rows)
    assert all(r.score < 0 for r in rows)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    table = lm.Table(np.arange(20), rng.integers(1, 50, 20), 7, 1000, 60, 10)
    model = lm.LogBilinear.first(table, 6)
    ids = np.arange(len(table.unigram))
    for one, two in ((3, 4), (table.start, table.start), (table.other, 0)):
        p = 10 ** model.log10(ids, np.full(len(ids), one), np.full(len(ids), two))
        assert p.sum() == pytest.approx(1, abs=1e-4)
    # the shared id: all its words and one unseen
    own = table.c[table.id == table.other]
    rest = table.other_tokens - own.sum()
    kinds = table.other_kinds - len(own)
    share = 10 ** table.within_other(own.astype(float))
    assert share.sum() + (rest + 0.1 * (kinds + 1)) / (table.other_tokens + 0.1 * (table.other_kinds + 1)) == pytest.approx(1)


def test_noise_contrast_learns_the_order_of_words():
    cycle = [b"alpha", b"beta", b"gamma", b"delta", b"eps"]
    texts = [b" ".join(cycle[(i + j) % 5] for j in range(60)) for i in range(50)]
    ((_, words),) = lm._chunks(texts)
    at, hashes, lengths = lm._number(words)
    counts = np.bincount(at)
    table = lm.Table(hashes, counts, len(texts), int(counts.sum()) + len(texts), len(counts) + 1, 20)
    token, one, two, starts = lm.sequences(table, at, hashes, lengths)
    assert starts.tolist() == [61 * i for i in range(50)] and (token[60::61] == table.end).all()
    assert (one[::61] == table.start).all() and (one[1:61] == token[:60]).all() and (two[2:61] == token[:59]).all()
    model = lm.LogBilinear.first(table, 8)
    trainer = lm.Trainer(model, table.unigram, 0, 0.05)
    before = model.log10(token, one, two).mean()
    for _ in range(150):
        trainer.cases(token, one, two)
    assert model.log10(token, one, two).mean() > 0.4 * before


def test_held_out_texts_score_above_the_unigram(spark, make_docs):
    # two languages: the words before tell which one is next
    halves = [sentence(1, 150).split(), sentence(2, 150).split()]
    pairs = [(i, " ".join(halves[i % 2][(i * 7 + j * j) % 150] for j in range(120))) for i in range(400)]
    rows = [r for r in lm.score_texts(make_docs(pairs), vocabulary=280, width=8, rounds=3).collect() if r.held_out]
    assert rows and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_empty(spark, make_docs):
    docs = make_docs([(2, "a b"), (3, None)])
    assert lm.score_texts(docs.where("false")).count() == 0
    only = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0][0]
    (r,) = lm.score_texts(make_docs([(only, "a b")])).collect()
    assert r.held_out and r.train_tokens == 0 and r.n_known == 0 and r.n_tokens == 3


def test_vocabulary_follows_the_corpus(spark):
    for n in (50, 3000):
        # word i of n occurs twice, one word as often as all others
        counts = spark.createDataFrame([(i, 2) for i in range(n)] + [(-1, 2 * n)], "h long, c long")
        assert lm.least_common(counts, 10, 0.9) == (2, n + 1) and lm.least_common(counts, 10, 0.5) == (2 * n, 1)
    n = 2000
    table = lm.Table(np.arange(n), np.arange(n, 0, -1), 7, 10 * n * n, n + 1, n)
    model = lm.LogBilinear.first(table, 6)
    assert max(np.diff(model.bounds)) <= 45 and model.bounds[-1] == n + 2
    # the words before are seen by the model also if they are rare
    token = np.array([5, 5])
    a, b = model.log10(token, np.array([1900, 1901]), np.array([3, 3]))
    assert a != b
    ids = np.arange(n + 2)
    assert (10 ** model.log10(ids, np.full(n + 2, 1900), np.full(n + 2, 3))).sum() == pytest.approx(1, abs=1e-4)


def test_every_token_has_the_same_weight():
    rng = np.random.default_rng(1)
    table = lm.Table(np.arange(50), np.arange(50, 0, -1), 10, 200_000, 52, 50)
    trainer = lm.Trainer(lm.LogBilinear.first(table, 4), table.unigram, 0, 0.01)
    token = np.r_[np.full(20_000, table.other), rng.integers(0, 50, 30_000)]
    one = np.r_[np.full(20_000, table.other), rng.integers(0, 50, 30_000)]
    two = np.r_[np.full(20_000, table.other), rng.integers(0, 3, 30_000)]
    steps = []
    trainer.step = lambda t, o, w, weight: steps.append((list(zip(t.tolist(), o.tolist(), w.tolist(), strict=True)), weight))
    trainer.cases(token, one, two)
    trained = Counter()
    for cases, weight in steps:
        assert weight.sum() <= 1 + lm.HEAVIEST / lm.MINIBATCH
        for case, x in zip(cases, weight.tolist(), strict=True):
            trained[case] += x * lm.MINIBATCH
    assert trained == pytest.approx(Counter(zip(token.tolist(), one.tolist(), two.tolist(), strict=True)))
    assert sum((table.other,) * 3 in cases for cases, _ in steps) > len(steps) // 2


def test_numbering_lets_its_words_go():
    words = [[b"a", b"b"], [b"b"]]
    lm._number(words)
    gc.collect()
    gc.disable()
    try:
        at, hashes, lengths = lm._number(words)
        assert gc.collect() == 0
    finally:
        gc.enable()
    assert at.tolist() == [0, 1, 1] and len(hashes) == 2 and lengths.tolist() == [2, 1]


@pytest.mark.parametrize("top", [1, 1000, 1 << 62])
def test_distinct_keys_are_those_of_numpy(top):
    rng = np.random.default_rng(top % 97)
    for n in (0, 1, 500):
        keys = rng.integers(0, top, n)
        want = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(lm._distinct(keys), want, strict=True))
        assert (lm._order(keys) == np.argsort(keys, kind="stable")).all()
