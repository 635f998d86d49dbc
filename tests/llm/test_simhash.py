import random

import numpy as np
from pyspark.sql import functions as F

from bourse.llm import simhash
from bourse.llm.components import components
from tests.llm.conftest import sentence


def test_fingerprint_equals_its_definition(spark):
    for text in ["", "one", "one two", "a b c d", "A B c d e f", sentence(1, 50), "é è  ê\tx " * 5]:
        words = text.encode().lower().split()
        shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        rows = spark.createDataFrame([(s.decode(),) for s in shingles], "s string").select(F.xxhash64("s")).collect()
        hashes = [r[0] % 2**64 for r in rows]
        want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert simhash.fingerprint(text.encode(), 4) == want


def test_codes_cover_and_meet():
    rng = np.random.default_rng(3)
    for blocks in (2, 3, 5):
        x = rng.integers(0, 2**63, 200, dtype=np.uint64)
        for n in range(5):
            flips = [rng.choice(64, n, replace=False) for _ in x]
            y = x ^ np.array([sum(1 << int(b) for b in f) for f in flips], dtype=np.uint64)
            met = np.zeros(len(x), bool)
            for code in simhash.block_codes(4, blocks):
                i, a, home = code.visits(x)
                assert np.bincount(i[home], minlength=len(x)).tolist() == [1] * len(x)
                homes = dict(zip(i[home].tolist(), a[home].tolist(), strict=True))
                j, b, _ = code.visits(y)
                for k, anchor in zip(j.tolist(), b.tolist(), strict=True):
                    met[k] |= homes[k] == anchor
            assert met.all()


def _near(spark, fps, **how):
    df = spark.createDataFrame([(int(np.int64(np.uint64(f))),) for f in fps], "fp long")
    found = components(simhash.near_links(df, 4, **how), "a", "b")
    return {r.node % 2**64: r.label % 2**64 for r in found.collect()}


def test_components_equal_brute_force_also_in_hot_anchors(spark, monkeypatch):
    rnd = random.Random(7)
    fps = {rnd.getrandbits(64) for _ in range(150)}
    for centre in list(fps)[:6]:  # clouds and chains
        at = centre
        for _ in range(40):
            at ^= 1 << rnd.randrange(64) | 1 << rnd.randrange(64)
            fps.add(at)
            fps.add(centre ^ (1 << rnd.randrange(64)))
    fps = sorted(fps)
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    groups = {}
    for f in fps:
        groups.setdefault(root(f), set()).add(f)
    want = {frozenset(g) for g in groups.values() if len(g) > 1}
    for slices, blocks, held in ((2048, 3, 1 << 17), (4, 3, 8), (2048, 2, 1 << 17)):
        monkeypatch.setattr(simhash, "HOMES_PER_SLICE", slices)
        monkeypatch.setattr(simhash, "ROWS_HELD", held)
        got = {}
        for f, label in _near(spark, fps, blocks=blocks).items():
            got.setdefault(label, set()).add(f)
        assert {frozenset(g) for g in got.values()} == want


def test_documents_and_edges(spark, make_docs):
    a = sentence(1, 400)
    pairs = [(5, a), (3, a), (9, a.upper()), (4, sentence(2, 300)), (7, None), (8, ""), (None, a), (2, sentence(3, 3)), (3, a), (None, " ")]
    docs = make_docs(pairs)
    rows = simhash.simhash_components(docs).collect()
    assert len(rows) == len(pairs)
    comp = {}
    for r in rows:
        comp.setdefault(r.doc_id, set()).add((r.component_id, r.fingerprint == "0" * 16))
    assert comp[5] == comp[3] == comp[9] == {(3, False)} and comp[4] == {(4, False)}
    assert comp[7] == comp[8] == {(7, True)} and comp[None] == {(3, False), (7, True)}
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 7]
    none = make_docs([(None, a), (None, a), (None, sentence(5, 50))])
    assert simhash.one_per_group(none).count() == 2
    assert {r.component_id for r in simhash.simhash_components(none).collect()} == {None}
    assert simhash.simhash_components(docs.where("false")).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100)] + [(200, 200 + i) for i in range(1, 60)] + [(300, 300), (301, 302), (302, 301)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    want = {i: 0 for i in range(101)} | {200 + i: 200 for i in range(60)} | {301: 301, 302: 301}
    assert got == want
