import numpy as np
import pytest
from pyspark.sql import functions as F

from bourse.llm.embed_dedup import groups_of, near_duplicate_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, min_cosine=0.93):
    """vec_id -> (n_links, component_id, kept) from all pairs; ids must differ."""
    ok = {}
    for i, v, label in rows:
        if label is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        x = np.array(v, np.float32).astype(float)
        ok[i] = (label, x / np.linalg.norm(x))
    near = {i: set() for i, _, _ in rows}
    ids = sorted(ok)
    for a in ids:
        for b in ids:
            if a < b and ok[a][0] == ok[b][0] and len(ok[a][1]) == len(ok[b][1]) and ok[a][1] @ ok[b][1] >= min_cosine:
                near[a].add(b)
                near[b].add(a)
    out = {}
    for i in near:
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(near[i]), min(seen), min(seen) == i)
    return out


def result(df):
    return {r.vec_id: (r.n_links, r.component_id, r.kept) for r in df.collect()}


def planted(seed=1, dim=24, groups=((1, 40), (2, 12), (30, 3)), lone=300):
    """Groups of near copies, exact copies in some of them, and vectors near nothing; two labels."""
    rnd = np.random.default_rng(seed)
    rows = []
    for many, size in groups:
        for _ in range(many):
            base = rnd.standard_normal(dim)
            for c in range(size):
                v = base if c % 5 == 4 else base + 0.17 * rnd.standard_normal(dim)
                rows.append((v, int(rnd.integers(0, 2)) if c == 1 else 0))
    rows += [(rnd.standard_normal(dim), int(rnd.integers(0, 2))) for _ in range(lone)]
    order = rnd.permutation(len(rows))
    return [(int(n), [float(np.float32(x)) for x in rows[k][0]], rows[k][1]) for n, k in enumerate(order)]


def test_equals_all_pairs(spark):
    rows = planted()
    got = near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA))
    assert result(got) == brute(rows)


def test_small_windows_and_member_blocks_lose_nothing(spark):
    # a window of 3 and blocks of 8 force the exact way for the rest, across block borders
    rows = planted(seed=5, groups=((1, 90), (5, 10)), lone=60)
    got = near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA), window=3, block=8, members_per_block=8, passes=12)
    assert result(got) == brute(rows)


def test_what_cannot_link(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1),
        (7, [1.0, 2.0], None), (8, [1.0, 2.0], None), (9, [1.0, 2.0], 1), (10, [2.0, 4.0], 1), (11, [1.0, 2.0], 2),
        (12, [1.0, 2.0, 0.0], 1), (13, [1e-30, 2e-30], 1), (14, [-0.0, 0.0], 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(-1) for c in ("cls", "n", "c1", "rank", "block", "_pid")})
    got = result(near_duplicate_vectors(df))
    assert got == brute(rows)
    assert got[9] == (2, 9, True) and got[13] == (2, 9, False) and got[11] == (0, 11, True)


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (None, [1.0, 0.01], 1), (None, [0.0, 1.0], 1), (None, None, None)]
    got = near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got) == [
        ("5", 2, "5", True), ("5", 2, "5", True),
        ("None", 0, "None", True), ("None", 0, "None", True), ("None", 2, "5", False),
    ]
    assert near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hot_copies_count_all(spark):
    rows = [(i, [1.0, 0.5, 0.25], 1) for i in range(400)] + [(1000, [1.0, 0.5, 0.2501], 1)]
    got = result(near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)))
    assert set(got.values()) == {(400, 0, True), (400, 0, False)}


@pytest.mark.parametrize("seed", range(5))
def test_groups_of_links(seed):
    rnd = np.random.default_rng(seed)
    a, b = rnd.integers(0, 60, 50), rnd.integers(0, 60, 50)
    want = np.arange(60)
    for _ in range(60):
        for x, y in zip(a, b):
            want[x] = want[y] = min(want[x], want[y])
    assert (groups_of(60, a, b) == want).all()
