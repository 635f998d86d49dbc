"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are positives; a draw from all texts, whatever their
label, is the unlabelled text that holds a share ``prior`` of positives.  A linear
classifier over word features minimises the class-prior-corrected risk

    prior * E_P[l(g)] + max(0, E_U[l(-g)] - prior * E_P[l(-g)])

with the logistic loss l; the second term estimates the risk on negatives and
is kept from going negative (when it does, the step lowers its size instead).
Features are the distinct words of a text, their beginnings of 3 to 6 letters,
so unseen forms of a known root are recognised, and the beginnings that several
different words share: a clean text may hold one word that begins like a slur,
seldom several.

The classifier is fitted in numpy on a sample of at most ``max_positive`` and
``max_unlabelled`` texts; every whole text is scored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import broadcast_if_small

MAX_POSITIVE = 2000  # bounds of the fitting sample, in texts
MAX_UNLABELLED = 6000
MAX_FEATURES = 2048
LEAST_POSITIVE = 3  # positives that must have a feature
STEPS = 600
CACHED_WORDS = 400_000
WORD = re.compile(r"[^\W\d_]{2,}")


def word_features(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in range(3, 7) if len(word) >= n)]


def features(text: str) -> set[str]:
    """The distinct features of a whole text."""
    own: set[str] = set()
    for w in set(WORD.findall(text.lower())):
        add_word(own, word_features(w))
    return own


def add_word(own: set[str], found) -> None:
    """Add a further word's features to a text's; one that is there already also stands for several words."""
    for f in found:
        own.add(f + "*" if f in own else f)


def near_key(own: set[str]) -> str:
    """Three minima of feature hashes: near copies mostly share it, different texts hardly ever."""
    return " ".join(str(min((xxhash.xxh64_intdigest(f, seed) for f in own), default=0)) for seed in range(3))


def select_features(positive: list[set[str]], unlabelled: list[set[str]], prior: float, most: int) -> list[str]:
    """Features that, by the class prior, point at positives in most texts that have them."""
    n_p, n_u = max(1, len(positive)), max(1, len(unlabelled))
    in_p = Counter(f for s in positive for f in s)
    in_p = {f: n for f, n in in_p.items() if n >= LEAST_POSITIVE}
    in_u = Counter(f for s in unlabelled for f in s if f in in_p)
    gain = {}
    for f, n in in_p.items():
        p, u = n / n_p, (in_u[f] + 0.5) / n_u
        spread = np.sqrt(u * (1 - min(u, 1.0)) / n_p + p * (1 - p) / n_p) + 1e-9
        if prior * p > 0.6 * u and (p - u) / spread > 3:
            gain[f] = n * np.log(p / u)
    return sorted(gain, key=lambda f: (-gain[f], f))[:most]


def fit_nnpu(x_p: np.ndarray, x_u: np.ndarray, prior: float, steps: int = STEPS, rate: float = 0.1, l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear classifier that minimises the non-negative risk (Adam, whole batches)."""
    prior = min(max(prior, 1e-4), 0.999)
    w = np.zeros(x_p.shape[1] + 1)
    w[-1] = np.log(prior / (1 - prior))
    if not len(x_p) or not len(x_u):
        return w[:-1], float(w[-1])
    m, v = np.zeros_like(w), np.zeros_like(w)

    def sigmoid(z):
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    for step in range(1, steps + 1):
        s_p, s_u = sigmoid(x_p @ w[:-1] + w[-1]), sigmoid(x_u @ w[:-1] + w[-1])
        negative = -np.log1p(-s_u + 1e-12).mean() + prior * np.log1p(-s_p + 1e-12).mean()
        # derivatives by the scores of: prior * E_P[l(g)], and of the risk on negatives
        d_pos, d_u, d_p = prior * (s_p - 1) / len(s_p), s_u / len(s_u), -prior * s_p / len(s_p)
        a, b = (d_pos + d_p, d_u) if negative >= 0 else (-d_p, -d_u)
        grad = np.r_[x_p.T @ a + x_u.T @ b, a.sum() + b.sum()]
        grad[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


class Model:
    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias

    def scorer(self):
        """A function from a text to its score; words are looked up once per task."""
        weights, bias, known = self.weights, self.bias, {}

        def score(text: str) -> float:
            hit: set[str] = set()
            for w in set(WORD.findall(text.lower())):
                found = known.get(w)
                if found is None:
                    if len(known) >= CACHED_WORDS:
                        known.clear()
                    found = known[w] = tuple(f for f in word_features(w) if f in weights or f + "*" in weights)
                if found:
                    add_word(hit, found)
            z = bias + sum(weights.get(f, 0.0) for f in sorted(hit))
            return float(1 / (1 + np.exp(-min(max(z, -40), 40))))

        return score


def _matrix(sets: list[set[str]], names: list[str]) -> np.ndarray:
    at = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(sets), len(names)), dtype=np.float32)
    for row, s in enumerate(sets):
        x[row, [at[f] for f in s if f in at]] = 1
    return x


def held_out(row_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text is 2 modulo 4."""
    return F.coalesce(F.crc32(row_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def draw_some(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` rows, those with the smallest hashes of their id (column i)."""
    draw = F.xxhash64("i")
    # hashes are even: about twice as many as asked for lie below the bound, so few go to the sort
    share = min(1.0, (2 * most + 100) / max(1, rows.count()))
    near = rows if share == 1 else rows.where(draw < F.lit(int(share * 2**64) - 2**63))
    return near.orderBy(draw, "i").limit(most)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    prior: float | None = None,
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
    max_features: int = MAX_FEATURES,
) -> Model:
    """Fit on rows that are not held out.  ``prior`` defaults to the share of positives among their labels.

    A row with several labels is positive if one of them is 1; null labels and
    ids, and labels without a text, are left out.  Copies and near copies in the
    sample count once, as they would pass for separate evidence.
    Without positives every text scores the prior's floor.
    """
    marks = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y"))
    marks = marks.where(~held_out(F.col("i")) & F.col("y").isNotNull() & F.col("i").isNotNull()).groupBy("i").agg(F.max("y").alias("y"))
    if prior is None:
        prior = marks.agg(F.avg("y").alias("p")).first()["p"] or 0.0
    ids = docs.select(F.col(id_col).alias("i")).where(~held_out(F.col("i")) & F.col("i").isNotNull()).distinct()
    marked = ids.join(marks, "i", "left").select("i", F.coalesce(F.col("y") == 1, F.lit(False)).alias("positive"))
    marked = marked.checkpoint()
    everything = marked.withColumn("positive", F.lit(False))
    some = draw_some(marked.where("positive"), max_positive).unionByName(draw_some(everything, max_unlabelled))
    sample = broadcast_if_small(some.checkpoint(), max_positive + max_unlabelled)
    texts = docs.select(F.col(id_col).alias("i"), F.col(text_col).cast("string").alias("t")).join(sample, "i").select("i", "t", "positive")

    def run(batches):
        for b in batches:
            own = [features(t or "") for t in b.column("t").to_pylist()]
            texts = pa.array(["\x00".join(sorted(s)) for s in own], pa.string())
            keys = pa.array([near_key(s) for s in own], pa.string())
            yield pa.RecordBatch.from_arrays([b.column("i"), b.column("positive"), texts, keys], ["i", "positive", "f", "near"])

    kind = dict(texts.dtypes)["i"]
    seen, held = set(), []
    for r in sorted(texts.mapInArrow(run, f"i {kind}, positive boolean, f string, near string").collect(), key=lambda r: (r["i"], r["f"])):
        if (r["positive"], r["near"]) not in seen:
            seen.add((r["positive"], r["near"]))
            held.append((r["positive"], r["f"]))
    # only features that could be selected are kept apart per text, each as one string
    often = Counter(f for positive, own in held if positive for f in own.split("\x00") if f)
    known = {f: f for f, n in often.items() if n >= LEAST_POSITIVE}
    sets: dict[bool, list[set[str]]] = {True: [], False: []}
    for positive, own in held:
        sets[positive].append({known[f] for f in own.split("\x00") if f in known})
    names = select_features(sets[True], sets[False], prior, max_features)
    w, b = fit_nnpu(_matrix(sets[True], names), _matrix(sets[False], names), prior)
    return Model(dict(zip(names, w.tolist(), strict=True)), b)


def score_toxicity(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row, from the whole text alone.

    Null and empty texts score like a text without known words; repeated rows
    score alike; rows without an id count as not held out.
    """

    def run(batches):
        score = model.scorer()
        for b in batches:
            s = np.array([score(t or "") for t in b.column("t").to_pylist()], dtype=np.float64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("t")
    )
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
