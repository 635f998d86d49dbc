"""Language-model scoring: a log-bilinear model trained in numpy with noise-contrastive estimation.

Counting.  Every training text is counted: one row per distinct word, by the
64-bit hash of its bytes, with its count; the commonest words are told apart by it.

Model.  The commonest words that together make up ``cover`` of the training tokens have
ids of their own, so the vocabulary grows with the corpus; all others share one id.
From the vectors of the two tokens before, the log-bilinear model
predicts a vector C1 r(w-1) + C2 r(w-2).  Ids fall into classes of about the square
root of their number, by falling count: the score of a class is the vector's product
with the class's vector plus its bias, the score of an id within its class likewise.
Both are normalised exactly, so a token costs two sums of that root's length.  A shared id's
probability is dealt to its words by their smoothed counts, so that all words, seen and
unseen, sum to one.

Training.  Each task goes once over all tokens of its texts: equal (context,
token) cases of a chunk are merged, heavy ones split again, and all are dealt in random order into
minibatches of equally many tokens, so every token occurrence has the same weight.  Noise classes are
drawn from the classes' unigram distribution and shared by the minibatch; noise ids are drawn
per case within its class.  Only touched rows are updated.
All tasks start from the same parameters; the changes are
averaged by token counts on the executors, and the next round starts from the average.
So a score depends on how the input is cut into tasks, within what averaging leaves of it.

The table of the commonest words and the averaged changes are files in the shared folder, which each
Python worker reads once; the driver sees totals and a histogram of counts.  ``MOST_IDS`` bounds what a worker
holds; words beyond it are counted like all others and share the one id.

Scoring.  Common words are looked up in that table.  The other words of a text are joined to the full counts; as the
commonest are not among them, no key of that join is hot.
"""

from __future__ import annotations

import math
import sys
import types
from collections import OrderedDict, defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.dataset as pads
import xxhash
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import text_bytes
from bourse.session import scratch_path

COVER = 0.75  # share of the training tokens whose words have ids of their own
COMMON_WORDS = 1 << 17  # looked up without a join
MOST_IDS = 1 << 20  # words with ids of their own, at most: 100 MB of parameters a worker
WIDTH = 16
ROUNDS = 1
NOISE = 32  # noise classes of a minibatch
NOISE_WITHIN = 1  # noise ids of a case within its class
MINIBATCH = 8192  # tokens
HEAVIEST = MINIBATCH // 16  # a merged case stands for at most so many tokens
RATE = 0.02
SMOOTH = 0.1
WORDS_AT_ONCE = 1 << 19


def held_out(row_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text is 0 modulo 10."""
    return F.coalesce(F.crc32(row_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def _chunks(texts: list[bytes]):
    """Texts in order, so many at once that their words stay few: first index, word lists (of lower-cased A-Z)."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        w = t.lower().split()
        if held and size + len(w) > WORDS_AT_ONCE:
            yield first, held
            first, held, size = i, [], 0
        held.append(w)
        size += len(w)
    if held:
        yield first, held


def _number(words: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per word its number among the different words, those words' hashes, and the texts' lengths."""
    number: defaultdict = defaultdict(count().__next__)  # its own length as the source would keep it alive
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    at = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, int(lengths.sum()))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number)).view(np.int64)
    return at, hashes, lengths


def _order(keys: np.ndarray) -> np.ndarray:
    """The stable order of numbers from 0 on.  Key and place in one number sort far faster than places by key."""
    bits = max(1, len(keys) - 1).bit_length()
    if not len(keys) or int(keys.max()).bit_length() + bits > 63:
        return np.argsort(keys, kind="stable")
    both = (keys.astype(np.int64) << bits) | np.arange(len(keys))
    both.sort()
    return both & ((1 << bits) - 1)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``np.unique``: the different keys, where each is first, the number of each key's, and their counts."""
    order = _order(keys)
    sorted_keys = keys[order]
    fresh = np.r_[True, sorted_keys[1:] != sorted_keys[:-1]][: len(keys)]
    starts = np.flatnonzero(fresh)
    number = np.empty(len(keys), dtype=np.int64)
    number[order] = np.cumsum(fresh) - 1
    return sorted_keys[starts], order[starts], number, np.diff(np.r_[starts, len(keys)])


# --- counts --------------------------------------------------------------------------------------


def word_counts(rows: DataFrame) -> DataFrame:
    """``h, c``: the count of every different word in ``rows`` (column t), by hash."""

    def run(batches):
        for b in batches:
            for _, words in _chunks(text_bytes(b, "t")):
                at, hashes, _ = _number(words)
                c = np.bincount(at, minlength=len(hashes))
                yield pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(c)], ["h", "c"])

    return rows.select("t").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


def least_common(counts: DataFrame, most: int, cover: float = 0.0) -> tuple[int, int]:
    """A count that at most ``most`` words reach, or so many as make up ``cover`` of all tokens if that are more; and
    the number of words that make up ``cover``: found on a histogram of eight steps per doubling, not by sorting."""
    steps = counts.groupBy(F.floor(F.log2("c") * 8).alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.min("c").alias("c"), F.sum("c").alias("tokens")
    )
    steps = sorted(steps.collect(), key=lambda r: -r["step"])  # a few hundred rows
    want = cover * sum(r["tokens"] for r in steps)
    least, words, tokens, covering = (1 << 63) - 1, 0, 0, 0
    for r in steps:
        short = tokens < want
        words, tokens = words + r["n"], tokens + r["tokens"]
        if short:
            covering = words
        elif words > most:
            break
        least = r["c"]
    return least, covering


class Table:
    """The commonest words, sorted by hash, and the totals of the training texts."""

    def __init__(self, h: np.ndarray, c: np.ndarray, texts: int, tokens: int, kinds: int, vocabulary: int):
        order = np.argsort(h)
        self.h, self.c = h[order], c[order]
        self.texts, self.tokens, self.kinds = texts, tokens, kinds
        # ids: words by falling count, then the end, then all others, then the start (a context only)
        rank = np.lexsort((self.h, -self.c))[:vocabulary]
        self.id = np.full(len(h), len(rank) + 1, dtype=np.int64)
        self.id[rank] = np.arange(len(rank))
        self.end, self.other, self.start = len(rank), len(rank) + 1, len(rank) + 2
        own = np.r_[self.c[rank], texts].astype(np.float64)
        self.other_tokens = tokens - own.sum()
        self.other_kinds = max(0, kinds - len(rank) - (1 if texts else 0))
        self.unigram = np.r_[own, self.other_tokens] + SMOOTH
        self.unigram /= self.unigram.sum()

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each word is in the table, its count and its id."""
        if not len(self.h):
            return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64), np.full(len(hashes), self.other)
        at = np.minimum(np.searchsorted(self.h, hashes), len(self.h) - 1)
        there = self.h[at] == hashes
        return there, np.where(there, self.c[at], 0), np.where(there, self.id[at], self.other)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + SMOOTH) / (self.tokens + SMOOTH * (self.kinds + 1)))

    def within_other(self, c: np.ndarray) -> np.ndarray:
        """Log10 share of a word without an id in the shared id's probability."""
        return np.log10((c + SMOOTH) / (self.other_tokens + SMOOTH * (self.other_kinds + 1)))


def sequences(table: Table, at: np.ndarray, hashes: np.ndarray, lengths: np.ndarray):
    """Ids of all tokens of the texts (ends included) and of the two before each; the texts' token starts."""
    ids = table.look_up(hashes)[2]
    n = int(lengths.sum()) + len(lengths)
    ends = np.cumsum(lengths + 1) - 1
    tokens = np.empty(n, dtype=np.int64)
    is_end = np.zeros(n, dtype=bool)
    is_end[ends] = True
    tokens[is_end], tokens[~is_end] = table.end, ids[at]
    place = np.arange(n) - np.repeat(ends - lengths, lengths + 1)
    one = np.where(place >= 1, np.r_[table.start, tokens[:-1]], table.start)
    two = np.where(place >= 2, np.r_[[table.start] * 2, tokens[:-2]][:n], table.start)
    return tokens, one, two, ends - lengths


# --- the model -----------------------------------------------------------------------------------


def classes(n: int) -> np.ndarray:
    """First ids of the classes of ``n`` ids, and ``n``: words in runs by falling count; the end and the shared id alone."""
    size = max(1, math.isqrt(max(0, n - 2)))
    return np.r_[np.arange(0, n - 2, size), n - 2, n - 1, n]


class LogBilinear:
    """Vectors ``r`` of the ids and the start, context matrices ``c1`` and ``c2``, biases ``b`` of the ids within their
    classes, vectors ``q`` and biases ``a`` of the classes."""

    def __init__(self, r, c1, c2, b, q, a):
        self.r, self.c1, self.c2, self.b, self.q, self.a = r, c1, c2, b, q, a
        self.bounds = classes(len(b))
        self.of_class = np.repeat(np.arange(len(a)), np.diff(self.bounds))

    @classmethod
    def first(cls, table: Table, width: int = WIDTH):
        rng = np.random.default_rng(0)
        n = len(table.unigram)
        near = np.eye(width) * 0.5 + rng.normal(0, 0.05, (width, width))
        far = np.eye(width) * 0.25 + rng.normal(0, 0.05, (width, width))
        bounds = classes(n)
        mass = np.add.reduceat(table.unigram, bounds[:-1])
        parts = (
            rng.normal(0, 0.1, (n + 1, width)), near, far, np.log(table.unigram / np.repeat(mass, np.diff(bounds))),
            rng.normal(0, 0.1, (len(mass), width)), np.log(mass),
        )
        return cls(*(p.astype(np.float32) for p in parts))

    def flat(self) -> np.ndarray:
        """All numbers as one table: rows of ids, the start, classes and matrices, each with its bias or 0 behind it."""
        zero = np.zeros(1 + 2 * len(self.c1), np.float32)
        bias = np.concatenate([self.b, zero[:1], self.a, zero[1:]])
        return np.c_[np.concatenate([self.r, self.q, self.c1, self.c2]), bias]

    @classmethod
    def of(cls, flat: np.ndarray, n: int, width: int):
        cuts = np.cumsum([n + 1, len(classes(n)) - 1, width])
        r, q, c1, c2 = (np.ascontiguousarray(p) for p in np.split(flat[:, :-1].astype(np.float32), cuts))
        bias = flat[:, -1].astype(np.float32)
        return cls(r, c1, c2, bias[:n].copy(), q, bias[n + 1 : cuts[1]].copy())

    def log10(self, token: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities of ids after their contexts: of the class, then of the id within it."""
        n = len(self.b)
        pair, _, at, _ = _distinct(one * (n + 1) + two)
        case, _, back, _ = _distinct(at * n + token)  # equal cases have equal scores
        at, token = np.divmod(case, n)
        near, far = self.r @ self.c1, self.r @ self.c2
        ctx = near[pair // (n + 1)] + far[pair % (n + 1)]
        norm = np.empty(len(pair), dtype=np.float64)
        for low in range(0, len(pair), 4096):
            s = ctx[low : low + 4096] @ self.q.T
            s += self.a
            norm[low : low + 4096] = _log_sum(s)
        kind = self.of_class[token]
        score = np.empty(len(token), dtype=np.float64)
        for low in range(0, len(token), 1 << 17):
            part = slice(low, low + (1 << 17))
            score[part] = np.einsum("ij,ij->i", ctx.take(at[part], axis=0), self.q.take(kind[part], axis=0)) + self.a[kind[part]] - norm[at[part]]
        order = _order(kind)
        cuts = np.searchsorted(kind[order], np.arange(len(self.a) + 1))
        for k, (low, high) in enumerate(zip(self.bounds[:-1], self.bounds[1:], strict=True)):
            if high - low > 1:
                out, bias = self.r[low:high].T.copy(), self.b[low:high]
                for x in range(cuts[k], cuts[k + 1], 4096):
                    rows = order[x : min(x + 4096, cuts[k + 1])]
                    s = ctx.take(at[rows], axis=0) @ out
                    s += bias
                    own = s[np.arange(len(rows)), token[rows] - low].astype(np.float64)
                    score[rows] += own - _log_sum(s)
        return score[back] / np.log(10)


def _log_sum(s: np.ndarray) -> np.ndarray:
    """Log of the sum of exponentials per row; ``s`` is used up."""
    top = s.max(axis=1, keepdims=True)
    s -= top
    np.exp(s, out=s)
    return top[:, 0] + np.log(s.sum(axis=1, dtype=np.float64))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Trainer:
    """Adam over minibatches with noise-contrastive estimation, of the class and of the id within it."""

    def __init__(self, model: LogBilinear, unigram: np.ndarray, seed: int, rate: float):
        self.m, self.rng, self.rate = model, np.random.default_rng(seed), rate
        self.parts = [model.c1, model.c2, model.q, model.a]
        self.mean, self.square = [np.zeros_like(p) for p in self.parts], [np.zeros_like(p) for p in self.parts]
        self.row_mean, self.row_square = (np.zeros((len(model.r), model.r.shape[1] + 1), np.float32) for _ in range(2))
        self.steps = 0
        mass = np.add.reduceat(unigram, model.bounds[:-1])
        self.class_cum, self.cum = np.cumsum(mass), np.cumsum(unigram)
        self.log_class_noise = np.log(mass * NOISE).astype(np.float32)
        self.log_noise = np.log(unigram / mass[model.of_class] * NOISE_WITHIN).astype(np.float32)
        self.below, self.mass = np.r_[0.0, self.cum][model.bounds[:-1]], mass

    def cases(self, token: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        """Train on all given tokens, each with the same weight; equal cases are merged, but no further than ``HEAVIEST``."""
        n = len(self.m.b) + 1
        _, _, where, _ = _distinct(one * n + two)
        # (pair, token) numbered by pair first: three ids of a large vocabulary would not fit 63 bits
        case, first, _, count = _distinct(where * n + token)
        pieces = -(-count // HEAVIEST)
        piece = np.repeat(np.arange(len(case)), pieces)
        nth = np.arange(len(piece)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        size = np.minimum(HEAVIEST, count[piece] - nth * HEAVIEST)
        order = self.rng.permutation(len(piece))
        at, size = first[piece[order]], size[order]
        batch = (np.cumsum(size) - 1) // MINIBATCH
        cuts = np.searchsorted(batch, np.arange(batch[-1] + 2 if len(batch) else 1))
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            k = at[low:high]
            self.step(token[k], one[k], two[k], size[low:high].astype(np.float32) / MINIBATCH)

    def step(self, token, one, two, weight) -> None:
        m = self.m
        r1, r2 = m.r.take(one, axis=0), m.r.take(two, axis=0)
        ctx = r1 @ m.c1 + r2 @ m.c2
        # the class
        kind = m.of_class[token]
        noise = np.minimum(np.searchsorted(self.class_cum, self.rng.random(NOISE)), len(m.a) - 1)
        q, q_noise = m.q.take(kind, axis=0), m.q[noise]
        d = -weight * _sigmoid(self.log_class_noise[kind] - np.einsum("ij,ij->i", ctx, q) - m.a[kind])  # derivative by the data score
        e = weight[:, None] * _sigmoid(ctx @ q_noise.T + (m.a[noise] - self.log_class_noise[noise]))
        d_ctx = d[:, None] * q + e @ q_noise
        g_q, g_a = np.zeros_like(m.q), np.bincount(kind, d, len(m.a)) + np.bincount(noise, e.sum(axis=0), len(m.a))
        np.add.at(g_q, noise, e.T @ ctx)
        own = d[:, None] * ctx
        for j in range(g_q.shape[1]):
            g_q[:, j] += np.bincount(kind, own[:, j], len(g_q))
        # the id within its class
        low, high = m.bounds[kind][:, None], m.bounds[kind + 1][:, None]
        drawn = self.below[kind][:, None] + self.rng.random((len(token), NOISE_WITHIN)) * self.mass[kind][:, None]
        other = np.clip(np.searchsorted(self.cum, drawn, side="right"), low, high - 1)
        several = (high - low > 1)[:, 0]
        r, r_other = m.r.take(token, axis=0), m.r.take(other, axis=0)
        d = -weight * several * _sigmoid(self.log_noise[token] - np.einsum("ij,ij->i", ctx, r) - m.b[token])
        e = (weight * several)[:, None] * _sigmoid(np.einsum("ikj,ij->ik", r_other, ctx) + m.b[other] - self.log_noise[other])
        d_ctx += d[:, None] * r + np.einsum("ik,ikj->ij", e, r_other)
        width = ctx.shape[1]
        ids = np.concatenate([token, other.ravel(), one, two])
        g = np.zeros((len(ids), width + 1), np.float32)
        t, o = len(token), len(token) * (1 + NOISE_WITHIN)
        g[:t, :width], g[:t, width] = d[:, None] * ctx, d
        g[t:o, :width], g[t:o, width] = (e[:, :, None] * ctx[:, None, :]).reshape(-1, width), e.ravel()
        g[o : o + t, :width], g[o + t :, :width] = d_ctx @ m.c1.T, d_ctx @ m.c2.T
        order = _order(ids)
        ids = ids[order]
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        ids, g = ids[starts], np.add.reduceat(g.take(order, axis=0), starts, axis=0)
        self.steps += 1
        a, s = self.row_mean.take(ids, axis=0), self.row_square.take(ids, axis=0)
        step = self._adam(a, s, g)
        self.row_mean[ids], self.row_square[ids] = a, s
        m.r[ids] -= step[:, :width]
        with_bias = ids < len(m.b)  # the start has none
        m.b[ids[with_bias]] -= step[with_bias, width]
        for p, g, a, s in zip(self.parts, (r1.T @ d_ctx, r2.T @ d_ctx, g_q, g_a), self.mean, self.square, strict=True):
            p -= self._adam(a, s, g)

    def _adam(self, a: np.ndarray, s: np.ndarray, g: np.ndarray) -> np.ndarray:
        """The step along ``g``; running mean ``a`` and mean square ``s`` are brought up to date."""
        a += 0.1 * (g - a)
        s += 0.01 * (g * g - s)
        return (self.rate * (a / (1 - 0.9**self.steps)) / (np.sqrt(s / (1 - 0.99**self.steps)) + 1e-6)).astype(np.float32)


# --- what the workers read -----------------------------------------------------------------------


def _read(path: str, columns: list[str]) -> pa.Table:
    system, place = fs.FileSystem.from_uri(path)
    return pads.dataset(place, filesystem=system, format="parquet").to_table(columns=columns)


class Shared:
    """What a Python worker needs and reads once: the table of common words and the model, from their folders."""

    def __init__(self, words: str, totals: tuple[int, int, int, int], width: int):
        self.words, self.totals, self.width = words, totals, width
        self.rounds: tuple[str, ...] = ()

    def _kept(self, key, make):
        held = sys.modules.setdefault("_lm_kept", types.ModuleType("_lm_kept")).__dict__.setdefault("kept", OrderedDict())
        if key not in held:
            held[key] = make()
            if len(held) > 3:
                held.popitem(last=False)
        return held[key]

    def table(self) -> Table:
        def make():
            rows = _read(self.words, ["h", "c"])
            return Table(rows.column("h").to_numpy(), rows.column("c").to_numpy(), *self.totals)

        return self._kept(self.words, make)

    def model(self) -> LogBilinear:
        """The first parameters and, for each round, the changes of all tasks, averaged by their tokens."""

        def make():
            table, names = self.table(), [f"x{j}" for j in range(self.width + 1)]
            flat = LogBilinear.first(table, self.width).flat().astype(np.float64)
            for path in self.rounds:
                rows = _read(path, ["i", *names])
                at = rows.column("i").to_numpy()
                tokens = rows.column("x0").to_numpy()[at < 0].sum()
                mine = at >= 0
                for j, x in enumerate(names):
                    flat[at[mine], j] += rows.column(x).to_numpy()[mine] / tokens
            return LogBilinear.of(flat, len(table.unigram), self.width)

        return self._kept((self.words, self.rounds), make)


def train(rows: DataFrame, shared: Shared, rounds: int = ROUNDS, rate: float = RATE) -> None:
    """``rounds`` passes over all of ``rows`` (column t); the tasks' changes, averaged after each, go into ``shared``."""
    width = shared.width
    names = [f"x{j}" for j in range(width + 1)]
    for turn in range(rounds):
        turn_rate = rate / (1 + turn)

        def run(batches, shared=shared, turn_rate=turn_rate, turn=turn):
            trainer, seen = None, 0
            for b in batches:
                for _, words in _chunks(text_bytes(b, "t")):
                    table = shared.table()
                    if trainer is None:
                        start = shared.model().flat()
                        trainer = Trainer(LogBilinear.of(start, len(table.unigram), width), table.unigram, turn, turn_rate)
                    token, one, two, _ = sequences(table, *_number(words))
                    trainer.cases(token, one, two)
                    seen += len(token)
            if seen:
                change = trainer.m.flat() - start
                rows = np.flatnonzero(change.any(axis=1))
                # row -1 holds the task's tokens
                at = pa.array(np.r_[-1, rows].astype(np.int32))
                x = [pa.array(np.r_[seen, change[rows, j].astype(np.float64) * seen].astype(np.float32)) for j in range(width + 1)]
                yield pa.RecordBatch.from_arrays([at, *x], ["i", *names])

        parts = rows.select("t").mapInArrow(run, "i int, " + ", ".join(f"{x} float" for x in names))
        path = scratch_path(rows.sparkSession, "lm-round")
        parts.groupBy("i").agg(*(F.sum(F.col(x).cast("double")).alias(x) for x in names)).write.parquet(path)
        shared.rounds = (*shared.rounds, path)


# --- scores --------------------------------------------------------------------------------------


def score_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: int | None = None,
    common_words: int = COMMON_WORDS,
    width: int = WIDTH,
    rounds: int = ROUNDS,
    cover: float = COVER,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per row of ``docs``.

    ``base_score`` is the smoothed unigram log10 probability, ``score`` the
    model's.  Null and empty texts are an end alone; repeated rows count and
    score each; rows without an id are training rows.  Without training texts
    every token is unseen.  ``vocabulary`` words have ids of their own, or as many
    as make up ``cover`` of the training tokens.  Other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        held_out(F.col(id_col)).alias("held_out"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"),
    )
    training = rows.where("not held_out")
    counts = word_counts(training).checkpoint()
    total = counts.agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).first()
    texts = training.count()
    least, covering = least_common(counts, common_words, cover if vocabulary is None else 0.0)
    vocabulary = min(covering, MOST_IDS) if vocabulary is None else vocabulary
    words = scratch_path(docs.sparkSession, "lm-words")
    counts.where(F.col("c") >= least).coalesce(16).write.parquet(words)  # at most common_words rows, or those with ids
    tokens, kinds = (total["c"] or 0) + texts, total["v"] + bool(texts)
    shared = Shared(words, (texts, tokens, kinds, vocabulary), width)
    if texts:
        train(training, shared, rounds)
    names = ["doc_id", "held_out", "th", "n_tokens", "n_known", "base_score", "score", "h", "tf"]

    def run(batches):
        for b in batches:
            for first, words in _chunks(text_bytes(b, "t")):
                table, model = shared.table(), shared.model()
                at, hashes, lengths = _number(words)
                there, c, _ = table.look_up(hashes)
                token, one, two, starts = sequences(table, at, hashes, lengths)
                text = np.repeat(np.arange(len(lengths)), lengths)

                def summed(values, text=text, lengths=lengths):
                    return np.bincount(text, values, len(lengths))

                known = there[at]
                score = np.add.reduceat(model.log10(token, one, two), starts)
                inside = known & (table.look_up(hashes)[2][at] == table.other)
                score += summed(np.where(inside, table.within_other(c)[at], 0.0))
                base = summed(np.where(known, table.base(c)[at], 0.0)) + table.base(np.array(table.texts))
                n_known = summed(known.astype(np.float64)) + bool(table.texts)
                # the words that are not in the table, per text
                pair, tf = np.unique(text[~known] * len(hashes) + at[~known], return_counts=True)
                cut = np.searchsorted(pair // max(1, len(hashes)), np.arange(len(lengths) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(b.column(x).slice(first, len(lengths)) for x in ("doc_id", "held_out", "th")),
                        pa.array(lengths + 1), pa.array(n_known.astype(np.int64)), pa.array(base), pa.array(score),
                        pa.ListArray.from_arrays(cut, pa.array(hashes[pair % max(1, len(hashes))])),
                        pa.ListArray.from_arrays(cut, pa.array(tf.astype(np.int64))),
                    ],
                    names,
                )

    keyed = rows.withColumn("th", F.xxhash64("t"))
    found = keyed.mapInArrow(
        run,
        "doc_id long, held_out boolean, th long, n_tokens long, n_known long, base_score double, score double, h array<long>, tf array<long>",
    ).checkpoint()
    rare = found.select("doc_id", "held_out", "th", F.explode(F.arrays_zip("h", "tf")).alias("w"))
    rare = rare.select("doc_id", "held_out", "th", F.col("w.h").alias("h"), F.col("w.tf").alias("tf"))
    c = F.coalesce("c", F.lit(0))
    base_all = tokens + SMOOTH * (kinds + 1)
    # what the words with ids leave to the shared one, as in Table
    with_id = docs.sparkSession.read.schema("h long, c long").parquet(words).orderBy(F.desc("c"), "h").limit(vocabulary)
    own = with_id.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("c"), F.lit(0)).alias("c")).first()
    other_all = tokens - own["c"] - texts + SMOOTH * (max(0, kinds - own["n"] - (1 if texts else 0)) + 1)
    added = rare.join(counts, "h", "left").select(
        "doc_id", "held_out", "th", F.lit(0).alias("copies"), F.lit(0).cast("long").alias("n_tokens"),
        F.when(c > 0, F.col("tf")).otherwise(F.lit(0)).alias("n_known"),
        (F.col("tf") * F.log10((c + SMOOTH) / base_all)).alias("base_score"),
        (F.col("tf") * F.log10((c + SMOOTH) / other_all)).alias("score"),
    )
    own = found.select("doc_id", "held_out", "th", F.lit(1).alias("copies"), "n_tokens", "n_known", "base_score", "score")
    sums = own.unionByName(added).groupBy("doc_id", "held_out", "th").agg(
        *(F.sum(x).alias(x) for x in ("copies", "n_tokens", "n_known", "base_score", "score"))
    )
    # rows with equal id and text were summed together: one row for each again
    each = sums.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return each.select(
        "doc_id", "held_out",
        *((F.col(x) / F.col("copies")).cast("long").alias(x) for x in ("n_tokens", "n_known")),
        F.lit(tokens).cast("long").alias("train_tokens"),
        *((F.col(x) / F.col("copies")).alias(x) for x in ("base_score", "score")),
    )
