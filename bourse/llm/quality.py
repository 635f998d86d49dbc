"""Quality rules on repetition, from suffix arrays over each text's words.

A whole text is a sequence of words.  Its repeated substrings are found with a
suffix array built by prefix doubling: ranks of word runs of length 1, 2, 4,
8, ... are refined until every remaining run is unique.  Neighbours in
the suffix order share their longest common prefix; the LCP intervals give the
maximal repeated substrings, and the longest LCP of a suffix with either
neighbour is the longest repeat starting there.  The union of these spans is
the part of the text that occurs more than once.

One suffix array covers many texts at once: ranks start from (text, word), so
runs of different texts, or over the end of a text, never fall together.
Positions whose run is already unique are left out of later rounds, so ordinary
prose costs little more than one sort of its words.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bourse.llm.common import text_bytes

# Texts whose words are sorted together; a longer text is sorted alone.
WORDS_PER_SORT = 1 << 17
SYMBOLS = b"#*$%&|<>"


def _runs(ids: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
    """Ranks of the word runs that start at each position: entry j is for runs of 2**j words.

    Equal runs have equal ranks, and ranks follow one order of all suffixes
    that gets finer with j: a rank is the number of smaller runs.  Only runs
    that still occur twice are sorted again.  Stops when every run is unique.
    """
    n = len(ids)
    key = doc.astype(np.int64) * (int(ids.max()) + 1) + ids
    rank, levels, active, h = np.zeros(n, dtype=np.int64), [], np.arange(n), 0
    while len(active):
        if h:
            after = active + h
            behind = np.where(after < n, rank[np.minimum(after, n - 1)], -1)
            key = rank[active] * (n + 1) + behind + 1
        order = np.argsort(key, kind="stable")
        old, key = rank[active][order], key[order]
        place = np.arange(len(order))
        fresh = np.r_[True, key[1:] != key[:-1]]
        first = np.maximum.accumulate(np.where(fresh, place, 0))  # of the equal runs
        group = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], place, 0))  # of those equal so far
        rank = rank.copy()
        rank[active[order]] = old + first - group
        levels.append(rank)
        alone = fresh & np.r_[fresh[1:], True]
        active = np.sort(active[order[~alone]])
        h = 2 * h or 1
    return levels


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the suffixes at ``a`` and ``b`` have in common from their start."""
    n = len(levels[0])
    length = np.zeros(len(a), dtype=np.int64)
    for j in range(len(levels) - 1, -1, -1):
        pa_, pb = a + length, b + length
        inside = (pa_ < n) & (pb < n)
        same = inside & (levels[j][np.minimum(pa_, n - 1)] == levels[j][np.minimum(pb, n - 1)])
        length += same * (1 << j)
    return length


def _covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lengths, -1)
    return np.cumsum(edge[:-1]) > 0


def repeats(ids: np.ndarray, doc: np.ndarray, n_docs: int, min_words: int, window: int):
    """Per text: words in repeated ``window``-word runs, words in repeats of ``min_words`` or more, longest repeat.

    ``ids`` are the words of the texts one after the other, ``doc`` the text of each word.
    """
    zero = np.zeros(n_docs, dtype=np.int64)
    if not len(ids):
        return zero, zero, zero
    levels = _runs(ids, doc)
    least = min(min_words, window)
    j = least.bit_length() - 1
    if j >= len(levels):
        return zero, zero, zero
    size = np.bincount(levels[j], minlength=len(ids))
    again = np.flatnonzero(size[levels[j]] > 1)
    order = again[np.argsort(levels[-1][again], kind="stable")]  # the last ranks are all different: the suffix array
    lcp = np.zeros(len(order) + 1, dtype=np.int64)
    lcp[1:-1] = _common(levels, order[:-1], order[1:])
    longest = np.maximum(lcp[:-1], lcp[1:])
    out = []
    for least in (window, min_words):
        on = longest >= least
        out.append(np.bincount(doc[_covered(order[on], longest[on], len(ids))], minlength=n_docs))
    top = zero.copy()
    np.maximum.at(top, doc[order], np.where(longest >= min_words, longest, 0))
    return out[0], out[1], top


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, list[list[bytes]]]]:
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        w = t.split()
        if held and size + len(w) > WORDS_PER_SORT:
            yield first, held
            first, held, size = i, [], 0
        held.append(w)
        size += len(w)
    if held:
        yield first, held


def measure(texts: list[bytes], min_words: int = 5, window: int = 8) -> dict[str, np.ndarray]:
    """The measures of whole texts (UTF-8 bytes), in their order."""
    out: dict[str, list] = defaultdict(list)
    for first, words in _chunks(texts):
        number: defaultdict = defaultdict(count().__next__)  # its own length as the source would keep it alive
        lens = np.array([len(w) for w in words], dtype=np.int64)
        ids = np.fromiter((number[x] for w in words for x in w), dtype=np.int64, count=int(lens.sum()))
        doc = np.repeat(np.arange(len(words)), lens)
        rep, cov, top = repeats(ids, doc, len(words), min_words, window)
        out["n_words"] += lens.tolist()
        out["n_repeat_words"] += rep.tolist()
        out["n_covered_words"] += cov.tolist()
        out["longest_repeat"] += top.tolist()
        for t, w in zip(texts[first : first + len(words)], words, strict=True):
            lines = [x for x in t.split(b"\n") if x.strip()]
            out["word_chars"].append(len(b"".join(w).decode("utf-8", "replace")))
            out["n_symbols"].append(len(t) - len(t.translate(None, SYMBOLS)))
            out["n_dup_lines"].append(len(lines) - len(set(lines)))
    return {k: np.array(v, dtype=np.int64) for k, v in out.items()}


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered_words", "longest_repeat"]


def repetition_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 5) -> DataFrame:
    """``doc_id`` and the measures of each row's whole text, by one pass without a shuffle.

    Null and empty texts have no words and all measures 0; repeated rows and
    null ids give one row each; other columns are left out.
    """

    def run(batches):
        for b in batches:
            m = measure(text_bytes(b, "_text"), min_words)
            yield pa.RecordBatch.from_arrays(
                [b.column("_id"), *(pa.array(m.get(c, np.zeros(0, np.int64)), pa.int64()) for c in COLUMNS)], ["doc_id", *COLUMNS]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    return rows.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COLUMNS))


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 5,
    max_covered_pct: int = 30,
    max_longest_pct: int = 20,
    longest_at_least: int = 50,
) -> DataFrame:
    """Measures and verdict per row.

    ``base_failed``: fewer than 20 words, or more than 30 % of the words in
    8-word windows that occur twice.  ``kept``: not base_failed, at most
    ``max_covered_pct`` % of the words in repeats of ``min_words`` or more, and
    no repeat of ``longest_at_least`` words or more that is longer than
    ``max_longest_pct`` % of the text.  Null, empty and wordless texts fail.
    """
    m = repetition_measures(docs, id_col, text_col, min_words)
    n = F.col("n_words")
    failed = (n < 20) | (100 * F.col("n_repeat_words") > 30 * n)
    fine = (100 * F.col("n_covered_words") <= max_covered_pct * n) & (
        (F.col("longest_repeat") < longest_at_least) | (100 * F.col("longest_repeat") <= max_longest_pct * n)
    )
    return m.withColumn("base_failed", failed).withColumn("kept", ~failed & fine)


def kept_documents(docs: DataFrame, text_col: str = "text", **rules) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, whose text passes the rules.

    The verdict is computed beside the row in one pass, so nothing is joined back.  Null and empty texts have too
    few words and go; repeated rows stay or go together; an empty table stays empty.
    """
    at = [c.lower() for c in docs.columns].index(text_col.lower())
    min_words = rules.get("min_words", 5)
    pct, top_pct, top_least = (
        rules.get(k, v) for k, v in (("max_covered_pct", 30), ("max_longest_pct", 20), ("longest_at_least", 50))
    )

    def run(batches):
        for b in batches:
            texts = [t or b"" for t in b.column(at).cast(pa.binary()).to_pylist()]
            if not texts:
                continue
            m = measure(texts, min_words)
            n = m["n_words"]
            ok = (n >= 20) & (100 * m["n_repeat_words"] <= 30 * n) & (100 * m["n_covered_words"] <= pct * n)
            ok &= (m["longest_repeat"] < top_least) | (100 * m["longest_repeat"] <= top_pct * n)
            yield b.filter(pa.array(ok))

    return docs.mapInArrow(run, docs.schema)
