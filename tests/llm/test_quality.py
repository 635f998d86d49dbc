import gc
from collections import Counter
import random

from bourse.llm.quality import kept_documents, measure, quality_rules
from tests.llm.conftest import sentence


def brute(text: bytes, least: int):
    w = text.split()
    runs = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    again = {j for i in range(len(w) - 7) if runs[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
    covered, longest = set(), 0
    for i in range(len(w)):
        best = 0
        for j in range(len(w)):
            if i != j:
                k = 0
                while max(i, j) + k < len(w) and w[i + k] == w[j + k]:
                    k += 1
                best = max(best, k)
        if best >= least:
            covered |= set(range(i, i + best))
            longest = max(longest, best)
    return len(again), len(covered), longest


def test_repeats_equal_brute_force():
    rnd = random.Random(5)
    texts = [b" ".join(rnd.choice([b"a", b"b", b"c", b"d"][: rnd.randint(1, 4)]) for _ in range(rnd.randint(0, 70))) for _ in range(150)]
    texts += [b"", b"x " * 90, b"a b c d e f g h " * 2, b"\xc3\xa9 \xa0 " * 9]
    m = measure(texts, 5)
    for i, t in enumerate(texts):
        assert (m["n_repeat_words"][i], m["n_covered_words"][i], m["longest_repeat"][i]) == brute(t, 5), t


def test_verdicts_and_edges(spark, make_docs):
    clean, long = sentence(1, 200), sentence(2, 60_000)
    loop = sentence(3, 10) + " "
    pairs = [
        (1, clean), (2, None), (3, ""), (4, " \t\n"), (5, "few words"), (6, loop * 20), (None, clean), (1, clean), (7, long),
        (8, clean + "\n" + "same line\n" * 3 + "#$%"), (9, sentence(4, 100) + " " + sentence(9, 60) + " " + sentence(9, 60)),
    ]
    docs = make_docs(pairs)
    got = {(r.doc_id, r.n_words): r for r in quality_rules(docs).collect()}
    assert len(got) == len(pairs) - 1  # the repeated row
    assert got[1, 200].kept and got[None, 200].kept and got[7, 60_000].kept
    assert got[2, 0].base_failed and got[3, 0].base_failed and got[4, 0].base_failed and got[5, 2].base_failed
    assert got[6, 200].n_repeat_words == 200 and not got[6, 200].kept
    assert got[8, 207].n_dup_lines == 2 and got[8, 207].n_symbols == 3 and got[8, 207].kept
    bad = got[9, 220]
    assert bad.longest_repeat == 60 and not bad.kept
    assert got[1, 200].word_chars == len(clean.replace(" ", ""))
    kept = kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "1", "None", "7", "8"])
    assert quality_rules(docs.where("false")).count() == 0 and kept_documents(docs.where("false")).count() == 0


def test_words_are_let_go_without_the_cycle_collector():
    """The words of a chunk must not wait for the collector: a task's chunks would add up."""
    texts = [sentence(i, 50).encode() for i in range(20)]
    measure(texts, 5)
    gc.collect()
    gc.disable()
    try:
        measure(texts, 5)
        assert gc.collect() == 0
    finally:
        gc.enable()
