import random
import zlib

import numpy as np
import pyarrow as pa

from bourse.llm import wavelet
from bourse.session import scratch_path
from tests.llm.conftest import sentence

PATH = wavelet.tokenizer_file("word_bpe_49k.json")


def test_words_encode_as_whole_texts():
    enc = wavelet.WordEncoder(PATH)
    texts = [
        "", "don't I'LL we'Ve it's", "<|endoftext|> x<|startoftext|>y", "café ñ É ÀÈß ÿ Ÿ µ ª º ×÷", "日本語 テスト 123 45a6b", "İstanbul ǅ ﬁ",
        "a\x1cb\x85c \x7f \x00 x", "'s't're'VE'm 'D'll' ''", "emoji 😀😀 ‍", "!!!--##a1b2", "ΣΑΣ σς", "a\r\nb\tc\x0bd\x0ce", "﻿abc",
        "é x́", " ́x", sentence(3, 200).upper(),
        "J\u030c E\u0301 I\u0307 K\u212a", "<|ENDOFTEXT|> <|EndOfText|> A<B", "\u017fS \u1e9e\u00df",
    ]
    for t in texts:
        want = enc.whole.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(enc.encode(t.encode()), "<u4").tolist() == want, t


def test_access_count_and_find(monkeypatch):
    monkeypatch.setattr(wavelet, "CHUNK_BITS", 64)
    rng = np.random.default_rng(1)
    for n, top, bits in ((0, 1, 16), (1, 1, 1), (1000, 300, 9), (777, 2, 1), (500, 65536, 16), (300, 100_000, 17)):
        ids = rng.integers(0, top, n).astype(np.uint32)
        s = wavelet.WaveletShard(wavelet.build(ids, [7], np.array([n]), "o", bits))
        assert s.ids().tolist() == ids.tolist() and s.documents()[0] == [7]
        for i in rng.integers(0, n, 60) if n else []:
            v, (lo, hi) = int(ids[i]), sorted(rng.integers(0, n + 1, 2).tolist())
            assert s.access(int(i)) == v and s.count(v, lo, hi) == int((ids[lo:hi] == v).sum())
            places = np.flatnonzero(ids == v)
            j = int(rng.integers(0, len(places)))
            assert s.find(v, j) == places[j]
        assert s.count(1 << 20) == 0


def test_files_hold_the_documents_in_order(spark, make_docs):
    rnd = random.Random(3)
    pairs = [(i, sentence(i, rnd.randint(0, 50))) for i in rnd.sample(range(-20, 200), 60)]
    pairs += [(500, None), (501, ""), (None, "alpha beta"), (None, None), (502, sentence(9, 20_000)), (pairs[0])]
    path = scratch_path(spark, "t-tokens")
    got = wavelet.token_table(make_docs(pairs), PATH, path=path, shard_tokens=200).collect()
    enc = wavelet.WordEncoder(PATH)
    end = (1).to_bytes(4, "little")
    want = sorted(((i, enc.encode((t or "").encode()) + end) for i, t in pairs), key=lambda x: (x[0] is not None, x[0] or 0))
    assert len(got) == len(pairs)
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == [i for i, _ in want]
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted((str(i), len(b) // 4, zlib.crc32(b)) for i, b in want)
    files = spark.read.format("binaryFile").load(path).select("content").collect()
    shards = [wavelet.WaveletShard(bytes(f.content)) for f in files]
    assert len(shards) > 10 and sum(s.n for s in shards) == start and sum(s.count(1) for s in shards) >= len(pairs)


def test_empty_table(spark, make_docs):
    assert wavelet.token_table(make_docs([(1, "x")]).where("false"), PATH).count() == 0


def test_repeated_rows_over_many_shards(spark, make_docs):
    text = sentence(4, 60)
    pairs = [(7, text)] * 40 + [(8, "end")] + [(None, None)] * 30 + [(None, text)] * 30
    got = sorted(wavelet.token_table(make_docs(pairs), PATH, shard_tokens=100).collect(), key=lambda r: r.start)
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    assert len(got) == len(pairs) and [r.doc_id for r in got] == [None] * 60 + [7] * 40 + [8]


def test_a_tokenizer_with_other_rules_encodes_whole_texts(tmp_path):
    import json

    rules = json.loads(open(PATH).read())
    rules["normalizer"]["normalizers"] = rules["normalizer"]["normalizers"][:2]  # keeps capitals
    other = tmp_path / "other.json"
    other.write_text(json.dumps(rules))
    enc, known = wavelet.WordEncoder(str(other)), wavelet.WordEncoder(PATH)
    assert known.by_words and not enc.by_words
    for t in ("The Word And THE word", "", "café <|endoftext|> x"):
        assert np.frombuffer(enc.encode(t.encode()), "<u4").tolist() == enc.whole.encode(t, add_special_tokens=False).ids
    assert enc.encode(b"The") != known.encode(b"The")


def test_what_is_in_use_is_not_computed_again():
    asked = []
    kept = wavelet._Kept(lambda k: asked.append(k) or k * 2, 10)
    for i in range(200):
        assert kept["often"] == "oftenoften" and kept[str(i)] == str(i) * 2
        assert len(kept) <= 10 and len(kept.old) <= 10
    assert asked.count("often") == 1 and len(asked) == 201


def test_a_piece_is_tokenized_once_whatever_words_hold_it():
    enc = wavelet.WordEncoder(PATH)
    asked = []
    compute = enc.pieces.compute
    enc.pieces.compute = lambda p: asked.append(p) or compute(p)
    enc.encode_all(pa.array([b"word Word, (word) word's word;", b"wOrd! \"word\" word..."]))
    enc.encode_all(pa.array([b"word?"]))
    assert asked.count("word") == 1 and len(asked) == len(set(asked))


def test_many_texts_encode_as_each_alone(monkeypatch):
    monkeypatch.setattr(wavelet, "SLICE_WORDS", 7)
    rnd = random.Random(5)
    marks = ["", ".", ",", "'s", "###", "<|endoftext|>", "\u0301", "9a", "\u00e0", "\u0440\u0443", "\u65e5", "\u00a0", "\x1c", "\x85", "\ufeff", "\ufffd", " "]
    space = [" ", "  ", "\n", "\t\r\n", "\x0b", "\x0c"]
    texts = ["", " ", "\n\n", "\u65e5\u672c", " a", "a "]
    texts += ["".join(rnd.choice(["the", "The", "\u00c9t\u00e9", "k"]) + rnd.choice(marks) + rnd.choice(space) for _ in range(rnd.randint(0, 30))) for _ in range(200)]
    enc = wavelet.WordEncoder(PATH)
    enc.pieces.most = 5
    for some in (texts, texts[:3], texts[3:4], [], texts[::-1]):
        ids, sizes = enc.encode_all(pa.array([t.encode() for t in some], pa.binary()))
        want = [enc.whole.encode(t, add_special_tokens=False).ids for t in some]
        assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    broken = [b"a\xc3 b", b"\xff", b"x\xe6\x97 \xe6\x97\xa5", b"end\xf0\x9f"]
    ids, sizes = enc.encode_all(pa.array(broken))
    want = [enc.whole.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids for t in broken]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_slices_hold_every_row_in_order():
    texts = ["abc", None, "", "x" * 50, "y", None, "z" * 9, "\u65e5" * 4]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["i", "t"])
    for size in (1, 5, 10, 1000):
        parts = list(wavelet.slices(batch, "t", size))
        assert [v for p in parts for v in p.column("i").to_pylist()] == list(range(len(texts)))
        assert len(parts) == 1 or size < 1000
        assert all(sum(len((t or "").encode()) for t in p.column("t").to_pylist()[:-1]) < size for p in parts)
    assert list(wavelet.slices(batch.slice(0, 0), "t", 5)) == []
