import json

import __spark_entry__ as entry
import corpus_pipeline
from bourse.llm import wavelet
from bourse.llm.decontam import decontaminate
from bourse.llm.mixing import uniform
from bourse.llm.quality import measure
from bourse.llm.simhash import fingerprint
from tests.llm.conftest import sentence
from pyspark.sql import functions as F


def test_queries_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and 4 <= len(corpus_pipeline.STAGES) <= 5
    assert all(q in names for q in entry.oracle_sql())


def test_stages_against_brute_force(spark, tmp_path):
    item = sentence(500, 14)
    rows = []
    for i in range(60):
        text = sentence(i, 60 + i)
        if i % 12 == 1:
            text = sentence(i - 1, 59 + i)  # the text of the row before
        if i % 12 == 2:
            text = f"{text} {item} {text[:40]}"
        if i % 12 == 3:
            text = "again and again " * 20
        rows.append((i, text, "en" if i % 4 else "de", f"src{i % 3}", len(text)))
    rows += [(100, None, None, None, None), (101, "", "en", "src1", 0), (0, rows[0][1], "de", "src0", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    sf = str(tmp_path)
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["quality"](spark, docs, sf)
    m = measure([(r[1] or "").encode() for r in rows])
    good = [r for r, n, rep in zip(rows, m["n_words"], m["n_repeat_words"], strict=True) if n >= 20 and 100 * rep <= 30 * n]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in good) and kept.columns == docs.columns

    one = stages["near_dedup"](spark, kept, sf)
    prints, want = [], []
    for r in sorted(good):
        fp = fingerprint(r[1].encode(), 4)
        if all((fp ^ x).bit_count() > 4 for x in prints):
            want.append(r[0])
        prints.append(fp)
    assert sorted(r.doc_id for r in one.collect()) == sorted(set(want)) and one.columns == docs.columns

    clean = stages["decontamination"](spark, one, sf)
    bad = {r.doc_id for r in decontaminate(one, spark.read.parquet(f"{sf}/benchmark.parquet")).collect() if r.n_hit}
    assert bad == {i for i in want if i % 12 == 2}
    assert sorted(r.doc_id for r in clean.collect()) == sorted(set(want) - bad) and clean.columns == docs.columns

    mixed = stages["mixing"](spark, clean, sf)
    ids = [r.doc_id for r in mixed.orderBy("doc_id").collect()]
    drawn = {r.doc_id: r.u for r in clean.select("doc_id", uniform(F.col("doc_id"), "mix").alias("u")).collect()}
    assert ids and set(ids) <= set(drawn) and mixed.columns == docs.columns
    out = sorted(stages["tokens"](spark, mixed, sf).collect())
    enc = wavelet.WordEncoder(wavelet.tokenizer_file("word_bpe_49k.json"))
    text = {r[0]: r[1] for r in rows}
    assert [r.doc_id for r in out] == ids
    assert [r.n_tokens for r in out] == [len(enc.encode(text[i].encode())) // 4 + 1 for i in ids]
    whole = corpus_pipeline.run(spark, sf)
    assert sorted(whole.collect()) == out
    assert json.loads(whole.schema.json())["fields"][0]["name"] == "doc_id"
