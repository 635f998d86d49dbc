import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) pairs, with columns whose names operators use inside."""

    def make(pairs):
        rows = [(i, t, "en", f"src{n % 3}", len(t or "")) for n, (i, t) in enumerate(pairs)]
        df = spark.createDataFrame(rows, DOCS)
        from pyspark.sql import functions as F

        clash = ["key", "fp", "h", "c", "w", "t", "label", "score", "found", "n_words", "topic", "_text"]
        return df.withColumns({c: F.lit(-1) for c in clash})

    return make


def sentence(seed: int, n: int) -> str:
    """Words that do not repeat by chance."""
    import random

    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 8))) for _ in range(n))
