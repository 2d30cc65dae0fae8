import pytest


@pytest.fixture
def frame(spark):
    """A table of documents (doc_id, text) with columns whose names the operators use too."""

    def make(rows, extra=True):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        if extra:
            for name in ("doc", "n", "key", "a", "b", "item", "score", "lang", "spans", "block"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


@pytest.fixture(scope="session")
def prose():
    """Invented words, the same ones on every run."""
    import random

    rng = random.Random(11)
    parts = "ka lo mi ren tu sha vel or ith da ne qua".split()
    words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(3000)]

    def text(n, seed):
        r = random.Random(seed)
        return " ".join(r.choice(words) for _ in range(n))

    return text
