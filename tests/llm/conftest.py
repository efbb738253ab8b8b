import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def frame(spark):
    """Rows (doc_id, text) as documents, with columns whose names the operators use themselves."""

    def make(rows, extra=True):
        full = [(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            from pyspark.sql import functions as F

            for name in ("fp", "full", "tokens", "copies", "row", "part", "hits", "n_words", "_place", "score", "digest"):
                df = df.withColumn(name, F.lit(name))
        return df

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, blanks, a very long text, ties, repeated rows, a null id."""
    long = " ".join(f"word{k % 997} and more {k}" for k in range(30_000))
    return [(1, None), (2, ""), (3, " \n\t "), (4, long), (5, "one two three four five six seven eight nine ten eleven twelve"), (6, "one two three four five six seven eight nine ten eleven twelve"), (7, "short"), (7, "short"), (None, "no id here"), (9, "été 日本語 ﬁn <|endoftext|> x\x00y")]


@pytest.fixture(scope="session")
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return make
