import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(texts):
    return [(i, t, "en" if i % 3 else None, f"s{i % 2}" if i % 5 else None, None) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def table(spark):
    """Texts as a table of documents: ids in order, some null languages and sources."""

    def make(texts, more=()):
        return spark.createDataFrame(rows(texts) + list(more), SCHEMA).repartition(3)

    return make


@pytest.fixture(scope="session")
def clashing():
    """The same rows with columns that operators use inside."""
    from pyspark.sql import functions as F

    def widen(df):
        names = "n n_words n_lines kept score tid key entry row words start length signature number component".split()
        return df.select("*", *(F.lit("x").alias(c) for c in names))

    return widen


SPACED = "Tab\tand\x0bvertical\x0cfeed\rhere"
ODD = ["", None, " ", "\n\n", "é ñ ß x", SPACED, "A" * 30_000, "\U0001f600 emoji"]
