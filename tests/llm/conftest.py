import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns whose names operators use themselves."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()
    base = " ".join(words)
    rows = [
        (1, base, "en", "a", 1), (2, base.upper(), "en", "a", 1), (3, base + " extra", "en", "b", 1), (4, None, "en", "a", None), (5, "", None, None, 0), (6, "...", "de", "b", 3),
        (7, "one two", "en", "a", 7), (7, "one two", "en", "a", 7), (None, "lonely words here without any identity", None, "b", 5), (9, "one two", "fr", "a", 7), (10, " ".join(f"w{i}" for i in range(30_000)), "de", None, 9), (11, "Ünïcode ÉTÉ straße 12", "fr", "c", 2),
    ]
    df = spark.createDataFrame(rows, DOCS)
    from pyspark.sql import functions as F

    for name in ("key", "node", "size", "hub", "label", "digest", "copy", "n_copies", "found", "uid", "bundle", "rate"):
        df = df.withColumn(name, F.lit(name))
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
