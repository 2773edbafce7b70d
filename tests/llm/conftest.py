import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, media string, shard int"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns whose names operators use themselves."""
    long = " ".join(f"word{k % 97} and{k}" for k in range(9000))
    rows = [(1, "plain words to read here today", "en"), (2, None, "en"), (3, "", None), (4, long, "en"), (1, "plain words to read here today", "en"), (None, "plain words to read here today", "en"), (7, "   \n\t ", "en"), (8, "Plain  words to READ here\ttoday", None), (9, "ä ö 日本 \U0001f600 é", "de")]
    return spark.createDataFrame([(i, t, lang, None, None if t is None else len(t), "x", 3) for i, t, lang in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
