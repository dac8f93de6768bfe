import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, kept string, digest string, `values` string, label int, key int"


@pytest.fixture
def docs_of(spark):
    """A documents table, with further columns whose names operators use themselves."""

    def make(texts, first=0):
        rows = [
            (i, t, "en", "s", None if t is None else len(t), "x", "y", "z", 7, None)
            for i, t in (texts.items() if isinstance(texts, dict) else enumerate(texts, first))
        ]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make


@pytest.fixture
def odd(spark):
    """Nulls in every column, empty and white texts, a very long one, repeated rows."""
    long = " ".join(f"w{i % 9000}" for i in range(60_000))
    rows = [
        (1, None, None, None, None, None, None, None, None, None),
        (2, "", "en", "s", 0, "", "", "", 0, 0),
        (3, " \t\n\x0b ", "en", "s", 5, "", "", "", 0, 0),
        (4, long, "en", "s", len(long), "", "", "", 0, 0),
        (5, "one two", "en", "s", 7, "", "", "", 0, 0),
        (5, "one two", "en", "s", 7, "", "", "", 0, 0),
        (6, "ONE two é 字 <|endoftext|>", "en", "s", 1, "", "", "", 0, 0),
        (None, "no id at all", "en", "s", 1, "", "", "", 0, 0),
    ]
    return spark.createDataFrame(rows, DOCUMENTS).repartition(3)
