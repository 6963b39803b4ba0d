import pytest

LONG = " ".join(f"word{i % 977} tail" for i in range(30000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 10),
    (2, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 10),
    (3, "", "en", "a", 0),
    (4, None, None, None, None),
    (5, "   \t\n ", "en", "a", 5),
    (6, "solo", "de", "b", 4),
    (7, "solo", "de", "b", 4),
    (8, LONG, "en", "hot", len(LONG)),
    (9, LONG + " extra", "en", "hot", len(LONG) + 6),
    (10, "É é 中文 😀 mail bob@example.com or 10.0.0.1 token = \"abcdef123456\" +1 (555) 123-4567 4111 1111 1111 1111", "fr", "b", 90),
    (10, "another text of the same id", "fr", "b", 27),
    (None, "a row without an id", "en", "b", 19),
    (12, "12345 67890 ...", "en", "b", 15),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, blank and very long texts, copies, a repeated id, a null id, a text without letters."""
    return spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same with extra columns named like results."""
    from pyspark.sql import functions as F

    return odd.withColumns({c: F.lit("x") for c in ("score", "spans", "ids", "decoded", "component_id", "kept", "n", "a", "b", "id", "key", "label", "rejected", "lang_pred", "base_spans", "n_words")})


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
