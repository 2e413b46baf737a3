import pytest

SF = "/root/testdata/sf0.001"

#: Nulls, empty and blank texts, repeated rows, a repeated id with another text, a very long text, clashing names.
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a"),
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa", "en", "a"),
    (1, "another text under the same id, with password = abcdefgh12 inside it", "en", None),
    (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa", None, "a"),
    (2, None, "en", "a"),
    (3, "", "de", "b"),
    (4, " \t\n ", "de", "b"),
    (5, "über größe straße über größe straße <|endoftext|> 東京 😀", "de", "b"),
    (6, "word " * 3000 + "\n" + "x" * 30000, "en", "a"),
    (7, "two\nlines", None, None),
]


@pytest.fixture(scope="session")
def edge(spark):
    """The rows above, with extra columns whose names operators use inside."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", "length(text) as n_chars", "'x' as key_", "'y' as row_", "'z' as text_", "1 as kept", "2 as words_")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
