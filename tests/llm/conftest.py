import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty, blank and very long texts, ties, repeated rows, clashing extra columns."""
    long = " ".join(f"w{i % 700}x{i % 13}" for i in range(30_000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog again and again today", "en", "s", 3),
        (1, "The quick brown fox jumps over the lazy dog again and again today", "en", "s", 3),
        (2, "THE QUICK brown fox  jumps over the lazy dog again and again today", None, None, None),
        (3, None, None, None, None), (4, "", "en", "s", 0), (5, " \n\t ", "en", "s", 4), (6, "one", "en", "s", 3),
        (7, "one two", "en", "s", 7), (None, "nobody knows this row and its number at all", "en", "s", 1),
        (None, None, None, None, None), (8, long, "en", "s", len(long)), (9, "!!! ??? ...", "en", "s", 11),
        (10, "tab\there\x0bvertical\x0cfeed\xa0nbsp 中文字 \U0001f642 é é", "xx", "s", 1),
        (11, "<|endoftext|> inside <|endoftext|>", "en", "s", 1),
    ]
    # columns that operators use inside, as clashing extras
    df = spark.createDataFrame(rows, DOCS)
    for c in ("fp", "id", "w", "h", "hash", "key", "rank", "part", "window", "offset", "doc", "u", "v", "node", "no", "toxicity"):
        df = df.selectExpr("*", f"'x' as `{c}`")
    return df


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
