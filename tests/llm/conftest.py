import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# columns whose names the operators also use inside
CLASHING = ["key", "h", "size", "words", "component", "text_hash", "bucket", "anchor", "sketch", "__text_", "kinds", "score_"]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, extra=False):
        """Documents from (doc_id, text[, lang, source]) rows."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            for i, name in enumerate(CLASHING):
                df = df.selectExpr("*", f"{i} AS `{name}`")
        return df.repartition(3)

    return make


@pytest.fixture(scope="session")
def edge_rows():
    """Null and empty texts, ties, repeated rows, null ids, a very long text."""
    long = " ".join(f"word{i % 977} and{i}" for i in range(40_000))
    return [
        (1, "one two three four five six seven eight nine ten"),
        (2, None),
        (3, ""),
        (4, " \t\n"),
        (5, "one two three four five six seven eight nine ten"),
        (5, "one two three four five six seven eight nine ten"),
        (5, "another text under a repeated id, with more words than five"),
        (None, "no id here but some words are in this text"),
        (None, None),
        (6, long),
        (7, long[:-3]),
        (8, "é ü 漢字 🙂 !!! 123"),
        (9, "short"),
    ]
