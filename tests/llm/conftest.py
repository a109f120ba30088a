import pytest

# Texts that operators must take: missing, empty, white space, repeated, very long, odd.
ODD_TEXTS = [
    None, "", " ", "\n\n", "a", "same text here", "same text here", "É́ 日本 😀", "x" * 30_000,
    "word " * 5_000, "\x00\x1c\x85 \t", "line one\nline two\nline one",
]


@pytest.fixture(scope="session")
def docs(spark):
    """Make a documents table; extra columns have names that operators use inside."""

    def make(texts, ids=None, lang="en"):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, lang, "s", len(t or ""), 7, "z", 1.5) for i, t in zip(ids, texts)]
        return spark.createDataFrame(
            rows,
            "doc_id long, text string, lang string, source string, n_chars long, "
            "key int, row string, score double",
        )

    return make


@pytest.fixture(scope="session")
def odd_docs(docs):
    ids = list(range(len(ODD_TEXTS)))
    ids[3] = None
    # A repeated row, and one id with two texts.
    return docs([*ODD_TEXTS, "same text here", "other"], [*ids, 6, 6])


@pytest.fixture(scope="session")
def no_docs(docs, odd_docs):
    return odd_docs.limit(0)
