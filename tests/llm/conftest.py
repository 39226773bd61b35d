import pytest


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and clashing extra columns."""
    long = " ".join(f"word{i % 977} Other{i}" for i in range(6000))
    texts = [
        (1, "a short text"),
        (1, "a short text"),
        (1, "another text under the same id"),
        (2, ""),
        (3, None),
        (None, "a text without an id"),
        (None, None),
        (4, " \t\n\r\x0b\x0c "),
        (5, long),
        (6, long + " end"),
        (7, "a" * 50_000),
        (8, "café ☃ \U0001f600 Σ \x00\x1c mail me@example.org, é@x.y or +1 (555) 010-9999\n\n x"),
        (9, "same words"),
        (10, "same words"),
    ]
    rows = [
        (d, t, None if i % 3 == 0 else "en", None if i % 4 == 0 else "src", None if t is None else len(t),
         "clash", i, None, float(i), [i])
        for i, (d, t) in enumerate(texts)
    ]
    return spark.createDataFrame(
        rows,
        "doc_id bigint, text string, lang string, source string, n_chars bigint, row_key string, "
        "n int, label string, score double, words array<int>",
    )


@pytest.fixture(scope="session")
def no_documents(odd_documents):
    return odd_documents.where("false")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
