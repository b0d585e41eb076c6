import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns of clashing names."""
    base = [(k, f"line one {k % 3}\nline two\nline three of {k}\nthe end", "en", f"s{k % 4}") for k in range(24)]
    odd = [(None, "alone", None, None), (100, None, "en", "s1"), (101, "", None, "s1"), (102, " \n ", "en", None), (103, "word " * 30_000, "en", "s0"), (104, "x" * 200_000, "en", "s0")]
    repeated = [(7, "the same row", "en", "s2")] * 5 + [(7, "another text", "en", "s2")]
    rows = [(i, t, la, s, len(t or ""), "kept", 1) for i, t, la, s in base + odd + repeated]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, rank int")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
