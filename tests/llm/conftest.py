import pytest

SF = "/root/testdata/sf0.001"

#: Texts that every operator must take: null, empty, white space, one word, repeated rows, odd characters, a very long one.
ODD_TEXTS = [None, "", " \t\n", "one", "one", "Émile \U0001F600 naïve\x0btext\x00end", "a " * 30_000, "x" * 120_000]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls in every column, repeated rows and a clashing extra column."""
    rows = [(i if i != 5 else None, t, "en" if i % 2 else None, f"src{i % 3}" if i % 4 else None, len(t or "")) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[3], rows[3]]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
