import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents with clashing extra columns from (doc_id, text, lang, source) tuples."""

    def make(rows):
        full = [(*r, *("en", "s")[len(r) - 2:])[:4] for r in rows]
        df = spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "x", 1, "y") for r in full],
                                   DOCS + ", key string, n int, words_hash string")
        return df

    return make


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
