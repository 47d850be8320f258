import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string"


@pytest.fixture
def documents(spark):
    """Documents from texts, with columns that clash with those of results."""

    def make(*texts, first=0):
        rows = [
            (first + k, t, "en" if k % 2 else None, f"src{k % 3}", None, "x", None)
            for k, t in enumerate(texts)
        ]
        return spark.createDataFrame(rows, DOCS)

    return make
