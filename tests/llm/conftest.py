import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of documents from texts, or from (text, lang, source)."""

    def make(rows, extra=""):
        full = []
        for i, row in enumerate(rows):
            text, lang, source = row if isinstance(row, tuple) else (row, "en", "s")
            full.append((i, text, lang, source, len(text or "")))
        return spark.createDataFrame(full, DOCUMENT)

    return make
