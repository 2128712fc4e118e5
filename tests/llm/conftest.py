import pytest


@pytest.fixture
def docs(spark):
    """Builds a documents frame from (doc_id, text) rows, with a column whose name clashes with an operator's own."""

    def make(rows, parts=3):
        data = [(i, t, "en", f"src{k % 3}", len(t or ""), 7) for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, sig int").repartition(parts)

    return make
