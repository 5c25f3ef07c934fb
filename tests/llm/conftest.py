import pytest


@pytest.fixture
def docs_of(spark):
    """Documents with extra columns whose names clash with inner ones."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, lang, src, None if t is None else len(t), "x", 7) for i, t, lang, src in rows],
            "doc_id long, text string, lang string, source string, n_chars long, hash string, size int",
        )

    return make
