import pytest


@pytest.fixture
def documents(spark):
    """rows -> documents-like frame with clashing extra columns."""

    def make(rows, extra=True):
        cols = "doc_id long, text string, lang string, source string, n_chars long"
        data = [(i, t, "en", f"s{(i or 0) % 3}", None if t is None else len(t)) for i, t in rows]
        if extra:
            cols += ", score double, kept string, text_ string, g long, `key` string, node long, spans string, label string"
            data = [(*d, 0.5, "x", "y", 1, "k", 2, "z", "w") for d in data]
        return spark.createDataFrame(data, cols)

    return make
