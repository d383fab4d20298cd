import pytest


@pytest.fixture
def documents(spark):
    """Rows of doc_id and text as the documents table, with columns whose names may clash."""

    def make(rows, extra=""):
        schema = "doc_id long, text string, lang string, source string, n_chars long" + extra
        full = []
        for row in rows:
            doc_id, text = row[:2]
            source = row[2] if len(row) > 2 else "s"
            full.append((doc_id, text, "en", source, len(text or "")) + (0,) * extra.count(","))
        return spark.createDataFrame(full, schema).repartition(3)

    return make


CLASH = ", band long, n long, rep long, tkey long, start long, h long, copy long, rate long, size long, component long"


@pytest.fixture
def clashing():
    return CLASH
