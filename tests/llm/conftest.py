import pytest

from conftest import SF_MID, SF_SMALL  # noqa: F401

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """(id, text) pairs, or full rows, as a documents frame."""
    def make(rows, schema=DOC_SCHEMA):
        rows = [r if len(r) == 5 else (r[0], r[1], "en", "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(rows, schema)

    return make
