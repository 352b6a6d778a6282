import pytest

from tidewater.llm.common import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, set string, key string, at long, label int, part string, mask int, words int, start int"


@pytest.fixture(scope="session")
def sp(spark):
    ship(spark)
    return spark


@pytest.fixture()
def table_of(sp):
    """A table of (doc_id, text, lang, source) with columns whose names the operators use themselves."""

    def make(rows):
        return sp.createDataFrame([(*r, None, "x", None, 0, 1, "p", 3, 4, 5) for r in rows], SCHEMA)

    return make
