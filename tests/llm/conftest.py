import pytest

from .cases import HARD


@pytest.fixture(scope="session")
def docs_of(spark):
    """Builds a documents table from (doc_id, text) pairs."""
    def build(rows, parts=3):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long").repartition(parts)
    return build


@pytest.fixture(scope="session")
def hard(docs_of):
    return docs_of(HARD)


@pytest.fixture(scope="session")
def empty(docs_of):
    return docs_of([])


@pytest.fixture(scope="session")
def clashing(hard):
    """The hard rows with columns named like the operators' own."""
    from pyspark.sql import functions as F
    names = ("row", "node", "label", "key", "n_words", "places", "_m", "_words", "kept", "failed", "start", "length",
             "target", "spans", "band", "a", "b", "_gone", "_text", "_row")
    return hard.withColumns({n: F.lit("x") for n in names})
