import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, added string, key long, rep string, bitmap int"


@pytest.fixture(scope="session")
def docs(spark):
    """Rows of (id, text), with further columns whose names the operators use themselves."""
    from tallyfield.llm.common import ship

    ship(spark)

    def make(rows):
        full = [(i, t, None, "s", None if t is None else len(t), "x", 1, "y", 2) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    from tallyfield.llm.common import table

    return table(spark, sf_dir, "documents")
