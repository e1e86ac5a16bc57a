import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows."""

    def build(*rows, schema=DOCS):
        full = [(*r, None, None)[:4] for r in rows]
        return spark.createDataFrame([(*r, len(r[1] or "")) for r in full], schema)

    return build


@pytest.fixture
def clashing(spark):
    """Documents with extra columns named like what the operators use inside or return."""

    def build(*rows, names=()):
        columns = ", ".join(f"`{n}` string" for n in names)
        schema = f"doc_id long, text string, lang string, source string, {columns}"
        full = [(*r, None, None)[:4] for r in rows]
        return spark.createDataFrame([(*r, *(f"{n}!" for n in names)) for r in full], schema)

    return build


LONG = " ".join(f"word{i % 977} and more" for i in range(120_000))
