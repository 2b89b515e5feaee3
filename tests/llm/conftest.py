import pytest

from millrace.llm.frames import prepared


@pytest.fixture(scope="session")
def llm(spark):
    return prepared(spark)


@pytest.fixture()
def frame(llm):
    """Rows of (doc_id, text) among columns whose names the operators use themselves."""

    def make(rows):
        return llm.createDataFrame(
            [(i, t, "x", 1, 2, b"y", 3.0, "z") for i, t in rows],
            "doc_id long, text string, lang string, piece int, length long, chunk binary, score double, sha string",
        )

    return make
