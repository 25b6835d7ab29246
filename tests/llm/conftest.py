import pytest


@pytest.fixture(scope="module")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def texts(spark):
    """A frame of documents from (doc_id, text), with a column whose name operators use themselves."""
    def make(rows, extra="_row"):
        return spark.createDataFrame([(d, t, "x") for d, t in rows], f"doc_id long, text string, `{extra}` string")
    return make
