import pytest

from . import corpus


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus.documents(), corpus.SCHEMA)


@pytest.fixture(scope="module")
def no_docs(spark):
    return spark.createDataFrame([], corpus.SCHEMA)
