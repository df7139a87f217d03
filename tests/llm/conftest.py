import pytest

DOC_SCHEMA = "doc_id long, text string, source string"


@pytest.fixture(scope="session")
def docs(spark):
    def make(rows, schema=DOC_SCHEMA):
        return spark.createDataFrame(rows, schema)
    return make
