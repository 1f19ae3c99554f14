import pytest
from corpus_rows import TEXTS, documents
from pyspark.sql import Row


@pytest.fixture(scope="session")
def docs(spark):
    return documents(spark, TEXTS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return documents(spark, [])


@pytest.fixture(scope="session")
def labels(spark):
    rows = [Row(doc_id=i, quality=i % 2, toxic=(i + 1) % 2) for i in range(20)]
    rows += [Row(doc_id=None, quality=1, toxic=0), Row(doc_id=3, quality=None, toxic=None)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
