import pytest
from corpus_rows import CLASHING, FIELDS, odd_rows
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def odd(spark):
    df = spark.createDataFrame(odd_rows(), FIELDS).repartition(3)
    for c in CLASHING:
        df = df.withColumn(c, F.lit("extra"))
    return df


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)
