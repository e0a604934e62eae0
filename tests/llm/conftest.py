import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """A small frame from rows and a schema, with a column that clashes with inner names."""

    def make(rows, schema):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(rows, schema)
        for name in ("n", "rank", "length", "words", "value", "key", "path", "line"):
            if name not in df.columns:
                df = df.withColumn(name, F.lit("clash"))
        return df

    return make
