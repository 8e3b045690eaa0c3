import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType


@pytest.fixture(scope="session")
def docs_of(spark):
    """documents-like rows from (doc_id, text[, lang, source]) tuples, as a parquet table."""
    from comms_lake.session import materialize
    schema = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                         StructField("lang", StringType()), StructField("source", StringType()),
                         StructField("n_chars", LongType())])

    def make(rows):
        full = [(r[0], r[1], *(r[2:] + ("en", "src0")[len(r) - 2:]), len(r[1] or "")) for r in rows]
        return materialize(spark.createDataFrame(full, schema).coalesce(2), "test")
    return make
