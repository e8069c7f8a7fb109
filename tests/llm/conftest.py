"""Small frames with all that documents may hold."""

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
LABELS = "doc_id bigint, label int"


@pytest.fixture(scope="session")
def frame(spark):
    """A frame of documents from ``(doc_id, text)`` or ``(doc_id, text, source)``."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make
