import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def small(spark):
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def make_documents(spark):
    """A documents table of given texts, or of (doc_id, text) pairs, with columns whose names clash with results."""

    def make(rows, partitions=3):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(i, t, "en", None, 0 if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCUMENTS).repartition(partitions)

    return make
