"""What a Python worker holds at a time."""

import corpus_pipeline
import pyarrow as pa
import pytest
from llm.cases import WORDS

from tallyloom.llm.tokens import TextEncoder


@pytest.mark.parametrize("name, stage", [s for s in corpus_pipeline.STAGES if s[0] in ("exact_dedup", "near_dedup", "packing")])
def test_stages_hand_workers_small_batches(spark, small, make_documents, name, stage):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    assert stage(spark, make_documents(["some words of a text", "and others"]), small).count() == 2

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch({"size": pa.array([batch.nbytes])})

    texts = spark.range(3000, numPartitions=1).selectExpr("id", "repeat('0123456789', 1000) text")
    found = [r["size"] for r in texts.mapInArrow(sizes, "size long").collect()]
    assert sum(found) > 30_000_000 and max(found) < 10_000_000


def test_ids_let_go_counts():
    coder, texts = TextEncoder(WORDS), pa.array(["Some words, some others."])
    assert coder.count_all(texts).tolist() == [len(b"".join(coder.encode_all(texts))) // 4]
    coder.count_all(texts)
    assert coder.counted
    assert len(list(coder.encode_all(texts))) == 1
    assert not coder.counted
