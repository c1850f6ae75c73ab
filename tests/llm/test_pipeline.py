from __future__ import annotations

import tracemalloc

import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from panelops.llm import bitplanes, common

WITH_PYTHON = [s for s in corpus_pipeline.STAGES if s[0] != "mixing to target weights"]


@pytest.fixture
def unbounded(spark):
    """The session with Spark's own bound of Arrow batches, before and after a test."""
    spark.conf.unset(common.BYTES_PER_BATCH)
    yield spark
    spark.conf.unset(common.BYTES_PER_BATCH)


def batch_sizes(docs) -> list[int]:
    def size(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"size": [b.nbytes]})

    return [r.size for r in docs.mapInArrow(size, "size long").collect()]


@pytest.mark.parametrize("stage", [f for _, f in WITH_PYTHON], ids=[n for n, _ in WITH_PYTHON])
def test_python_gets_small_batches(unbounded, sf, stage):
    spark = unbounded
    long = spark.range(0, 400, numPartitions=1).selectExpr("id doc_id", "repeat('some words ', 10000) text")
    assert max(batch_sizes(long)) > 40e6
    stage(spark, spark.read.parquet(f"{sf}/documents.parquet").limit(50), sf)
    sizes = batch_sizes(long)
    assert sum(sizes) > 40e6 and max(sizes) < 1.2 * common.BATCH_BYTES


def test_own_bound_stays(unbounded):
    unbounded.conf.set(common.BYTES_PER_BATCH, "1m")
    common.small_batches(unbounded)
    assert unbounded.conf.get(common.BYTES_PER_BATCH) == "1m"


@pytest.mark.parametrize("stage", [f for _, f in WITH_PYTHON], ids=[n for n, _ in WITH_PYTHON])
def test_batches_change_no_row(unbounded, sf, stage):
    docs = unbounded.read.parquet(f"{sf}/documents.parquet")
    found = []
    for size in ("64m", "10k"):
        unbounded.conf.set(common.BYTES_PER_BATCH, size)
        found.append(sorted(map(repr, stage(unbounded, docs, sf).collect())))
    assert found[0] == found[1] and found[0]


def test_encoder_works_on_little_at_once():
    coder = bitplanes.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    data, at = common.text_bytes(pa.array(["some words of a text\n" * 500] * 300))
    list(coder.encode_each(data, at))
    tracemalloc.start()
    n = sum(map(len, coder.encode_each(data, at)))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n and len(data) > 3e6 and most < 48e6, f"{most / 1e6:.0f} MB"
