from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from panelops.llm import bitplanes
from panelops.llm.common import text_bytes

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)
CODER = bitplanes.PieceEncoder(PATH, cached=200)


def by_library(text: str) -> list[int]:
    return WHOLE.encode(text, add_special_tokens=False).ids


def by_pieces(texts: list[str]) -> list[list[int]]:
    ids, at = CODER.encode(*text_bytes(pa.array(texts, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(at, at[1:], strict=False)]


AWKWARD = st.text(alphabet=" \t\n\r\x0b\x1c\x85  　aZé×÷ñ.,'s!#0½٣ⅷ中🙂ŗ", max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(AWKWARD, st.text(max_size=40)), max_size=6))
def test_pieces_give_the_ids_of_the_whole_text(texts):
    assert by_pieces(texts) == [by_library(t) for t in texts]


def test_pieces_of_odd_texts():
    texts = [
        "", " ", "\n", "a", "a  b", "x.\nThe end", "don't, 'tis", "×.y ×", "word<|endoftext|> x", "y" * 500 + " y", "été. À\n\nb ",
        "a\n b", "a \nb", "###token = \"x\"###", "a    b", None,
    ]
    assert by_pieces(texts) == [by_library(t or "") for t in texts]


@pytest.mark.parametrize("kind", ["byte", "bit"])
@pytest.mark.parametrize("n", [1, 7, 8, 9, 1000])
def test_planes_round_trip(kind, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32).astype("<u4").tobytes()
    planes = bitplanes.to_planes(ids, kind)
    assert len(planes) == (4 if kind == "byte" else 32)
    assert bitplanes.from_planes(planes, n, kind) == ids


def expected(rows, end_id=2):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.asarray(by_library(text or "") + [end_id], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("kind", ["byte", "bit"])
def test_files_give_back_all_ids(spark, tmp_path, kind):
    rows = [(5, "five five"), (1, None), (9, ""), (3, "word " * 3000), (7, "last.\n"), (7, "last.\n"), (None, "no id")]
    docs = spark.createDataFrame([(t, i, 1, 2) for i, t in rows], "text string, doc_id long, shard int, start long")
    path = str(tmp_path / "ids")
    bitplanes.write_ids(docs.repartition(3), path, PATH, block=512, kind=kind)
    got = bitplanes.read_documents(spark, path, block=512).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == expected(rows)
    sizes = [r.n_ids for r in spark.read.parquet(path).orderBy("shard", "chunk").collect()]
    assert sum(sizes) == sum(r[2] for r in expected(rows)) and max(sizes) == 512


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bitplanes.write_ids(docs, str(tmp_path / "ids"), PATH)
    assert bitplanes.read_documents(spark, str(tmp_path / "ids")).collect() == []


def test_damaged_chunk_raises(spark, tmp_path):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "some words here")], "doc_id long, text string")
    bitplanes.write_ids(docs, str(tmp_path / "ids"), PATH)
    spark.read.parquet(str(tmp_path / "ids")).withColumn("crc32", F.col("crc32") + 1).write.parquet(str(tmp_path / "bad"))
    with pytest.raises(Exception, match="damaged"):
        bitplanes.read_documents(spark, str(tmp_path / "bad")).collect()
