from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from panelops.llm import ecoc_language as ecoc
from panelops.llm.common import read, text_bytes


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 12])
def test_codewords_are_apart(n):
    code = ecoc.codewords(n)
    assert code.shape[0] == n and set(np.unique(code)) <= {-1.0, 1.0}
    if n > 1:
        distance = (code.shape[1] - code @ code.T) / 2 + np.eye(n) * 999
        assert distance.min() >= (1 if n == 2 else 2)


def test_wrong_bit_is_corrected():
    code = ecoc.codewords(4)
    coder = ecoc.Coder(list("abcd"), code, np.eye(7), np.zeros(7))
    for i in range(4):
        for bit in range(7):
            margins = 3 * code[i].copy()
            margins[bit] *= -1
            assert coder.decode(margins[None, :])[0][0] == i


def test_features_are_those_of_each_whole_text():
    texts = ["Ab", "", "x", None, "Été à la mer. " * 300, "ab"]
    together = ecoc.ngram_features(*text_bytes(pa.array(texts)))
    for i, t in enumerate(texts):
        assert np.allclose(together[i], ecoc.ngram_features(*text_bytes(pa.array([t], pa.string())))[0])
    assert np.allclose(together[0], together[5]) and not together[1].any()


def test_accuracy_on_held_out_documents(spark):
    docs = read(spark, "/root/testdata/sf0.01", "documents")
    got = ecoc.predict(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    assert (got["held_out"] == got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    assert (got["lang_pred"] == got["lang"])[got["held_out"]].mean() > 0.97
    assert got["score"].between(0, 1).all()


def test_prediction_ignores_its_own_label(spark):
    docs = read(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang", "source")
    held = docs.withColumn("lang", ecoc.F.when(ecoc.held_out("doc_id"), "zz").otherwise(docs.lang)).withColumn("source", ecoc.F.lit(None))
    assert sorted(map(tuple, ecoc.predict(docs).collect())) == sorted(map(tuple, ecoc.predict(held).collect()))


ROWS = [
    (1, "the cat and the dog of the house", "en", 0.5), (2, "le chat et le chien de la maison", "fr", 0.5), (3, None, "en", 0.5), (4, "", "fr", 0.5),
    (5, "123 -- !!", "en", 0.5), (None, "the house and the cat", "en", 0.5), (1, "the cat and the dog of the house", "en", 0.5), (7, "été " * 20000, None, 0.5),
]


def test_odd_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, score double")
    got = {(r.doc_id, r.lang_pred) for r in ecoc.predict(docs).collect()}
    assert {(3, "und"), (4, "und"), (5, "und")} <= got and len(ecoc.predict(docs).collect()) == len(ROWS)
    kept = ecoc.keep_identified(docs)
    assert kept.columns == docs.columns and not {3, 4, 5} & {r.doc_id for r in kept.collect()}


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, score double").withColumn("lang", ecoc.F.lit(None).cast("string"))
    assert {r.lang_pred for r in ecoc.predict(docs).collect()} == {"und"}
    assert ecoc.predict(docs.limit(0)).collect() == []


def test_one_language(spark):
    docs = spark.createDataFrame([(i, "some words", "en") for i in range(6)], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in ecoc.predict(docs).collect()} == {("en", 1.0)}
