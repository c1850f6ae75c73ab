from __future__ import annotations

import random
import string
import time
from hashlib import sha256

import numpy as np

from panelops.llm import markov_secrets as ms

AKIA = "AKIA" + "Q7" * 8
HEX = "0123456789abcdef" * 2


def test_base_patterns():
    text = f'é Password = "abcdefgh"; ſecret=abcdefgh1 api-key=abcdefgh1 APIKEY:short token=\'x token="abcd.efgh" {AKIA} {HEX}g {HEX[:-1]}'
    got = [(ms.KINDS[k], text[a:b]) for a, k, b in ms.base_spans(text)]
    assert got == [("assign", 'Password = "abcdefgh'), ("assign", 'token="abcd.efgh'), ("access", AKIA), ("hex", HEX)]


def corpus(spark):
    rng = random.Random(4)
    made = lambda n: "".join(rng.choices(string.ascii_letters + string.digits, k=n))
    words = ["internationalization_of_the_thing", "the", "configuration", "somethingverylongindeedhere", "of", "and", "another", "underneath"]
    rows = [(i, " ".join(rng.choices(words, k=3000)) + f' token = "{made(40)}"') for i in range(40)]
    rows += [(100, f"here is {made(40)} and that"), (101, "internationalization_of_the_thing"), (102, None), (103, ""), (None, HEX), (1, "the " * 90000)]
    return rows, spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, n_hex int")


def test_models_add_random_strings_only(spark):
    rows, docs = corpus(spark)
    got = {r.doc_id: r for r in ms.scan(docs).collect()}
    assert len(ms.scan(docs).collect()) == len(rows)
    assert got[100].spans == "random:8:48" and got[101].spans == "" and got[102].spans == "" and got[None].spans == "hex:0:32"
    assert got[100].base_sha256 == sha256(b"").hexdigest() and got[None].base_sha256 == sha256(b"hex:0:32").hexdigest()
    assert all(got[i].spans.count("assign") == 1 and "random" not in got[i].spans for i in range(2, 40))


def test_runs_that_touch_base_spans():
    rng, ratio = random.Random(7), np.ones(ms.STATES ** 2)
    for _ in range(300):
        text = "".join(rng.choices(["x" * 25, " ", "token=abcdefgh1", AKIA, HEX, "é", "-" * 20], k=rng.randint(0, 25)))
        base = ms.base_spans(text)
        want = [(m.start(), 3, m.end()) for m in ms.RUN.finditer(text) if all(m.end() <= a or b <= m.start() for a, _, b in base)]
        assert ms.random_spans(text, base, ratio, 15.0) == want


def test_many_spans_take_linear_time():
    text = f"token=abcdefgh1 {'x' * 25} " * 20_000
    begin = time.perf_counter()
    assert len(ms.random_spans(text, ms.base_spans(text), np.ones(ms.STATES ** 2), 15.0)) == 20_000
    assert time.perf_counter() - begin < 5


def test_nothing_known(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ms.scan(docs).collect() == []
