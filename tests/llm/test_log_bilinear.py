from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from panelops.llm import log_bilinear as lm


def tokens_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def brute(docs):
    rest = {i: None if i is None else zlib.crc32(str(i).encode()) % 10 for i, _ in docs}
    counts = Counter(w for i, t in docs if rest[i] for w in tokens_of(t))
    total, kinds = sum(counts.values()), len(counts)
    rows = []
    for i, text in docs:
        own = tokens_of(text)
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in own)
        rows.append((i, None if rest[i] is None else rest[i] == 0, len(own), sum(counts[w] > 0 for w in own), total, round(base, 6)))
    return sorted(rows, key=str)


def corpus(n, seed=1):
    rng = random.Random(seed)
    made = [f"{a}{b}" for a in ("Ab", "çe", "x", "-", "don't") for b in ("", "s", "É.", "ing,")]
    texts = [" ".join(rng.choices(made, k=rng.randint(0, 40))) + rng.choice(["", "\n", "  "]) for _ in range(n)]
    texts += [None, "", " \t\r\n", "y" * 3000, "unheard\x0bof\x1fone word", texts[0], texts[0], "a b " * 20_000]
    return [*enumerate(texts), (3, "again the same id"), (None, "no id at all"), (-7, "ab abs")]


def scored(spark, docs, parts=3, **sizes):
    df = spark.createDataFrame([(i, t, 0, "w") for i, t in docs], "doc_id long, text string, row int, word string").repartition(parts)
    return lm.score(df, **sizes)


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 500, "own": 4, "shared": 3}])
def test_counts_and_base_against_brute_force(spark, sizes):
    docs = corpus(150)
    rows = scored(spark, docs, **sizes).collect()
    got = sorted(((*r[:5], round(r["base_score"], 6)) for r in rows), key=str)
    assert got == brute(docs)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in rows)


def test_no_rows_and_nothing_to_learn_from(spark):
    assert scored(spark, [], 1).collect() == []
    rows = scored(spark, [(None, "a b"), (None, None)], 1).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]


def chained(n, seed):
    """Texts in which one of two vocabularies follows itself, each word mostly followed by its successor."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind, w = rng.choice("pq"), rng.randrange(30)
        line = []
        for _ in range(40):
            w = (w + 1) % 30 if rng.random() < 0.8 else rng.randrange(30)
            line.append(f"{kind}{w}")
        out.append((i, " ".join(line)))
    return out


def test_context_helps_on_held_out_texts(spark):
    rows = scored(spark, chained(1500, 4)).filter("held_out").collect()
    gain = sum(r["score"] - r["base_score"] for r in rows) / sum(r["n_tokens"] for r in rows)
    assert len(rows) > 50 and gain > 0.4


def test_probabilities_of_all_tokens_add_up_to_one():
    rng = np.random.default_rng(1)
    counts, kinds = np.array([9.0, 30, 20, 40, 0]), np.array([1.0, 1, 1, 7, 0])
    classes = lm.Classes(2, counts, kinds)
    model = lm.Model.untrained(classes, 4, 1)
    model.targets[:] = rng.normal(0, 1, model.targets.shape)
    before = np.array([[5, 5], [0, 3], [2, 1]])
    total = np.exp(model.predictions(before) @ model.targets.T + model.biases - model.log_totals(before)[:, None])
    assert total.sum(1) == pytest.approx(np.ones(3), abs=1e-5)
    # Inside a shared class: its known words and one unseen word.
    words, within = [10, 10, 5, 5, 4, 4, 2], classes.within()
    assert (sum(words) + 0.1 * len(words) + 0.1) / within[3] == pytest.approx(1) and 0.1 / within[4] == pytest.approx(1)
    assert within[:3].tolist() == [0, 0, 0]


def test_piece_scores_are_the_softmax_token_by_token():
    rng = np.random.default_rng(2)
    classes = lm.Classes(3, np.ones(6), np.ones(6))
    model = lm.Model.untrained(classes, 3, 1)
    model.targets[:], model.contexts[:] = rng.normal(0, 1, model.targets.shape), rng.normal(0, 1, model.contexts.shape)
    kinds = np.array([6, 6, 1, 2, 5, 0, 6, 6, 0, 5, 0, 3], np.uint16)
    pieces = [lm.Piece(0, 0, True, False, 2, 6), lm.Piece(1, 1, True, False, 8, 9), lm.Piece(2, 2, True, False, 11, 12)]
    want = []
    for p in pieces:
        logs = 0.0
        for i in range(p.start, p.end):
            guess = model.contexts[kinds[i - 2]] @ model.places[0] + model.contexts[kinds[i - 1]] @ model.places[1]
            scores = model.targets @ guess + model.biases
            logs += scores[kinds[i]] - np.log(np.exp(scores).sum())
        want.append(logs / np.log(10))
    assert lm.piece_scores(pieces, kinds, model) == pytest.approx(want, abs=1e-4)


def test_long_texts_are_split_between_words():
    text = "one Two\tthree\n" * 1000
    assert [w for part in lm.words(text, 50) for w in part] == [w for part in lm.words(text) for w in part] == text.lower().encode().split()
