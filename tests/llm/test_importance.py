from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from panelops.llm import importance


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def features(text):
    words = words_of(text)
    return [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, items, least=20, percent=5):
    def counts(texts):
        out = [0] * 10_000
        for t in texts:
            for f in features(t):
                out[zlib.crc32(f.encode()) % 10_000] += 1
        return out

    s, t = counts(x for _, x in docs), counts(items)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10_000) / ((a + 1) * (sum(t) + 10_000)))) for a, b in zip(s, t, strict=True)]
    rows = []
    for i, text in docs:
        found = features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % 10_000] for f in found)
        h = None if i is None else int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        score = None if h is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(found), weight, score, None, len(words_of(text))])
    long_enough = sorted((r for r in rows if r[5] >= least), key=lambda r: (r[3] is None, -(r[3] or 0), r[0] or 0, r[2], r[1]))
    for place, r in enumerate(long_enough[:percent * len(long_enough) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=str)


def corpus(n, seed=1):
    rng = random.Random(seed)
    letters = ["ab", "Ça", "x9", "de-f", "GH", "ünd", "z"]
    texts = [" ".join("".join(rng.choices(letters, k=rng.randint(1, 3))) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    texts += [None, "", " \t\n", "...", "x" * 5000, texts[0], texts[0], "A b" * 30_000, "a b c\x00d"]
    return list(enumerate(texts))


def test_against_brute_force(spark):
    docs = corpus(120) + [(3, "same id " * 30), (None, "no id " * 40), (-5, "ab ab ab")]
    items = ["ab gh z", None, "", "Ça x9 de f", "ab gh z"]
    got = importance.resample(
        spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, row string, weight int").repartition(5),
        spark.createDataFrame([(t, 0) for t in items], "text string, no_id int"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_spans_of_a_long_text_are_cut_into_stretches():
    words = importance.collapsed("One  two, THREE four-five " * 50)
    whole = np.concatenate([b for _, b in importance.run_buckets(words)])
    parts = list(importance.run_buckets(words, at_once=7))
    assert sum(n for n, _ in parts) == 250 and np.array_equal(whole, np.concatenate([b for _, b in parts]))
    runs = [words[a:b].decode() for a, ends in importance.spans(words) for b in ends if b >= 0]
    assert sorted(runs) == sorted(features("One  two, THREE four-five " * 50))


@pytest.mark.parametrize("docs, items", [([], ["a b"]), (corpus(25, 3), []), ([], [])])
def test_empty_tables(spark, docs, items):
    got = importance.resample(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(t,) for t in items], "text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_target_like_documents_are_drawn(spark):
    """Of documents in two vocabularies, those of the target's are drawn."""
    rng = random.Random(5)
    first, second = [f"alpha{i}" for i in range(40)], [f"beta{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(first if i % 10 else second, k=50))) for i in range(400)]
    items = [(" ".join(rng.choices(second, k=30)),) for _ in range(30)]
    got = importance.resample(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "text string"))
    drawn = [r["doc_id"] for r in got.filter("rank is not null").collect()]
    assert len(drawn) == 20 and all(i % 10 == 0 for i in drawn)
