from __future__ import annotations

import random
import re
from itertools import combinations

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelops.llm import jaccard_orders as jo
from panelops.llm.common import text_bytes
from panelops.llm.components import components


def shingles(text, n=3):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def brute(rows, percent=90):
    """Links by comparing all pairs, then components."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(doc_id, len(s), least.get(find(i))) for i, ((doc_id, _), s) in enumerate(zip(rows, sets, strict=True))]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aAbéß \t\n\x0b\x1c中İ", max_size=25), max_size=6))
def test_set_sizes_and_overlaps(texts):
    got = [set(s.tolist()) for s in jo.shingle_sets(*text_bytes(pa.array(texts, pa.string())))]
    want = [shingles(t) for t in texts]
    assert [len(s) for s in got] == [len(s) for s in want]
    for (a, b), (c, d) in zip(combinations(got, 2), combinations(want, 2), strict=True):
        assert len(a & b) == len(c & d)


def test_long_words_differ_beyond_the_table():
    a, b = "x" * 70 + "ab", "x" * 70 + "ba"
    one, two = jo.shingle_sets(*text_bytes(pa.array([a, b])))
    assert one[0] != two[0]


def corpus(seed, n=60):
    """Random texts, near copies of some at several distances, chains of near copies, exact copies."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)] + ["the"] * 40
    texts = [" ".join(rng.choices(words, k=rng.choice([1, 2, 3, 9, 30, 80]))) for _ in range(n)]
    for k in range(n):
        t = rng.choice(texts).split()
        for _ in range(rng.choice([0, 1, 1, 2])):
            t[rng.randrange(len(t))] = f"n{k}"
        texts.append(" ".join(t))
    passage = " ".join(f"p{k}" for k in range(12))
    texts += [f"{t} {passage}" for t in texts[:20]] + ["", None, " \n", "The The the", "the the THE"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return [*rows, rows[3], (None, "no id at all here"), (rows[5][0], "other text of an id that is there")]


@pytest.mark.parametrize("pairs_per_row", [4, 0])
@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_all_pairs(spark, seed, pairs_per_row):
    rows = corpus(seed)
    docs = spark.createDataFrame([(t, i, 1, b"") for i, t in rows], "text string, doc_id long, n_set int, digest binary")
    got = [tuple(r) for r in jo.join(docs, pairs_per_row=pairs_per_row).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_group_of_near_copies_is_compared_about_once_each(spark):
    base = [f"b{k}" for k in range(100)]
    rows = [(k, " ".join(base[:50] + [f"own{k}"] + base[51:])) for k in range(1, 300)] + [(0, " ".join(base))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.component_id for r in jo.join(docs).collect()} == {0}


def test_keep_one(spark):
    rows = corpus(3)[:-1]
    docs = spark.createDataFrame([(t, i, "x") for i, t in rows], "text string, doc_id long, digest string")
    kept = jo.keep_one(docs).collect()
    expected = brute(rows)
    empty = sum(not n for _, n, _ in expected)
    assert jo.keep_one(docs).columns == docs.columns
    assert len(kept) == empty + len({c for _, n, c in expected if n})
    assert sorted(r.doc_id for r in kept if shingles(r.text) and r.doc_id is not None) == sorted({c for _, n, c in expected if n and c is not None})


def test_pipeline_stage_takes_five_words_and_four_fifths(spark, monkeypatch):
    import corpus_pipeline

    three = shingles
    monkeypatch.setitem(globals(), "shingles", lambda text, n=5: three(text, n))
    rows = corpus(4)[:-2]
    for k in range(20):  # five-word similarity 86 / 106, three-word similarity 92 / 104
        text = [f"s{k}x{i}" for i in range(100)]
        rows += [(1000 + k, " ".join(text)), (2000 + k, " ".join([*text[:30], "new", *text[31:60], "words", *text[61:]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    expected = brute(rows, 80)
    assert sorted(r.doc_id for r in kept if shingles(r.text)) == sorted({c for _, n, c in expected if n})
    assert len(kept) == sum(not n for _, n, _ in expected) + len({c for _, n, c in expected if n})
    assert not {r.doc_id for r in kept} & set(range(2000, 2020))


def test_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jo.join(docs).collect() == [] and jo.keep_one(docs).collect() == []


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 220)]
    star = [(7, i) for i in range(8, 60)]
    edges = spark.createDataFrame(chain + star + [(1, 1)], "a long, b long")
    labels = {r.node: r.label for r in components(edges).collect()}
    assert labels == {i: 100 for i in range(100, 221)} | {i: 7 for i in range(7, 60)} | {1: 1}


def test_bit_tables_bound_the_overlap(spark):
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.choice([3, 30, 36, 70, 400]))) for _ in range(40)]
    sets = list(jo.shingle_sets(*text_bytes(pa.array(texts))))
    rows = [(i, len(s), jo.bitmap(s).tolist()) for i, s in enumerate(sets)]
    d = spark.createDataFrame(rows, "i int, n long, bits array<long>")
    pairs = d.toDF("i", "na", "ba").crossJoin(d.toDF("j", "nb", "bb")).filter("size(ba) between size(bb) / 2 and size(bb) * 2")
    most = pairs.select("i", "j", jo.most_common(jo.F.col("na"), jo.F.col("nb"), jo.F.col("ba"), jo.F.col("bb")).alias("most")).collect()
    for r in most:
        common = len(set(sets[r.i].tolist()) & set(sets[r.j].tolist()))
        assert common <= r.most <= min(len(sets[r.i]), len(sets[r.j]))


def staged(monkeypatch):
    """The tables the operator stores, by name; its listed pairs and links can be counted."""
    found, store = {}, jo.stage_table

    def kept(df, name):
        found.setdefault(name, []).append(out := store(df, name))
        return out

    monkeypatch.setattr(jo, "stage_table", kept)
    return found


def test_unlike_documents_that_share_passages_are_not_listed(spark, monkeypatch):
    halves = [[[f"{side}{i}x{k}" for k in range(30)] for i in range(20)] for side in "ab"]
    rows = [(20 * i + j, " ".join(a + b)) for i, a in enumerate(halves[0]) for j, b in enumerate(halves[1])]
    rows.append((1000, f"{rows[7][1]} end"))
    tables = staged(monkeypatch)
    got = {r.doc_id: r.component_id for r in jo.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: k for k in range(400)} | {1000: 7}
    assert sum(t.count() for t in tables["pairs"]) <= 2 * len(rows)  # of 7 600 that share a half


def test_groups_of_copies_that_are_all_alike_are_linked_about_once_each(spark, monkeypatch):
    rng, rows = random.Random(9), []
    for g in range(20):
        base = [f"g{g}x{k}" for k in range(200)]
        for k in range(12):
            copy = list(base)
            copy[rng.randrange(200)] = f"own{g}x{k}"
            rows.append((100 * g + k, " ".join(copy)))
    tables = staged(monkeypatch)
    got = {r.doc_id: r.component_id for r in jo.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: k // 100 * 100 for k, _ in rows}
    assert sum(t.count() for t in tables["links"]) <= 2 * len(rows)  # of 1 320 pairs


@pytest.mark.parametrize("percent", [50, 80, 90, 100])
def test_places_and_parities_lose_no_pair(spark, percent):
    rng, texts = random.Random(percent), []
    for k in range(12):
        base = [f"w{k}x{i}" for i in range(rng.choice([4, 12, 50, 120]))]
        texts += [" ".join(base)] + [" ".join(base[:a] + ["own"] * rng.randrange(3) + base[a + rng.randrange(4):]) for a in rng.sample(range(len(base)), 4)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(t, i) for i, t in rows], "text string, doc_id long")
    got = [tuple(r) for r in jo.join(docs, percent=percent).collect()]
    assert sorted(got) == sorted(brute(rows, percent))


def test_parity_tables_differ_by_no_more_bits_than_the_sets():
    rng = random.Random(6)
    texts = [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.choice([1, 3, 30, 300, 2000]))) for _ in range(40)]
    sets = list(jo.shingle_sets(*text_bytes(pa.array(texts))))
    for a, b in combinations(sets, 2):
        bits = sum(int(x).bit_count() for x in (jo.parities(a) ^ jo.parities(b)).view("uint64").tolist())
        assert bits <= len(set(a.tolist()) ^ set(b.tolist()))
