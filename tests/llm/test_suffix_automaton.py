from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from panelops.llm import suffix_automaton as sa

SEQUENCE = st.lists(st.sampled_from([b"a", b"b", b"c", b"x"]), max_size=12)


def brute(items, words, window):
    """Hit positions and names by comparing every window at every place."""
    hit, names = set(), set()
    for name, item in items:
        n = min(len(item), window)
        if not n:
            continue
        for i in range(len(item) - n + 1):
            for k in range(len(words) - n + 1):
                if words[k:k + n] == item[i:i + n]:
                    hit.update(range(k, k + n))
                    names.add(name)
    return hit, names


@settings(max_examples=300, deadline=None)
@given(st.lists(SEQUENCE, max_size=5), st.lists(st.sampled_from([b"a", b"b", b"c", b"x", b"out"]), max_size=40), st.integers(1, 5))
def test_scan_finds_what_comparison_finds(items, words, window):
    items = [(str(k), i) for k, i in enumerate(items)]
    spans, names = sa.SuffixAutomaton(items, window).scan(words)
    positions = [p for a, b in spans for p in range(a, b)]
    assert len(positions) == len(set(positions)) and spans == sorted(spans)
    assert (set(positions), names) == brute(items, words, window)


def test_walk_gives_longest_match_lengths():
    automaton = sa.SuffixAutomaton([("i", b"a b a b c".split()), ("k", b"b b a".split())], 2)
    ids = [automaton.vocabulary.get(w, automaton.alphabet - 1) for w in b"a b a b b a x b".split()]
    assert [n for _, n in automaton._walk(ids)] == [1, 2, 3, 4, 2, 3, 0, 1]


BENCH = [
    ("10", "The QUICK brown fox jumps over the lazy dog and runs away"), ("9", "short item here"), ("10", "alpha beta"),
    (None, "nameless words"), ("7", None), ("8", "..."),
]


def rows(spark, docs, block_words):
    d = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id long, text string, n_words int, item_id string")
    b = spark.createDataFrame(BENCH, "item_id string, text string")
    return d, b


@pytest.mark.parametrize("block_words", [10**6, 1])
def test_report_against_comparison(spark, block_words):
    rng = random.Random(1)
    pool = [t for _, t in BENCH if t] + ["filler Words été", "dog and", ""]
    docs = [(i, " . ".join(rng.choices(pool, k=rng.randint(0, 6)))) for i in range(40)]
    docs += [(40, None), (41, ""), (1, docs[1][1]), (None, "short, item-here!"), (42, "über short item here " * 5000)]
    d, b = rows(spark, docs, block_words)
    items = [(n, sa.words_of((t or "").encode())) for n, t in BENCH]
    expected = []
    for i, t in docs:
        words = sa.words_of((t or "").encode())
        hit, names = brute(items, words, 10)
        names.discard(None)
        expected.append((i, len(words), len(hit), len(names), sa.items_digest(names), bool(hit)))
    got = [tuple(r) for r in sa.report(d, b, block_words=block_words).collect()]
    key = lambda r: (r[0] is None, r)
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_no_benchmark_and_no_documents(spark):
    d, b = rows(spark, [(1, "short item here")], 10)
    assert [r.n_hit for r in sa.report(d, b.limit(0)).collect()] == [0]
    assert sa.report(d.limit(0), b).collect() == []
    assert sa.decontaminate(d.limit(0), b).columns == d.columns


@pytest.mark.parametrize("block_words", [10**6, 1])
def test_decontaminate_cuts_spans(spark, block_words):
    docs = [
        (1, "One two three four, Short  ITEM-here. five six seven eight"), (2, "short item here and"), (3, "all clean"), (4, None), (5, ""),
        (6, "a b c d alpha beta short item here alpha beta e f g h i j"),
    ]
    d, b = rows(spark, docs, block_words)
    out = sa.decontaminate(d, b, block_words=block_words)
    assert out.columns == d.columns
    assert {r.doc_id: r.text for r in out.collect()} == {
        1: "One two three four, . five six seven eight", 3: "all clean", 4: None, 5: "", 6: "a b c d  e f g h i j",
    }
    assert {r.doc_id for r in sa.decontaminate(d, b, max_words=9, max_coverage=1.0).filter("text = 'all clean' or doc_id = 2").collect()} == {2, 3}


@pytest.mark.parametrize("block_words", [10**6, 1])
def test_texts_pass_through_python_once(spark, block_words):
    d, b = rows(spark, [(1, "short item here and more"), (2, "all clean"), (3, None)], block_words)
    for out in (sa.decontaminate(d, b, block_words=block_words), sa.report(d, b, block_words=block_words)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("MapInArrow") == 1
