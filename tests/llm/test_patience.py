from __future__ import annotations

import random

from hypothesis import given, settings
from hypothesis import strategies as st

from panelops.llm import patience


@settings(max_examples=200, deadline=None)
@given(st.permutations(range(9)))
def test_rising_is_longest(order):
    got = patience.rising(list(enumerate(order)))
    assert got == sorted(got) and [b for _, b in got] == sorted(b for _, b in got)
    best = [1] * len(order)
    for i in range(len(order)):
        best[i] += max((best[j] for j in range(i) if order[j] < order[i]), default=0)
    assert len(got) == max(best)


@settings(max_examples=200, deadline=None)
@given(*[st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), max_size=12)] * 2)
def test_alignment_pairs_equal_words_in_order(text, template):
    pairs = patience.align(text, template)
    assert all(text[a] == template[b] for a, b in pairs)
    assert all(x < y and u < v for (x, u), (y, v) in zip(pairs, pairs[1:], strict=False))
    if text == template:
        assert len(pairs) == len(text)


def test_documents(spark):
    rng = random.Random(2)
    prose = lambda n: " ".join(rng.choices(["the", "of", "license", "and", "work", "storm", "this", "under", "version"], k=n))
    mit = patience.TEMPLATES["MIT"]
    long = patience.TEMPLATES["MIT-text"].replace("merge, publish, ", "")
    rows = [
        (1, f"{prose(300)}\n{mit}", "MIT"), (2, f"{mit}\n{prose(40)}\n{mit}", "MIT"), (3, prose(400), None), (4, None, None), (5, "", None),
        (6, f"x y z. {long} the end", "MIT-text"), (7, patience.TEMPLATES["GPL-3.0"].upper() + " 30", "GPL-3.0"), (8, "Released under a license", None),
        (8, f"storm {mit}", "MIT"), (None, "Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"), (9, ("rain and sun " * 50000) + mit, "MIT"),
    ]
    docs = spark.createDataFrame([(i, t, "q") for i, t, _ in rows], "doc_id long, text string, license string")
    got = patience.scan(docs)
    key = lambda r: (r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.license) for r in got.collect()), key=key) == sorted(((i, x) for i, _, x in rows), key=key)
    six = got.filter("doc_id = 6").first()
    assert six.coverage > 0.9 and six.start == 3
    assert patience.scan(docs.limit(0)).collect() == []


def test_neighbours_that_repeat_edge_words():
    scanner = patience.Scanner(patience.TEMPLATES)
    name, share, start, end = scanner.best(patience.words_of(b"The project is released under the MIT License. See the LICENSE file"))
    assert (name, share, start, end) == ("MIT", 1.0, 3, 8)
    for name, words in scanner.templates.items():
        a, z = words[0], words[-1]
        for before in ([a], [a, b"x"], [z, b"x", a, b"y", a], [*words[:3], b"x"]):
            for after in ([z], [b"x", z], [b"y", z, b"x", a, z], [b"x", *words[-3:]]):
                assert scanner.best([*before, *words, *after]) == (name, 1.0, len(before), len(before) + len(words)), (name, before, after)


def test_copies_that_lack_a_word_which_stands_elsewhere():
    rng = random.Random(1)
    prose = lambda n: " ".join(rng.choices(["the", "of", "to", "and", "in", "a", "storm"], k=n))
    text = patience.TEMPLATES["MIT-text"]
    granted, lend = text.replace("Permission", "Authorization", 1).replace("permit", "allow"), text.replace("sublicense", "lend")
    scanner = patience.Scanner(patience.TEMPLATES)
    name, share, start, end = scanner.best(patience.words_of(f"{prose(500)} permission {prose(300)} {granted} {prose(400)}".encode()))
    assert name == "MIT-text" and 0.95 < share < 1 and 801 <= start <= 802 and end == 863
    name, share, start, end = scanner.best(patience.words_of(f"{lend} {prose(300)} sublicense {prose(200)} {lend}".encode()))
    assert name == "MIT-text" and 0.95 < share < 1 and (start, end) == (0, 62)
