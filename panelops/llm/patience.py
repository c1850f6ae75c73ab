"""License scans by patience alignment: words unique to both a text and a template anchor it, the longest
increasing run of anchors is kept, and the gaps between anchors are aligned in the same way."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.llm.common import text_bytes, with_columns
from panelops.llm.suffix_automaton import words_of

#: Names and notices, public license statements.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so.",
}
#: Share of a template's words that must be aligned, in a stretch of the text of at most `STRETCH` its length.
COVERAGE = 0.85
STRETCH = 1.5


def rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs that rise in both places; `pairs` rise in the first."""
    ends: list[int] = []
    rows: list[int] = []
    back: list[int] = []
    for i, (_, b) in enumerate(pairs):
        k = bisect_left(ends, b)
        back.append(rows[k - 1] if k else -1)
        if k == len(ends):
            ends.append(b)
            rows.append(i)
        else:
            ends[k], rows[k] = b, i
    out, i = [], rows[-1] if rows else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def align(text: list[bytes], template: list[bytes]) -> list[tuple[int, int]]:
    """Aligned places (text, template), rising in both. Gaps are aligned in turn; equal words at their
    edges count as aligned where no unique word is left."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        in_text, in_template = Counter(text[a:b]), Counter(template[c:d])
        place = {w: i for i, w in enumerate(template[c:d], c) if in_template[w] == 1 and in_text.get(w) == 1}
        anchors = rising([(i, place[w]) for i, w in enumerate(text[a:b], a) if w in place])
        if not anchors:
            continue
        out += anchors
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        todo += [(x + 1, y, u + 1, v) for (x, u), (y, v) in zip(edges, edges[1:], strict=False)]
    return sorted(out)


class Scanner:
    """Finds the best template of a text. Every stretch of at most `STRETCH` a template's length that begins
    and ends with one of its words and holds enough of them, counted without order, is a candidate; those
    that cannot beat the best alignment so far are not aligned."""

    def __init__(self, templates: dict[str, str]):
        self.templates = {name: words_of(t.encode()) for name, t in sorted(templates.items())}
        self.needs = {name: Counter(words) for name, words in self.templates.items()}
        self.by_word: dict[bytes, list[str]] = defaultdict(list)
        for name, need in self.needs.items():
            for w in need:
                self.by_word[w].append(name)

    def best(self, words: list[bytes]) -> tuple[str, float, int, int] | None:
        """(name, coverage, start, end) of the best covered template; longer ones first at equal coverage,
        then the shortest stretch, then the first."""
        places: dict[str, list[int]] = defaultdict(list)
        for i, w in enumerate(words):
            for name in self.by_word.get(w, ()):
                places[name].append(i)
        found = []
        for name, at in places.items():
            if best := self._best_of(name, at, words):
                size = len(self.templates[name])
                n, start, end = best
                found.append((-n / size, -size, name, start, end))
        if not found:
            return None
        share, _, name, start, end = min(found)
        return name, -share, start, end

    def _best_of(self, name: str, at: list[int], words: list[bytes]) -> tuple[int, int, int] | None:
        """(aligned words, start, end) of the stretch with most words of a template aligned; `at` holds the
        places of its words."""
        template, need = self.templates[name], self.needs[name]
        least, widest = COVERAGE * len(template), int(STRETCH * len(template))
        if len(at) < least or (Counter(map(words.__getitem__, at)) & need).total() < least:
            return None
        best: tuple[int, int, int] | None = None
        for most, i, j in self._windows(at, least, widest, words, need):
            if best and (most < best[0] or best[2] - best[1] == best[0] == most):
                break
            have: dict[bytes, int] = defaultdict(int)
            n, start = 0, at[i]
            for place in at[i:j]:
                w = words[place]
                have[w] += 1
                n += have[w] <= need[w]
                end = place + 1
                if n < least or best and (n, start - end) <= (best[0], best[1] - best[2]):
                    continue
                pairs = align(words[start:end], template)
                if len(pairs) >= least:
                    here = (len(pairs), start + pairs[0][0], start + pairs[-1][0] + 1)
                    if not best or (here[0], here[1] - here[2], -here[1]) > (best[0], best[1] - best[2], -best[1]):
                        best = here
        return best

    def _windows(self, at: list[int], least: float, widest: int, words: list[bytes], need: Counter) -> list[tuple[int, int, int]]:
        """(words of the template without order, i, j) of the windows at[i:j] that hold enough, most first."""
        out, j, n = [], 0, 0
        have: dict[bytes, int] = defaultdict(int)
        for i, start in enumerate(at):
            while j < len(at) and at[j] < start + widest:
                w = words[at[j]]
                have[w] += 1
                n += have[w] <= need[w]
                j += 1
            if n >= least:
                out.append((n, i, j))
            w = words[start]
            n -= have[w] <= need[w]
            have[w] -= 1
        return sorted(out, key=lambda x: (-x[0], x[1]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] | None = None) -> DataFrame:
    """Per document: doc_id, license (NULL if none is covered), coverage, and the stretch of words [start,
    end) aligned with it. NULL and empty texts have none; rows with equal ids stay apart."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scanner = Scanner(templates or TEMPLATES)

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        data, at = text_bytes(batch.column(1))
        raw = data.tobytes()
        found = [scanner.best(words_of(raw[a:b])) or (None, 0.0, None, None) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        return dict(zip(("license", "coverage", "start", "end"), map(list, zip(*found, strict=True)), strict=True)) if found else {
            n: [] for n in ("license", "coverage", "start", "end")}

    return with_columns(slim, run, "license string, coverage double, start long, end long").drop("text")
