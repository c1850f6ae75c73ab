"""Benchmark decontamination: a generalised suffix automaton of the test items, through which the words
of every document are streamed."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelops.llm.common import byte_table, fresh, text_bytes, with_columns

WINDOW = 10
#: Words of test items one automaton holds; a larger benchmark is streamed against in blocks.
BLOCK_WORDS = 1_000_000
#: Words: runs of 0-9, a-z (after lower-casing A-Z) and all characters beyond ASCII.
WORD_BYTES = byte_table(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCAN = "{words} long, {spans} array<int>, {items} array<string>"


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(WORD_BYTES).split()


class SuffixAutomaton:
    """All word sequences that occur in some item. State 0 is the empty sequence; `step` holds the
    transitions by state * alphabet + word."""

    def __init__(self, items: Iterable[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        coded = [(name, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]) for name, words in items if words]
        self.alphabet = len(self.vocabulary) + 1  # the last one stands for all words that no item has
        self.step: dict[int, int] = {}
        self.link, self.length = [-1], [0]
        self.out: list[dict[int, int]] = [{}]
        for _, words in coded:
            last = 0
            for w in words:
                last = self._extend(last, w)
        for state, moves in enumerate(self.out):
            for w, to in moves.items():
                self.step[state * self.alphabet + w] = to
        del self.out
        self.shorter = sorted({len(words) for _, words in coded if len(words) < window})
        self.shortest = min([window] * any(len(words) >= window for _, words in coded) + self.shorter, default=0)
        #: Items by the state of a window, and whole items shorter than a window by state and length.
        self.windows: dict[int, set[str | None]] = {}
        self.whole: dict[tuple[int, int], set[str | None]] = {}
        for name, words in coded:
            for at, (state, length) in enumerate(self._walk(words)):
                if length >= window:
                    self.windows.setdefault(self._suffix(state, window), set()).add(name)
                elif at == len(words) - 1 < window - 1:
                    self.whole.setdefault((self._suffix(state, len(words)), len(words)), set()).add(name)

    def _extend(self, last: int, w: int) -> int:
        """The state of `last` followed by `w`, added where it is missing."""
        known = self.out[last].get(w)
        if known is not None:
            if self.length[known] == self.length[last] + 1:
                return known
            return self._split(last, w, known)
        state = self._state(self.length[last] + 1, {})
        at = last
        while at != -1 and w not in self.out[at]:
            self.out[at][w] = state
            at = self.link[at]
        if at == -1:
            self.link[state] = 0
        else:
            known = self.out[at][w]
            self.link[state] = known if self.length[known] == self.length[at] + 1 else self._split(at, w, known)
        return state

    def _state(self, length: int, moves: dict[int, int]) -> int:
        self.link.append(0)
        self.length.append(length)
        self.out.append(moves)
        return len(self.link) - 1

    def _split(self, at: int, w: int, known: int) -> int:
        """A state for the shorter sequences of `known`."""
        short = self._state(self.length[at] + 1, dict(self.out[known]))
        self.link[short], self.link[known] = self.link[known], short
        while at != -1 and self.out[at].get(w) == known:
            self.out[at][w] = short
            at = self.link[at]
        return short

    def _walk(self, words: Iterable[int]) -> Iterator[tuple[int, int]]:
        """After each word: the state and length of the longest sequence of items that ends there."""
        step, link, size, wide = self.step, self.link, self.length, self.alphabet
        state = length = 0
        for w in words:
            to = step.get(state * wide + w)
            while to is None and state:
                state = link[state]
                length = size[state]
                to = step.get(state * wide + w)
            if to is None:
                length = 0
            else:
                state, length = to, length + 1
            yield state, length

    def _suffix(self, state: int, length: int) -> int:
        """The state of the last `length` words of a sequence of `state`."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str | None]]:
        """Merged spans [start, end) of words inside occurrences of windows, and the items they are of.

        Only runs of item words as long as the shortest window are streamed: any other word takes the
        automaton back to its empty state.
        """
        spans: list[tuple[int, int]] = []
        found: set[str | None] = set()
        if not self.shortest or len(words) < self.shortest:
            return spans, found
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int32, len(words))
        stops = np.concatenate([[-1], np.flatnonzero(ids < 0), [len(ids)]])
        for k in np.flatnonzero(np.diff(stops) > self.shortest).tolist():
            begin = int(stops[k]) + 1
            for at, (state, length) in enumerate(self._walk(ids[begin:stops[k + 1]].tolist()), begin + 1):
                if length < self.shortest:
                    continue
                hit = 0
                if length >= self.window and (names := self.windows.get(self._suffix(state, self.window))):
                    found |= names
                    hit = self.window
                for n in self.shorter:
                    if n <= length and (names := self.whole.get((self._suffix(state, n), n))):
                        found |= names
                        hit = max(hit, n)
                if hit:
                    if spans and at - hit <= spans[-1][1]:
                        low = at - hit
                        while len(spans) > 1 and low <= spans[-2][1]:
                            spans.pop()
                        spans[-1] = (min(low, spans[-1][0]), at)
                    else:
                        spans.append((at - hit, at))
        return spans, found


def automata(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int) -> Iterator[SuffixAutomaton]:
    """Automata over blocks of items; the driver holds one block at a time."""
    block, size = [], 0
    for name, text in benchmark.select(F.col(id_col).cast("string"), text_col).toLocalIterator():
        words = words_of((text or "").encode())
        if block and size + len(words) > block_words:
            yield SuffixAutomaton(block, window)
            block, size = [], 0
        block.append((name, words))
        size += len(words)
    yield SuffixAutomaton(block, window)


def scan(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, str, str, str]:
    """`docs` with three new columns, whose names are returned too: number of words, merged spans of hit
    words as [start, end, start, end, ...], and the ids of the items that have occurring windows.

    A window is `window` consecutive words of an item, or a whole shorter item. NULL texts have no words
    and no hits; items with a NULL id hit words and are not listed. Every row is scanned for itself, so
    repeated ids stay apart. No shuffle; a broadcast automaton holds `block_words` words and one item at most.
    """
    return _scan(docs, benchmark, text_col, item_col, item_text_col, window, block_words)[:4]


def _scan(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, block_words: int = BLOCK_WORDS, max_words: int | None = None,
) -> tuple[DataFrame, str, str, str, str]:
    """`scan`, and with `max_words` the text without longer spans where there are any, in a column of its
    own. One pass over the texts for all blocks: every further Python step of a task is a worker more."""
    n_words, spans, items, new = (fresh(docs, c) for c in ("n_words", "hit_spans", "hit_items", "cut_text"))
    context, place = docs.sparkSession.sparkContext, docs.columns.index(text_col)
    shared: list[Broadcast] = [context.broadcast(a) for a in automata(benchmark, item_col, item_text_col, window, block_words)]

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        data, at = text_bytes(batch.column(place))
        raw, out = data.tobytes(), {c: [] for c in (n_words, spans, items, new)}
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            words, found, names = words_of(raw[a:b]), [], set()
            for automaton in shared:
                hits, ids = automaton.value.scan(words)
                found += [x for s in hits for x in s]
                names |= ids
            out[n_words].append(len(words))
            out[spans].append(found)
            out[items].append(sorted(n for n in names if n is not None))
            out[new].append(without(raw[a:b].decode(), found, max_words) if found and max_words is not None else None)
        return out

    done = with_columns(docs, run, SCAN.format(words=n_words, spans=spans, items=items) + f", `{new}` string")
    return (done if max_words is not None else done.drop(new)), n_words, spans, items, new


def hit_words(spans: Column) -> Column:
    """Words covered by spans, which passes over several blocks may give twice and out of order."""
    pairs = F.transform(F.sequence(F.lit(0), (F.size(spans) / 2).cast("int") - 1), lambda i: F.struct(
        F.get(spans, 2 * i).alias("a"), F.get(spans, 2 * i + 1).alias("b")))
    pairs = F.when(F.size(spans) > 0, F.array_sort(pairs)).otherwise(F.slice(pairs, 1, 0))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    return F.aggregate(pairs, start, lambda s, p: F.struct(
        (s["n"] + F.greatest(F.lit(0), p["b"] - F.greatest(s["end"], p["a"]))).alias("n"),
        F.greatest(s["end"], p["b"]).alias("end"),
    ), lambda s: s["n"].cast("long"))


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: words, hit words, items found with a digest of their ids, and whether any is hit."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    done, n_words, spans, items = scan(slim, benchmark, **options)
    hits = hit_words(F.col(spans))
    return done.select(
        "doc_id", F.col(n_words).alias("n_words"), hits.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(spans) > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", max_words: int = 0, max_coverage: float = 0.5, **options
) -> DataFrame:
    """Documents without hit spans of over `max_words` words; those with a larger part of their words
    hit than `max_coverage` go as a whole. Clean documents and NULL texts stay as they are. Columns stay.
    """
    done, n_words, spans, _, new = _scan(docs, benchmark, text_col, max_words=max_words, **options)
    text = F.when(F.size(spans) > 0, F.col(f"`{new}`")).otherwise(F.col(f"`{text_col}`"))
    return done.filter(hit_words(F.col(spans)) <= max_coverage * F.col(n_words)).select(*[
        text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns
    ])


def without(text: str, spans: list[int], max_words: int) -> str:
    """The text without the characters from the first to the last word of each span."""
    merged: list[list[int]] = []
    for a, b in sorted(zip(spans[::2], spans[1::2], strict=True)):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    words = [m.span() for m in WORD.finditer(text)]
    kept, end = [], 0
    for a, b in merged:
        if b - a > max_words:
            kept.append(text[end:words[a][0]])
            end = words[b - 1][1]
    return "".join([*kept, text[end:]])


def items_digest(names: Iterable[str]) -> str:
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
