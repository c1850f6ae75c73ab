"""Secret scans: patterns of known kinds, and strings that a character Markov model of random strings
explains far better than one of ordinary text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.llm.common import map_batches, texts_of, with_columns

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")
NAMES = ("password", "passwd", "secret", "token", "api")
HEX_BYTES = bytes(104 if 48 <= b <= 57 or 97 <= b <= 102 else 32 for b in range(256))
#: Characters of candidates, the states of the models; every other character is state 0.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
STATE = np.zeros(256, np.int64)
STATE[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(1, len(ALPHABET) + 1)
STATES = len(ALPHABET) + 1
RUN_BYTES = bytes(120 if STATE[b] else 32 for b in range(256))
#: Least length of a candidate, and least log-likelihood ratio for it to count as random.
LEAST_RUN = 20
RUN = re.compile(rf"[A-Za-z0-9+/_-]{{{LEAST_RUN},}}", re.ASCII)
THRESHOLD = 15.0
#: Counts every move has beforehand, in ordinary text and in random strings, which are uniform unless many show otherwise.
SMOOTHING = (10.0, 10.0)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the known kinds, leftmost and non-overlapping per kind, in order."""
    spans = []
    low = text.lower()
    if any(n in low for n in NAMES):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    if b"h" * 32 in text.encode().translate(HEX_BYTES):
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 32]
    return sorted(spans)


def moves(text: str) -> np.ndarray:
    """Numbers of the character pairs of a text, from state to state."""
    states = STATE[np.frombuffer(text.encode(), np.uint8)]
    return states[:-1] * STATES + states[1:]


def learn(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Log-probabilities of moves in random strings and in ordinary text. The values of the base matches
    are the sample of random strings, all text outside the matches is that of ordinary ones; pairs are
    counted over all documents, each task sending one count per pair and kind at most.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        total = np.zeros((2, STATES * STATES), np.int64)
        for batch in batches:
            for text in texts_of(batch.column(0)):
                at, ordinary = 0, []
                for a, kind, b in base_spans(text):
                    value = ASSIGN.match(text, a)[2] if kind == 0 else text[a:b]
                    total[1] += np.bincount(moves(value), minlength=STATES * STATES)
                    ordinary.append(text[at:a])
                    at = max(at, b)
                ordinary.append(text[at:])
                total[0] += np.bincount(moves("\n".join(ordinary)), minlength=STATES * STATES)
        kind, move = np.nonzero(total)
        yield {"kind": pa.array(kind, pa.int32()), "move": pa.array(move, pa.int32()), "n": pa.array(total[kind, move])}

    sent = map_batches(docs.select(F.col(text_col).cast("string")), count, "kind int, move int, n long")
    sums = np.repeat(SMOOTHING, STATES * STATES).reshape(2, STATES, STATES)
    for row in sent.groupBy("kind", "move").agg(F.sum("n").alias("n")).collect():  # STATES ** 2 of each kind at most
        sums[row["kind"], row["move"] // STATES, row["move"] % STATES] += row["n"]
    inner = sums[:, 1:, 1:]
    logs = np.zeros_like(sums)
    logs[:, 1:, 1:] = np.log(inner / inner.sum(2, keepdims=True))
    return logs[1].reshape(-1), logs[0].reshape(-1)


def random_spans(text: str, base: list[tuple[int, int, int]], ratio: np.ndarray, threshold: float) -> list[tuple[int, int, int]]:
    """Runs of at least `LEAST_RUN` characters that touch no base match and whose ratio is above the threshold."""
    if b"x" * LEAST_RUN not in text.encode().translate(RUN_BYTES):
        return []
    found, at, reach = [], 0, 0
    for m in RUN.finditer(text):
        # Base spans are in the order of their starts: those that begin before the run ends touch it if one reaches into it.
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][2])
            at += 1
        if reach <= m.start() and ratio[moves(m[0])].sum() > threshold:
            found.append((m.start(), 3, m.end()))
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans. Places are code points of the
    whole text; NULL and empty texts have no spans. Rows with equal ids stay apart. Without any base match
    random strings count as uniform."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    of_random, of_ordinary = learn(slim)
    shared = docs.sparkSession.sparkContext.broadcast(of_random - of_ordinary)

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {n: [] for n in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
        for text in texts_of(batch.column(1)):
            base = base_spans(text)
            kinds = [kind for _, kind, _ in base]
            for k, n in enumerate(("n_assign", "n_access", "n_hex")):
                out[n].append(kinds.count(k))
            out["base_sha256"].append(sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(sorted(base + random_spans(text, base, shared.value, threshold))))
        return out

    return with_columns(slim, run, "n_assign long, n_access long, n_hex long, base_sha256 string, spans string").drop("text")
