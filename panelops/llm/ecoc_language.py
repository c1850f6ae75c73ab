"""Language identification with error-correcting output codes: every language has a codeword, binary
classifiers on character n-grams predict its bits, loss-weighted decoding picks the nearest codeword."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.llm.common import byte_table, fresh, text_bytes, with_columns

#: Hash buckets of n-grams.
BUCKETS = 4096
#: Labelled documents per language the classifiers are fitted on, at most (about; twice that in all).
SAMPLE = 400
UNDETERMINED = "und"
#: Least lead of the best codeword's score over the second's; below it a prediction is ambiguous.
LEAD = 0.05
LETTERS = byte_table(lambda b: 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)


def codewords(n: int, seed: int = 0) -> np.ndarray:
    """A row of +1 and -1 bits per language. Up to five languages: all ways to part them in two. More:
    the best separated of 50 random codes of 15 log2(n) bits."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        cuts = np.arange(1, 2 ** (n - 1))
        return np.where((cuts[None, :] >> np.arange(n)[:, None]) & 1, 1.0, -1.0)
    rng, bits = np.random.default_rng(seed), int(np.ceil(15 * np.log2(n)))
    best, apart = None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (n, bits))
        code = code[:, np.abs(code.sum(0)) < n]
        distance = (code.shape[1] - code @ code.T) / 2
        if (least := (distance + np.eye(n) * bits).min()) > apart:
            best, apart = code, least
    return best


@dataclass(frozen=True)
class Coder:
    """Fitted classifiers: weights and offset per bit, and the codewords of the languages."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def decode(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, its score, and its lead over the second. The score of a language
        falls with the logistic loss of its bits and scores add up to 1."""
        margins = features @ self.weights + self.offset
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None, :, :]).sum(2)
        part = np.exp(loss.min(1, keepdims=True) - loss)
        part /= part.sum(1, keepdims=True)
        order = np.argsort(-part, axis=1, kind="stable")
        rows = np.arange(len(part))
        first = part[rows, order[:, 0]]
        second = part[rows, order[:, 1]] if part.shape[1] > 1 else np.zeros(len(part))
        return order[:, 0], first, first - second


def ngram_features(data: np.ndarray, at: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Root of the counts of hashed byte bigrams, trigrams and 4-grams of the letters of whole texts, at
    length 1 a row. A-Z are lower-cased, everything else but letters beyond ASCII counts as a space."""
    folded = np.frombuffer(data.tobytes().translate(LETTERS), np.uint8).astype(np.uint32)
    out = np.zeros((len(at) - 1, buckets), np.float32)
    if len(folded) < 4:
        folded = np.concatenate([folded, np.full(4, 32, np.uint32)])
    shift = np.uint32(32 - int(np.log2(buckets)))
    two = folded[:-1] * np.uint32(257) + folded[1:]
    three = two[:-1] * np.uint32(263) + folded[2:]
    four = three[:-1] * np.uint32(269) + folded[3:]
    grams = [((g + np.uint32(salt)) * np.uint32(2654435761)) >> shift for salt, g in ((7, two), (11, three), (13, four))]
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        if b - a > 1:
            row = np.bincount(grams[0][a:b - 1], minlength=buckets)
            if b - a > 2:
                row += np.bincount(grams[1][a:b - 2], minlength=buckets)
            if b - a > 3:
                row += np.bincount(grams[2][a:b - 3], minlength=buckets)
            np.sqrt(row, out=out[i], casting="unsafe")
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(size > 0, size, 1)


def fit(labelled: DataFrame, text_col: str, lang_col: str, sample: int = SAMPLE, buckets: int = BUCKETS) -> Coder | None:
    """Fits the bit classifiers on a bounded sample: of every language about `sample` rows, those with the
    smallest hash of text and language, at most twice that times the number of languages in all. Rows
    without language, text or letter teach nothing. None if no row is left.
    """
    rows = labelled.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter(
        F.col("lang").isNotNull() & (F.length(F.trim("text")) > 0)
    )
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    rank = F.xxhash64("text", "lang")
    unit = (rank / F.lit(2.0 ** 64)) + 0.5
    share = F.lit(0.0)
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample / n))).otherwise(share)
    drawn = rows.filter(unit <= share).withColumn("rank", rank).orderBy("rank", "lang").limit(2 * sample * len(counts)).toPandas()
    languages = sorted(set(drawn["lang"])) or sorted(counts)[:1]
    if drawn.empty:
        return Coder(languages, codewords(1), np.zeros((buckets, 1), np.float32), np.zeros(1))
    features = np.concatenate([
        ngram_features(*text_bytes(pa.array(drawn["text"][a:a + 100], pa.string())), buckets) for a in range(0, len(drawn), 100)
    ])
    index = {lang: i for i, lang in enumerate(languages)}
    code = codewords(len(languages))
    wanted = code[[index[lang] for lang in drawn["lang"]]]
    weights, offset = logistic(features, wanted)
    return Coder(languages, code, weights, offset)


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 120, penalty: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regressions of all bits at once, by accelerated gradient steps. Rows have length 1."""
    n = len(x)
    w, b = np.zeros((x.shape[1], y.shape[1]), np.float32), np.zeros(y.shape[1])
    at_w, at_b, momentum = w, b, 1.0
    rate = 2.0 / (0.25 * 2 + penalty)
    for _ in range(steps):
        slope = -y / (1 + np.exp(y * (x @ at_w + at_b)))
        new_w = at_w - rate * ((x.T @ slope.astype(np.float32)) / n + penalty * at_w)
        new_b = at_b - rate * slope.mean(0)
        next_momentum = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        k = (momentum - 1) / next_momentum
        at_w, at_b = (new_w + k * (new_w - w)).astype(np.float32), new_b + k * (new_b - b)
        w, b, momentum = new_w.astype(np.float32), new_b, next_momentum
    return w, b


def identify(
    docs: DataFrame, coder: Coder | None, text_col: str = "text", lead: float = LEAD,
    names: tuple[str, str, str] = ("lang_pred", "score", "ambiguous"),
) -> DataFrame:
    """`docs` with the predicted language of the whole text, its score from 0 to 1, and whether the best
    codeword leads the second by less than `lead`. Texts that are NULL or have no letter are `und` with
    score 0 and count as ambiguous, as do all texts if nothing was learned. Models are small: languages
    times bits and buckets times bits.
    """
    place = docs.columns.index(text_col)
    lang, score, ambiguous = names
    if {n.lower() for n in names} & {c.lower() for c in docs.columns}:
        raise ValueError(f"the table has a column called as one of {names}")
    shared = docs.sparkSession.sparkContext.broadcast(coder)

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        column, fitted = batch.column(place), shared.value
        lettered = np.asarray([any(map(str.isalpha, t or "")) for t in column.to_pylist()], bool)
        if fitted is None or not len(column):
            n = len(column)
            return {lang: [UNDETERMINED] * n, score: [0.0] * n, ambiguous: [True] * n}
        data, at = text_bytes(column)
        index, best, ahead = np.empty(len(column), int), np.empty(len(column)), np.empty(len(column))
        for a in range(0, len(column), 200):
            b = min(a + 200, len(column))
            found = ngram_features(data[at[a]:at[b]], at[a:b + 1] - at[a], fitted.weights.shape[0])
            index[a:b], best[a:b], ahead[a:b] = fitted.decode(found)
        return {
            lang: [fitted.languages[i] if ok else UNDETERMINED for i, ok in zip(index.tolist(), lettered.tolist(), strict=True)],
            score: np.where(lettered, np.clip(best, 0, 1), 0.0).tolist(), ambiguous: (~lettered | (ahead < lead)).tolist(),
        }

    return with_columns(docs, run, f"`{lang}` string, `{score}` double, `{ambiguous}` boolean")


def held_out(id_col: str) -> F.Column:
    """One document in three, by the checksum of its id as text; a NULL id is the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def predict(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learns from the rows that are not held out and predicts all: doc_id, held_out, lang_pred, score."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    slim = slim.withColumn("held_out", held_out("doc_id"))
    coder = fit(slim.filter(~F.col("held_out")), "text", "lang")
    return identify(slim.select("doc_id", "held_out", "text"), coder).drop("text")


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Documents whose language was determined without ambiguity; all columns stay."""
    names = tuple(fresh(docs, n) for n in ("lang_pred", "lang_score", "lang_ambiguous"))
    coder = fit(docs.filter(~held_out(id_col)), text_col, lang_col)
    return identify(docs, coder, text_col, names=names).filter(~F.col(names[2])).drop(*names)
