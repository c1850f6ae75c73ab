"""Importance resampling towards a target corpus by hashed word n-grams.

Texts are collapsed to words between single spaces; an overlapped scan then finds one match at every word,
whose groups end the spans of the runs of one, two and three words that begin there. The CRC-32 of each span
gives its bucket. The log ratio of a bucket's share in the target to its share in the corpus is its gain; a
document weighs the sum of its gains, and Gumbel noise from its id makes the highest scores a sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelops.llm.common import byte_table, fresh, map_batches
from panelops.operators.ranks import numbered
from panelops.staging import stage_table

BUCKETS = 10_000
#: Documents with fewer words are not drawn.
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Words whose spans are held at a time, so that long texts take no more memory than their bytes.
AT_ONCE = 50_000
#: a-z, 0-9 and everything beyond ASCII belongs to words.
WORD_BYTES = byte_table(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
SEPARATORS = regex.compile(rb" ++")
RUNS = regex.compile(rb"(?<![^ ])([^ ]++)(?![^ ])(?: ([^ ]++)(?![^ ])(?: ([^ ]++)(?![^ ]))?)?")


def collapsed(text: str) -> bytes:
    """The words of a text, A-Z in lower case, with one space between."""
    return SEPARATORS.sub(b" ", text.encode("utf-8", "replace").translate(WORD_BYTES)).strip(b" ")


def spans(words: bytes) -> Iterator[tuple[int, tuple[int, ...]]]:
    """For every word of a collapsed text where it starts, and where the runs of one, two and three words
    from it end; -1 if the text ends before."""
    for match in RUNS.finditer(words, overlapped=True):
        yield match.start(), match.end(1, 2, 3)


def run_buckets(words: bytes, buckets: int = BUCKETS, at_once: int = AT_ONCE) -> Iterator[tuple[int, np.ndarray]]:
    """Number of words and buckets of all runs from them, for stretches of at most `at_once` words; one empty
    stretch if there are no words."""
    found = spans(words)
    stretch = list(islice(found, at_once))
    while True:
        crcs = [crc32(words[a:b]) for a, ends in stretch for b in ends if b >= 0]
        yield len(stretch), (np.array(crcs, np.uint32) % buckets).astype(np.uint32)
        stretch = list(islice(found, at_once))
        if not stretch:
            return


def hashed_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(row, id, words, runs, buckets): the buckets of a document's runs as 16-bit numbers, in rows of at most
    AT_ONCE words; a document without words has one row. Stored, because two passes read it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            rows, ids, texts = batch.columns
            out: dict[str, list] = {n: [] for n in ("row", "id", "words", "runs", "buckets")}
            held = 0
            for row, doc, text in zip(rows, ids, texts, strict=True):
                for words, part in run_buckets(collapsed(text.as_py() or ""), buckets):
                    for name, x in zip(out, (row.as_py(), doc.as_py(), words, len(part), part.astype("<u2").tobytes()), strict=True):
                        out[name].append(x)
                    held += 2 * len(part)
                    if held >= 1 << 22:
                        yield out
                        out, held = {name: [] for name in out}, 0
            yield out

    if not 1 <= buckets <= 1 << 16:
        raise ValueError("buckets must fit 16 bits")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return stage_table(map_batches(rows, run, "row long, id long, words long, runs long, buckets binary"), "runs")


def bucket_counts(runs: DataFrame, name: str, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, `name`): runs per bucket; every task adds up its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in batch.column(0):
                total += np.bincount(np.frombuffer(part.as_py(), "<u2"), minlength=buckets)
        filled = np.flatnonzero(total)
        yield {"bucket": pa.array(filled), "n": pa.array(total[filled])}

    return map_batches(runs.select("buckets"), run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias(name))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket: thousandths of the log ratio of its smoothed share in the target to that
    in the corpus, rounded down."""
    counts = corpus.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    for table, name in ((corpus, "s"), (target, "t")):
        counts = counts.join(bucket_counts(table, name, buckets), "bucket", "left")
    s, t = F.coalesce("s", F.lit(0)), F.coalesce("t", F.lit(0))
    all_s, all_t = (x.agg(F.coalesce(F.sum("runs"), F.lit(0))).scalar() for x in (corpus, target))
    ratio = ((t + 1) * (all_s + buckets)).cast("double") / ((s + 1) * (all_t + buckets)).cast("double")
    return counts.select("bucket", F.floor(1000.0 * F.log(ratio)).alias("gain"))


def weights(runs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(row, id, words, runs, weight): the gains of a document's runs added up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            found = [int(gain[np.frombuffer(x.as_py(), "<u2")].sum()) for x in batch.column(4)]
            yield {n: batch.column(i) for i, n in enumerate(("row", "id", "words", "runs"))} | {"weight": found}

    parts = map_batches(runs, run, "row long, id long, words long, runs long, weight long")
    sums = [F.sum(n).alias(n) for n in ("words", "runs", "weight")]
    return parts.groupBy("row").agg(F.first("id").alias("id"), *sums)


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel number that the id and the seed alone decide."""
    text = F.concat(F.lit(f"{seed}:"), id_col.cast("string"))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED,
    id_col: str = "doc_id", text_col: str = "text", target_text: str = "text", buckets: int = BUCKETS,
) -> DataFrame:
    """Every document with doc_id, n_features, weight, score and rank: `percent` in a hundred of those with at
    least `least_words` words are drawn and ranked 1, 2, .. by score, the smaller id first in a tie.

    NULL and empty texts have no features, weight 0, and are not drawn. A NULL id has no score and comes
    last; rows of one id are documents of their own, told apart by weight, features and the order of the
    table. Only the named columns are read, so other columns may have any name. Empty tables give no rows,
    an empty target smoothed gains.

    Two counted tables of at most `buckets` rows go through the driver; ranks are numbered by range buckets.
    """
    runs = hashed_runs(docs, id_col, text_col, buckets)
    no_id = fresh(target, "no_id")
    wanted = hashed_runs(target.withColumn(no_id, F.lit(None).cast("long")), no_id, target_text, buckets)
    gain = np.zeros(buckets, np.int64)
    for r in gains(runs, wanted, buckets).collect():  # one row a bucket
        gain[r["bucket"]] = r["gain"]
    scored = stage_table(weights(runs, gain).withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "scored")
    long_enough = scored.filter(F.col("words") >= least_words)
    drawn = long_enough.count() * percent // 100
    order = [F.col("score").isNull(), -F.col("score"), F.col("id"), F.col("weight"), F.col("runs"), F.col("row")]
    rank = F.when(F.col("place") <= drawn, F.col("place"))
    ranked = numbered(long_enough, order, "place").withColumn("rank", rank).drop("place")
    rest = scored.filter(F.col("words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select(
        F.col("id").alias("doc_id"), F.col("runs").alias("n_features"), "weight", "score", "rank")
