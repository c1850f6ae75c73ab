"""Mixing documents to target weights of domains, to which documents belong softly.

A naive Bayes classifier learned from the labelled documents gives every document its domain
posteriors; projected gradient steps on the least squares of the expected domain totals then find a
nonnegative rate for every document. DataFrame operations only: texts become word rows that meet a
broadcast table of bounded size, and each step is one aggregate over the stored posteriors.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from math import log, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelops.llm.common import fresh
from panelops.staging import stage_table

#: Labelled documents the classifier is fitted on, at most: those with the smallest hash of their id.
SAMPLE = 20_000
#: Words the classifier keeps, which bounds its broadcast table.
WORDS = 2_000
STEPS = 60
TOLERANCE = 1e-4
#: Steps after which rates are stored, so that folds stay short.
FOLDED = 8
ROW = "#row"


def with_features(docs: DataFrame) -> DataFrame:
    """The table with `words`: the distinct lower-cased words of the whole text, and words for its style:
    length, share of marks and of capitals, repetition. NULL is the empty text. The text is split once. (Exploding with `explode_outer` keeps Spark
    from inferring a filter that would make the words of every text a second time, before joins.)"""
    whole = F.coalesce("text", F.lit(""))
    n = F.greatest(F.length(whole), F.lit(1))
    letters = F.length(F.translate(whole, " .,\n#$%&*!0123456789", ""))
    capitals = n - F.length(F.translate(whole, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    split = docs.withColumn("words", F.split(F.lower(whole), r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"))
    distinct = split.withColumn("n_words", F.size("words")).withColumn("words", F.array_distinct("words"))

    def named(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"#{name}"), value.cast("int").cast("string"))

    return distinct.withColumn("words", F.concat("words", F.array(
        F.lit(ROW), named("length", F.log2(n)), named("marks", (n - letters) * 20 / n), named("capitals", capitals * 10 / n),
        named("distinct", F.size("words") * 10 / F.greatest("n_words", F.lit(1))),
    ))).drop("n_words")


def n_words(text: Column) -> Column:
    """Words between single spaces and line ends; cheap and close to what a tokenizer counts."""
    whole = F.trim(F.coalesce(text, F.lit("")))
    return F.when(whole == "", F.lit(0)).otherwise(1 + F.length(whole) - F.length(F.translate(whole, " \n", ""))).cast("long")


def fit(docs: DataFrame, labelled: DataFrame, domains: list[str], sample: int = SAMPLE, keep: int = WORDS) -> DataFrame:
    """(word, w_0, .. w_d): what a word adds to the log posterior of each domain; the row `ROW`, which
    every document has, adds the rest. At most `keep` + 1 rows.

    `docs` has key, text; `labelled` has key, domain. Rows with another or no domain are left out, repeated
    keys count as often as they occur. Without labelled documents all domains are as likely.
    """
    drawn = labelled.filter(F.col("domain").isin(domains) & F.col("key").isNotNull()).orderBy(
        F.xxhash64("key", "domain"), "key", "domain").limit(sample)
    pairs = with_features(docs.select("key", "text").join(F.broadcast(drawn), "key").select("domain", "text"))
    counted = stage_table(pairs.select("domain", F.explode_outer("words").alias("word")).filter("word <> ''").groupBy("word").agg(*[
        F.sum((F.col("domain") == d).cast("double")).alias(f"c_{k}") for k, d in enumerate(domains)
    ]), "word-counts")
    sizes = (counted.filter(F.col("word") == ROW).first() or {f"c_{k}": 0.0 for k in range(len(domains))})
    n = [sizes[f"c_{k}"] for k in range(len(domains))]
    total = sum(n)
    p = [(F.col(f"c_{k}") + 0.5) / (n[k] + 1.0) for k in range(len(domains))]
    overall = (sum((F.col(f"c_{k}") for k in range(len(domains))), F.lit(0.0)) + 0.5) / (total + 1.0)
    told = sum(((1.0 + n[k]) * (p[k] * F.log(p[k] / overall) + (1 - p[k]) * F.log((1 - p[k]) / (1 - overall))) for k in range(len(domains))), F.lit(0.0))
    best = counted.filter(F.col("word") != ROW).withColumn("told", told).orderBy(F.desc("told"), "word").limit(keep)
    best = stage_table(best.select("word", *[F.log(x / (1 - x)).alias(f"w_{k}") for k, x in enumerate(p)], *[F.log(1 - x).alias(f"z_{k}") for k, x in enumerate(p)]), "word-weights")
    absent = best.agg(*[F.coalesce(F.sum(f"z_{k}"), F.lit(0.0)).alias(f"z_{k}") for k in range(len(domains))])
    rest = absent.select(F.lit(ROW).alias("word"), *[
        (F.col(f"z_{k}") + log((n[k] + 1) / (total + len(domains)))).alias(f"w_{k}") for k in range(len(domains))])
    return best.drop(*[f"z_{k}" for k in range(len(domains))]).unionByName(rest)


def posteriors(docs: DataFrame, model: DataFrame, d: int) -> DataFrame:
    """Per distinct (key, hash of text): rows, tokens of one row, and p_0 .. p_d. Equal rows get equal
    posteriors; they are added up map-side, as are the words of each text."""
    counted = docs.select("key", "text", F.xxhash64("text").alias("hash"), n_words(F.col("text")).alias("tokens"))
    words = with_features(counted).select("key", "hash", "tokens", F.explode_outer("words").alias("word"))
    scored = words.join(F.broadcast(model), "word").groupBy("key", "hash").agg(
        F.sum((F.col("word") == ROW).cast("long")).alias("rows"), F.max("tokens").alias("tokens"),
        *[F.sum(f"w_{k}").alias(f"s_{k}") for k in range(d)])
    scored = scored.select("key", "hash", "rows", "tokens", *[(F.col(f"s_{k}") / F.col("rows")).alias(f"s_{k}") for k in range(d)])
    top = F.greatest(*[F.col(f"s_{k}") for k in range(d)]) if d > 1 else F.col("s_0")
    parts = [F.exp(F.col(f"s_{k}") - top) for k in range(d)]
    return scored.select("key", "hash", "rows", "tokens", *[(x / sum(parts[1:], parts[0])).alias(f"p_{k}") for k, x in enumerate(parts)])


def rates(members: DataFrame, weights: list[float], steps: int = STEPS, tolerance: float = TOLERANCE) -> DataFrame:
    """`members` (posteriors) with `rate`, the nonnegative expected number of copies of each row, so that
    the expected tokens of domain k come to weights[k] times all tokens, as nearly as least squares allow.

    Accelerated projected gradient from rate 1. Steps are taken in the inner product weighted by tokens, so
    a rate depends on posteriors and not on length; domains are scaled by their share. A step needs the
    domain totals only, and rates are folded from the steps' small vectors, so nothing but them is kept.
    """
    d = len(weights)
    p = [F.col(f"p_{k}") for k in range(d)]
    mass = F.col("rows") * F.col("tokens")

    members = members.withColumn("r0", F.lit(1.0)).withColumn("q0", F.lit(1.0))

    def totals(rate: Column) -> list[float]:
        row = members.agg(*[F.sum(mass * rate * x).alias(f"a_{k}") for k, x in enumerate(p)]).first()
        return [row[f"a_{k}"] or 0.0 for k in range(d)]

    now = totals(F.lit(1.0))
    everything = sum(now)
    if not everything:
        return members.withColumn("rate", F.lit(1.0)).drop("r0", "q0")
    target = [w * everything for w in weights]
    scale = [max(a, 1e-9 * everything) for a in now]
    moves: list[list[float]] = []  # momentum, then what is taken off for each domain's posterior

    def folded(ahead: float | None) -> Column:
        """Rates after all moves; with `ahead`, the point further along the last move."""
        start = F.struct(F.col("r0").alias("r"), F.col("q0").alias("q"))
        if not moves:
            return start["r"] + (start["r"] - start["q"]) * F.lit(ahead or 0.0)

        def step(s: Column, m: Column) -> Column:
            y = s["r"] + m[0] * (s["r"] - s["q"])
            taken = reduce(lambda x, k: x + p[k] * m[k + 1], range(1, d), p[0] * m[1])
            return F.struct(F.greatest(F.lit(0.0), y - taken).alias("r"), s["r"].alias("q"))

        all_moves = F.array(*[F.array(*[F.lit(float(x)) for x in m]) for m in moves])
        return F.aggregate(all_moves, start, step, lambda s: s["r"] + (s["r"] - s["q"]) * F.lit(ahead or 0.0))

    momentum, ahead, was, gap = 1.0, 0.0, now, float("inf")
    for k in range(steps):
        if k:
            now = totals(folded(ahead))
        missed = max(abs(a - t) for a, t in zip(now, target, strict=True))
        moved = max(abs(a - b) for a, b in zip(now, was, strict=True)) if k else everything
        if missed <= tolerance * everything or moved <= tolerance / 10 * everything:
            break  # there, or as near as nonnegative rates come
        last, gap = gap, sum((a - t) ** 2 / s for a, t, s in zip(now, target, scale, strict=True))
        if gap > last:  # overshot: start the momentum anew
            momentum = 1.0
        was = now
        moves.append([ahead, *[(a - t) / s for a, t, s in zip(now, target, scale, strict=True)]])
        after = (1 + sqrt(1 + 4 * momentum * momentum)) / 2
        momentum, ahead = after, (momentum - 1) / after
        if len(moves) == FOLDED:
            twice = members.withColumn("r1", folded(None)).withColumn("q1", folded(-1.0))
            members = stage_table(twice.drop("r0", "q0").withColumnsRenamed({"r1": "r0", "q1": "q0"}), "rates")
            moves.clear()
    return members.withColumn("rate", F.greatest(F.lit(0.0), folded(ahead))).drop("r0", "q0")


def copies(rate: Column, *keys: str) -> Column:
    """The whole part of the rate, and one more with the chance of the rest, drawn by a hash of the keys."""
    chance = F.pmod(F.xxhash64(*keys, F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")).cast("long")


def mix(docs: DataFrame, labelled: DataFrame, weights: Mapping[str, float], id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per distinct (id, text): doc_id, hash of the text, rows, tokens, p_0 .. in the order of `weights`, rate
    and copies. `labelled` has `id_col` and domain. Empty tables give no rows; NULL ids are an id like any other.
    """
    domains = list(weights)
    slim = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    model = fit(slim, labelled.select(F.col(id_col).alias("key"), "domain"), domains, **options)
    members = stage_table(posteriors(slim, model, len(domains)), "posteriors")
    found = rates(members, [weights[x] for x in domains])
    return found.withColumn("copies", copies(F.col("rate"), "key", "hash")).withColumnRenamed("key", id_col)


def apply(docs: DataFrame, labelled: DataFrame, weights: Mapping[str, float], id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Every row as often as its copies say; columns stay."""
    key, digest, n = (fresh(docs, c) for c in ("key", "hash", "copies"))
    drawn = mix(docs, labelled, weights, id_col, text_col, **options).filter("copies > 0").select(
        F.col(id_col).alias(key), F.col("hash").alias(digest), F.col("copies").alias(n))
    same = docs[id_col].eqNullSafe(F.col(key)) & (F.xxhash64(docs[text_col]) == F.col(digest))
    names = [F.col(f"`{c}`") for c in docs.columns]
    return docs.join(drawn, same).select(*names, F.explode(F.sequence(F.lit(1), F.col(n))).alias(n)).select(*names)


def domains_of(labels: DataFrame) -> DataFrame:
    """`domain` of a table with quality and toxic: toxic, else high or low by quality. NULL marks count as 0."""
    toxic, quality = (F.coalesce(F.col(c), F.lit(0)) > 0 for c in ("toxic", "quality"))
    return labels.select("doc_id", F.when(toxic, "toxic").when(quality, "high").otherwise("low").alias("domain"))
