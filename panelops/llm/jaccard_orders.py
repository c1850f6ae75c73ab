"""Self-join of documents by Jaccard similarity of their word shingles, filtered by prefixes under
several global orders of the shingles.

Two sets of similarity t share a shingle among the first |s| - ceil(t |s|) + 1 of each under any one
order; of the smaller one, the first |s| - ceil(2 t |s| / (1 + t)) + 1 do. Pairs are found by equal prefix
shingles under a first order (rare shingles come first), must also share a prefix shingle under every
further order, and are then compared exactly. Within the join, the places of the shared shingle and
parity tables of the sets rule out nearly all pairs that are not similar enough, so few are listed;
before texts are fetched, larger bit tables of the sets rule out more.

Documents with equal sets form one class. Links within classes are not spelled out, and a pair whose
classes are known to be connected is not compared, so a group of thousands of copies costs about as
many comparisons as it has members. No pair of unconnected classes that passes the filters is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelops.llm.common import fresh, map_batches, pieces, text_bytes, with_columns
from panelops.llm.components import components
from panelops.staging import stage_table

WORDS = 3
#: Least similarity, in hundredths.
PERCENT = 90
ORDERS = 3
#: Buckets in which shingles are counted for the orders; 4 bytes each, whatever the corpus.
BUCKET_BITS = 20
CHUNKS = 16
#: Comparisons per candidate row up to which pairs of a group are listed; above, more groups are
#: contracted around a middle first. Changes the work only.
PAIRS_PER_ROW = 4
ROUNDS = 8
#: A round that leaves more than this share of the pairs is the last before they are listed.
FALLS_TO = 0.9
AT_ONCE = 1 << 19
#: 64-bit words of a set's parity table.
PARITIES = 8
#: Bits of the table that tells which documents' texts may be wanted, as a power of two: 8 MB.
BIT_TABLE = 26
LONG_WORD = 64

LOW_BITS = np.uint64(16)
_RNG = np.random.default_rng(8)
_BY_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BY_PLACE = _RNG.integers(1, 1 << 63, LONG_WORD, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BY_WORD = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


def mixed(h: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit finaliser; another salt gives another order."""
    h = h ^ np.uint64((0x9E3779B97F4A7C15 * (salt + 1)) & (2**64 - 1))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and the place of each text's first word (and the last's end)."""
    folded = np.frombuffer(data.tobytes().translate(_LOWER), np.uint8)
    solid = folded != 32
    start = solid.copy()
    start[1:] &= ~solid[:-1]
    edges = at[:-1][at[:-1] < len(folded)]
    start[edges] = solid[edges]
    begin = np.flatnonzero(start)
    if not len(begin):
        return np.empty(0, np.uint64), np.zeros(len(at), np.int64)
    stop = solid.copy()
    stop[:-1] &= ~solid[1:]
    last = at[1:][(at[1:] > 0)] - 1
    stop[last] = solid[last]
    size = np.flatnonzero(stop) + 1 - begin
    letters = np.flatnonzero(solid)
    place = np.arange(len(letters)) - np.repeat(np.cumsum(size) - size, size)
    terms = _BY_BYTE[folded[letters]] * _BY_PLACE[np.minimum(place, LONG_WORD - 1)]
    hashes = mixed(np.add.reduceat(terms, np.cumsum(size) - size) + size.astype(np.uint64))
    for i in np.flatnonzero(size > LONG_WORD):
        hashes[i] = xxhash.xxh3_64_intdigest(folded[begin[i]:begin[i] + size[i]].tobytes())
    return hashes, np.searchsorted(begin, at)


def shingle_sets(data: np.ndarray, at: np.ndarray, words: int = WORDS) -> Iterator[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its shingles; of all its words, if they are fewer."""
    a = 0
    while a < len(at) - 1:
        b = max(a + 1, int(np.searchsorted(at, at[a] + AT_ONCE, side="right")) - 1)
        hashes, first = word_hashes(data[at[a]:at[b]], at[a:b + 1] - at[a])
        full = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        for k in range(words):
            full += hashes[k:k + len(full)] * _BY_WORD[k]
        full = mixed(full, words)
        for x, y in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if y - x >= words:
                yield np.unique(full[x:y - words + 1])
            elif y > x:
                yield mixed(np.sum(hashes[x:y] * _BY_WORD[:y - x], keepdims=True), y - x)
            else:
                yield np.empty(0, np.uint64)
        a = b


def prefix_size(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1


def bucket_counts(docs: DataFrame, text_col: str, words: int, bits: int = BUCKET_BITS) -> np.ndarray:
    """In how many documents the shingles of each hash bucket occur, over all documents. Each task sends
    its compressed counts once; sums have a fixed size."""
    size = (1 << bits) // CHUNKS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        total = np.zeros(1 << bits, np.int64)
        for batch in pieces(batches):
            for s in shingle_sets(*text_bytes(batch.column(0)), words):
                np.add.at(total, s >> np.uint64(64 - bits), 1)
        pack = zstandard.ZstdCompressor(level=1)
        yield {"part": list(range(CHUNKS)), "counts": [pack.compress(c.tobytes()) for c in total.reshape(CHUNKS, -1)]}

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        unpack, total = zstandard.ZstdDecompressor(), np.zeros(size, np.int64)
        for blob in rows["counts"]:
            total += np.frombuffer(unpack.decompress(blob), np.int64)
        return pd.DataFrame({"part": rows["part"].iloc[:1], "counts": [total.tobytes()]})

    sent = map_batches(docs.select(F.col(text_col).cast("string")), count, "part int, counts binary")
    sums = sent.groupBy("part").applyInPandas(add, "part int, counts binary").collect()
    out = np.zeros((CHUNKS, size), np.int64)
    for row in sums:
        out[row["part"]] = np.frombuffer(row["counts"], np.int64)
    return out.reshape(-1)


def size_classes(docs: DataFrame, text_col: str, words: int) -> Broadcast:
    """The logarithms of the bucket counts, for the tasks: one byte a bucket."""
    counts = bucket_counts(docs, text_col, words)
    return docs.sparkSession.sparkContext.broadcast(np.log2(np.maximum(counts, 1)).astype(np.uint8))


def prefix_places(s: np.ndarray, classes: np.ndarray, order: int, percent: int) -> np.ndarray:
    """Where the prefix of a set under an order stands in it. In order i a shingle stands by the size
    class of its bucket's count, then by hash i."""
    rank = classes[(s >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)].astype(np.uint64) << np.uint64(58)
    return np.argsort(rank | (mixed(s, 100 + order) >> np.uint64(6)), kind="stable")[:prefix_size(len(s), percent)]


def digest_of(s: np.ndarray) -> bytes | None:
    return blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def with_prefixes(docs: DataFrame, text_col: str, classes: Broadcast, words: int, percent: int) -> DataFrame:
    """The table with the size of each document's set, a 128-bit digest of it (NULL for no words), and
    its prefix under the first order: 48 bits of each shingle's hash, then 16 of its place; bit and parity
    tables of the set."""
    place = docs.columns.index(text_col)

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        size, digest, prefix, bits, odd = [], [], [], [], []
        for s in shingle_sets(*text_bytes(batch.column(place)), words):
            size.append(len(s))
            digest.append(digest_of(s))
            bits.append(bitmap(s))
            odd.append(parities(s))
            first = s[prefix_places(s, classes.value, 0, percent)] if len(s) else s
            prefix.append((first >> LOW_BITS << LOW_BITS | np.minimum(np.arange(len(first)), 0xFFFF).astype(np.uint64)).view(np.int64))
        return {"n_set": size, "digest": digest, "prefix": prefix, "bits": bits, "odd": odd}

    return with_columns(docs, run, "n_set long, digest binary, prefix array<long>, bits array<long>, odd array<long>")


def bitmap(s: np.ndarray) -> np.ndarray:
    """A bit table of the set, two to four bits a shingle, as 64-bit integers; a power of two of them."""
    bits = np.zeros(64 << max(0, int(np.ceil(np.log2(max(1, len(s)) / 32)))), bool)
    bits[(mixed(s, 99) & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.int64)


def parities(s: np.ndarray) -> np.ndarray:
    """Of each of a fixed number of hash buckets, a bit that tells whether it holds an odd number of the
    set's shingles, as 64-bit integers. Two sets differ by as many shingles as their tables differ by bits,
    at least."""
    n = 64 * PARITIES
    odd = np.bincount((mixed(s, 98) & np.uint64(n - 1)).astype(np.int64), minlength=n) & 1
    return np.packbits(odd.astype(bool), bitorder="little").view(np.int64)


def most_common(na: Column, nb: Column, a: Column, b: Column) -> Column:
    """An upper bound of the shingles two sets share: a shingle whose bit the other table lacks is not
    shared. Of tables of unequal length the longer one is folded."""

    def folded(x: Column, y: Column) -> Column:
        half = (F.size(x) / 2).cast("int")
        return F.when(F.size(x) > F.size(y), F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseOR(q))).otherwise(x)

    def only(x: Column, y: Column) -> Column:
        bits = F.zip_with(x, y, lambda p, q: F.bit_count(p.bitwiseAND(F.bitwise_not(q))))
        return F.aggregate(bits, F.lit(0), lambda n, k: n + F.coalesce(k, F.lit(0)))

    fa, fb = folded(a, b), folded(b, a)
    return F.least(na - only(fa, fb), nb - only(fb, fa))


def pairs_in_size(na: F.Column, nb: F.Column, percent: int) -> F.Column:
    return F.least(na, nb) * 100 >= F.greatest(na, nb) * percent


def by_size(rows: DataFrame, percent: int) -> DataFrame:
    """Each row twice: in the size class of its set, and in the class below. Classes are so wide that a
    set's smaller partners are in one of the two. As a smaller partner, a set is `short`: it stands in its
    own class only, by its first shingles, one of which every set as large or larger must share."""
    wide = math.log(100 / percent) * (1 + 1e-6) if percent < 100 else 1e-12
    own = F.floor(F.log("n_set") / wide)
    short = (F.col("n_set") - F.col("pos")) * (100 + percent) >= 2 * percent * F.col("n_set")
    return rows.select("*", F.explode(F.array(
        F.struct(own.alias("size_class"), short.alias("short")), F.struct((own - 1).alias("size_class"), F.lit(False).alias("short")))).alias("cell")
    ).select(*rows.columns, "cell.*")


def listed(members: DataFrame, odd: DataFrame, percent: int) -> DataFrame:
    """The pairs of different components that meet in a cell, a being the larger set, and can be similar
    enough by the first shingle they share, before which none is shared, and by their parity tables."""
    words = range(PARITIES)
    rows = members.join(odd.select("cid", *[F.col("odd")[i].alias(f"o{i}") for i in words]), "cid")
    a = rows.select("token", "size_class", *[F.col(c).alias(f"{c}_a") for c in ("cid", "n_set", "pos", "comp", *[f"o{i}" for i in words])])
    b = rows.filter("short").select("token", "size_class", *[F.col(c).alias(f"{c}_b") for c in ("cid", "n_set", "pos", "comp", *[f"o{i}" for i in words])])
    both = F.col("n_set_a") + F.col("n_set_b")
    unlike = sum((F.bit_count(F.col(f"o{i}_a").bitwiseXOR(F.col(f"o{i}_b"))) for i in words), F.lit(0))
    return a.join(b, ["token", "size_class"]).filter("comp_a <> comp_b").filter(
        "n_set_a > n_set_b or n_set_a = n_set_b and cid_a < cid_b"
    ).filter(pairs_in_size(F.col("n_set_a"), F.col("n_set_b"), percent)).filter(
        (F.col("n_set_a") - F.col("pos_a")) * (100 + percent) >= both * percent
    ).filter((F.col("n_set_b") - F.col("pos_b")) * (100 + percent) >= both * percent
    ).filter(unlike * (100 + percent) <= both * (100 - percent)).select(F.col("cid_a").alias("a"), F.col("cid_b").alias("b"))


def texts_of_ids(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """`wanted` with the texts of its documents, joined on the id `key`. Before texts are shuffled, most
    others are left out by a bit table of hashed ids, which has a fixed size."""
    keyed = docs.select(F.coalesce("doc_id", F.lit(-1)).alias("key"), "text")
    bit = F.shiftrightunsigned(F.xxhash64("key"), 64 - BIT_TABLE)
    bits = wanted.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
    near = keyed.withColumn("bit", bit).withColumn("word", F.shiftright("bit", 6).cast("int")).join(F.broadcast(bits), "word").filter(
        "(bits & shiftleft(1L, cast(bit & 63 as int))) <> 0").select("key", "text")
    return wanted.join(near, "key").dropDuplicates(["key", "cid", "center", "text"])


def linked(pairs: DataFrame, named: DataFrame, docs: DataFrame, shared: Broadcast, words: int, percent: int, orders: int) -> DataFrame:
    """The pairs (a, b) of class ids that share a prefix shingle under every further order and whose sets
    are similar enough. Sets are made anew from the texts of the classes in question only; that of b
    travels to a."""
    keyed = named.select("cid", "digest", F.coalesce("doc_id", F.lit(-1)).alias("key"))
    members = pairs.select(F.col("b").alias("cid"), F.col("a").alias("center")).join(keyed, "cid")
    centers = pairs.select(F.col("a").alias("cid")).distinct().join(keyed, "cid").withColumn("center", F.lit(None).cast("long"))
    wanted = stage_table(members.unionByName(centers).select("cid", "center", "digest", "key"), "wanted")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in pieces(batches):
            out = {"cid": [], "center": [], "hashes": [], "others": []}
            cids, digests = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for cid, center, digest, s in zip(cids, batch.column(1).to_pylist(), digests, shingle_sets(*text_bytes(batch.column(3)), words), strict=True):
                if digest_of(s) == digest:  # else another text of the same id
                    out["cid"].append(cid)
                    out["center"].append(center)
                    out["hashes"].append(s.view(np.int64))
                    out["others"].append([
                        (s[prefix_places(s, shared.value, i, percent)] >> np.uint64(32)).astype(np.uint32).view(np.int32) for i in range(1, orders)])
            yield out

    texts = texts_of_ids(docs, wanted).select("cid", "center", "digest", "text")
    made = stage_table(map_batches(texts, sets, "cid long, center long, hashes array<long>, others array<array<int>>"), "sets")
    b = made.filter("center is not null").select(F.col("center").alias("a"), F.col("cid").alias("b"), F.col("hashes").alias("hb"), F.col("others").alias("ob"))
    a = made.filter("center is null").select(F.col("cid").alias("a"), F.col("hashes").alias("ha"), F.col("others").alias("oa"))
    both = b.join(a, "a")
    for i in range(orders - 1):
        both = both.filter(F.arrays_overlap(F.col("oa")[i], F.col("ob")[i]))
    common = F.size(F.array_intersect("ha", "hb"))
    both = both.select("a", "b", common.alias("n"), (F.size("ha") + F.size("hb") - common).alias("all"))
    return both.filter(F.col("n") * 100 >= F.col("all") * percent).select("a", "b")


def class_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, orders: int = ORDERS,
    pairs_per_row: float = PAIRS_PER_ROW, rounds: int = ROUNDS,
) -> tuple[DataFrame, DataFrame]:
    """Two stored tables: (doc_id, n_set, digest) of every document, and (digest, doc_id, component,
    component_id) of every class: its smallest id, a number of its component and the smallest id in it.

    NULL and empty texts have size 0, no digest and no class. NULL ids count as larger than any other.
    """
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shared = size_classes(slim, "text", words)
    marked = stage_table(with_prefixes(slim, "text", shared, words, percent).drop("text"), "prefixes")
    classes = marked.filter("digest is not null").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_set").alias("n_set"), F.first("prefix").alias("prefix"),
        F.first("bits").alias("bits"), F.first("odd").alias("odd"))
    classes = stage_table(classes.withColumn("cid", F.monotonically_increasing_id()), "classes")
    named = classes.select("cid", "digest", "doc_id")

    rows = classes.select("cid", F.explode("prefix").alias("packed"))
    token = F.shiftright("packed", 16)
    common = rows.groupBy(token.alias("token")).agg(F.count(F.lit(1)).alias("members")).filter("members > 1").select("token")
    rows = rows.join(common, token == F.col("token")).select("token", "cid", F.expr("cast(packed & 65535 as int)").alias("pos"))
    rows = stage_table(rows.join(classes.select("cid", "n_set"), "cid"), "common")
    edges, labels, n_rows, before = None, None, rows.count(), None
    rows = by_size(rows, percent)
    for k in range(rounds + 1):
        if labels is None:
            now = rows.withColumn("comp", F.col("cid"))
        else:
            now = rows.join(labels.withColumnsRenamed({"node": "cid", "label": "comp"}), "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
        by_comp = now.groupBy("token", "size_class", "comp").agg(F.count(F.lit(1)).alias("m"), F.count_if("short").alias("s"))
        open_cells = by_comp.groupBy("token", "size_class").agg(
            (F.sum("m") * F.sum("s") - F.sum(F.col("m") * F.col("s"))).alias("n")).filter("n > 0")
        open_cells = stage_table(open_cells, "open")
        left = open_cells.agg(F.sum("n")).first()[0]
        if not left:
            break
        now = stage_table(now.join(open_cells.select("token", "size_class"), ["token", "size_class"]), "members")
        rows = now.drop("comp")
        stuck, before = before is not None and left > FALLS_TO * before, left
        last = k > 0 and (left <= pairs_per_row * n_rows or stuck) or k == rounds
        if last:
            found = listed(now, classes, percent).distinct()
        else:  # the member with the fewest rarer shingles, then others by chance
            rank = F.col("pos") if k == 0 else F.xxhash64("cid", F.lit(k))
            middle = now.groupBy("token", "size_class").agg(
                F.min_by("cid", rank).alias("a"), F.min_by("n_set", rank).alias("na"), F.min_by("comp", rank).alias("ca"))
            found = now.select("token", "size_class", F.col("cid").alias("b"), F.col("n_set").alias("nb"), F.col("comp").alias("cb")).join(
                middle, ["token", "size_class"]).filter("ca <> cb").filter(pairs_in_size(F.col("na"), F.col("nb"), percent))
            # of a member's middles, that which shares most; the others if that does not link them
            found = found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).groupBy("b").agg(F.max_by("a", F.struct("n", "a")).alias("a"))
        found = stage_table(found.select("a", "b"), "pairs")
        sides = classes.select("cid", "n_set", "bits")
        found = found.join(sides.toDF("a", "na", "ba"), "a").join(sides.toDF("b", "nb", "bb"), "b")
        found = found.withColumn("most", most_common(F.col("na"), F.col("nb"), F.col("ba"), F.col("bb")))
        found = found.filter(F.col("most") * 100 >= (F.col("na") + F.col("nb") - F.col("most")) * percent).select("a", "b")
        new = stage_table(linked(found, named, slim, shared, words, percent, orders), "links")
        edges = new if edges is None else edges.union(new)
        labels = components(edges)
        if last:
            break
    if labels is None:
        named = named.withColumn("component", F.col("cid"))
    else:
        named = named.join(labels.withColumnsRenamed({"node": "cid", "label": "component"}), "cid", "left").withColumn(
            "component", F.coalesce("component", "cid"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return marked, stage_table(named.join(least, "component").select("digest", "doc_id", "component", "component_id"), "components")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: doc_id, n_shingles, and the smallest id of its component."""
    marked, classes = class_components(docs, id_col, text_col, **options)
    return marked.select("doc_id", "n_set", "digest").join(classes.select("digest", "component_id"), "digest", "left").select(
        "doc_id", F.col("n_set").alias("n_shingles"),
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, **options) -> DataFrame:
    """One document of every component, that with the smallest id (then text); documents without words
    stay. Columns stay."""
    _, classes = class_components(docs, id_col, text_col, words=words, **options)
    chosen = classes.groupBy("component").agg(F.min_by("digest", F.struct(F.col("doc_id").isNull(), "doc_id", "digest")).alias("digest"))
    place, digest = docs.columns.index(text_col), fresh(docs, "digest")

    def run(batch: pa.RecordBatch) -> dict[str, list]:
        sets = shingle_sets(*text_bytes(batch.column(place)), words)
        return {digest: [digest_of(s) for s in sets]}

    marked = with_columns(docs, run, f"`{digest}` binary")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    order = F.struct(F.col(f"`{id_col}`").isNull(), F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    one = marked.join(chosen.select(F.col("digest").alias(digest)), digest, "left_semi").groupBy(digest).agg(F.min_by(row, order).alias("row"))
    return one.select("row.*").unionByName(marked.filter(F.col(digest).isNull()).drop(digest))
