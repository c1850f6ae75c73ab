"""Language-model scores of texts: a log-bilinear model trained with noise-contrastive estimation.

Tokens are counted over the whole corpus. The most frequent have a class of their own, every other belongs to
a class by its last bytes; within such a class words follow their smoothed counts, so unseen words have a
probability too and all probabilities add up to one. The model predicts the class of a token from the two
before it: their vectors, each times a matrix of its place, add up to a prediction, whose products with the
vectors of all classes, after a softmax over all of them, are the class probabilities.

Documents are cut into blocks, each with a dictionary of its own, so texts are split once and words travel
once per block. Blocks are trained where they are: every task starts from the same parameters, and the mean
of what the tasks have learned starts the next round.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelops.llm.common import arrow_schema, map_batches
from panelops.staging import stage_table

#: Bytes of text in a block, and in one split of a long text.
BLOCK_BYTES = 8 << 20
#: Words with a class of their own, and classes of all other words.
OWN_CLASS, SHARED = 399, 240
TAIL_BYTES = 3
#: More than there are classes, which are stored in 16 bits.
CLASS_CODES = 1 << 16
DIMS = 16
#: Each round trains on its share of the blocks; together they see every training token once.
ROUNDS = 3
BATCH, NOISE = 2048, 64
RATE = 0.1
SEED = 42
SMOOTH = 0.1
#: Neither is a word, as both hold white space or nothing.
START, END = b"", b"\n"
SPACE = regex.compile(rb"[ \t-\r]")


def words(text: str, at_once: int = BLOCK_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, A-Z in lower case, in lists of about `at_once` bytes."""
    data, start = text.encode("utf-8", "replace").lower(), 0
    while start < len(data):
        end = len(data)
        if end - start > at_once:
            space = SPACE.search(data, start + at_once)
            end = space.start() if space else end
        yield data[start:end].split()
        start = end


@dataclass
class Piece:
    """A stretch of a document inside a block: the places of its tokens, after two that come before them."""

    row: int
    id: int | None
    learned: bool
    held_out: bool | None
    start: int
    end: int


def blocks(batches: Iterator[pa.RecordBatch], block_bytes: int) -> Iterator[tuple[list[Piece], np.ndarray, dict[bytes, int]]]:
    """Pieces, tokens as numbers of the block's dictionary, and the dictionary, for about `block_bytes` bytes."""
    pieces, ids, size = [], [], 0
    numbers: dict[bytes, int] = defaultdict()

    def opened() -> None:
        nonlocal pieces, ids, size, numbers
        pieces, ids, size, numbers = [], [], 0, defaultdict()
        numbers.default_factory = numbers.__len__

    opened()
    for batch in batches:
        for row, doc, learned, held_out, text in zip(*batch.columns, strict=True):
            own = (row.as_py(), doc.as_py(), learned.as_py(), held_out.as_py())
            before = [START, START]
            stretches: Iterable[list[bytes]] = words(text.as_py() or "", block_bytes)
            for stretch, last in marked(stretches):
                tokens = [*stretch, END] if last else stretch
                if tokens:
                    start = len(ids) + 2
                    ids += [numbers[w] for w in before]
                    ids += [numbers[w] for w in tokens]
                    pieces.append(Piece(*own, start, len(ids)))
                    size += sum(map(len, stretch))
                    before = [*before, *tokens[-2:]][-2:]
                if size >= block_bytes:
                    yield pieces, np.array(ids, np.int32), numbers
                    opened()
    if pieces:
        yield pieces, np.array(ids, np.int32), numbers


def marked(parts: Iterable[list[bytes]]) -> Iterator[tuple[list[bytes], bool]]:
    """Parts with whether they are the last; one empty last part if there is none."""
    held: list[bytes] = []
    first = True
    for part in parts:
        if not first:
            yield held, False
        held, first = part, False
    yield held, True


def packed(what: object) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(what, protocol=5))


def unpacked(data: bytes) -> object:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(data))


def numbered_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """(block, local, word, n, data): a row for each word of a block's dictionary with its training count,
    and one with `data`, the block's pieces and tokens. Docs: (row, id, learned, held_out, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        part = TaskContext.get().partitionId()
        for i, (pieces, ids, numbers) in enumerate(blocks(batches, block_bytes)):
            learned = [ids[p.start:p.end] for p in pieces if p.learned] or [np.empty(0, np.int32)]
            counts = np.bincount(np.concatenate(learned), minlength=len(numbers))
            block, found = (part << 32) + i, list(numbers)
            for a in range(0, len(found), 1 << 16):
                some = found[a:a + (1 << 16)]
                yield {"block": pa.array(np.full(len(some), block)), "local": pa.array(np.arange(a, a + len(some), dtype=np.int32)),
                       "word": pa.array(some, pa.binary()),
                       "n": pa.array(counts[a:a + len(some)]), "data": pa.nulls(len(some), pa.binary())}
            yield {"block": [block], "local": [None], "word": [None], "n": [None], "data": [packed((pieces, ids, numbers.get(START, -1)))]}

    ddl = "block long, local int, word binary, n long, data binary"
    return stage_table(map_batches(docs, run, ddl), "numbered")


@dataclass
class Classes:
    """Number 0 is the end of a text, then the frequent words, then the shared classes; `counts` are training
    tokens, `kinds` the different ones, by class."""

    own: int
    counts: np.ndarray
    kinds: np.ndarray

    @property
    def size(self) -> int:
        return len(self.counts)

    def within(self) -> np.ndarray:
        """What a token's smoothed count is divided by in its class; 0 where the class is the token."""
        below = self.counts + SMOOTH * (self.kinds + 1)
        below[:1 + self.own] = 0.0
        return below


def counted(numbered: DataFrame, own: int, shared: int) -> tuple[DataFrame, Classes]:
    """(word, code) of every word, and the classes; a code is the training count times CLASS_CODES, and the class.
    `own` words and the sums of the classes reach the driver."""
    rows = numbered.filter("word is not null")
    words_ = stage_table(rows.groupBy("word").agg(F.sum("n").alias("c")), "words")
    frequent = words_.filter((F.col("c") > 0) & (F.length("word") > 0) & (F.col("word") != F.lit(END))).orderBy(
        F.desc("c"), "word").limit(own).collect()
    table = [(bytearray(r["word"]), 1 + i) for i, r in enumerate(frequent)] + [(bytearray(END), 0)]
    given = numbered.sparkSession.createDataFrame(table, "word binary, given int")
    tail = F.crc32(F.substring("word", -TAIL_BYTES, TAIL_BYTES)) % shared
    classed = words_.join(F.broadcast(given), "word", "left").select(
        "word", "c", F.coalesce("given", tail + (1 + len(frequent))).alias("class"))
    counts, kinds = np.zeros(1 + len(frequent) + shared), np.zeros(1 + len(frequent) + shared)
    for r in classed.filter("c > 0").groupBy("class").agg(F.sum("c").alias("c"), F.count("*").alias("n")).collect():
        counts[r["class"]], kinds[r["class"]] = r["c"], r["n"]
    return classed.select("word", (F.col("c") * CLASS_CODES + F.col("class")).alias("code")), Classes(len(frequent), counts, kinds)


def coded_blocks(numbered: DataFrame, classed: DataFrame, classes: Classes) -> DataFrame:
    """(block, data): pieces, classes of the tokens, and for each piece what needs the counts of words."""
    looked = numbered.filter("word is not null").select("block", "local", "word").join(classed, "word").select("block", "local", "code")
    texts = numbered.filter("data is not null").select(F.col("block").alias("of"), "data")
    total, kinds, within = classes.counts.sum(), classes.kinds.sum(), classes.within()
    schema = arrow_schema("block long, data binary")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for data in left.column("data"):
            pieces, ids, start = unpacked(data.as_py())
            order = np.argsort(right.column("local").to_numpy())
            c, kind = np.divmod(right.column("code").to_numpy()[order], CLASS_CODES)
            base = np.log10((c + SMOOTH) / (total + SMOOTH * (kinds + 1)))
            shares = np.zeros(len(c))
            shared = within[kind] > 0.0
            shares[shared] = np.log10((c[shared] + SMOOTH) / within[kind[shared]])
            sums = []
            for p in pieces:
                own = ids[p.start:p.end]
                sums.append((len(own), int((c[own] > 0).sum()), float(base[own].sum()), float(shares[own].sum())))
            if start >= 0:  # as a context only
                kind[start] = classes.size
            out.append(packed((pieces, kind.astype(np.uint16)[ids], sums)))
        return pa.table({"block": left.column("of"), "data": pa.array(out, pa.binary())}, schema)

    return stage_table(texts.groupBy("of").cogroup(looked.groupBy("block")).applyInArrow(run, "block long, data binary"), "coded")


@dataclass
class Model:
    """Vectors of contexts (one more than classes, for the place before a text) and of classes, biases, and a
    matrix for each of the two places before a token."""

    contexts: np.ndarray
    targets: np.ndarray
    biases: np.ndarray
    places: np.ndarray

    @classmethod
    def untrained(cls, classes: Classes, dims: int, seed: int) -> Model:
        """The class frequencies, whatever the context."""
        m, rng = classes.size, np.random.default_rng(seed)
        return cls(
            rng.normal(0, 0.3, (m + 1, dims)).astype(np.float32), np.zeros((m, dims), np.float32),
            np.log(frequencies(classes)).astype(np.float32), np.stack([0.5 * np.eye(dims), np.eye(dims)]).astype(np.float32))

    @property
    def arrays(self) -> list[np.ndarray]:
        return [self.contexts, self.targets, self.biases, self.places]

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.arrays])

    def filled(self, flat: np.ndarray) -> Model:
        out, at = [], 0
        for x in self.arrays:
            out.append(flat[at:at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        return Model(*out)

    def predictions(self, before: np.ndarray) -> np.ndarray:
        """Predicted vectors for pairs of contexts (rows, 2)."""
        return sum(self.contexts[before[:, i]] @ self.places[i] for i in (0, 1))

    def log_totals(self, before: np.ndarray, at_once: int = 4096) -> np.ndarray:
        """Logarithm of the sum over all classes of the exponentials of their scores."""
        out = np.empty(len(before), np.float32)
        for a in range(0, len(before), at_once):
            scores = self.predictions(before[a:a + at_once]) @ self.targets.T + self.biases
            top = scores.max(1, keepdims=True)
            out[a:a + at_once] = np.log(np.exp(scores - top, out=scores).sum(1)) + top[:, 0]
        return out


def frequencies(classes: Classes) -> np.ndarray:
    return (classes.counts + 1.0) / (classes.counts.sum() + classes.size)


def token_places(pieces: list[Piece]) -> np.ndarray:
    return np.concatenate([np.arange(p.start, p.end) for p in pieces]) if pieces else np.empty(0, np.int64)


class Training:
    """Noise-contrastive estimation: a token is told from noise drawn by class frequency, with the score of its
    class as the logarithm of an unnormalised probability. Steps are scaled by each parameter's own past."""

    def __init__(self, model: Model, noise: np.ndarray, seed: int, rate: float = RATE, batch: int = BATCH, samples: int = NOISE):
        self.model = Model(*[x.copy() for x in model.arrays])
        self.past = [np.full_like(x, 1e-4) for x in model.arrays]
        self.rng, self.rate, self.batch, self.samples = np.random.default_rng(seed), rate, batch, samples
        self.ends, self.offset = np.cumsum(noise / noise.sum()), np.log(samples * noise).astype(np.float32)
        self.seen = 0

    def learn(self, kinds: np.ndarray, places: np.ndarray) -> None:
        places = self.rng.permutation(places)
        for a in range(0, len(places), self.batch):
            at = places[a:a + self.batch]
            self._step(kinds[at[:, None] - [2, 1]].astype(np.int64), kinds[at].astype(np.int64))
        self.seen += len(places)

    def _step(self, before: np.ndarray, target: np.ndarray) -> None:
        m, n = self.model, len(target)
        drawn = np.minimum(np.searchsorted(self.ends, self.rng.random(self.samples)), len(self.ends) - 1)
        guess, noisy = m.predictions(before), m.targets[drawn]
        true = (guess * m.targets[target]).sum(1) + m.biases[target] - self.offset[target]
        false = guess @ noisy.T + (m.biases[drawn] - self.offset[drawn])
        up = (1.0 / (1.0 + np.exp(np.clip(true, -30, 30))))[:, None] / n
        down = -1.0 / (1.0 + np.exp(-np.clip(false, -30, 30))) / n
        to_guess = up * m.targets[target] + down @ noisy
        contexts, targets, biases = (np.zeros(x.size) for x in (m.contexts, m.targets, m.biases))
        dims = np.arange(guess.shape[1])
        spots = [target[:, None] * len(dims) + dims, drawn[:, None] * len(dims) + dims]
        targets += np.bincount(spots[0].ravel(), (up * guess).ravel(), targets.size) + np.bincount(spots[1].ravel(), (down.T @ guess).ravel(), targets.size)
        biases += np.bincount(target, up[:, 0], biases.size) + np.bincount(drawn, down.sum(0), biases.size)
        places = np.empty_like(m.places)
        for i in (0, 1):
            places[i] = m.contexts[before[:, i]].T @ to_guess
            back = to_guess @ m.places[i].T
            contexts += np.bincount((before[:, i, None] * len(dims) + dims).ravel(), back.ravel(), contexts.size)
        for x, past, step in zip(m.arrays, self.past, (contexts, targets, biases, places), strict=True):
            step = step.reshape(x.shape).astype(np.float32)
            past += step * step
            x += self.rate * step / np.sqrt(past)


def trained(coded: DataFrame, classes: Classes, dims: int, rounds: int, seed: int) -> Model:
    """The model after every training token has been seen once, in `rounds` rounds."""
    model, noise = Model.untrained(classes, dims, seed), frequencies(classes)
    width = 1024
    for i in range(rounds):
        def run(batches: Iterator[pa.RecordBatch], model: Model = model, i: int = i) -> Iterator[dict[str, list]]:
            training = None
            for batch in batches:
                for block, data in zip(*batch.columns, strict=True):
                    pieces, kinds, _ = unpacked(data.as_py())
                    own = [p for p in pieces if p.learned]
                    # The rounds share out the pieces, so that a table of one block has all rounds too.
                    places = token_places([p for j, p in enumerate(own) if (j + block.as_py()) % rounds == i])
                    training = training or Training(model, noise, seed + block.as_py() % (1 << 30))
                    if len(places):
                        training.learn(kinds, places)
            if training and training.seen:
                flat = training.model.flat().astype(float)
                parts = [flat[a:a + width] for a in range(0, len(flat), width)]
                yield {"part": list(range(len(parts))), "seen": [float(training.seen)] * len(parts), "values": [(x * training.seen).tolist() for x in parts]}

        learned = map_batches(coded.select("block", "data"), run, "part int, seen double, values array<double>")
        values = learned.select("part", "seen", F.posexplode("values").alias("i", "x"))
        means = values.groupBy("part", "i").agg((F.sum("x") / F.sum("seen")).alias("x")).groupBy("part").agg(
            F.array_sort(F.collect_list(F.struct("i", "x"))).alias("xs"))
        rows = means.select("part", F.transform("xs", lambda s: s["x"]).alias("xs")).orderBy("part").collect()  # the parameters
        if rows:
            model = model.filled(np.concatenate([r["xs"] for r in rows]))
    return model


def piece_scores(pieces: list[Piece], kinds: np.ndarray, model: Model) -> np.ndarray:
    """Sum of the log10 probabilities of the classes of each piece's tokens."""
    places = token_places(pieces)
    before = kinds[places[:, None] - [2, 1]].astype(np.int64)
    pairs, which = np.unique(before[:, 0] * len(model.contexts) + before[:, 1], return_inverse=True)
    pairs = np.stack(np.divmod(pairs, len(model.contexts)), 1)
    totals, logs = model.log_totals(pairs), np.empty(len(places))
    for a in range(0, len(places), 1 << 16):
        target = kinds[places[a:a + (1 << 16)]].astype(np.int64)
        guess = model.predictions(before[a:a + (1 << 16)])
        logs[a:a + (1 << 16)] = (guess * model.targets[target]).sum(1) + model.biases[target] - totals[which[a:a + (1 << 16)]]
    starts = np.cumsum([0] + [p.end - p.start for p in pieces[:-1]])
    return np.add.reduceat(logs, starts) / np.log(10.0)


def block_scores(coded: DataFrame, model: Model) -> DataFrame:
    """(row, id, held_out, n_tokens, n_known, base, score) of every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            for data in batch.column(0):
                pieces, kinds, sums = unpacked(data.as_py())
                own = piece_scores(pieces, kinds, model)
                yield {
                    "row": [p.row for p in pieces], "id": [p.id for p in pieces], "held_out": [p.held_out for p in pieces],
                    "n_tokens": [s[0] for s in sums], "n_known": [s[1] for s in sums], "base": [s[2] for s in sums],
                    "score": [float(x) + s[3] for x, s in zip(own, sums, strict=True)]}

    return map_batches(coded.select("data"), run, "row long, id long, held_out boolean, n_tokens long, n_known long, base double, score double")


def score(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, own: int = OWN_CLASS, shared: int = SHARED,
    dims: int = DIMS, rounds: int = ROUNDS, block_bytes: int = BLOCK_BYTES, seed: int = SEED,
) -> DataFrame:
    """Every document with doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    Tokens are the words between white space, A-Z in lower case, and one end; NULL and empty texts have the end
    alone. Documents whose crc32(id as text) leaves 0 when divided by `folds` are held out of all counts and of
    training; a NULL id is neither learned from nor held out (NULL). `base_score` is the log10 probability by
    smoothed counts of all training tokens, `score` that of the model. Rows of equal ids are documents of their
    own; words of equal count are ranked by their bytes. Without training documents the scores are those of
    unseen tokens. Only the two named columns are read, so others may have any name; an empty table gives no rows.

    All training tokens are counted and trained on. The driver holds the `own` most frequent words, sums per
    class and the parameters, whose sizes are parameters. Results of one table can differ in the last digits
    with its partitions, as they decide what a task learns.
    """
    rest = F.crc32(F.col(id_col).cast("string")) % folds
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"),
        F.coalesce(rest != 0, F.lit(False)).alias("learned"), (rest == 0).alias("held_out"), F.col(text_col).alias("text"))
    numbered = numbered_blocks(rows, block_bytes)
    classed, classes = counted(numbered, own, shared)
    coded = coded_blocks(numbered, classed, classes)
    model = trained(coded, classes, dims, rounds, seed)
    parts = block_scores(coded, model)
    sums = [F.sum(n).alias(n) for n in ("n_tokens", "n_known")]
    whole = parts.groupBy("row").agg(
        F.first("id").alias("doc_id"), F.first("held_out").alias("held_out"), *sums, F.sum("base").alias("base_score"), F.sum("score").alias("score"))
    return whole.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(int(classes.counts.sum())).cast("long").alias("train_tokens"), "base_score", "score")
