"""Token ids in a columnar binary format: fixed-size id blocks, transposed into bit or byte planes,
each plane compressed with zstandard, with a chunk index beside them.

A written folder is a Parquet table with one row per chunk. `planes` holds the compressed planes, the
other columns are the chunk index, so an index scan reads no payload. Files are committed by Spark's
writer, on any file system Spark reaches, and a lost executor's chunks are written again.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelops.llm.common import map_batches, text_bytes

BLOCK_IDS = 1 << 16
LEVEL = 3
#: Distinct pieces a worker keeps ids for; beyond it the table starts anew, ids stay the same.
CACHED_PIECES = 400_000
#: Bytes of texts a worker encodes at once, unless one text is longer; its arrays take about 60 times that.
AT_ONCE = 1 << 19
#: Bytes beyond which a piece's ids are not kept.
LONG_PIECE = 64
#: Pieces encoded by one call.
JOINED = 50
CHUNKS = (
    "shard int, chunk int, n_ids int, crc32 long, kind string, planes array<binary>, "
    "doc_id array<long>, doc_row array<long>, doc_ids array<int>, doc_starts array<boolean>, doc_ends array<boolean>"
)
PARTS = "shard int, doc_row long, doc_id long, chunk int, first long, n long, crc32 long, ids binary"

class PieceEncoder:
    """Encodes whole texts with a byte-level BPE tokenizer, keeping the ids of repeated pieces.

    The tokenizer encodes every distinct piece; a text's ids are its pieces' ids in order. Texts are cut
    only where the pre-tokenizer cuts whatever stands around (`piece_starts`), so the ids are those of
    the whole text. Known pieces are found by a 64-bit hash of their bytes (random tables, fixed seed)
    in an open-addressing table; pieces of over `LONG_PIECE` bytes are encoded each time.
    """

    def __init__(self, path: str, cached: int = CACHED_PIECES):
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has the cores
        self.tokenizer = Tokenizer.from_file(path)
        (self.line_end,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        rng = np.random.default_rng(0)
        self.by_byte = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.by_place = rng.integers(1, 1 << 63, LONG_PIECE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.cached = cached
        self._clear(0)

    def _clear(self, needed: int) -> None:
        self.room = max(self.cached, needed)
        self.bits = max(8, int(2 * self.room - 1).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)  # 0: free
        self.slot_piece = np.zeros(1 << self.bits, np.int32)
        self.n_pieces = 0
        self.first, self.count = np.zeros(1024, np.int64), np.zeros(1024, np.int32)
        self.ids, self.n_ids = np.zeros(4096, np.uint32), 0

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Piece numbers of keys, -1 where unknown."""
        out = np.full(len(keys), -1, np.int32)
        slot, left = (keys >> np.uint64(64 - self.bits)).astype(np.int64), np.arange(len(keys))
        while len(left):
            held = self.keys[slot]
            hit = held == keys[left]
            out[left[hit]] = self.slot_piece[slot[hit]]
            on = ~hit & (held != 0)
            left, slot = left[on], (slot[on] + 1) & (len(self.keys) - 1)
        return out

    def _add(self, keys: np.ndarray, count: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Stores distinct unknown keys with their ids; returns their piece numbers."""
        numbers = np.arange(self.n_pieces, self.n_pieces + len(keys), dtype=np.int32)
        self.n_pieces += len(keys)
        self.first, self.count = grown(self.first, self.n_pieces), grown(self.count, self.n_pieces)
        self.first[numbers], self.count[numbers] = self.n_ids + np.cumsum(count) - count, count
        self.ids = grown(self.ids, self.n_ids + len(ids))
        self.ids[self.n_ids:self.n_ids + len(ids)] = ids
        self.n_ids += len(ids)
        slot, left = (keys >> np.uint64(64 - self.bits)).astype(np.int64), np.arange(len(keys))
        while len(left):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = keys[left[free]]
            won = free & (self.keys[slot] == keys[left])
            self.slot_piece[slot[won]] = numbers[left[won]]
            left, slot = left[~won], (slot[~won] + 1) & (len(self.keys) - 1)
        return numbers

    def _code(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each piece has, and the ids of all. Pieces without white space but a leading
        space go many to a call, between line ends."""
        texts = ["\n".join(pieces[i:i + JOINED]) for i in range(0, len(pieces), JOINED)]
        if all(len(p.split()) == 1 and not p[-1].isspace() and (p[0] == " " or not p[0].isspace()) and not p[1:2].isspace() for p in pieces):
            coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
            ids = np.concatenate([np.asarray([*c.ids, self.line_end], np.uint32) for c in coded])
            ends = np.flatnonzero(ids == self.line_end)
            if len(ends) == len(pieces):
                return np.diff(ends, prepend=-1) - 1, np.delete(ids, ends)
        coded = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        lists = [c.ids for c in coded]
        return np.fromiter(map(len, lists), np.int64, len(lists)), np.asarray(list(chain.from_iterable(lists)), np.uint32)

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts behind each other, and where each text's begin (and the last end); `data` and
        `at` as `text_bytes` gives them."""
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(at), np.int64)
        start = piece_starts(data, at)
        ends = np.append(start[1:], len(data))
        size = ends - start
        place = np.arange(len(data), dtype=np.int32) - np.repeat(start.astype(np.int32), size)
        terms = self.by_byte[data] * self.by_place[np.minimum(place, LONG_PIECE - 1)]
        keys = np.add.reduceat(terms, start)
        keys += size.astype(np.uint64) * self.by_place[0]
        keys ^= keys >> np.uint64(32)
        keys *= self.by_byte[1]
        keys[keys == 0] = 1
        long = np.flatnonzero(size > LONG_PIECE)
        number = self._find(keys)
        number[long] = -1
        new = np.flatnonzero(number < 0)
        new = new[size[new] <= LONG_PIECE]
        raw = data.tobytes()
        if len(new):
            distinct, sample = np.unique(keys[new], return_index=True)
            if self.n_pieces + len(distinct) > self.room:
                self._clear(len(distinct))
                return self.encode(data, at)
            pieces = [raw[start[i]:ends[i]].decode() for i in new[sample]]
            plain = np.asarray([p.isascii() and p.isprintable() and " " not in p[1:] and p != " " or is_latin(p[p[0] == " ":]) for p in pieces])
            known = np.empty(len(pieces), np.int32)
            for part in (np.flatnonzero(plain), np.flatnonzero(~plain)):
                if len(part):
                    known[part] = self._add(distinct[part], *self._code([pieces[i] for i in part]))
            number[new] = known[np.searchsorted(distinct, keys[new])]
        count, first, ids = self.count[number], self.first[number], self.ids
        if len(long):
            count[long], coded = self._code([raw[start[i]:ends[i]].decode() for i in long])
            first[long] = self.n_ids + np.cumsum(count[long]) - count[long]
            ids = np.concatenate([ids[:self.n_ids], coded])
        before = np.append(0, np.cumsum(count, dtype=np.int64))
        out = ids[np.repeat(first - before[:-1], count) + np.arange(before[-1])]
        return out, before[np.searchsorted(start, at)]


    def encode_each(self, data: np.ndarray, at: np.ndarray) -> Iterator[bytes]:
        """Little-endian 32-bit ids of text after text, of which about `AT_ONCE` bytes are in work."""
        a = 0
        while a < len(at) - 1:
            b = max(a + 1, int(np.searchsorted(at, at[a] + AT_ONCE, side="right")) - 1)
            ids, begin = self.encode(data[at[a]:at[b]], at[a:b + 1] - at[a])
            raw = ids.astype("<u4").tobytes()
            yield from (raw[4 * x:4 * y] for x, y in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True))
            a = b


def grown(values: np.ndarray, size: int) -> np.ndarray:
    """`values`, copied to twice the length if it is shorter than `size`."""
    if size <= len(values):
        return values
    out = np.zeros(2 * size, values.dtype)
    out[:len(values)] = values
    return out


def is_latin(piece: str) -> bool:
    """Letters of the Latin blocks only, on which all Unicode versions agree."""
    return piece.isalpha() and (piece.isascii() or max(piece) < "\u0250")


def byte_flags(**sets: bytes) -> tuple[np.ndarray, dict[str, np.uint8]]:
    """A table with a bit for each set of bytes, and the bits by name."""
    table, bits = np.zeros(256, np.uint8), {}
    for k, (name, values) in enumerate(sets.items()):
        bits[name] = np.uint8(1 << k)
        table[np.frombuffer(values, np.uint8)] |= bits[name]
    return table, bits


FLAGS, BIT = byte_flags(
    space=b"\t\n\v\f\r ",
    solid=bytes(range(33, 127)),  # ASCII that no library takes for white space
    lead=bytes(range(0xC3, 0xE0)),  # of two-byte characters, none of which is white space
    latin=bytes(range(0xC3, 0xCA)),  # of two-byte letters, but for two signs
    letter=bytes([*range(65, 91), *range(97, 123)]),
    mark=b".,;:!?#$%&*()",
    line_end=b"\n",
    sign=bytes([0x97, 0xB7]),  # second bytes of the two signs
)


def piece_starts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places where a byte-level pre-tokenizer starts a piece whatever stands around: at white space
    after something else, after a lone line end before a letter, between a letter and a mark."""
    flags = np.append(FLAGS[data], np.uint8(0))
    here, prev = flags[1:-1], flags[:-2]
    trail = (prev & (BIT["solid"] | BIT["space"])) == 0  # a byte of a longer character, or a control sign
    trail &= data[:-1] >= 0x80
    two = np.zeros(len(prev), bool)
    two[1:] = (flags[:-3] & BIT["lead"]) != 0
    two &= trail
    latin = np.zeros(len(prev), bool)
    latin[1:] = (flags[:-3] & BIT["latin"]) != 0
    latin &= trail & ((prev & BIT["sign"]) == 0)
    solid = ((prev & BIT["solid"]) != 0) | two
    letter = ((prev & BIT["letter"]) != 0) | latin
    letter_here = ((here & BIT["letter"]) != 0) | ((here & BIT["latin"]) != 0) & ((flags[2:] & BIT["sign"]) == 0)
    after_end = (prev & BIT["line_end"]) != 0
    after_end[:1] = False
    after_end[1:] &= solid[:-1]
    start = np.empty(len(data), bool)
    cut = start[1:]
    np.bitwise_and(solid, (here & BIT["space"]) != 0, out=cut)
    cut |= letter & ((here & BIT["mark"]) != 0)
    cut |= (after_end | ((prev & BIT["mark"]) != 0)) & letter_here
    start[at[:-1][at[:-1] < len(data)]] = True
    return np.flatnonzero(start)


def to_planes(ids: bytes, kind: str, level: int = LEVEL) -> list[bytes]:
    """The planes of a block of little-endian 32-bit ids, compressed: 4 of bytes or 32 of bits."""
    if kind not in ("byte", "bit"):
        raise ValueError(f"planes are of kind byte or bit, not {kind}")
    rows = np.frombuffer(ids, np.uint8).reshape(-1, 4)
    if kind == "bit":
        rows = np.unpackbits(rows, axis=1, bitorder="little")
    planes = np.ascontiguousarray(rows.T)
    if kind == "bit":
        planes = np.packbits(planes, axis=1, bitorder="little")
    pack = zstandard.ZstdCompressor(level=level)
    return [pack.compress(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes], n_ids: int, kind: str) -> bytes:
    """The ids of a block as little-endian 32-bit integers."""
    unpack = zstandard.ZstdDecompressor()
    rows = np.stack([np.frombuffer(unpack.decompress(p), np.uint8) for p in planes])
    if kind == "bit":
        bits = np.unpackbits(rows, axis=1, bitorder="little", count=n_ids)
        rows = np.packbits(bits.T, axis=1, bitorder="little").T
    return np.ascontiguousarray(rows[:, :n_ids].T).tobytes()


def write_ids(
    docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = 2, block: int = BLOCK_IDS, kind: str = "byte", level: int = LEVEL,
) -> None:
    """Encodes whole texts and writes their ids to `path` in ascending order of `id_col`.

    Documents are dealt by ranges of (id, text), so shards are in order and no id has to fit one task
    unless its rows are equal throughout. NULL ids come first; NULL texts are empty and hold the end
    id only. Equal ids are ordered by text. An empty table gives an empty folder. Memory per task: one
    Arrow batch and one block.
    """
    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = ordered.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        shard, end = TaskContext.get().partitionId(), np.asarray([end_id], "<u4").tobytes()
        coder = worker_encoder(tokenizer_path)
        held, doc, chunk, row = bytearray(), [], 0, 0

        def cut() -> dict[str, list]:
            nonlocal held, doc, chunk
            ids = bytes(held)
            out = {
                "shard": [shard], "chunk": [chunk], "n_ids": [len(ids) // 4], "crc32": [zlib.crc32(ids)], "kind": [kind],
                "planes": [to_planes(ids, kind, level)], "doc_id": [[d[0] for d in doc]], "doc_row": [[d[1] for d in doc]],
                "doc_ids": [[d[2] for d in doc]], "doc_starts": [[d[3] for d in doc]], "doc_ends": [[d[4] for d in doc]],
            }
            held, doc, chunk = bytearray(), [], chunk + 1
            return out

        for batch in batches:
            for i, ids in zip(batch.column(0).to_pylist(), coder.encode_each(*text_bytes(batch.column(1))), strict=True):
                ids += end
                at = 0
                while at < len(ids):
                    part = ids[at:at + 4 * block - len(held)]
                    at += len(part)
                    held += part
                    doc.append((i, row, len(part) // 4, at == len(part), at == len(ids)))
                    if len(held) == 4 * block:
                        yield cut()
                row += 1
        if held:
            yield cut()

    map_batches(ordered, encode, CHUNKS).write.option("compression", "uncompressed").parquet(path)


ENCODERS: dict[str, PieceEncoder] = {}


def worker_encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker, which later tasks of the worker use again."""
    if path not in ENCODERS:
        ENCODERS[path] = PieceEncoder(path)
    return ENCODERS[path]


def read_parts(spark: SparkSession, path: str, block: int = BLOCK_IDS) -> DataFrame:
    """Decodes the chunks at `path`: a row per document and chunk, `first` being the place of its ids in
    the shard. `ids` is filled where a document goes on in another chunk, else only its checksum."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
        for batch in batches:
            for c in batch.to_pylist():
                ids = from_planes(c["planes"], c["n_ids"], c["kind"])
                if zlib.crc32(ids) != c["crc32"]:
                    raise ValueError(f"chunk {c['chunk']} of shard {c['shard']} is damaged")
                n = np.asarray(c["doc_ids"], np.int64)
                ends = np.cumsum(n)
                parts = [ids[4 * (e - k):4 * e] for e, k in zip(ends.tolist(), n.tolist(), strict=True)]
                size, whole = len(parts), [s and e for s, e in zip(c["doc_starts"], c["doc_ends"], strict=True)]
                yield {
                    "shard": [c["shard"]] * size, "doc_row": c["doc_row"], "doc_id": c["doc_id"], "chunk": [c["chunk"]] * size,
                    "first": (ends - n + c["chunk"] * block).tolist(), "n": n.tolist(),
                    "crc32": [zlib.crc32(p) if w else None for p, w in zip(parts, whole, strict=True)],
                    "ids": [None if w else p for p, w in zip(parts, whole, strict=True)],
                }

    return map_batches(spark.read.parquet(path), decode, PARTS)


def read_documents(spark: SparkSession, path: str, block: int = BLOCK_IDS) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens and
    ids_crc32. Parts are few per document; shards are as many as the writer had tasks."""
    parts = read_parts(spark, path, block).groupBy("shard", "doc_row").agg(
        F.min("doc_id").alias("doc_id"), F.min("first").alias("first"), F.sum("n").alias("n_tokens"),
        F.max("crc32").alias("crc32"),
        F.sort_array(F.collect_list(F.when(F.col("ids").isNotNull(), F.struct("chunk", "ids")))).alias("ids"),
    )
    joined = F.aggregate(F.transform("ids", lambda p: p["ids"]), F.lit(b""), lambda a, b: F.concat(a, b))
    shards = spark.read.parquet(path).groupBy("shard").agg(F.sum(F.col("n_ids").cast("long")).alias("size"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = shards.select(F.col("shard").alias("_s"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return parts.join(F.broadcast(offsets), F.col("shard") == F.col("_s")).select(
        "doc_id", (F.col("offset") + F.col("first")).alias("start"), "n_tokens",
        F.coalesce("crc32", F.crc32(joined)).alias("ids_crc32"),
    )
