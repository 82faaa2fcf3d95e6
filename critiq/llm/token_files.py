"""Token-id files written by an adaptive context-mixing range coder.

Ids are coded in blocks that start from empty models and carry checksums, so any
block decodes alone.  A block's ids are cut into up to ``LANES`` equal runs that
are coded side by side, one id of each run a step, all sharing three adaptive
predictors that learn after every step:

* order 0: counts of all ids, as cumulative frequencies that are added up anew
  once the ids counted have grown by a sixteenth;
* order 1: the id that last proved right after the previous id;
* order 2: the same after the two previous ids (hashed).

The coder's interval for an id comes from their mixture: the order-2 and order-1
candidates get shares that follow how often candidates of the same confidence
have been right so far in this block, and order 0 shares the rest.  Each run has
a carry-less range coder of its own with 64-bit state and 16-bit output words.

A file set is a Parquet table with one row a block (part, block, start of its
ids in the part, number of ids, payload), written and read by Spark so that any
store Spark reaches will do.  Parts are ranges of doc_id in ascending order; a
part is encoded as it streams by, with one block in memory.

Block payload, little-endian: magic ``CMR1``; u32 vocabulary size, ids,
documents, lanes; u32 crc32 of the ids and of the rest of the payload; per
document i64 doc_id, u8 null flag and u32 ids; per lane u16 words; the words.

Edge cases: null and empty texts hold the end id alone; null doc_ids come first;
rows with equal doc_id keep the order of the scan; an empty table gives no
blocks and an empty result; a text beyond the block size makes a longer block;
other columns are ignored.  A damaged block raises ``ValueError``.
"""
from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import small_batches
from .tokens import TEXT_BYTES, encoder, gathered, public_path

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
VOCABULARY = 50_257
BLOCK_IDS = 1 << 20
LANES = 8192
RUN = 128
_MAGIC = b"CMR1"
_HEAD = struct.Struct("<4sIIIIII")
_TOTAL_BITS = 24
_TOTAL = 1 << _TOTAL_BITS
_STEP = 15  # weight of one occurrence in the order-0 counts
_SLOTS = 1 << 18
U = np.uint64
# Change of a candidate's confidence, if it was wrong and if it was right.
_STEPS = np.array([(k >> 1) - k for k in range(16)] + [min(k + 1, 15) - k for k in range(16)], dtype=np.int32)


class Mixer:
    """The three predictors and their shares, for one block.  A predictor's
    table holds 16 * candidate + confidence; -16 is no candidate."""

    def __init__(self, vocabulary: int, lanes: int):
        self.weight = np.ones(vocabulary, dtype=np.int64)
        self.cum = np.arange(vocabulary + 1, dtype=np.int64)
        # Halving steps of a search in ``cum``, the longest first.
        self.halves = [1 << k for k in range(max(1, vocabulary).bit_length() - 1, -1, -1)]
        self.top = np.full((1 << max(1, vocabulary).bit_length()) + 1, 1 << 62, dtype=np.int64)
        self.table1 = np.full(vocabulary + 1, -16, dtype=np.int32)
        self.table2 = np.full(_SLOTS, -16, dtype=np.int32)
        # Right and tried candidates by confidence (order 2: and by agreement).
        self.right1, self.tried1 = np.full(16, 1.0), np.full(16, 4.0)
        self.right2, self.tried2 = np.full(32, 1.0), np.full(32, 4.0)
        self.c1 = np.full(lanes, vocabulary, dtype=np.int64)
        self.c2 = np.zeros(lanes, dtype=np.int64)
        self.limit = max(1, ((1 << 22) - vocabulary) // _STEP)
        self.seen = self.fresh = 0
        self.refresh()

    def refresh(self) -> None:
        np.cumsum(self.weight, out=self.cum[1:])
        self.top[:len(self.cum)] = self.cum
        self.total = int(self.cum[-1])
        self.fresh = self.seen

    def predict(self) -> None:
        self.v2, self.v1 = self.table2[self.c2], self.table1[self.c1]
        self.a, self.b = self.v2 >> 4, self.v1 >> 4
        agree = (self.a == self.b) * np.int32(16)
        self.k1, self.k2 = (self.v1 & 15) + agree, (self.v2 & 15) + agree
        # Confidence 0 is no candidate; order 1 has no share where both agree.
        share = (0.7 * _TOTAL * np.minimum(1.0, self.right2 / self.tried2)).astype(np.int64)
        share[::16] = 0
        self.share2 = share[self.k2]
        share = np.zeros(32)
        share[1:16] = (0.95 * self.right1 / self.tried1)[1:]
        self.share1 = ((0.75 * _TOTAL - self.share2) * share[self.k1]).astype(np.int64)
        self.base = self.share2 + self.share1
        self.rest = _TOTAL - self.base

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of each id in the mixture."""
        lo = self.cum[ids] * self.rest // self.total
        width = self.cum[ids + 1] * self.rest // self.total - lo
        lo += self.base
        short = ids.astype(np.int32)
        hit1 = (short == self.b) & (self.share1 > 0)
        hit2 = (short == self.a) & (self.share2 > 0)
        for hit, start, share in ((hit1, self.share2, self.share1), (hit2, 0, self.share2)):
            np.copyto(lo, start, where=hit)
            np.copyto(width, share, where=hit)
        return lo, width

    def find(self, at: np.ndarray) -> np.ndarray:
        """The id whose interval holds each point."""
        ids = np.where(at < self.share2, self.a, self.b).astype(np.int64)
        left = np.flatnonzero(at >= self.base)
        point = ((at[left] - self.base[left] + 1) * self.total - 1) // self.rest[left]
        # All points go down the halves together, which no branch holds up.
        found = np.zeros(len(left), dtype=np.int64)
        for half in self.halves:
            found += (self.top[found + half] <= point) * half
        ids[left] = found
        return ids

    def learn(self, ids: np.ndarray) -> None:
        short = ids.astype(np.int32)
        same2, same1 = short == self.a, short == self.b
        n = np.bincount(self.k2 + same2 * np.int32(32), minlength=64)
        self.right2 += n[32:]
        self.tried2 += n[:32] + n[32:]
        n = np.bincount((self.k1 & 15) + same1 * np.int32(16) + same2 * np.int32(32), minlength=64)
        self.right1 += n[16:32]
        self.tried1 += n[:16] + n[16:32]
        short *= 16
        short += 1
        for table, ctx, old, same in ((self.table2, self.c2, self.v2, same2), (self.table1, self.c1, self.v1, same1)):
            # Right: surer.  Wrong: half as sure, or replaced.
            k = old & 15
            now = old + _STEPS[k + same * np.int32(16)]
            np.copyto(now, short, where=(k < 2) & ~same)
            table[ctx] = now
        if self.seen < self.limit:
            np.add.at(self.weight, ids, _STEP)
            self.seen += len(ids)
            if self.seen - self.fresh >= self.fresh >> 4:
                self.refresh()
        self.c2 = ((self.c1 * 0x9E3779B1 + ids * 0x85EBCA6B) >> 7) & (_SLOTS - 1)
        self.c1 = ids


def _lanes(n: int) -> tuple[int, int]:
    lanes = max(1, min(LANES, n // RUN))
    return lanes, -(-n // lanes) if n else 0


def _shifts(low: np.ndarray, rng: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Shifts settled words out of the lanes until none is left: yields the lanes
    that shift and the words they give, and updates both arrays."""
    go, x, y = None, low, rng
    while True:
        settled = ((x ^ (x + y)) >> U(48)) == 0
        small = (y < U(2**32)) & ~settled
        some = np.flatnonzero(settled | small)
        if not len(some):
            return
        go = some if go is None else go[some]
        x, y, tight = x[some], y[some], small[some]
        if tight.any():
            y[tight] = (~x[tight] + U(1)) & U(2**32 - 1)
        words = (x >> U(48)).astype(np.uint16)
        x, y = x << U(16), y << U(16)
        low[go], rng[go] = x, y
        yield go, words


def compress_ids(ids: np.ndarray, vocabulary: int) -> tuple[int, np.ndarray, np.ndarray]:
    """(lanes, words in each lane, all words) of the ids of a block."""
    lanes, steps = _lanes(len(ids))
    grid = np.zeros(lanes * steps, dtype=np.int64)
    grid[:len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model = Mixer(vocabulary, lanes)
    low, rng = np.zeros(lanes, dtype=U), np.full(lanes, 2**64 - 1, dtype=U)
    out = np.zeros((lanes, 3 * steps + 8), dtype="<u2")
    cells, pos = out.reshape(-1), np.arange(lanes) * out.shape[1]
    for t in range(steps):
        model.predict()
        lo, width = model.interval(grid[t])
        unit = rng >> U(_TOTAL_BITS)
        low += unit * lo.view(U)
        rng = unit * width.view(U)
        for go, first in _shifts(low, rng):
            cells[pos[go]] = first
            pos[go] += 1
        model.learn(grid[t])
    pos -= np.arange(lanes) * out.shape[1]
    if steps:
        # Two more words name a point inside every final interval.
        end = (low + U(2**32 - 1)) >> U(32)
        every = np.arange(lanes)
        for shift in (16, 0):
            out[every, pos] = ((end >> U(shift)) & U(0xFFFF)).astype(np.uint16)
            pos += 1
    return lanes, pos, out[np.arange(out.shape[1]) < pos[:, None]]


def expand_ids(n: int, lanes: int, counts: np.ndarray, words: np.ndarray, vocabulary: int) -> np.ndarray:
    """The ids of a block from its words."""
    steps = -(-n // lanes) if n else 0
    start = np.concatenate([[0], np.cumsum(counts)])[:-1].astype(np.int64)
    stream = np.concatenate([words.astype(U), np.zeros(8, dtype=U)])
    stop = start + counts

    def word(which: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.where(at < stop[which], stream[np.minimum(at, len(stream) - 1)], U(0))

    every = np.arange(lanes)
    code, pos = np.zeros(lanes, dtype=U), start.copy()
    for _ in range(4):
        code = (code << U(16)) | word(every, pos)
        pos += 1
    model = Mixer(vocabulary, lanes)
    low, rng = np.zeros(lanes, dtype=U), np.full(lanes, 2**64 - 1, dtype=U)
    grid = np.zeros((steps, lanes), dtype=np.int64)
    for t in range(steps):
        model.predict()
        unit = rng >> U(_TOTAL_BITS)
        at = np.minimum((code - low) // unit, U(_TOTAL - 1)).astype(np.int64)
        ids = model.find(at)
        lo, width = model.interval(ids)
        low += unit * lo.view(U)
        rng = unit * width.view(U)
        for go, _ in _shifts(low, rng):
            code[go] = (code[go] << U(16)) | word(go, pos[go])
            pos[go] += 1
        grid[t] = ids
        model.learn(ids)
    return grid.T.reshape(-1)[:n]


def write_block(docs: list[tuple[int | None, bytes]], vocabulary: int = VOCABULARY) -> bytes:
    """Payload of (doc_id, ids as little-endian u32 bytes) rows."""
    raw = b"".join(b for _, b in docs)
    ids = np.frombuffer(raw, dtype="<u4").astype(np.int64)
    if len(ids) and ids.max() >= vocabulary:
        raise ValueError("an id is not in the vocabulary")
    lanes, counts, words = compress_ids(ids, vocabulary)
    body = b"".join([
        np.array([d or 0 for d, _ in docs], dtype="<i8").tobytes(),
        np.array([d is None for d, _ in docs], dtype="u1").tobytes(),
        np.array([len(b) // 4 for _, b in docs], dtype="<u4").tobytes(),
        counts.astype("<u2").tobytes(), words.tobytes()])
    return _HEAD.pack(_MAGIC, vocabulary, len(ids), len(docs), lanes, zlib.crc32(raw), zlib.crc32(body)) + body


def read_block(payload: bytes) -> list[tuple[int | None, bytes]]:
    """The rows of a payload; raises ValueError if anything in it is damaged."""
    if len(payload) < _HEAD.size:
        raise ValueError("block too short")
    magic, vocabulary, n, n_docs, lanes, ids_crc, body_crc = _HEAD.unpack_from(payload)
    body = payload[_HEAD.size:]
    if magic != _MAGIC or zlib.crc32(body) != body_crc:
        raise ValueError("damaged block")
    at = 0

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(body, dtype=kind, count=count, offset=at)
        at += out.nbytes
        return out

    names, nulls, sizes, counts = take("<i8", n_docs), take("u1", n_docs), take("<u4", n_docs), take("<u2", lanes).astype(np.int64)
    raw = expand_ids(n, lanes, counts, take("<u2", int(counts.sum())), vocabulary).astype("<u4").tobytes()
    if zlib.crc32(raw) != ids_crc:
        raise ValueError("damaged ids")
    cut = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))]) * 4
    return [(None if z else int(d), raw[a:b]) for d, z, a, b in zip(names, nulls, cut, cut[1:])]


def encode_documents(docs: DataFrame, path: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks (part, block, start, n_ids, payload) of all texts in ascending
    doc_id order; ``start`` counts the ids before the block in its part."""
    small_batches(docs.sparkSession)
    path = path or public_path(TOKENIZER)
    end = np.array([end_id], dtype="<u4").tobytes()
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("at"))
    # Ranges of (doc_id, position), so that one id with many rows is split too.
    order = [F.col("doc_id").asc_nulls_first(), F.col("at").asc()]
    ranged = narrow.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, start = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[int | None, bytes]] = []
        size = 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([start], pa.int64()), pa.array([size], pa.int64()),
                                               pa.array([write_block(held)], pa.binary())], names=["part", "block", "start", "n_ids", "payload"])

        for b in gathered(batches, TEXT_BYTES // 2):
            for d, ids in zip(b.column(0).to_pylist(), encoder(path).column(b.column(1))):
                ids += end
                held.append((d, ids))
                size += len(ids) // 4
                if size >= block_ids:
                    yield close()
                    block, start, held, size = block + 1, start + size, [], 0
        if held:
            yield close()

    return ranged.mapInArrow(run, "part int, block int, start long, n_ids long, payload binary")


def write_files(docs: DataFrame, path: str, **options) -> None:
    """Encodes all texts into a file set at ``path``."""
    encode_documents(docs, **options).write.option("compression", "uncompressed").parquet(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (little-endian u32
    bytes) of each document of a file set."""
    small_batches(spark)
    blocks = spark.read.schema("part int, block int, start long, n_ids long, payload binary").parquet(path)
    # One row a part: bounded by the partitions that wrote the files.
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.coalesce(before, F.lit(0)).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, start, payload in zip(*(b.column(k).to_pylist() for k in (0, 1, 2))):
                rows = read_block(payload)
                sizes = np.cumsum([0] + [len(x) // 4 for _, x in rows])[:-1]
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(rows), pa.int32()), pa.array([d for d, _ in rows], pa.int64()),
                                                  pa.array(start + sizes, pa.int64()), pa.array([x for _, x in rows], pa.binary())], names=["part", "doc_id", "within", "ids"])

    rows = blocks.select("part", "start", "payload").mapInArrow(run, "part int, doc_id long, within long, ids binary")
    return rows.join(F.broadcast(parts), "part").select("doc_id", (F.col("before") + F.col("within")).alias("start"), "ids")


def token_table(docs: DataFrame) -> DataFrame:
    """Writes the files of all documents in the shared folder, reads them back
    and returns doc_id, start, n_tokens and a digest of each document's ids."""
    path = scratch_path(docs.sparkSession, f"llm/token-files-{uuid.uuid4().hex}")
    write_files(docs, path)
    return read_files(docs.sparkSession, path).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
