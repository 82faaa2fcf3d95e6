"""Packing by vector bins: sequences under simultaneous limits on tokens,
segments and loss-bearing tokens, filled by the dot-product heuristic.

An example of more than a sequence first fills sequences of its own.  What is
left of it goes whole into the open bin with the largest dot product of the
bin's free shares and the example's demand shares (both relative to the
limits), so a bin rich in what the example needs much of takes it.  If no open
bin can take it whole, it is cut: the bin with the best dot product is filled to
a limit, and the rest tries again.  A bin that the limit on segments or on
loss-bearing tokens closes far from full is cut at powers of two, which need no
padding.  At the end of a partition the emptiest open bins are dealt over the
others, and the last one is cut likewise.

Map-only: every partition packs its own rows as they stream by, with at most
``OPEN`` open bins in memory; a lost task repeats alone and gives the same
sequences.  Sequence ids hold the partition number above 2**40.

Edge cases: null and empty texts give their end id alone; rows with a null or
repeated doc_id are packed like any other; an example whose loss mask is null
counts every token; an empty table gives an empty result; other columns are
ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .tokens import encoder, public_path

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
OPEN = 64
# A sequence is padded by at most this share of its tokens.
SPARE = 64
_FLUSH_BYTES = 4 << 20
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class Limits(NamedTuple):
    tokens: int = 2048
    segments: int = 128
    loss_tokens: int = 2048


class Piece(NamedTuple):
    doc_id: int | None
    start: int
    ids: np.ndarray
    loss: np.ndarray | None  # running count of loss-bearing tokens, 0 first
    doc_tokens: int

    def n_loss(self) -> int:
        return len(self.ids) if self.loss is None else int(self.loss[-1] - self.loss[0])

    def fit(self, tokens: int, loss_tokens: int) -> int:
        """The longest prefix within both."""
        if self.loss is None:
            return min(tokens, loss_tokens, len(self.ids))
        return min(tokens, int(np.searchsorted(self.loss - self.loss[0], loss_tokens, "right")) - 1)

    def cut(self, n: int) -> tuple["Piece", "Piece"]:
        left, right = (None, None) if self.loss is None else (self.loss[:n + 1], self.loss[n:])
        return (Piece(self.doc_id, self.start, self.ids[:n], left, self.doc_tokens),
                Piece(self.doc_id, self.start + n, self.ids[n:], right, self.doc_tokens))


class Packer:
    """Packs a stream of pieces; closed sequences are lists of pieces."""

    def __init__(self, limits: Limits = Limits(), open_bins: int = OPEN):
        self.limits, self.cap = limits, np.array(limits, dtype=np.float64)
        self.open_bins = open_bins
        self.bins: list[list[Piece]] = []
        self.free = np.zeros((0, 3))

    def _put(self, k: int, piece: Piece) -> Iterator[list[Piece]]:
        self.bins[k].append(piece)
        self.free[k] -= (len(piece.ids), 1, piece.n_loss())
        # No token fits any more (or no segment): the sequence is done.
        if self.free[k, 0] <= 0 or self.free[k, 1] <= 0:
            yield from self._done(self._close(k))

    def _close(self, k: int) -> list[Piece]:
        self.free = np.delete(self.free, k, axis=0)
        return self.bins.pop(k)

    def _open(self) -> int:
        self.bins.append([])
        self.free = np.vstack([self.free, self.cap])
        return len(self.bins) - 1

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        while len(piece.ids) >= self.limits.tokens:
            n = piece.fit(self.limits.tokens, self.limits.loss_tokens)
            if n < self.limits.tokens:
                break
            head, piece = piece.cut(n)
            yield [head]
        while len(piece.ids):
            need = np.array([len(piece.ids), 1, piece.n_loss()], dtype=np.float64)
            score = (self.free / self.cap) @ (need / self.cap)
            whole = np.flatnonzero((self.free >= need).all(axis=1))
            if len(whole):
                yield from self._put(int(whole[np.argmax(score[whole])]), piece)
                return
            if len(self.bins) < self.open_bins and (need <= self.cap).all():
                yield from self._put(self._open(), piece)
                return
            # Cut: the open bin with the best product takes a prefix; a bin out
            # of loss-bearing tokens may be able to take none, and is closed.
            if not self.bins:
                self._open()
                continue
            k = int(np.argmax(score)) if len(score) else 0
            n = piece.fit(int(self.free[k, 0]), int(self.free[k, 2]))
            if n <= 0:
                yield from self._done(self._close(k))
                continue
            head, piece = piece.cut(n)
            yield from self._put(k, head)

    def finish(self) -> Iterator[list[Piece]]:
        """Deal the emptiest bins over the fullest, then cut the last at powers
        of two."""
        while len(self.bins) > 1:
            k = int(np.argmax(self.free[:, 0]))
            pieces = self._close(k)
            self.open_bins = len(self.bins)
            for p in pieces:
                yield from self.add(p)
                self.open_bins = max(1, min(self.open_bins, len(self.bins)))
        if self.bins:
            yield from self._done(self._close(0), 0)

    def _done(self, pieces: list[Piece], spare: int | None = None) -> Iterator[list[Piece]]:
        """A closed bin as one sequence, or, if another limit than that of tokens
        closed it and more than ``spare`` tokens would be padding, cut at powers of
        two, which need none."""
        left = sum(len(p.ids) for p in pieces)
        if self.limits.tokens - left <= (self.limits.tokens // SPARE if spare is None else spare):
            yield pieces
            return
        while left:
            size = 1 << (left.bit_length() - 1)
            out, room = [], size
            while room:
                head, rest = pieces[0].cut(min(room, len(pieces[0].ids)))
                out.append(head)
                room -= len(head.ids)
                pieces[:1] = [rest] if len(rest.ids) else []
            yield out
            left -= size


def pack_rows(rows: Iterator[tuple[int | None, np.ndarray, np.ndarray | None]], limits: Limits, first_id: int) -> Iterator[list[tuple]]:
    """Rows of SCHEMA, in lists of one sequence, for (doc_id, ids, loss mask)."""
    packer, n = Packer(limits), first_id

    def out(seq: list[Piece]) -> list[tuple]:
        nonlocal n
        at, done = 0, []
        for p in seq:
            done.append((p.doc_id, p.start, len(p.ids), p.ids.tobytes(), p.doc_tokens, n, at))
            at += len(p.ids)
        n += 1
        return done

    for doc_id, ids, mask in rows:
        run = None if mask is None else np.concatenate([[0], np.cumsum(mask != 0)])
        for seq in packer.add(Piece(doc_id, 0, ids, run, len(ids))):
            yield out(seq)
    for seq in packer.finish():
        yield out(seq)


_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _batches(sequences: Iterator[list[tuple]]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for seq in sequences:
        held += seq
        size += sum(len(r[3]) for r in seq) + 64 * len(seq)
        if size > _FLUSH_BYTES:
            yield _batch(held)
            held, size = [], 0
    yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_ARROW)], schema=_ARROW)


def pack_examples(examples: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Packs rows (doc_id long, ids binary of little-endian 32-bit ids, loss
    binary with one byte a token or null) into pieces of SCHEMA."""
    small_batches(examples.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                for d, ids, loss in zip(*(c.to_pylist() for c in b.columns)):
                    yield d, np.frombuffer(ids or b"", "<u4"), None if loss is None else np.frombuffer(loss, np.uint8)
        yield from _batches(pack_rows(rows(), limits, TaskContext.get().partitionId() << 40))

    return examples.select(F.col("doc_id").cast("long"), "ids", "loss").mapInArrow(run, SCHEMA)


def pack_documents(docs: DataFrame, limits: Limits = Limits(), path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Tokenizes whole texts, ends each with ``end_id`` and packs them; every
    token of a document bears loss."""
    small_batches(docs.sparkSession)
    path = path or public_path(TOKENIZER)
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                for d, ids in zip(b.column(0).to_pylist(), encoder(path).column(b.column(1))):
                    yield d, np.frombuffer(ids + end, "<u4"), None
        yield from _batches(pack_rows(rows(), limits, TaskContext.get().partitionId() << 40))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCHEMA)


def pack_table(docs: DataFrame) -> DataFrame:
    """The pieces of all documents with a digest of their ids."""
    return pack_documents(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
