"""Shared helpers of the training-data operators: scratch tables, safe column
names, vectorised word and n-gram hashing over Arrow text buffers."""
from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path

# Text is processed in slices of about this many UTF-8 bytes (one text at
# least), which bounds the working arrays of a task to some 30 times as much.
SLICE_BYTES = 1 << 20
# ASCII white space of the word rule ``[^\x20\x09-\x0D]+``.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INV = pow(_BASE, -1, 2**64)
_GRAM = (_RNG.integers(1, 2**63, 64, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)

ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
}


_HOME = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def small_batches(spark: SparkSession) -> None:
    """Arrow batches small enough for rows with very long texts, and workers
    that find this package where the driver has it (on clusters that install it
    elsewhere, or ship it with --py-files, the added entry does no harm)."""
    for k, v in ARROW_CONF.items():
        spark.conf.set(k, v)
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if _HOME not in paths:
        env["PYTHONPATH"] = os.pathsep.join(x for x in [_HOME, *paths] if x)


def written(df: DataFrame, name: str = "t") -> DataFrame:
    """Write a frame once as Parquet in this application's part of the shared
    folder (``session.drop_scratch`` removes it) and read it back: cuts lineage,
    and a lost executor only costs a re-read."""
    path = scratch_path(df.sparkSession, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that no column of ``df`` has (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        k = n
        while k.lower() in taken:
            k = "_" + k
        taken.add(k.lower())
        out.append(k)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string array; null counts as empty."""
    arr = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = arr.buffers()
    o = np.frombuffer(offs, dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    d = np.frombuffer(data, dtype=np.uint8)[o[0]:o[-1]] if data is not None and o[-1] > o[0] else np.zeros(0, np.uint8)
    return d, o - o[0]


def text_slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about SLICE_BYTES, with their text buffers."""
    for batch in batches:
        if not batch.num_rows:
            continue
        data, offs = text_buffers(batch.column(batch.schema.get_field_index(text)))
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(offs, offs[a] + SLICE_BYTES, "right")) - 1)
            yield batch.slice(a, b - a), data[offs[a]:offs[b]], offs[a:b + 1] - offs[a]
            a = b


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers 0..n of the base and of its inverse (mod 2^64), kept and grown."""
    if not _POWERS or len(_POWERS[0]) <= n:
        size = 1 << max(SLICE_BYTES.bit_length(), int(n + 1).bit_length())
        steps = np.ones((2, size), dtype=np.uint64)
        steps[0, 1:], steps[1, 1:] = np.uint64(_BASE), np.uint64(_BASE_INV)
        _POWERS[:] = [np.cumprod(x, dtype=np.uint64) for x in steps]
    return _POWERS


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Slice:
    """Words of a slice of texts: ``starts``/``ends`` (byte offsets), ``bounds``
    (first word of each text) and 64-bit hashes of any byte ranges."""

    def __init__(self, data: np.ndarray, offs: np.ndarray):
        self.data, self.offs = data, offs
        n = len(data)
        self.is_word = ~_SPACE[data]
        before = np.zeros(n, dtype=bool)
        after = np.zeros(n, dtype=bool)
        if n:
            before[1:] = self.is_word[:-1]
            after[:-1] = self.is_word[1:]
            cut = offs[(offs > 0) & (offs < n)]
            before[cut] = False
            after[cut - 1] = False
        self.starts = np.flatnonzero(self.is_word & ~before)
        self.ends = np.flatnonzero(self.is_word & ~after) + 1
        self.bounds = np.searchsorted(self.starts, offs)
        self._sums: np.ndarray | None = None

    def per_text(self, mask: np.ndarray) -> np.ndarray:
        """Sum of a per-byte mask in each text."""
        c = np.zeros(len(mask) + 1, dtype=np.int64)
        np.cumsum(mask, out=c[1:])
        return c[self.offs[1:]] - c[self.offs[:-1]]

    def hashes(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        if self._sums is None:
            n = len(self.data)
            up = _powers(n)[0]
            self._sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(_BYTE[self.data] * up[:n], dtype=np.uint64, out=self._sums[1:])
        h = (self._sums[e] - self._sums[s]) * _powers(len(self.data))[1][s]
        return mix(h + (e - s).astype(np.uint64))

    def grams(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each window of ``width`` words within one text, and the
        index of its first word."""
        w = self.hashes(self.starts, self.ends)
        if len(w) < width:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        last = np.repeat(self.bounds[1:], np.diff(self.bounds))
        first = np.flatnonzero(np.arange(len(w)) + width <= last)
        g = np.zeros(len(first), dtype=np.uint64)
        for k in range(width):
            g += w[first + k] * _GRAM[k]
        return mix(g), first
