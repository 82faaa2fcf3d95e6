"""Importance resampling towards a target distribution.

Features are runs of 1 to ``run`` consecutive words, hashed into buckets.  A
bucket's gain is the log ratio of its smoothed shares in the target and in the
corpus; a document weighs the sum of its features' gains, and Gumbel noise from
a hash of its id turns a top-k draw into sampling without replacement.

How it runs:

* bucket counts: every task adds its texts into one array of ``buckets``
  counts and emits that, so the shuffle holds at most ``buckets`` rows a task
  however hot a word is; the sums (``buckets`` rows) make the array of gains;
* scores: a map-only pass looks the features up in the array; the narrow
  result is written once;
* cutoff: bisection of the score range, five levels a job: one aggregate
  counts the rows above 31 thresholds.  Rows tied at the cutoff are
  bisected by doc_id, and equal ids by the number of their written row, so
  exactly the wanted number is drawn without sorting the table;
* ranks: only the drawn rows are range-partitioned and sorted; a rank is the
  offset of the partition plus the position in it.

Edge cases: null and empty texts have no features (weight 0); rows without
doc_id count in the corpus but have no score and are never drawn; repeated rows
are drawn one by one; an empty corpus or target gives gains by smoothing alone;
the columns of ``keep`` are carried along, all others are ignored.
"""
from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, text_slices, written

BUCKETS = 10_000
RUN = 1
SEED = "2024"
LEAST_WORDS = 20
PERCENT = 10
MEMO = 400_000
# Bisection: thresholds a job, i.e. five levels.
PROBES = 31
# FIXED VALUE: words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing
# A-Z: digits, a-z and everything beyond ASCII; all other bytes become spaces.
_LETTERS = bytes(range(0x41, 0x5B))
WORD_BYTES = bytes(b + 32 if b in _LETTERS else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                   for b in range(256))


class _BucketOf(dict):
    """feature -> bucket, with a bounded memo."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        bucket = zlib.crc32(feature) % self.buckets
        if len(feature) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[feature] = bucket
        return bucket


def _texts(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """Slices of rows with the words of each text."""
    for batch, data, offs in text_slices(batches, text):
        low = data.tobytes().translate(WORD_BYTES)
        yield batch, [low[a:b].split() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]


def _buckets(words: list[bytes], run: int, bucket_of: _BucketOf) -> np.ndarray:
    """Bucket of each feature of one text."""
    if run == 1:
        return np.fromiter(map(bucket_of.__getitem__, words), np.int64, len(words))
    runs = chain.from_iterable((b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)) for n in range(1, run + 1))
    return np.fromiter(map(bucket_of.__getitem__, runs), np.int64)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, run: int = RUN) -> DataFrame:
    """(bucket, n) over all features of ``text``; absent buckets are left out."""
    small_batches(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, bucket_of = np.zeros(buckets, np.int64), _BucketOf(buckets)
        for _, texts_words in _texts(batches, "text"):
            for words in texts_words:
                if words:
                    total += np.bincount(_buckets(words, run, bucket_of), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    part = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    return part.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS, run: int = RUN) -> np.ndarray:
    """floor(1000 ln(smoothed target share / smoothed corpus share)) of every
    bucket; at most ``buckets`` rows a side come to the driver."""
    sides = []
    for df in (corpus, target):
        n = [0] * buckets
        for row in bucket_counts(df, buckets, run).collect():
            n[row["bucket"]] = row["n"]
        sides.append((n, sum(n)))
    (s, S), (t, T) = sides
    return np.array([math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)], np.int64)


def importance_scores(docs: DataFrame, gains: np.ndarray, run: int = RUN, seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) and the ``keep`` columns."""
    small_batches(docs.sparkSession)
    carried = {f"_keep{i}": c for i, c in enumerate(keep)}
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *[F.col(f"`{c}`").alias(k) for k, c in carried.items()])
    kinds = "".join(f", {k} {rows.schema[k].dataType.simpleString()}" for k in carried)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket_of = _BucketOf(len(gains))
        for batch, texts_words in _texts(batches, "text"):
            found = [_buckets(words, run, bucket_of) for words in texts_words]
            cols = [[len(w) for w in texts_words], [len(f) for f in found], [int(gains[f].sum()) for f in found]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in cols], *batch.columns[2:]],
                                             names=["doc_id", "n_words", "n_features", "weight", *carried])

    x = rows.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long" + kinds)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return x.withColumn("score", F.col("weight") + noise).select("doc_id", "n_words", "n_features", "weight", "score", *[F.col(k).alias(c) for k, c in carried.items()])


def least_reaching(rows: DataFrame, key: Column, want: int) -> int:
    """The largest integer v such that at least ``want`` rows have key >= v, by
    bisection with exact counts (``want`` is at least 1 and at most the rows)."""
    lo, hi = rows.agg(F.min(key), F.max(key)).first()
    while lo < hi:
        # lo is reached by enough rows; hi + 1 is not.
        probes = sorted({lo + (hi - lo) * i // (PROBES + 1) + 1 for i in range(PROBES + 1)} | {hi})
        counts = rows.agg(*[F.count_if(key >= F.lit(p).cast("long")).alias(f"c{i}") for i, p in enumerate(probes)]).first()
        enough = [p for p, c in zip(probes, counts) if c >= want]
        fewer = [p for p, c in zip(probes, counts) if c < want]
        lo, hi = (enough[-1] if enough else lo), (fewer[0] - 1 if fewer else hi)
    return lo


def drawn_filter(rows: DataFrame, want: int) -> Column:
    """Condition of the ``want`` rows first by (score descending, doc_id, row)."""
    if want <= 0:
        return F.lit(False)
    test, below = F.lit(False), F.lit(True)
    # Falling keys; the complement of an integer reverses its order without overflow.
    for key in (F.col("score"), F.bitwise_not(F.col("doc_id")), F.bitwise_not(F.col("row"))):
        cut = least_reaching(rows.filter(below), key, want)
        over = below & (key > cut)
        test, below = test | over, below & (key == cut)
        n = rows.agg(F.count_if(over), F.count_if(below)).first()
        want -= n[0]
        if want == n[1]:
            return test | below
    return test | below


def with_ranks(rows: DataFrame) -> DataFrame:
    """``rank`` 1, 2, ... by (score descending, doc_id, row): sorted once by
    range partitions; one count a partition gives the offsets."""
    order = [F.desc("score"), F.asc("doc_id"), F.asc("row")]
    x = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id()), "drawn")
    x = x.withColumn("_p", F.shiftright("_m", 33))
    counts = x.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)   # one row a partition
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return x.join(F.broadcast(offsets), "_p").withColumn("rank", F.col("_off") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_p", "_m", "_off")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS,
             run: int = RUN, seed: str = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every document with n_words, n_features, weight, score and its rank in the
    draw of ``percent`` per cent of the documents of at least ``least_words``
    words (null when not drawn)."""
    gains = bucket_gains(docs, target, buckets, run)
    scored = written(importance_scores(docs, gains, run, seed, keep).withColumn("row", F.monotonically_increasing_id()), "scores")
    able = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    rows = scored.filter(able)
    drawn = able & drawn_filter(rows, percent * rows.count() // 100)
    ranked = with_ranks(scored.filter(drawn))
    rest = scored.filter(~F.coalesce(drawn, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).drop("row")


def resample_table(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return resample(docs, benchmark).select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))


# The same by DuckDB: CRC-32 over the bytes of each distinct word.
ORACLE = r"""
WITH RECURSIVE
table_step(i, k, c) AS (
  SELECT i, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END FROM table_step WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS tab FROM table_step WHERE k = 8),
doc_words AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bench_words AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
words AS (SELECT r, unnest(ws) AS w FROM doc_words),
vocabulary AS (SELECT DISTINCT w, hex(encode(w)) AS h FROM (SELECT w FROM words UNION SELECT w FROM bench_words)),
bucketed AS (
  SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
                lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
  FROM vocabulary, crc_table),
s AS (SELECT bucket, count(*) AS n FROM words JOIN bucketed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bench_words JOIN bucketed USING (w) GROUP BY bucket),
sums AS (SELECT coalesce((SELECT sum(n) FROM s), 0)::DOUBLE AS s_all, coalesce((SELECT sum(n) FROM t), 0)::DOUBLE AS t_all),
gains AS (
  SELECT b.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1) * (s_all + 10000) / ((coalesce(s.n, 0) + 1) * (t_all + 10000))))::BIGINT AS gain
  FROM (SELECT DISTINCT bucket FROM bucketed) b LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), sums),
weights AS (SELECT r, sum(gain)::BIGINT AS weight FROM words JOIN bucketed USING (w) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM doc_words LEFT JOIN weights USING (r)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS k, (SELECT count(*) FROM scored WHERE n_features >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND k <= 10 * n // 100 THEN k END AS rank FROM ranked
"""
