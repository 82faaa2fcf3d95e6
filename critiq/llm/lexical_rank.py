"""Ranked lexical search by the Best Position Algorithm over impact lists.

A document scores the sum of w * impact over a query's terms, where a term's
weight w comes from its document frequency and the impact of a posting from its
count and the document's length.  Each term has an impact list: its postings by
falling impact.  For a query, the algorithm reads the lists in step from the
top; each document met is looked up in all lists by direct access, which gives
its whole score and marks its position as seen in each list.  The best position
of a list is the last one before its first unseen position: through direct
accesses it may lie far below the last position read.  No unmet document can
score more than the sum of w * impact at the best positions, so the search stops
as soon as that sum lies strictly below the k-th score (strictly, as a tied
document with a smaller id would still enter).

How it runs:

* the terms of the queries are taken in blocks of about ``BLOCK_TERMS`` (query,
  term) pairs, dealt by a hash of the query, so what is broadcast is bounded
  (a query's own terms stay together) and any number of queries is served;
* one pass over the texts writes the postings of the block's terms in shards of
  at most ``SHARD_DOCS`` documents, one row each, with the sums that the
  statistics need; document frequencies are added up by Spark;
* each shard is searched by itself.  A task keeps the k best of a query over the
  shards that it reads and starts the next shard with that k-th score;
* the tasks' best, at most k a query and task, meet in a window with a limit.

Edge cases: null and empty texts have no terms and do not count in N; rows
without doc_id count in the statistics but are not ranked; rows of one doc_id
are ranked one by one; texts of rows with the same item_id are one query, null
being an id too; queries without terms and empty tables give no rows; other
columns are ignored.
"""
from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, text_slices, written

TOP = 10
BLOCK_TERMS = 500_000
SHARD_DOCS = 16_384
SHARD_POSTINGS = 1_000_000
FIRST_READ = 8
# FIXED VALUES of the score: impact = SCALE * tf div (1000 * tf + 8 * m), with
# m = 100 - 90 + (90 * n * N) div L.
SCALE, PER_TF, PER_LENGTH, LENGTH_BASE, LENGTH_SHARE = 1_000_000_000, 1000, 8, 10, 90
# FIXED VALUE: terms are ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+``, A-Z
# lower-cased: digits, letters and everything beyond ASCII.
TERM_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                   for b in range(256))


class Queries(NamedTuple):
    """A block of queries: number of each term, and (item_id, term numbers)."""
    number: dict[bytes, int]
    items: list[tuple[int | None, np.ndarray]]


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    for batch, data, offs in text_slices(batches, "text"):
        low = data.tobytes().translate(TERM_BYTES)
        yield batch, [low[a:b].split() for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]


def query_terms(items: DataFrame) -> DataFrame:
    """Distinct (item_id, term), term as UTF-8 bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _terms(batches):
            pairs = [(i, t) for i, words in zip(batch.column(0).to_pylist(), texts) for t in set(words)]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.binary())], names=["item_id", "term"])

    x = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return x.mapInArrow(run, "item_id long, term binary").distinct()


def _load_block(pairs: DataFrame) -> Queries:
    number: dict[bytes, int] = {}
    items: dict[int | None, list[int]] = {}
    for row in pairs.select("item_id", "term").collect():
        items.setdefault(row["item_id"], []).append(number.setdefault(bytes(row["term"]), len(number)))
    return Queries(number, [(i, np.array(t)) for i, t in items.items()])


# A shard: documents with a term (doc_id, its null mark and length) and, for
# each of the block's terms found, the postings (document in the shard, count).
SHARD = ("shard long, n_docs long, n_terms long, doc_ids binary, unnamed binary, lengths binary, "
         "terms binary, starts binary, at binary, counts binary")
_SHARD_ARROW = pa.schema([(c.split()[0], pa.int64() if c.split()[1] == "long" else pa.binary()) for c in SHARD.split(", ")])


class _Shard:
    """Postings of a run of documents while they are read."""

    def __init__(self):
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, int]] = []
        self.size = 0

    def add(self, doc_id: int | None, length: int, counts: Counter) -> None:
        if counts:
            self.parts.append((np.fromiter(counts.keys(), np.int64, len(counts)), np.fromiter(counts.values(), np.int64, len(counts)), len(self.ids)))
            self.size += len(counts)
        self.ids.append(doc_id)
        self.lengths.append(length)

    def row(self, number: int) -> pa.RecordBatch:
        term = np.concatenate([p[0] for p in self.parts] or [np.zeros(0, np.int64)])
        count = np.concatenate([p[1] for p in self.parts] or [np.zeros(0, np.int64)])
        at = np.repeat([p[2] for p in self.parts], [len(p[0]) for p in self.parts]).astype(np.int64)
        order = np.argsort(term, kind="stable")
        terms, starts = np.unique(term[order], return_index=True)
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        cells = [ids, np.array([i is None for i in self.ids], np.int8), np.array(self.lengths, np.int64), terms, np.append(starts, len(term)), at[order], count[order]]
        row = [number, len(self.ids), sum(self.lengths), *[c.tobytes() for c in cells]]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SHARD_ARROW)], schema=_SHARD_ARROW)


def shard_postings(docs: DataFrame, block) -> DataFrame:
    """Rows of SHARD for the terms of a broadcast block of queries."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = block.value.number
        shard, at = _Shard(), TaskContext.get().partitionId() << 32
        for batch, texts in _terms(batches):
            for doc_id, words in zip(batch.column(0).to_pylist(), texts):
                if words:
                    found = Counter(map(number.get, words))
                    found.pop(None, None)
                    shard.add(doc_id, len(words), found)
                    if len(shard.ids) >= SHARD_DOCS or shard.size >= SHARD_POSTINGS:
                        yield shard.row(at)
                        shard, at = _Shard(), at + 1
        if shard.ids:
            yield shard.row(at)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, SHARD)


class Statistics(NamedTuple):
    n_docs: int
    n_terms: int
    weights: np.ndarray


def statistics(shards: DataFrame, n_numbers: int) -> Statistics:
    """N, L and the weight of each term; a task sends one row a term found."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_numbers, np.int64)
        for batch in batches:
            for terms, starts in zip(batch.column(0), batch.column(1)):
                df[np.frombuffer(terms.as_py(), np.int64)] += np.diff(np.frombuffer(starts.as_py(), np.int64))
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "df"])

    N, L = shards.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    df = np.zeros(n_numbers, np.int64)
    for row in shards.select("terms", "starts").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[row["term"]] = row["df"]
    return Statistics(N, L, np.array([math.floor(1000 * math.log((2 * N + 2) / (2 * d + 1))) for d in df.tolist()], np.int64))


class ImpactList(NamedTuple):
    """Postings of a term in a shard: documents in order of number with their
    impact and position, and the documents by falling impact."""
    docs: np.ndarray
    impact: np.ndarray
    position: np.ndarray
    ranked: np.ndarray
    ranked_impact: np.ndarray


def impact_lists(row: dict, stats: Statistics) -> tuple[np.ndarray, dict[int, ImpactList]]:
    """doc_ids of a shard, and the impact list of each term; postings of
    documents without doc_id are left out."""
    long = {k: np.frombuffer(row[k], np.int64) for k in ("doc_ids", "lengths", "terms", "starts", "at", "counts")}
    named = np.frombuffer(row["unnamed"], np.int8) == 0
    n = long["lengths"]
    if LENGTH_SHARE * int(n.max(initial=0)) * stats.n_docs < 1 << 63:
        m = LENGTH_BASE + (LENGTH_SHARE * n * stats.n_docs) // max(stats.n_terms, 1)
    else:
        m = np.array([LENGTH_BASE + LENGTH_SHARE * x * stats.n_docs // stats.n_terms for x in n.tolist()], np.int64)
    out = {}
    for term, a, b in zip(long["terms"].tolist(), long["starts"][:-1].tolist(), long["starts"][1:].tolist()):
        docs, tf = long["at"][a:b], long["counts"][a:b]
        if not named.all():
            docs, tf = docs[named[docs]], tf[named[docs]]
        impact = (SCALE * tf) // (PER_TF * tf + PER_LENGTH * m[docs])
        order = np.argsort(-impact, kind="stable")
        position = np.empty(len(docs), np.int64)
        position[order] = np.arange(len(docs))
        out[term] = ImpactList(docs, impact, position, docs[order], impact[order])
    return long["doc_ids"], out


def best_positions(lists: list[tuple[int, ImpactList]], doc_ids: np.ndarray, k: int, floor: int = 0, step: int = FIRST_READ) -> tuple[np.ndarray, np.ndarray, int]:
    """(documents, scores, positions read) of the k best documents with score
    above 0 over weighted impact lists, by (score descending, doc_id); documents
    below ``floor``, a k-th score known from elsewhere, may be left out."""
    lists = [(w, x) for w, x in lists if w > 0 and len(x.docs)]
    seen = [np.zeros(len(x.docs), bool) for _, x in lists]
    best = [0] * len(lists)
    met, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    read = 0
    while lists:
        # Sorted access to the next positions of every list.
        new = np.setdiff1d(np.concatenate([x.ranked[read:read + step] for _, x in lists]), met)
        read, step = read + step, step * 2
        # Direct access of the new documents to all lists.
        got = np.zeros(len(new), np.int64)
        limit, done = 0, True
        for i, (w, x) in enumerate(lists):
            if len(new):
                at = np.minimum(np.searchsorted(x.docs, new), len(x.docs) - 1)
                hit = x.docs[at] == new
                got[hit] += w * x.impact[at[hit]]
                seen[i][x.position[at[hit]]] = True
            rest = seen[i][best[i]:]
            gap = int(np.argmin(rest)) if len(rest) else 0
            best[i] += len(rest) if len(rest) and rest[gap] else gap
            if best[i] < len(x.docs):
                done = False
                limit += w * int(x.ranked_impact[best[i] - 1])
        met, scores = np.concatenate([met, new]), np.concatenate([scores, got])
        kth = max(floor, int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0)
        if done or limit == 0 or limit < kth:
            break
    order = np.lexsort((doc_ids[met], -scores))[:k]
    order = order[scores[order] > 0]
    return met[order], scores[order], read


def search_shards(shards: DataFrame, block, stats: Statistics, k: int) -> DataFrame:
    """(item_id, doc_id, score): the k best of each query over a task's shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = block.value.items
        kept: list[list[tuple[int, int]]] = [[] for _ in items]
        for batch in batches:
            for row in batch.to_pylist():
                doc_ids, lists = impact_lists(row, stats)
                for q, (_, terms) in enumerate(items):
                    own = [(int(stats.weights[t]), lists[t]) for t in terms.tolist() if t in lists]
                    floor = -kept[q][-1][0] if len(kept[q]) == k else 0
                    docs, scores, _ = best_positions(own, doc_ids, k, floor)
                    if len(docs):
                        kept[q] = sorted(kept[q] + list(zip((-scores).tolist(), doc_ids[docs].tolist())))[:k]
        rows = [(i, d, -s) for (i, _), best in zip(items, kept) for s, d in best]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], names=["item_id", "doc_id", "score"])

    return shards.drop("n_docs", "n_terms").mapInArrow(run, "item_id long, doc_id long, score long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item."""
    spark = docs.sparkSession
    small_batches(spark)
    pairs = written(query_terms(items), "query-terms")
    n_blocks = max(1, math.ceil(pairs.count() / block_terms))
    found = None
    for b in range(n_blocks):
        mine = pairs.filter(F.pmod(F.hash("item_id"), F.lit(n_blocks)) == b)
        block = spark.sparkContext.broadcast(_load_block(mine))
        shards = written(shard_postings(docs, block), "postings")
        part = written(search_shards(shards, block, statistics(shards, len(block.value.number)), k), "found")
        block.unpersist()
        found = part if found is None else found.unionAll(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def rank_table(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return rank_documents(docs, benchmark)


# The same by DuckDB, scoring every document that holds a term.
ORACLE = r"""
WITH doc_terms AS (
  SELECT row_number() OVER () AS r, doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ts FROM documents),
item_terms AS (
  SELECT DISTINCT item_id, unnest(list_transform(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS term FROM benchmark),
totals AS (SELECT count(*)::BIGINT AS all_docs, coalesce(sum(len(ts)), 0)::BIGINT AS all_terms FROM doc_terms WHERE len(ts) > 0),
tf AS (SELECT r, doc_id, len(ts)::BIGINT AS n, term, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, ts, unnest(ts) AS term FROM doc_terms) WHERE term IN (SELECT term FROM item_terms) GROUP BY r, doc_id, n, term),
df AS (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term),
weights AS (SELECT term, floor(1000 * ln((2 * all_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM df, totals),
scored AS (
  SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * all_docs) // all_terms))))::BIGINT AS score
  FROM item_terms JOIN tf USING (term) JOIN weights USING (term), totals WHERE doc_id IS NOT NULL GROUP BY item_id, r, doc_id),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
