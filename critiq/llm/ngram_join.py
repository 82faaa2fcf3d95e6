"""N-gram Jaccard self-join of documents by MinHash banding, verified on the
full n-gram sets.

Words are ``[^\\x20\\x09-\\x0D]+`` as written; a text's set holds its distinct
windows of five words (a text of one to four words has one gram: all of them; a
text without words has none and links with nothing).  Two texts link when the
Jaccard similarity of their sets is at least the threshold.

1. One pass hashes every whole text: a digest of its set (texts with equal sets
   form a class, so copies collapse before anything is compared) and a MinHash
   signature.  Bands and rows follow from the target recall at the threshold.
2. Classes are shuffled on band hashes.  Buckets with company are compared by
   signature (five standard errors below the threshold) in cells of two blocks
   at most, each emitting spanning edges only, never its pairs.
3. Components of those edges bound the exact work: the texts of their classes
   are read again, their full sets shipped once per cell, and every pair of a
   component is verified in blocks.  A cell emits link counts and spanning edges.
4. Components of verified edges are the result's groups.

A group of n different near copies costs n * n comparisons, because each link
must be counted, but never n * n rows; blocks of it go to different tasks.
Exact copies cost nothing: the map side combines them.  The joins with tables
that grow with the corpus ask for shuffles, so that small and large inputs take
the same plan and Spark can split a hot key.

Edge cases: null text counts as empty; a row without words is a group of its
own; rows with a null doc_id take part, and a group without any other id has a
null class_id; repeated doc_ids stay separate rows; an empty table gives an
empty result; columns other than doc_id and text are ignored or passed through.
"""
from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _GRAM, Slice, fresh, mix, small_batches, text_slices, written
from .graph import cells, connected_components, forest_of

WIDTH = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 128
# Members of a block; a cell compares two blocks at most.
BLOCK = 256
_COLUMNS = 4096


class Bands(NamedTuple):
    bands: int
    rows: int


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES) -> Bands:
    """The longest bands (fewest chance candidates) that find a pair at the
    threshold with the target probability within ``most`` hashes."""
    best = None
    for rows in range(1, 33):
        hit = threshold ** rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows <= most:
            best = Bands(bands, rows)
    if best is None:
        raise ValueError("no banding reaches this recall within the hashes allowed")
    return best


def text_sets(data: np.ndarray, offs: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct gram hashes of each text of a slice."""
    s = Slice(data, offs)
    grams, first = s.grams(width)
    n_words = np.diff(s.bounds)
    cut = np.searchsorted(first, s.bounds)
    out = []
    words = s.hashes(s.starts, s.ends) if ((n_words > 0) & (n_words < width)).any() else None
    for i, n in enumerate(n_words):
        if n >= width:
            out.append(np.unique(grams[cut[i]:cut[i + 1]]))
        elif n:
            w = words[s.bounds[i]:s.bounds[i + 1]]
            out.append(mix((w * _GRAM[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_class(grams: np.ndarray) -> bytes | None:
    """A 128-bit digest of a gram set."""
    return hashlib.blake2b(grams.tobytes(), digest_size=16).digest() if len(grams) else None


def signatures(sets: list[np.ndarray], n_hashes: int) -> np.ndarray:
    """16 bits of each MinHash of each (non-empty) set."""
    mult = np.random.default_rng(7).integers(1, 2**63, n_hashes, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    grams = np.concatenate(sets)
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    low = np.empty((n_hashes, len(sets)), dtype=np.uint64)
    buf = np.empty_like(grams)
    for k in range(n_hashes):
        np.multiply(grams, mult[k], out=buf)
        np.minimum.reduceat(buf, at, out=low[k])
    return (mix(low.T) & np.uint64(0xFFFF)).astype("<u2")


def signed(docs: DataFrame, width: int, n_hashes: int) -> DataFrame:
    """doc_id, th (hash of the text), cls, sig and chk (8 bits of each hash)."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offs in text_slices(batches, "text"):
            sets = text_sets(data, offs, width)
            cls = [set_class(s) for s in sets]
            sig: list[bytes | None] = [None] * len(sets)
            chk = list(sig)
            real = [i for i, s in enumerate(sets) if len(s)]
            if real:
                m = signatures([sets[i] for i in real], n_hashes)
                low = (m & 0xFF).astype(np.uint8)
                for r, i in enumerate(real):
                    sig[i], chk[i] = m[r].tobytes(), low[r].tobytes()
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(cls, pa.binary()), pa.array(sig, pa.binary()), pa.array(chk, pa.binary())],
                                             names=["doc_id", "th", "cls", "sig", "chk"])

    return docs.select("doc_id", "th", "text").mapInArrow(run, "doc_id long, th long, cls binary, sig binary, chk binary")


def runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """The consecutive rows with equal first ``n_keys`` columns, one table each
    (rows are sorted by them)."""
    rest: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        if rest is not None:
            t = pa.concat_tables([rest, t])
        if not t.num_rows:
            continue
        change = np.zeros(t.num_rows, dtype=bool)
        for k in range(n_keys):
            c = t.column(k).combine_chunks()
            c = c.chunk(0) if isinstance(c, pa.ChunkedArray) else c
            codes = c.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            change[1:] |= codes[1:] != codes[:-1]
        cut = np.flatnonzero(change)
        at = 0
        for c in cut:
            yield t.slice(at, c - at)
            at = c
        rest = t.slice(at)
    if rest is not None and rest.num_rows:
        yield rest


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, width)


def candidate_edges(classes: DataFrame, plan: Bands, threshold: float, block: int) -> DataFrame:
    """Spanning edges (src, dst) between classes that share a band hash and
    whose signatures may reach the threshold."""
    size = 2 * plan.rows
    n_hashes = plan.bands * plan.rows
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("sig", size * i + 1, size)) for i in range(plan.bands)])
    buckets = classes.select("cls", F.explode(keys).alias("bucket"))
    sizes = written(buckets.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > 1), "buckets")
    member = cells(buckets, sizes, "bucket", "cls", block)
    least = (threshold - 5 * math.sqrt(threshold * (1 - threshold) / n_hashes)) * n_hashes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[bytes, bytes]] = set()
        for t in runs(batches, 3):
            if t.num_rows < 2:
                continue
            cls = t.column("cls").to_pylist()
            m = _matrix(t.column("chk"), n_hashes)
            if len(cls) == 2:
                if np.count_nonzero(m[0] == m[1]) >= least:
                    found.add((cls[0], cls[1]))
            else:
                own = t.column("own").to_numpy()
                linked = np.zeros((len(cls), len(cls)), dtype=bool)
                i, j = t.column("cell_i")[0].as_py(), t.column("cell_j")[0].as_py()
                for a in range(len(cls)):
                    linked[a] = (m == m[a]).sum(1) >= least
                if i != j:
                    linked &= own[:, None] != own[None, :]
                found.update((cls[a], cls[b]) for a, b in forest_of(linked))
            if len(found) > 50_000:
                yield _edges(found)
                found.clear()
        yield _edges(found)

    full = member.join(classes.select("cls", "chk").hint("merge"), "cls").select("bucket", "cell_i", "cell_j", "own", "cls", "chk")
    return full.repartition("bucket", "cell_i", "cell_j").sortWithinPartitions("bucket", "cell_i", "cell_j") \
        .mapInArrow(run, "src binary, dst binary").distinct()


def _edges(found: set[tuple[bytes, bytes]]) -> pa.RecordBatch:
    rows = [(a, b) if a < b else (b, a) for a, b in found]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)], names=["src", "dst"])


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of blocks of the
    incidence matrix."""
    n = len(sets)
    grams, member = np.unique(np.concatenate(sets), return_inverse=True)
    rows = np.repeat(np.arange(n), [len(s) for s in sets])
    shared = np.bincount(member, minlength=len(grams)) > 1
    new = np.cumsum(shared) - 1
    keep = shared[member]
    cols, rows = new[member[keep]], rows[keep]
    order = np.argsort(cols, kind="stable")
    cols, rows = cols[order], rows[order]
    out = np.zeros((n, n), dtype=np.float64)
    for a in range(0, int(shared.sum()), _COLUMNS):
        lo, hi = np.searchsorted(cols, [a, a + _COLUMNS])
        m = np.zeros((n, _COLUMNS), dtype=np.float32)
        m[rows[lo:hi], cols[lo:hi] - a] = 1
        out += m @ m.T
    return out


def verified(need: DataFrame, docs: DataFrame, width: int, threshold: float, block: int) -> DataFrame:
    """cls, links (rows of other classes linked with it) and spanning edges
    (cls, other) from the full sets of all classes of ``need`` (cls, root, th,
    cnt, n: size of the root's component)."""

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[bytes] = set()
        for part, data, offs in text_slices(batches, "text"):
            cls, rows, out = part.column(part.schema.get_field_index("cls")).to_pylist(), [], []
            for i, grams in enumerate(text_sets(data, offs, width)):
                if cls[i] not in done and set_class(grams) == cls[i]:
                    done.add(cls[i])
                    rows.append(i)
                    out.append(grams.tobytes())
            part = part.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("root", "cls", "cnt")), pa.array(out, pa.binary())], names=["root", "cls", "cnt", "grams"])

    sets = docs.select("th", "text").join(need.select("th", "root", "cls", "cnt").hint("merge"), "th") \
        .select("root", "cls", "cnt", "text").mapInArrow(sets_of, "root binary, cls binary, cnt long, grams binary")
    sizes = need.groupBy("root").agg(F.count("*").alias("n"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, 3):
            cls = t.column("cls").to_pylist()
            first = [k for k in range(len(cls)) if k == 0 or cls[k] != cls[k - 1]]
            if len(first) < 2:
                continue
            t = t.take(pa.array(first, pa.int64()))
            cls, cnt = t.column("cls").to_pylist(), t.column("cnt").to_numpy()
            own = t.column("own").to_numpy()
            sets = [np.frombuffer(b, dtype=np.uint64) for b in t.column("grams").to_pylist()]
            n = np.array([len(s) for s in sets], dtype=np.float64)
            both = overlaps(sets)
            linked = both >= threshold * (n[:, None] + n[None, :] - both) - 1e-9
            np.fill_diagonal(linked, False)
            if t.column("cell_i")[0].as_py() != t.column("cell_j")[0].as_py():
                linked &= own[:, None] != own[None, :]
            links = linked.astype(np.int64) @ cnt
            a = [(cls[k], int(links[k]), None) for k in np.flatnonzero(links)]
            a += [(cls[x], 0, cls[y]) for x, y in forest_of(linked)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in a], kind) for k, kind in enumerate((pa.binary(), pa.int64(), pa.binary()))],
                                             names=["cls", "links", "other"])

    return cells(sets, sizes, "root", "cls", block).select("root", "cell_i", "cell_j", "own", "cls", "cnt", "grams") \
        .repartition("root", "cell_i", "cell_j").sortWithinPartitions("root", "cell_i", "cell_j", "cls") \
        .mapInArrow(run, "cls binary, links long, other binary")


def jaccard_join(docs: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD, recall: float = RECALL,
                 block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, th, cls) and classes (cls, cnt, n_links, root), both written.

    ``n_links`` counts the other rows that a row of the class links with;
    ``root`` names the class's connected component."""
    plan = choose_bands(threshold, recall)
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("th"), F.col("text").cast("string").alias("text"))
    rows = written(signed(base, width, plan.bands * plan.rows), "signed")
    classes = written(rows.where(F.col("cls").isNotNull()).groupBy("cls").agg(
        F.count("*").alias("cnt"), F.min("th").alias("th"), F.first("sig").alias("sig"), F.first("chk").alias("chk")), "classes")
    comp = connected_components(candidate_edges(classes, plan, threshold, block))
    need = written(comp.withColumnRenamed("node", "cls").join(classes.select("cls", "th", "cnt"), "cls"), "need")
    found = written(verified(need, base, width, threshold, block), "links")
    roots = connected_components(found.where(F.col("other").isNotNull()).select(F.col("cls").alias("src"), F.col("other").alias("dst")))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    out = classes.select("cls", "cnt").join(links, "cls", "left").join(roots.withColumnRenamed("node", "cls"), "cls", "left") \
        .select("cls", "cnt", (F.coalesce("links", F.lit(0)) + F.col("cnt") - 1).alias("n_links"), F.coalesce("root", "cls").alias("root"))
    return rows.select("doc_id", "th", "cls"), written(out, "groups")


def join_table(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id reachable by
    links, itself included), n_links, kept (it is that document)."""
    rows, groups = jaccard_join(docs)
    ids = rows.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.min("doc_id").alias("low"))
    low = ids.join(groups.select("cls", "root"), "cls").groupBy("root").agg(F.min("low").alias("class_id"))
    per_class = written(groups.join(low, "root").select("cls", "n_links", "class_id"), "per-class")
    out = rows.join(per_class.hint("merge"), "cls", "left")
    own = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return out.select("doc_id", own.alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.coalesce(F.col("doc_id") == own, F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one document of each linked group: that of the
    smallest doc_id (null ids last, then the text's hash).  Rows that repeat
    both doc_id and text are copies of one document; any one of them stays."""
    rows, groups = jaccard_join(docs)
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")
    first = rows.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.min(order).alias("o"))
    best = first.join(groups.select("cls", "root"), "cls").groupBy("root").agg(F.min("o").alias("o")).select("o.doc_id", "o.th")
    stay = written(best.union(rows.where(F.col("cls").isNull()).select("doc_id", "th").distinct()), "stay")
    d, h, sd, sh = fresh(docs, "dedup_id", "dedup_hash", "stay_id", "stay_hash")
    keyed = docs.withColumn(d, F.col("doc_id").cast("long")).withColumn(h, F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    stay = stay.select(F.col("doc_id").alias(sd), F.col("th").alias(sh))
    one = keyed.dropDuplicates([d, h]).join(stay.hint("merge"), (F.col(h) == F.col(sh)) & F.col(d).eqNullSafe(F.col(sd)), "left_semi")
    return one.select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS gram FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM g a JOIN g b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE common >= 0.8 * (nx.n + ny.n - common) - 1e-9),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT d.doc_id, min(r.y) AS class_id, (SELECT count(*) FROM links l WHERE l.x = d.doc_id) AS n_links, d.doc_id = min(r.y) AS kept
FROM documents d JOIN reach r ON r.x = d.doc_id GROUP BY d.doc_id
"""
