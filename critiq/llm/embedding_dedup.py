"""Embedding near-duplicates by NN-descent.

Vectors are compared only under equal labels, by cosine.  Equal vectors of a
label collapse into a class first (in the map side), so copies cost nothing.

1. Start: for each of ``TREES`` random projection trees the classes are sorted
   by label and the signs of their projections; runs of ``CHUNK`` give every
   class its first neighbours.
2. NN-descent: each class's neighbours and reverse neighbours meet in a local
   join, and pairs that beat a member's worst neighbour go to its list.  Rounds
   end when few entries change.  A list holds ``K`` neighbours, and up to
   ``K_MOST`` over the threshold.  The pairs found are written beside the lists,
   with spanning edges of all pairs over the threshold that met: what a list has
   no room for links components all the same.
   Where a list is full of neighbours over the threshold, the descent goes on
   from new trees with ``K`` more places for neighbours outside the own
   component, until no list is full of those.
3. The recall of links is audited: classes drawn by hash are compared with all
   classes by brute force, more of them until ``LINKED`` groups with links are
   met (``AUDIT_MOST`` classes at most).  Every class with links counts by the
   share of them found, every group once, whatever its size.  Below ``RECALL``,
   or while an audit that met fewer groups still sees new links between
   components, the descent goes on from new trees; after ``PASSES`` it raises.
4. Edges over the threshold span components; inside each one every pair is
   verified in double precision, in cells of two blocks at most, which emit link
   counts and spanning edges, never pairs.  So links beyond a list's length are
   counted all the same, and no cap remains in the result.

Only half-precision vectors travel in the descent; the exact check reads double
precision.  Lists, rounds and components are written tables in the shared
folder.

Edge cases: a null, zero or empty vector, one with null or non-finite
components, or one without a label links with nothing and is its own component;
vectors of unequal length are not compared; rows that repeat a vec_id stay
separate rows; a null vec_id takes part, and a component without any other has a
null id; an empty table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import hashlib
import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, written
from .graph import cells, connected_components, forest_of
from .ngram_join import runs

THRESHOLD = 0.93
K, K_MOST = 12, 48
TREES, BITS, CHUNK = 6, 24, 96
ROUNDS, CHANGED = 6, 0.002
AUDIT, AUDIT_MOST, LINKED, RECALL = 200, 20_000, 100, 0.98
# Most bytes of vectors that an audit draws, whatever their dimension.
AUDIT_BYTES = 16 << 20
PASSES = 6
BLOCK = 512
# Half precision moves a cosine by less than this.
SLACK = 0.004
_NODE = "cls binary, root binary, label long, dim int, v16 binary"
_PAIR = "src binary, dst binary, sim double, other boolean"


def _units(column: pa.Array) -> list[np.ndarray | None]:
    out: list[np.ndarray | None] = []
    for v in column:
        values = v.as_py()
        if not values or any(x is None for x in values):
            out.append(None)
            continue
        x = np.array(values, dtype=np.float64)
        big = np.abs(x).max()
        if not np.isfinite(big) or big == 0:
            out.append(None)
            continue
        x = x / big
        out.append(x / np.sqrt(x @ x))
    return out


def classes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, cls; cls null where a row links with nothing) and classes
    (cls, cnt, label, dim, v16, v64), both written."""
    small_batches(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cls, dim, v16, v64 = [], [], [], []
            for label, u in zip(b.column(1).to_pylist(), _units(b.column(2))):
                if label is None or u is None:
                    u = None
                raw = None if u is None else u.tobytes()
                cls.append(None if raw is None else hashlib.blake2b(raw, digest_size=16, salt=np.int64(label).tobytes()).digest())
                dim.append(None if raw is None else len(u))
                v16.append(None if raw is None else u.astype("<f2").tobytes())
                v64.append(raw)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cls, pa.binary()), b.column(1), pa.array(dim, pa.int32()), pa.array(v16, pa.binary()), pa.array(v64, pa.binary())],
                                             names=["vec_id", "cls", "label", "dim", "v16", "v64"])

    rows = written(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
                   .mapInArrow(run, "vec_id long, cls binary, label long, dim int, v16 binary, v64 binary"), "vectors")
    classes = written(rows.where(F.col("cls").isNotNull()).groupBy("cls").agg(
        F.count("*").alias("cnt"), *[F.first(c).alias(c) for c in ("label", "dim", "v16", "v64")]), "vector-classes")
    return rows.select("vec_id", "cls"), classes


def _matrix(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype=kind).reshape(len(rows), -1)


def _top(sims: np.ndarray, k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k largest entries of each row (above its floor)."""
    np.fill_diagonal(sims, -2.0)
    k = min(k, sims.shape[1] - 1)
    cols = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    rows = np.repeat(np.arange(len(sims)), k)
    cols = cols.ravel()
    if floor is not None:
        ok = sims[rows, cols] > floor[rows]
        rows, cols = rows[ok], cols[ok]
    return rows, cols


def _picked(cls: list[bytes], root: list[bytes], sims: np.ndarray, k: int, threshold: float, floor: np.ndarray | None = None,
            outer: np.ndarray | None = None) -> tuple[list[bytes], list[bytes], np.ndarray, np.ndarray]:
    """Pairs of members that met: the k best of each member (above its floor),
    the k best outside its component (above ``outer``), and spanning edges of
    all other pairs over the threshold."""
    i, j = _top(sims, k, floor)
    own = np.unique(root, return_inverse=True)[1]
    other = own[:, None] != own[None, :]
    taken = np.zeros(sims.shape, dtype=bool)
    taken[i, j] = True
    if np.count_nonzero(other) < sims.size - len(sims):
        a, b = _top(np.where(other, sims, -2.0), k, np.full(len(sims), -2.0) if outer is None else outer)
        taken[a, b] = other[a, b]
    linked = (sims >= threshold - SLACK) & other
    if (linked & ~taken & ~taken.T).any():
        for a, b in forest_of(linked):
            taken[a, b] = True
    i, j = np.nonzero(taken)
    return [cls[r] for r in i], [cls[c] for c in j], sims[i, j].astype(np.float64), other[i, j]


def _edges(parts: list[tuple[list[bytes], list[bytes], np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    src = [x for p in parts for x in p[0]]
    dst = [x for p in parts for x in p[1]]
    sim = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0)
    other = np.concatenate([p[3] for p in parts]) if parts else np.zeros(0, dtype=bool)
    return pa.RecordBatch.from_arrays([pa.array(src, pa.binary()), pa.array(dst, pa.binary()), pa.array(sim, pa.float64()), pa.array(other, pa.bool_())],
                                      names=["src", "dst", "sim", "other"])


def first_lists(nodes: DataFrame, trees: int, chunk: int, k: int, threshold: float, seed: int = 0) -> DataFrame:
    """Pairs (src, dst, sim, other) inside the runs of each projection tree."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            dims = b.column(3).to_numpy(zero_copy_only=False)
            out = np.zeros((trees, b.num_rows), dtype=np.int64)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                x = np.frombuffer(b"".join(b.column(4)[int(i)].as_py() for i in at), "<f2").reshape(len(at), d).astype(np.float32)
                for t in range(trees):
                    plane = np.random.default_rng((seed, t, int(d))).standard_normal((d, BITS)).astype(np.float32)
                    out[t, at] = ((x @ plane) > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(c) for c in out]], names=[*b.schema.names, *[f"t{t}" for t in range(trees)]])

    coded = written(nodes.select("cls", "root", "label", "dim", "v16").mapInArrow(code, _NODE + "".join(f", t{t} long" for t in range(trees))), "coded")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, 2):
            cls, root = t.column("cls").to_pylist(), t.column("root").to_pylist()
            if len(cls) < 2:
                continue
            x = _matrix(t.column("v16"), "<f2").astype(np.float32)
            parts = []
            for a in range(0, len(cls), chunk):
                b = min(len(cls), a + chunk)
                a = max(0, b - chunk)
                if b - a < 2:
                    continue
                sims = x[a:b] @ x[a:b].T
                parts.append(_picked(cls[a:b], root[a:b], sims, k, threshold))
            yield _edges(parts)

    out = None
    for t in range(trees):
        order = ["label", "dim", f"t{t}", F.xxhash64("cls", F.lit(t))]
        one = coded.select("label", "dim", "cls", "root", "v16", f"t{t}").repartitionByRange(*order).sortWithinPartitions(*order) \
            .select("label", "dim", "cls", "root", "v16").mapInArrow(_bounded(near), _PAIR)
        out = one if out is None else out.unionAll(one)
    return out


def _bounded(near, rows: int = 8192):
    """Cuts the sorted input of ``near`` into stretches of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= rows:
                yield from near(iter(held))
                held, n = [], 0
        yield from near(iter(held))

    return run


def merged(pairs: DataFrame, k: int, most: int, threshold: float) -> DataFrame:
    """The lists of all sources: the k best neighbours each, the k best outside
    the own component, and up to ``most`` of those over the threshold.  ``old``
    tells entries that were there before."""
    one = pairs.groupBy("src", "dst").agg(F.max("sim").alias("sim"), F.max("old").alias("old"), F.max("other").alias("other"))
    order = Window.partitionBy("src").orderBy(F.desc("sim"), "dst")
    out = one.withColumn("rank", F.row_number().over(order)) \
        .withColumn("outer", F.sum(F.col("other").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return out.where((F.col("rank") <= k) | (F.col("other") & (F.col("outer") <= k)) | ((F.col("rank") <= most) & (F.col("sim") >= threshold - SLACK)))


def descend(lists: DataFrame, nodes: DataFrame, step: int, k: int, most: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """One round: the pairs (written) of local joins among neighbours and
    reverse neighbours, and the new lists."""
    fwd = lists.select(F.col("src").alias("center"), F.col("dst").alias("cls"))
    rank = F.row_number().over(Window.partitionBy("center").orderBy(F.xxhash64("cls", F.lit(step))))
    back = lists.select(F.col("dst").alias("center"), F.col("src").alias("cls")).withColumn("r", rank).where(F.col("r") <= 2 * k).drop("r")
    best, far = F.col("rank") <= k, F.col("other") & (F.col("outer") <= k)

    def worst(inside: Column) -> Column:
        return F.when(F.count(F.when(inside, 1)) < k, F.lit(-1.0)).otherwise(F.least(F.min(F.when(inside, F.col("sim"))), F.lit(threshold)))

    floors = lists.groupBy(F.col("src").alias("cls")).agg(worst(best).alias("floor"), worst(far).alias("outer"))
    known = written(nodes.select("cls", "root", "v16").join(floors, "cls", "left"), "floors")
    members = fwd.union(back).distinct().join(known.hint("merge"), "cls") \
        .select("center", "cls", "root", "v16", F.coalesce("floor", F.lit(-1.0)).alias("floor"), F.coalesce("outer", F.lit(-1.0)).alias("outer"))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for t in runs(batches, 1):
            if t.num_rows < 2:
                continue
            cls, root = t.column("cls").to_pylist(), t.column("root").to_pylist()
            x = _matrix(t.column("v16"), "<f2").astype(np.float32)
            part = _picked(cls, root, x @ x.T, 6, threshold, t.column("floor").to_numpy(), t.column("outer").to_numpy())
            if len(part[0]):
                parts.append(part)
                n += len(part[0])
            if n > 20_000:
                yield _edges(parts)
                parts, n = [], 0
        yield _edges(parts)

    found = written(members.repartition("center").sortWithinPartitions("center").mapInArrow(local, _PAIR), "found")
    return found, written(merged(_again(lists).unionAll(found.withColumn("old", F.lit(0))), k, most, threshold), "lists")


def _again(lists: DataFrame) -> DataFrame:
    return lists.select("src", "dst", "sim", "other", F.lit(1).alias("old"))


def outside(lists: DataFrame, comp: DataFrame) -> DataFrame:
    """``lists`` with ``other`` by the components ``comp`` (node, root)."""
    a, b = comp.toDF("src", "a"), comp.toDF("dst", "b")
    other = F.coalesce("a", "src") != F.coalesce("b", "dst")
    return lists.drop("other").join(a, "src", "left").join(b, "dst", "left").select("src", "dst", "sim", other.alias("other"))


def verified(need: DataFrame, threshold: float, block: int) -> DataFrame:
    """cls, links and spanning edges (cls, other) of all pairs inside each root's
    members (root, cls, cnt, v64), in double precision."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, 3):
            if t.num_rows < 2:
                continue
            cls, own = t.column("cls").to_pylist(), t.column("own").to_numpy()
            x = _matrix(t.column("v64"), "<f8")
            linked = x @ x.T >= threshold
            np.fill_diagonal(linked, False)
            if t.column("cell_i")[0].as_py() != t.column("cell_j")[0].as_py():
                linked &= own[:, None] != own[None, :]
            links = linked.astype(np.int64) @ t.column("cnt").to_numpy()
            a = [(cls[i], int(links[i]), None) for i in np.flatnonzero(links)] + [(cls[i], 0, cls[j]) for i, j in forest_of(linked)]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in a], kind) for c, kind in enumerate((pa.binary(), pa.int64(), pa.binary()))], names=["cls", "links", "other"])

    sizes = need.groupBy("root").agg(F.count("*").alias("n"))
    return cells(need, sizes, "root", "cls", block).select("root", "cell_i", "cell_j", "own", "cls", "cnt", "v64") \
        .repartition("root", "cell_i", "cell_j").sortWithinPartitions("root", "cell_i", "cell_j").mapInArrow(run, "cls binary, links long, other binary")


def audit(nodes: DataFrame, comp: DataFrame, threshold: float, total: int, queries: int = AUDIT, most: int = AUDIT_MOST,
          linked: int = LINKED) -> tuple[float, int, int]:
    """Recall of links, groups with links it rests on, and classes drawn.

    The links of the drawn classes are found by brute force against all classes;
    one is found if it lies within one component (where every pair is verified).
    A class with links has the share found as its recall, a component the mean
    of its drawn classes, and the result is the mean of those components (0 of 0
    is 1).  The query set is bounded; the classes stream by it."""
    rooted = nodes.join(comp.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "label", "dim", "v64", F.coalesce("root", "cls").alias("root"))
    space = 1 << 40
    widest = nodes.agg(F.max("dim")).first()[0] or 1
    most = max(1, min(most, AUDIT_BYTES // (8 * widest)))
    while True:
        share = min(1.0, queries / max(total, 1))
        asked = rooted.where(F.pmod(F.xxhash64("cls", F.lit("audit")), F.lit(space)) < int(share * space)).collect()
        by_cls = _links_of(rooted, asked, threshold)
        groups: dict[bytes, list[float]] = {}
        for r in asked:
            there, found = by_cls.get(bytes(r["cls"]), (0, 0))
            if there:
                groups.setdefault(bytes(r["root"]), []).append(found / there)
        if len(groups) >= linked or share == 1.0 or queries >= most:
            return (float(np.mean([np.mean(v) for v in groups.values()])) if groups else 1.0), len(groups), len(asked)
        queries = min(most, 4 * queries)


def _links_of(rooted: DataFrame, asked: list, threshold: float) -> dict[bytes, tuple[int, int]]:
    """For each asked class with links, their number and that of those inside
    its component."""
    groups: dict[tuple[int, int], list] = {}
    for r in asked:
        groups.setdefault((r["label"], r["dim"]), []).append((bytes(r["cls"]), bytes(r["root"]), bytes(r["v64"])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[bytes, list[int]] = {}
        for b in batches:
            cls, label, dim, v64, root = (b.column(c).to_pylist() for c in range(5))
            at: dict[tuple[int, int], list[int]] = {}
            for i, key in enumerate(zip(label, dim)):
                if key in groups:
                    at.setdefault(key, []).append(i)
            for key, here in at.items():
                x = np.frombuffer(b"".join(v64[i] for i in here), "<f8").reshape(len(here), -1)
                for a in range(0, len(groups[key]), 1000):
                    q = groups[key][a:a + 1000]
                    for i, j in zip(*np.nonzero(np.frombuffer(b"".join(v for _, _, v in q), "<f8").reshape(len(q), -1) @ x.T >= threshold)):
                        if cls[here[j]] != q[i][0]:
                            c = n.setdefault(q[i][0], [0, 0])
                            c[0] += 1
                            c[1] += root[here[j]] == q[i][1]
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.binary()), *[pa.array([c[k] for c in n.values()], pa.int64()) for k in (0, 1)]], names=["cls", "there", "found"])

    got = rooted.mapInArrow(run, "cls binary, there long, found long").groupBy("cls").agg(F.sum("there").alias("there"), F.sum("found").alias("found")).collect()
    return {bytes(r["cls"]): (r["there"], r["found"]) for r in got}


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, k: int = K, most: int = K_MOST, trees: int = TREES, chunk: int = CHUNK,
                    rounds: int = ROUNDS, block: int = BLOCK, recall: float = RECALL) -> tuple[DataFrame, DataFrame, float]:
    """Rows (vec_id, cls), classes (cls, cnt, n_links, root) and the audited
    recall of the descent."""
    rows, nodes = classes_of(vectors)
    total = nodes.count()
    over = F.col("sim") >= threshold - SLACK
    at, lists, comp, step, seed, passes, joined = nodes.withColumn("root", F.col("cls")), None, None, 0, 0, 0, -1
    while True:
        start = written(first_lists(at, trees, chunk, k, threshold, seed), "found")
        every = start.withColumn("old", F.lit(0)).select("src", "dst", "sim", "other", "old")
        lists = written(merged(every if lists is None else _again(lists).unionAll(every), k, most, threshold), "lists")
        new = [start]
        for _ in range(rounds):
            step += 1
            found, lists = descend(lists, at, step, k, most, threshold)
            new.append(found)
            if lists.where(F.col("old") == 0).count() <= CHANGED * k * total:
                break
        # The components so far stand for all edges found before: plans do not
        # grow with the passes.
        edges = None if comp is None else comp.toDF("src", "dst")
        for t in new:
            pairs = t.where(over).select("src", "dst")
            edges = pairs if edges is None else edges.unionAll(pairs)
        comp = connected_components(edges)
        # Full lists may have left out links to other components.
        full = not lists.where(over & F.col("other")).groupBy("src").count().where(F.col("count") >= (k if seed else most)).isEmpty()
        if not full:
            got, linked, drawn = audit(nodes, comp, threshold, total)
            logging.getLogger(__name__).info("audited recall %.4f over %d groups with links, %d of %d classes drawn", got, linked, drawn, total)
            before, joined = joined, comp.count() - comp.select("root").distinct().count()
            if got >= recall and (linked >= LINKED or drawn == total or joined == before):
                break
            passes += 1
            if passes == PASSES:
                raise RuntimeError(f"audited recall {got:.4f} is below {recall} or still grows after {PASSES} passes")
            # For what the descent has missed: longer lists twice, then more trees.
            k, most, trees = (2 * k, 2 * most, trees) if passes <= 2 else (k, most, 2 * trees)
        seed += 1
        at = written(nodes.join(comp.toDF("cls", "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls")), "rooted")
        lists = written(outside(lists, comp), "lists")
    need = written(comp.withColumnRenamed("node", "cls").join(nodes.select("cls", "cnt", "v64"), "cls"), "need")
    found = written(verified(need, threshold, block), "links")
    roots = connected_components(found.where(F.col("other").isNotNull()).select(F.col("cls").alias("src"), F.col("other").alias("dst")))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    out = nodes.select("cls", "cnt").join(links, "cls", "left").join(roots.withColumnRenamed("node", "cls"), "cls", "left") \
        .select("cls", "cnt", (F.coalesce("links", F.lit(0)) + F.col("cnt") - 1).alias("n_links"), F.coalesce("root", "cls").alias("root"))
    return rows, written(out, "groups"), got


def dedup_table(vectors: DataFrame) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows, groups, _ = near_duplicates(vectors)
    ids = rows.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.min("vec_id").alias("low"))
    low = ids.join(groups.select("cls", "root"), "cls").groupBy("root").agg(F.min("low").alias("low"))
    per_class = written(groups.join(low, "root").select("cls", "n_links", "low"), "per-class")
    own = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("low"))
    return rows.join(per_class.hint("merge"), "cls", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.coalesce(F.col("vec_id") == own, F.lit(False)).alias("kept"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (
  SELECT vec_id AS x, vec_id AS y FROM embeddings
  UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.x = e.vec_id) AS n_links, min(r.y)::BIGINT AS component_id, e.vec_id = min(r.y) AS kept
FROM embeddings e JOIN reach r ON r.x = e.vec_id GROUP BY e.vec_id
"""
