"""Corpus-wide operators and the pipeline against brute force and SQL."""
import collections
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from critiq.llm import embedding_dedup, mixing, ngram_join, quality_rules, secrets
from critiq.llm.graph import connected_components

from .conftest import prose


def components(n, links):
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(300)] + [(rng.randrange(400, 900), rng.randrange(400, 900)) for _ in range(350)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    want = components(1300, edges)
    nodes = {x for e in edges if e[0] != e[1] for x in e}
    assert set(got) == nodes
    groups = collections.defaultdict(set)
    for v in nodes:
        groups[got[v]].add(want[v])
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len({want[v] for v in nodes})


def grams(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_join(rows):
    sets = [grams(t) for _, t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9]
    root = components(len(rows), links)
    n = collections.Counter(x for e in links for x in e)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[root[i]] = min(low.get(root[i], d), d)
    return [(d, low.get(root[i]), n[i]) for i, (d, _) in enumerate(rows)], root


def near_copies(seed=4):
    rng = random.Random(seed)
    base = prose(rng, 120).split()
    rows = [(i, prose(rng, rng.randint(3, 150))) for i in range(60)]
    for i in range(60, 140):  # one large group of near copies, more than a block
        w = base[:]
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = prose(rng, 1) + "zz"
        rows.append((i, " ".join(w)))
    passage = prose(rng, 60)
    rows += [(200 + i, passage + " " + prose(rng, 100)) for i in range(30)]  # shared passage, not copies
    rows += [(300 + i, rows[3][1]) for i in range(40)] + [(400, "a b"), (401, "a b"), (402, "a  b c")]
    return rows


def test_ngram_join_brute_force(spark):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want, _ = brute_join(rows)
    r, g = ngram_join.jaccard_join(df, block=16)
    assert sorted(map(tuple, ngram_join.join_table(df).select("doc_id", "class_id", "n_links").collect())) == sorted(want)
    # Small blocks (many cells) give the same links.
    n = r.join(g, "cls").select("doc_id", "n_links").collect()
    assert {x.doc_id: x.n_links for x in n} == {d: k for d, _, k in want}


def test_ngram_join_odd_rows(odd_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    want, root = brute_join(rows)
    want = [(d, d if not grams(t) else c, n) for (d, c, n), (_, t) in zip(want, rows)]
    got = [tuple(r) for r in ngram_join.join_table(odd_docs).select("doc_id", "class_id", "n_links").collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    kept = ngram_join.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    with_words = len({root[i] for i, (_, t) in enumerate(rows) if grams(t)})
    empty = len({(d, t or "") for d, t in rows if not grams(t)})
    assert kept.count() == with_words + empty
    assert ngram_join.join_table(odd_docs.where("false")).count() == 0 and ngram_join.keep_one(odd_docs.where("false")).count() == 0


def test_choose_bands():
    b = ngram_join.choose_bands(0.8, 0.9999, 128)
    assert 1 - (1 - 0.8 ** b.rows) ** b.bands >= 0.9999 and b.rows * b.bands <= 128
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.1, 0.9999, 8)


def brute_vectors(rows):
    unit = []
    for _, v, label in rows:
        ok = v is not None and len(v) > 0 and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None)
    links = [(i, j) for i in range(len(rows)) for j in range(i) if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2]
             and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93]
    root, n = components(len(rows), links), collections.Counter(x for e in links for x in e)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[root[i]] = min(low.get(root[i], r[0]), r[0])
    return sorted(((r[0], n[i], low.get(root[i])) for i, r in enumerate(rows)), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_embedding_dedup_brute_force(spark):
    rng = np.random.default_rng(3)
    rows, k = [], 0
    for label in (1, 2, 3):
        for size in [1] * 60 + [2] * 8 + [5, 90]:  # the last group saturates every list
            c = rng.normal(size=24)
            for _ in range(size):
                rows.append((k, (c + rng.normal(size=24) * 0.12).astype(np.float32).tolist(), label))
                k += 1
    rows += [(9000 + i, rows[5][1], 1) for i in range(40)]
    odd = [(9500, None, 1), (9501, [0.0] * 24, 1), (9502, [float("nan")] * 24, 1), (9503, [None] * 24, 2), (9504, [], 2), (9505, rows[5][1], None),
           (None, rows[0][1], 1), (9506, [1.0, 2.0], 1), (9507, [2.0, 4.0], 1), (9500, rows[9][1], 1)]
    rows += odd
    df = spark.createDataFrame([(*r, "e") for r in rows], "vec_id long, embedding array<float>, label int, cls string").repartition(4)
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.dedup_table(df).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert got == brute_vectors(rows)
    assert embedding_dedup.dedup_table(df.where("false")).count() == 0


# ---- mixing -------------------------------------------------------------------
def test_mixing_hits_targets_natively(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out, t, p, r = mixing.mix(docs, mixing.quality_toxic_domain(labels))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    rows = out.select(t, p, r).collect()
    post = np.array([x[1] for x in rows])
    tokens, rate = np.array([x[0] for x in rows], float), np.array([x[2] for x in rows])
    assert (rate >= 0).all() and np.allclose(post.sum(1), 1)
    names = sorted({x.domain for x in mixing.quality_toxic_domain(labels).select("domain").distinct().collect()})
    goal = np.array([mixing.TARGETS[n] for n in names])
    share = (rate * tokens) @ post / tokens.sum()
    # The rates are a stationary point of the projected gradient: no
    # residual is left that a nonnegative change of rates could lower.
    residual = share - goal / goal.sum()
    assert np.abs(residual).max() < 0.01


def test_mixing_rates_match_direct_solution(spark):
    """The distributed steps against numpy on a table of given posteriors."""
    rng = np.random.default_rng(0)
    post, tokens = rng.dirichlet([0.3, 0.3, 0.3], 400), rng.integers(1, 500, 400)
    df = spark.createDataFrame([(int(t), x.tolist()) for t, x in zip(tokens, post)], "t long, p array<double>")
    goal = {"a": 0.7, "b": 0.3, "c": 0.0}
    shift = mixing.fit_rates(df, ["a", "b", "c"], goal, "t", "p")
    got = np.array([x[0] for x in df.select(mixing.rate_of(shift, F.col("p"))).collect()])
    assert np.allclose(got, np.maximum(0, 1 - post @ np.array(shift)))
    aim = np.array([0.7, 0.3, 0])
    # Plain projected gradient, long enough, as the direct solution.
    rate, w = np.ones(400), tokens / tokens.sum()
    for _ in range(20_000):
        rate = np.maximum(0, rate - 2 * post @ ((rate * w) @ post - aim))
    direct = np.abs((rate * w) @ post - aim).max()
    assert np.abs((got * w) @ post - aim).max() < direct + 0.02


def test_mixing_warns_of_targets_out_of_reach(spark):
    rows = [(100, [0.9, 0.1]), (50, [0.8, 0.2])]
    df = spark.createDataFrame(rows, "t long, p array<double>")
    with pytest.warns(UserWarning, match="miss a target"):
        mixing.fit_rates(df, ["a", "b"], {"a": 0.1, "b": 0.9}, "t", "p")


def test_mixing_odd_rows(odd_docs, labels001):
    out = mixing.mix_table(odd_docs, labels001).collect()
    assert len(out) == odd_docs.count() and all(r.rate >= 0 for r in out)
    assert {r.rate for r in mixing.mix_table(odd_docs, labels001.where("false")).collect()} == {1.0}
    again = mixing.resample(odd_docs, labels001)
    assert again.columns == odd_docs.columns and mixing.resample(odd_docs.where("false"), labels001).count() == 0


def test_resample_keeps_clean(spark):
    """An input that is 98 % clean, and short clean texts."""
    rng = random.Random(2)
    bad = ["slur", "insult", "hateful", "vile"]
    rows = [(i, prose(rng, 60), 1, 0) for i in range(980)] + [(2000 + i, " ".join(rng.choice(bad) for _ in range(60)), 1, 1) for i in range(20)]
    rows += [(3000 + i, "so it is", 1, 0) for i in range(40)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in rows], "doc_id long, quality int, toxic int")
    for targets in (mixing.TARGETS, {"quality=1,toxic=0": 0.8, "quality=1,toxic=1": 0.2}):
        got = {r.doc_id for r in mixing.resample(docs, labels, targets).select("doc_id").distinct().collect()}
        assert {r[0] for r in rows if not r[3]} <= got


# ---- pipeline --------------------------------------------------------------------
def test_pipeline_stages(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    before = docs.collect()
    frames = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, d).write.parquet(f"{tmp_path}/{k}")
        nxt = spark.read.parquet(f"{tmp_path}/{k}")
        frames.append(nxt)
        if k < 4:
            assert nxt.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = nxt
    kept = {r.doc_id for r in quality_rules.quality_table(spark.createDataFrame(before)).where("kept").collect()}
    assert {r.doc_id for r in frames[0].collect()} == kept
    rows = [(r.doc_id, r.text) for r in frames[0].collect()]
    _, root = brute_join(rows)
    best = {}
    for (i, _), g in zip(rows, root):
        best[g] = min(best.get(g, i), i)
    assert {r.doc_id for r in frames[1].collect()} == set(best.values())
    assert {(r.doc_id, r.text) for r in frames[2].collect()} == {(r.doc_id, secrets.redact_text(r.text)) for r in frames[1].collect()}
    assert all(r.n_chars == len(r.text) for r in frames[2].collect())
    mixed = collections.Counter(r.doc_id for r in frames[3].collect())
    assert set(mixed) <= {r.doc_id for r in frames[2].collect()}
    assert {r.doc_id for r in frames[4].collect()} == set(mixed)
    assert corpus_pipeline.run(spark, d).count() == frames[4].count()


def test_pipeline_odd_rows(spark, odd_docs, tmp_path):
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        assert stage(spark, odd_docs, "/root/testdata/sf0.001").columns == odd_docs.columns
        assert stage(spark, odd_docs.where("false"), "/root/testdata/sf0.001").count() == 0


def test_oracles(spark):
    from critiq.llm import registry
    d = "/root/testdata/sf0.001"
    for name, sql in registry.ORACLES.items():
        con = duckdb.connect()
        for t in ("documents", "embeddings", "benchmark"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
        cur = con.execute(sql)
        cols = [c[0] for c in cur.description]
        want = sorted(tuple(dict(zip(cols, r))[c] for c in sorted(cols)) for r in cur.fetchall())
        got = registry.QUERIES[name](spark, d)
        assert sorted(tuple(r[c] for c in sorted(cols)) for r in got.collect()) == want


def test_embedding_dedup_dense_groups_linked_across(spark):
    """Two dense groups whose lists are full of their own members, linked only
    at 0.93 to 0.95; a third group lies apart."""
    rng = np.random.default_rng(8)
    d, n = 32, 200
    axis = np.linalg.qr(rng.normal(size=(d, 3)))[0].T
    turn = np.arccos(0.91)
    centers = [axis[0], np.cos(turn) * axis[0] + np.sin(turn) * axis[1], axis[2]]
    rows = []
    for c in centers:
        v = c + rng.normal(size=(n, d)) * (0.12 / np.sqrt(d))
        rows += [(len(rows) + i, x.astype(np.float32).tolist(), 1) for i, x in enumerate(v)]
    rows += [(5000 + i, rng.normal(size=d).tolist(), 1) for i in range(100)]
    u = np.array([r[1] for r in rows[:2 * n]])
    u /= np.linalg.norm(u, axis=1)[:, None]
    inner, cross = u[:n] @ u[:n].T, u[:n] @ u[n:].T
    assert inner.min() > 0.96 and cross.max() < np.sort(inner, axis=1)[:, -9].min() and ((cross >= 0.93) & (cross < 0.95)).any()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    ids, groups, _ = embedding_dedup.near_duplicates(df, k=4, most=8)
    found = ids.join(groups, "cls").select("vec_id", "n_links", "root").collect()
    low = {}
    for r in found:
        low[r.root] = min(low.get(r.root, r.vec_id), r.vec_id)
    assert sorted((r.vec_id, r.n_links, low[r.root]) for r in found) == brute_vectors(rows)


def test_embedding_audit_sees_small_groups(spark):
    """A group of 300, all found, does not hide 20 lost pairs."""
    rng = np.random.default_rng(5)
    rows = []
    for size in [300] + [2] * 20:
        c = rng.normal(size=24)
        rows += [(len(rows) + i, (c + rng.normal(size=24) * 0.05).tolist(), 1) for i in range(size)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    ids, nodes = embedding_dedup.classes_of(vectors)
    big = ids.where("vec_id < 300").select(F.col("cls").alias("node")).crossJoin(ids.where("vec_id = 0").select(F.col("cls").alias("root")))
    got, groups, drawn = embedding_dedup.audit(nodes, big, 0.93, 340)
    assert (groups, drawn) == (41, 340) and abs(got - 1 / 41) < 1e-9
