"""Importance resampling, the tokenization automaton and ranked search, against
brute force, the tokenizers library and DuckDB."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from critiq.llm import bpe_automaton, importance, lexical_rank
from critiq.llm.tokens import public_path

SF = "/root/testdata/sf0.001"


def duck(sql):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    rel = con.sql(sql)
    return rel.columns, rel.fetchall()


def same_rows(df, sql):
    cols, want = duck(sql)
    return sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in df.select(*cols).collect())


# Importance resampling.

def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute_importance(docs, target, run=1, percent=10, least=20, buckets=10_000):
    def words(text):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text or ""))

    def features(ws):
        return [" ".join(ws[i:i + n]) for n in range(1, run + 1) for i in range(len(ws) - n + 1)]

    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in docs for f in features(words(t)))
    t = Counter(bucket(f) for x in target for f in features(words(x)))
    S, T = sum(s.values()), sum(t.values())
    out = []
    for d, text in docs:
        ws = words(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in map(bucket, features(ws)))
        score = None
        if d is not None:
            h = int(hashlib.sha256(f"2024:{d}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((d, len(ws), len(features(ws)), weight, score))
    able = sorted((-r[4], r[0]) for r in out if r[1] >= least and r[4] is not None)
    return out, able[:percent * len(able) // 100]


@pytest.mark.parametrize("run,percent", [(1, 10), (1, 60), (2, 100), (1, 0)])
def test_importance_against_brute_force(spark, odd_docs, run, percent):
    target = ["cor den el fin naïve", None, "", "BA ba"]
    docs = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    got = importance.resample(odd_docs, spark.createDataFrame([(t,) for t in target], "text string"), percent=percent, run=run).collect()
    want, drawn = brute_importance(docs, target, run, percent)
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_words, r.n_features, r.weight, r.score)) for r in got)
    ranked = sorted((r["rank"], -r.score, r.doc_id) for r in got if r["rank"] is not None)
    assert ranked == [(i + 1, s, d) for i, (s, d) in enumerate(drawn)]


def test_importance_draws_exactly_among_ties(spark):
    # Half of the rows are copies of one row: equal score and doc_id.
    text = " ".join(f"w{i}" for i in range(25))
    docs = spark.createDataFrame([(7, text)] * 30 + [(i, text + f" x{i}") for i in range(100, 130)], "doc_id long, text string").repartition(5)
    for percent in (5, 35, 50, 77):
        got = importance.resample(docs, docs.limit(0), percent=percent).collect()
        ranks = sorted(r["rank"] for r in got if r["rank"] is not None)
        assert ranks == list(range(1, 60 * percent // 100 + 1))
        drawn = sorted((-r.score, r.doc_id) for r in got if r["rank"] is not None)
        assert drawn == sorted((-r.score, r.doc_id) for r in got)[:len(drawn)]


def test_importance_table_keeps_columns_and_empty(spark, docs001, odd_docs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert same_rows(importance.resample_table(docs001, bench), importance.ORACLE)
    kept = importance.resample(odd_docs, bench, keep=("text", "n_words", "rank") if "rank" in odd_docs.columns else ("text",))
    assert kept.count() == odd_docs.count() and "text" in kept.columns
    empty = importance.resample_table(docs001.limit(0), bench.limit(0))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_bisection_finds_the_cut(spark):
    rng = random.Random(5)
    values = [rng.choice([-10**15, -3, 0, 0, 0, 5, 10**12]) + rng.randint(-2, 2) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for want in (1, 17, 250, 500):
        assert importance.least_reaching(df, F.col("v"), want) == sorted(values, reverse=True)[want - 1]


# The tokenization automaton.

def naive_bpe(word, ranks):
    ids = list(word)
    while True:
        best = min(((ranks[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks), default=None)
        if best is None:
            return ids
        # All occurrences of the best pair, from the left.
        pair, out, i = (ids[best[1]], ids[best[1] + 1]), [], 0
        while i < len(ids):
            if tuple(ids[i:i + 2]) == pair:
                out.append(ids[i] + ids[i + 1])
                i += 2
            else:
                out.append(ids[i])
                i += 1
        ids = out


def test_automaton_against_naive_merging():
    rng = random.Random(11)
    for _ in range(60):
        tokens, merges, made = list("abc"), [], set()
        for _ in range(rng.randint(1, 14)):
            a, b = rng.choice(tokens), rng.choice(tokens)
            if a + b not in made and len(a + b) <= 8:
                merges.append((a, b))
                made.add(a + b)
                tokens.append(a + b)
        number = {t: i for i, t in enumerate(tokens)}
        own = bpe_automaton.Automaton({i: t.encode() for t, i in number.items()}, [(number[a], number[b]) for a, b in merges], [number[a + b] for a, b in merges])
        ranks = {m: i for i, m in enumerate(merges)}
        for _ in range(60):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))
            want = [number[t] for t in naive_bpe(word, ranks)]
            assert own.encode(word.encode()) == want and own.accepts(want)
            other = [rng.choice(tokens) for _ in range(rng.randint(1, 4))]
            assert own.accepts([number[t] for t in other]) == (naive_bpe("".join(other), ranks) == other)


def test_automaton_refuses_a_token_made_twice():
    with pytest.raises(ValueError):
        bpe_automaton.Automaton({0: b"a", 1: b"aa", 2: b"aaa"}, [(0, 0), (0, 1), (1, 0)], [1, 2, 2])


def test_bpe_against_the_library(spark, odd_docs, docs001):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_path(bpe_automaton.TOKENIZER))
    rng = random.Random(2)
    odd = ["<|endoftext|>a <|endoftext|><|endoftext", "a\x1c\x85b  　c", "aaaaaaa" * 40, "\U0001f600é ١٢٣ Ⅷ½", " \n\n\t  foo   bar\r\n", "it's we'll I'D  "]
    odd += ["".join(rng.choice(["a", "th", " ", "\n", chr(rng.randint(1, 0x2fff)), chr(rng.randint(0x10000, 0x1ffff)), "'s", "1", "!!", "Ġ"]) for _ in range(20)) for _ in range(100)]
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()] + [(r.doc_id, r.text) for r in docs001.collect()] + [(1000 + i, t) for i, t in enumerate(odd)]
    got = bpe_automaton.bpe_table(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)).collect()

    def want(doc_id, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        return doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()
    assert sorted(repr(tuple(r)) for r in got) == sorted(repr(want(*t)) for t in texts)
    own = bpe_automaton.tokenizer(public_path(bpe_automaton.TOKENIZER))
    for _ in range(300):
        ids = [rng.randrange(50_257) for _ in range(rng.randint(1, 6))]
        assert own.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids, skip_special_tokens=False)
    assert bpe_automaton.bpe_table(docs001.limit(0)).count() == 0


# Ranked search.

def brute_rank(docs, items, k=10):
    def terms(text):
        return [lower(w) for w in re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text or "")]

    held = [(d, Counter(terms(t))) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    N, L = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    queries = defaultdict(set)
    for i, text in items:
        queries[i] |= set(terms(text))
    out = []
    for i, ts in queries.items():
        scored = []
        for d, c in held:
            m = 100 - 90 + (90 * sum(c.values()) * N) // L
            s = sum(math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            if s > 0 and d is not None:
                scored.append((-s, d))
        out += [(i, r + 1, d, -s) for r, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(map(repr, out))


def test_rank_against_brute_force(spark, odd_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    words = [t.split()[j] for _, t in rows if t and len(t.split()) > 20 for j in (0, 5, 11)]
    items = [(1, " ".join(words[:9])), (2, None), (3, ""), (4, "é naïve END one"), (None, words[0]), (5, "nothing here matches qq"), (5, words[2]), (6, " ".join(words) * 2)]
    table = spark.createDataFrame([(*i, "e") for i in items], "item_id long, text string, score string")
    want = brute_rank(rows, items)
    for block_terms in (lexical_rank.BLOCK_TERMS, 7):
        got = lexical_rank.rank_documents(odd_docs, table, block_terms=block_terms)
        assert sorted(repr(tuple(r)) for r in got.collect()) == want
    assert lexical_rank.rank_documents(odd_docs.limit(0), table).count() == 0
    assert lexical_rank.rank_documents(odd_docs, table.limit(0)).count() == 0


def test_rank_ties_over_many_shards(spark, monkeypatch):
    # Copies hold most rows: equal scores are cut by doc_id, across shards and tasks.
    docs = [(i, "alpha beta gamma") for i in range(300, 0, -1)] + [(1000 + i, f"alpha word{i}") for i in range(60)]
    items = [(0, "alpha beta"), (1, "word3 word4 alpha")]
    shards = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = lexical_rank.rank_documents(shards, spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute_rank(docs, items)


def test_rank_table_by_sql(spark, docs001):
    assert same_rows(lexical_rank.rank_table(docs001, spark.read.parquet(f"{SF}/benchmark.parquet")), lexical_rank.ORACLE)


def test_best_positions_stop_before_the_end():
    rng = np.random.default_rng(4)
    n, k = 5000, 10
    lists, whole = [], np.zeros(n, np.int64)
    for w in (900, 700, 300):
        docs = np.sort(rng.choice(n, 3000, replace=False))
        impact = (rng.pareto(1.5, 3000) * 1000).astype(np.int64) + 1
        order = np.argsort(-impact, kind="stable")
        position = np.empty(3000, np.int64)
        position[order] = np.arange(3000)
        lists.append((w, lexical_rank.ImpactList(docs, impact, position, docs[order], impact[order])))
        whole[docs] += w * impact
    ids = rng.permutation(n)
    want = sorted(zip((-whole).tolist(), ids.tolist()))[:k]
    docs, scores, read = lexical_rank.best_positions(lists, ids, k)
    assert list(zip((-scores).tolist(), ids[docs].tolist())) == want and read < 3000
    # A known k-th score only leaves out what lies below it.
    floor = -want[4][0]
    docs, scores, less = lexical_rank.best_positions(lists, ids, k, floor)
    assert list(zip((-scores).tolist(), ids[docs].tolist()))[:5] == want[:5] and less <= read


def test_written_tables_are_dropped_with_the_scratch(spark, monkeypatch, tmp_path):
    from critiq.llm.common import written
    from critiq.session import drop_scratch
    monkeypatch.setattr("critiq.session.ensure_checkpoint_dir", lambda session: str(tmp_path))
    assert written(spark.range(5), "x").count() == 5 and [f for f in tmp_path.rglob("*.parquet")]
    drop_scratch(spark)
    assert not [f for f in tmp_path.rglob("*") if f.is_file()]
