"""Per-document operators against brute force, round trips and held-out data."""
import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest

from critiq.llm import html_text, packing, quality_model, quality_rules, secrets, token_counts, token_files
from critiq.llm.tokens import KEPT_BYTES, PATTERN, UNSAFE, TokenEncoder, cut_bytes, gathered, public_path

from .conftest import prose


# ---- secrets -------------------------------------------------------------
def brute_base(text):
    text = text or ""
    spans = []
    for m in re.finditer(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            spans.append((m.start(), 0, m.end()))
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 16]
    return sorted(spans)


def test_secret_base_spans(docs001, odd_docs):
    for docs in (docs001, odd_docs):
        want = collections.Counter()
        for r in docs.select("doc_id", "text").collect():
            b = brute_base(r.text)
            n = collections.Counter(k for _, k, _ in b)
            digest = hashlib.sha256(",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in b).encode()).hexdigest()
            want[(r.doc_id, n[0], n[1], n[2], digest)] += 1
        got = collections.Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secrets.scan_secrets(docs).collect())
        assert got == want


@pytest.mark.parametrize("text,found", [
    ('k = "aB3$xyz!90Qw"\npassword = k\n', ["aB3$xyz!90Qw"]),
    ('DB_PASS=s3cr3t!Pw#99', ["s3cr3t!Pw#99"]),
    ('<password>hunter2Ab9x!</password>', ["hunter2Ab9x!"]),
    ('--api-key sk_live_abcDEF123456 run', ["sk_live_abcDEF123456"]),
    ('a = b = "Qwerty!2345"\nauth_token: ${b}', ["Qwerty!2345"]),
    ('private_key: str = "abc" + "DEF123456xyz$"', ["DEF123456xyz$"]),
    ('token_count: 1234567890\nsecret_name = "database-main-7"\npassword = "changeme"', []),
    ("the token: people say that keys = doors", []),
    ("ſecret = abcdefgh12345 and KEY", []),
    ('passphrase = b"Zx9kQ2mLp0rT"\nauth_key = rb\'Yx9kQ2mLp0rT\'', ["Zx9kQ2mLp0rT", "Yx9kQ2mLp0rT"]),
    ('a = u"Zx9kQ2mLp0rT"\npassphrase = f"{a}"', ["Zx9kQ2mLp0rT"]),
    ('a = r"Zx9kQ2mLp0rT"\nconf["db_pwd"] = a', ["Zx9kQ2mLp0rT"]),
    ('{"credential": {"value": "Zx9kQ2mLp0rT", "name": "production-db"}, "value": "Qy8wE7rT6uI5"}', ["Zx9kQ2mLp0rT"]),
    ("credentials:\n  host: db-7.internal-1\n  value: Zx9kQ2mLp0rT\nvalue: Qy8wE7rT6uI5\n", ["Zx9kQ2mLp0rT"]),
    ("Authorization: Bearer Zx9kQ2mLp0rT.aa", ["Zx9kQ2mLp0rT.aa"]),
    ('curl -H "Authorization: Bearer Zx9kQ2mLp0rT"', ["Zx9kQ2mLp0rT"]),
])
def test_lexer(text, found):
    _, more = secrets.scan(text)
    assert [text[s:e] for s, _, e in more] == found
    if found:
        assert found[0] not in secrets.redact_text(text)


def test_propagation_is_linear_and_equals_brute_force():
    rng = random.Random(8)
    for _ in range(200):
        names = ["password", "auth_token", "session_key", "key_path", *"abcdefg"]
        lines = [f'{rng.choice(names)} = {rng.choice([rng.choice(names), chr(34) + "v%dAbCdEfGh" % rng.randint(0, 9) + chr(34)])}' for _ in range(rng.randint(1, 14))]
        facts = secrets.Assignments("\n".join(lines))
        want = {}
        for name in facts.literals.keys() | facts.refs.keys():
            seen, todo = {name}, [name]
            while todo:
                k = todo.pop()
                for span in facts.literals.get(k, ()):
                    want[span] = max(want.get(span, 0.0), secrets.name_score(name))
                more = [x for x in facts.refs.get(k, ()) if x not in seen]
                seen.update(more)
                todo += more
        assert facts.scored() == {k: v for k, v in want.items() if v > 0}
    chain = "password = a0\n" + "".join(f"a{i} = a{i + 1}\n" for i in range(10_000)) + 'a10000 = "Zx9$kQ2mLp0rT"\n'
    began = time.process_time()
    _, more = secrets.scan(chain)
    assert [chain[s:e] for s, _, e in more] == ["Zx9$kQ2mLp0rT"] and time.process_time() - began < 1.0
    many = "".join(f'password = "Zx9$kQ2mLp{i}"\npassword: abcdefgh1234{i}\n' for i in range(5_000))
    began = time.process_time()
    secrets.scan(many)
    assert time.process_time() - began < 3.0


@pytest.mark.parametrize("name", ["dbpass", "DBPASS", "dbpwd", "secretkey", "SECRETKEY", "privatekey", "accesskey", "authkey", "passwords", "tokens"])
def test_lexer_joined_names(name):
    text = f'{name} = "s3cr3t!Pw#99"\nmonkey = "s3cr3t!Pw#98"\ntokencount = "s3cr3t!Pw#97"'
    _, more = secrets.scan(text)
    assert "s3cr3t!Pw#99" in [text[s:e] for s, _, e in more] and "s3cr3t!Pw#99" not in secrets.redact_text(text)
    assert "s3cr3t!Pw#98" in secrets.redact_text(text) and "s3cr3t!Pw#97" in secrets.redact_text(text)


def test_failing_assign_consumes_text():
    text = "password=secret=abcdefghijklmn"
    assert brute_base(text) == secrets.base_spans(text)


# ---- quality rules ---------------------------------------------------------
def brute_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    cover = {j for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(cover))


def test_quality_counts(docs001, odd_docs):
    for docs in (docs001, odd_docs):
        want = collections.Counter((r.doc_id, *brute_stats(r.text)) for r in docs.select("doc_id", "text").collect())
        out = quality_rules.quality_table(docs).collect()
        assert collections.Counter((r.doc_id, *(r[c] for c in quality_rules.STATS)) for r in out) == want
        for r in out:
            assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
            assert not (r.kept and r.base_failed)


def test_quality_rejects_outliers_keeps_clean(spark):
    rng = random.Random(5)
    good = [(i, prose(rng, rng.randint(30, 200)) + ".\n" + prose(rng, 40), "en", "a") for i in range(400)]
    bad = [(1000 + i, " ".join(w + "***" for w in prose(rng, 80).split()), "en", "a") for i in range(60)]
    out = quality_rules.quality_table(spark.createDataFrame(good + bad, "doc_id long, text string, lang string, source string"))
    kept = {r.doc_id: r.kept for r in out.collect()}
    assert all(kept[i] for i in range(400)) and not any(kept[1000 + i] for i in range(60))


def test_mcd_matches_direct_steps(spark):
    """The distributed concentration steps against numpy on the same bins."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 5)) @ np.diag([1, .3, .2, .2, .4])
    x[:50] += 9
    df = spark.createDataFrame([("en", "a", r.tolist()) for r in x], "lang string, source string, vec array<double>").repartition(4)
    got = quality_rules.mcd(df).where("not whole").first()
    assert np.abs(np.array(got["mean"]) - x[50:].mean(0)).max() < 0.25
    d = x - np.array(got["mean"])
    dist = np.einsum("ij,jk,ik->i", d, np.array(got["prec"]).reshape(5, 5), d)
    assert dist[:50].min() > quality_rules.chi2_quantile(1 - 1e-6, 5) and np.median(dist[50:]) < 12


# ---- html ----------------------------------------------------------------
def test_html_held_out_layouts():
    model = html_text.default_model()
    right = total = 0
    for page in html_text.labelled_pages(120, seed=77):
        marks = []
        nodes = html_text.parse(page, marks)
        p, _ = model.marginals(nodes, html_text.features(nodes))
        for node, q, y in zip(nodes, p, marks):
            if node.text is not None:
                total += 1
                right += (q >= 0.5) == bool(y)
    assert right / total > 0.99


def test_html_marginals_are_exact():
    """Sum-product against enumeration of all labellings of a small tree."""
    import itertools
    import math
    model = html_text.default_model()
    nodes = html_text.parse('<nav><a href="x">Home</a></nav><article><h1>T</h1><p>Some words here.</p></article>')
    feats = html_text.features(nodes)
    p, edge = model.marginals(nodes, feats)
    z, one = 0.0, [0.0] * len(nodes)
    for y in itertools.product((0, 1), repeat=len(nodes)):
        s = sum(sum(model.unary.get(f, 0) for f in feats[i]) for i in range(len(nodes)) if y[i])
        for i in range(1, len(nodes)):
            pair = (0.0, *model.pair[html_text.kind(nodes[i])])
            s += pair[2 * y[nodes[i].parent] + y[i]]
        w = math.exp(s)
        z += w
        for i in range(len(nodes)):
            one[i] += w * y[i]
    assert np.allclose([v / z for v in one], p)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.1"])
def test_html_pages(spark, scale):
    pages = spark.read.parquet(f"/root/testdata/{scale}/pages.parquet")
    import html

    def truth(h):
        a = h[h.index("<article>") + 9:]
        a = a[:a.index("</article>")] if "</article>" in a else a
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:h1|p)>", a)]
        return "\n".join(x for x in blocks if x)

    want = {r.page_id: truth(r.html) for r in pages.collect()}
    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert got == want


def test_html_odd_pages(spark):
    rows = [(1, None, None, "x"), (2, "u", "", "x"), (None, "u", "<article><p>A &amp; b&nbsp;c<br>d<p>E", "x"), (3, "u", "<article><p>cut off <b", "x"),
            (4, "u", "<article><p>one<!-- <p>two --><script>x='</p>'</script> more words.</p></article><div class='cookie-notice'><p>We use them.</p></div>", "x")]
    out = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()}
    assert out[1] == ("", 0) and out[2] == ("", 0)
    assert out[None][0] == "A & b c d\nE" and out[3][0] == "cut off" and out[4][0] == "one more words."
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("part", ['<svg class="icon"/>', '<svg class="icon">', "<math/>", '<svg viewBox="0 0 1 1"><path d="M0"/></svg>', "<object data='x'>", "<noscript>"])
def test_html_no_text_is_swallowed(part):
    page = f"<article><h1>A title</h1><p>The first paragraph {part} has some words.</p><p>The second paragraph has more words.</p></article>"
    assert html_text.default_model().text(page) == "A title\nThe first paragraph has some words.\nThe second paragraph has more words."


def test_html_fallback_math_and_names():
    page = "<article><p>Where <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p><noscript><p>Shown without scripts, too.</p></noscript><template><p>Not shown.</p></template></article>"
    assert html_text.default_model().text(page) == "Where x=2 holds.\nShown without scripts, too."
    nodes = html_text.parse("<div class='" + " ".join("abcdefghijklmn") + " sidebar'>x</div>")
    assert "n:sidebar" in html_text.features(nodes)[1]


@pytest.mark.parametrize("page,text", [
    ('<article class="post"><h1>T title</h1><p>Some paragraph here with words.</p><ul><li>one item</li><li>two item</li></ul><form><input><button>Send</button></form></article>',
     "T title\nSome paragraph here with words.\none item\ntwo item"),
    ("<article><p>A &amp; B<br>e f</p><p>x 2</p></article>", "A & B e f\nx 2"),
    ("<article><p>one<br>two</p><p>&lt;tag&gt; &eacute;</p></article>", "one two\n<tag> é"),
    ('<body><nav><a href=x>Home</a></nav><article class="post"><p>Alpha beta.</p><ul><li>k</li></ul><form class=search><input></form></article><footer>c</footer></body>', "Alpha beta.\nk"),
    ('<article><h1>Title</h1><p>Shown <span hidden>not this</span> words here.</p><div hidden><p>secret one</p></div><p style="color:red; display: none">secret two</p><p style="visibility:hidden">three</p>'
     '<div hidden="until-found"><p>Found by search.</p></div><p data-x="hidden">More shown.</p></article>', "Title\nShown words here.\nFound by search.\nMore shown."),
])
def test_html_whole_articles_without_hidden_parts(page, text):
    assert html_text.default_model().text(page) == text


@pytest.mark.parametrize("page", ["<div>" * 20_000 + "x" + "</div>" * 20_000, "<span>" * 20_000 + "</b>" * 20_000, "<div>" * 20_000 + "<li>" * 5_000, "<svg>" + "<g/>" * 20_000])
def test_html_deep_pages_are_parsed_in_linear_time(page):
    began = time.process_time()
    html_text.parse(page)
    assert time.process_time() - began < 5.0


# ---- quality model -----------------------------------------------------------
def test_quality_model_held_out(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = quality_model.score_table(docs, labels)
    rows = out.join(labels, "doc_id").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.93


def test_quality_model_odd_rows(spark, odd_docs, labels001):
    rows = quality_model.score_table(odd_docs, labels001).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    none = quality_model.score_table(odd_docs, labels001.where("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_model.score_table(odd_docs.where("false"), labels001).count() == 0


def test_pu_risk_is_minimal_and_prior_found(spark):
    """The Newton steps against the risk itself, on text statistics of two kinds."""
    rng = np.random.default_rng(4)
    n, share = 4000, 0.4
    good = rng.random(n) < share
    x = rng.normal(0, 1, (n, quality_model.N_STATS))
    x[:, :4] += np.where(good, 1.0, -1.0)[:, None]
    trusted = good & (rng.random(n) < 0.5)
    rows = spark.createDataFrame([(r.tolist(), bool(t)) for r, t in zip(x, trusted)], "x array<double>, positive boolean").repartition(4)
    start = quality_model.Model(x.mean(0), x.std(0) + 0.02)
    model = quality_model.pu_fit(rows, start, share, steps=12)
    a = model.design(x)

    def risk(w):
        z = a @ w
        negative = np.logaddexp(0, z).mean() - share * np.logaddexp(0, z[trusted]).mean()
        return share * np.logaddexp(0, -z[trusted]).mean() + max(0.0, negative) + quality_model.DECAY / 2 * w @ w

    least = risk(model.weight)
    for size in (0.02, 0.2):
        for _ in range(60):
            d = rng.normal(size=len(model.weight))
            assert risk(model.weight + size * d / np.sqrt(d @ d)) > least - 1e-3
    assert risk(start.weight) > least + 0.1
    assert ((model.scores(x) >= 0.5) == good).mean() > 0.93
    assert 0.25 < quality_model.estimate_prior(rows, model) < 0.46


# ---- tokens, files, packing ----------------------------------------------------
def test_encoder_equals_library(docs001):
    texts = [r.text for r in docs001.collect()][:60] + ["it's  we'll\n\n x²½ don’t –€ É ẞ x", "\t\t a  ", "", "a b́ İ ſ K", "<|endoftext|> x ١٢", "Ĳ Œ ﬁ 你好 \x0b \x85"]
    for name in PATTERN:
        e = TokenEncoder(public_path(name), memo=500)
        assert e.ids(texts) == e._whole(texts)


def test_block_round_trip_and_damage():
    rng = np.random.default_rng(0)
    for n in (0, 1, 7, 300, 9000):
        docs = [(i if i % 3 else None, rng.zipf(1.3, n).clip(0, 50_256).astype("<u4").tobytes()) for i in range(5)]
        block = token_files.write_block(docs)
        assert token_files.read_block(block) == docs
    for at in (3, 30, len(block) // 2, len(block) - 1):
        bad = bytearray(block)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            token_files.read_block(bytes(bad))


def test_coder_adds_up_its_counts_seldom(monkeypatch):
    # Adding up the counts of all ids takes as long as some thousand ids do.
    added = []
    refresh = token_files.Mixer.refresh
    monkeypatch.setattr(token_files.Mixer, "refresh", lambda self: added.append(self.seen) or refresh(self))
    ids = np.random.default_rng(4).zipf(1.2, 60_000).clip(0, 50_256).astype(np.int64)
    lanes, counts, words = token_files.compress_ids(ids, 50_257)
    n = len(added)
    assert (token_files.expand_ids(len(ids), lanes, counts, words, 50_257) == ids).all()
    assert len(added) == 2 * n and n <= 64 < token_files.RUN


def brute_tokens(docs, name, end):
    e = TokenEncoder(public_path(name))
    return [(r.doc_id, e._whole([r.text or ""])[0] + np.array([end], "<u4").tobytes()) for r in docs.select("doc_id", "text").collect()]


def test_token_files(docs001, odd_docs):
    for docs in (docs001, odd_docs):
        want = sorted(brute_tokens(docs, token_files.TOKENIZER, 2), key=lambda r: (r[0] is not None, r[0] or 0))
        got = sorted(token_files.token_table(docs).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in got] == [d for d, _ in want]
        assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == collections.Counter((d, len(b) // 4, zlib.crc32(b)) for d, b in want)
        at = 0
        for r in got:
            assert r.start == at
            at += r.n_tokens
    assert token_files.token_table(docs.where("false")).count() == 0


def test_packing(docs001, odd_docs):
    for docs in (docs001, odd_docs):
        want = collections.Counter(b for _, b in brute_tokens(docs, packing.TOKENIZER, 1))
        rows = packing.pack_documents(docs).collect()
        sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
        for r in rows:
            sequences[r.sequence_id].append(r)
            pieces[r.doc_id, r.doc_tokens].append(r)
        for s in sequences.values():
            s.sort(key=lambda r: r.offset)
            assert [r.offset for r in s] == np.cumsum([0] + [r.length for r in s])[:-1].tolist()
            assert sum(r.length for r in s) <= 2048 and len(s) <= packing.Limits().segments
        assert sum(r.length for r in rows) == sum(len(b) // 4 * k for b, k in want.items())
        whole = collections.Counter()
        for (_, n), ps in pieces.items():
            if sum(p.length for p in ps) == n:
                whole[b"".join(bytes(p.ids) for p in sorted(ps, key=lambda p: p.start))] += 1
        assert not whole - want and sum(whole.values()) >= 0.8 * len(set(pieces))
    assert packing.pack_table(docs.where("false")).count() == 0


def test_packing_limits():
    rng = np.random.default_rng(1)
    lim = packing.Limits(256, 4, 150)
    rows = [(i, rng.integers(0, 99, int(n)).astype("<u4"), (rng.random(int(n)) < 0.6).astype(np.uint8)) for i, n in enumerate(rng.lognormal(4, 1.2, 400).clip(1))]
    masks = {i: m for i, _, m in rows}
    back = collections.defaultdict(list)
    for seq in packing.pack_rows(iter(rows), lim, 0):
        assert sum(r[2] for r in seq) <= 256 and len(seq) <= 4
        assert sum(int(masks[r[0]][r[1]:r[1] + r[2]].sum()) for r in seq) <= 150
        for r in seq:
            back[r[0]].append(r)
    for i, ids, _ in rows:
        assert b"".join(r[3] for r in sorted(back[i], key=lambda r: r[1])) == ids.tobytes()


def test_packing_of_short_documents_pads_little():
    # The limit on segments closes bins long before they are full.
    rows = [(i, np.arange(1 + i % 9, dtype="<u4"), None) for i in range(4000)]
    sequences = list(packing.pack_rows(iter(rows), packing.Limits(), 0))
    used = [sum(p[2] for p in seq) for seq in sequences]
    room = [n if n & (n - 1) == 0 else 2048 for n in used]
    assert sum(used) == sum(len(r[1]) for r in rows) and all(len(seq) <= 128 for seq in sequences)
    assert sum(room) < 1.02 * sum(used)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_joined_new_words_equal_single_ones(name, docs001):
    enc = TokenEncoder(public_path(name))
    texts = [r.text or "" for r in docs001.collect()][:60] + ["word Word's ſix naïve’s 12 a\tb", "", "ſ", "I'd é! 'S x's"]
    want = [np.array(e.ids, "<u4").tobytes() for e in enc.library.encode_batch(texts, add_special_tokens=False)]
    assert enc.ids(texts) == want and enc.ids(texts) == want
    small = TokenEncoder(public_path(name), memo=50)
    assert [small.ids([t])[0] for t in texts] == want


def test_full_memo_keeps_common_words(monkeypatch):
    asked = []
    new = TokenEncoder._new
    monkeypatch.setattr(TokenEncoder, "_new", lambda self, pieces: asked.extend(pieces) or new(self, pieces))
    enc = TokenEncoder(public_path("word_bpe_49k.json"), memo=40)
    common = ["alpha", "beta", "gamma", "delta"]
    texts = [" ".join([*common, "x" + "abcdefghij"[k // 10] + "abcdefghij"[k % 10]]) for k in range(100)]
    got = [enc.ids([t])[0] for t in texts]
    assert got == [np.array(e.ids, "<u4").tobytes() for e in enc.library.encode_batch(texts, add_special_tokens=False)]
    # The memo was full several times; only the words met once came anew.
    assert len(asked) == 104 and len(enc.known) + len(enc.old) <= 2 * 41


def test_byte_cut_equals_pattern():
    rng = random.Random(3)
    parts = [*"  \n\t\r'stmdrevlx aAé²½3€–ßŒ.!<|İ你\x0b\xa0😀ſªº‧ʼ", "'ll", "'re", " '", "'s", "'ve", "'"]
    for _ in range(3000):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 9))) for _ in range(rng.randint(1, 5))] + ["x"]
        raw = [t.encode() for t in texts]
        offs = np.cumsum([0, *map(len, raw)])
        doubt = [k for k, t in enumerate(texts) if "<|" in t or UNSAFE.search(t)]
        starts = []
        for k, (t, at) in enumerate(zip(texts, offs.tolist())):
            for p in [t] if k in doubt else PATTERN["byte_bpe_50k.json"].findall(t):
                starts.append(at)
                at += len(p.encode())
        got = cut_bytes(np.frombuffer(b"".join(raw), np.uint8), offs)
        assert (got[0].tolist(), got[1].tolist()) == (starts, doubt)


def test_byte_memo_takes_distinct_pieces_and_stays_small(monkeypatch):
    asked = []
    new = TokenEncoder._new_pieces
    monkeypatch.setattr(TokenEncoder, "_new_pieces", lambda self, pieces: asked.extend(pieces.to_pylist()) or new(self, pieces))
    enc = TokenEncoder(public_path("byte_bpe_50k.json"), memo=8)
    long = "y" * (KEPT_BYTES + 1)
    texts = [f"one two three {'abcdefghij'[k // 10]}{'abcdefghij'[k % 10]}q one two " + long for k in range(100)]
    column = pa.array([*texts, None, "", "x 你 one"])
    want = [np.array(e.ids, "<u4").tobytes() for e in enc.library.encode_batch([t or "" for t in column.to_pylist()], add_special_tokens=False)]
    # One run of texts: each distinct piece is asked for once.
    assert list(enc.column(column)) == want and len(asked) == len(set(asked)) == 106
    asked.clear()
    assert [b for k in range(len(column)) for b in enc.column(column.slice(k, 1))] == want
    assert len(enc.keys) <= 16 and max(map(len, enc.keys.to_pylist())) <= KEPT_BYTES
    # The common words stayed while the memo was full several times.
    assert max(asked.count(p) for p in ("one", " two", " three")) <= 1 and asked.count(" " + long) == 100


def test_gathered_batches():
    batches = [pa.RecordBatch.from_arrays([pa.array(["abc"] * n, pa.string())], names=["t"]) for n in (3, 0, 5, 1)]
    got = list(gathered(iter(batches), 2 * batches[0].nbytes))
    assert [b.num_rows for b in got] == [8, 1] and not list(gathered(iter([]), 5))


# ---- token counts ---------------------------------------------------------------
def test_token_counts(docs001, odd_docs):
    scores = token_counts.unigram_scores(public_path(token_counts.VOCABULARY))

    def brute(word):
        word = token_counts.MARK + word
        best = [(0.0, 0)]
        for i in range(1, len(word) + 1):
            options = [(round(best[j][0] + scores[word[j:i]], 7), -best[j][1] - 1) for j in range(max(0, i - 20), i) if word[j:i] in scores]
            if word[i - 1] not in scores:
                n = len(word[i - 1].encode())
                options.append((round(best[i - 1][0] + n * token_counts.BYTE_SCORE, 7), -best[i - 1][1] - n))
            s, n = max(options)
            best.append((s, -n))
        return best[-1][1]

    cache = {}
    for docs in (docs001.limit(40), odd_docs):
        want = collections.Counter()
        for r in docs.select("doc_id", "text").collect():
            ws = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
            for w in set(ws) - cache.keys():
                cache[w] = brute(w)
            want[(r.doc_id, len(ws), sum(cache[w] for w in ws))] += 1
        assert collections.Counter(map(tuple, token_counts.count_tokens(docs).collect())) == want
    small = token_counts.TrieCounter(scores, nodes=50, words=20)
    assert small.texts([r.text for r in docs001.limit(20).collect()]) == token_counts.TrieCounter(scores).texts([r.text for r in docs001.limit(20).collect()])
