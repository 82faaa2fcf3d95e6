"""Secret scan by assignment-aware lexing.

Every whole text gets three base pattern scans (``assign``, ``access``,
``hex``) and a lexer that reads source and configuration syntax into
name-literal pairs (``name = "x"``, ``"name": "x"``, ``name: x``, ``NAME=x``,
``--name x``, ``<name>x</name>``, ``conf["name"] = x``, nested braces and
indented blocks, prefixed and joined strings), propagates constants
(``k = "x"; password = k``) and scores each literal by the most sensitive name
that it reaches.  Propagation visits every name of a text once.  Literals over the threshold add spans of kind ``literal``
unless a base ``assign`` span already covers them.

Map-only: one pass, one text at a time, no shuffle; a lost task repeats alone.

Edge cases: null and empty texts have no spans; equal rows give equal rows;
equal starts are ordered by kind as listed, then end; an empty table gives an
empty result; other columns are ignored (scan) or passed through (redact).
Positions are code points, ends exclusive.
"""
from __future__ import annotations

import bisect
import functools
import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

# FIXED VALUES: the base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?((?-i:[A-Za-z0-9+/_.=-]+))""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "literal")

# Weights of the words that a name is made of; a name scores their sum.
NAME_WEIGHT = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "pwd": 0.9, "pass": 0.7, "secret": 1.0, "secrets": 0.8,
    "token": 0.8, "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "cred": 0.7, "creds": 0.8, "auth": 0.5,
    "authorization": 0.7, "bearer": 0.7, "private": 0.4, "key": 0.4, "api": 0.3, "access": 0.3, "client": 0.1,
    "signing": 0.4, "encryption": 0.4, "master": 0.2, "session": 0.2, "webhook": 0.2,
    # Names about a secret rather than of one.
    "id": -0.5, "name": -0.7, "url": -0.7, "uri": -0.6, "path": -0.8, "file": -0.8, "type": -0.8, "length": -0.9,
    "len": -0.9, "count": -0.9, "max": -0.5, "min": -0.5, "field": -0.8, "label": -0.8, "hint": -0.8, "prompt": -0.8,
    "public": -0.9, "expiry": -0.8, "ttl": -0.8, "policy": -0.8, "regex": -0.8, "header": -0.6, "hash": -0.3,
    "host": -0.9, "hostname": -0.9, "port": -0.9, "region": -0.9, "email": -0.9, "username": -0.9, "domain": -0.9,
    "endpoint": -0.9, "version": -0.9, "description": -0.9, "title": -0.9, "date": -0.9, "time": -0.9, "format": -0.9,
    "status": -0.9, "created": -0.9, "updated": -0.9, "expires": -0.9,
}
# Words that only say whose secret it is, inside names written as one word.
WHOSE = frozenset("db database user app admin root my aws gcp azure git github smtp mail ftp ssh redis mysql postgres mongo service server".split())
PLACEHOLDER = re.compile(r"(?i)^(?:change_?me|example|sample|dummy|test|none|null|nil|true|false|undefined|redacted|hidden|your.*|x+|\*+|\.+|<.*>|\$\{.*|\{\{.*|%\(.*|env\..*|process\.env.*|os\.environ.*)$")
THRESHOLD = 0.45
LEAST_LITERAL = 8
# A text without one of these cannot hold a name that scores.
STEM = re.compile(r"pass|pwd|secret|token|key|cred|auth|bearer|private|signing|encryption", re.I | re.A)
_SUBWORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_LEX = re.compile(r"""
    (?P<tag><(?P<tname>[A-Za-z_][\w.-]*)>(?P<tval>[^<>\n]+)</(?P=tname)>)
  | (?P<flag>--(?P<fname>[A-Za-z][\w-]*)(?:=|\x20+)(?P<fval>[^\s"'-][^\s"']*))
  | (?P<str>(?P<pre>(?<![\w$])[bBrRuUfF]{1,2})?(?:"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`))
  | (?P<ref>\$\{(?P<rname>\w+)\})
  | (?P<op>:=|=>|==|!=|<=|>=|=|:|\+|,|;|\(|\)|\{|\}|\[|\])
  | (?P<word>[^\s"'`=:+,;(){}\[\]<>]+(?:[+/][^\s"'`=:+,;(){}\[\]<>]+)*)
  | (?P<nl>\n)
""", re.X)
# A string that begins with an assignment; schemes that may stand before a value.
_INNER = re.compile(r"\s*[A-Za-z_][\w.-]*\s*[:=]", re.A)
SCHEMES = frozenset(["bearer", "basic", "token", "apikey", "digest"])
# Names of enclosing blocks that count for a name.
_PATH = 3
_NAME = re.compile(r"[A-Za-z_$][\w.$-]*\Z", re.A)


@functools.lru_cache(maxsize=1 << 16)
def _word_score(word: str) -> float:
    """Weight of a lower-case word, or the summed weights of the fewest known
    words (with plural s) that it is joined of; 0 if it is not."""
    if word in NAME_WEIGHT:
        return NAME_WEIGHT[word]
    if len(word) > 64:
        return 0.0
    best: list[tuple[int, float] | None] = [(0, 0.0)] + [None] * len(word)
    for j in range(1, len(word) + 1):
        for i in range(max(0, j - 15), j):
            part, at = word[i:j], best[i]
            one = part if part in NAME_WEIGHT or part in WHOSE else part[:-1] if part[-1] == "s" and part[:-1] in NAME_WEIGHT else None
            if at is not None and one is not None:
                new = (at[0] + 1, at[1] + NAME_WEIGHT.get(one, 0.0))
                if best[j] is None or new[0] < best[j][0] or (new[0] == best[j][0] and new[1] > best[j][1]):
                    best[j] = new
    return best[-1][1] if best[-1] else 0.0


def name_score(name: str) -> float:
    """Sensitivity of a name, 0 to 1."""
    words = [w.lower() for w in _SUBWORD.findall(name)]
    return max(0.0, min(1.0, sum(_word_score(w) for w in words)))


def literal_score(value: str) -> float:
    """How much a literal looks like a secret rather than a word or place
    holder, 0 to 1: bits per character and character classes."""
    n = len(value)
    if n < LEAST_LITERAL or PLACEHOLDER.match(value) or any(c.isspace() for c in value):
        return 0.0
    bits = -sum(k / n * math.log2(k / n) for k in Counter(value).values())
    classes = sum(any(f(c) for c in value) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return min(1.0, 0.2 * (classes - 1) + bits / 5.0)


class Assignments:
    """What the names of a text are given: ``literals`` (spans) and ``refs`` (other
    names).  A name inside the braces or the indented block of other names also
    counts under its path, as in ``credential.value``."""

    def __init__(self, text: str):
        self.literals: dict[str, list[tuple[int, int]]] = {}
        self.refs: dict[str, list[str]] = {}
        self._read(text, 0, True)

    def _literal(self, names: list[str], start: int, end: int) -> None:
        for name in names:
            self.literals.setdefault(name, []).append((start, end))

    def _refer(self, names: list[str], other: str) -> None:
        for name in names:
            self.refs.setdefault(name, []).append(other)

    def _tokens(self, text: str, at: int, outer: bool) -> list[tuple[str, str, int, int]]:
        toks: list[tuple[str, str, int, int]] = []
        for m in _LEX.finditer(text):
            if m["tag"]:
                a, b = m.span("tval")
                lead = len(m["tval"]) - len(m["tval"].lstrip())
                self._literal([m["tname"]], at + a + lead, at + a + lead + len(m["tval"].strip()))
            elif m["flag"]:
                a, b = m.span("fval")
                self._literal([m["fname"]], at + a, at + b)
            elif m["str"]:
                skip = len(m["pre"] or "") + 1
                inner = m["str"][skip:-1]
                toks.append(("str", inner, at + m.start() + skip, at + m.end() - 1))
                # A string may hold an assignment of its own, as header lines do.
                if outer and _INNER.match(inner) and STEM.search(inner):
                    self._read(inner, at + m.start() + skip, False)
            elif m["ref"]:
                toks.append(("ref", m["rname"], at + m.start(), at + m.end()))
            elif m["op"]:
                toks.append(("op", m["op"], at + m.start(), at + m.end()))
            elif m["word"]:
                toks.append(("word", m["word"], at + m.start(), at + m.end()))
            else:
                toks.append(("nl", "\n", at + m.start(), at + m.end()))
        return toks

    def _read(self, text: str, at: int, outer: bool) -> None:
        toks = self._tokens(text, at, outer)
        braces: list[str | None] = []
        blocks: list[tuple[int, str]] = []
        i, n, line = 0, len(toks), at
        while i < n:
            kind, value, s, _ = toks[i]
            if kind == "nl":
                line = toks[i][3]
                i += 1
                continue
            if i == 0 or toks[i - 1][0] == "nl":
                while blocks and s - line <= blocks[-1][0]:
                    blocks.pop()
            if kind == "op" and value == "{":
                braces.append(None)
            elif kind == "op" and value == "}" and braces:
                braces.pop()
            # name["key"] = value
            step = 3 if kind == "op" and value == "[" and i + 3 < n and toks[i + 1][0] == "str" and toks[i + 2][:2] == ("op", "]") else 1
            name = toks[i + 1][1] if step == 3 else value
            if i + step >= n or toks[i + step][0] != "op" or toks[i + step][1] not in ("=", ":", ":=", "=>") or (step == 1 and kind not in ("word", "str")) or not _NAME.match(name):
                i += 1
                continue
            around = [b for b in braces if b][-_PATH:] + [b for _, b in blocks[-_PATH:]]
            names = [name] + ([".".join([*around, name])] if around else [])
            j = i + step + 1
            if j < n and toks[j][:2] == ("op", "{"):
                braces.append(name)
                i = j + 1
                continue
            if j < n and toks[j][0] == "nl" and toks[i + step][1] == ":":
                blocks.append((s - line if step == 1 else 0, name))
                i = j
                continue
            i = self._value(toks, i, i + step, names)

    def _value(self, toks: list[tuple[str, str, int, int]], i: int, op: int, names: list[str]) -> int:
        """Take the value behind the operator at ``op``; the next token to read."""
        n, j = len(toks), op + 1
        # name: Type = value
        if toks[op][1] == ":" and j + 2 < n and toks[j][0] == "word" and toks[j + 1][:2] == ("op", "="):
            j += 2
        # Authorization: Bearer value
        if j + 1 < n and toks[j][0] == toks[j + 1][0] == "word" and toks[j][1].lower() in SCHEMES:
            names = [f"{x}.{toks[j][1]}" for x in names]
            j += 1
        step = j
        while j < n:
            kind, value, s, e = toks[j]
            if kind == "str":
                self._literal(names, s, e)
                for ref in re.findall(r"\$\{(\w+)\}|\{(\w+)\}", value):
                    self._refer(names, ref[0] or ref[1])
            elif kind == "word":
                value = value.rstrip(".")
                self._literal(names, s, s + len(value))
                if _NAME.match(value):
                    self._refer(names, value)
            elif kind == "ref":
                self._refer(names, value)
            else:
                break
            j += 1
            if j < n and toks[j][:2] == ("op", "+"):
                j += 1
            elif not (kind == "str" and j < n and toks[j][0] == "str"):
                break
        # A value may itself be the next pair's name (``a = b = "x"``).
        if j > step and j < n and toks[j][0] == "op" and toks[j][1] in ("=", ":=") and toks[j - 1][0] == "word":
            self._refer(names, toks[j - 1][1])
            return j - 1
        return j if j > step else max(step, i + 1)

    def reached(self) -> dict[str, float]:
        """The score of the most sensitive name whose value reaches each name, over
        references; every name is visited once, from the highest score down."""
        scores = {name: name_score(name) for name in self.literals.keys() | self.refs.keys()}
        best: dict[str, float] = {}
        for start in sorted(scores, key=lambda x: -scores[x]):
            if scores[start] <= 0.0:
                break
            todo = [start]
            while todo:
                name = todo.pop()
                if name not in best:
                    best[name] = scores[start]
                    todo += [x for x in self.refs.get(name, ()) if x not in best and x in scores]
        return best

    def scored(self) -> dict[tuple[int, int], float]:
        """The score of each literal that some sensitive name takes."""
        out: dict[tuple[int, int], float] = {}
        for name, score in self.reached().items():
            for span in self.literals.get(name, ()):
                if score > out.get(span, 0.0):
                    out[span] = score
        return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the base patterns' spans."""
    low = text.lower()
    out = []
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def literal_spans(text: str, covered: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """Spans of literals under sensitive names, without those inside ``covered``."""
    if not ("=" in text or ":" in text or "--" in text or "</" in text) or not STEM.search(text):
        return []
    # Base spans do not overlap: the one that starts last before a literal decides.
    starts = [a for a, _ in covered]

    def inside(s: int, e: int) -> bool:
        i = bisect.bisect_right(starts, s) - 1
        return i >= 0 and e <= covered[i][1]

    return sorted((s, 3, e) for (s, e), score in Assignments(text).scored().items()
                  if score * literal_score(text[s:e]) >= THRESHOLD and not inside(s, e))


def scan(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, added spans) of one text."""
    text = text or ""
    base = base_spans(text)
    return base, literal_spans(text, [(a, b) for a, k, b in base if k == 0])


def _digest(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


_SCHEMA = pa.schema([("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()),
                     ("spans", pa.string()), ("n_literal", pa.int64())])


def scan_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: counts by kind, a digest of the base spans and all
    spans as ``kind:start:end`` in order."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                base, more = scan(text.as_py())
                n = Counter(k for _, k, _ in base)
                rows.append((n[0], n[1], n[2], hashlib.sha256(_digest(base).encode()).hexdigest(), _digest(sorted(base + more)), len(more)))
            cols = list(zip(*rows)) or [()] * len(_SCHEMA)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, type=f.type) for c, f in zip(cols, _SCHEMA)]], names=["doc_id", *_SCHEMA.names])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long")


def redact_text(text: str, mark: str = "<SECRET>") -> str:
    """The text with each secret value replaced (of an ``assign`` span only the
    value, so that the name stays readable)."""
    base, more = scan(text)
    spans = []
    for a, k, b in base + more:
        if k == 0:
            a = ASSIGN.match(text, a).start(2)
        spans.append((a, b))
    out, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets replaced in ``text`` (and ``n_chars`` brought in
    line where it exists); rows without secrets are unchanged."""
    small_batches(docs.sparkSession)
    names = docs.columns
    at, count = names.index("text"), names.index("n_chars") if "n_chars" in names else -1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            old = batch.column(at).to_pylist()
            new = [t and redact_text(t) for t in old]
            cols = list(batch.columns)
            cols[at] = pa.array(new, type=batch.schema.field(at).type)
            if count >= 0:
                cols[count] = pa.array([c if a == b else len(b) for a, b, c in zip(old, new, batch.column(count).to_pylist())], type=batch.schema.field(count).type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
