"""Byte-pair encoding by a tokenization automaton, and decoding by its labels.

The automaton reads token ids and accepts exactly the id sequences that the
merges make of some word.  It is built from one state with a loop for every byte
by a gadget for each merge (u, v) -> w in order of rank: let s be the state
that u leads to.  If s has an arc v, u now leads to a copy of s without that
arc, and w, taken wherever u could be taken, leads to where v led.  All arcs of
one token lead to one state, so the automaton stays deterministic and a merge
costs one state.

Arcs stay cheap by an order of the tokens: w may be taken where its left part
may, so a state that loses an arc v loses all later tokens that begin with v by
their left parts.  In the post-order of that tree, children by rank, these are
one interval ending at v.  The row of a state in the transition table is
therefore a short sorted list of intervals that it has no arc for (for the file
used here 366,000 before joining, in 14,600 rows).

A text is cut at added tokens and into pre-split words.  A word is encoded by
following the arcs whose labels spell it, longest first; only one path spells a
word, so a position from which the walk fails is never entered again and a word
costs at most one visit a byte.  Ids of decoded words are the labels of the
arcs, joined.

Map-only, one text at a time; a worker compiles the table once and keeps the ids
of short words, up to ``MEMO`` of them.

Edge cases: null and empty texts have no ids and decode to an empty text; equal
rows give equal rows; very long words are walked like others; an empty table
gives an empty result; other columns are ignored.  Files whose merges give one
token twice, or whose added tokens strip or match whole words only, are refused.
"""
from __future__ import annotations

import json
import os
import re
import struct
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .tokens import PATTERN, UNSAFE, public_path

TOKENIZER = "byte_bpe_50k.json"
MEMO = 400_000
MEMO_CHARS = 64
# Key of the token in a trie node, beside the bytes 0 to 255.
_TOKEN = 256


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the file: printable Latin-1 characters
    for themselves, the other bytes in order from U+0100."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """``merges``: pairs of ids by rank, ``made``: the id that each makes,
    ``labels``: bytes of each id; ids of single bytes need no merge."""

    def __init__(self, labels: dict[int, bytes], merges: list[tuple[int, int]], made: list[int]):
        if len(set(made)) < len(made):
            raise ValueError("two merges make the same token")
        self.labels = labels
        alive = {t for t, label in labels.items() if len(label) == 1} - set(made)
        kids: dict[int, list[int]] = {}
        for (u, _), w in zip(merges, made):
            kids.setdefault(u, []).append(w)
        first, self.number = self._post_order(alive, kids)
        # States: the state copied, and the interval of arcs that it lost.
        self.copied, self.lost = [-1], [(0, -1)]
        self.state = dict.fromkeys(alive, 0)
        next_kid = dict.fromkeys(kids, 0)
        for (u, v), w in zip(merges, made):
            # The first child of v that is not made yet, or w itself (u = v).
            at = next_kid.get(v, 0)
            next_kid[u] += 1
            if u not in alive or v not in alive or self._lacks(self.state[u], self.number[v]):
                continue  # this merge can never happen
            self.copied.append(self.state[u])
            self.lost.append((first[kids[v][at]] if at < len(kids.get(v, ())) else self.number[v], self.number[v]))
            # The old target of v, which is s itself if u = v.
            self.state[w] = self.state[v]
            self.state[u] = len(self.copied) - 1
            alive.add(w)
        self.longest = max((len(labels[t]) for t in alive), default=0)
        self._rows()
        self._arcs(alive)

    @staticmethod
    def _post_order(roots: set[int], kids: dict[int, list[int]]) -> tuple[dict[int, int], dict[int, int]]:
        """Least number below each token, and its own number."""
        first: dict[int, int] = {}
        number: dict[int, int] = {}
        n = 0
        for root in sorted(roots):
            todo = [(root, False)]
            while todo:
                t, done = todo.pop()
                if done:
                    number[t] = n
                    n += 1
                else:
                    first[t] = n
                    todo.append((t, True))
                    todo += [(k, False) for k in reversed(kids.get(t, ()))]
        return first, number

    def _lacks(self, state: int, number: int) -> bool:
        while state > 0:
            a, b = self.lost[state]
            if a <= number <= b:
                return True
            state = self.copied[state]
        return False

    def _rows(self) -> None:
        """Rows of the transition table: joined intervals without an arc."""
        rows: dict[int, tuple[list[int], list[int]]] = {0: ([], [])}
        for q in set(self.state.values()):
            if q in rows:
                continue
            cuts, s = [], q
            while s > 0:
                cuts.append(self.lost[s])
                s = self.copied[s]
            starts: list[int] = []
            ends: list[int] = []
            for a, b in sorted(cuts):
                if ends and a <= ends[-1] + 1:
                    ends[-1] = max(ends[-1], b)
                else:
                    starts.append(a)
                    ends.append(b)
            rows[q] = (starts, ends)
        self.rows = rows
        self.row_of = {t: rows[q] for t, q in self.state.items()}

    def _arcs(self, alive: set[int]) -> None:
        """A trie of the labels: byte -> node, ``_TOKEN`` -> (token, number)."""
        self.trie: dict = {}
        for t in alive:
            node = self.trie
            for b in self.labels[t]:
                node = node.setdefault(b, {})
            node[_TOKEN] = (t, self.number[t])

    def accepts(self, ids: list[int]) -> bool:
        """Whether the merges make these ids of their joined labels."""
        row = self.rows[0]
        for t in ids:
            if t not in self.row_of or not _has(row, self.number[t]):
                return False
            row = self.row_of[t]
        return True

    def _spelled(self, word: bytes, at: int) -> list[tuple[int, tuple[int, int]]]:
        """(end, (token, number)) of the labels that begin at a position, longest last."""
        out, node = [], self.trie
        for b in word[at:at + self.longest]:
            node = node.get(b)
            if node is None:
                break
            at += 1
            t = node.get(_TOKEN)
            if t is not None:
                out.append((at, t))
        return out

    def encode(self, word: bytes) -> list[int]:
        """The ids of a word: the one accepted path that spells it."""
        ids: list[int] = []
        failed: set[int] = set()
        rows, ways = [self.rows[0]], [self._spelled(word, 0)]
        ends = [0]
        n = len(word)
        while ends[-1] < n:
            way, (starts, stops) = ways[-1], rows[-1]
            while way:
                end, (t, number) = way.pop()
                if end not in failed:
                    i = bisect_right(starts, number)
                    if i == 0 or stops[i - 1] < number:
                        ids.append(t)
                        ends.append(end)
                        rows.append(self.row_of[t])
                        ways.append(self._spelled(word, end))
                        break
            else:
                if not ids:
                    raise ValueError("the alphabet of the file lacks a byte")
                failed.add(ends.pop())
                ids.pop()
                rows.pop()
                ways.pop()
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.labels.__getitem__, ids))


def _has(row: tuple[list[int], list[int]], number: int) -> bool:
    i = bisect_right(row[0], number)
    return i == 0 or row[1][i - 1] < number


class Tokenizer:
    """Whole texts by a byte-level tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, letters = file["model"], byte_letters()
        for key in ("normalizer", "post_processor"):
            if file.get(key) is not None:
                raise ValueError(f"files with a {key} are not handled")
        if model["type"] != "BPE" or file["pre_tokenizer"]["type"] != "ByteLevel" or file["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("not a byte-level tokenizer file")
        vocab = model["vocab"]
        labels = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.automaton = Automaton(labels, [(vocab[a], vocab[b]) for a, b in pairs], [vocab[a + b] for a, b in pairs])
        self.added = {}
        for token in file["added_tokens"]:
            if any(token[k] for k in ("single_word", "lstrip", "rstrip", "normalized")):
                raise ValueError("added tokens that strip or match whole words only are not handled")
            self.added[token["content"]] = token["id"]
            spelt = set(token["content"]) <= set(letters)
            labels[token["id"]] = bytes(map(letters.__getitem__, token["content"])) if spelt else token["content"].encode()
        self.find_added = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.labels, self.letters, self.path = labels, letters, path
        name = os.path.basename(path)
        self.split = PATTERN[name].findall if name in PATTERN else None
        self.library = None
        self.known: dict[str, bytes] = {}

    def _words(self, text: str) -> list[str] | list[bytes]:
        """Pre-split words of a text without added tokens; texts with characters
        of doubtful class are split by the library's own rule."""
        if self.split is not None and not UNSAFE.search(text):
            return self.split(text)
        if self.library is None:
            from tokenizers import Tokenizer as Library
            self.library = Library.from_file(self.path).pre_tokenizer
        return [bytes(map(self.letters.__getitem__, w)) for w, _ in self.library.pre_tokenize_str(text)]

    def _word(self, word: str | bytes) -> bytes:
        ids = self.automaton.encode(word if isinstance(word, bytes) else word.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def _ids(self, text: str) -> bytes:
        words = self._words(text)
        try:
            return b"".join(map(self.known.__getitem__, words))
        except KeyError:
            found = {w: self.known.get(w) or self._word(w) for w in set(words)}
        if len(self.known) + len(found) > MEMO:
            self.known.clear()
        self.known.update((w, ids) for w, ids in found.items() if len(w) <= MEMO_CHARS)
        return b"".join(map(found.__getitem__, words))

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.find_added is None or not self.find_added.search(text):
            return self._ids(text)
        return b"".join(struct.pack("<I", self.added[part]) if part in self.added else self._ids(part)
                        for part in self.find_added.split(text) if part)

    def decode(self, ids: bytes | None) -> str:
        """The labels of the ids, joined; bytes that are no UTF-8 become U+FFFD,
        ids that the file does not have are left out."""
        numbers = np.frombuffer(ids or b"", "<u4").tolist()
        try:
            raw = b"".join(map(self.labels.__getitem__, numbers))
        except KeyError:
            raw = b"".join(self.labels.get(i, b"") for i in numbers)
        return raw.decode("utf-8", "replace")


_LOADED: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The compiled tokenizer of a worker process."""
    if path not in _LOADED:
        _LOADED[path] = Tokenizer(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids): ids of whole texts, little-endian unsigned 32-bit."""
    small_batches(docs.sparkSession)
    path = path or public_path(TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([own.encode(t.as_py()) for t in batch.column(1)], pa.binary())], names=["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, text) for (doc_id, ids)."""
    small_batches(encoded.sparkSession)
    path = path or public_path(TOKENIZER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([own.decode(i.as_py()) for i in batch.column(1)], pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def bpe_table(docs: DataFrame) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    x = decode_documents(encode_documents(docs))
    return x.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
