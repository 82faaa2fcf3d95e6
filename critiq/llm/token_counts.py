"""Token counts by dynamic programming over a trie of distinct pre-tokens.

A pre-token is a word ``[^\\x20\\x09-\\x0D]+`` behind the mark U+2581.  Its tokens
are those of its best segmentation into the pieces of a public vocabulary under
a unigram model (the piece of rank r has log probability -log(r + RANK_SHIFT),
Zipf's law over the file's order; nothing is trained); of equal scores the one
with fewer tokens counts.  A character without a piece falls back to its UTF-8
bytes, a token each.

Distinct pre-tokens are inserted in a trie.  Each node holds the forward score
of its prefix and the number of tokens of that score, both computed from its
ancestors once, when the node is made, and so shared by all pre-tokens with the
prefix; the count at a terminal node is kept for the pre-token.  A text's count
is the sum over its words.

Map-only: every worker has its own trie, of at most ``NODES`` nodes, started
anew beyond that; a lost task repeats alone.  Pre-tokens of more than ``LONG``
characters run the same recurrence over a sliding window outside the trie, so a
word of any length takes bounded memory.

Edge cases: null and empty texts and texts of white space alone have 0 words
and 0 tokens; equal rows give equal counts; null doc_ids are kept; an empty
table gives an empty result; other columns are ignored.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches
from .tokens import public_path

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"
RANK_SHIFT = 2.7
BYTE_SCORE = -16.0
NODES = 800_000
WORDS = 300_000
LONG = 128
_EPSILON = 1e-9


def unigram_scores(path: str) -> dict[str, float]:
    """Log probabilities of the text pieces of a sentencepiece file."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [i for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    total = sum(1 / (r + RANK_SHIFT) for r in range(len(plain)))
    return {sp.id_to_piece(i): -math.log((r + RANK_SHIFT) * total) for r, i in enumerate(plain)}


class TrieCounter:
    """Counts tokens of words; keeps the trie and the words' counts."""

    def __init__(self, scores: dict[str, float], nodes: int = NODES, words: int = WORDS):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        # All ends of pieces: what no piece ends with needs no longer look back.
        self.tails = {p[k:] for p in scores for k in range(len(p))}
        self.most_nodes, self.most_words = nodes, words
        self.clear()

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.best, self.count = [0.0], [0]
        self.known: dict[bytes, int] = {}

    def _state(self, word: str, i: int, best: list[float], count: list[int], first: int) -> tuple[float, int]:
        """Forward score and count of ``word[:i]`` from those of its prefixes
        (``best[k]`` is that of ``word[:first + k]``)."""
        score, tokens = -math.inf, 0
        get = self.scores.get
        tails = self.tails
        for j in range(i - 1, -1, -1):
            piece = word[j:i]
            if piece not in tails:
                break
            s = get(piece)
            if s is not None:
                s += best[j - first]
                n = count[j - first] + 1
                if s > score + _EPSILON or (s > score - _EPSILON and n < tokens):
                    score, tokens = s, n
        if word[i - 1] not in self.scores:
            n = len(word[i - 1].encode("utf-8", "surrogatepass"))
            s = best[i - 1 - first] + n * BYTE_SCORE
            if s > score + _EPSILON:
                score, tokens = s, count[i - 1 - first] + n
        return score, tokens

    def insert(self, word: str) -> int:
        """The number of tokens of a pre-token (with its mark)."""
        if len(word) > LONG:
            return self._slide(word)
        node, child, all_best, all_count = 0, self.child, self.best, self.count
        best, count = [0.0], [0]
        for i in range(1, len(word) + 1):
            key = node * 0x110000 + ord(word[i - 1])
            node = child.get(key, -1)
            if node < 0:
                node = child[key] = len(all_best)
                s, n = self._state(word, i, best, count, 0)
                all_best.append(s)
                all_count.append(n)
            best.append(all_best[node])
            count.append(all_count[node])
        return count[-1]

    def _slide(self, word: str) -> int:
        best, count, first = [0.0], [0], 0
        for i in range(1, len(word) + 1):
            s, n = self._state(word, i, best, count, first)
            best.append(s)
            count.append(n)
            if len(best) > 4 * self.longest:
                cut = len(best) - self.longest
                # Scores are compared only with each other.
                best, count, first = [x - best[-1] for x in best[cut:]], count[cut:], first + cut
        return count[-1]

    def texts(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """(words, tokens) of each text."""
        split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
        new = {w for ws in split for w in ws if w not in self.known}
        if new:
            if len(self.best) > self.most_nodes or len(self.known) > self.most_words:
                self.clear()
                new = {w for ws in split for w in ws}
            # In order, so that pre-tokens with a prefix in common follow each other.
            for w in sorted(new):
                self.known[w] = self.insert(MARK + w.decode("utf-8", "surrogatepass"))
        get = self.known.__getitem__
        return [(len(ws), sum(map(get, ws))) for ws in split]


_COUNTERS: dict[str, TrieCounter] = {}


def counter(path: str) -> TrieCounter:
    """The counter of a worker process for a vocabulary file."""
    if path not in _COUNTERS:
        _COUNTERS[path] = TrieCounter(unigram_scores(path))
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_tokens."""
    small_batches(docs.sparkSession)
    path = path or public_path(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [counter(path).texts([t.as_py()])[0] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]], names=["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, n_words long, n_tokens long")
