"""Token ids of whole texts by a public tokenizer file, with a bounded memo of
pre-tokens.

Both tokenizers cut a text into pre-tokens by a pattern and encode each alone,
so the ids of a text are those of its pre-tokens in order.  A worker encodes a
new pre-token with the tokenizers library (new plain words of a run of texts in
one call) and keeps its ids; after ``MEMO`` entries it forgets those not met
again while as many others came, so twice ``MEMO`` and a run's are held at most.
The pattern is applied here only to texts whose characters all lie in blocks
where its classes are beyond doubt; any other text, and any text that might hold
an added token, goes to the library whole.

The pre-tokens of the byte-level file lie end to end, so its texts are cut at the
class changes of their bytes, the distinct pre-tokens of a run of texts are looked
up in a memo of Arrow arrays, and the ids are laid out by Arrow.  That memo holds
``MEMO`` to twice ``MEMO`` pre-tokens of at most ``KEPT_BYTES``, those last met.
"""
from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import text_buffers

MEMO = 300_000
_LETTER = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ſ"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
UNSAFE = re.compile("[^\t\n\r\x20-\x7e\xa1-įı-ſ‐-‧€]")
# FIXED VALUES: the pre-token patterns of the two files, for those characters.
PATTERN = {
    "byte_bpe_50k.json": re.compile(f"'(?:[stmd]|re|ve|ll)| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\\s{_LETTER}{_NUMBER}]+|\\s+(?!\\S)|\\s+"),
    "word_bpe_49k.json": re.compile(f"'(?:[stmd]|re|ve|ll)|[{_LETTER}]+|[{_NUMBER}]|[^\\s{_LETTER}{_NUMBER}]+"),
}
LOWER = {"word_bpe_49k.json"}
TILED = {"byte_bpe_50k.json"}
TILED_WORD = f"^ [{_LETTER}]+$"


# Plain words: pre-tokens that come back one by one when they are joined by the
# given text; those of the tiled file when joined by nothing.
WORD = {
    "word_bpe_49k.json": (re.compile(f"[{_LETTER}]+").fullmatch, " "),
}
# New plain words that go to the library as one text (a call a word costs more
# than the word), and characters of texts that are looked up together.
JOINED = 2_000
TEXT_CHARS = 1 << 20
# The same for a run of texts that is cut as bytes.
TEXT_BYTES = 1 << 23
KEPT_BYTES = 100

_BLANK, _ALPHA, _DIGIT, _OTHER, _DOUBT = range(5)
# Class of each code point below U+2100, then of all others.
_KIND = np.array([_DOUBT if UNSAFE.match(c) else _BLANK if c.isspace() else _ALPHA if re.match(f"[{_LETTER}]", c) else _DIGIT if re.match(f"[{_NUMBER}]", c) else _OTHER
                  for c in map(chr, range(0x2100))] + [_DOUBT], dtype=np.uint8)
_BYTE_KIND = np.concatenate([_KIND[:128], np.full(128, _DOUBT, np.uint8)])


def cut_bytes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each pre-token of the byte-level pattern in UTF-8 texts that
    lie end to end, and the texts in doubt, which are left in one piece."""
    n = len(data)
    kind = _BYTE_KIND[data]
    high = np.flatnonzero(data >= 0x80)
    if len(high):
        # All bytes of a character get its class.
        lead = high[data[high] >= 0xC0]
        b0, b1, b2 = (data[np.minimum(lead + k, n - 1)].astype(np.int32) for k in range(3))
        code = np.where(b0 < 0xE0, (b0 & 0x1F) << 6 | b1 & 0x3F, (b0 & 0x0F) << 12 | (b1 & 0x3F) << 6 | b2 & 0x3F)
        code[b0 >= 0xF0] = len(_KIND) - 1
        kind[high] = np.repeat(_KIND[np.minimum(code, len(_KIND) - 1)], 2 + (b0 >= 0xE0) + (b0 >= 0xF0))
    head = np.zeros(n + 1, dtype=bool)
    head[offs[:-1]] = True
    start = head.copy()
    change = kind[1:] != kind[:-1]
    start[1:n] |= change
    # The last blank before anything else stands alone, or leads it if a space.
    word = np.flatnonzero(change & (kind[:-1] == _BLANK)) + 1
    word = word[~head[word]]
    start[word - 1] = True
    start[word] = data[word - 1] != 0x20
    # 's 't 'm 'd 're 've 'll where an apostrophe starts a pre-token.
    mark = np.flatnonzero(data == 0x27)
    mark = mark[start[mark]]
    mark = mark[(mark + 1 < n) & ~head[mark + 1]]
    a, b = data[np.minimum(mark + 1, n - 1)], data[np.minimum(mark + 2, n - 1)]
    one = np.isin(a, list(b"stmd"))
    two = ((np.isin(a, list(b"rv")) & (b == 0x65)) | ((a == 0x6C) & (b == 0x6C))) & (mark + 2 < n) & ~head[np.minimum(mark + 2, n)]
    start[mark[one | two] + 1] = False
    start[mark[one] + 2] = True
    start[mark[two] + 3] = True
    opening = np.flatnonzero(data == 0x3C)
    opening = opening[(data[np.minimum(opening + 1, n - 1)] == 0x7C) & ~head[opening + 1]]
    doubt = np.unique(np.searchsorted(offs, np.concatenate([opening, np.flatnonzero(kind == _DOUBT)]), "right") - 1)
    for k in doubt:
        start[offs[k] + 1:offs[k + 1]] = False
    return np.flatnonzero(start[:n]), doubt


class TokenEncoder:
    """ids(texts) -> little-endian unsigned 32-bit ids of each text, as bytes."""

    def __init__(self, path: str, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        name = os.path.basename(path)
        self.find = PATTERN[name].findall if name in PATTERN else None
        self.lower = name in LOWER
        self.tiled = name in TILED
        self.is_word, self.joint = WORD.get(name, (lambda p: None, ""))
        vocabulary = self.library.get_vocab()
        # Bytes that each token stands for: a character of a byte-level token is one.
        self.n_bytes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=np.int64)
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(token.removesuffix("</w>"))
        # Pre-tokens met since the memo was last full, and those met before.
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.memo = memo
        # The memo of a tiled file: pre-tokens, their ids, the run that last met them.
        self.keys, self.values = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.met, self.runs = np.zeros(0, np.int64), 0

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _new(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pre-tokens; plain words are joined and told apart by the bytes
        that their tokens stand for."""
        words, alone, found = [], [], {}
        for p in pieces:
            (words if self.is_word(p) else alone).append(p)
        runs = [words[i:i + JOINED] for i in range(0, len(words), JOINED)]
        for part, raw in zip(runs, self._whole([self.joint.join(part) for part in runs])):
            sizes = np.fromiter(map(len, map(str.encode, part)), np.int64, len(part))
            stop = np.cumsum(sizes)
            ends = np.cumsum(self.n_bytes[np.frombuffer(raw, "<u4")])
            last = np.searchsorted(ends, stop)
            if len(ends) and ends[-1] == stop[-1] and (ends[last] == stop).all():
                at = [0, *((last + 1) * 4).tolist()]
                found.update(zip(part, [raw[x:y] for x, y in zip(at, at[1:])]))
            else:
                alone += part
        found.update(zip(alone, self._whole(alone)))
        return found

    def ids(self, texts: list[str | None]) -> list[bytes]:
        if self.tiled:
            return list(self._tiled(pa.array(texts, pa.large_string())))
        whole: dict[int, bytes] = {}
        parts: list[str] = []
        stops = []
        for k, text in enumerate(texts):
            text = text or ""
            if self.find is None or "<|" in text or UNSAFE.search(text):
                whole[k] = self._whole([text])[0]
            else:
                parts += self.find(text.lower() if self.lower else text)
            stops.append(len(parts))
        got = list(map(self.known.get, parts))
        missing = [i for i, raw in enumerate(got) if raw is None]
        if missing:
            new = {parts[i] for i in missing}
            again = new & self.old.keys()
            self.known.update(self._new(list(new - again)))
            self.known.update(zip(again, map(self.old.__getitem__, again)))
            for i in missing:
                got[i] = self.known[parts[i]]
        if len(self.known) > self.memo:
            self.old, self.known = self.known, {}
        return [whole[k] if k in whole else b"".join(got[x:y]) for k, (x, y) in enumerate(zip([0, *stops], stops))]

    def _new_words(self, words: pa.Array) -> list[pa.Array]:
        """Ids of plain words of a tiled file, joined as in ``_new``."""
        _, offs, data = words.buffers()
        offs = np.frombuffer(offs, np.int64)[words.offset:words.offset + len(words) + 1]
        out = []
        for i in range(0, len(words), JOINED):
            cut = offs[i:i + JOINED + 1]
            raw = self._whole([str(memoryview(data)[cut[0]:cut[-1]], "utf-8")])[0]
            stop = cut[1:] - cut[0]
            ends = np.cumsum(self.n_bytes[np.frombuffer(raw, "<u4")])
            last = np.searchsorted(ends, stop)
            if len(ends) and ends[-1] == stop[-1] and (ends[last] == stop).all():
                at = np.concatenate([[0], (last + 1) * 4])
                out.append(pa.Array.from_buffers(pa.large_binary(), len(stop), [None, pa.py_buffer(at), pa.py_buffer(raw)]))
            else:
                alone = [str(memoryview(data)[x:y], "utf-8") for x, y in zip(cut.tolist(), cut[1:].tolist())]
                out.append(pa.array(self._whole(alone), pa.large_binary()))
        return out

    def _new_pieces(self, pieces: pa.Array) -> pa.Array:
        """Ids of pre-tokens of a tiled file."""
        plain = pc.match_substring_regex(pieces, TILED_WORD).to_numpy(zero_copy_only=False)
        words = self._new_words(pieces.filter(pa.array(plain))) if plain.any() else []
        # Others by few at once, as an encoding takes far more than its text.
        rest, other = [], pieces.filter(pa.array(~plain)).to_pylist()
        size, x = 0, 0
        for y, piece in enumerate(other, 1):
            size += len(piece)
            if size >= TEXT_CHARS or y - x >= JOINED or y == len(other):
                rest += self._whole(other[x:y])
                size, x = 0, y
        order = np.empty(len(plain), np.int64)
        order[np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])] = np.arange(len(plain))
        return pa.concat_arrays([*words, pa.array(rest, pa.large_binary())]).take(pa.array(order))

    def _look_up(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pre-tokens of a tiled file, from the memo or anew."""
        self.runs += 1
        at = pc.index_in(pieces, value_set=self.keys)
        keys = pieces.filter(at.is_null())
        values = pa.concat_arrays([self.values, self._new_pieces(keys)]) if len(keys) else self.values
        at = at.fill_null(-1).to_numpy().astype(np.int64)
        at[at < 0] = len(self.keys) + np.arange(len(keys))
        met = np.concatenate([self.met, np.zeros(len(keys), np.int64)])
        met[at] = self.runs
        got = values.take(pa.array(at))
        short = pc.less_equal(pc.binary_length(keys), KEPT_BYTES).to_numpy(zero_copy_only=False)
        kept = np.concatenate([np.ones(len(self.keys), bool), short])
        if kept.sum() > 2 * self.memo:
            # Those last met stay.
            last = np.flatnonzero(kept)
            kept[last[np.argsort(-met[last], kind="stable")[self.memo:]]] = False
        if len(keys):
            self.keys = pa.concat_arrays([self.keys, keys])
        if not kept.all():
            some = pa.array(kept)
            self.keys, values, met = self.keys.filter(some), values.filter(some), met[kept]
        self.values, self.met = values, met
        return got

    def _tiled(self, texts) -> Iterator[bytes]:
        data, offs = text_buffers(texts)
        x = 0
        while x < len(offs) - 1:
            y = max(x + 1, int(np.searchsorted(offs, offs[x] + TEXT_BYTES, "right")) - 1)
            yield from self._run(data[offs[x]:offs[y]], offs[x:y + 1] - offs[x])
            x = y

    def _run(self, data: np.ndarray, offs: np.ndarray) -> list[bytes]:
        """Ids of UTF-8 texts that lie end to end."""
        if not len(data):
            return [b""] * (len(offs) - 1)
        starts, doubt = cut_bytes(data, offs)
        bounds = np.append(starts, len(data))
        coded = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        taken = self._look_up(coded.dictionary).take(coded.indices)
        _, stops, ids = taken.buffers()
        at = np.frombuffer(stops, np.int64)[np.searchsorted(starts, offs)].tolist()
        ids = memoryview(ids or b"")
        return [bytes(ids[a:b]) for a, b in zip(at, at[1:])]

    def column(self, texts) -> Iterator[bytes]:
        """Ids of each text of an Arrow column, looked up by runs of texts."""
        if self.tiled:
            yield from self._tiled(texts)
            return
        run: list[str] = []
        size = 0
        for text in texts:
            run.append(text.as_py() or "")
            size += len(run[-1])
            if size >= TEXT_CHARS:
                yield from self.ids(run)
                run, size = [], 0
        yield from self.ids(run)


_ENCODERS: dict[str, TokenEncoder] = {}


def encoder(path: str) -> TokenEncoder:
    """The encoder of a worker process for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TokenEncoder(path)
    return _ENCODERS[path]


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at least ``size`` bytes, but for the last."""
    held: list[pa.RecordBatch] = []
    room = size
    for b in batches:
        held.append(b)
        room -= b.nbytes
        if room <= 0:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, room = [], size
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def public_path(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path(name)
