"""Merge-type (BPE) encoding and decoding of SentencePiece models.

A word's encoding is found without simulating merges: longest matches of an Aho-Corasick automaton are laid end to end,
a pair of neighbours must survive being merged anew, and positions from which no encoding goes on are marked in a
bitfield, so that no position is tried in vain twice.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import inf
from operator import add

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, per_batch, released

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Where no piece holds a line's end, words end there too.
LINE_WORDS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n+")


class Recent(dict):
    """Keeps what make gave for the keys used last, texts only up to a size: at most twice most of them."""

    def __init__(self, make: Callable, most: int, size: int | None = None) -> None:
        self.make, self.most, self.size, self.old = make, most, size, {}

    def __missing__(self, key: str | bytes | int) -> object:
        got = self.old.get(key, self)
        if got is self:
            got = self.make(key)
        if self.size is None or len(key) <= self.size:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = got
        return got

    def forget(self) -> None:
        self.clear()
        self.old = {}


def _fields(b: bytes) -> Iterator[tuple[int, object]]:
    """Fields of a protocol buffer message."""
    i = 0

    def number() -> int:
        nonlocal i
        n = shift = 0
        while True:
            n |= (b[i] & 127) << shift
            i += 1
            if b[i - 1] < 128:
                return n
            shift += 7

    while i < len(b):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(kind) or number()
            yield key >> 3, b[i : i + size]
            i += size


class Pieces:
    """A model's pieces, its encoding and decoding. model: the bytes of a .model file of merge type with byte fallback and no text normalisation."""

    def __init__(self, model: bytes, word_cache: int = 150_000, pair_cache: int = 200_000) -> None:
        self.pieces: list[str] = []
        self.kinds: list[int] = []
        scores: list[float] = []
        self.dummy_prefix = True
        for field, value in _fields(model):
            if field == 1:
                x = dict(_fields(value))
                self.pieces.append(x[1].decode())
                scores.append(struct.unpack("<f", x[2])[0] if 2 in x else 0.0)
                self.kinds.append(x.get(3, NORMAL))
            elif field == 2 and dict(_fields(value)).get(3, 1) != 2:
                raise ValueError("the model isn't of merge type")
            elif field == 3:
                x = dict(_fields(value))
                self.dummy_prefix = bool(x.get(3, 1))
                if x.get(2) or x.get(4, 1) or not x.get(5, 1):
                    raise ValueError("the model rewrites texts in a way that isn't supported")
        if set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("the model has pieces of a kind that isn't supported")
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == NORMAL}
        self.known = frozenset(p for p in self.ids if len(p) == 1)
        self.cost = {p: -scores[i] for p, i in self.ids.items()}
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte fallback")
        self.names = [str(i) for i in range(len(self.pieces))]
        self.bytes = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else b" \xe2\x81\x87 " if k == UNKNOWN else p.replace(SPACE, " ").encode() for p, k in zip(self.pieces, self.kinds, strict=True)]
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.longest = max(map(len, self.ids), default=0)
        self.pairs = Recent(self.together, pair_cache)
        self.own = Recent(lambda t: self.merged(self.pieces[t]) == [self.pieces[t]], len(self.pieces))  # whether merging makes a piece of its characters
        self.shorter = Recent(self.prefix, len(self.pieces))
        # no merge crosses two characters that no piece has side by side
        self.inside = frozenset(a + b for p in self.ids for a, b in zip(p, p[1:], strict=False))
        self.words = Recent(self.coded, word_cache, 48)
        self.parts = Recent(lambda w: self.told(self.encode_word(w)), word_cache // 2, 48)
        self.cut = WORDS if any("\n" in p for p in self.ids) else LINE_WORDS

    def merged(self, s: str, border: int = 0) -> list[str]:
        """The pieces that merging leaves of a short string: the best score first, then the leftmost pair. Nothing, once a merge crosses the border, a number of characters."""
        parts = list(s)
        cost, none = self.cost.get, inf
        costs = [cost(a + b, none) for a, b in zip(parts, parts[1:], strict=False)]
        while costs:
            best = min(costs)
            if best == none:
                break
            i = costs.index(best)
            if i < border:
                border -= 1
                if i == border:
                    return []
            one = parts[i] = parts[i] + parts.pop(i + 1)
            del costs[i]
            if i < len(costs):
                costs[i] = cost(one + parts[i + 1], none)
            if i:
                costs[i - 1] = cost(parts[i - 1] + one, none)
        return parts

    def together(self, key: int) -> bool:
        """Whether two pieces, the first times 2^32 plus the second, stay side by side when their characters are merged anew."""
        a, b = self.pieces[key >> 32], self.pieces[key & 0xFFFFFFFF]
        return self.merged(a + b, len(a)) == [a, b]

    def prefix(self, t: int) -> tuple[int, int] | None:
        """The longest piece that begins piece t and is shorter, with its length."""
        p = self.pieces[t]
        return next(((n, self.ids[p[:n]]) for n in range(len(p) - 1, 0, -1) if p[:n] in self.ids), None)

    def backtrack(self, s: str) -> list[int]:
        """The encoding of a string of known characters."""
        n, far = len(s), self.longest
        match, alone, pairs, shorter = self.automaton.iter_long, self.own, self.pairs, self.shorter
        # one pass lays longest matches; every known character is a piece, so they leave no gap
        out: list[int] = []
        at: list[int] = []  # where each piece of out starts
        pos, last = 0, None
        for _, (size, t) in match(s):
            if not alone[t] or last is not None and not pairs[last << 32 | t]:
                break
            out.append(t)
            at.append(pos)
            pos += size
            last = t
        else:
            return out
        m = size, t
        alive = (1 << (n + 1)) - 1  # bit p: an encoding may still go on from p
        while pos < n:
            while m is not None:
                size, t = m
                if alive >> (pos + size) & 1 and alone[t] and (not out or pairs[out[-1] << 32 | t]):
                    break
                m = shorter[t]
            if m is None:
                alive &= ~(1 << pos)
                m = shorter[out.pop()]
                pos = at.pop()
            else:
                out.append(t)
                at.append(pos)
                pos += size
                if pos < n:
                    m = next(match(s[pos : pos + far]))[1]
        return out

    def encode_word(self, word: str) -> list[int]:
        """Characters that the model doesn't know become bytes and end a merge's reach."""
        if self.known.issuperset(word):
            return self.backtrack(word)
        out: list[int] = []
        known = ""
        for c in word:
            if c in self.ids:
                known += c
                continue
            if known:
                out += self.backtrack(known)
                known = ""
            out += [self.byte_ids[x] for x in c.encode()]
        return out + (self.backtrack(known) if known else [])

    def told(self, ids: list[int]) -> tuple[str, bytes]:
        """Ids as text, and what they decode to."""
        return ",".join(map(self.names.__getitem__, ids)), b"".join(map(self.bytes.__getitem__, ids))

    def word_told(self, word: str) -> tuple[str, bytes]:
        """A word's ids as text and what they decode to, put together from its parts that merges don't cross."""
        if self.inside.issuperset(map(add, word, word[1:])):
            return self.told(self.encode_word(word))
        out, start = [], 0
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in self.inside:
                out.append(self.parts[word[start:i]])
                start = i
        out.append(self.parts[word[start:]])
        return ",".join([x for x, _ in out]), b"".join([x for _, x in out])

    def forget(self) -> None:
        """Frees what is kept of words and pieces."""
        for kept in (self.words, self.parts, self.pairs, self.own, self.shorter):
            kept.forget()

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        return self.cut.findall((SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE))

    def encode(self, text: str) -> list[int]:
        return [i for w in self.split(text) for i in self.encode_word(w)]

    def coded(self, word: str) -> str | tuple[str, bytes]:
        """A word's ids as text; with what they decode to, where that isn't the word itself."""
        ids, back = self.word_told(word)
        return ids if back == word.replace(SPACE, " ").encode() else (ids, back)

    def joined(self, parts: list[bytes], first: str) -> str:
        """The text of ids' parts, the first id as text. Bytes that aren't UTF-8 become U+FFFD."""
        out = b"".join(parts)
        if self.dummy_prefix and out[:1] == b" " and first and self.kinds[int(first.split(",", 1)[0])] == NORMAL:
            out = out[1:]
        return out.decode("utf-8", "replace")

    def both(self, text: str) -> tuple[str, str]:
        """A text's ids as text, and what they decode to."""
        words = self.split(text)
        got = list(map(self.words.__getitem__, words))
        try:
            ids, parts = ",".join(got), ["".join(words).replace(SPACE, " ").encode()]  # each word decodes to itself
        except TypeError:
            ids = ",".join(x if isinstance(x, str) else x[0] for x in got)
            parts = [w.replace(SPACE, " ").encode() if isinstance(x, str) else x[1] for w, x in zip(words, got, strict=True)]
        return ids, self.joined(parts, ids)

    def decode(self, ids: list[int]) -> str:
        text, back = self.told(ids)
        return self.joined([back], text)


@lru_cache(1)
def loaded(model: bytes) -> Pieces:
    """One for all tasks of a Python worker."""
    return Pieces(model)


OUT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
DIGESTS = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def model_bytes(path: str, most: int = 64 << 20) -> bytes:
    """The driver reads the model and sends it to the executors, which need no such file; its size is checked."""
    with open(path, "rb") as f:
        got = f.read(most + 1)
    if len(got) > most:
        raise ValueError(f"{path} is larger than {most} bytes")
    return got


def encode_texts(docs: DataFrame, model: bytes, digests: bool = False) -> DataFrame:
    """doc_id with the ids of each whole text and the text that they decode to (or digests of both).

    Null texts count as empty: no ids, an empty text. Repeated rows stay; other columns are left out. No shuffle: each
    batch is encoded where it is read, and each distinct short word of a task once.
    """
    batches_of(docs.sparkSession)

    def encode(ids: list[int], texts: list[str | None]) -> list:
        p = loaded(model)
        n, enc, dec = [], [], []
        for t in texts:
            s, d = p.both(t or "")
            n.append(s.count(",") + 1 if s else 0)
            enc.append(hashlib.sha256(s.encode()).hexdigest() if digests else np.fromstring(s, np.int32, sep=","))
            dec.append(hashlib.sha256(d.encode()).hexdigest() if digests else d)
        if not digests:  # lists without a Python number for each id
            enc = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, enc)]), pa.int32()), pa.array(np.concatenate([*enc, np.zeros(0, np.int32)])))
        return [ids, n, enc, dec]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from per_batch(encode, schema, ["doc_id", "text"])(it)
        finally:
            loaded.cache_clear()  # a worker's memory is for the next task
            released()

    schema = DIGESTS if digests else OUT
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "doc_id long, n_tokens long, ids array<int>, decoded string")
