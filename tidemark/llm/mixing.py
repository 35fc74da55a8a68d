"""Language-model scoring by online logistic mixing of context bit predictors with exact counts.

A text is read as bytes, closed by one 0xFF (which UTF-8 never has), and cut into units: a word with the one white-space
byte, or the end, behind it, headed by a byte that tells how the unit before ended. Bits are predicted in contexts within
a unit, so a text's probability is the product over its units, and each distinct unit of the corpus is scored once.

Counts are kept by context, not in tables of a fixed size. Distinct units are dealt out by ranges into parts: a context of
the whole unit so far is then known to one part alone, but where it begins the part's first or last unit. Those, and the
contexts of the last bytes, are added up by key over all parts, and each part gets what it asked for.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ASCII_UPPER, batches_of, cut, rows_out, shared_folder, tidy

UNIT = re.compile(rb"[^\x20\x09-\x0D\xff]*[\x20\x09-\x0D\xff]")
END = b"\xff"
#: Contexts of a bit: the 1, 2, 3, 4 bytes before its byte, and the whole unit so far.
ORDERS = (1, 2, 3, 4)
N = len(ORDERS) + 1
BUCKETS = 33
#: From these counts on a context counts as better known.
LEVELS = (0.5, 1.5, 3.5, 30)


@dataclass(frozen=True)
class Setting:
    """bits: of each context's keys (the last: of all further ones). The mixer moves by rate after each batch of units; sample, if any, has only about so many units tune it, chosen by hash. A part has per_part units."""

    bits: tuple[int, ...] = (64,)
    sample: int | None = None
    batch: int = 64
    rate: float = 0.1
    per_part: int = 100_000


class Kinds(dict):
    """One byte for how a unit ended: its white space, and the kind of the byte before."""

    def __missing__(self, unit: bytes) -> bytes:
        if len(self) > 400_000:
            self.clear()
        x = unit[-2] if len(unit) > 1 else 32
        kind = 0 if x <= 32 else 1 if 97 <= x <= 122 or x >= 128 else 2 if 65 <= x <= 90 else 3 if x in b".!?" else 4
        got = self[unit] = bytes([kind * 2 + (unit[-1:] != b" ")])
        return got


KINDS = Kinds()


def units(text: str | None) -> list[bytes]:
    """A text's units, each after the byte for its predecessor's end (a text's first: 10)."""
    u = UNIT.findall((text or "").encode() + END)
    return list(map(add, [b"\x0a", *map(KINDS.__getitem__, u[:-1])], u))


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def squash(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def firsts(us: list[bytes], most: int = 32) -> np.ndarray:
    """For each byte of units in their order, the place (in all bytes) of the first one that ends the same beginning of units that follow each other: their bits are the same events. Sought in units' first bytes, so many."""
    raw = np.frombuffer(b"".join(us), np.uint8)
    sizes = np.fromiter(map(len, us), np.int64, len(us))
    starts = np.cumsum(sizes) - sizes
    out = np.arange(len(raw))
    same = np.arange(1, len(us))
    for p in range(most):
        same = same[np.minimum(sizes[same], sizes[same - 1]) > p]
        same = same[raw[starts[same] + p] == raw[starts[same - 1] + p]]
        if not len(same):
            break
        new = np.append(True, np.diff(same) != 1)
        out[starts[same] + p] = starts[(same[new] - 1)[np.cumsum(new) - 1]] + p
    return out


def coded(us: list[bytes], headed: bool = True, first: np.ndarray | None = None) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """For each byte of each unit (headed: but its first; with firsts: each that is its own first): the unit's number, the keys of its contexts, the byte."""
    raw = np.frombuffer(b"".join(us), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, us), np.int64, len(us))
    starts = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(us)), sizes)
    place = np.arange(len(raw)) - np.repeat(starts, sizes)
    power = np.cumprod(np.full(int(sizes.max(initial=1)) + 1, 0x100000001B3, np.uint64))
    term = (raw + np.uint64(1)) * power[place]
    before = np.cumsum(term) - term
    keep = np.flatnonzero(place >= headed if first is None else (place >= headed) & (first == np.arange(len(raw))))
    of, place = of[keep], place[keep]
    contexts = []
    for o in ORDERS:
        h = np.full(len(keep), o, np.uint64)
        for back in range(1, o + 1):
            h = h * np.uint64(0x2545F4914F6CDD1D) + np.where(place >= back, raw[np.maximum(keep - back, 0)] + np.uint64(1), 0).astype(np.uint64)
        contexts.append(mix64(h))
    prefix = before[keep] - before[starts][of]
    contexts.append(mix64(prefix * np.uint64(0x2545F4914F6CDD1D) + np.uint64(99)))
    return of, contexts, raw[keep].astype(np.int64)


class Units(list):
    """Units, and what is worked out once for all that read them: bytes of common beginnings of units that follow each other count as one."""

    @cached_property
    def sizes(self) -> np.ndarray:
        return np.fromiter(map(len, self), np.int64, len(self))

    @cached_property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    @cached_property
    def first(self) -> np.ndarray:
        return firsts(self)

    @cached_property
    def coded(self) -> tuple[list[np.ndarray], np.ndarray]:
        """The keys of contexts and the byte, of each byte that is its own first and no head."""
        _, contexts, sym = coded(self, True, self.first)
        return contexts, sym

    @cached_property
    def event(self) -> np.ndarray:
        """For each byte its number in coded; -1 for heads."""
        own = self.first == np.arange(len(self.first))
        own[self.starts] = False
        out = (np.cumsum(own, dtype=np.int32) - np.int32(1))[self.first]
        out[self.starts] = -1
        return out


def units_of(us: list[bytes]) -> Units:
    return us if isinstance(us, Units) else Units(us)


def under(key: np.ndarray, sym: np.ndarray) -> np.ndarray:
    """A key for a byte in a context."""
    return mix64(key + (sym.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))


def by_key(key: np.ndarray, sym: np.ndarray) -> np.ndarray:
    """The order by key and byte."""
    top = key >> np.uint64(8)
    o = np.argsort(top << np.uint64(8) | sym.astype(np.uint64))
    if np.any((top[o[1:]] == top[o[:-1]]) & (key[o[1:]] != key[o[:-1]])):  # keys that differ in their last byte only
        return np.lexsort((sym, key))
    return o


def leveled(n: np.ndarray) -> np.ndarray:
    out = np.zeros(len(n), np.int8)
    for x in LEVELS:
        out += n >= x
    return out


class Known:
    """Exact counts of the bits of the bytes in each context, from rows of a context's key, a byte and its count."""

    def __init__(self, key: np.ndarray, sym: np.ndarray, n: np.ndarray) -> None:
        o = by_key(key, sym)
        key, sym, n = key[o], sym[o], n[o].astype(np.float64)
        slots, counts, base = np.empty((len(key), 8), np.int32), [], 0
        other = np.ones(len(key), bool)
        other[1:] = key[1:] != key[:-1]
        for b in range(8):
            node, bit = sym >> (8 - b), sym >> (7 - b) & 1
            new = other.copy()
            new[1:] |= node[1:] != node[:-1]
            g = np.cumsum(new) - 1
            counts.append(np.stack([np.bincount(g, n * (1 - bit)), np.bincount(g, n * bit)], axis=1).astype(np.float32))
            slots[:, b] = base + g
            base += len(counts[-1])
        self.counts = np.concatenate(counts)
        find = under(key, sym)
        o = np.argsort(find)
        self.find, self.slots, self.bits = find[o], slots[o], (sym[o, None] >> np.arange(7, -1, -1) & 1).astype(np.int8)
        # keys are even hashes: their first bits tell nearly where a key stands
        self.shift = np.uint64(64 - max(1, len(find).bit_length()))
        self.near = np.searchsorted(self.find, np.arange(1 << int(64 - self.shift), dtype=np.uint64) << self.shift)

    def at(self, key: np.ndarray, sym: np.ndarray) -> np.ndarray:
        return self.slots[self.row(key, sym)].ravel()

    def row(self, key: np.ndarray, sym: np.ndarray) -> np.ndarray:
        """The row in slots and bits of each byte in its context."""
        want = under(key, sym)
        place = self.near[want >> self.shift]
        off = np.flatnonzero(self.find[place] != want)
        while len(off):
            place[off] += 1
            off = off[self.find[place[off]] != want[off]]
        return place

    def without(self) -> tuple[np.ndarray, np.ndarray]:
        """By slot and bit, two each: the stretched prediction and the level without that one bit's own count."""
        told = np.empty((len(self.counts), 2), np.float32)
        level = np.empty((len(self.counts), 2), np.int8)
        for bit in range(2):
            c = self.counts.copy()
            c[:, bit] = np.maximum(0, c[:, bit] - 1)
            told[:, bit] = np.log((c[:, 1] + np.float32(0.2)) / (c[:, 0] + np.float32(0.2)))
            level[:, bit] = leveled(c[:, 0] + c[:, 1])
        return told.ravel(), level.ravel()


def events(us: list[bytes], places: Known | tuple[int, ...], headed: bool = False) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, np.ndarray]:
    """For each bit of each unit's bytes: the unit's number, the slots (of each context), the node within the byte, the bit. Slots are the places of known contexts, or keys of so many bits."""
    of, contexts, sym = coded(us, headed)
    nodes = np.empty((len(sym), 8), np.int32)
    bit = np.empty((len(sym), 8), np.int8)
    for b in range(8):
        nodes[:, b] = (sym >> (8 - b)) | (1 << b)
        bit[:, b] = (sym >> (7 - b)) & 1
    if isinstance(places, Known):
        slots = [places.at(h, sym) for h in contexts]
    else:
        slots = [(under(h[:, None], nodes) >> np.uint64(64 - places[min(k, len(places) - 1)])).ravel() for k, h in enumerate(contexts)]
    return np.repeat(of, 8), slots, nodes.ravel(), bit.ravel()


#: By byte, the nodes of its eight bits and the bits.
NODES = (np.arange(256)[:, None] | 256) >> np.arange(8, 0, -1)
BITS = (np.arange(256)[:, None] >> np.arange(7, -1, -1) & 1).astype(np.int8)

Ready = tuple[list[np.ndarray], np.ndarray]


def predictors(counts: list[np.ndarray]) -> Ready:
    """Each context's stretched predictions, 0 for slots without counts, and how well the last context's slots are known."""
    told = [np.log((c[:, 1] + np.float32(0.2)) / (c[:, 0] + np.float32(0.2))) for c in counts]
    return told, leveled(counts[-1].sum(1))


class Model:
    """Predictions by context and slot, the mixer's weights by gate, and the refining table."""

    def __init__(self, ready: Ready, setting: Setting, weights: np.ndarray | None = None, refined: np.ndarray | None = None) -> None:
        self.ready, self.setting = ready, setting
        self.weights = np.full(((len(LEVELS) + 1) * (N + 1), N + 1), 0.3, np.float32) if weights is None else weights
        self.refined = np.tile(squash((np.arange(BUCKETS) - BUCKETS // 2) / 2.0), (256, 1)).astype(np.float32) if refined is None else refined

    def inputs(self, slots: list[np.ndarray], bit: np.ndarray, without: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Stretched predictions, by context, and the gate; with Known.without, each bit's own count is left out."""
        x = np.empty((N + 1, len(bit)), np.float32)
        x[N] = 0.3
        known = np.zeros(len(bit), np.int64)
        for k in range(N):
            at = slots[k] if without is None else slots[k] * 2 + bit
            x[k] = (self.ready[0][k] if without is None else without[0])[at]
            known += x[k] != 0
        return x, known * (len(LEVELS) + 1) + (self.ready[1] if without is None else without[1])[at]

    def seen(self, rows: list[np.ndarray], told: np.ndarray) -> np.ndarray:
        """Stretched predictions, by context, of bytes with these rows of known; a row has those of eight bits, so that a byte's are found at once."""
        x = np.empty((N + 1, 8 * len(rows[0])), np.float32)
        x[N] = 0.3
        for k, at in enumerate(rows):
            np.take(told, at, axis=0, out=x[k].reshape(-1, 8), mode="clip")
        return x

    def gates(self, rows: list[np.ndarray], told: np.ndarray, level: np.ndarray) -> np.ndarray:
        """The gate of each byte's eight bits."""
        tells, out = told != 0, np.zeros((len(rows[0]), 8), np.int8)
        for at in rows:
            out += np.take(tells, at, axis=0)
        return out * np.int8(len(LEVELS) + 1) + np.take(level, rows[-1], axis=0)

    def mixed(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        z = np.zeros(len(gate), np.float32)
        for k, w in enumerate(np.ascontiguousarray(self.weights.T)):
            z += x[k] * w[gate]
        return np.clip(z, -8, 8)

    def refining(self, s: np.ndarray, node: np.ndarray) -> np.ndarray:
        """The mix of a prediction with what the refining table says."""
        y = np.clip((s * 2) + BUCKETS // 2, 0, BUCKETS - 1.001)
        low = y.astype(np.int64)
        part = y - low
        r = self.refined[node, low] * (1 - part) + self.refined[node, low + 1] * part
        return np.clip(0.5 * squash(s) + 0.5 * r, 2.0**-20, 1 - 2.0**-20)

    def learn(self, us: list[bytes], weight: np.ndarray, known: Known) -> list[np.ndarray]:
        """For units whose weight is not 0, predict batches' bits without their own count and move the weights; what there is to add up over parts: by gate the bits and the weights times these, by cell of the refining table the bits and their ones."""
        s = self.setting
        size = 256 * BUCKETS
        told = [np.zeros(len(self.weights)), np.zeros(self.weights.shape), np.zeros(size), np.zeros(size)]
        at = known.slots * 2 + known.bits
        without, level = (x[at] for x in known.without())
        us = units_of(us)
        contexts, sym = us.coded
        rows = [known.row(h, sym) for h in contexts]  # sought once for all units that share a beginning
        gates = self.gates(rows, without, level)
        event, starts, sizes = us.event, us.starts, us.sizes
        order = np.flatnonzero(weight)[np.random.default_rng(0).permutation(np.count_nonzero(weight))]
        times = max(1, -(-200 * s.batch // max(1, len(order))))  # a part of few units goes round
        for _ in range(times):
            for i in range(0, len(order), 32 * s.batch):
                at = order[i : i + 32 * s.batch]
                lengths = sizes[at] - 1  # heads are not predicted
                of = np.repeat(np.arange(len(at)), lengths)
                mine = event[np.arange(len(of)) + np.repeat(starts[at] + 1 - np.cumsum(lengths) + lengths, lengths)]
                gate_ = np.take(gates, mine, axis=0).ravel()
                # a batch's bits by gate, so that a gate's are summed as one run
                o = np.argsort(np.repeat((of // s.batch).astype(np.int16) << 8, 8) | gate_, kind="stable")
                x_ = np.take(self.seen([r[mine] for r in rows], without), o, axis=1)
                gate_, w_ = gate_[o].astype(np.int64), weight[at][of][o >> 3]
                bit_, cell_ = (np.take(x, sym[mine], axis=0).ravel()[o] for x in (BITS, NODES))
                light, z_ = w_.astype(np.float32), np.empty(len(w_), np.float32)
                ends = 8 * np.searchsorted(of, np.arange(0, len(at) + s.batch, s.batch))
                for lo, hi in zip(ends, ends[1:], strict=False):
                    if lo == hi:
                        continue
                    x, gate, w = x_[:, lo:hi], gate_[lo:hi], w_[lo:hi]
                    z = z_[lo:hi] = self.mixed(x, gate)
                    err = (bit_[lo:hi] - squash(z)) * light[lo:hi]
                    runs = np.flatnonzero(np.append(True, gate[1:] != gate[:-1]))
                    here, mass = gate[runs], np.add.reduceat(w, runs)
                    # a gate moves by its bits' mean error
                    self.weights[here] += (s.rate * np.add.reduceat(err * x, runs, axis=1) / (mass + 1e-9)).T.astype(np.float32)
                    told[0][here] += mass
                    told[1][here] += mass[:, None] * self.weights[here]
                y = np.clip((z_ * 2) + BUCKETS // 2, 0, BUCKETS - 1.001)
                cell = cell_ * BUCKETS + np.ceil(y - 0.5).astype(np.int64)
                told[2] += np.bincount(cell, w_, size)
                told[3] += np.bincount(cell, w_ * bit_, size)
        return [x / times for x in told]

    def merged(self, told: list[np.ndarray]) -> None:
        """Takes the weights' means and the refining table's shares of what all parts learned."""
        mass, weights, n, ones = told
        self.weights = np.where(mass[:, None] > 0, weights / np.maximum(mass, 1e-9)[:, None], self.weights).astype(np.float32)
        prior = 50.0
        self.refined = np.clip((ones.reshape(256, -1) + prior * self.refined) / (n.reshape(256, -1) + prior), 1e-6, 1 - 1e-6).astype(np.float32)

    def log10(self, us: list[bytes], known: Known) -> np.ndarray:
        """log10 of each unit's probability. Units in their order share the bits of their common beginnings, which are predicted once."""
        us = units_of(us)
        told, level = self.ready[0][-1][known.slots], self.ready[1][known.slots]
        contexts, sym = us.coded
        each = np.zeros(len(sym) + 1)  # the last: heads, which are not predicted
        for i in range(0, len(sym), 16_384):
            some = sym[i : i + 16_384]
            rows = [known.row(h[i : i + 16_384], some) for h in contexts]
            gate = self.gates(rows, told, level).ravel().astype(np.int64)
            p = self.refining(self.mixed(self.seen(rows, told), gate), NODES[some].ravel())
            each[i : i + len(some)] = np.log10(np.where(BITS[some].ravel() == 1, p, 1 - p)).reshape(-1, 8).sum(1, dtype=np.float64)
        return np.bincount(np.repeat(np.arange(len(us)), us.sizes), each[us.event], len(us))


TOLD = pa.schema([("chunk", pa.int64()), ("place", pa.int32()), ("unit", pa.binary()), ("n", pa.int64()), ("doc_id", pa.int64()), ("train", pa.bool_()), ("places", pa.binary())])


#: Of the byte before a unit's last, what Kinds tells.
KIND = np.array([KINDS[bytes([x, 32])][0] for x in range(256)], np.uint8)


def split(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """How many units each text has; all units, each after the byte for its predecessor's end, as places in a list of the distinct ones, in order of first sight; that list."""
    data = np.frombuffer(END.join([*texts, b""]), np.uint8)
    ends = np.flatnonzero((data - np.uint8(9) < 5) | (data == 32) | (data == 255)) + 1
    starts = np.append(0, ends[:-1])
    last = data[ends - 1]
    heads = np.full(len(ends), 10, np.uint8)  # a text's first unit
    kinds = KIND[np.where(ends - starts == 1, 32, data[ends - 2])] + (last != 32)
    heads[1:] = np.where(last[:-1] == 255, 10, kinds[:-1])
    starts += np.arange(len(starts))
    headed, body = np.empty(len(data) + len(heads), np.uint8), np.ones(len(data) + len(heads), bool)
    body[starts] = False
    headed[body], headed[starts] = data, heads
    offsets = pa.py_buffer(np.append(starts, len(headed)))
    every = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, offsets, pa.py_buffer(headed)]).dictionary_encode()
    return np.diff(np.flatnonzero(last == 255), prepend=-1), every.indices.to_numpy(), every.dictionary


PACKER = pa.Codec("zstd", 1)


def packed(places: np.ndarray) -> bytes:
    """Places as bytes: how many there are, then their first, second, third and fourth bytes, compressed."""
    return len(places).to_bytes(8, "little") + PACKER.compress(places.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T.tobytes(), asbytes=True)


def unpacked(x: bytes) -> np.ndarray:
    n = int.from_bytes(x[:8], "little")
    return np.ascontiguousarray(np.frombuffer(PACKER.decompress(x[8:], 4 * n, asbytes=True), np.uint8).reshape(4, n).T).view("<u4").ravel()


def _joined(it: Iterator[pa.RecordBatch], size: int = 6 << 20) -> Iterator[pa.RecordBatch]:
    """Batches put together up to so many bytes, or one that has more."""
    held: list[pa.RecordBatch] = []
    for b in it:
        held.append(b)
        if sum(x.nbytes for x in held) >= size or len(held) == 100:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def _chunks(it: Iterator[pa.RecordBatch], most: int = 600_000, size: int = 32 << 20) -> Iterator[pa.RecordBatch]:
    """A partition's texts as packed places of their units, and after each chunk of texts its units with how often training texts have them; those that only held-out texts have count 0. A chunk ends at so many units or bytes of text, looked at every 200 texts."""
    task = TaskContext.get()
    chunk, held = (task.partitionId() if task else 0) << 32, 0
    names, counts = pa.array([], pa.large_binary()), np.zeros(0, np.int64)

    def close() -> Iterator[pa.RecordBatch]:
        for i in range(0, len(names), 20_000):
            us = names.slice(i, 20_000).cast(pa.binary())
            k = len(us)
            yield rows_out(TOLD, [pa.array(np.full(k, chunk)), pa.array(np.arange(i, i + k, dtype=np.int32)), us, pa.array(counts[i : i + k]), *(pa.nulls(k, f.type) for f in list(TOLD)[4:])])

    for b in _joined(it):
        while b.num_rows:
            texts = pc.fill_null(b.column(1).cast(pa.binary()), b"")
            each, found, mine = split(texts.to_pylist())
            both = pa.concat_arrays([names, mine]).dictionary_encode()
            place = both.indices.to_numpy()[len(names) :]
            # both lists are in order of first sight, so whatever texts are left for the next chunk, their new units come last
            stops = np.append(np.arange(200, b.num_rows, 200), b.num_rows)
            ends = np.cumsum(each)[stops - 1]
            met = np.maximum.accumulate(found)[ends - 1] + 1
            units_held = len(names) + np.cumsum(place >= len(names))[met - 1]
            text_held = held + np.cumsum(pc.binary_length(texts).to_numpy())[stops - 1]
            full = (units_held > most) | (text_held > size)
            end = int(full.argmax()) if full.any() else -1
            k, found, place, held = int(stops[end]), found[: ends[end]], place[: met[end]], int(text_held[end])
            names = both.dictionary.slice(0, int(units_held[end]))
            counts = np.append(counts, np.zeros(len(names) - len(counts), np.int64))
            train = pc.fill_null(b.column(2).slice(0, k), False).to_numpy(zero_copy_only=False)
            counts[place] += np.bincount(found[np.repeat(train, each[:k])], minlength=len(place))
            places = np.split(place[found].astype("<u4"), np.cumsum(each[: k - 1]))
            yield rows_out(TOLD, [pa.array(np.full(k, chunk)), *(pa.nulls(k, f.type) for f in list(TOLD)[1:4]), b.column(0).slice(0, k), b.column(2).slice(0, k), [packed(x) for x in places]])
            if full.any():
                yield from close()
                names, counts, held, chunk = names.slice(0, 0), counts[:0], 0, chunk + 1
            b = b.slice(k)
    yield from close()


ASKED = "bucket int, part int, key binary, sym binary, n binary"
GIVEN = "part int, key binary, size binary, sym binary, n binary"


def summed(key: np.ndarray, sym: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    find = under(key, sym)
    o = np.argsort(find)
    find = find[o]
    first = np.flatnonzero(np.append(True, find[1:] != find[:-1])[: len(find)])
    return key[o[first]], sym[o[first]], np.add.reduceat(n[o], first) if len(first) else n


def arrays(t: pa.Table, name: str, kind: type) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in t.column(name)]


def joint(arrays_: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(arrays_) if arrays_ else np.zeros(0, kind)


def own_contexts(us: list[bytes], n: np.ndarray, shared: bool) -> list[tuple[np.ndarray, ...]]:
    """Rows of (key, byte, count) of a part's units: those of contexts that other parts may have, or the others."""
    us = units_of(us)
    contexts, sym = us.coded
    at = us.event
    w = np.bincount(at[at >= 0], np.repeat(n, us.sizes)[at >= 0], len(sym)).astype(np.int64)
    _, (*_, border), _ = coded([min(us), max(us)])
    mine = np.isin(contexts[-1], border) == shared
    last = summed(contexts[-1][mine], sym[mine], w[mine])
    return [*(summed(h, sym, w) for h in contexts[:-1]), last] if shared else [last]


def shared_contexts(every: DataFrame, parts: int) -> DataFrame:
    """For each part of units (part, unit, n), rows of the contexts that it has and other parts may have, with their bytes and counts over all parts; packed by buckets of keys."""

    def ask(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("unit")  # neighbours share beginnings
        both = own_contexts(Units(t.column("unit").to_pylist()), t.column("n").to_numpy(), True)
        k, sym, n = (np.concatenate(x) for x in zip(*both, strict=True))
        b = (k % np.uint64(parts)).astype(np.int64)
        o = np.argsort(b, kind="stable")
        k, sym, n, b = k[o], sym[o].astype(np.uint8), n[o], b[o]
        first = np.flatnonzero(np.append(True, b[1:] != b[:-1]))
        ends = np.append(first[1:], len(b))
        cols = [[x[i:j].tobytes() for i, j in zip(first, ends, strict=True)] for x in (k, sym, n)]
        return pa.table([pa.array(b[first], pa.int32()), pa.array([key[0].as_py()] * len(first), pa.int32()), *(pa.array(x, pa.binary()) for x in cols)], names=["bucket", "part", "key", "sym", "n"])

    def give(key: tuple, t: pa.Table) -> pa.Table:
        ks = arrays(t, "key", np.uint64)
        k, sym, n = summed(np.concatenate(ks), np.concatenate(arrays(t, "sym", np.uint8)), np.concatenate(arrays(t, "n", np.int64)))
        o = np.argsort(k, kind="stable")
        k, sym, n = k[o], sym[o], n[o]
        each, first, size = np.unique(k, return_index=True, return_counts=True)
        out: list[list[bytes]] = [[], [], [], []]
        for mine in ks:
            at = np.searchsorted(each, np.unique(mine))
            rows = np.repeat(first[at] - np.cumsum(size[at]) + size[at], size[at]) + np.arange(size[at].sum())
            for c, x in zip(out, (each[at], size[at].astype(np.uint16), sym[rows], n[rows]), strict=True):
                c.append(x.tobytes())
        return pa.table([t.column("part"), *(pa.array(x, pa.binary()) for x in out)], names=["part", "key", "size", "sym", "n"])

    asked = every.select("part", "unit", "n").groupBy("part").applyInArrow(ask, ASKED)
    return cut(asked.groupBy("bucket").applyInArrow(give, GIVEN), "contexts")


def known_of(units_: pa.Table, given: pa.Table) -> tuple[list[bytes], np.ndarray, Known]:
    """A part's units, how often training texts have them, and the counts of all their contexts."""
    us, n = Units(units_.column("unit").to_pylist()), units_.column("n").to_numpy()
    key = np.repeat(joint(arrays(given, "key", np.uint64), np.uint64), joint(arrays(given, "size", np.uint16), np.uint16))
    rows = [(key, joint(arrays(given, "sym", np.uint8), np.uint8).astype(np.int64), joint(arrays(given, "n", np.int64), np.int64)), *own_contexts(us, n, False)]
    return us, n, Known(*(np.concatenate(x) for x in zip(*rows, strict=True)))


def tuned(every: DataFrame, contexts: DataFrame, setting: Setting) -> tuple[np.ndarray, np.ndarray]:
    """The mixer's weights and the refining table: each part learns from all its training units with their counts, what they learned is added up."""
    start = Model(([], np.zeros(0)), setting)
    size = [start.weights.shape[0], start.weights.size, start.refined.size, start.refined.size]
    share = 1.0 if setting.sample is None else setting.sample / max(1, every.where("n > 0").count())

    def learn(key: tuple, t: pa.Table, given: pa.Table) -> pa.Table:
        out = np.zeros(sum(size))
        if t.num_rows:
            t = t.sort_by("unit")  # learning depends on the order, which shuffles change
            us, n, known = known_of(t, given)
            mine = np.where(t.column("tunes").to_numpy(zero_copy_only=False), n, 0).astype(np.float64)
            if mine.any():
                out = np.concatenate([x.ravel() for x in Model(([], np.zeros(0)), setting).learn(us, mine, known)])
        return pa.table([pa.array([key[0].as_py() // 64], pa.int32()), pa.array([out.tobytes()], pa.binary())], names=["g", "told"])

    def add_up(key: tuple, it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(sum(size))
        for b in it:
            for x in b.column("told"):
                out += np.frombuffer(x.as_buffer(), np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([out.tobytes()], pa.binary())], names=["g", "told"])

    tunes = F.pmod(F.xxhash64("unit"), F.lit(1 << 30)) < F.lit(share * (1 << 30))
    told = every.select("part", "unit", "n", tunes.alias("tunes")).groupBy("part").cogroup(contexts.groupBy("part")).applyInArrow(learn, "g int, told binary")
    got = arrays(cut(told, "told").groupBy("g").applyInArrow(add_up, "g int, told binary").toArrow(), "told", np.float64)
    if got:
        mass, weights, n, ones = np.split(sum(got), np.cumsum(size)[:-1])
        start.merged([mass, weights.reshape(start.weights.shape), n, ones])
    return start.weights, start.refined


def score(docs: DataFrame, train: Column, setting: Setting = Setting()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of docs (doc_id, text).

    train tells the rows to learn from. Null texts count as empty: their one token is the end. base_score is the add-one
    unigram model over lower-cased words and text ends; score is the mixing model's log10 probability of the whole text
    as bytes with its end. Without training rows all counts are 0 and the model is untrained. Repeated rows count each
    time and get equal results; other columns are left out. Words may be of any length.

    Tasks write their texts as places in chunks' lists of units, with these lists and their counts; a shuffle adds them up
    and scores each distinct unit once. Places are then shuffled once by chunk and meet the scores of the chunk's units;
    texts are read once. Counts of contexts stay in the parts of units
    that ask for them; only the mixer's weights and the refining table go to the driver, added up over 64 parts at a time.
    """
    spark = docs.sparkSession
    batches_of(spark)
    shared_folder(spark)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", train.alias("train"))
    told = cut(d.mapInArrow(tidy(_chunks), "chunk long, place int, unit binary, n long, doc_id long, train boolean, places binary"), "chunks")
    texts = told.where("places is not null").select("chunk", "doc_id", "train", "places")
    own = told.where("unit is not null").select("chunk", "place", "unit", "n")
    every = cut(own.groupBy("unit").agg(F.sum("n").alias("n")), "units")
    parts = max(1, -(-every.count() // setting.per_part))
    every = cut(every.repartitionByRange(parts, "unit").withColumn("part", F.spark_partition_id()), "parts")
    word = F.expr(f"translate(cast(substring(unit, 2, octet_length(unit) - 2) as string), '{ASCII_UPPER}', '{ASCII_UPPER.lower()}')")
    each = every.select("part", "unit", "n", F.expr("if(octet_length(unit) > 2, null, '')").alias("none")).withColumn("token", F.when(F.col("none").isNull(), word)).drop("none")
    words = cut(each.where("token is not null").groupBy("token").agg(F.sum("n").alias("c")), "words")
    ends = every.where("endswith(unit, X'FF')").agg(F.sum("n").alias("e")).first()["e"] or 0
    seen = words.where("c > 0").agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n_all, v_all = (seen["n"] or 0) + ends, seen["v"] + (ends > 0)
    floor = math.log10(n_all + v_all + 1)

    contexts = shared_contexts(every, parts)
    shipped = spark.sparkContext.broadcast(tuned(every, contexts, setting))

    def scored(key: tuple, t: pa.Table, given: pa.Table) -> pa.Table:
        s = np.zeros(0)
        if t.num_rows:
            t = t.sort_by("unit")  # neighbours share beginnings
            us, _, known = known_of(t, given)
            told, level = predictors([known.counts])
            s = Model((told * N, level), setting, *shipped.value).log10(us, known)
        return pa.table([t.column("unit"), pa.array(s), t.column("c")], names=["unit", "s", "c"])

    table = each.join(words, "token", "left").select("part", "unit", "n", F.coalesce("c", F.lit(0).cast("long")).alias("c"))
    table = table.groupBy("part").cogroup(contexts.groupBy("part")).applyInArrow(scored, "unit binary, s double, c long")
    table = cut(table, "unit-scores")

    def judged(key: tuple, texts: pa.Table, table: pa.Table) -> pa.Table:
        real, s = np.zeros((2, table.num_rows))
        c = np.zeros(table.num_rows, np.int64)
        at = table.column("place").to_numpy()
        real[at], s[at], c[at] = (table.column(x).to_numpy(zero_copy_only=False) for x in ("real", "s", "c"))
        sums = np.stack([real, real * (c > 0), np.where(real > 0, np.log10(c + 1.0) - floor, 0.0), s], axis=1)  # what a unit adds to a text
        got = np.array([sums[unpacked(x)].sum(0) for x in texts.column("places").to_pylist()]).reshape(-1, 4)
        n = got[:, :2].round().astype(np.int64) + np.array([1, int(ends > 0)])
        base = got[:, 2] + (math.log10(ends + 1) - floor)
        held_out = pc.invert(pc.fill_null(texts.column("train"), False))
        columns = [texts.column("doc_id"), held_out, pa.array(n[:, 0]), pa.array(n[:, 1]), pa.array(np.full(len(n), n_all)), pa.array(base), pa.array(got[:, 3])]
        return pa.table(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    mine = own.join(table, "unit").select(F.col("chunk").alias("at"), "place", F.expr("octet_length(unit) > 2").alias("real"), "s", "c")
    return texts.groupBy("chunk").cogroup(mine.groupBy("at")).applyInArrow(judged, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
