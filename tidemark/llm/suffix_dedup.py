"""Exact duplicate substrings by a sparse, hash-compared suffix sort.

Every window of the wanted size picks one anchor by its content alone: the least hashed gram in it. Equal windows pick
equal anchors at equal places, so only texts around equal anchors are compared: their suffixes from the anchor on, and
their reversed prefixes before it, are sorted by comparing prefix hashes, and neighbours' common extensions tell which
windows occur twice. Common extensions are verified by their bytes; strings that are only counted, by cryptographic
digests (BLAKE2b, 128 bits), never by the short hashes that bring them together. Runs of words, an addition, compare by
two independent polynomial hashes, 128 bits in all.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cmp_to_key, lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import batches_of, cut, groups, tidy

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: A second pair, for hashes of words that don't depend on the first.
BASE2 = np.uint64(0xC2B2AE3D27D4EB4F)
INVERSE2 = np.uint64(pow(0xC2B2AE3D27D4EB4F, -1, 1 << 64))
#: So many windows of a text are looked at together; more only bounds memory, runs of windows end there.
PIECE = 1 << 19
#: Documents meet small tables by a hash of so many values, whatever their number.
BUCKETS = 1 << 20


@lru_cache(4)
def powers(n: int, base: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.cumprod(p)


def room(n: int) -> int:
    return 1 << max(10, n.bit_length())


def prefix_hashes(raw: bytes | np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    """Polynomial hashes of all prefixes, of bytes or numbers, modulo 2^64; hash n is of the first n."""
    h = np.zeros(len(raw) + 1, np.uint64)
    x = raw if isinstance(raw, np.ndarray) else np.frombuffer(raw, np.uint8).astype(np.uint64)
    np.cumsum((x + np.uint64(1)) * powers(room(len(raw)), int(base))[: len(raw)], out=h[1:])
    return h


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def runs(raw: bytes, size: int, gram: int) -> Iterator[tuple[int, int, int]]:
    """(first window, number of windows, anchor) of the runs of windows with one anchor, by places in raw."""
    wide = size - gram + 1
    for s0 in range(0, len(raw) - size + 1, PIECE):
        part = raw[s0 : s0 + PIECE + size - 1]
        h = prefix_hashes(part)
        n = len(part) - gram + 1
        g = mix((h[gram:] - h[:n]) * powers(1 << max(10, len(part).bit_length()), int(INVERSE))[:n])
        low = (g & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)  # of equal ones the leftmost
        length = 1
        while length * 2 <= wide:
            low = np.minimum(low[:-length], low[length:])
            length *= 2
        count = len(part) - size + 1
        own = (np.minimum(low[:count], low[wide - length : wide - length + count]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(np.diff(own)) + 1))
        for lo, k, a in zip(first.tolist(), np.diff(np.append(first, count)).tolist(), own[first].tolist(), strict=True):
            yield s0 + lo, k, s0 + a


def digest(raw: bytes) -> bytes:
    return blake2b(raw, digest_size=16).digest()


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class Text:
    """A byte string with the hashes of its prefixes."""

    def __init__(self, raw: bytes) -> None:
        self.raw, self.hashes = raw, prefix_hashes(raw)


def common(a: Text, b: Text) -> int:
    """Length of the longest common prefix: a binary search over prefix hashes, verified."""
    low, high = 0, min(len(a.raw), len(b.raw))
    x, y = a.hashes, b.hashes
    if x[high] == y[high]:
        low = high
    while low < high - 1:
        mid = (low + high) // 2
        if x[mid] == y[mid]:
            low = mid
        else:
            high = mid
    n = low
    if a.raw[:n] != b.raw[:n]:  # equal hashes of unequal prefixes
        n = next(i for i in range(n) if a.raw[i] != b.raw[i])
    return n


def compare(a: Text, b: Text) -> int:
    n = common(a, b)
    return (a.raw[n : n + 1] > b.raw[n : n + 1]) - (a.raw[n : n + 1] < b.raw[n : n + 1])


def suffix_array(texts: list[Text]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' order, by merge sort, and the common prefix of each with the one before it (the first: 0)."""
    order = sorted(range(len(texts)), key=cmp_to_key(lambda i, j: compare(texts[i], texts[j])))
    return np.array(order), np.array([0, *(common(texts[i], texts[j]) for i, j in zip(order, order[1:], strict=False))])


def repeated(strings: list[bytes], anchors: list[int], counts: list[int], size: int) -> list[list[tuple[int, int]]]:
    """For strings around equal anchors (at these places), with so many windows each from their start: the ranges of window starts, first and last, whose window another string has at the same distance from its anchor."""
    n = len(strings)
    right = [Text(s[a:]) for s, a in zip(strings, anchors, strict=True)]
    left = [Text(s[:a][::-1]) for s, a in zip(strings, anchors, strict=True)]
    out: list[list[tuple[int, int]]] = [[] for _ in strings]

    def add(i: int, least: int, most: int) -> None:
        """Windows that begin least to most bytes before the anchor."""
        least, most = max(least, anchors[i] - counts[i] + 1), min(most, anchors[i])
        if least <= most:
            out[i].append((anchors[i] - most, anchors[i] - least))

    if n == 2:
        most, least = common(left[0], left[1]), size - common(right[0], right[1])
        for i in (0, 1):
            add(i, least, most)
        return out
    (ro, rc), (lo, lc) = suffix_array(right), suffix_array(left)
    # how far before the anchor a window begins decides which neighbours agree on both of its parts; between these marks nothing changes
    marks = np.unique(np.clip(np.concatenate((lc[1:] + 1, size - rc[1:], [0])), 0, size + 1))
    for b, e in zip(marks, np.append(marks[1:], size + 1), strict=True):
        cls = np.empty(n, np.int64)
        cls[lo] = np.cumsum(lc < b) * (n + 1)
        more = np.empty(n, np.int64)
        more[ro] = np.cumsum(rc < size - b)
        cls += more
        _, back, times = np.unique(cls, return_inverse=True, return_counts=True)
        for i in np.flatnonzero(times[back] > 1):
            add(int(i), int(b), int(e) - 1)
    return out


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that the spans (from, to) cover."""
    s, e = np.array(spans, np.int64).reshape(-1, 2).T
    return list(zip(*(x.tolist() for x in joined_by(np.zeros(len(s), np.int64), s, e)[1:]), strict=True))


def joined_by(of: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts (by number) and their spans: the maximal runs of covered bytes, by text and place."""
    at = of << 32
    o = np.argsort(at + s)
    at, start, end = at[o], (at + s)[o], np.maximum.accumulate((at + e)[o])
    first = np.flatnonzero(np.append(True, start[1:] > end[:-1])) if len(o) else o
    last = np.append(first[1:], len(o))[: len(first)] - 1
    return at[first] >> 32, start[first] - at[first], end[last] - at[first]


def listed(x: pa.Array, *names: str) -> tuple[np.ndarray, ...]:
    """Of lists of structs: the number of each struct's list, and its fields."""
    flat = x.flatten()
    of = np.repeat(np.arange(len(x)), pc.fill_null(pc.list_value_length(x), 0).to_numpy())
    return of, *(flat.field(n).to_numpy(zero_copy_only=False) for n in names)


OCC = pa.schema([("ah", pa.int64()), ("sh", pa.binary()), ("doc", pa.int64()), ("th", pa.int64()), ("lo", pa.int32()), ("n", pa.int32()), ("off", pa.int32())])


def repeated_spans(docs: DataFrame, size: int = 400, gram: int = 100, together: int = 1000) -> DataFrame:
    """doc, th (an id and a hash of its text) and s, e: covered bytes from s to before e, of docs (doc_id, text); see remove_repeats."""
    batches_of(docs.sparkSession)
    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"), F.xxhash64("text").alias("th"), "text").where(F.octet_length("text") >= size)

    def occurrences(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out: list[list[int]] = [[] for _ in OCC.names]
            for doc, th, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                raw = text.encode()
                for lo, n, a in runs(raw, size, gram):
                    for o, x in zip(out, (signed(xxhash.xxh3_64_intdigest(raw[a : a + gram])), digest(raw[lo : lo + n - 1 + size]), doc, th, lo, n, a - lo), strict=True):
                        o.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, OCC, strict=True)], schema=OCC)

    occ = cut(d.mapInArrow(tidy(occurrences), "ah long, sh binary, doc long, th long, lo int, n int, off int"), "anchors")
    # written first, so that the join's larger side comes straight from a shuffle and a hot anchor can be split
    often = cut(occ.groupBy("ah").agg(F.count("*").alias("k")).where("k > 1").select("ah"), "anchors-often")
    occ = cut(occ.join(often, "ah"), "repeated-anchors")
    classes = occ.groupBy("ah", "sh").agg(F.count("*").alias("k"), F.min(F.struct("doc", "th", "lo", "n", "off")).alias("one"))
    classes = cut(classes, "classes")
    whole = occ.join(classes.where("k > 1").select("ah", "sh"), ["ah", "sh"]).select("doc", "th", F.col("lo").alias("s"), (F.col("lo") + F.col("n") - 1 + size).alias("e"))

    # strings that occur once, around anchors that occur in other strings too
    open_ = classes.groupBy("ah").agg(F.count("*").alias("m"), F.sum((F.col("k") == 1).cast("long")).alias("single")).where("m > 1 and single > 0").select("ah", "m")
    open_ = cut(open_, "anchors-open")
    need = classes.join(open_, "ah").select("ah", "m", F.col("k").alias("k"), "one.*")
    per_doc = cut(need.groupBy("doc", "th").agg(F.collect_list(F.struct("ah", "m", "k", "lo", "n", "off")).alias("need")), "open-anchors")
    text = near(d, per_doc)

    def strings(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for doc, th, text, need in zip(*(c.to_pylist() for c in b.columns), strict=True):
                raw = text.encode()
                for i in range(0, len(need), 5000):
                    rows = [(x["ah"], x["m"], x["k"], doc, th, x["lo"], x["n"], x["off"], raw[x["lo"] : x["lo"] + x["n"] - 1 + size]) for x in need[i : i + 5000]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), STRINGS.types, strict=True)], schema=STRINGS)

    STRINGS = pa.schema([("ah", pa.int64()), ("m", pa.int64()), ("k", pa.int64()), ("doc", pa.int64()), ("th", pa.int64()), ("lo", pa.int32()), ("n", pa.int32()), ("off", pa.int32()), ("raw", pa.binary())])
    got = text.join(per_doc, ["doc", "th"]).select("doc", "th", "text", "need").mapInArrow(tidy(strings), "ah long, m long, k long, doc long, th long, lo int, n int, off int, raw binary")
    got = cut(got, "strings")

    def sorted_groups(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int, int]] = []
        for _, g in groups(it, ["ah"]):
            found = repeated(g["raw"], g["off"], g["n"], size) if len(g["raw"]) > 1 else []
            for k, doc, th, lo, ranges in zip(g["k"], g["doc"], g["th"], g["lo"], found, strict=False):
                if k == 1:
                    out += [(doc, th, lo + a, lo + b + size) for a, b in ranges]
            if len(out) > 20_000:
                yield spans_out(out)
                out = []
        if out:
            yield spans_out(out)

    def windows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for ah, doc, th, lo, n, off, raw in zip(*(b.column(c).to_pylist() for c in ("ah", "doc", "th", "lo", "n", "off", "raw")), strict=True):
                hs = [digest(raw[t : t + size]) for t in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array([ah] * n), pa.array(hs, pa.binary()), pa.array([off - t for t in range(n)], pa.int32()), pa.array([doc] * n), pa.array([th] * n), pa.array([lo + t for t in range(n)], pa.int32())], names=["ah", "wh", "o", "doc", "th", "s"])

    kind = "doc long, th long, s int, e int"
    few = got.where(F.col("m") <= together).repartition("ah").sortWithinPartitions("ah").mapInArrow(tidy(sorted_groups), kind)
    # anchors in more different strings than one task should sort: their windows one by one
    each = cut(got.where(F.col("m") > together).mapInArrow(tidy(windows), "ah long, wh binary, o int, doc long, th long, s int"), "windows")
    twice = cut(each.groupBy("ah", "wh", "o").agg(F.count("*").alias("k")).where("k > 1").select("ah", "wh", "o"), "windows-twice")
    many = each.join(twice, ["ah", "wh", "o"]).select("doc", "th", "s", (F.col("s") + size).alias("e"))
    return whole.union(few).union(many)


def spans_out(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    doc, th, s, e = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(th, pa.int64()), pa.array(s, pa.int32()), pa.array(e, pa.int32())], names=["doc", "th", "s", "e"])


def bucket(df: DataFrame) -> Column:
    return F.pmod(F.xxhash64(*(("_doc", "_th") if "_doc" in df.columns else ("doc", "th"))), F.lit(BUCKETS))


def near(d: DataFrame, some: DataFrame, kind: str = "left_semi") -> DataFrame:
    """The rows of d (doc, th) whose hash bucket some's rows have too (left_anti: the others): a cheap filter before a join. The buckets broadcast are BUCKETS numbers at most."""
    return d.withColumn("_b", bucket(d)).join(F.broadcast(some.select(bucket(some).alias("_b")).distinct()), "_b", kind).drop("_b")


BLANK = np.isin(np.arange(256), list(b" \t\n\v\f\r"))


def word_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end."""
    blank = np.ones(len(raw) + 2, bool)
    blank[1:-1] = BLANK[np.frombuffer(raw, np.uint8)]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    return edges[::2], edges[1::2]


class Words:
    """Places of a text's words, and hashes of runs of them, whatever white space parts them."""

    def __init__(self, raw: bytes) -> None:
        self.starts, self.ends = word_spans(raw)
        self.size = room(len(raw))
        h = prefix_hashes(raw)
        token = mix((h[self.ends] - h[self.starts]) * powers(self.size, int(INVERSE))[self.starts])
        self.sums = [(prefix_hashes(token), INVERSE), (prefix_hashes(mix(token + BASE2), BASE2), INVERSE2)]

    def hashes(self, first: np.ndarray | slice, after: np.ndarray | slice) -> list[np.ndarray]:
        """Two hashes of the runs from each first word to before each after."""
        return [mix((h[after] - h[first]) * powers(self.size, int(inverse))[: len(h)][first]) for h, inverse in self.sums]


def word_runs(w: Words, words: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of runs of windows of so many words with one anchor: the first word, that after the last, and the anchor's hash."""
    n = len(w.starts) - gram + 1
    g = w.hashes(slice(0, n), slice(gram, None))[0]
    low = (g & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)  # of equal ones the leftmost
    wide, length = words - gram + 1, 1
    while length * 2 <= wide:
        low = np.minimum(low[:-length], low[length:])
        length *= 2
    count = len(w.starts) - words + 1
    own = (np.minimum(low[:count], low[wide - length : wide - length + count]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate(([0], np.flatnonzero(np.diff(own)) + 1))
    return first, np.append(first[1:], count) - 1 + words, g[own[first]]


def repeated_passages(docs: DataFrame, words: int) -> DataFrame:
    """doc, th, s, e as repeated_spans: the runs of so many whole words that also stand elsewhere, whatever white space parts them.

    Windows of words pick anchors as windows of bytes do. Texts around an anchor that are the same count as a whole;
    those that differ have their windows counted one by one, so that no anchor meets in one task.
    """
    batches_of(docs.sparkSession)
    gram = max(1, words // 8)
    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"), F.xxhash64("text").alias("th"), "text").where(F.octet_length("text") >= 2 * words - 1)

    def batch(names: list[str], parts: list[tuple]) -> pa.RecordBatch:
        """Rows of arrays; a number stands for as many as the part has."""
        kinds = [pa.int32() if n in ("s", "e") else pa.bool_() if n == "single" else pa.int64() for n in names]
        cols = [np.concatenate([x if isinstance(x, np.ndarray) else np.full(len(p[0]), x) for p in parts for x in [p[i]]]) if parts else np.zeros(0, np.int64) for i in range(len(names))]
        return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c).cast(k) for c, k in zip(cols, kinds, strict=True)], names=names)

    def occurrences(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            parts = []
            for doc, th, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                w = Words(text.encode())
                if len(w.starts) >= words:
                    first, after, ah = word_runs(w, words, gram)
                    parts.append((ah, *w.hashes(first, after), doc, th, w.starts[first], w.ends[after - 1]))
            yield batch(["ah", "sh", "sh2", "doc", "th", "s", "e"], parts)

    occ = cut(d.mapInArrow(tidy(occurrences), "ah long, sh long, sh2 long, doc long, th long, s int, e int"), "word-anchors")
    often = cut(occ.groupBy("ah").agg(F.count("*").alias("k")).where("k > 1").select("ah"), "word-anchors-often")
    occ = cut(occ.join(often, "ah"), "repeated-word-anchors")
    classes = cut(occ.groupBy("ah", "sh", "sh2").agg(F.count("*").alias("k"), F.min(F.struct("doc", "th", "s", "e")).alias("one")), "word-classes")
    whole = occ.join(classes.where("k > 1").select("ah", "sh", "sh2"), ["ah", "sh", "sh2"]).select("doc", "th", "s", "e")
    open_ = cut(classes.groupBy("ah").agg(F.count("*").alias("m"), F.sum((F.col("k") == 1).cast("long")).alias("single")).where("m > 1 and single > 0").select("ah"), "word-anchors-open")
    need = classes.join(open_, "ah").select((F.col("k") == 1).alias("single"), "one.*")
    need = cut(need.groupBy("doc", "th").agg(F.collect_list(F.struct("single", "s", "e")).alias("need")), "open-word-anchors")

    def windows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            of, single, s, e = listed(b.column(3), "single", "s", "e")
            ends = np.searchsorted(of, np.arange(b.num_rows + 1))
            parts, held = [], 0
            for k, (doc, th, text) in enumerate(zip(*(c.to_pylist() for c in b.columns[:3]), strict=True)):
                w, mine = Words(text.encode()), slice(ends[k], ends[k + 1])
                i = np.searchsorted(w.starts, s[mine])
                n = np.searchsorted(w.ends, e[mine]) + 2 - words - i
                at = np.arange(n.sum()) + np.repeat(i - np.cumsum(n) + n, n)
                parts.append((*w.hashes(at, at + words), np.repeat(single[mine], n), doc, th, w.starts[at], w.ends[at + words - 1]))
                held += len(at)
                if held > 100_000:
                    yield batch(["wh", "wh2", "single", "doc", "th", "s", "e"], parts)
                    parts, held = [], 0
            yield batch(["wh", "wh2", "single", "doc", "th", "s", "e"], parts)

    each = near(d, need).join(need, ["doc", "th"]).select("doc", "th", "text", "need").mapInArrow(tidy(windows), "wh long, wh2 long, single boolean, doc long, th long, s int, e int")
    each = cut(each, "word-windows")
    twice = cut(each.groupBy("wh", "wh2").agg(F.count("*").alias("k")).where("k > 1").select("wh", "wh2"), "word-windows-twice")
    return whole.union(each.where("single").join(twice, ["wh", "wh2"]).select("doc", "th", "s", "e"))


def remove_repeats(docs: DataFrame, size: int = 400, as_text: bool = False, words: int | None = None, told: bool = False) -> DataFrame:
    """doc_id, n_bytes, spans (of s, e) and kept (binary) of each row of docs (doc_id, text); or all columns of docs, text being what is kept, without characters that a cut splits, and spans (as_text).

    Removed is each byte of the text's UTF-8 that a string of size bytes covers which also starts anywhere else, in any
    row or the same one, and (words) each run of so many whole words that also stands elsewhere, whatever white space
    parts them; all judged on the input. With told, such runs of words stay, and n_passages counts the maximal ones.
    Kept are the other bytes in their order; a cut may split a character. Null texts count as empty; shorter texts keep
    all. Rows with equal ids are different texts, repeated rows copies of each other. Texts may be of any length; other
    columns are left out; empty tables give no rows.

    Documents' anchors (some 2 per 300 bytes, 2 per 40 words) are shuffled as numbers; strings only around anchors that
    occur in different strings, one for each. An anchor in more strings than one task should sort has its windows
    counted singly. Texts are shuffled only near those with something to remove.
    """
    spans = repeated_spans(docs, size).withColumn("w", F.lit(False))
    if words:
        spans = spans.union(repeated_passages(docs, words).withColumn("w", F.lit(told)))
    spans = cut(spans, "spans").groupBy("doc", "th").agg(F.collect_list(F.struct("s", "e", "w")).alias("found"))
    spans = cut(spans, "document-spans").select(F.col("doc").alias("_doc"), F.col("th").alias("_th"), F.col("found").alias("_found"))
    text = F.coalesce("text", F.lit(""))
    d = (docs.drop("spans") if as_text else docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("*", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("_doc"), F.xxhash64("text").alias("_th"))
    names = [c for c in d.columns if c not in ("_doc", "_th")] if as_text else ["doc_id"]
    kinds = [x for x in d.schema.fields if x.name in names]

    def remove(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            place = b.schema.get_field_index
            sizes, kept = [], []
            of, s, e, w = listed(b.column(place("_found")), "s", "e", "w")
            passages = np.bincount(joined_by(of[w], s[w], e[w])[0], minlength=b.num_rows)
            of, s, e = joined_by(of[~w], s[~w], e[~w])
            ends = np.searchsorted(of, np.arange(b.num_rows + 1))
            for t, lo, hi in zip(b.column(place("text")).to_pylist(), ends, ends[1:], strict=False):
                raw = (t or "").encode()
                sizes.append(len(raw))
                kept.append(b"".join(raw[i:j] for i, j in zip([0, *e[lo:hi].tolist()], [*s[lo:hi].tolist(), len(raw)], strict=True)))
            done_ = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(s), pa.array(e)], names=["s", "e"]))
            if as_text:
                new = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
                yield pa.RecordBatch.from_arrays([*(new if n == "text" else b.column(place(n)) for n in names), done_], names=[*names, "spans"])
            else:
                more = [pa.array(passages, pa.int64())] if told else []
                yield pa.RecordBatch.from_arrays([b.column(place("doc_id")), pa.array(sizes, pa.int64()), done_, pa.array(kept, pa.binary()), *more], names=["doc_id", "n_bytes", "spans", "kept", *(["n_passages"] if told else [])])

    span_list = "array<struct<s:bigint,e:bigint>>"
    none = F.expr(f"cast(array() as {span_list})").alias("spans")
    if as_text:
        out = T.StructType([*kinds, T.StructField("spans", T.ArrayType(T.StructType([T.StructField("s", T.LongType()), T.StructField("e", T.LongType())])))])
    else:
        out = f"doc_id long, n_bytes long, spans {span_list}, kept binary" + (", n_passages long" if told else "")
    touched = near(d, spans).join(spans, ["_doc", "_th"], "left").select(*dict.fromkeys([*names, "text"]), "_found").mapInArrow(tidy(remove), out)
    rest = near(d, spans, "left_anti")
    rest = rest.select(*(text.alias("text") if n == "text" else F.col(n) for n in names), none) if as_text else rest.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), none, text.cast("binary").alias("kept"), *([F.lit(0).cast("long").alias("n_passages")] if told else []))
    return rest.union(touched)
