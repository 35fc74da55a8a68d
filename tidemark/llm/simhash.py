"""Near duplicates by SimHash, found through Golay-code keys."""

from __future__ import annotations

import re
from functools import lru_cache
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, cut, groups, per_batch, tidy
from tidemark.llm.components import components

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: Generator polynomial of the binary Golay code of 23 bits, 12 of them free: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY = 0b101011100011
#: A fingerprint's 64 bits as three words of 23 bits; the last has 18 and zeros.
SEGMENTS = (0, 23, 46)
WIDTH = 23


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    w = WORD.findall((text or "").encode().translate(LOWER))
    if not w:
        return 0
    if len(w) <= words:
        shingles = [b" ".join(w)]
    else:
        shingles = list(map(b" ".join, zip(*(w[i:] for i in range(words)), strict=False)))
    h = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), np.uint64, len(shingles))
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[i : i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def remainder_of(x: int) -> int:
    """A word's 11 check bits: its remainder modulo the generator."""
    for i in range(WIDTH - 1, 10, -1):
        if x >> i & 1:
            x ^= GOLAY << (i - 11)
    return x


@lru_cache(1)
def neighbours() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each remainder: the one error pattern of at most 3 bits, and all those of at most 4 (from where to where in a list).

    A codeword c is within r bits of x exactly if x ^ c has at most r bits and x's remainder.
    """
    one = [remainder_of(1 << i) for i in range(WIDTH)]
    near: list[list[int]] = [[] for _ in range(1 << 11)]
    nearest = np.zeros(1 << 11, np.int64)

    def fill(start: int, bits: int, pattern: int, rest: int) -> None:
        near[rest].append(pattern)
        if bits <= 3:
            nearest[rest] = pattern
        if bits < 4:
            for i in range(start, WIDTH):
                fill(i + 1, bits + 1, pattern | 1 << i, rest ^ one[i])

    fill(0, 0, 0, 0)
    sizes = np.array([len(x) for x in near])
    return nearest, np.cumsum(sizes) - sizes, np.array([p for x in near for p in x])


@lru_cache(1)
def remainders() -> tuple[np.ndarray, np.ndarray]:
    low = np.array([remainder_of(x) for x in range(1 << 12)])
    high = np.array([remainder_of(x << 12) for x in range(1 << 11)])
    return low, high


def segment(f: np.ndarray, at: int) -> np.ndarray:
    return ((f >> np.uint64(at)) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)


def codewords(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of 23-bit words: the index of the codeword within 3 bits; and of all those within 4, with the place of each one's word."""
    nearest, first, near = neighbours()
    low, high = remainders()
    r = low[x & 4095] ^ high[x >> 12]
    sizes = np.diff(np.append(first, len(near)))[r]
    of = np.repeat(np.arange(len(x)), sizes)
    place = np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return (x ^ nearest[r]) >> 11, (x[of] ^ near[first[r][of] + place]) >> 11, of


def keys(f: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Keys of fingerprints, with their places: those with their own codewords (True) and those with all near ones (False).

    If a word x lies within 3 of its codeword c and y within 1 of x, then y lies within 4 of c: so x's own codeword is
    among y's near ones. Three errors over three segments either leave one segment without any and another with one at
    most: that segment's bits and the other's codeword make a key, for each of the six choices. Or each segment has one:
    the codewords of the first two and half of the third, either half, make one.
    """
    words = [segment(f, at) for at in SEGMENTS]
    own, near = [], []
    for w in words:
        o, n, of = codewords(w)
        own.append(o)
        near.append((n, of, np.bincount(of, minlength=len(f))))
    every = np.arange(len(f))
    for k, (i, j) in enumerate(((0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1))):
        base = (k << 40) | (words[i] << 12)
        yield every, base | own[j], True
        n, of, _ = near[j]
        yield of, base[of] | n, False
    (na, fa, _), (nb, _, cb) = near[0], near[1]
    times = cb[fa]  # each near codeword of the first segment with all of the second
    of = np.repeat(fa, times)
    starts = np.cumsum(cb) - cb
    pair = np.repeat(na, times) << 12 | nb[starts[of] + np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)]
    for half in (0, 1):
        base = ((6 + half) << 40) | ((words[2] >> (9 * half)) & 511) << 24
        yield every, base | own[0] << 12 | own[1], True
        yield of, base[of] | pair, False


def forest(f: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Edges that connect exactly those fingerprints which links of most bits or fewer connect: each found one is compared with those not yet found."""
    out: list[tuple[int, int]] = []
    rest = np.unique(f)
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            linked = np.bitwise_count(rest ^ x) <= most
            if linked.any():
                found = rest[linked]
                out += [(int(x), int(y)) for y in found]
                queue += list(found)
                rest = rest[~linked]
    return out


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (as a long) of each row."""
    batches_of(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("f", pa.int64())])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(per_batch(lambda i, t: [i, [signed(fingerprint(x)) for x in t]], schema, ["doc_id", "text"]), "doc_id long, f long")


def near_duplicates(docs: DataFrame, most: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each row of docs (doc_id, text).

    Texts' words are lower-cased (A-Z); fingerprints are of 3-word shingles (XXH64, seed 42); two link at most (3 or
    fewer; more is an error) differing bits; component_id is the smallest doc_id that links reach. Null, empty and
    wordless texts have fingerprint 0 and link like others. Rows with equal ids stay apart but share what they reach;
    a null id never is a component's id, but where a component has no other. Empty tables give no rows.

    Only distinct fingerprints are compared, so exact copies of any number cost one row. Each gets some 100 keys of 33 bits
    and more; keys that only one fingerprint has go natively, before any are brought together; of each other key's
    fingerprints a spanning forest of verified links goes on, never all pairs. Chance brings some 56 / 2^33 of the
    distinct fingerprints, 8 bytes each, to a key; clusters of true near copies end their comparisons as they link.
    """
    if most > 3:
        raise ValueError("Golay keys find links of 3 differing bits at most")
    d = cut(fingerprints(docs), "fingerprints")
    nodes = d.groupBy("f").agg(F.min("doc_id").alias("low"))

    def keyed(fs: list[int]) -> list:
        f = np.array(fs, np.int64).view(np.uint64)
        parts = list(keys(f))
        key = np.concatenate([k for _, k, _ in parts])
        return [pa.array(key), pa.array(f.view(np.int64)[np.concatenate([of for of, _, _ in parts])]), pa.array(np.concatenate([np.full(len(k), own) for _, k, own in parts]))]

    schema = pa.schema([("key", pa.int64()), ("f", pa.int64()), ("own", pa.bool_())])
    parts = int(d.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    k = nodes.select("f").repartition(parts).mapInArrow(per_batch(keyed, schema, ["f"]), "key long, f long, own boolean")
    k = cut(k.groupBy("key", "f").agg(F.max("own").alias("own")), "keys")
    live = k.groupBy("key").agg(F.count("*").alias("n"), F.max("own").alias("own")).where("n > 1 and own").select("key")

    def linked(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u: list[int] = []
        v: list[int] = []
        for _, g in groups(it, ["key"]):
            for a, b in forest(np.array(g["f"], np.int64).view(np.uint64), most):
                u.append(signed(a))
                v.append(signed(b))
            if len(u) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])
                u, v = [], []
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    pairs = k.join(live, "key").select("key", "f").repartition("key").sortWithinPartitions("key").mapInArrow(tidy(linked), "u long, v long")
    roots = components(pairs)
    classes = nodes.join(roots, nodes["f"] == roots["node"], "left").select("f", "low", F.coalesce("root", "f").alias("root"))
    lows = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    named = classes.join(lows, "root").select("f", "component_id")
    return d.join(named, "f").select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")


#: Bands of minima, and minima of a band: a pair of Jaccard 0.8 shares no band with chance (1 - 0.8^4)^20, some 3 in 100,000.
BANDS, ROWS = 20, 4


def shingle_set(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted hashes of a text's distinct shingles of lower-cased (A-Z) words; fewer words are one shingle, none no shingle."""
    w = WORD.findall((text or "").encode().translate(LOWER))
    n = min(words, len(w))
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(b" ".join(w[i : i + n])) for i in range(len(w) - n + 1 if n else 0)), np.uint64))


def band_keys(x: np.ndarray) -> list[int]:
    odd = np.random.default_rng(7).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(x), 4096):
        h = x[i : i + 4096, None] * odd
        low = np.minimum(low, ((h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)).min(0))
    return [signed(xxhash.xxh64_intdigest(b.tobytes(), seed=i)) for i, b in enumerate(low.reshape(BANDS, ROWS))]


def alike(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    if min(len(x), len(y)) < least * max(len(x), len(y)) - 1e-9:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both >= least * (len(x) + len(y) - both) - 1e-9


def as_sets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """key, th, text of 256 rows at a time, the text's set (as bytes) in place of the text."""
    for b in it:
        for i in range(0, b.num_rows, 256):
            c = b.slice(i, 256)
            key, th, text = (c.column(c.schema.get_field_index(n)) for n in ("key", "th", "text"))
            yield pa.RecordBatch.from_arrays([key, th, pa.array([shingle_set(x.as_py()).tobytes() for x in text], pa.large_binary())], names=["key", "th", "set"])


def band_links(it: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    """u, v of each band's spanning forest; it: key, th, text, sorted by key. A band's sets are held, 8 bytes for each shingle, its texts are not."""
    for _, g in groups(as_sets(it), ["key"]):
        rest = [(th, np.frombuffer(x, np.uint64)) for th, x in zip(g["th"], g["set"], strict=True)]
        out: list[tuple[int, int]] = []
        while rest:
            queue = [rest.pop()]
            while queue and rest:
                th, x = queue.pop()
                near = [alike(x, y, least) for _, y in rest]
                found = [r for r, ok in zip(rest, near, strict=True) if ok]
                rest = [r for r, ok in zip(rest, near, strict=True) if not ok]
                out += [(th, t) for t, _ in found]
                queue += found
        if out:
            u, v = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def jaccard_links(texts: DataFrame, least: float = 0.8) -> DataFrame:
    """u, v: links that connect texts (th, a text's own number, and text; repeated rows count once) whose sets of 5-word shingles have at least this Jaccard similarity.

    Texts that share a band of MinHash minima are compared by their whole sets; of each band a spanning forest of
    verified links goes on, never all pairs. Of bands that hold the same texts one is compared. Only texts that share a
    band travel, and only there are their sets made anew.
    """
    batches_of(texts.sparkSession)

    def banded(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = [(th, band_keys(x)) for th, x in zip(b.column(0).to_pylist(), map(shingle_set, b.column(1).to_pylist()), strict=True) if len(x)]
            yield pa.RecordBatch.from_arrays([pa.array([th for th, _ in rows], pa.int64()), pa.array([ks for _, ks in rows], pa.list_(pa.int64()))], names=["th", "ks"])

    d = cut(texts.select("th", "text").mapInArrow(tidy(banded), "th long, ks array<long>").dropDuplicates(["th"]), "bands")
    k = d.select("th", F.explode("ks").alias("key"))
    held = k.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("th")).alias("x"), F.bit_xor(F.xxhash64("th", F.lit(1))).alias("y")).where("n > 1")
    live = cut(held.groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key"), "live-bands")
    pairs = cut(k.join(live, "key"), "live-texts")
    bucket = F.pmod(F.xxhash64("th"), F.lit(1 << 20))  # numbers broadcast: so many at most
    body = texts.select("th", "text").withColumn("_b", bucket).join(F.broadcast(pairs.select(bucket.alias("_b")).distinct()), "_b", "left_semi").groupBy("th").agg(F.first("text").alias("text"))

    return pairs.join(body, "th").repartition("key").sortWithinPartitions("key").mapInArrow(tidy(lambda it: band_links(it, least)), "u long, v long")
