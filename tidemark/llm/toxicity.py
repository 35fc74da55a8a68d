"""Toxicity by compression distance: how much shorter a toxic dictionary makes a text's windows than an ordinary one.

Both dictionaries come from zstandard's trainer. The ordinary one is trained on the words of ordinary training texts. The
toxic one is trained on windows of toxic training texts, of words that these have far more often than ordinary texts,
and holds the ordinary one's content too. A window is one word between two fixed runs of words, so that a segment which
the trainer picked is coded in one piece and what it saves isn't lost in the noise of its neighbours.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, cut, per_batch, tidy
from tidemark.llm.piece_bpe import Recent

#: ASCII letters lower-cased, other ASCII but digits to spaces.
PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))
#: What stands around a word in its window; both dictionaries hold it.
AROUND = b" the of and in that "


@dataclass(frozen=True)
class Setting:
    """toxic and ordinary: labelled rows that are learned from, at most; a fourth of them only calibrates. share: of the toxic texts that must have a word (least: so many at least) whose windows train the toxic dictionary; ratio: how much more often they must have it than ordinary texts; longest: longer words train none. toxic_bytes, ordinary_bytes and segment: the trainer's sizes."""

    toxic: int = 1500
    ordinary: int = 6000
    share: float = 0.025
    least: int = 4
    ratio: float = 12.0
    longest: int = 24
    toxic_bytes: int = 1536
    ordinary_bytes: int = 8192
    segment: int = 44


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(PLAIN).split()


def window(word: bytes) -> bytes:
    return AROUND + word + AROUND


def trained(samples: list[bytes], size: int, segment: int) -> bytes:
    """A dictionary by zstandard's trainer; of too few samples for it, their commonest ones, the very commonest last."""
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=8).as_bytes()
    except zstandard.ZstdError:
        n = Counter(samples)
        return b"".join(sorted(n, key=lambda x: (n[x], x)))[-size:]


def dictionaries(toxic: list[tuple[bytes, ...]], ordinary: list[tuple[bytes, ...]], setting: Setting) -> tuple[bytes, bytes]:
    """The contents of the ordinary and the toxic dictionary, from the distinct words of texts of both kinds, in order."""
    base = trained([b" " + b" ".join(t) + b" " for t in ordinary if t], setting.ordinary_bytes, setting.segment + 4) + AROUND * 2
    have, lack = Counter(w for t in toxic for w in t), Counter(w for t in ordinary for w in t)
    need = max(setting.least, int(setting.share * len(toxic)))
    own = {w for w, n in have.items() if n >= need and 4 <= len(w) <= setting.longest and n / len(toxic) > setting.ratio * (lack[w] + 0.2) / max(1, len(ordinary))}
    return base, trained([window(w) for t in toxic for w in t if w in own], setting.toxic_bytes, setting.segment) + b" " + base


def coder(content: bytes) -> zstandard.ZstdCompressor:
    how = zstandard.ZstdCompressionParameters(window_log=17, hash_log=16, chain_log=17, search_log=8, min_match=4, target_length=32, strategy=zstandard.STRATEGY_LAZY2, write_checksum=False, write_content_size=False, write_dict_id=False)
    return zstandard.ZstdCompressor(compression_params=how, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))


def savings(ordinary: bytes, toxic: bytes) -> Recent:
    """Bytes that the toxic dictionary saves on a word's window, for the words used last."""
    o, t = coder(ordinary), coder(toxic)
    return Recent(lambda w: len(o.compress(window(w))) - len(t.compress(window(w))), 150_000, 64)


def features(text: str | None, gains: Recent) -> list[float]:
    """The two greatest savings, how many words save 5, 4, 3 and 2 bytes or more, and the first of these to a word."""
    g = np.fromiter(map(gains.__getitem__, words(text)), np.int64)
    if not len(g):
        return [0.0] * 8
    top = np.sort(np.partition(g, len(g) - 2)[-2:])[::-1] if len(g) > 1 else np.append(g, 0)
    counts = [int((g >= least).sum()) for least in (5, 4, 3, 2)]
    return [min(6.0, max(0.0, float(top[0]))), min(6.0, max(0.0, float(top[1]))), *map(math.log1p, counts), math.log1p(100 * counts[1] / len(g)), math.log1p(100 * counts[3] / len(g))]


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton's method; the constant is last."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + penalty * len(x) / 100 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - penalty * len(x) / 100 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_texts(docs: DataFrame, labels: DataFrame, train: Column, setting: Setting = Setting()) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.5 on) of each row of docs (doc_id, text).

    labels (doc_id, toxic) are learned from where train holds of a doc_id, from at most so many rows of each label as
    setting has, those whose ids hash lowest. Of a doc_id with several labels the greater counts, with several texts the
    least; null ids, null labels and labels without a document teach nothing. With only one label to learn, every score
    is 0 or 1 accordingly, with none 0. Null and empty texts have no windows and the score of such texts. Repeated rows
    get equal scores, empty tables give no rows; other columns are left out. Texts are scored whole, where they are read;
    the sample is written once, its dictionaries are trained in one task, and only they and the calibrating rows'
    features go to the driver.
    """
    batches_of(docs.sparkSession)
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    told = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).where(train).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("y"))
    pick = lambda y, n: told.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    told = pick(1, setting.toxic).union(pick(0, setting.ordinary)).withColumn("last", F.pmod(F.xxhash64("doc_id", F.lit("last")), F.lit(4)) == 0)
    sample = d.join(F.broadcast(told), "doc_id").groupBy("doc_id").agg(F.min(F.struct("y", "last", "text")).alias("x"))
    sample = cut(sample.select("x.y", "x.last", "x.text"), "toxicity-sample")
    n = {(r["y"], r["last"]): r["n"] for r in sample.groupBy("y", "last").agg(F.count("*").alias("n")).collect()}
    nt, no = n.get((1, False), 0), n.get((0, False), 0)
    if not nt or not no:
        s = 1.0 if nt else 0.0
        return d.select("doc_id", F.lit(s).alias("score"), F.lit(int(s)).alias("predicted"))

    def learn(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bytes] = {}
        texts: tuple[list, list] = ([], [])
        for b in it:
            for text, y in zip(b.column("text").to_pylist(), b.column("y").to_pylist(), strict=True):
                texts[y].append(tuple(known.setdefault(w, w) for w in sorted(set(words(text)))))
        if texts[0] or texts[1]:
            got = dictionaries(sorted(texts[1]), sorted(texts[0]), setting)
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in got], names=["o", "t"])

    got = sample.where("not last").select("text", "y").repartition(1).mapInArrow(tidy(learn), "o binary, t binary").first()  # rows of the sample at most
    common, toxic = bytes(got["o"]), bytes(got["t"])

    def measured(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = savings(common, toxic)
        for b in it:
            yield pa.RecordBatch.from_arrays([pa.array([features(t, gains) for t in b.column("text").to_pylist()], pa.list_(pa.float64())), b.column("y")], names=["x", "y"])

    kind = "x array<double>, y int"
    rows = sample.where("last").select("text", "y").mapInArrow(tidy(measured), kind).collect()
    if len({r["y"] for r in rows}) < 2:
        rows = sample.select("text", "y").mapInArrow(tidy(measured), kind).collect()
    rows = sorted((r["y"], *r["x"]) for r in rows)
    w = fit(np.array([r[1:] for r in rows]), np.array([r[0] for r in rows], float))
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])

    def scored(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = savings(common, toxic)

        def judge(ids: list[int], texts: list[str | None]) -> list:
            s = [1 / (1 + math.exp(-max(-30.0, min(30.0, float(np.dot(w[:-1], features(t, gains)) + w[-1]))))) for t in texts]
            return [ids, s, [int(x >= 0.5) for x in s]]

        return per_batch(judge, schema, ["doc_id", "text"])(it)

    return d.mapInArrow(scored, "doc_id long, score double, predicted int")
