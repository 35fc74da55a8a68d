"""Language identification by cross-parsing against labelled text."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import batches_of, tidy

UNDECIDED = "und"
GAP, END = 1, 2  # symbols; 0: bytes that no sample has
#: So many texts and more take each step together; fewer, the longest ones' rest, one by one.
TOGETHER = 32


def plain_bytes() -> np.ndarray:
    """Which bytes are parsed as they are: letters a-z and all parts of longer UTF-8 characters. Runs of others are one gap."""
    keep = np.zeros(256, bool)
    keep[ord("a") : ord("z") + 1] = True
    keep[128:] = True
    return keep


def suffix_automaton(texts: list[bytes]) -> list[dict[int, int]]:
    """Transitions of the automaton of all substrings of the texts; state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    for text in texts:
        last = 0
        for c in text:
            if c in nxt[last]:
                q = nxt[last][c]
                if length[q] == length[last] + 1:
                    last = q
                    continue
                new = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[last] + 1)
                link.append(link[q])
                link[q] = new
                p = last
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = new
                    p = link[p]
                last = new
                continue
            cur = len(nxt)
            nxt.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                if length[q] == length[p] + 1:
                    link[cur] = q
                else:
                    new = len(nxt)
                    nxt.append(dict(nxt[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    link[q] = link[cur] = new
                    while p >= 0 and nxt[p].get(c) == q:
                        nxt[p][c] = new
                        p = link[p]
            last = cur
    return nxt


def symbols(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' symbols one after another, with runs of gaps as one, and where each text ends."""
    raw = np.frombuffer("\0".join(t.lower().replace("\0", " ") for t in texts).encode() + b"\0", np.uint8)
    s = table[raw]
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != GAP) | (s[:-1] != GAP)
    s = s[keep]
    return s, np.flatnonzero(s == END)


class Parser:
    """Counts the longest-match phrases of texts against each language's sample."""

    def __init__(self, samples: tuple[tuple[str, tuple[str, ...]], ...]) -> None:
        self.langs = [lang for lang, _ in samples]
        keep = plain_bytes()
        cleaned = []
        table = np.full(256, GAP, np.int32)
        table[keep] = 0
        table[0] = END
        for _, texts in samples:
            joined = "\0".join(t.lower().replace("\0", " ") for t in texts).encode()
            cleaned.append([re.sub(rb"[^a-z\x80-\xff]+", b" ", t) for t in joined.split(b"\0")])
        seen = sorted({c for texts in cleaned for t in texts for c in t} - {32})
        for i, c in enumerate(seen):
            table[c] = END + 1 + i
        self.table, self.width = table, END + 1 + len(seen)
        self.price = [math.log2(2 + sum(map(len, texts))) for texts in cleaned]
        parts, self.roots, base = [], [], 0
        for texts in cleaned:
            sa = suffix_automaton([bytes(t) for t in texts])
            # a step: the next state's row times 4, and how many phrases end; a symbol that no state has is a phrase itself
            kind = np.int32 if (base + len(sa)) * self.width < 1 << 29 else np.int64
            root = np.full(self.width, base * self.width * 4 + 2, kind)
            for c, q in sa[0].items():
                root[GAP if c == 32 else table[c]] = (base + q) * self.width * 4 + 1
            steps = np.tile(root, (len(sa), 1))
            steps[0] -= 1
            for v, out in enumerate(sa):
                for c, q in out.items():
                    steps[v, GAP if c == 32 else table[c]] = (base + q) * self.width * 4
            parts.append(steps.ravel())
            self.roots.append(base * self.width)
            base += len(sa)
        self.steps = np.concatenate(parts) if parts else np.zeros(0, np.int32)

    def costs(self, texts: list[str]) -> np.ndarray:
        """For each text and language, the bits of naming its phrases, by symbol of the text. A text's parse is one from its start to its end."""
        s, ends = symbols(texts, self.table)
        starts = np.concatenate(([0], ends[:-1] + 1))
        order = np.argsort(starts - ends, kind="stable")
        first, size = starts[order], (ends - starts)[order]
        counts = np.zeros((len(self.langs), len(order)), np.int64)
        roots = np.array(self.roots, self.steps.dtype)[:, None]
        at = np.repeat(roots, len(order), axis=1)
        shared = int(size[TOGETHER - 1]) if len(size) >= TOGETHER else 0
        live = np.searchsorted(-size, -np.arange(shared), "left")  # texts longer than each step's number
        for i in range(shared):
            n = live[i]
            x = self.steps[at[:, :n] + s[first[:n] + i]]
            counts[:, :n] += x & 3
            at[:, :n] = x >> 2
        step = memoryview(self.steps)
        for j in range(len(order)):
            if size[j] <= shared:
                break
            rest = s[first[j] + shared : first[j] + size[j]].tolist()
            for k in range(len(self.langs)):
                p, n = int(at[k, j]), 0
                for c in rest:
                    x = step[p + c]
                    n += x & 3
                    p = x >> 2
                counts[k, j] += n
                at[k, j] = p
        out = np.empty((len(texts), len(self.langs)))
        out[order] = ((counts + (at != roots)) * np.array(self.price)[:, None]).T
        return out / np.maximum(1, ends - starts)[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        told = [i for i, t in enumerate(texts) if self.langs and t and any(map(str.isalpha, t))]
        lang, score = [UNDECIDED] * len(texts), [0.0] * len(texts)
        if told:
            c = self.costs([texts[i] for i in told])
            best = c.argmin(1)  # of equals the first, in order of their names
            low = c[np.arange(len(told)), best]
            c[np.arange(len(told)), best] = np.inf
            second = c.min(1) if len(self.langs) > 1 else np.full(len(told), np.inf)
            sure = np.where(np.isinf(second), 1.0, second / np.maximum(low + second, 1e-12))
            for i, b, x in zip(told, best, sure, strict=True):
                lang[i], score[i] = self.langs[b], float(x)
        return lang, score


def labelled_samples(docs: DataFrame, train: Column, rows: int, chars: int) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """For each non-null lang, the whole texts of so many rows: those of chars characters at most whose ids hash lowest; if they are too few, the shortest longer ones."""
    told = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull())
    long = F.greatest(F.lit(0), F.length("text") - chars).alias("long")
    s = told.select("lang", long, F.xxhash64("doc_id").alias("h"), "doc_id", F.xxhash64("text").alias("th"), F.when(F.length("text") <= chars, F.col("text")).alias("text"))
    w = Window.partitionBy("lang").orderBy("long", "h", "doc_id", "th")
    got = s.withColumn("n", F.row_number().over(w)).where(F.col("n") <= rows).select("lang", "n", "h", "th", "text").collect()  # rows * languages at most
    out: dict[str, list[tuple[int, str]]] = {}
    far: dict[tuple[str, int, int], int] = {}
    for r in got:
        if r["text"] is None:
            far[r["lang"], r["h"], r["th"]] = r["n"]
        else:
            out.setdefault(r["lang"], []).append((r["n"], r["text"]))
    if far:
        keys = F.broadcast(docs.sparkSession.createDataFrame(list(far), "lang string, h long, th long"))
        for r in told.select("lang", F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("th"), "text").join(keys, ["lang", "h", "th"]).dropDuplicates(["lang", "h", "th"]).collect():
            out.setdefault(r["lang"], []).append((far[r["lang"], r["h"], r["th"]], r["text"]))
    return tuple((k, tuple(t for _, t in sorted(v))) for k, v in sorted(out.items()))


def identify(docs: DataFrame, train: Column | None = None, rows: int = 48, chars: int = 768, carry: bool = False) -> DataFrame:
    """doc_id, lang_pred and score (0 to 1) of each row of docs (doc_id, text, lang).

    Each language's suffix automaton is built of the whole texts of a bounded sample of its labelled rows among train
    (null: all rows): so many rows, of chars characters at most where there are enough of these. A whole text is parsed
    greedily, from its start to its end, into the longest phrases that a language's sample holds; phrases are counted,
    weighted by the bits that name a place in the sample. The language with the fewest bits wins, of equals the first by
    name; the score is the runner-up's share of both costs. A null text, one without letters (Unicode's), or no labelled
    rows at all: und with score 0. Repeated rows get equal results; empty tables give no rows; other columns are left
    out, or carried along before lang_pred and score (carry; own columns of these names are replaced). No shuffle of
    texts; the samples go to the driver, and the automata from there to the workers, which drop them with the job.
    """
    spark = docs.sparkSession
    batches_of(spark)
    parser = spark.sparkContext.broadcast(Parser(labelled_samples(docs.select("doc_id", "text", "lang"), F.lit(True) if train is None else train, rows, chars)))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            lang, score = parser.value.predict(b.column(b.schema.get_field_index("text")).to_pylist())
            kept = [(c, n) for c, n in zip(b.columns, b.schema.names, strict=True) if carry or n == "doc_id"]
            yield pa.RecordBatch.from_arrays([*(c for c, _ in kept), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*(n for _, n in kept), "lang_pred", "score"])

    d = docs.drop("lang_pred", "score") if carry else docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = T.StructType([*(x for x in d.schema.fields if carry or x.name == "doc_id"), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return d.mapInArrow(tidy(run), out)
