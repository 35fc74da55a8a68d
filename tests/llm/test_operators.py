"""The operators against brute force, the libraries, SQL and held-out labels; and their edge cases."""

import hashlib
import math
import os
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import decontaminate, html_text, language, mixing, neighbours, piece_bpe, queries, simhash, suffix_dedup, toxicity, url_filter
from tidemark.llm.common import CLEANUP, cut, remainder
from tidemark.llm.components import components

DOCS = "doc_id long, text string, lang string, extra string, th long"
EDGE = [(1, None, None, "x", 1), (2, "", "en", "x", 1), (3, "word", "en", "x", 1), (3, "word", "en", "x", 1), (None, "no id here", None, None, None), (5, "é" * 3000, "fr", "x", 1), (6, "12 34 !?", "en", "x", 1), (7, "the cat sat on the mat and slept " * 60, "en", "x", 1)]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def covered(rows, size):
    seen = Counter()
    for _, t in rows:
        b = (t or "").encode()
        seen.update(b[s : s + size] for s in range(len(b) - size + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - size + 1):
            if seen[b[s : s + size]] > 1:
                gone[s : s + size] = b"\1" * size
        out.append((i, len(b), hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest(), sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))))
    return sorted(out, key=str)


def removed(df):
    return sorted(((r["doc_id"], r["n_bytes"], hashlib.sha256(bytes(r["kept"])).hexdigest(), len(r["spans"])) for r in suffix_dedup.remove_repeats(df).collect()), key=str)


@pytest.mark.parametrize("together", [1000, 1])
def test_op1_against_brute_force(spark, monkeypatch, together):
    rng = random.Random(3)
    base = ["".join(rng.choice("ab \n") for _ in range(900)) for _ in range(5)]
    rows = []
    for i in range(60):
        t = rng.choice(base)[rng.randint(0, 300) : rng.randint(500, 900)]
        j = rng.randint(0, len(t))
        rows.append((i, t[:j] + rng.choice(["X", "zz", "é", ""]) + t[j:] + "tail" * rng.choice([0, 0, 150])))
    rows += [(500, "a" * 1000), (501, None), (502, ""), (503, "a" * 399), (504, "ab" * 700), (505, "same " * 81 + "x"), (505, "same " * 81 + "x")]
    spans = suffix_dedup.repeated_spans
    monkeypatch.setattr(suffix_dedup, "repeated_spans", lambda d, size: spans(d, size, 100, together))
    assert removed(spark.createDataFrame(rows, "doc_id long, text string")) == covered(rows, 400)


def test_op1_pieces_and_collisions(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    raw = bytes(random.Random(1).choice(b"ab") for _ in range(1500))
    got = list(suffix_dedup.runs(raw, 400, 100))
    assert [s for lo, n, _ in got for s in range(lo, lo + n)] == list(range(1101)) and all(lo + n - 1 <= a <= lo + 300 for lo, n, a in got)
    a, b = suffix_dedup.Text(b"abcdef"), suffix_dedup.Text(b"abcxef")
    b.hashes = a.hashes  # all hashes collide: the texts decide
    assert suffix_dedup.common(a, b) == 3


def test_op1_passages_against_brute_force(spark):
    """Runs of so many words that also stand elsewhere, whatever white space parts them; repeated rows and null ids too."""
    rng = random.Random(4)
    rows = [(i if i % 9 else None, "".join(rng.choice("ab") + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(rng.randint(0, 60)))) for i in range(40)]
    rows += [rows[3], (100, None), (101, ""), (102, "a " * 30)]
    size = 7
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + size]) for w in words for i in range(len(w) - size + 1))
    want = []
    for (i, t), w in zip(rows, words, strict=True):
        in_ = [seen[tuple(w[j : j + size])] > 1 for j in range(len(w) - size + 1)]
        hit = [any(in_[max(0, k - size + 1) : k + 1]) for k in range(len(w))]
        # two runs that touch without sharing a word stay two
        runs, end = 0, -1
        for j, x in enumerate(in_):
            if x:
                runs, end = runs + (j > end), j + size - 1
        want.append((i, sum(hit), runs))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    spans = suffix_dedup.repeated_passages(d, size).collect()
    texts = {(i if i is not None else -(1 << 63), t): n for (i, t), n in zip(rows, range(len(rows)), strict=True)}
    found = {}
    for r in spans:
        found.setdefault((r["doc"], r["th"]), set()).add((r["s"], r["e"]))
    hashes = {(r["doc"], r["th"]): r["text"] for r in d.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"), F.xxhash64("text").alias("th"), "text").collect()}
    for key, text in hashes.items():
        i, n_words, n_runs = want[texts[key[0], text]]
        runs = suffix_dedup.joined(list(found.get(key, ())))
        assert (sum(len(text[s:e].split()) for s, e in runs) if text else 0, len(runs)) == (n_words, n_runs)
    told = suffix_dedup.remove_repeats(d, 10_000, words=size, told=True).collect()
    assert len(told) == len(rows) and sorted((str(r["doc_id"]), r["n_passages"]) for r in told) == sorted((str(i), n) for i, _, n in want)
    assert Counter((r["doc_id"], bytes(r["kept"]).decode()) for r in told) == Counter((i, t or "") for i, t in rows)


def test_op1_spans_join_over_a_whole_batch():
    """Lists of spans, null and empty ones too, are read without a row each in Python and joined text by text."""
    rng = random.Random(6)
    found = [None, [], *([{"s": (s := rng.randint(0, 60)), "e": s + rng.randint(1, 9)} for _ in range(rng.randint(0, 12))] for _ in range(50)), None]
    column = pa.array([None, *found], pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32())])))[1:]
    of, s, e = suffix_dedup.listed(column, "s", "e")
    got = {}
    for k, *run in zip(*(x.tolist() for x in suffix_dedup.joined_by(of, s, e)), strict=True):
        got.setdefault(k, []).append(tuple(run))
    for k, spans in enumerate(found):
        bytes_ = sorted({x for r in spans or [] for x in range(2 * r["s"], 2 * r["e"] + 1)})  # doubled: spans that touch are one
        want = [(x // 2, next(y for y in range(x, 999) if y + 1 not in bytes_) // 2) for x in bytes_ if x - 1 not in bytes_]
        assert got.get(k, []) == want
    assert suffix_dedup.joined([]) == [] and suffix_dedup.joined([(5, 9), (1, 5), (11, 12)]) == [(1, 9), (11, 12)]


def test_op1_edges(spark, edge, empty):
    assert len(removed(edge)) == len(EDGE) and removed(empty) == []
    t = suffix_dedup.remove_repeats(edge, as_text=True)
    assert t.columns == [*edge.columns, "spans"] and t.where("doc_id = 5").first()["text"] == "" and t.where("extra is null").count() == 1


def test_cut_frees_its_shuffles(spark, monkeypatch):
    """A table's shuffles leave the disk when it is written, not with the driver's garbage; it can be cut again, and the session's setting stays."""
    dirs = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    shuffles = lambda: {x for top in dirs for _, _, names in os.walk(top) for x in names if x.startswith("shuffle_")}
    before = shuffles()
    df = spark.range(20_000).groupBy((F.col("id") % 1000).alias("k")).count()
    tables = [cut(df, "counts") for _ in range(2)]
    until = time.time() + 10
    while shuffles() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffles() - before and [t.agg(F.sum("count")).first()[0] for t in tables] == [20_000] * 2
    assert spark.conf.get(CLEANUP, None) is None
    spark.conf.set(CLEANUP, "false")
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        cut(df, "counts")
    assert spark.conf.get(CLEANUP) == "false"
    spark.conf.unset(CLEANUP)


def test_op2(spark, docs):
    some = docs.select("doc_id", "text").union(spark.createDataFrame([(-1, None), (-2, ""), (-3, "brandnewword xyz")], "doc_id long, text string"))
    got = {r["doc_id"]: r for r in mixing.score(some, remainder("doc_id", 7) != 2, mixing.Setting(sample=2000)).collect()}
    words = {r["doc_id"]: [*re.findall(rb"[^\x20\x09-\x0D]+", (r["text"] or "").encode().lower()), None] for r in some.collect()}
    c = Counter(w for i, ws in words.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in words.items():
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(ws), sum(c[w] > 0 for w in ws), n, zlib.crc32(str(i).encode()) % 7 == 2)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9) and r["score"] < 0
    held = [r for r in got.values() if r["held_out"]]
    bits = -sum(r["score"] for r in held) / math.log10(2) / sum(len(w or b"") + 1 for r in held for w in words[r["doc_id"]])
    assert bits < 4


def test_op2_is_a_probability():
    """The bytes after any beginning share out all of its probability."""
    s = mixing.Setting(bits=(8, 8, 8, 8))
    rng = np.random.default_rng(0)
    m = mixing.Model(mixing.predictors([rng.integers(0, 9, (256, 2)).astype(np.float32) for _ in range(mixing.N)]), s)
    of, slots, node, bit = mixing.events([b"a" + bytes([x]) for x in range(256)], s.bits)
    p = m.refining(m.mixed(*m.inputs(slots, bit)), node)
    last = np.tile(np.arange(16) >= 8, 256)
    assert math.isclose(np.exp(np.bincount(of[last], np.log(np.where(bit == 1, p, 1 - p))[last])).sum(), 1, rel_tol=1e-4)


def test_op2_edges(edge, empty):
    got = mixing.score(edge, F.lit(True), mixing.Setting(sample=100)).collect()
    assert len(got) == len(EDGE) and {r["n_tokens"] for r in got if r["doc_id"] in (1, 2)} == {1}
    assert mixing.score(edge, F.lit(False)).agg(F.max("n_known")).first()[0] == 0
    assert mixing.score(empty, F.lit(True)).count() == 0


def brute_rule(url, rules):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), m[2]) if m else ("", "")
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fit)[1], max(fit)[2]) if fit else (host, path, None, "allow")


def test_op3(spark):
    urls = [None, "", "no scheme", "http://", "http://COM/en/", "x://a.com/en/1?q#f", "http://example.com/en/7", "http://b.example.com/en/77", "http://notexample.net/de/8", "http://m.example.net/de/80#x", "http://example.net?/de/8", "http://com", "a://b://c.com/en/", "http://é.org/es/", "http://www.example.com/en/8" + "x" * 5000, "http://a.com/en/\nb"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls + urls[-3:])], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages, spark.createDataFrame(queries.URL_RULES, url_filter.RULES)).collect()}
    assert got == {i: brute_rule(u, queries.URL_RULES) for i, u in enumerate(urls + urls[-3:])}
    none = url_filter.filter_urls(pages, spark.createDataFrame([], url_filter.RULES))
    assert none.where("verdict != 'allow' or rule is not null").count() == 0 and none.count() == len(urls) + 3
    assert url_filter.filter_urls(pages.limit(0), spark.createDataFrame(queries.URL_RULES, url_filter.RULES)).count() == 0


def test_op4(spark, sf, edge, empty):
    rng = random.Random(0)
    words = ["".join(rng.choice("aeinrstlo") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    bad = ["zorgblat", "quuxfrum", "blixnark", "vromptix"]
    rows = []
    for i in range(900):
        w = rng.choices(words, k=rng.randint(20, 120))
        toxic = i % 6 == 0
        for _ in range(3 * toxic):
            w[rng.randrange(len(w))] = rng.choice(bad)
        rows.append((i, " ".join(w), int(toxic)))
    d = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score_texts(d, labels, remainder("doc_id", 5) != 0).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum(got[r[0]]["predicted"] == r[2] for r in held) / len(held) > 0.97
    assert all(0 <= x["score"] <= 1 and x["predicted"] == int(x["score"] >= 0.5) for x in got.values())
    assert toxicity.score_texts(edge, labels, F.lit(True)).count() == len(EDGE)
    none = labels.limit(0)
    assert {r["predicted"] for r in toxicity.score_texts(edge, labels.where("toxic = 1").join(d.limit(0), "doc_id", "left_anti"), F.lit(True)).collect()} <= {0, 1}
    assert toxicity.score_texts(edge, none, F.lit(True)).agg(F.max("score")).first()[0] == 0 and toxicity.score_texts(empty, none, F.lit(True)).count() == 0


def test_op4_windows_by_dictionaries():
    """The dictionaries are the trainer's, the toxic one holds its words in their frames, and savings are differences of compressed lengths."""
    rng = random.Random(1)
    names = ["".join(rng.choice("aeinrstlo") for _ in range(rng.randint(4, 9))).encode() for _ in range(2000)]
    bad = [b"zorgblat", b"quuxfrum", b"blixnark"]
    texts = [tuple(sorted(set(rng.choices(names, k=80)) | set(rng.sample(bad, 2) if i % 4 == 0 else []))) for i in range(800)]
    o, t = toxicity.dictionaries(texts[::4], [x for i, x in enumerate(texts) if i % 4], toxicity.Setting())
    assert all(toxicity.AROUND[-6:] + b in t and b not in o for b in bad) and o.startswith(b"\x37\xa4\x30\xec") and t.startswith(b"\x37\xa4\x30\xec")
    gains = toxicity.savings(o, t)
    for w in [*bad, *names[:200]]:
        raw = toxicity.AROUND + w + toxicity.AROUND
        want = [len(toxicity.coder(c).compress(raw)) for c in (o, t)]
        assert gains[w] == want[0] - want[1]
    assert min(gains[b] for b in bad) >= 3 and sum(gains[w] >= 3 for w in names) < 0.02 * len(names)
    g = [gains[w] for w in toxicity.words("Zorgblat, " + names[0].decode())]
    assert toxicity.features("Zorgblat, " + names[0].decode(), gains)[:2] == [min(6.0, max(0.0, x)) for x in sorted(g, reverse=True)]


@pytest.fixture(scope="module")
def model():
    return piece_bpe.model_bytes(public_tokenizers.path("piece_bpe_32k.model"))


def test_op5(model, docs, edge, empty):
    ours, theirs = piece_bpe.Pieces(model, 50), sentencepiece.SentencePieceProcessor(model_proto=model)
    rng = random.Random(2)
    texts = ["", " ", "▁", "  a", "a" * 2000, "the" * 300, "日本語の文章" * 20, "x\n\ny \n", "\x00\ufffd😀"] + ["".join(rng.choice("aeinrst hlo▁ \n\tTHE日é😀\x00.,!012\u3000") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    for t in texts:
        ids = theirs.encode(t)
        assert ours.encode(t) == ids and ours.decode(ids) == theirs.decode(ids)
    for r in piece_bpe.encode_texts(docs.limit(40), model).collect():
        assert r["n_tokens"] == len(r["ids"]) and r["decoded"] == theirs.decode(r["ids"])
    got = {r["doc_id"]: r for r in piece_bpe.encode_texts(edge, model, digests=True).collect()}
    assert got[1] == got[1] and got[1]["n_tokens"] == 0 and got[1]["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    assert piece_bpe.encode_texts(empty, model).count() == 0
    with pytest.raises(ValueError, match="larger"):
        piece_bpe.model_bytes(public_tokenizers.path("piece_bpe_32k.model"), 10)


def test_op6(docs, edge, empty):
    def fingerprint(t):
        w = re.findall(rb"[^\x20\x09-\x0D]+", t.encode().translate(simhash.LOWER))
        if not w:
            return 0
        h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 3]), 42) for i in range(max(1, len(w) - 2))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    rows = docs.limit(120).collect()
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs.limit(120)).collect()}
    f = {r["doc_id"]: fingerprint(r["text"]) for r in rows}
    assert all(int(got[i]["fingerprint"], 16) == x for i, x in f.items())
    low = {i: i for i in f}
    for _ in f:
        new = {i: min(low[j] for j in f if (f[i] ^ f[j]).bit_count() <= 3) for i in f}
        if new == low:
            break
        low = new
    assert all(got[i]["component_id"] == x for i, x in low.items())
    e = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(edge).collect()}
    assert e[1] == e[2] == 1 and simhash.near_duplicates(empty).count() == 0
    with pytest.raises(ValueError):
        simhash.near_duplicates(edge, 4)


def test_op6_keys_lose_no_link():
    rng = np.random.default_rng(0)
    f = rng.integers(0, 2**63, 1500, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, 1500, dtype=np.uint64)
    g = f.copy()
    for i in range(len(g)):
        for b in rng.choice(64, rng.integers(0, 4), replace=False):
            g[i] ^= np.uint64(1) << np.uint64(b)
    own, near = [set() for _ in f], [set() for _ in f]
    for of, k, mine in simhash.keys(f):
        if mine:
            for a, b in zip(of, k, strict=True):
                own[a].add(int(b))
    for of, k, mine in simhash.keys(g):
        if not mine:
            for a, b in zip(of, k, strict=True):
                near[a].add(int(b))
    assert all(a & b for a, b in zip(own, near, strict=True))


def test_components(spark):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 160)] + [(rng.randint(200, 400), rng.randint(200, 400)) for _ in range(120)] + [(7, 7), (None, 3)]
    root = {x: x for e in edges for x in e if x is not None}
    for _ in range(500):
        for a, b in edges:
            if a is not None and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: v for k, v in root.items() if k in got} and len(got) == len({x for a, b in edges if a is not None and a != b for x in (a, b)})
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_op7(docs, edge, empty):
    got = language.identify(docs, remainder("doc_id", 3) != 1).withColumn("held", remainder("doc_id", 3) == 1)
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").where("held").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.95 and all(0 <= r["score"] <= 1 for r in rows)
    e = {r["doc_id"]: r["lang_pred"] for r in language.identify(edge).collect()}
    assert e[1] == e[2] == e[6] == "und" and e[7] == "en"
    assert {r["lang_pred"] for r in language.identify(edge, F.lit(False)).collect()} == {"und"} and language.identify(empty).count() == 0
    kept = language.identify(edge, carry=True)
    assert kept.columns == [*edge.columns, "lang_pred", "score"] and kept.count() == len(EDGE)


def test_op7_letters_and_long_texts(spark):
    """Fractions and raised digits aren't letters; a long text's parse is one, whatever stands in its batch."""
    rows = [(i, t, lang, "x", 1) for i, (t, lang) in enumerate([("the cat sat on the mat", "en"), ("le chat est assis ici", "fr"), ("\xbd \xb2 12", None), ("\u4e2d", None)] + [("the mat sat " * 900, None)] * 40)]
    got = {r["doc_id"]: r["lang_pred"] for r in language.identify(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[2] == "und" and got[3] != "und" and got[4] == got[43] == "en"
    p = language.Parser((("a", ("the cat sat",)), ("b", ("le chat",))))
    text = "the cat le sat cha " * 300
    alone = p.costs([text])[0]
    assert all((p.costs([text, *["the cat"] * k, text[:4000]])[0] == alone).all() for k in (0, 40, 100))


def test_op7_samples_are_whole_texts(spark):
    rows = [(i, "ab " * n, "en", "x", 1) for i, n in enumerate((1, 2, 3, 300, 200))]
    got = language.labelled_samples(spark.createDataFrame(rows, DOCS).select("doc_id", "text", "lang"), F.lit(True), 4, 20)
    assert sorted(map(len, got[0][1])) == [3, 6, 9, 600]


def test_op7_counts_phrases():
    samples = (("a", ("the cat sat", "on a mat")), ("b", ("le chat noir", "est ici")))
    p = language.Parser(samples)
    text = "the chat sat on ici x the cat"
    for k, (_, ts) in enumerate(samples):
        i = n = 0
        while i < len(text):
            j = i + 1
            while j <= len(text) and any(text[i:j] in t for t in ts):
                j += 1
            i, n = max(j - 1, i + 1), n + 1
        assert round(p.costs([text])[0][k] * len(text) / p.price[k]) == n


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<nav><a>m</a></nav><article><h1>T</h1><p>One &amp; two&nbsp;x.<br>y<aside>ad</aside></p><p>De.</p><div class=comments><p>First!</div></article><footer>f</footer>", "T\n\nOne & two x. y\n\nDe."),
        ("<nav><a>x</a><article><p>Not closed</p></article>", "Not closed"),
        ("<article><script>var t='</p>';</script><style>p{}</style><p>a<b>b</b> c\n d</p><form>f<input></form></article>", "ab c d"),
        ("<article><p><b>x<br><p>y</article>", "x\n\ny"),
        ("<main><div id='cookie-notice'>c</div><p>z</p></main>", "z"),
        ("", ""), (None, ""), ("<", ""), ("<!-- <article>no</article> -->", ""),
    ],
)
def test_op8(page, want):
    assert html_text.main_text(page) == want


def test_op8_two_passes_against_plain_search():
    """Labels against a plain search for the nearest decided blocks; stop words, lengths and links decide, in articles too."""
    rng = random.Random(2)
    rules = html_text.Rules()
    for _ in range(300):
        found = [html_text.Block(" ".join(rng.choices(["the", "of", "and", "zork", "blim"], k=rng.choice([2, 8, 30, 80]))), 0, rng.choice(["open", "open", "away"]), rng.random() < 0.2) for _ in range(rng.randint(1, 12))]
        for b in found:
            b.linked = rng.choice([0, 0, 0, len(b.text) // 2])
        first = [html_text.first_pass(b, rules) for b in found]
        html_text.classify(found, rules)
        for i, b in enumerate(found):
            if first[i] in ("good", "bad"):
                assert b.label == first[i]
                continue
            before = next((x for x in first[:i][::-1] if x in ("good", "bad")), "bad")
            after = next((x for x in first[i + 1 :] if x in ("good", "bad")), "bad")
            assert b.label == (before if before == after else "good" if first[i] == "near" or (b.heading and after == "good") else "bad")


def test_op8_features_decide(monkeypatch):
    body = "the cat is in the house and of the dog " * 8
    odd = "zork blim quux frum " * 15
    links = "<ul><li><a href=x>one more long link</a></li><li><a href=y>and another link</a></li></ul>"
    page = f"<div><p>{body}</p><p>{odd}</p>{links}</div>"
    assert html_text.main_text(page) == body.strip()
    article = f"<article><p>{body}</p>{links}<p>Short.</p>{links}<p>{odd}</p></article>"
    assert html_text.main_text(article) == f"{body.strip()}\n\n{odd.strip()}"  # links go, and what stands among them
    monkeypatch.setattr(html_text, "STOP", frozenset())
    assert html_text.main_text(page) == "" and html_text.main_text(article) == f"{body.strip()}\n\n{odd.strip()}"


@pytest.mark.parametrize("part", ["<a ", "<a \"", "<a '\">", "<div>", "<script ", "<div class=\"", "<article><nav>", "<p>x</nav>", "</b><b>", "<!--"])
def test_op8_hostile_pages_take_linear_time(part):
    page = part * (400_000 // len(part))
    began = time.perf_counter()
    html_text.main_text(page)
    assert time.perf_counter() - began < 10


def test_op8_without_article(spark):
    body = "the cat is in the house and of the dog " * 8
    page = f"<p>short</p><p>{body}</p><p>between</p><p>{body}</p><div><a href=x>link link</a></div><p>end</p>"
    assert html_text.main_text(page) == f"{body.strip()}\n\nbetween\n\n{body.strip()}"
    rows = spark.createDataFrame([(1, None, None, "x"), (1, "u", page, "x")], "page_id long, url string, html string, text string")
    assert sorted(r["n_chars"] for r in html_text.extract(rows).collect())[0] == 0 and html_text.extract(rows.limit(0)).count() == 0


def test_op9(spark, edge, empty):
    rng = random.Random(5)
    words = ["w%d" % i for i in range(500)]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for i in range(25)] + [(90, None), (91, ""), (92, "..."), (3, "repeated id here with seven words")]
    rows = []
    for i in range(60):
        w = rng.choices(words, k=rng.randint(3, 400))
        if i % 3 == 0:
            item = rng.choice(items[:25])[1].split()
            if i % 2:
                item = item[: max(1, int(len(item) * 0.9))]
            at = rng.randrange(len(w))
            w[at:at] = [x.upper() + "," for x in item]
        rows.append((i, " ".join(w), "x"))
    rows += [(0, rows[0][1], "x"), (1000, None, "x"), (1001, "", "x")]

    def shingles(t, m):
        w = [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
        return {tuple(w[i : i + m]) for i in range(len(w) - m + 1)}

    want = set()
    for d, t, _ in rows:
        for i, q in items:
            n = len([x for x in re.split(r"[\W_]+", (q or "").lower()) if x])
            s = shingles(q, min(5, n)) if n else set()
            if s and len(s & shingles(t, min(5, n))) >= 0.8 * len(s) - 1e-9:
                want.add((d, i))
    got = decontaminate.contaminated(spark.createDataFrame(rows, "doc_id long, text string, item_id string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == want and want
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.contaminated(empty, bench).count() == 0 and decontaminate.contaminated(edge, bench.limit(0)).count() == 0


def brute_nearest(rows, k):
    v = {}
    for i, e in rows:
        if i is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e) and len(e) == 8:
            v[i] = min(v.get(i, e), e)
    out = {}
    for q in v:
        if q % 20 == 0:
            s = sorted((-sum(float(np.float32(a)) * float(np.float32(b)) for a, b in zip(v[q], v[i], strict=True)), i) for i in v if i != q)
            out[q] = [i for _, i in s[:k]]
    return out


def test_op10_small(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(150)] + [(i, [1.0] * 8) for i in range(200, 260)]
    rows += [(300, None), (301, [0.0] * 8), (302, [float("nan")] * 8), (303, [1.0, None] * 4), (304, [1.0] * 7), (None, [1.0] * 8), (0, rows[0][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int")
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    assert got == brute_nearest(rows, 20)
    few = neighbours.nearest(df.where("vec_id in (0, 1, 2)"), F.col("vec_id") % 20 == 0)
    assert few.count() == 2 and neighbours.nearest(df.limit(0), F.lit(True)).count() == 0


def test_op10_recall(spark):
    x = np.random.default_rng(0).normal(size=(1500, 16)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    s = neighbours.Setting(leaf=128, beam=80, values=512 * 16)
    got = {}
    for r in neighbours.nearest(df, F.col("vec_id") % 20 == 0, 20, s).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hit = 0
    for q, found in got.items():
        d = x.astype(float) @ x[q].astype(float)
        d[q] = -np.inf
        hit += len(found & set(np.argsort(-d)[:20].tolist()))
    assert hit / (20 * len(got)) >= 0.9 and len(got) == 75


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, sf, name):
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        c.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    df = queries.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    want = c.execute(f"select {', '.join(cols)} from ({queries.SQL[name]})").fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in df.select(*cols).collect()) and want


def test_pipeline(spark, sf, docs):
    extra = spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "12 34", "en", "s", 5)], docs.schema)
    d = docs.union(extra).union(docs.limit(1))
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, d, sf)
        assert got.columns == docs.columns, name
        d = cut(got, "stage")
        sizes.append(d.count())
    assert sizes[0] == docs.count() + 1 and sizes == sorted(sizes, reverse=True) and sizes[1] < sizes[0] and sizes[3] < sizes[2]
    last = corpus_pipeline.STAGES[-1][1](spark, d, sf)
    assert last.count() == sizes[-1] and last.agg(F.min("n_tokens")).first()[0] > 0
    assert d.groupBy("doc_id").count().where("count > 1").count() == 0


def brute_contexts(counted):
    """Counts of the two bits after each context: its bytes before, of an order or all (0), the bits so far of its byte."""
    c = Counter()
    for u, n in counted.items():
        for at in range(1, len(u)):
            bits = f"{u[at]:08b}"
            for o in (*mixing.ORDERS, 0):
                before = u[:at] if o == 0 else (u[max(0, at - o) : at], at < o)
                for b in range(8):
                    c[(o, before, bits[:b], bits[b])] += n
    return c


def test_op2_counts_are_exact_over_parts(spark):
    """Contexts never share counts, however many units there are and wherever the ranges of units end."""
    rng = random.Random(3)
    counted = {bytes([10]) + "".join(rng.choices("abcé", k=rng.randint(1, 6))).encode() + b" ": rng.randint(0, 5) for _ in range(600)}
    rows = spark.createDataFrame([(bytearray(u), n) for u, n in counted.items()], "unit binary, n long").repartitionByRange(7, "unit").withColumn("part", F.spark_partition_id())
    rows = cut(rows, "parts")
    given = mixing.shared_contexts(rows, 7).toArrow()
    want, seen = brute_contexts(counted), 0
    for part in {r["part"] for r in rows.collect()}:
        mine = given.filter(np.array(given.column("part")) == part)
        us, _, known = mixing.known_of(rows.where(F.col("part") == part).toArrow(), mine)
        of, slots, _, bit = mixing.events(us, known, True)
        place = np.arange(len(of)) - np.searchsorted(of, of)
        for k, o in enumerate((*mixing.ORDERS, 0)):
            for i in range(len(of)):
                u, at, b = us[of[i]], 1 + place[i] // 8, place[i] % 8
                before = u[:at] if o == 0 else (u[max(0, at - o) : at], at < o)
                bits = f"{u[at]:08b}"
                assert list(known.counts[slots[k][i]]) == [want[(o, before, bits[:b], x)] for x in "01"]
                seen += 1
    assert seen == sum(8 * (len(u) - 1) for u in counted) * mixing.N


def test_op2_chunks_keep_texts_and_counts():
    """Places lead back to the texts' units and counts to the training texts', wherever chunks end."""
    texts = ["a b c", None, "", "b b d e f", "\t\n x", "é " * 50, "a b c"] * 90
    train = [i % 3 > 0 for i in range(len(texts))]
    rows = pa.record_batch([pa.array(range(len(texts))), pa.array(texts), pa.array(train)], names=["doc_id", "text", "train"])
    got = pa.Table.from_batches(mixing._chunks(iter([rows]), 4)).to_pylist()
    names = {(r["chunk"], r["place"]): r["unit"] for r in got if r["unit"] is not None}
    for r in (r for r in got if r["places"] is not None):
        assert [names[r["chunk"], x] for x in mixing.unpacked(r["places"])] == mixing.units(texts[r["doc_id"]]) and r["train"] == train[r["doc_id"]]
    want, n = Counter(u for x, t in zip(texts, train, strict=True) if t for u in mixing.units(x)), Counter()
    for r in got:
        n[r["unit"]] += r["n"] or 0
    assert len({k for k, _ in names}) > 1 and {u: k for u, k in n.items() if k} == want


def test_op2_learns_from_all_units():
    """Every training unit tunes the mixer and the refining table, as often as it occurs; contexts reach 4 bytes and over a unit's border."""
    assert mixing.Setting().sample is None and 4 in mixing.ORDERS
    assert mixing.units("a. b")[1] != mixing.units("a b")[1]
    us = [bytes([10]) + f"w{i} ".encode() for i in range(3000)]
    n = np.arange(1, 3001)
    (key, sym, c) = (np.concatenate(x) for x in zip(*mixing.own_contexts(us, n, True), *mixing.own_contexts(us, n, False), strict=True))
    told = mixing.Model(([], np.zeros(0)), mixing.Setting()).learn(us, n.astype(float), mixing.Known(key, sym, c))
    bits = sum(8 * (len(u) - 1) * int(k) for u, k in zip(us, n, strict=True))
    assert math.isclose(told[0].sum(), bits, rel_tol=1e-6) and math.isclose(told[2].sum(), bits, rel_tol=1e-6)


def test_op2_shared_beginnings_are_predicted_once(monkeypatch):
    """Units that follow each other share the bits of their common beginnings; probabilities are those of each unit alone."""
    rng = random.Random(5)
    us = sorted({b"\n" + "".join(rng.choices("abé", k=rng.randint(0, 7))).encode() + b" " for _ in range(700)})
    long = [b"\n" + b"x" * 40 + x + b" " for x in (b"", b"y", b"yz")]
    n = np.array([rng.randint(0, 5) for _ in us + long])
    known = mixing.Known(*(np.concatenate(x) for x in zip(*mixing.own_contexts(us + long, n, True), *mixing.own_contexts(us + long, n, False), strict=True)))
    told, level = mixing.predictors([known.counts])
    weights = np.random.default_rng(1).random(mixing.Model(([], np.zeros(0)), mixing.Setting()).weights.shape, np.float32)
    m = mixing.Model((told * mixing.N, level), mixing.Setting(), weights)
    predicted, mixed = [], m.mixed
    monkeypatch.setattr(m, "mixed", lambda x, gate: predicted.append(len(gate)) or mixed(x, gate))
    m.log10(us, known)
    assert sum(predicted) == 8 * len({u[:k] for u in us for k in range(2, len(u) + 1)}) < 8 * sum(len(u) - 1 for u in us)
    for some in (us + long, rng.sample(us + long, len(us + long)), us[:1]):
        of, slots, node, bit = mixing.events(some, known, True)
        p = m.refining(m.mixed(*m.inputs(slots, bit)), node)
        assert np.allclose(m.log10(some, known), np.bincount(of, np.log10(np.where(bit == 1, p, 1 - p))), rtol=1e-5)
    assert len(m.log10([], known)) == 0


def test_op2_learning_seeks_shared_beginnings_once(monkeypatch):
    """Learning takes the bits of every unit with a weight, but looks up the contexts of a common beginning once."""
    us = [b"\n" + f"word{i:05d} ".encode() for i in range(900)]
    weight = np.arange(900) % 7.0
    known = mixing.Known(*(np.concatenate(x) for x in zip(*mixing.own_contexts(us, weight, True), *mixing.own_contexts(us, weight, False), strict=True)))
    sought, row = [], known.row
    monkeypatch.setattr(known, "row", lambda key, sym: sought.append(len(key)) or row(key, sym))
    told = mixing.Model(([], np.zeros(0)), mixing.Setting()).learn(us, weight, known)
    assert sum(sought) == mixing.N * len({u[:k] for u in us for k in range(2, len(u) + 1)})
    assert math.isclose(told[0].sum(), 8 * 10 * weight.sum(), rel_tol=1e-6) and math.isclose(told[2].sum(), told[0].sum(), rel_tol=1e-6)
    mine = np.flatnonzero(weight)
    alone = mixing.Model(([], np.zeros(0)), mixing.Setting()).learn([us[i] for i in mine], weight[mine], known)
    assert all(np.allclose(x, y, rtol=1e-6) for x, y in zip(told, alone, strict=True))


@pytest.mark.parametrize("limits", [{}, {"most": 30}, {"size": 3000}])
def test_op2_chunks_over_batches(limits):
    """A chunk lists each of its units once, however many batches it spans and wherever in them it ends."""
    rng = random.Random(8)
    texts = [rng.choice([None, "", " ", "a\t\tb", " ".join(rng.choices(["so", "So.", "é!", "x", "1"], k=9)) + rng.choice(" \n.")]) for _ in range(1500)]
    train = [rng.choice([True, False, None]) for _ in texts]
    rows = pa.record_batch([pa.array(range(1500)), pa.array(texts), pa.array(train)], names=["doc_id", "text", "train"])
    got = pa.Table.from_batches(mixing._chunks((rows.slice(i, 450) for i in range(0, 1500, 450)), **limits)).to_pylist()
    names = {(r["chunk"], r["place"]): r["unit"] for r in got if r["unit"] is not None}
    told = [r for r in got if r["places"] is not None]
    assert [r["doc_id"] for r in told] == list(range(1500)) and [r["train"] for r in told] == train
    assert all([names[r["chunk"], x] for x in mixing.unpacked(r["places"])] == mixing.units(texts[r["doc_id"]]) for r in told)
    assert len({(k, u) for (k, _), u in names.items()}) == len(names) and (len({k for k, _ in names}) > 1) == bool(limits)
    n = Counter()
    for r in got:
        n[r["unit"]] += r["n"] or 0
    assert +n == Counter(u for x, t in zip(texts, train, strict=True) if t for u in mixing.units(x))


def test_op2_order_of_close_keys():
    """Keys that differ only in their last byte keep their bytes apart."""
    key, sym = np.array([513, 512, 513, 512, 7], np.uint64), np.array([1, 9, 0, 2, 3])
    assert list(mixing.by_key(key, sym)) == [4, 3, 1, 2, 0]


def test_pipeline_near_copies(spark):
    """Texts of 5-word Jaccard 0.8 and more go, whatever their fingerprints; rows without an id are dropped for their own text only."""
    rng = random.Random(5)
    rows, i = [], 0
    for _ in range(40):
        w = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(120)]
        other = [*w]
        other[rng.randint(20, 100)] = "changed"  # 5 of 116 shingles differ: Jaccard .917
        other[rng.randint(0, 10)] = "too"
        rows += [(i, " ".join(w)), (i + 1, " ".join(other))]
        i += 2
    alone = " ".join("".join(rng.choices("klmnop", k=6)) for _ in range(60))
    rows += [(None, rows[0][1] + " end"), (None, alone), (0, alone + " and more of it " + " ".join("".join(rng.choices("qrst", k=6)) for _ in range(60)))]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in corpus_pipeline.simhash_dedup(spark, d, "").collect()]
    assert sorted(r[0] for r in got if r[0]) == list(range(2, 80, 2))
    assert {r[1] for r in got if not r[0]} == {rows[0][1], rows[-2][1], rows[-1][1]}


def test_near_copies_band_holds_no_texts():
    """A band's links are found, over the borders of batches, with its sets of shingles in memory but not its texts."""
    rng = random.Random(8)
    base = ["".join(rng.choices("абвгде", k=6)) for _ in range(1500)]
    texts = [" ".join([*base[:i], "changed", *base[i + 1 :]]) for i in range(400)]
    batches = [pa.RecordBatch.from_arrays([pa.array([7] * 20), pa.array(range(i, i + 20)), pa.array(texts[i : i + 20])], names=["key", "th", "text"]) for i in range(0, 400, 20)]
    alone = pa.RecordBatch.from_arrays([pa.array([7, 8, 8, 8]), pa.array([400, 0, 1, 401]), pa.array(["а б в", texts[0], texts[1], None])], names=["key", "th", "text"])
    list(simhash.band_links(iter([alone]), 0.8))  # imports
    tracemalloc.start()
    try:
        got = [list(zip(*b.to_pydict().values(), strict=True)) for b in simhash.band_links(iter([*batches, alone]), 0.8)]
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [len(x) for x in got] == [399, 1] and {i for x in got[0] for i in x} == set(range(400)) and set(got[1][0]) == {0, 1}
    assert most < sum(2 * len(t) for t in texts)


def test_pipeline_short_passages(spark):
    """Passages of 51 words go although shorter than 400 bytes; of 50 words they stay."""
    rng = random.Random(6)
    word = lambda k: " ".join("".join(rng.choices("abcdefgh", k=4)) for _ in range(k))
    long, short = word(51), word(50)
    rows = [(i, f"{word(30)} x{i} {p} y{i} {word(30)}") for i, p in enumerate((long, long, short, short))]
    got = {r["doc_id"]: r["text"] for r in corpus_pipeline.suffix_array_dedup(spark, spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_chars long"), "").collect()}
    assert len(long) < 400 and all((p in got[i]) == (p == short) for i, p in enumerate((long, long, short, short)))
    assert got[2] == rows[2][1] and got[0] == rows[0][1].replace(long, "")


def test_pipeline_contaminated_rows_only(spark, sf):
    """A contaminated row goes alone: clean rows with its id, or without an id like it, stay."""
    item = spark.read.parquet(f"{sf}/benchmark.parquet").where("length(text) > 100").first()["text"]
    rows = [(None, item), (None, "quite clean"), (1, item), (1, "clean as well")]
    got = corpus_pipeline.benchmark_decontamination(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf).collect()
    assert {tuple(r) for r in got} == {rows[1], rows[3]}

EMPTY_STAGES = [name for name, _ in corpus_pipeline.STAGES]


@pytest.mark.parametrize("name", EMPTY_STAGES)
def test_pipeline_stages_on_odd_tables(spark, sf, name):
    """Stages on an empty table and on null ids, empty texts, repeated rows and columns named like their own."""
    stage = dict(corpus_pipeline.STAGES)[name]
    kind = "doc_id long, text string, lang string, source string, n_chars long, th long, spans string, root string, key string"
    rows = [(1, "the cat sat on the mat", "en", "s", 22, 1, "x", "r", "k"), (1, "the cat sat on the mat", "en", "s", 22, 1, "x", "r", "k"), (None, "another text here", "en", None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None), (2, "", "en", "s", 0, 1, "x", "r", "k")]
    assert stage(spark, spark.createDataFrame([], kind), sf).count() == 0
    d = spark.createDataFrame(rows, kind)
    got = stage(spark, d, sf)
    assert got.count() == {"language_id": 3, "simhash_dedup": 3, "suffix_array_dedup": 3}.get(name, 5)
    if name != "sentencepiece":
        assert got.columns == d.columns and {r["spans"] for r in got.collect()} == {"x", None}
