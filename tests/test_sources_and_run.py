"""Sources, records, sinks and the whole run: files by path, failures by company, and what Python's own functions say."""

import json
import re
import unicodedata

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import lexicons as L
from tidemark import log
from tidemark.functions import text as X
from tidemark.operators import analytics as A
from tidemark.operators import keywords as K
from tidemark.operators import lines as C
from tidemark.operators import records as B
from tidemark.operators import sections as S
from tidemark.operators import validation as V
from tidemark.plans import disclosure
from tidemark.sources import tables

PDF = {b"good": ("fake", ["First page of text " * 40, "", "Third\r\npage " * 60]), b"thin": ("fake", ["12", ""]), b"empty": ("fake", [" ", ""])}


def parse(content):
    if content == b"none":
        return "fake", []
    if content not in PDF:
        raise ValueError("broken file")
    return PDF[content]


@pytest.fixture
def folder(tmp_path):
    for name, content in {"annual/a.pdf": b"good", "base/sub/b.pdf": b"thin", "base/c.txt": "Größe".encode("cp1252"), "annual/d.pdf": b"junk", "other/sub/b.pdf": b"good", "annual/f.pdf": b"empty", "annual/n.pdf": b"none"}.items():
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(content)
    return tmp_path


def test_report_paths_and_orchestration(spark, folder):
    bases = [f"{folder}/other/missing", f"{folder}/base", f"{folder}/other"]
    c = spark.createDataFrame([("a", "a.pdf"), ("b", "sub\\b.pdf"), ("c", f"{folder}/base/c.txt"), ("d", "d.pdf"), ("e", "nowhere/e.pdf"), ("f", "f.pdf"), ("g", None), ("n", "n.pdf")], "record_id string, report_path string")
    found = tables.files(spark, str(folder), "*")
    at = {r["record_id"]: r["path"] for r in tables.located(c, found, bases, f"{folder}/annual").collect()}
    assert at == {"a": f"{folder}/annual/a.pdf", "b": f"{folder}/base/sub/b.pdf", "c": f"{folder}/base/c.txt", "d": f"{folder}/annual/d.pdf", "e": f"{folder}/annual/e.pdf", "f": f"{folder}/annual/f.pdf", "g": None, "n": f"{folder}/annual/n.pdf"}
    got = {r["record_id"]: r for r in tables.company_reports(c, found, bases, f"{folder}/annual", parse).collect()}
    assert got["a"]["text"].startswith("First page") and "\n\nThird\npage" in got["a"]["text"] and got["a"]["error"] is None and not got["a"]["scanned"]
    assert got["b"]["text"] == "12" and got["b"]["scanned"] and got["b"]["error"] is None  # sparse native text stays
    assert got["c"]["text"] == "Größe" and got["c"]["parser"] == "text"
    assert got["d"]["error"] == "broken file" and "no such report" in got["e"]["error"] and "scanned" in got["f"]["error"] and got["n"]["error"] == "the file has no pages"
    assert "none given" in got["g"]["error"] and len(got) == 8


def test_pages(spark, folder):
    f = tables.files(spark, str(folder / "annual"), "*.pdf").select(tables.stem("path").alias("record_id"), "content")
    pages = tables.parsed(f, parse)
    assert {r["record_id"]: r["n_pages"] for r in tables.page_counts(pages).collect()} == {"a": 3, "d": 0, "f": 2, "n": 0}
    third = {r["record_id"]: (r["text"], r["error"]) for r in tables.page(pages, 3).collect()}
    assert third["a"][0].startswith("Third") and third["a"][1] is None and third["f"] == (None, "page 3 of 2")


def test_workbooks(spark, tmp_path):
    for name in ("b.xlsx", "~$b.xlsx", "a.xls", "c.txt"):
        (tmp_path / name).write_text("x")
    w = tables.workbooks(spark, [str(tmp_path)])
    assert [r["path"].rsplit("/", 1)[1] for r in w.collect()] == ["a.xls", "b.xlsx"] and A.latest(w).first()["latest"] is not None
    assert "content" not in w.columns


def test_master_keeps_the_first_whole_row(spark, tmp_path):
    head = "Company Name,Ticker,Industry,Year,Report Path,Source URL\n"
    (tmp_path / "m.csv").write_text(head + "Zed,ACM,IT,2024,z.pdf,https://z\nAlpha,acm,Auto,2024,a.pdf,https://a\n,,,,,\n")
    m = tables.company_master(tables.read_table(spark, str(tmp_path / "m.csv"))).collect()
    assert [(r["company_name"], r["industry"], r["report_path"], r["source_url"]) for r in m] == [("Zed", "IT", "z.pdf", "https://z")]


def test_dictionary_keeps_the_files_order(spark, tmp_path):
    (tmp_path / "d.csv").write_text("Category,Keyword\n" + "".join(f"C{i % 7},word{i}\n" for i in range(50)) + "C0,word0\n")
    e = tables.dictionary(tables.read_table(spark, str(tmp_path / "d.csv")))
    assert [r["keyword"] for r in e.orderBy("pos").collect()] == [f"word{i}" for i in range(50)]
    assert K.categories(e) == [f"C{i}" for i in range(7)] and K.keywords_of(e, " C1 ")[:2] == ["word1", "word8"] and K.keywords_of(e, "c1") == []


def test_records(spark):
    rows = spark.createDataFrame([("a", "Acme", "ACM", "IT", 2024, "a.pdf", "https://a", 51.5)], "record_id string, company_name string, ticker string, industry string, report_year int, report_path string, source_url string, disclosure_score double")
    j = B.to_json(rows)
    assert json.loads(j.first()["record"])["disclosure_score"] == 51.5
    back = B.from_json(j).first()
    assert (back["company_name"], back["report_year"], back["extracted_text"]) == ("Acme", 2024, None)
    bad = spark.createDataFrame([("x", '{"company_name": "A"}'), ("y", json.dumps(json.loads(j.first()["record"]) | {"odd": 1})), ("z", "no")], "record_id string, record string")
    errors = {r["record_id"]: r["error"] for r in B.from_json(bad, strict=False).collect()}
    assert errors["x"].startswith("missing fields: industry") and errors["y"] == "unknown fields: odd" and errors["z"] == "not a JSON object"
    with pytest.raises(PySparkException, match="unknown fields"):
        B.from_json(bad.where("record_id = 'y'")).collect()


def test_manual_counts_of_mappings(spark):
    d = spark.createDataFrame([('{"Acme": {"AI": 2, " ai ": "3"}, "Zed": {"Cloud": 0}}',), ('{"Acme": {"Cloud": 1}}',)], "counts string")
    assert sorted(map(tuple, V.mapping_counts(d).collect())) == [("Acme", "ai", 5), ("Acme", "cloud", 1), ("Zed", "cloud", 0)]
    with pytest.raises(PySparkException, match="mapping"):
        V.mapping_counts(spark.createDataFrame([("[1, 2]",)], "counts string")).collect()
    with pytest.raises(PySparkException, match="missing"):
        V.mapping_counts(spark.createDataFrame([('{" ": {"a": 1}}',)], "counts string")).collect()
    with pytest.raises(PySparkException, match="not a count"):
        V.mapping_counts(spark.createDataFrame([('{"A": {"a": 1.5}}',)], "counts string")).collect()
    flat = spark.createDataFrame([({"AI": 1, "ai ": 2},)], "counts map<string,int>")
    nested = spark.createDataFrame([({"x": {"AI": 1}, "y": {"AI": 4}},)], "counts map<string,map<string,int>>")
    assert [tuple(r) for r in V.flat_counts(flat).collect()] == [("ai", 3)] and [tuple(r) for r in V.flat_counts(nested).collect()] == [("ai", 5)]


def test_optional_validation(spark):
    auto = spark.createDataFrame([("a", "ai", 2), ("b", "ai", 1)], "company string, keyword string, n long")
    manual = spark.createDataFrame([("a", "ai", 1)], "company string, keyword string, n long")
    assert V.optional_report(auto, None) is None
    assert [(r["company"], r["tp"], r["fp"], r["fn"]) for r in V.optional_report(auto, manual).collect()] == [("a", 1, 1, 0)]


def test_enrich_takes_the_first(spark):
    d = spark.createDataFrame([("ACM",), ("ZED",)], "ticker string")
    look = spark.createDataFrame([("acm", None, 0), ("acm", "Zinc", 1), ("ACM", "Auto", 2)], "ticker string, industry string, o int").coalesce(1)
    for order in (None, "o"):
        assert sorted(map(tuple, A.enrich(d, look, order=order).collect())) == [("ACM", "Zinc"), ("ZED", "Not available")]


def test_headings_by_place_and_name(spark):
    f = spark.createDataFrame([("a", "AI", 0, 5, 0.9), ("a", "ML", 0, 5, 1.0), ("a", "AI", 9, 12, 0.5)], "record_id string, heading string, start long, end long, confidence double")
    assert sorted((r["start"], r["heading"]) for r in S.by_location(f).collect()) == [(0, "ML"), (9, "AI")]
    s = spark.createDataFrame([("a", "AI", 1, "about ai"), ("a", "Technology", 2, "about it")], "record_id string, name string, ord int, text string")
    assert S.named(s, "gen ai").first()["text"] == "about ai" and S.named(s, "no heading").count() == 0
    assert json.loads(S.as_json(s).first()["sections"]) == {"AI": "about ai", "Technology": "about it"}


def test_failures_stay_with_their_company(spark, monkeypatch, tmp_path):
    c = spark.createDataFrame([(x, x.upper(), x.upper(), "IT", 2024) for x in "abcde"], "record_id string, company_name string, ticker string, industry string, report_year int")
    r = spark.createDataFrame([("a", "Innovation\nartificial intelligence in all of our many plants and offices", None), ("b", "  ", None), ("c", "7\n\n 8 ", None), ("d", None, "broken file")], "record_id string, text string, error string")
    res = disclosure.analyse(c, r, K.default_entries(spark))
    assert {x["record_id"]: x["error"] for x in res.status.collect()} == {"a": None, "b": "the report has an empty text", "c": "the text is empty after cleaning", "d": "broken file", "e": "no report"}
    out = disclosure.readiness(res).first()
    assert out["scores"] == 1 and out["sections"] == 1 and out["markdown"] == 1
    disclosure.write(res, str(tmp_path / "out"))
    read = lambda kind: spark.read.text(f"{tmp_path}/out/{kind}/record_id=a", wholetext=True).first()["value"]
    assert read("extracted").startswith("Innovation\n") and json.loads(read("sections_json"))["Innovation"].startswith("Innovation") and read("reports").startswith("# A ")
    with pytest.raises(PySparkException, match="empty"):
        disclosure.write_texts(spark.createDataFrame([("a", " ")], "record_id string, text string"), str(tmp_path / "none"))
    assert C.attempted(lambda x: 1 / 0, "x") is None


def test_text_forms_against_python(spark, sf):
    """What SQL can't say: NFKC, acronyms and the table of contents, against Python's own functions."""
    d = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("record_id"), F.concat(F.lit("ai ① ﬁ iot r&d AIR it's "), "text").alias("text"))
    got = d.select("text", C.nfkc("text").alias("n"), X.acronyms("text").alias("a"), X.lower_but_acronyms("text").alias("l")).collect()
    names = sorted(L.ACRONYMS, key=lambda a: (-len(a), a))
    for r in got:
        assert r["n"] == unicodedata.normalize("NFKC", r["text"])
        want = r["text"]
        for a in names:
            want = re.sub(rf"(?<!\w){re.escape(a)}(?!\w)", a, want, flags=re.I)
        assert r["a"] == want
        assert r["l"].lower() == r["text"].lower()


def test_fuzzy_against_plain_search(spark):
    """Fuzzy headings and counts against difflib over every wording and run."""
    from difflib import SequenceMatcher

    lex = S.lexicon(spark)
    choices = [(r["pattern"], r["canonical"]) for r in lex.orderBy("place").collect()]
    forms = ["digital transformatoin", "reserch and development", "artifical intelligence", "nothing alike", "patentss", "innovations"]
    got = {r["form"]: (r["canonical"], r["confidence"]) for r in S.fuzzy(spark.createDataFrame([(f,) for f in forms], "form string"), lex).collect()}
    for f in forms:
        scores = [SequenceMatcher(None, f, p).ratio() for p, _ in choices]
        top = max(scores)
        assert got.get(f) == ((choices[scores.index(top)][1], round(top, 4)) if top >= 0.84 else None)
    s = spark.createDataFrame([("a", "x", "machine lerning and machin learning and machine learnings with deep learnin")], "record_id string, name string, text string")
    keys = ["machine learning", "deep learning", "cloud"]
    words = s.first()["text"].split()
    want = {}
    for k in keys:
        i = n = 0
        while i <= len(words) - len(k.split()):
            hit = SequenceMatcher(None, " ".join(words[i : i + len(k.split())]), k).ratio() >= 0.9
            n, i = n + hit, i + (len(k.split()) if hit else 1)
        want |= {k: n} if n else {}
    assert {r["keyword"]: r["n"] for r in K.count_fuzzy(s, keys).collect()} == want


def test_dashboard_cells(spark):
    d = spark.createDataFrame([("3", " ", "x"), ("nan", "b", None), (None, None, None)], "v string, a string, b string")
    assert [r[0] for r in d.select(A.number("v")).collect()] == [3.0, 0.0, 0.0]
    assert [r[0] for r in d.select(A.first_value(["a", "b"])).collect()] == ["x", "b", "Not available"]
    assert [r[0] for r in spark.createDataFrame([("r&d - x / y",)], "k string").select(X.metric_key("k")).collect()] == ["r and d - x / y"]


def test_consecutive_lines_take_linear_time(spark):
    import time

    took = []
    for n in (2000, 8000):
        d = spark.createDataFrame([("\n".join(f"line {i // 3} of the report" for i in range(n)),)], "t string")
        began = time.perf_counter()
        got = d.select(C.drop_consecutive("t").alias("t")).first()["t"]
        took.append(time.perf_counter() - began)
        assert len(got.split("\n")) == -(-n // 3)
    assert took[1] < 12 * max(took[0], 0.3)


def test_logging_is_set_up_once(tmp_path):
    a = log.configure(str(tmp_path / "logs"))
    b = log.configure(str(tmp_path / "logs"))
    assert a is b and len(a.handlers) == 2
    a.info("told")
    assert "told" in (tmp_path / "logs" / "tidemark.log").read_text()
    for h in [*a.handlers]:
        a.removeHandler(h)
        h.close()
