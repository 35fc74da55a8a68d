"""Operators on small fixtures: the traps and the documented cases."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators import analytics as A
from tidemark.operators import keywords as K
from tidemark.operators import lines as C
from tidemark.operators import sections as S
from tidemark.operators import validation as V
from tidemark.plans import disclosure
from tidemark.sources import tables
from tidemark.streaming import reports as R


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "x string").select(f("x").alias("y")).first()["y"]


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (X.normalize_keyword, " Machine-Learning ", "machine learning"),
        (X.normalize_keyword, "R&D", "r and d"),
        (X.match_text, "AI/ML — the Board’s R&D, e-mail", "ai ml the board's r and d e mail"),
        (X.normalized_heading, "Innovation", "nnovation"),
        (X.normalized_heading, "1. Innovation", "innovation"),
        (X.normalized_heading, "Hi", "i"),
        (X.normalized_heading, "R&D", "and d"),
        (X.acronyms, "it is an iot api", "IT is an IoT API"),
        (X.quotes, "‘a’ “b”", "'a' \"b\""),
        (X.hyphens, "a–b­c—d", "a-bc - d"),
        (X.bullets, "• one\n ◦ two", "- one\n- two"),
        (X.special_characters, "Board’s • 5€", "Board s   5€"),
        (X.spaces, "  a   b \n c", "a b\nc"),
        (X.blank_lines, "a\r\n\r\n\r\n\r\nb", "a\n\nb"),
        (X.lower_but_acronyms, "The AI of R&D And Others", "the AI of R&D and others"),
        (X.safe_filename, ' a<b>:c  d. ', "a_b_c d"),
        (X.safe_filename, " .. ", "untitled"),
        (X.parse_year, "2024-25", 2024),
        (X.parse_year, "12", None),
        (X.canonical_line, "  Große \t Straße ", "grosse strasse"),
    ],
)
def test_text_functions(spark, f, value, want):
    assert one(spark, f, value) == want


def test_lines_like_splitlines(spark):
    for t in ["", "a", "a\n", "a\r\nb\x0bc\x85d e", "\n\n", "x\n\n"]:
        assert one(spark, X.lines, t) == (t.splitlines() or [""])


def test_heading_like(spark):
    like = lambda t: one(spark, lambda c: X.heading_like(c, company_suffix=True), t)
    assert like("Annual Report 2025") and like("strategy") and not like("Acme Limited") and not like("and so on") and not like("Ends Here.")


def test_contents_go():
    toc = "Title\nContents\nOne ..... 1\nnot an entry\nTwo ..... 2\nThree ..... 3\nBody\nOne ..... 1"
    assert C.without_contents("Title\nContents\nOne ..... 1\nTwo ..... 2\nThree ..... 3\nBody") == "Title\nBody"
    assert C.without_contents(toc) == "Title\nBody\nOne ..... 1"
    assert C.without_contents("Contents\nOne ..... 1\nBody") == "Contents\nOne ..... 1\nBody"
    assert C.without_contents(None) == ""


def test_clean_paged_report(spark):
    page = "acme annual report limited\nText of page {0} here, and more.\nsame\nsame\nfooter of acme\n{0}\n"
    text = "".join(page.format(i) for i in range(1, 6))
    out = C.clean(spark.createDataFrame([("r", text), ("n", None)], "record_id string, text string"))
    got = dict(rows(out, "record_id", "text"))
    assert "limited" not in got["r"] and "footer" not in got["r"] and "Text of page 3 here, and more." in got["r"] and got["n"] == ""
    assert "same" not in got["r"]


def test_consecutive_lines(spark):
    assert one(spark, C.drop_consecutive, "a b.\na  B.\n\na b.\nHead Line\nHead Line") == "a b.\n\na b.\nHead Line\nHead Line"


DICTIONARY = [("AI", "Artificial Intelligence"), ("AI", "Machine-Learning"), ("AI", "machine learning"), ("Innovation", "R&D"), (None, "x"), ("AI", " ")]


def make_entries(spark, rows_):
    return K.entries(spark.createDataFrame([(i, *r) for i, r in enumerate(rows_)], "pos int, Category string, Keyword string"))


def test_dictionary(spark):
    e = make_entries(spark, DICTIONARY)
    got = {r["category"]: tuple(r["keywords"]) for r in K.grouped(e).collect()}
    assert got == {"AI": ("machine learning", "artificial intelligence"), "Innovation": ("r and d",)}
    with pytest.raises(ValueError, match="no valid keywords"):
        tables.dictionary(spark.createDataFrame([], "Category string, Keyword string"))
    with pytest.raises(ValueError, match="missing required columns"):
        tables.dictionary(spark.createDataFrame([], "Term string"))
    assert K.default_entries(spark).count() == 30


@pytest.mark.parametrize(
    ("text", "keyword", "n"),
    [
        ("Machine learning, machine learning-based and Machine-Learning", "machine learning", 3),
        ("Artificially intelligent", "artificial intelligence", 0),
        ("Innovation INNOVATION innovation InNoVaTiOn", "innovation", 4),
        ("AI supports fair systems in retail.", "ai", 1),
        ("industry 4.0 and c++", "industry 4.0", 0),
        ("the ai's ai", "ai", 2),
        ("", "ai", 0),
    ],
)
@pytest.mark.parametrize("patterns", [400, 0])
def test_keyword_counts(spark, monkeypatch, text, keyword, n, patterns):
    s = spark.createDataFrame([("r", "s", text)], "record_id string, name string, text string")
    if not patterns:
        got = K.count_by_runs(s.select("record_id", F.col("name").alias("section"), X.match_text("text").alias("norm")), [keyword, "zz"])
    else:
        got = K.count_keywords(s, [keyword])
    assert sum(r["n"] for r in got.collect()) == n


def test_sections_of_counts(spark):
    s = spark.createDataFrame([("r", "Strategy", "AI and innovation guide our AI strategy."), ("r", "Research", "Innovation enables delivery.")], "record_id string, name string, text string")
    assert rows(K.count_keywords(s, ["ai", "innovation"]), "section", "keyword", "n") == [("Research", "innovation", 1), ("Strategy", "ai", 2), ("Strategy", "innovation", 1)]
    fz = K.count_fuzzy(spark.createDataFrame([("r", "s", "we use machin learning here")], "record_id string, name string, text string"), ["machine learning", "use"])
    assert rows(fz, "keyword", "n") == [("machine learning", 1)]


def test_statistics_and_score(spark):
    e = make_entries(spark, [("AI", "ai"), ("AI", "machine learning"), ("Patents", "patent"), ("Automation", "rpa"), ("Overlap", "ai")])
    r = spark.createDataFrame([("r",), ("empty",)], "record_id string")
    c = spark.createDataFrame([("r", "s", "ai", 2), ("r", "s", "machine learning", 1), ("r", "s", "patent", 1)], "record_id string, section string, keyword string, n long")
    w = spark.createDataFrame([("r", 100), ("empty", 0)], "record_id string, n_words long")
    got = {(x["record_id"], x["category"]): x for x in K.category_statistics(r, c, w, e).collect()}
    assert len(got) == 8
    ai, patents, none = got["r", "AI"], got["r", "Patents"], got["r", "Automation"]
    assert (ai["count"], ai["percentage_contribution"], ai["density"]) == (3, 75.0, 30.0) and patents["percentage_contribution"] == 25.0 and not none["present"]
    assert sum(got["r", k]["percentage_contribution"] for k in ("AI", "Patents", "Overlap")) > 100
    assert got["empty", "AI"]["density"] == 0.0
    s = spark.createDataFrame([("r", "Innovation", "word " * 100)], "record_id string, name string, text string")
    x = {y["record_id"]: y for y in K.scores(K.metrics(r, s, c, e)).collect()}
    assert x["r"]["section_coverage"] == 10.0 and x["r"]["keyword_density_score"] == 100.0 and x["empty"]["overall_score"] == 0.0
    want = 0.4 * 100 + 0.3 * 75 + 0.2 * 10 + 0.1 * 75
    assert x["r"]["overall_score"] == pytest.approx(want)
    with pytest.raises(ValueError):
        K.scores(K.metrics(r, s, c, e), {"keyword_density": 1.0})


def test_headings_and_sections(spark):
    text = "intro\nInnovation\n" + "We invent many things that people need daily.\n" * 2 + "Human Resources\nPeople work here and are glad of it every day.\nInnovation\nMore inventions of ours, forty characters or more."
    r = spark.createDataFrame([("r", text), ("n", "no heading stands here, only a line of text.")], "record_id string, text string")
    h = S.headings(r, False)
    assert rows(h, "start", "heading")[0] == (text.index("Innovation"), "Innovation")
    found = S.sections(r, h)
    merged = S.merge(found)
    assert rows(S.or_full_report(r, merged), "record_id", "name") == [("n", "Full Report"), ("r", "Innovation")]
    body = merged.first()["text"]
    assert body.count("Innovation") == 2 and "Human" not in body and "\n\n" in body
    probe = spark.createDataFrame([("a", "Innovation"), ("b", "1. Innovation"), ("c", "Hi"), ("d", "R&D")], "record_id string, text string")
    got = {x["record_id"]: (x["heading"], x["confidence"]) for x in S.headings(probe).collect()}
    assert got["a"] == ("Innovation", 1.0) and got["c"] == ("AI", 1.0) and got["d"] == ("Research & Development", 1.0)
    assert got["b"] == ("Innovation", 0.9474)


def test_validation(spark):
    wide = spark.createDataFrame([("Acme", 2024, "3", 1.0), ("Acme", 2024, None, 2.0)], "Company string, Year int, ai string, `big data` double")
    assert rows(V.manual_counts(wide), "keyword", "n") == [("ai", 3), ("big_data", 3)]
    long = spark.createDataFrame([("Acme", " AI ", "18"), ("Acme", "ai", "2"), ("Zed", "x", "1")], "company string, keyword string, manual_count string")
    manual = V.manual_counts(long)
    assert rows(manual, "company", "keyword", "n") == [("Acme", "ai", 20), ("Zed", "x", 1)]
    auto = spark.createDataFrame([("Acme", "ai", 15), ("Acme", "iot", 5)], "company string, keyword string, n long")
    r = V.report(auto, manual).first()
    assert (r["tp"], r["fp"], r["fn"], r["precision"], r["recall"], r["f1"], r["accuracy"]) == (15, 5, 5, 0.75, 0.75, 0.75, 0.6)
    assert r["missing_keywords"] == ["ai"] and r["false_matches"] == ["iot"] and r["comments"].startswith("Acceptable")
    none = V.quality(spark.createDataFrame([("A", 0, 0, 0)], "company string, tp long, fp long, fn long")).first()
    assert (none["precision"], none["f1"], none["accuracy"]) == (0.0, 0.0, 1.0)
    with pytest.raises(KeyError):
        V.report(auto.withColumn("company", F.lit("Other")), manual)
    with pytest.raises(Exception, match="not a count"):
        V.manual_counts(spark.createDataFrame([("A", "k", "-1")], "company string, keyword string, count string")).collect()


def test_company_master(spark):
    df = spark.createDataFrame([("Tata", " tcs ", "IT", "2024-25", "a.pdf", "https://x.y/z"), ("Tata", "TCS", "IT", "FY2024", "b.pdf", "https://x.y/z")], "`Company Name` string, Symbol string, Sector string, `Financial Year` string, `PDF Path` string, URL string")
    m = tables.company_master(df).collect()
    assert len(m) == 1 and (m[0]["ticker"], m[0]["report_year"], m[0]["record_id"]) == ("TCS", 2024, "tcs_2024")
    with pytest.raises(ValueError, match="source_url"):
        tables.company_master(df.drop("URL"))
    with pytest.raises(ValueError, match="invalid"):
        tables.company_master(df.withColumn("Symbol", F.lit(" ")))


def test_selection_and_dashboard(spark):
    c = spark.createDataFrame([("Tata Steel", "TATA", 2024), ("Tata Power", "TPOW", 2025), ("Infosys", "INFY", 2024)], "company_name string, ticker string, report_year int")
    assert rows(A.select_companies(c, "tata"), "ticker") == [("TATA",)]
    assert rows(A.select_companies(c, "tat"), "ticker") == [("TATA",), ("TPOW",)]
    assert rows(A.select_companies(c, "tat", 2025), "ticker") == [("TPOW",)]
    md = "# x\n## Recommendations\n\n- Strong ai disclosure\n- Moderate x\n## Next\n- no"
    assert one(spark, A.parse_recommendations, md) == ["Strong ai disclosure", "Moderate x"]
    assert one(spark, A.parse_recommendations, "nothing") == []
    bad = spark.createDataFrame([("a", "", "T", 1800, "ftp://x", 101.0), ("b", "B", "T", 2024, "https://x.y", None)], "record_id string, company_name string, ticker string, report_year int, source_url string, disclosure_score double")
    assert {r["record_id"] for r in A.violations(bad).collect()} == {"a"} and A.violations(bad).count() == 4
    t = A.trend(spark.createDataFrame([(2024, x) for x in (3.0, 1.0, 2.0)], "y int, v double"), "y", "v")
    assert rows(t, "x", "y") == [(1, 1.0), (2, 2.0), (3, 3.0)]
    assert rows(A.in_order(c, "ticker", ["INFY", "TATA"]), "ord", "ticker") == [(0, "INFY"), (1, "TATA")]


def test_scanned_and_pages(spark):
    p = spark.createDataFrame([("r", 2, "two"), ("r", 1, " one "), ("r", 3, "  "), ("s", 1, None)], "record_id string, page_number int, text string")
    assert rows(C.combine_pages(p), "record_id", "text") == [("r", "one \n\ntwo")]
    assert all(r["scanned"] for r in C.scanned(p).collect())


def test_whole_plan(spark, tmp_path):
    companies = spark.createDataFrame([("a", "Acme", "ACM", "IT", 2024), ("b", "Bad", "BAD", "IT", 2024), ("c", "Gone", "GON", "IT", 2024)], "record_id string, company_name string, ticker string, industry string, report_year int")
    text = "INNOVATION\nArtificial intelligence supports innovation initiatives across the enterprise."
    reports = spark.createDataFrame([("a", text), ("b", " \n\t ")], "record_id string, text string")
    res = disclosure.analyse(companies, reports, K.default_entries(spark))
    assert dict(rows(res.status, "record_id", "status")) == {"a": "SUCCESS", "b": "FAILED", "c": "FAILED"}
    assert rows(res.sections, "name") == [("Innovation",)]
    md = res.markdown.first()["markdown"]
    assert "- innovation: 2" in md and "- Innovation" in md and md.startswith("# Acme Annual Report Analysis")
    disclosure.write(res, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out" / "ready")).count() == 30
    assert res.scores.first()["explanation"].endswith("out of 100.")


def test_text_source(spark, tmp_path):
    (tmp_path / "a_2024.txt").write_bytes("﻿Größe".encode())
    (tmp_path / "b_2024.txt").write_bytes("Größe".encode("cp1252"))
    assert rows(tables.report_texts(spark, str(tmp_path)), "record_id", "text") == [("a_2024", "Größe"), ("b_2024", "Größe")]


def test_stream(spark, tmp_path):
    src = spark.createDataFrame([("a", "ai and ai", "2024-01-01 00:10:00"), ("b", "AI", "2024-01-01 00:50:00")], "record_id string, text string, ts string").withColumn("ts", F.to_timestamp("ts"))
    src.write.parquet(str(tmp_path / "in"))
    q = R.counts_by_window(R.arriving(spark, str(tmp_path / "in")), ["ai"]).writeStream.format("memory").queryName("hits").outputMode("complete").start()
    try:
        q.processAllAvailable()
        assert [r["n"] for r in spark.table("hits").collect()] == [3]
    finally:
        q.stop()
