"""Cleaning and counting that compute each text once, and their results."""

from pyspark.sql import functions as F

from tidemark import lexicons as L
from tidemark.functions import text as X
from tidemark.operators import keywords as K
from tidemark.operators import lines as C
from tidemark.plans import disclosure


def scans(df):
    """How often a plan reads its input."""
    return df._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD")


def test_cleaning_reads_reports_once(spark):
    text = "\n".join(f"Acme yearly text\nline {w}.\n{i}" for i, w in enumerate("abcdef"))
    r = spark.createDataFrame([("r", text), (None, text), ("n", None)], "record_id string, text string")
    out = C.normalize(C.clean(r))
    assert scans(out) == 1
    # headers go from each report by itself, from one without an id too
    assert {x["record_id"]: x["text"] for x in out.collect()} == {i: "\n".join(f"line {w}." for w in "abcdef") for i in ("r", None)} | {"n": ""}


def test_lines_within_the_row_are_those_of_the_tables(spark):
    text = "\n".join(["head x.", "Über ß text,", "one two three.", "tail y;", "12"] * 4 + ["one two three.", "", "HEAD  X."])
    r = spark.createDataFrame([("r", text), ("s", "only one page\nonly one page\nonly one page"), ("e", "")], "record_id string, text string")
    paged = r.where("record_id = 'r'")
    for r, table, keys in ((paged, C.edge_lines(r, True), lambda p: C.edge_keys(p, True)), (paged, C.edge_lines(r, False), lambda p: C.edge_keys(p, False)), (r, C.repeated_lines(r), lambda p: C.candidate_keys(X.lines("text")))):
        want = {(x["record_id"], x["key"]) for x in table.collect()}
        got = r.select("record_id", F.explode(C.occurring(keys(C.pages_of("text")), F.size(C.pages_of("text")))).alias("key"))
        assert {(x["record_id"], x["key"]) for x in got.collect()} == want != set()


def test_patterns_that_fail_early_find_the_same(spark):
    heads = [*L.REPORT_HEADINGS] + [h.upper() for h in L.REPORT_HEADINGS]
    odd = [":Strategy::", ": Strategy", "RisK   Management", "Buſiness", "Busineß Responsibility and Sustainability\tReport", "Busineẞ Responsibility and Sustainability Report", "Strategy x", "Strategy: ", "", ":", "Human Resources"]
    r = spark.createDataFrame([(x,) for x in heads + odd], "s string").select(X.strip("s").alias("s"))
    for x in r.select("s", X.known_heading(F.col("s")).alias("got"), X.heading_key("s").isin(*[h.lower() for h in L.REPORT_HEADINGS]).alias("want")).collect():
        assert x["got"] == x["want"], x["s"]
    texts = ["it is", "iT,It", "said It_ it1 1it it", "\U0001d400it it\U0001d400 r&d R&d ai-ML", "aiai ai ai", "éit ité"]
    edge = r"[\p{L}\p{N}\p{M}_]"
    old = F.col("s")
    for a in sorted(L.ACRONYMS, key=lambda a: (-len(a), a)):
        old = F.regexp_replace(old, rf"(?i)(?<!{edge})\Q{a}\E(?!{edge})", a)
    for x in spark.createDataFrame([(t,) for t in texts], "s string").select("s", X.acronyms("s").alias("got"), old.alias("want")).collect():
        assert x["got"] == x["want"], x["s"]


def test_lines_end_at_any_line_end(spark):
    texts = ["", "a", "a\n", "a\n\n", "a\r\nb\rc\x0bd\x0ce\x1cf\x1dg\x1eh\x85i j ", "\r\n", "\n\r", "a\r", " \n", None]
    got = spark.createDataFrame([(t,) for t in texts], "s string").select("s", X.lines("s").alias("l")).collect()
    assert [x["l"] for x in got] == [(t or "").splitlines() or [""] for t in texts]


def test_chain_cleans_reports_once_and_filters_without_computing_twice(spark):
    c = spark.createDataFrame([("a", "T"), ("b", "U"), ("c", "V"), (None, "W")], "record_id string, ticker string")
    r = spark.createDataFrame([("a", "Innovation\nwe have ai"), ("b", " "), (None, "x")], "record_id string, text string")
    out = disclosure.cleaned(c, r)
    assert scans(out) == 2  # companies and reports
    assert {x["ticker"]: (x["error"], x["text"]) for x in out.collect()} == {"T": (None, "Innovation\nwe have AI"), "U": ("the report has an empty text", None), "V": ("no report", None), "W": ("no report", None)}
    n = K.count_keywords(r.select("record_id", F.lit("s").alias("name"), "text"), ["have", "ai", "a"])
    assert n._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 1 + 3  # the words once, each keyword once
    assert {(x["record_id"], x["keyword"], x["n"]) for x in n.collect()} == {("a", "have", 1), ("a", "ai", 1)}
