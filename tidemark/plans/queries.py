"""The registered queries over the test tables, and their SQL.

A document is a report, its source the company, its language the industry, 2024 + doc_id % 2 the year.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import lexicons as L
from tidemark.functions import text as X
from tidemark.operators import analytics as A
from tidemark.operators import keywords as K
from tidemark.operators import lines as C
from tidemark.operators import sections as S
from tidemark.operators import validation as V
from tidemark.plans import disclosure

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: A dictionary of words that the test texts have; one category has none, one keyword two categories.
ENTRIES = [("Data", "AI"), ("Data", "of the"), ("Data", "of-the"), ("Innovation", "and  the"), ("Innovation", "tion"), ("Innovation", "ai"), ("Licensing", "Licensed Under"), ("Licensing", "apache license"), ("Licensing", "all rights reserved"), ("Romance", "le"), ("Romance", "que"), ("Germanic", "der"), ("Germanic", "the"), ("Dormant", "quantum ledger"), ("", "blank"), ("Dormant", " ")]


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), "text", F.col("source").alias("ticker"), F.col("lang").alias("industry"), (2024 + F.col("doc_id") % 2).alias("report_year"))


def raw_entries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *e) for i, e in enumerate(ENTRIES)], "pos int, Category string, Keyword string")


def entries(spark: SparkSession) -> DataFrame:
    return K.entries(raw_entries(spark))


def full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).select("record_id", F.lit("Full Report").alias("name"), F.lit(1).alias("ord"), "text")


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.count_keywords(full(spark, sf_dir), K.all_keywords(entries(spark)))


# ---- SQL that several oracles share
STRIP = r"regexp_replace(regexp_replace({0}, '^\s+', ''), '\s+$', '')"
KEY = r"replace(lower(" + STRIP.format(r"regexp_replace({0}, '\s+', ' ', 'g')") + "), 'ß', 'ss')"
MATCH = r"array_to_string(regexp_extract_all(replace(lower(replace(replace(translate(regexp_replace({0}, '[-‐-―−]', ' ', 'g'), '‘’‚‛′‵', ''''''''''''''), '&', ' and '), '/', ' ')), 'ß', 'ss'), '[\p{{L}}\p{{N}}]+(?:[&''-][\p{{L}}\p{{N}}]+)*'), ' ')"
KW = r"replace(lower(" + STRIP.format(r"regexp_replace(replace(replace(regexp_replace({0}, '[-‐-―−]', ' ', 'g'), '&', ' and '), '/', ' '), '\s+', ' ', 'g')") + "), 'ß', 'ss')"
WORDS = r"len(regexp_extract_all({0}, '[\p{{L}}\p{{N}}]+(?:[&''-][\p{{L}}\p{{N}}]+)*'))"
R4 = "floor(({0}) * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE"
RATIO = "CASE WHEN {1} > 0 THEN floor({0}::DOUBLE / {1} * {2}::DOUBLE * 10000.0::DOUBLE + 0.5::DOUBLE) / 10000.0::DOUBLE ELSE 0.0::DOUBLE END"
_VALUES = ", ".join("({}, '{}', '{}')".format(i, *e) for i, e in enumerate(ENTRIES))
DICT = f"""raw(pos, c, k) AS (VALUES {_VALUES}),
    e AS (SELECT category, keyword, min(pos) AS pos FROM (SELECT {STRIP.format("c")} AS category, {KW.format("k")} AS keyword, pos FROM raw) WHERE category <> '' AND keyword <> '' GROUP BY ALL),
    rep AS (SELECT doc_id AS record_id, text, source AS ticker, lang AS industry, 2024 + doc_id % 2 AS report_year FROM documents)"""
COUNTS = (
    DICT
    + r""",
    norm AS (SELECT record_id, replace(' ' || array_to_string(regexp_extract_all("""
    + MATCH.format("text")
    + r""", '[\p{L}\p{N}]+'), ' ') || ' ', ' ', '  ') AS t FROM rep),
    cnt AS (SELECT record_id, 'Full Report' AS section, keyword, n FROM (
        SELECT record_id, keyword, (length(t) - length(replace(t, ' ' || replace(keyword, ' ', '  ') || ' ', ''))) // (length(replace(keyword, ' ', '  ')) + 2) AS n
        FROM norm, (SELECT DISTINCT keyword FROM e)) WHERE n > 0),
    wrd AS (SELECT record_id, """
    + WORDS.format("text")
    + r""" AS n_words FROM rep),
    tot AS (SELECT record_id, sum(n)::BIGINT AS total, count(*) AS uniq FROM cnt GROUP BY 1),
    cat AS (SELECT record_id, category, sum(n)::BIGINT AS n FROM cnt JOIN e USING (keyword) GROUP BY 1, 2),
    cats AS (SELECT category, min(pos) AS cat_pos FROM e GROUP BY 1),
    st AS (SELECT r.record_id, c.category, c.cat_pos, coalesce(cat.n, 0) AS count, coalesce(tot.total, 0) AS total_keyword_count, n_words AS word_count
           FROM rep r CROSS JOIN cats c LEFT JOIN cat ON cat.record_id = r.record_id AND cat.category = c.category LEFT JOIN tot ON tot.record_id = r.record_id JOIN wrd ON wrd.record_id = r.record_id)"""
)
STATS = COUNTS + f""", stats AS (SELECT *, {RATIO.format("count", "word_count", "1000.0")} AS density, count > 0 AS present, {RATIO.format("count", "total_keyword_count", "100.0")} AS percentage_contribution FROM st)"""
_NORM = "CASE WHEN {1} > 0 THEN " + R4.format("least(greatest(({0})::DOUBLE / ({1})::DOUBLE, 0.0::DOUBLE), 1.0::DOUBLE) * 100.0::DOUBLE") + " ELSE 0.0::DOUBLE END"
SCORES = (
    COUNTS
    + f""",
    m AS (SELECT r.record_id, r.ticker, r.industry, r.report_year, coalesce(total, 0) AS total_keyword_count, coalesce(uniq, 0) AS unique_keyword_count, n_words AS total_word_count, coalesce(p, 0) AS categories_present,
                 (SELECT count(*) FROM cats) AS categories_known, (SELECT count(DISTINCT keyword) FROM e) AS known_keyword_count, 0.0::DOUBLE AS section_coverage
          FROM rep r LEFT JOIN tot USING (record_id) JOIN wrd USING (record_id) LEFT JOIN (SELECT record_id, count(DISTINCT category) AS p FROM cat GROUP BY 1) USING (record_id)),
    m2 AS (SELECT *, {RATIO.format("total_keyword_count", "total_word_count", "1000.0")} AS keyword_density FROM m),
    s AS (SELECT *, {_NORM.format("keyword_density", "10.0")} AS keyword_density_score, {_NORM.format("categories_present", "categories_known")} AS category_coverage_score,
                 0.0::DOUBLE AS section_coverage_score, {_NORM.format("unique_keyword_count", "known_keyword_count")} AS keyword_diversity_score FROM m2),
    scores AS (SELECT *, {R4.format("keyword_density_score * 0.4::DOUBLE + category_coverage_score * 0.3::DOUBLE + section_coverage_score * 0.2::DOUBLE + keyword_diversity_score * 0.1::DOUBLE")} AS overall_score FROM s)"""
)


def score_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reports(spark, sf_dir)
    m = K.metrics(r, full(spark, sf_dir), counts(spark, sf_dir), entries(spark))
    return K.scores(m).join(r.select("record_id", "ticker", "industry", "report_year"), "record_id")


# ---- dictionary, keywords, categories, scores
@query(f"WITH {DICT} SELECT {KW.format('k')} AS keyword, pos FROM raw")
def kw_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_entries(spark).select(X.normalize_keyword("Keyword").alias("keyword"), "pos")


@query(f"WITH {DICT} SELECT category, keyword, min(pos) OVER (PARTITION BY category) AS cat_pos, pos FROM e")
def dict_entries_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entries(spark)


@query(f"WITH {DICT} SELECT category, min(pos) AS cat_pos, string_agg(keyword, '|' ORDER BY length(keyword), keyword) AS keywords FROM e GROUP BY category")
def dict_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.grouped(entries(spark)).withColumn("keywords", F.array_join("keywords", "|"))


@query(f"SELECT doc_id AS record_id, {MATCH.format('text')} AS norm FROM documents")
def match_norm_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).select("record_id", X.match_text("text").alias("norm"))


@query(f"WITH {COUNTS} SELECT record_id, section, keyword, n FROM cnt")
def keyword_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir)


@query(f"WITH {COUNTS} SELECT keyword, sum(n)::BIGINT AS n, count(*) AS n_reports FROM cnt GROUP BY keyword")
def keyword_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir).groupBy("keyword").agg(F.sum("n").alias("n"), F.count("*").alias("n_reports"))


@query(f"WITH {STATS} SELECT record_id, category, cat_pos, count, density, present, percentage_contribution, total_keyword_count, word_count FROM stats")
def category_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.category_statistics(reports(spark, sf_dir), counts(spark, sf_dir), K.words_of(full(spark, sf_dir)), entries(spark))


@query(f"WITH {STATS} SELECT category, sum(count)::BIGINT AS total FROM stats GROUP BY 1 HAVING sum(count) > 0")
def category_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.totals(category_stats(spark, sf_dir), "category", "count")


@query(f"WITH {STATS} SELECT record_id, category, (CASE WHEN count = 0 THEN 'Strengthen ' WHEN count < 5 THEN 'Moderate ' ELSE 'Strong ' END) || replace(category, '_', ' ') || ' disclosure' AS recommendation FROM stats")
def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return category_stats(spark, sf_dir).select("record_id", "category", K.recommendation().alias("recommendation"))


@query(f"WITH {SCORES} SELECT record_id, total_keyword_count, unique_keyword_count, total_word_count, categories_present, categories_known, known_keyword_count, section_coverage, keyword_density FROM scores")
def metric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.metrics(reports(spark, sf_dir), full(spark, sf_dir), counts(spark, sf_dir), entries(spark))


@query(f"WITH {SCORES} SELECT record_id, keyword_density_score, category_coverage_score, section_coverage_score, keyword_diversity_score FROM scores")
def component_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_table(spark, sf_dir).select("record_id", "keyword_density_score", "category_coverage_score", "section_coverage_score", "keyword_diversity_score")


@query(f"WITH {SCORES} SELECT record_id, ticker, industry, report_year, total_word_count, keyword_density, overall_score FROM scores")
def disclosure_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_table(spark, sf_dir).select("record_id", "ticker", "industry", "report_year", "total_word_count", "keyword_density", "overall_score")


@query(f"WITH {SCORES} SELECT record_id, 'Overall Disclosure Score is a weighted mathematical score: 40% keyword density (' || keyword_density_score || '), 30% category coverage (' || category_coverage_score || '), 20% section coverage (' || section_coverage_score || '), and 10% keyword diversity (' || keyword_diversity_score || '). The final reproducible score is ' || overall_score || ' out of 100.' AS explanation FROM scores")
def score_explanation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_table(spark, sf_dir).select("record_id", K.explanation().alias("explanation"))


@query()
def keyword_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.count_fuzzy(full(spark, sf_dir), ["thation", "all rights reserve"])


# ---- dashboards over scores
@query(f"WITH {SCORES} SELECT count(DISTINCT record_id) AS n, {R4.format('avg(overall_score)')} AS mean, max(overall_score) AS highest, min(overall_score) AS lowest FROM scores")
def portfolio_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.kpis(score_table(spark, sf_dir), "overall_score", "record_id")


@query(f"WITH {SCORES} SELECT industry, {R4.format('avg(overall_score)')} AS mean FROM scores WHERE industry <> 'Not available' GROUP BY 1")
def industry_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.means(score_table(spark, sf_dir), "industry", "overall_score")


@query(f"WITH {SCORES} SELECT report_year AS x, {R4.format('avg(overall_score)')} AS y FROM scores GROUP BY 1")
def year_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.trend(score_table(spark, sf_dir), "report_year", "overall_score")


@query(f"WITH {SCORES} SELECT row_number() OVER (ORDER BY overall_score) AS x, overall_score AS y FROM scores")
def score_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.trend(score_table(spark, sf_dir).withColumn("report_year", F.lit(2024)), "report_year", "overall_score")


@query(f"WITH {SCORES} (SELECT 'top' AS side, record_id, overall_score FROM scores ORDER BY overall_score DESC, record_id LIMIT 10) UNION ALL (SELECT 'bottom', record_id, overall_score FROM scores ORDER BY overall_score, record_id LIMIT 10)")
def top_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = score_table(spark, sf_dir).select("record_id", "overall_score")
    return A.top(s, "overall_score", "record_id").select(F.lit("top").alias("side"), "*").union(A.top(s, "overall_score", "record_id", ascending=True).select(F.lit("bottom").alias("side"), "*"))


@query(f"""WITH {SCORES}, b AS (SELECT min(overall_score) AS lo, max(overall_score) AS hi, least(greatest(count(*), 5), 20) AS k FROM scores),
    g AS (SELECT least(floor((overall_score - lo) / ((hi - lo) / k)), k - 1)::INT AS bin, lo, hi, k, count(*) AS n FROM scores, b GROUP BY ALL)
    SELECT bin, {R4.format("lo + bin * ((hi - lo) / k)")} AS low, {R4.format("lo + (bin + 1) * ((hi - lo) / k)")} AS high, n FROM g""")
def score_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.histogram(score_table(spark, sf_dir), "overall_score")


@query(f"WITH {STATS} SELECT category, {', '.join(f'''sum(CASE WHEN ticker = 'src{i}' THEN count ELSE 0 END)::BIGINT AS src{i}''' for i in range(3))} FROM stats JOIN rep USING (record_id) GROUP BY category")
def category_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = category_stats(spark, sf_dir).join(reports(spark, sf_dir).select("record_id", "ticker"), "record_id")
    return A.pivot(c, "category", "ticker", "count", ["src0", "src1", "src2"])


@query(f"WITH {SCORES} SELECT record_id, 'keyword_density' AS metric, keyword_density AS value FROM scores UNION ALL SELECT record_id, 'section_coverage', section_coverage FROM scores")
def metrics_melt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.melt(score_table(spark, sf_dir), ["record_id"], ["keyword_density", "section_coverage"])


@query(f"WITH {COUNTS} SELECT keyword, sum(n)::BIGINT AS n FROM cnt JOIN rep USING (record_id) WHERE ticker = 'src1' GROUP BY 1 HAVING sum(n) > 0 ORDER BY n DESC, keyword LIMIT 20")
def top_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = counts(spark, sf_dir).join(reports(spark, sf_dir).where("ticker = 'src1'").select("record_id"), "record_id", "left_semi")
    return A.top(c.groupBy("keyword").agg(F.sum("n").alias("n")).where("n > 0"), "n", "keyword", 20)


@query("SELECT DISTINCT ON (source) source AS ticker, doc_id AS record_id FROM documents ORDER BY source, doc_id DESC")
def dedup_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.keep_last(reports(spark, sf_dir).select("ticker", "record_id"), "ticker", "record_id")


@query("SELECT record_id, ticker, report_year FROM (SELECT doc_id AS record_id, source AS ticker, 2024 + doc_id % 2 AS report_year FROM documents) QUALIFY row_number() OVER (PARTITION BY lower(ticker), report_year ORDER BY record_id) = 1")
def manifest_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.dedup_first(reports(spark, sf_dir).select("record_id", "ticker", "report_year"), [F.lower("ticker"), F.col("report_year")], "record_id")


_COMPANY = "SELECT c_custkey, c_name AS company_name, c_mktsegment AS ticker, 2020 + c_nationkey AS report_year FROM customer"


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("company_name"), F.col("c_mktsegment").alias("ticker"), (2020 + F.col("c_nationkey")).alias("report_year"))


@query(f"WITH c AS ({_COMPANY}), x AS (SELECT *, lower(ticker) = 'build' OR lower(company_name) = 'build' AS ex FROM c) SELECT c_custkey, company_name, ticker, report_year FROM x WHERE (ex OR (NOT (SELECT bool_or(ex) FROM x) AND (contains(lower(ticker), 'build') OR contains(lower(company_name), 'build')))) AND report_year = 2025")
def company_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.select_companies(companies(spark, sf_dir), " Build ", 2025)


@query(f"WITH c AS ({_COMPANY}) SELECT company_name || ' (' || ticker || ' · ' || report_year || ')' AS label, regexp_replace(regexp_replace(regexp_replace(lower(company_name), '[^a-z0-9]+', '_', 'g'), '^_+', ''), '_+$', '') || '_' || report_year AS slug FROM c")
def labels_and_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return companies(spark, sf_dir).select(A.label("company_name", "ticker", "report_year").alias("label"), X.slug("company_name", "report_year").alias("slug"))


@query("SELECT p_partkey, p_name, p_brand FROM part WHERE contains(lower(p_name), 'an') OR contains(lower(p_brand), '#1')")
def search_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.search(table(spark, sf_dir, "part"), "AN", ["p_name"]).select("p_partkey", "p_name", "p_brand").union(A.search(table(spark, sf_dir, "part"), "#1", ["p_brand"]).select("p_partkey", "p_name", "p_brand")).distinct()


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def semi_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return A.visible(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), chosen, "o_custkey")


@query("SELECT s_name, s_nationkey, NULL::VARCHAR AS c_name FROM supplier UNION ALL SELECT NULL, c_nationkey, c_name FROM customer")
def union_workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "supplier").select("s_name", "s_nationkey")
    return A.union_all([a, table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("s_nationkey"), "c_name")])


@query("SELECT s_suppkey, s_nationkey, coalesce(n_name, 'Not available') AS industry FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON s_nationkey = n_nationkey")
def industry_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    look = table(spark, sf_dir, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").cast("string").alias("ticker"), F.col("n_name").alias("industry"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", F.col("s_nationkey").cast("string").alias("ticker"))
    return A.enrich(s, look).select("s_suppkey", "s_nationkey", "industry")


@query("SELECT event_id, regexp_extract(props, '(?:19|20)\\d{2}')  AS y FROM events")
def year_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.regexp_extract("props", r"(?:19|20)\d{2}", 0).alias("y"))


@query("SELECT doc_id AS record_id, 2000 + doc_id % 30 AS year FROM documents")
def year_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = F.concat(F.lit("FY "), (2000 + F.col("record_id") % 30).cast("string"), F.lit("-25"))
    return reports(spark, sf_dir).select("record_id", X.parse_year(y).cast("long").alias("year"))


@query("SELECT count(*) AS processed, count(*) FILTER (o_orderstatus = 'F') AS success, count(*) FILTER (o_orderstatus <> 'F') AS failed FROM orders")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.run_summary(table(spark, sf_dir, "orders").select(F.when(F.col("o_orderstatus") == "F", "SUCCESS").otherwise("FAILED").alias("status")))


@query("SELECT o_orderkey, lpad((s // 3600)::VARCHAR, greatest(2, length((s // 3600)::VARCHAR))::INT, '0') || ':' || lpad((s % 3600 // 60)::VARCHAR, 2, '0') || ':' || lpad((s % 60)::VARCHAR, 2, '0') AS duration FROM (SELECT o_orderkey, o_orderkey % 500000 AS s FROM orders)")
def duration_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", X.clock(F.col("o_orderkey") % 500000).alias("duration"))


# ---- line algebra; page marks, furniture and odd characters are put in
_PAGED = r"(SELECT doc_id AS record_id, 'acme limited report' || chr(10) || replace(text, '. ', '.' || chr(10) || (doc_id % 90)::VARCHAR || chr(10) || 'acme limited report' || chr(10)) AS text FROM documents)"


def paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = F.concat(F.lit(".\n"), (F.col("record_id") % 90).cast("string"), F.lit("\nacme limited report\n"))
    return reports(spark, sf_dir).select("record_id", F.concat(F.lit("acme limited report\n"), F.replace("text", F.lit(". "), mark)).alias("text"))


_LINES = "SELECT record_id, unnest(range(len(l))) AS line_no, unnest(l) AS line FROM (SELECT record_id, string_split(text, chr(10)) AS l FROM {0})"
_SUFFIX = r"regexp_matches({0}, '(?i)\b(?:limited|ltd|private|pvt|plc|inc|corp|corporation|company|co\.?)\b\.?$')"
_HEADS = ", ".join("'" + h.lower().replace("'", "''") + "'" for h in L.REPORT_HEADINGS)
_CAPS = r"len(regexp_extract_all({0}, '[A-Za-z&'']+'))"
_CAPU = r"len(list_filter(regexp_extract_all({0}, '[A-Za-z&'']+'), lambda x: regexp_matches(x, '^[A-Z]')))"
_SHAPE = rf"(length({{0}}) <= 120 AND NOT regexp_matches({{0}}, '[.,;]$') AND {_CAPS} > 0 AND {_CAPU} >= greatest(1, floor({_CAPS} * 0.7::DOUBLE)))"
_HEADING = rf"({{0}} <> '' AND ({KEY.format('{0}')} IN ({_HEADS}) OR {_SHAPE}) AND NOT {_SUFFIX})"
_CAND = rf"({{0}} <> '' AND NOT {_HEADING} AND regexp_matches({{0}}, '[A-Za-z]') AND length({{0}}) <= 120)"
_PAGES = r"list_filter(regexp_split_to_array(text, '(?i)\n\s*(?:page\s+)?\d{1,4}\s*\n'), lambda p: " + STRIP.format("p") + " <> '')"


@query(f"SELECT record_id, line_no::INT AS line_no, {KEY.format('line')} AS key FROM ({_LINES.format('(SELECT doc_id AS record_id, text FROM documents)')})")
def canonical_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.explode_lines(reports(spark, sf_dir)).select("record_id", "line_no", X.canonical_line("line").alias("key"))


@query(rf"SELECT record_id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM ({_LINES.format(_PAGED)}) WHERE NOT regexp_matches(line, '(?i)^\s*(?:page\s*)?(?:\d{{1,4}}|[ivxlcdm]{{1,12}})(?:\s*(?:of|/|-)\s*(?:\d{{1,4}}|[ivxlcdm]{{1,12}}))?\s*$') GROUP BY record_id")
def page_number_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paged(spark, sf_dir).select("record_id", C.drop_page_numbers("text").alias("text"))


@query(f"SELECT record_id, len({_PAGES}) AS n_pages FROM {_PAGED}")
def page_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paged(spark, sf_dir).select("record_id", F.size(C.pages_of("text")).cast("long").alias("n_pages"))


def _edge_sql(side: str) -> str:
    full = r"list_filter(string_split(page, chr(10)), lambda x: " + STRIP.format("x") + " <> '')"
    some = f"{full}[1:3]" if side == "start" else f"{full}[-3:]"
    return f"""WITH p AS (SELECT record_id, len(pages) AS k, unnest(pages) AS page FROM (SELECT record_id, {_PAGES} AS pages FROM {_PAGED}) WHERE len(pages) > 1),
        l AS (SELECT record_id, k, {STRIP.format("line")} AS s FROM (SELECT record_id, k, unnest({some}) AS line FROM p))
        SELECT record_id, {KEY.format("s")} AS key, count(*) AS n FROM l WHERE {_CAND.format("s")} GROUP BY record_id, k, 2 HAVING count(*) >= greatest(3, floor(k * 0.35::DOUBLE))"""


@query(_edge_sql("start"))
def header_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.edge_lines(paged(spark, sf_dir), True)


@query(_edge_sql("end"))
def footer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.edge_lines(paged(spark, sf_dir), False)


@query(f"""WITH k AS (SELECT record_id, len({_PAGES}) AS k FROM {_PAGED}), l AS (SELECT record_id, {STRIP.format("line")} AS s FROM ({_LINES.format(_PAGED)}))
    SELECT record_id, {KEY.format("s")} AS key, count(*) AS n FROM l JOIN k USING (record_id) WHERE {_CAND.format("s")} GROUP BY record_id, k, 2 HAVING count(*) >= greatest(3, floor(k * 0.35::DOUBLE))""")
def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.repeated_lines(paged(spark, sf_dir))


@query(f"""WITH l AS (SELECT record_id, line_no, line, {KEY.format("line")} AS key FROM ({_LINES.format("(SELECT doc_id AS record_id, text FROM documents)")})),
    f AS (SELECT *, lag(key) OVER (PARTITION BY record_id ORDER BY line_no) AS b, {_HEADING.format(STRIP.format("line"))} AS h FROM l)
    SELECT record_id, string_agg(line, chr(10) ORDER BY line_no) AS text FROM f WHERE key = '' OR b IS NULL OR key <> b OR h GROUP BY record_id""")
def consecutive_dupes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).select("record_id", C.drop_consecutive("text").alias("text"))


@query(rf"SELECT doc_id AS record_id, regexp_replace(text || '•“x”™', '[^\p{{L}}\p{{N}}\p{{M}}_\s.,;:!?%&@(){{}}\[\]/\\+\-=*''\x22`₹$€£#<>|^~–—]', ' ', 'g') AS text FROM documents")
def special_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).select("record_id", X.special_characters(F.concat("text", F.lit("•“x”™"))).alias("text"))


@query(r"SELECT doc_id AS record_id, regexp_replace(regexp_replace(chr(9) || chr(9) || text || chr(7) || 'x', '\t+', ' ', 'g'), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g') AS text FROM documents")
def tabs_and_nonprintable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).select("record_id", X.non_printable(X.tabs(F.concat(F.lit("\t\t"), "text", F.lit("\x07x")))).alias("text"))


@query(r"SELECT doc_id AS record_id, regexp_replace(replace(replace(text, '. ', '.' || chr(13) || chr(10) || chr(10) || chr(10) || chr(10)), chr(13) || chr(10), chr(10)), '\n{3,}', chr(10) || chr(10), 'g') AS text FROM documents")
def blank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).select("record_id", X.blank_lines(F.replace("text", F.lit(". "), F.lit(".\r\n\n\n\n"))).alias("text"))


@query(r"SELECT record_id, string_agg(regexp_replace(regexp_replace(regexp_replace(line, ' {2,}', ' ', 'g'), '^\s+', ''), '\s+$', ''), chr(10) ORDER BY line_no) AS text FROM (" + _LINES.format("(SELECT doc_id AS record_id, replace(text, ' a', '   a') AS text FROM documents)") + ") GROUP BY record_id")
def line_spaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).select("record_id", X.spaces(F.replace("text", F.lit(" a"), F.lit("   a"))).alias("text"))


@query("SELECT doc_id AS record_id, replace(replace(translate(translate('“' || replace(text, 'e ', '’ — ') || '‑x−', '‘’‚‛′‵“”„‟″‶', '''''''''''''\"\"\"\"\"\"'), '‐‑‒–−', '-----'), '—', ' - '), '―', ' - ') AS text FROM documents")
def quotes_hyphens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).select("record_id", X.hyphens(X.quotes(F.concat(F.lit("“"), F.replace("text", F.lit("e "), F.lit("’ — ")), F.lit("‑x−")))).alias("text"))


@query(r"SELECT doc_id AS record_id, regexp_replace('• ' || replace(text, chr(10), chr(10) || '◦ '), '(?m)^\s*[•●▪▫◦‣⁃]\s+', '- ', 'g') AS text FROM documents WHERE length(text) > 0")
def bullets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).where(F.length("text") > 0).select("record_id", X.bullets(F.concat(F.lit("• "), F.replace("text", F.lit("\n"), F.lit("\n◦ ")))).alias("text"))


@query(f"SELECT record_id, count(*) FILTER ({_HEADING.format('s')}) AS n FROM (SELECT record_id, {STRIP.format('line')} AS s FROM ({_LINES.format('(SELECT doc_id AS record_id, text FROM documents)')})) GROUP BY record_id")
def heading_like_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.size(F.filter(X.lines("text"), lambda x: X.heading_like(x, company_suffix=True)))
    return reports(spark, sf_dir).select("record_id", n.cast("long").alias("n"))


_PLAIN_KEY = KEY.format(r"regexp_replace(regexp_replace({0}, '^:+', ''), ':+$', '')")
_HEADN = rf"(length({{0}}) BETWEEN 1 AND 120 AND NOT regexp_matches({{0}}, '[.,;]$') AND regexp_matches({{0}}, '[A-Za-z&'']') AND ({_PLAIN_KEY} IN ({_HEADS}) OR {_SHAPE}))"


@query(f"SELECT record_id, (count(*) FILTER ({_HEADN.format('s')}))::INT AS n FROM (SELECT record_id, {STRIP.format('line')} AS s FROM ({_LINES.format('(SELECT doc_id AS record_id, text FROM documents)')})) GROUP BY record_id")
def heading_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).select("record_id", C.heading_count("text").alias("n"))


@query()
def nfkc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).select("record_id", C.nfkc("text").alias("text"))


@query("SELECT doc_id AS record_id, regexp_replace(text, '\\n$', '') AS text FROM documents")
def contents_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    toc = F.lit("Contents\nOne ..... 1\nTwo ..... 2\nThree ..... 3\n")
    return reports(spark, sf_dir).select("record_id", C.drop_contents(F.concat(toc, "text")).alias("text"))


@query()
def acronyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).select("record_id", X.acronyms("text").alias("text"))


@query()
def cleaned_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.normalize(C.clean(paged(spark, sf_dir)))


@query("SELECT conv_id AS record_id, string_agg(t, chr(10) || chr(10) ORDER BY turn, t) AS text FROM (SELECT conv_id, turn, text AS t FROM conversations WHERE " + STRIP.format("text") + " <> '') GROUP BY conv_id")
def page_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.combine_pages(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("record_id"), F.col("turn").alias("page_number"), "text"))


@query(f"WITH g AS (SELECT conv_id AS record_id, sum(length({STRIP.format('text')}))::BIGINT AS n_chars, count(*) AS n, sum((length({STRIP.format('text')}) < 50)::INT) AS e FROM conversations GROUP BY 1), h AS (SELECT record_id, n_chars, {RATIO.format('e', 'n', '1.0')} AS empty_share FROM g) SELECT *, n_chars < 500 OR empty_share >= 0.6 AS scanned FROM h")
def scanned_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.scanned(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("record_id"), "text"))


# ---- headings and sections; each report gets three headings
_HEADED = "(SELECT doc_id AS record_id, 'Innovation' || chr(10) || text || chr(10) || 'Human Resources' || chr(10) || text || chr(10) || 'Technology Strategy' || chr(10) || 'Über ' || text AS text FROM (SELECT doc_id, replace(text, chr(10), ' ') || '.' AS text FROM documents))"


def headed(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.concat(F.replace("text", F.lit("\n"), F.lit(" ")), F.lit("."))
    return reports(spark, sf_dir).select("record_id", F.concat(F.lit("Innovation\n"), t, F.lit("\nHuman Resources\n"), t, F.lit("\nTechnology Strategy\nÜber "), t).alias("text"))


_FOUND = f"""h(line, heading) AS (VALUES ('Innovation', 'Innovation'), ('Human Resources', 'Human Resources'), ('Technology Strategy', 'Technology')),
    hd AS (SELECT * FROM {_HEADED}), ln AS (SELECT record_id, line_no, line, (sum(length(line) + 1) OVER (PARTITION BY record_id ORDER BY line_no) - length(line) - 1)::BIGINT AS start FROM ({_LINES.format("hd")})),
    fd AS (SELECT record_id, heading, start, start + length(ln.line) AS "end", ln.line FROM ln JOIN h ON ln.line = h.line)"""
_SPANS = (
    _FOUND
    + r""", sp AS (SELECT record_id, heading AS name, start, coalesce(nxt, length(text)) AS "end", text FROM (SELECT *, lead(start) OVER (PARTITION BY record_id ORDER BY start) AS nxt FROM fd) JOIN hd USING (record_id) WHERE heading <> 'Human Resources'),
    sec AS (SELECT record_id, name, start, "end", regexp_replace("""
    + STRIP.format(r"regexp_replace(regexp_replace(regexp_replace(substring(text, start + 1, \"end\" - start), '[ \t]+', ' ', 'g'), '(?m) +$', '', 'g'), '(?m)^ +', '', 'g')").replace('\\"', '"')
    + r""", '\n{3,}', chr(10) || chr(10), 'g') AS text FROM sp)"""
)


@query(f'WITH {_FOUND} SELECT record_id, heading, start, "end", 1.0::DOUBLE AS confidence, line FROM fd')
def heading_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.headings(headed(spark, sf_dir), False).select("record_id", "heading", "start", "end", "confidence", "line")


@query(f'WITH {_SPANS} SELECT record_id, name, row_number() OVER (PARTITION BY record_id ORDER BY start)::INT AS ord, start, "end", text FROM sec WHERE length(text) >= 40')
def section_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = headed(spark, sf_dir)
    return S.sections(r, S.headings(r, False))


@query(rf"WITH {_SPANS} SELECT record_id, name, length(text) AS character_count, len(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS word_count, text <> '' AS present, substring(text, 1, 500) AS preview FROM sec WHERE length(text) >= 40")
def section_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.summary(section_spans(spark, sf_dir))


@query("SELECT record_id, name, min(o)::INT AS ord, string_agg(text, chr(10) || chr(10) ORDER BY o, text) AS text FROM (SELECT conv_id AS record_id, role AS name, text, min(turn) AS o FROM conversations GROUP BY ALL) GROUP BY record_id, name")
def section_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("record_id"), F.col("role").alias("name"), F.col("turn").cast("int").alias("ord"), "text")
    return S.merge(x)


@query(f"WITH {_SPANS}, r AS (SELECT doc_id AS record_id, text FROM documents), f AS (SELECT * FROM sec WHERE length(text) >= 1500) SELECT record_id, name, text FROM f UNION ALL SELECT record_id, 'Full Report', text FROM r WHERE record_id NOT IN (SELECT record_id FROM f)")
def full_report_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.or_full_report(reports(spark, sf_dir), S.sections(headed(spark, sf_dir), S.headings(headed(spark, sf_dir), False), least=1500)).select("record_id", "name", "text")


@query(f"WITH {_SPANS}, f AS (SELECT DISTINCT record_id, name FROM sec WHERE length(text) >= 40), n AS (SELECT r.record_id, count(name) AS n, coalesce(string_agg(name, '|' ORDER BY name), '') AS detected FROM (SELECT record_id FROM hd) r LEFT JOIN f USING (record_id) GROUP BY 1) SELECT record_id, detected, n::INT AS n_detected, {RATIO.format('n', '10', '100.0')} AS percentage FROM n")
def section_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = K.coverage(headed(spark, sf_dir), section_spans(spark, sf_dir))
    return c.select("record_id", F.array_join("detected", "|").alias("detected"), "n_detected", "percentage")


@query()
def heading_fuzzy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.headings(reports(spark, sf_dir).select("record_id", F.concat(F.lit("1. Innovation\n"), "text").alias("text")))


@query()
def markdown_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = score_table(spark, sf_dir).withColumnRenamed("ticker", "company_name")
    return A.markdown(s, category_stats(spark, sf_dir), S.merge(section_spans(spark, sf_dir)))


@query(f"WITH {STATS} SELECT record_id, string_agg((CASE WHEN count = 0 THEN 'Strengthen ' WHEN count < 5 THEN 'Moderate ' ELSE 'Strong ' END) || category || ' disclosure', '|' ORDER BY cat_pos) AS found FROM stats GROUP BY record_id")
def parse_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markdown_reports(spark, sf_dir).select("record_id", F.array_join(A.parse_recommendations("markdown"), "|").alias("found"))


# ---- validation: the labels' two marks are the counts by hand and by machine
_AUTO = "(SELECT company, keyword, sum(n)::BIGINT AS n FROM (SELECT source AS company, 'quality' AS keyword, quality + doc_id % 3 AS n FROM labels JOIN documents USING (doc_id) UNION ALL SELECT source, 'toxic', toxic FROM labels JOIN documents USING (doc_id)) GROUP BY ALL)"
_MAN = "(SELECT company, keyword, sum(n)::BIGINT AS n FROM (SELECT source AS company, 'quality' AS keyword, quality * 2 AS n FROM labels JOIN documents USING (doc_id) UNION ALL SELECT source, 'length', (n_chars > 900)::INT FROM labels JOIN documents USING (doc_id)) GROUP BY ALL)"
_CMP = f"a AS {_AUTO}, b AS {_MAN}, cmp AS (SELECT coalesce(a.company, b.company) AS company, coalesce(a.keyword, b.keyword) AS keyword, coalesce(b.n, 0) AS manual_count, coalesce(a.n, 0) AS automated_count FROM a FULL JOIN b ON a.company = b.company AND a.keyword = b.keyword), c AS (SELECT *, automated_count - manual_count AS difference, least(automated_count, manual_count) AS matched_count, automated_count = manual_count AS is_exact_match FROM cmp)"


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("company"), "n_chars"), "doc_id")


def auto_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _labelled(spark, sf_dir).select("company", (F.col("quality") + F.col("doc_id") % 3).alias("quality"), F.col("toxic").cast("long").alias("toxic"))
    return V.manual_counts(j)


def manual_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = _labelled(spark, sf_dir)
    q = j.select(F.col("company").alias("Company Name"), F.lit(" Quality").alias("Keyword"), (F.col("quality") * 2).cast("string").alias("Manual Count"))
    n = j.select(F.col("company").alias("Company Name"), F.lit("length").alias("Keyword"), (F.col("n_chars") > 900).cast("int").cast("string").alias("Manual Count"))
    return V.manual_counts(q.union(n))


@query(f"SELECT * FROM {_MAN}")
def validation_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manual_counts(spark, sf_dir)


@query(f"SELECT * FROM {_AUTO}")
def validation_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return auto_counts(spark, sf_dir)


@query(f"WITH {_CMP} SELECT * FROM c")
def compare_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.compare(auto_counts(spark, sf_dir), manual_counts(spark, sf_dir))


_CONF = _CMP + ", t AS (SELECT company, sum(matched_count)::BIGINT AS tp, sum(greatest(difference, 0))::BIGINT AS fp, sum(greatest(-difference, 0))::BIGINT AS fn FROM c GROUP BY 1)"


@query(f"WITH {_CONF} SELECT * FROM t")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.confusion(compare_counts(spark, sf_dir))


@query(f"""WITH {_CONF}, q AS (SELECT *, {RATIO.format("tp", "(tp + fp)", "1.0")} AS precision, {RATIO.format("tp", "(tp + fn)", "1.0")} AS recall, CASE WHEN tp + fp + fn > 0 THEN {R4.format("tp::DOUBLE / (tp + fp + fn)")} ELSE 1.0 END AS accuracy FROM t)
    SELECT *, {RATIO.format("(precision * recall * 2.0::DOUBLE)", "(precision + recall)", "1.0")} AS f1,
           CASE WHEN precision >= 0.9 AND recall >= 0.9 THEN 'High extraction quality' WHEN precision >= 0.75 AND recall >= 0.7 THEN 'Acceptable extraction quality; review count differences'
                WHEN precision < 0.75 AND recall < 0.7 THEN 'Low extraction quality; review false matches and missing keywords' WHEN precision < 0.75 THEN 'Precision below threshold; review false matches' ELSE 'Recall below threshold; review missing keywords' END AS comments FROM q""")
def precision_recall_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.quality(confusion(spark, sf_dir))


@query(f"WITH {_CMP} SELECT company, coalesce(string_agg(keyword, '|' ORDER BY keyword) FILTER (difference < 0), '') AS missing_keywords, coalesce(string_agg(keyword, '|' ORDER BY keyword) FILTER (difference > 0), '') AS false_matches FROM c GROUP BY company")
def missing_false_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.differences(compare_counts(spark, sf_dir)).select("company", F.array_join("missing_keywords", "|").alias("missing_keywords"), F.array_join("false_matches", "|").alias("false_matches"))


@query(f"WITH {COUNTS} SELECT r.record_id, ticker, report_year, k.keyword, coalesce(n, 0) AS automated_count, NULL::BIGINT AS manual_count, 'Pending' AS review_status FROM rep r CROSS JOIN (SELECT DISTINCT keyword FROM e) k LEFT JOIN cnt ON cnt.record_id = r.record_id AND cnt.keyword = k.keyword")
def validation_ready(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.ready(reports(spark, sf_dir).select("record_id", "ticker", "report_year"), counts(spark, sf_dir), entries(spark))


@query(f"WITH {_MAN.replace('(SELECT', 'b AS (SELECT', 1)}, r AS (SELECT DISTINCT source AS ticker FROM documents) SELECT upper(r.ticker) AS record_id, b.keyword, b.n FROM r JOIN b ON lower(b.company) = lower(r.ticker)")
def validate_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = reports(spark, sf_dir).select(F.upper("ticker").alias("record_id"), F.lit("unknown").alias("company_name"), F.upper("ticker").alias("ticker")).distinct()
    return V.manual_for(r, manual_counts(spark, sf_dir))


@query(f"WITH {SCORES} SELECT record_id, overall_score, keyword_density AS raw_keyword_density, total_word_count AS raw_total_word_count, 'a, b' AS tags FROM scores")
def flatten_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = score_table(spark, sf_dir)
    raw = F.struct("keyword_density", "total_word_count")
    return A.flatten(s.select("record_id", "overall_score", raw.alias("raw"), F.array(F.lit("a"), F.lit("b")).alias("tags")))


# ---- more of the dashboard, the files and the run
@query(f"WITH {STATS} SELECT category, ticker, sum(count)::BIGINT AS count FROM stats JOIN rep USING (record_id) GROUP BY category, ticker")
def category_by_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = category_stats(spark, sf_dir).join(reports(spark, sf_dir).select("record_id", "ticker"), "record_id")
    return c.groupBy("category", "ticker").agg(F.sum("count").alias("count"))


@query(r"SELECT doc_id AS record_id, regexp_replace(regexp_replace(regexp_replace(replace(text, '. ', '. ' || chr(9) || chr(13) || chr(10) || chr(13) || chr(10) || chr(10)), '\r\n?', chr(10), 'g'), '[ \t]+\n', chr(10), 'g'), '\n{3,}', chr(10) || chr(10), 'g') AS text FROM documents")
def newline_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).select("record_id", X.newlines(F.replace("text", F.lit(". "), F.lit(". \t\r\n\r\n\n"))).alias("text"))


@query(r"SELECT record_id, string_agg(regexp_replace(regexp_replace(regexp_replace(line, '[^\S\r\n]{2,}', ' ', 'g'), '^\s+', ''), '\s+$', ''), chr(10) ORDER BY line_no) AS text FROM (" + _LINES.format("(SELECT doc_id AS record_id, replace(text, ' a', ' ' || chr(9) || ' a') AS text FROM documents)") + ") GROUP BY record_id")
def inline_blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir).select("record_id", X.inline_spaces(F.replace("text", F.lit(" a"), F.lit(" \t a"))).alias("text"))


@query(r"""WITH a AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace('. ' || url || '??', '[<>:"/\\|?*\x00-\x1f]', '_', 'g'), '\s+', ' ', 'g'), '^[ .]+', ''), '[ .]+$', '') AS s FROM pages)
    SELECT page_id, regexp_replace(substring(CASE WHEN s = '' THEN 'untitled' ELSE regexp_replace(s, '_+', '_', 'g') END, 1, 40), '[ .]+$', '') AS name FROM a""")
def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.safe_filename(F.concat(F.lit(". "), "url", F.lit("??")), most=40).alias("name"))


_RECORDS = "(SELECT doc_id AS record_id, CASE WHEN lang = 'es' THEN ' ' ELSE source END AS company_name, lang AS ticker, (1850 + n_chars % 300)::INT AS report_year, CASE WHEN lang = 'de' THEN 'ftp://x.y' ELSE 'https://x.y/' || source END AS source_url, n_chars / 20.0::DOUBLE AS disclosure_score FROM documents)"


@query(f"""SELECT record_id, problem FROM (SELECT record_id, unnest([CASE WHEN trim(company_name) = '' THEN 'company_name is blank' END, CASE WHEN report_year NOT BETWEEN 1900 AND year(current_date) + 1 THEN 'report_year is out of range' END,
    CASE WHEN NOT regexp_matches(source_url, '^https?://[^/\\s]+') THEN 'source_url isn''t a web address' END, CASE WHEN disclosure_score NOT BETWEEN 0 AND 100 THEN 'disclosure_score is out of range' END]) AS problem FROM {_RECORDS}) WHERE problem IS NOT NULL""")
def record_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    name = F.when(F.col("lang") == "es", " ").otherwise(F.col("source"))
    url = F.when(F.col("lang") == "de", "ftp://x.y").otherwise(F.concat(F.lit("https://x.y/"), "source"))
    return A.violations(d.select(F.col("doc_id").alias("record_id"), name.alias("company_name"), F.col("lang").alias("ticker"), (1850 + F.col("n_chars") % 300).cast("int").alias("report_year"), url.alias("source_url"), (F.col("n_chars") / 20.0).alias("disclosure_score")))


@query("SELECT DISTINCT o_orderpriority FROM orders WHERE trim(o_orderpriority) <> ''")
def distinct_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.options(table(spark, sf_dir, "orders"), "o_orderpriority")


@query("SELECT o_orderkey, CASE WHEN p = floor(p) THEN p::BIGINT::VARCHAR ELSE p::VARCHAR END AS shown FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN floor(o_totalprice::DOUBLE) ELSE o_totalprice::DOUBLE END AS p FROM orders)")
def numbers_shown(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("o_totalprice").cast("double")
    return table(spark, sf_dir, "orders").select("o_orderkey", A.number_text(F.when(F.col("o_orderkey") % 2 == 0, F.floor(p).cast("double")).otherwise(p)).alias("shown"))


@query(f"WITH c AS ({_COMPANY}) SELECT * FROM c WHERE report_year::VARCHAR IN ('2021', '2024') AND ticker IN ('BUILDING', 'MACHINERY')")
def chosen_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.where_in(companies(spark, sf_dir), {"report_year": ["2021", "2024"], "ticker": ["BUILDING", "MACHINERY"], "company_name": []})


@query("SELECT doc_id, stem AS _record_id, path AS _workbook_path, regexp_replace(stem, '_(?:19|20)\\d{2}$', '') AS company_name, coalesce(ticker, upper(regexp_replace(stem, '_(?:19|20)\\d{2}$', ''))) AS ticker, y AS report_year FROM (SELECT doc_id, source || '_' || (2000 + n_chars % 30) AS stem, '/out/' || source || '_' || (2000 + n_chars % 30) || '_analysis.xlsx' AS path, CASE WHEN lang <> 'en' THEN lang END AS ticker, (2000 + n_chars % 30)::INT AS y FROM documents)")
def identity_attached(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    path = F.concat(F.lit("/out/"), "source", F.lit("_"), (2000 + F.col("n_chars") % 30).cast("string"), F.lit("_analysis.xlsx"))
    return A.with_identity(d.select("doc_id", path.alias("p"), F.when(F.col("lang") != "en", F.col("lang")).alias("ticker")), "p").drop("p")


@query("SELECT DISTINCT '/x/' || source || '_' || lang || '_analysis.xlsx' AS path, CASE WHEN lang = 'en' THEN '/r/' || source || '_' || lang || '_report.md' END AS report FROM documents")
def report_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("source", "lang").distinct()
    books = d.select(F.concat(F.lit("/x/"), "source", F.lit("_"), "lang", F.lit("_analysis.xlsx")).alias("path"))
    return A.report_paths(books, d.where("lang = 'en'").select(F.concat(F.lit("/r/"), "source", F.lit("_"), "lang", F.lit("_report.md")).alias("path")))


@query("SELECT doc_id, lang, CASE lang WHEN 'fr' THEN 0 ELSE 1 END AS ord FROM documents WHERE lang IN ('fr', 'en')")
def custom_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.in_order(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", ["fr", "en"])


@query("SELECT s_suppkey, coalesce(seg, 'Not available') AS industry FROM supplier LEFT JOIN (SELECT c_nationkey, arg_min(c_mktsegment, c_custkey) AS seg FROM customer GROUP BY 1) ON s_nationkey = c_nationkey")
def first_industry(spark: SparkSession, sf_dir: str) -> DataFrame:
    look = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("ticker"), F.col("c_mktsegment").alias("industry"), "c_custkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").cast("string").alias("ticker"))
    return A.enrich(s, look, order="c_custkey").select("s_suppkey", "industry")


@query(f"SELECT * FROM {_AUTO}")
def validation_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = auto_counts(spark, sf_dir).groupBy("company").agg(F.map_from_entries(F.collect_list(F.struct("keyword", F.col("n").cast("string")))).alias("m"))
    return V.mapping_counts(g.select(F.to_json(F.create_map("company", "m")).alias("counts")))


@query(f"WITH {DICT} SELECT category, keyword FROM e WHERE category = 'Licensing'")
def category_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = K.keywords_of(entries(spark), " Licensing ")
    return spark.createDataFrame([("Licensing", k) for k in found], "category string, keyword string")


@query()
def whole_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaning, headings, sections, counts and scores of all documents as one run."""
    r = headed(spark, sf_dir)
    c = reports(spark, sf_dir).select("record_id", F.col("ticker").alias("company_name"), "ticker", "industry", "report_year")
    res = disclosure.analyse(c, r, entries(spark), False)
    n = res.sections.groupBy("record_id").agg(F.array_join(F.array_sort(F.collect_list("name")), "|").alias("sections"))
    return res.status.join(n, "record_id", "left").join(res.scores.select("record_id", "total_word_count", "section_coverage", "overall_score"), "record_id", "left")
