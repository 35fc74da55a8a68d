"""Dictionaries of keywords, their counts in sections, categories, metrics and the disclosure score.

Everything is a long table: entries (category, keyword, cat_pos, pos), counts (record_id, section, keyword, n; n > 0) and
words (record_id, section, n_words).
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import lexicons as L
from tidemark.functions import text as X

#: Up to so many keywords are counted by one pattern each in a single pass; more by an equi-join of word runs.
PATTERNS = 400


def entries(raw: DataFrame, category: str = "Category", keyword: str = "Keyword", position: str = "pos") -> DataFrame:
    """category, keyword, cat_pos and pos of a dictionary's rows: normalised, the first of equal ones, none with a blank part."""
    e = raw.select(X.strip(X.collapse(F.coalesce(category, F.lit("")))).alias("category"), X.normalize_keyword(keyword).alias("keyword"), F.col(position).alias("pos")).where("category != '' and keyword != ''")
    e = e.groupBy("category", "keyword").agg(F.min("pos").alias("pos"))
    return e.select("category", "keyword", F.min("pos").over(Window.partitionBy("category")).alias("cat_pos"), "pos")


def default_entries(spark: SparkSession) -> DataFrame:
    rows = [(c, k) for c, ks in L.KEYWORDS.items() for k in ks]
    return entries(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "pos int, Category string, Keyword string"))


def grouped(e: DataFrame) -> DataFrame:
    """category, cat_pos and its keywords, by length, then letters."""
    g = e.groupBy("category", "cat_pos").agg(F.array_sort(F.collect_list(F.struct(F.length("keyword").alias("n"), "keyword"))).alias("k"))
    return g.select("category", "cat_pos", F.transform("k", lambda x: x["keyword"]).alias("keywords"))


def all_keywords(e: DataFrame) -> list[str]:
    """Distinct keywords in the dictionary's order; a dictionary is small."""
    return [r["keyword"] for r in e.groupBy("keyword").agg(F.min(F.struct("cat_pos", F.length("keyword"), "keyword")).alias("o")).orderBy("o").select("keyword").collect()]


def categories(e: DataFrame) -> list[str]:
    """The dictionary's categories, in its order."""
    return [r["category"] for r in e.groupBy("category").agg(F.min("pos").alias("p")).orderBy("p").collect()]


def keywords_of(e: DataFrame, category: str) -> list[str]:
    """A category's keywords, by length, then letters; white space in its name doesn't matter, case does. Unknown: none."""
    return [r["keyword"] for r in e.where(F.col("category") == " ".join(category.split())).select("keyword").orderBy(F.length("keyword"), "keyword").collect()]


def count_keywords(sections: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """record_id, section, keyword, n of the keywords that occur as whole words in sections (record_id, name, text)."""
    s = sections.select("record_id", F.col("name").alias("section"), X.match_text("text").alias("norm"))
    if not keywords:
        return s.select("record_id", "section", F.lit("").alias("keyword"), F.lit(0).cast("long").alias("n")).where("false")
    if len(keywords) > PATTERNS:
        return count_by_runs(s, keywords)
    edge = r"[\p{L}\p{N}]"
    one = [F.struct(F.lit(k).alias("keyword"), F.regexp_count("norm", F.lit(rf"\Q{k}\E(?<!{edge}\Q{k}\E)(?!{edge})")).cast("long").alias("n")) for k in keywords]
    return X.exploded(s.select("record_id", "section", F.filter(F.array(*one), lambda x: x["n"] > 0).alias("x")), "x").select("record_id", "section", "x.keyword", "x.n")


def count_by_runs(s: DataFrame, keywords: Sequence[str]) -> DataFrame:
    """The same by an equi-join of runs of words with the dictionary; for keywords of words alone, that don't overlap themselves. Others are counted by pattern."""
    plain = [k for k in keywords if re.fullmatch(r"[^\W_]+(?: [^\W_]+)*", k) and not any(k.split()[:i] == k.split()[-i:] for i in range(1, len(k.split())))]
    rest = [k for k in keywords if k not in set(plain)]
    spark = s.sparkSession
    k = spark.createDataFrame([(x, len(x.split())) for x in plain], "keyword string, size int")
    words = s.select("record_id", "section", F.filter(F.split("norm", r"[^\p{L}\p{N}]+"), lambda x: x != "").alias("w"))
    sizes = sorted({len(x.split()) for x in plain})
    runs = [words.where(F.size("w") >= n).select("record_id", "section", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - n + 1), lambda i: F.array_join(F.slice("w", i, n), " "))).alias("keyword")) for n in sizes]
    out = None
    for r in runs:
        out = r if out is None else out.union(r)
    got = out.join(k.select("keyword"), "keyword", "left_semi").groupBy("record_id", "section", "keyword").agg(F.count("*").alias("n"))
    few = [rest[i : i + PATTERNS] for i in range(0, len(rest), PATTERNS)]
    for part in few:
        got = got.unionByName(count_keywords(s.select("record_id", F.col("section").alias("name"), F.col("norm").alias("text")), part))
    return got


def count_fuzzy(sections: DataFrame, keywords: Sequence[str], least: float = 0.9, longest: int = 6) -> DataFrame:
    """Counts of runs that resemble a keyword, for keywords that a section doesn't have exactly; runs don't overlap."""

    def scan(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for rid, name, norm in zip(pdf["record_id"], pdf["section"], pdf["norm"], strict=True):
                words = norm.split()
                for k in keywords:
                    if re.search(rf"(?<![^\W_]){re.escape(k)}(?![^\W_])", norm):
                        continue
                    size, i, n = min(len(k.split()), longest), 0, 0
                    while size and i <= len(words) - size:
                        run = " ".join(words[i : i + size])
                        m = SequenceMatcher(None, run, k)
                        hit = m.real_quick_ratio() >= least and m.quick_ratio() >= least and m.ratio() >= least
                        n, i = n + hit, i + (size if hit else 1)
                    if n:
                        out.append((rid, name, k, n))
            yield pd.DataFrame(out, columns=["record_id", "section", "keyword", "n"])

    s = sections.select("record_id", F.col("name").alias("section"), X.match_text("text").alias("norm"))
    return s.mapInPandas(scan, f"record_id {dict(s.dtypes)['record_id']}, section string, keyword string, n long")


def words_of(sections: DataFrame) -> DataFrame:
    return sections.groupBy("record_id").agg(F.sum(X.word_count("text")).cast("long").alias("n_words"))


def frequency(counts: DataFrame) -> DataFrame:
    return counts.groupBy("record_id", "keyword").agg(F.sum("n").cast("long").alias("n"))


def category_statistics(records: DataFrame, counts: DataFrame, words: DataFrame, e: DataFrame) -> DataFrame:
    """One row for each record and category, with zeros: count, density per 1000 words, present, percentage of all keyword hits, both totals. A keyword of two categories counts in both, once in the total."""
    per = frequency(counts)
    c = per.join(F.broadcast(e.select("category", "keyword")), "keyword").groupBy("record_id", "category").agg(F.sum("n").cast("long").alias("count"))
    totals = per.groupBy("record_id").agg(F.sum("n").cast("long").alias("total"))
    cats = e.select("category", "cat_pos").distinct()
    base = records.select("record_id").join(totals, "record_id", "left").join(words, "record_id", "left").crossJoin(F.broadcast(cats))
    j = base.join(c, ["record_id", "category"], "left").select("record_id", "category", "cat_pos", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("total", F.lit(0)).alias("total_keyword_count"), F.coalesce("n_words", F.lit(0)).alias("word_count"))
    return j.select("record_id", "category", "cat_pos", "count", X.ratio(F.col("count").cast("double"), F.col("word_count"), 1000.0).alias("density"), (F.col("count") > 0).alias("present"), X.ratio(F.col("count").cast("double"), F.col("total_keyword_count"), 100.0).alias("percentage_contribution"), "total_keyword_count", "word_count")


def coverage(records: DataFrame, sections: DataFrame, expected: Sequence[str] = L.EXPECTED_SECTIONS) -> DataFrame:
    """record_id, detected, missing (lists in the expected order), n_detected, n_expected, percentage."""
    names = sections.groupBy("record_id").agg(F.collect_set(F.lower("name")).alias("names"))
    want = F.array(*[F.lit(x) for x in expected])
    r = records.select("record_id").join(names, "record_id", "left").withColumn("names", F.coalesce("names", F.array().cast("array<string>")))
    has = lambda x: F.array_contains("names", F.lower(x))
    r = r.select("record_id", F.filter(want, has).alias("detected"), F.filter(want, lambda x: ~has(x)).alias("missing"))
    n = F.size("detected")
    return r.select("*", n.alias("n_detected"), F.lit(len(expected)).alias("n_expected"), X.ratio(n.cast("double"), F.lit(len(expected)), 100.0).alias("percentage"))


def metrics(records: DataFrame, sections: DataFrame, counts: DataFrame, e: DataFrame, expected: Sequence[str] = L.EXPECTED_SECTIONS) -> DataFrame:
    """One row a record: keyword and word totals, density, unique keywords, categories present and known, section coverage, known keywords."""
    per = frequency(counts)
    t = per.groupBy("record_id").agg(F.sum("n").cast("long").alias("total_keyword_count"), F.count("*").alias("unique_keyword_count"))
    p = per.join(F.broadcast(e.select("category", "keyword")), "keyword").groupBy("record_id").agg(F.count_distinct("category").alias("categories_present"))
    sizes = e.agg(F.count_distinct("category").alias("categories_known"), F.greatest(F.lit(1), F.count_distinct("keyword")).alias("known_keyword_count"))
    out = records.select("record_id").join(t, "record_id", "left").join(p, "record_id", "left").join(words_of(sections), "record_id", "left").na.fill(0)
    out = out.join(coverage(records, sections, expected).select("record_id", F.col("percentage").alias("section_coverage")), "record_id").crossJoin(F.broadcast(sizes))
    return out.withColumnRenamed("n_words", "total_word_count").withColumn("keyword_density", X.ratio(F.col("total_keyword_count").cast("double"), F.col("total_word_count"), 1000.0))


def normalized(value, benchmark):
    """100 at the benchmark or above, 0 at or below none."""
    return F.when(benchmark > 0, X.round4(F.least(F.greatest(value / benchmark, F.lit(0.0)), F.lit(1.0)) * 100.0)).otherwise(F.lit(0.0))


def scores(m: DataFrame, weights: dict[str, float] | None = None, benchmark: float = L.DENSITY_BENCHMARK) -> DataFrame:
    """Metrics with the four component scores and overall_score, their weighted sum; weights must add up to 1."""
    w = weights or L.WEIGHTS
    if abs(sum(w.values()) - 1) > 5e-7 or set(w) != set(L.WEIGHTS):
        raise ValueError("weights of the four components must add up to 1")
    d = lambda c: F.col(c).cast("double")
    m = m.select(
        "*",
        normalized(d("keyword_density"), F.lit(benchmark)).alias("keyword_density_score"),
        normalized(d("categories_present"), d("categories_known")).alias("category_coverage_score"),
        normalized(d("section_coverage"), F.lit(100.0)).alias("section_coverage_score"),
        normalized(d("unique_keyword_count"), d("known_keyword_count")).alias("keyword_diversity_score"),
    )
    total = sum(F.col(f"{k}_score") * F.lit(x) for k, x in w.items())
    return m.withColumn("overall_score", X.round4(total))


def explanation():
    """The score's formula as a sentence."""
    s = lambda c: F.col(c).cast("string")
    return F.concat(
        F.lit("Overall Disclosure Score is a weighted mathematical score: 40% keyword density ("), s("keyword_density_score"), F.lit("), 30% category coverage ("), s("category_coverage_score"),
        F.lit("), 20% section coverage ("), s("section_coverage_score"), F.lit("), and 10% keyword diversity ("), s("keyword_diversity_score"), F.lit("). The final reproducible score is "), s("overall_score"), F.lit(" out of 100."),
    )


def recommendation(category="category", count="count"):
    name = F.replace(X.col(category), F.lit("_"), F.lit(" "))
    level = F.when(X.col(count) == 0, "Strengthen").when(X.col(count) < 5, "Moderate").otherwise("Strong")
    return F.concat_ws(" ", level, name, F.lit("disclosure"))
