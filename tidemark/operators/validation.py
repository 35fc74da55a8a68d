"""Automated keyword counts against manual ones: long tables (company, keyword, n)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import lexicons as L
from tidemark.functions import text as X

COMPANY, KEYWORD, COUNT = ("company", "company_name", "ticker"), ("keyword", "keywords", "term"), ("manual_count", "count", "manual")
NOT_KEYWORDS = frozenset((*COMPANY, "industry", "report_year", "year", "source_url", "report_path"))


def first_of(columns: Sequence[str], wanted: Sequence[str]) -> str | None:
    return next((c for c in wanted if c in columns), None)


def label(c: X.Text) -> Column:
    """A name with single spaces; one that is missing or blank is an error."""
    s = X.strip(X.collapse(X.col(c).cast("string")))
    return F.when(F.coalesce(s, F.lit("")) == "", F.raise_error(F.lit("a company or keyword is missing"))).otherwise(s)


def mapping_counts(df: DataFrame, column: str = "counts") -> DataFrame:
    """company, keyword, n from a map of companies to maps of keywords to counts, or from such a JSON object as text; equal ones add up."""
    kind = "map<string,map<string,string>>"
    whole = F.from_json(column, kind) if dict(df.dtypes)[column] == "string" else F.col(column).cast(kind)
    bad = F.raise_error(F.lit("manual counts aren't a mapping of companies"))
    rows = df.select(F.explode(F.when(whole.isNull() & F.col(column).isNotNull(), bad).otherwise(whole)).alias("c", "m")).select("c", F.explode("m").alias("k", "count"))
    rows = rows.select(label("c").alias("company"), X.casefold(label("k")).alias("keyword"), count("count").alias("n"))
    return rows.groupBy("company", "keyword").agg(F.sum("n").cast("long").alias("n"))


def flat_counts(df: DataFrame, column: str = "counts") -> DataFrame:
    """keyword and n from a map of keywords to counts, or of categories to such maps; equal keywords add up."""
    nested = dict(df.dtypes)[column].startswith("map<string,map")
    rows = df.select(F.explode(column).alias("c", "m")).select(F.explode("m").alias("k", "count")) if nested else df.select(F.explode(column).alias("k", "count"))
    return rows.groupBy(X.casefold(label("k")).alias("keyword")).agg(F.sum(F.col("count").cast("long")).alias("n"))


def count(c: X.Text) -> Column:
    """A count from a number or its text; null is 0, anything but a whole number of 0 or more an error."""
    v = F.expr(f"try_cast(`{c}` as double)")
    bad = F.raise_error(F.concat(F.lit("not a count: "), F.col(c).cast("string")))
    return F.when(F.col(c).isNull() | F.isnan(v), F.lit(0)).when(v.isNull() | (v < 0) | (v != F.floor(v)), bad).otherwise(v).cast("long")


def manual_counts(df: DataFrame) -> DataFrame:
    """company, keyword, n from long rows (company, keyword, count) or wide ones (company, a column for each keyword); equal ones add up."""
    df = df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])
    company, keyword, n = (first_of(df.columns, x) for x in (COMPANY, KEYWORD, COUNT))
    if company is None:
        raise ValueError("validation data needs a company, company_name or ticker column")
    if keyword and n:
        long = df.select(label(company).alias("company"), X.casefold(label(keyword)).alias("keyword"), count(n).alias("n"))
    else:
        names = [c for c in df.columns if c not in NOT_KEYWORDS]
        if not names:
            raise ValueError("wide validation data has no keyword columns")
        long = df.select(label(company).alias("company"), *[count(c).alias(c) for c in names]).unpivot("company", names, "keyword", "n")
    return long.groupBy("company", "keyword").agg(F.sum("n").cast("long").alias("n"))


def compare(auto: DataFrame, manual: DataFrame) -> DataFrame:
    """company, keyword, both counts, difference, matched_count, is_exact_match, for companies on the automated side."""
    a = auto.select("company", "keyword", F.col("n").alias("a"))
    m = manual.join(auto.select("company").distinct(), "company", "left_semi").select("company", "keyword", F.col("n").alias("m"))
    j = a.join(m, ["company", "keyword"], "full_outer").select("company", "keyword", F.coalesce("m", F.lit(0)).cast("long").alias("manual_count"), F.coalesce("a", F.lit(0)).cast("long").alias("automated_count"))
    d = F.col("automated_count") - F.col("manual_count")
    return j.select("*", d.alias("difference"), F.least("automated_count", "manual_count").alias("matched_count"), (d == 0).alias("is_exact_match"))


def confusion(compared: DataFrame) -> DataFrame:
    d = F.col("difference")
    return compared.groupBy("company").agg(F.sum("matched_count").cast("long").alias("tp"), F.sum(F.greatest(d, F.lit(0))).cast("long").alias("fp"), F.sum(F.greatest(-d, F.lit(0))).cast("long").alias("fn"))


def observation(p: X.Text, r: X.Text) -> Column:
    p, r = X.col(p), X.col(r)
    return (
        F.when((p >= L.HIGH) & (r >= L.HIGH), "High extraction quality")
        .when((p >= L.MIN_PRECISION) & (r >= L.MIN_RECALL), "Acceptable extraction quality; review count differences")
        .when((p < L.MIN_PRECISION) & (r < L.MIN_RECALL), "Low extraction quality; review false matches and missing keywords")
        .when(p < L.MIN_PRECISION, "Precision below threshold; review false matches")
        .otherwise("Recall below threshold; review missing keywords")
    )


def quality(c: DataFrame, tn: int = 0) -> DataFrame:
    """Precision, recall, F1 (of the rounded two) and accuracy (1 where there is nothing) from tp, fp, fn."""
    x = lambda n: F.col(n).cast("double")
    c = c.select("*", X.ratio(x("tp"), x("tp") + x("fp")).alias("precision"), X.ratio(x("tp"), x("tp") + x("fn")).alias("recall"))
    f1 = X.ratio(F.col("precision") * F.col("recall") * 2.0, F.col("precision") + F.col("recall"))
    all_ = x("tp") + x("fp") + x("fn") + F.lit(float(tn))
    return c.select("*", f1.alias("f1"), F.when(all_ > 0, X.round4((x("tp") + F.lit(float(tn))) / all_)).otherwise(F.lit(1.0)).alias("accuracy"), observation("precision", "recall").alias("comments"))


def differences(compared: DataFrame) -> DataFrame:
    """company, missing_keywords (fewer found than by hand) and false_matches (more), sorted."""
    pick = lambda cond: F.array_sort(F.collect_list(F.when(cond, F.col("keyword"))))
    return compared.groupBy("company").agg(pick(F.col("difference") < 0).alias("missing_keywords"), pick(F.col("difference") > 0).alias("false_matches"))


def report(auto: DataFrame, manual: DataFrame) -> DataFrame:
    """The whole validation of each company; one without manual counts is an error."""
    if auto.select("company").distinct().join(manual, "company", "left_anti").limit(1).count():
        raise KeyError("no manual validation data for a company")
    c = compare(auto, manual)
    return quality(confusion(c)).join(differences(c), "company")


def optional_report(auto: DataFrame, manual: DataFrame | None) -> DataFrame | None:
    """The validation of those companies that have manual counts; without any table of them, none."""
    return None if manual is None else report(auto.join(manual.select("company").distinct(), "company", "left_semi"), manual)


def manual_for(records: DataFrame, manual: DataFrame) -> DataFrame:
    """record_id, keyword, n: each record's manual counts, by its company's name, else by its ticker, in any case."""
    m = manual.select(X.casefold("company").alias("c"), "keyword", "n")
    names = m.select("c").distinct()
    r = records.select("record_id", X.casefold("company_name").alias("a"), X.casefold("ticker").alias("b"))
    r = r.join(names.select(F.col("c").alias("a"), F.lit(True).alias("by_name")), "a", "left")
    r = r.select("record_id", F.when(F.col("by_name"), F.col("a")).otherwise(F.col("b")).alias("c"))
    return r.join(m, "c").select("record_id", "keyword", "n")


def ready(records: DataFrame, counts: DataFrame, e: DataFrame) -> DataFrame:
    """A row for each record and dictionary keyword, zeros too, waiting for its manual count."""
    n = counts.groupBy("record_id", "keyword").agg(F.sum("n").cast("long").alias("automated_count"))
    base = records.crossJoin(F.broadcast(e.select("keyword").distinct())).join(n, ["record_id", "keyword"], "left")
    return base.select(*records.columns, "keyword", F.coalesce("automated_count", F.lit(0)).cast("long").alias("automated_count"), F.lit(None).cast("long").alias("manual_count"), F.lit("Pending").alias("review_status"))
