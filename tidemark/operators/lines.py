"""Cleaning of reports as line algebra (record_id, text).

A report's lines stay in its row, counts of repeated ones included, so that cleaning reads each report once. Its one
shuffle deals texts to all cores. Only tables of line counts are grouped.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import lexicons as L
from tidemark.functions import text as X


def explode_lines(reports: DataFrame, text: str = "text") -> DataFrame:
    """record_id, line_no (from 0) and line."""
    return reports.select("record_id", F.posexplode(X.lines(text)).alias("line_no", "line"))


def pages_of(text: X.Text) -> Column:
    """Likely pages: at page breaks, else between lines of a number; blank ones go."""
    full = lambda a: F.filter(a, lambda p: X.strip(p) != "")
    return X.let(text, lambda t: X.let(full(F.split(t, L.PAGE_BREAK)), lambda p: F.when(F.size(p) > 1, p).otherwise(full(F.split(t, L.PAGE_MARK)))))


def repeated_candidate(line: X.Text) -> Column:
    s = X.strip(line)
    return (s != "") & (F.length(s) <= 120) & s.rlike("[A-Za-z]") & ~X.heading_like(s, company_suffix=True)


def threshold(pages: X.Text, least: int = 3, share: float = 0.35) -> Column:
    return F.greatest(F.lit(least), F.floor(X.col(pages) * F.lit(share)).cast("int"))


def candidate_keys(a: Column) -> Column:
    return F.transform(F.filter(a, repeated_candidate), X.canonical_line)


def edge_keys(pages: X.Text, at_start: bool, edge: int = 3) -> Column:
    """Keys of the candidates among the first (or last) lines of pages."""
    some = lambda a: F.slice(a, 1, edge) if at_start else F.slice(a, F.greatest(F.lit(1), F.size(a) - edge + 1), edge)
    return candidate_keys(F.flatten(F.transform(X.col(pages), lambda p: X.let(F.filter(X.lines(p), lambda x: X.strip(x) != ""), some))))


def edge_lines(reports: DataFrame, at_start: bool, edge: int = 3) -> DataFrame:
    """record_id, key and n of lines that repeat among the first (or last) lines of a report's pages; two pages at least."""
    p = reports.select("record_id", pages_of("text").alias("pages")).where("size(pages) > 1")
    e = p.select("record_id", F.size("pages").alias("n_pages"), F.explode(edge_keys("pages", at_start, edge)).alias("key"))
    n = e.groupBy("record_id", "n_pages", "key").agg(F.count("*").alias("n"))
    return n.where(F.col("n") >= threshold("n_pages")).select("record_id", "key", "n")


def repeated_lines(reports: DataFrame) -> DataFrame:
    """record_id, key and n of lines that repeat anywhere in a report."""
    pages = reports.select("record_id", F.size(pages_of("text")).alias("n_pages"))
    e = explode_lines(reports).where(repeated_candidate("line"))
    n = e.groupBy("record_id", X.canonical_line("line").alias("key")).agg(F.count("*").alias("n")).join(pages, "record_id")
    return n.where(F.col("n") >= threshold("n_pages")).select("record_id", "key", "n")


def occurring(keys: Column, n_pages: Column) -> Column:
    """Those of a report's keys that reach the threshold. Sorted, such a key equals the one so many places on, less one."""
    on = lambda k: X.let(threshold(n_pages), lambda n: F.zip_with(k, F.slice(k, n, F.greatest(F.lit(0), F.size(k) - n + 1)), lambda a, b: F.when(a == b, a)))
    return F.array_distinct(F.filter(X.let(F.sort_array(keys), on), lambda x: x.isNotNull()))


def without_keys(text: Column, keys: Column) -> Column:
    """A text without its lines of these keys, but what reads like a heading stays."""
    kept = lambda k: F.filter(X.lines(text), lambda x: ~F.array_contains(k, X.canonical_line(x)) | X.heading_like(x, company_suffix=True))
    return X.let(keys, lambda k: F.when(F.size(k) > 0, F.array_join(kept(k), "\n")).otherwise(text))


def drop_edges(text: X.Text, at_start: bool) -> Column:
    """A report's text without headers (or footers): what edge_lines counts, within the row."""
    keys = lambda p: F.when(F.size(p) > 1, occurring(edge_keys(p, at_start), F.size(p)))
    return X.let(text, lambda t: without_keys(t, X.let(pages_of(t), keys)))


def drop_repeated(text: X.Text) -> Column:
    """A report's text without what repeated_lines counts, within the row."""
    return X.let(text, lambda t: without_keys(t, occurring(candidate_keys(X.lines(t)), F.size(pages_of(t)))))


def drop_page_numbers(text: X.Text) -> Column:
    return F.array_join(F.filter(X.lines(text), lambda x: ~x.rlike(L.PAGE_NUMBER)), "\n")


def drop_consecutive(text: X.Text) -> Column:
    """A line equal to the one before goes, but headings; blank lines part."""
    keyed = F.transform(X.lines(text), lambda x: F.struct(x.alias("l"), X.canonical_line(x).alias("k")))
    # lines beside the keys before theirs, so that no line looks an array up
    before = lambda a: F.zip_with(a, F.slice(F.concat(F.array(F.lit(None).cast("string")), F.transform(a, lambda p: p["k"])), 1, F.size(a)), lambda p, b: F.struct(p["l"].alias("l"), p["k"].alias("k"), b.alias("b")))
    rows = X.let(keyed, before)
    kept = F.filter(rows, lambda p: (p["k"] == "") | p["b"].isNull() | (p["k"] != p["b"]) | X.heading_like(p["l"], company_suffix=True))
    return F.array_join(F.transform(kept, lambda p: p["l"]), "\n")


def without_contents(text: str | None) -> str:
    """A text without the first table of contents in its first 250 lines: from its title to its last entry, or two blank lines."""
    rows = (text or "").splitlines()
    title, entry = re.compile(L.TOC_TITLE), re.compile(L.TOC_ENTRY)
    for start in (i for i, x in enumerate(rows[:250]) if title.match(x.strip())):
        seen = blank = 0
        end = start
        for i, x in enumerate(rows[start + 1 : start + 180], start + 1):
            blank = 0 if x.strip() else blank + 1
            if blank >= 2 and seen >= 3:
                end = i + 1
                break
            if blank:
                continue
            if entry.match(x.strip()):
                seen, last = seen + 1, i + 1
            elif seen >= 3:
                end = last
                break
        else:
            end = last if seen >= 3 else start
        if end > start:
            return "\n".join(rows[:start] + rows[end:])
    return text or ""


def attempted(f: Callable[[str | None], str], text: str | None) -> str | None:
    """f of a text; null where it fails, so that one report's failure isn't the run's."""
    try:
        return f(text)
    except Exception:
        return None


@F.pandas_udf(T.StringType())
def drop_contents(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """A state machine over at most 180 lines: no expression for it."""
    for t in texts:
        yield t.map(lambda x: attempted(without_contents, x))


def nfkc_text(text: str | None) -> str | None:
    return None if text is None else unicodedata.normalize("NFKC", text)


@F.pandas_udf(T.StringType())
def nfkc(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for t in texts:
        yield t.map(nfkc_text)


def mapped(reports: DataFrame, f: Callable[[str | None], str | None]) -> DataFrame:
    """f of each text, as a step of its own: Spark doesn't find a UDF whose argument holds loops within loops."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            i = b.schema.get_field_index("text")
            yield b.set_column(i, b.schema.field(i), pa.array(map(f, b.column(i).to_pylist()), b.schema.field(i).type))

    return reports.mapInArrow(run, reports.schema)


def clean(reports: DataFrame, headers_footers: bool = True) -> DataFrame:
    """Reports with cleaned texts: the whole chain, in its order. Null texts count as empty."""
    # cleaning is long work on short input, which few files or row groups would give to few cores
    r = reports.repartition(4 * reports.sparkSession.sparkContext.defaultParallelism, "record_id", "text")
    r = r.withColumn("text", drop_contents(X.tabs(F.coalesce("text", F.lit("")))))  # null where it failed
    if headers_footers:
        r = r.withColumn("text", drop_edges(drop_edges("text", True), False))
    r = r.withColumn("text", drop_consecutive(drop_repeated(drop_page_numbers("text"))))
    return r.withColumn("text", X.strip(X.blank_lines(X.spaces(X.non_printable(X.special_characters("text"))))))


def normalize_headings(text: X.Text) -> Column:
    known = F.create_map(*[F.lit(v) for h in L.REPORT_HEADINGS for v in (h.lower(), h)])
    title = lambda x: F.regexp_replace(X.acronyms(x), "^[ :]+|[ :]+$", "")

    def one(line: Column) -> Column:
        s = X.strip(line)
        number, rest = F.regexp_extract(s, L.NUMBERED_HEADING, 1), F.regexp_extract(s, L.NUMBERED_HEADING, 2)
        return (
            F.when(s == "", F.lit(""))
            .when(X.known_heading(s), F.element_at(known, X.heading_key(s)))
            .when((rest != "") & X.heading_like(rest), F.concat(F.regexp_replace(number, r"\.+$", ""), F.lit(". "), title(rest)))
            .when(X.heading_like(s), title(s))
            .otherwise(s)
        )

    return X.each_line(text, one)


def normalize(reports: DataFrame, lowercase: bool = False) -> DataFrame:
    """Reports with normalised texts: the whole chain, in its order. Null texts stay null."""
    r = mapped(reports, nfkc_text)
    r = r.withColumn("text", X.inline_spaces(X.newlines(X.bullets(X.hyphens(X.quotes("text"))))))
    r = r.withColumn("text", X.newlines(X.inline_spaces(normalize_headings("text"))))
    r = r.withColumn("text", X.lower_but_acronyms("text")) if lowercase else r
    return r.withColumn("text", X.strip(X.acronyms("text")))


def heading_count(text: X.Text) -> Column:
    return F.size(F.filter(X.lines(text), lambda x: X.heading_like(x)))


def combine_pages(pages: DataFrame) -> DataFrame:
    """record_id and text: a record's pages (record_id, page_number, text) in order, blank ones left out."""
    full = pages.where(X.strip(F.coalesce("text", F.lit(""))) != "").select("record_id", F.struct("page_number", F.col("text").alias("t")).alias("p"))
    g = full.groupBy("record_id").agg(F.array_sort(F.collect_list("p")).alias("p"))  # a record's pages: one report
    return g.select("record_id", X.strip(F.array_join(F.transform("p", lambda x: x["t"]), "\n\n")).alias("text"))


def scanned(pages: DataFrame, page_chars: int = 50, pages_counted: int = 10, empty_share: float = 0.6) -> DataFrame:
    """record_id, n_chars, empty_share and scanned: too few characters in all, or on too many pages."""
    n = F.length(X.strip(F.coalesce("text", F.lit(""))))
    g = pages.groupBy("record_id").agg(F.sum(n).cast("long").alias("n_chars"), F.count("*").alias("n"), F.sum((n < page_chars).cast("long")).alias("e"))
    share = X.ratio(F.col("e").cast("double"), F.col("n").cast("double"))
    return g.select("record_id", "n_chars", share.alias("empty_share"), ((F.col("n_chars") < page_chars * pages_counted) | (share >= empty_share)).alias("scanned"))


def keep_last(df: DataFrame, key: str, order: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")
