"""Inputs: company master, keyword dictionary, manual counts, report texts and PDF pages."""

from __future__ import annotations

import importlib.util
import io
from collections.abc import Callable, Iterator, Sequence
from pathlib import PurePosixPath

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import lexicons as L
from tidemark.functions import text as X
from tidemark.operators import keywords as K
from tidemark.operators import lines as C


def squeezed(name: str) -> str:
    return "".join(c for c in name.strip().lower() if c in "abcdefghijklmnopqrstuvwxyz0123456789")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV, JSON (lines or one array), Parquet or ORC by suffix; Excel by the driver, where openpyxl is installed."""
    kind = PurePosixPath(path).suffix.lower()
    if kind == ".csv":
        return spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    if kind == ".json":
        return spark.read.option("multiLine", True).json(path)
    if kind in (".xlsx", ".xlsm", ".xls"):
        if not importlib.util.find_spec("openpyxl"):
            raise RuntimeError("reading Excel files needs openpyxl")
        return spark.createDataFrame(pd.read_excel(path, dtype=str))
    if kind == ".orc":
        return spark.read.orc(path)
    return spark.read.parquet(path)


def placed(df: DataFrame) -> DataFrame:
    """df with _pos, by which its rows stand as in their files; rows that come from no file, as they are read."""
    try:
        return df.withColumn("_pos", F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id()))
    except AnalysisException:
        return df.withColumn("_pos", F.monotonically_increasing_id())


def resolve(df: DataFrame, aliases: dict[str, tuple[str, ...]]) -> DataFrame:
    """df with the canonical columns only, and _pos if it has that; a column that no alias finds is an error."""
    have = {squeezed(c): c for c in reversed(df.columns)}
    out = []
    for name, wanted in aliases.items():
        found = next((have[a] for a in wanted if a in have), None)
        if found is None:
            raise ValueError(f"missing required column: {name}")
        out.append(F.col(f"`{found}`").alias(name))
    return df.select(*out, *[c for c in df.columns if c == "_pos"])


def company_master(df: DataFrame) -> DataFrame:
    """record_id, company_name, ticker (upper case), industry, report_year, report_path and source_url, once for each ticker and year: the first row. Rows of nulls go; a blank cell, a bad year or an empty table is an error."""
    m = resolve(placed(df), L.MASTER_ALIASES).dropna("all", subset=list(L.MASTER_ALIASES))
    text = [c for c in L.MASTER_ALIASES if c != "report_year"]
    m = m.select("_pos", *[X.strip(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in text], F.coalesce(F.expr("try_cast(report_year as string)"), F.lit("")).alias("y"))
    year = F.when(F.col("y").rlike(r"^\d+\.0+$"), F.split("y", r"\.")[0].cast("int")).otherwise(X.parse_year("y")) if dict(df.dtypes).get("report_year") == "double" else X.parse_year("y")
    m = m.withColumn("report_year", year)
    bad = m.where(F.greatest(*[(F.col(c) == "").cast("int") for c in text]).cast("boolean") | F.col("report_year").isNull()).limit(1).collect()
    if bad:
        raise ValueError(f"invalid company master row: { {c: bad[0][c] for c in (*text, 'y')} }")
    if not m.limit(1).count():
        raise ValueError("the company master is empty")
    m = m.withColumn("ticker", F.upper("ticker")).withColumn("record_id", X.slug("ticker", "report_year"))
    own = ("record_id", "company_name", "ticker", "industry", "report_path", "source_url")
    return m.groupBy(F.lower("ticker").alias("_t"), "report_year").agg(F.min_by(F.struct(*own), "_pos").alias("x")).select("report_year", "x.*")


def dictionary(df: DataFrame) -> DataFrame:
    """Entries of a keyword dictionary with Category and Keyword columns; none usable is an error."""
    have = {squeezed(c): c for c in reversed(df.columns)}
    if not {"category", "keyword"} <= set(have):
        raise ValueError("missing required columns: Category, Keyword")
    d = placed(df).withColumn("pos", F.row_number().over(Window.orderBy("_pos")).cast("long")).drop("_pos")  # a dictionary is small
    out = K.entries(d, f"`{have['category']}`", f"`{have['keyword']}`")
    if not out.limit(1).count():
        raise ValueError("the dictionary has no valid keywords")
    return out


#: Where Windows-1252 has other characters than Latin-1.
WINDOWS = tuple("".join(x) for x in zip(*[(chr(b), bytes([b]).decode("cp1252")) for b in range(128, 160) if b not in (129, 141, 143, 144, 157)], strict=True))


def decoded(content: X.Text) -> Column:
    """Bytes as text; such as aren't UTF-8 are read as Windows-1252."""
    c = X.col(content)
    return F.when(F.is_valid_utf8(c.cast("string")), F.regexp_replace(c.cast("string"), "^\ufeff", "")).otherwise(F.translate(F.decode(c, "ISO-8859-1"), *WINDOWS))


def stem(path: X.Text) -> Column:
    return F.regexp_extract(X.col(path), r"([^/]+)\.[^./]+$", 1)


def files(spark: SparkSession, path: str | Sequence[str], pattern: str, recursive: bool = True) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", recursive).option("pathGlobFilter", pattern).load(path if isinstance(path, str) else list(path))


def report_texts(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """record_id (the file's stem), path, size and text of text files; bytes that aren't UTF-8 are read as Windows-1252."""
    f = files(spark, path, "*.txt", recursive)
    return f.select(stem("path").alias("record_id"), "path", F.round(F.col("length") / 1048576, 3).alias("size_mb"), decoded("content").alias("text"))


def workbooks(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """path, modified and size of the Excel files of folders, once for each path in any case, sorted; lock files left out. Contents aren't read."""
    f = files(spark, folders, "*.{xlsx,xlsm,xls}", False).select("path", F.col("modificationTime").alias("modified"), F.col("length").alias("size"))
    f = f.where(~F.regexp_extract("path", "([^/]*)$", 1).startswith("~$"))
    return f.groupBy(F.lower("path").alias("_k")).agg(F.min_by(F.struct("path", "modified", "size"), "path").alias("x")).select("x.*").orderBy("path")


def plain_path(path: X.Text) -> Column:
    """A path without its scheme, with single slashes."""
    return F.regexp_replace(F.regexp_replace(F.translate(path, "\\", "/"), "^[a-zA-Z][a-zA-Z0-9+.-]+:(?=/)", ""), "/+", "/")


def located(companies: DataFrame, found: DataFrame, bases: Sequence[str], folder: str) -> DataFrame:
    """companies (report_path) with path: an absolute one as it is; a bare name in folder; else the first of bases under which found (path) has it, else its name in folder."""
    p, name = plain_path("report_path"), F.regexp_extract(plain_path("report_path"), "([^/]*)$", 1)
    under = lambda base, rest: F.regexp_replace(F.concat(F.lit(base.rstrip("/") + "/"), rest), "/+", "/")
    last = under(folder, name)
    tries = F.when(p.startswith("/"), F.array(p)).when(~p.contains("/"), F.array(last)).otherwise(F.array(*[under(b, p) for b in bases], last))
    key = ["record_id", "report_path"]
    c = companies.select(*key).distinct().withColumn("_try", tries)
    there = c.select(*key, F.posexplode("_try").alias("_i", "_p")).join(found.select(plain_path("path").alias("_p")).distinct(), "_p").groupBy(*key).agg(F.min_by("_p", "_i").alias("path"))
    return companies.join(c.join(there, key, "left").select(*key, F.coalesce("path", F.element_at("_try", -1)).alias("path")), key, "left")


PAGES = "record_id string, page_number int, text string, parser string, error string"
Parsed = tuple[str, list[str]]


def read_pdf(content: bytes) -> Parsed:
    """The parser that could read a PDF file, and its pages' texts: PyMuPDF, for files that it can't read pdfplumber."""
    wrong: list[Exception] = []
    try:
        import fitz

        with fitz.open(stream=content, filetype="pdf") as doc:
            if doc.needs_pass:
                raise ValueError("the file is encrypted")
            return "pymupdf", [p.get_text() for p in doc]
    except Exception as e:
        wrong.append(e)
    try:
        import pdfplumber

        with pdfplumber.open(io.BytesIO(content)) as doc:
            return "pdfplumber", [p.extract_text() or "" for p in doc.pages]
    except Exception as e:
        wrong.append(e)
    raise ValueError("; ".join(str(e) or type(e).__name__ for e in wrong))


def parsed(pdfs: DataFrame, parse: Callable[[bytes], Parsed] = read_pdf) -> DataFrame:
    """record_id, page_number (from 1), text, parser and error of the pages of PDF files (record_id, content); one that can't be read, or has no pages, gives one row with its error."""

    def pages(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            for rid, content in zip(b.column("record_id").to_pylist(), b.column("content").to_pylist(), strict=True):
                try:
                    parser, texts = parse(content)
                    rows = [(rid, i, t.replace("\r\n", "\n").replace("\r", "\n").strip(), parser, None) for i, t in enumerate(texts, 1)]
                    rows = rows or [(rid, None, None, None, "the file has no pages")]
                except Exception as e:  # one bad file isn't the batch's end
                    rows = [(rid, None, None, None, str(e) or type(e).__name__)]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.string(), pa.int32(), pa.string(), pa.string(), pa.string()), strict=True)], names=["record_id", "page_number", "text", "parser", "error"])

    return pdfs.select(F.col("record_id").cast("string").alias("record_id"), "content").mapInArrow(pages, PAGES)


def pdf_pages(spark: SparkSession, path: str) -> DataFrame:
    """The pages of a folder's PDF files, see parsed. Needs PyMuPDF or pdfplumber."""
    if not any(importlib.util.find_spec(m) for m in ("fitz", "pdfplumber")):
        raise RuntimeError("reading PDF files needs PyMuPDF or pdfplumber")
    return parsed(files(spark, path, "*.pdf").select(stem("path").alias("record_id"), "content"))


def page_counts(pages: DataFrame) -> DataFrame:
    """record_id and its number of pages; 0 for files that can't be read."""
    return pages.groupBy("record_id").agg(F.coalesce(F.max("page_number"), F.lit(0)).alias("n_pages"))


def page(pages: DataFrame, number: int) -> DataFrame:
    """One page of each record; for records with fewer pages a row with an error."""
    got = pages.where(F.col("page_number") == number)
    short = page_counts(pages).where(F.col("n_pages") < number).select("record_id", F.lit(number).alias("page_number"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("parser"), F.format_string("page %s of %s", F.lit(number), "n_pages").alias("error"))
    return got.unionByName(short)


def company_reports(companies: DataFrame, found: DataFrame, bases: Sequence[str], folder: str, parse: Callable[[bytes], Parsed] = read_pdf) -> DataFrame:
    """record_id, text, parser, scanned and error of companies' reports (record_id, report_path), from files found (path, content).

    A text file is decoded. A PDF's pages are read and combined; one that looks scanned keeps what native text it has, as
    there is no character recognition here, and without any has an error, like a file that is missing or can't be read.
    """
    c = located(companies.select("record_id", "report_path"), found, bases, folder).withColumn("_p", plain_path("path"))
    have = c.join(found.select(plain_path("path").alias("_p"), "content"), "_p", "left")
    pdf = F.lower("_p").endswith(".pdf")
    none = F.lit(None).cast("string")
    missing = have.where(F.col("content").isNull()).select("record_id", none.alias("text"), none.alias("parser"), F.lit(False).alias("scanned"), F.concat(F.lit("no such report: "), F.coalesce("path", F.lit("none given"))).alias("error"))
    texts = have.where(F.col("content").isNotNull() & ~pdf).select("record_id", decoded("content").alias("text"), F.lit("text").alias("parser"), F.lit(False).alias("scanned"), none.alias("error"))
    pages = parsed(have.where(F.col("content").isNotNull() & pdf), parse)
    told = pages.groupBy("record_id").agg(F.max("parser").alias("parser"), F.max("error").alias("error"))
    whole = told.join(C.combine_pages(pages), "record_id", "left").join(C.scanned(pages).select("record_id", "scanned"), "record_id", "left")
    empty = F.when(F.coalesce("text", F.lit("")) == "", F.lit("the report is scanned: it has no native text"))
    pdfs = whole.select("record_id", "text", "parser", F.coalesce("scanned", F.lit(False)).alias("scanned"), F.coalesce("error", empty).alias("error"))
    kind = dict(companies.dtypes)["record_id"]
    return missing.unionByName(texts).unionByName(pdfs.withColumn("record_id", F.col("record_id").cast(kind)))
