"""From reports to scores: one plan over all companies."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators import analytics as A
from tidemark.operators import keywords as K
from tidemark.operators import lines as C
from tidemark.operators import sections as S
from tidemark.operators import validation as V


@dataclass(frozen=True)
class Results:
    """Tables of a run, each keyed by record_id."""

    texts: DataFrame
    sections: DataFrame
    counts: DataFrame
    categories: DataFrame
    scores: DataFrame
    ready: DataFrame
    markdown: DataFrame
    status: DataFrame


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, so that what follows doesn't compute it anew: written to the folder of spark.checkpoint.dir; where that is unset, kept on the executors' disks."""
    spark = df.sparkSession
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        return df.persist(StorageLevel.DISK_ONLY)
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cleaned(companies: DataFrame, reports: DataFrame) -> DataFrame:
    """record_id, ticker, text (cleaned and normalised) and error of each company: no report, an error of its extraction, an empty text before or after cleaning, or a text that couldn't be cleaned. One company's failure leaves the others alone."""
    own = F.col("error") if "error" in reports.columns else F.lit(None).cast("string")
    j = companies.select("record_id", "ticker").join(reports.select("record_id", F.col("text").alias("raw"), own.alias("told"), F.lit(True).alias("_there")), "record_id", "left")
    first = F.when(F.col("_there").isNull(), "no report").when(F.col("told").isNotNull(), F.col("told")).when(X.strip(F.coalesce("raw", F.lit(""))) == "", "the report has an empty text")
    j = j.select("record_id", "ticker", "raw", first.alias("error"))
    done = C.normalize(C.clean(j.withColumn("text", F.when(F.col("error").isNull(), F.col("raw"))).drop("raw")))
    second = F.when(F.col("text").isNull(), "the text couldn't be cleaned").when(F.col("text") == "", "the text is empty after cleaning")
    return done.select("record_id", "ticker", F.coalesce("error", second).alias("error"), F.when(F.col("error").isNull(), F.col("text")).alias("text"))


def analyse(companies: DataFrame, reports: DataFrame, entries: DataFrame, fuzzy_headings: bool = True) -> Results:
    """companies: record_id, company_name, ticker, industry, report_year. reports: record_id, text, perhaps error. Texts, sections and counts are stored once; what is asked of them reads them."""
    told = stored(cleaned(companies, reports), "texts")
    status = told.select("record_id", "ticker", F.when(F.col("error").isNull(), "SUCCESS").otherwise("FAILED").alias("status"), "error")
    texts = told.where("error is null").select("record_id", "text")
    merged = stored(S.merge(S.sections(texts, S.headings(texts, fuzzy_headings))), "sections")
    sections = S.or_full_report(texts, merged)
    ok = status.where("status = 'SUCCESS'").select("record_id")
    counts = stored(K.count_keywords(sections, K.all_keywords(entries)), "counts")
    categories = K.category_statistics(ok, counts, K.words_of(sections), entries)
    scores = K.scores(K.metrics(ok, sections, counts, entries)).withColumn("explanation", K.explanation()).join(companies, "record_id")
    ready = V.ready(companies.select("record_id", "company_name", "ticker", "report_year").join(ok, "record_id"), counts, entries)
    return Results(texts, sections, counts, categories, scores, ready, A.markdown(scores, categories, merged), status)


def readiness(results: Results) -> DataFrame:
    """One row of the tables' sizes: what there is before any manual count."""
    tables = {k: v for k, v in vars(results).items() if k not in ("texts", "ready", "status")}
    rows = [df.agg(F.count("*").alias("n")).select(F.lit(k).alias("k"), "n") for k, df in tables.items()]
    return A.union_all(rows).groupBy().pivot("k", list(tables)).agg(F.first("n"))


def write(results: Results, folder: str, mode: str = "overwrite") -> None:
    """Each table as Parquet; the extracted texts, sections as JSON and Markdown reports also as text files, a folder for each record."""
    at = folder.rstrip("/")
    for name, df in vars(results).items():
        df.write.mode(mode).parquet(f"{at}/{name}")
    spark = results.status.sparkSession
    write_texts(spark.read.parquet(f"{at}/texts"), f"{at}/extracted", mode)
    write_texts(S.as_json(spark.read.parquet(f"{at}/sections")).withColumnRenamed("sections", "text"), f"{at}/sections_json", mode)
    write_texts(spark.read.parquet(f"{at}/markdown").withColumnRenamed("markdown", "text"), f"{at}/reports", mode)


def write_texts(reports: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """Each record's text as a file in a folder of its own; an empty text is an error."""
    text = F.when(X.strip(F.coalesce("text", F.lit(""))) == "", F.raise_error(F.lit("a text to write is empty"))).otherwise(F.col("text"))
    reports.select("record_id", text.alias("text")).write.mode(mode).partitionBy("record_id").text(folder)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    A.flatten(df).write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)
