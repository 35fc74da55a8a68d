"""Keyword counts of reports as they arrive; an addition to the batch plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import keywords as K


def arriving(spark: SparkSession, folder: str, files: int = 100) -> DataFrame:
    """record_id, text and ts of reports written to a folder as Parquet."""
    return spark.readStream.schema("record_id string, text string, ts timestamp").option("maxFilesPerTrigger", files).parquet(folder)


def counts_by_window(reports: DataFrame, keywords: Sequence[str], window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """start, keyword and n: hits by window of arrival; reports later than the watermark count no more."""
    s = reports.select("record_id", "ts", F.lit("Full Report").alias("name"), "text")
    stamped = s.withColumn("record_id", F.struct("record_id", "ts"))
    c = K.count_keywords(stamped, keywords).select(F.col("record_id.ts").alias("ts"), "keyword", "n").withWatermark("ts", late)
    return c.groupBy(F.window("ts", window), "keyword").agg(F.sum("n").alias("n")).select(F.col("window.start").alias("start"), "keyword", "n")
