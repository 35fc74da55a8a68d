"""The cleaning pipeline over documents: each stage works on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language, piece_bpe, simhash, suffix_dedup
from tidemark.llm.common import cut, remainder, table
from tidemark.llm.components import components

#: No SQL: language ID, SimHash and SentencePiece can't be expressed in it.
ORACLE_SQL = None


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language stay; texts without letters, null texts and such without any learned language go."""
    got = language.identify(docs, remainder("doc_id", 3) != 1, carry=True)
    return got.where(F.col("lang_pred") != language.UNDECIDED).select(*docs.columns)


def keyed(docs: DataFrame) -> DataFrame:
    """docs with _th, a hash of the text, and _row, one of id and text: what stages drop rows by."""
    return docs.withColumn("_th", F.xxhash64("text")).withColumn("_row", F.xxhash64("doc_id", F.col("doc_id").isNull(), "text", F.col("text").isNull()))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id stays (with a null id only where none has another); of repeated rows one.

    Near copies are linked by fingerprints of at most 3 differing bits, or 5-word Jaccard similarity of 0.8 or more.
    """
    d = keyed(docs)
    texts = d.select(F.col("_th").alias("th"), "text")
    close = simhash.near_duplicates(texts.select(F.col("th").alias("doc_id"), "text")).select(F.col("doc_id").alias("u"), F.col("component_id").alias("v"))
    roots = components(close.union(simhash.jaccard_links(texts)))
    rows = d.select("_th", "_row", F.col("doc_id").isNull().alias("none"), "doc_id").join(roots, F.col("_th") == F.col("node"), "left").withColumn("root", F.coalesce("root", "_th"))
    stay = cut(rows.groupBy("root").agg(F.min(F.struct("none", "doc_id", "_row")).alias("one")).select(F.col("one._row").alias("_row")), "kept")
    return d.join(stay, "_row", "left_semi").dropDuplicates(["_row"]).select(*docs.columns)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages of 400 bytes or more, or of 51 words or more, go from all documents that have them; documents left without words go."""
    own = {c: f"_c{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}  # columns named like the operator's are none of its
    got = suffix_dedup.remove_repeats(docs.withColumnsRenamed(own), as_text=True, words=51).drop("spans").withColumnsRenamed({v: k for k, v in own.items()})
    return got.where(F.trim(F.regexp_replace("text", r"\s+", " ")) != "").withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    d = keyed(docs)
    pairs = decontaminate.contaminated(d.select(F.col("_row").alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    gone = cut(pairs.select(F.col("doc_id").alias("_row")).distinct(), "contaminated")
    return d.join(gone, "_row", "left_anti").select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids, and the digest of the text that they decode to."""
    got = piece_bpe.encode_texts(docs, piece_bpe.model_bytes(public_tokenizers.path("piece_bpe_32k.model")))
    return got.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("simhash_dedup", simhash_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what each keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
