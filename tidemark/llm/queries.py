"""The queries of this folder's operators, with their production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, html_text, language, mixing, neighbours, piece_bpe, simhash, suffix_dedup, toxicity, url_filter
from tidemark.llm.common import remainder, table

#: The rules that pages are judged by.
URL_RULES = [("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "block"), ("example.net", "/de/8", "block"), ("org", "/es/", "block")]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Besides the contract's columns n_passages: runs of more than 50 words that also stand elsewhere, which may have less than 400 bytes."""
    got = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), words=51, told=True)
    removed = (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed")
    return got.select("doc_id", "n_bytes", removed, F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), "n_passages")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score(table(spark, sf_dir, "documents"), remainder("doc_id", 7) != 2)


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, url_filter.RULES)
    return url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = toxicity.score_texts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return got.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.encode_texts(table(spark, sf_dir, "documents"), piece_bpe.model_bytes(public_tokenizers.path("piece_bpe_32k.model")), digests=True)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = language.identify(table(spark, sf_dir, "documents"), remainder("doc_id", 3) != 1)
    return got.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_suffix_dedup, op2_lm_scoring, op3_url_filters, op4_toxicity, op5_sentencepiece, op6_simhash, op7_language_id, op8_html_extraction, op9_decontamination, op10_nearest_neighbours)}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SQL: dict[str, str] = {
    "op3_url_filters": rf"""
        WITH p AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{_UPPER}', '{_LOWER}') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
            FROM pages
        ), r(h, p, v) AS (VALUES {", ".join(str(x) for x in URL_RULES)}),
        m AS (
            SELECT page_id, arg_max(h || p.p, length(h || p.p)) AS rule, arg_max(v, length(h || p.p)) AS v
            FROM (SELECT * FROM p) AS q JOIN r AS p ON (q.host = p.h OR ends_with(q.host, '.' || p.h)) AND starts_with(q.path, p.p)
            GROUP BY page_id
        )
        SELECT p.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN m ON p.page_id = m.page_id
    """,
    "op9_decontamination": r"""
        WITH i AS (
            SELECT item_id, w, least(len(w), 5) AS m
            FROM (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark)
            WHERE len(w) > 0
        ), s AS (
            SELECT DISTINCT item_id, m, array_to_string(w[j:j + m - 1], ' ') AS s
            FROM (SELECT item_id, w, m, unnest(range(1, len(w) - m + 2)) AS j FROM i)
        ), n AS (SELECT item_id, count(*) AS n_item FROM s GROUP BY item_id),
        d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
        k AS (
            SELECT DISTINCT doc_id, array_to_string(w[j:j + m - 1], ' ') AS s
            FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS j FROM d, (SELECT DISTINCT m FROM i))
        ), c AS (SELECT doc_id, item_id, count(*) AS n_shared FROM k JOIN s ON k.s = s.s GROUP BY doc_id, item_id)
        SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
        FROM c JOIN n USING (item_id) WHERE n_shared >= n_item * 0.8 - 1e-9
    """,
}
