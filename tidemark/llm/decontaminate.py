"""Benchmark passages in documents: MinHash containment search by size partitions, then exact containment.

Documents may be thousands of times longer than an item, so their own minima tell nothing of an item in them. Only items
are sketched, therefore: an item's sketch holds its least hashed shingles, so many that a document with the wanted share
of the item's shingles must have one of them. Documents are looked through by all their shingles' hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut

#: Sketches of so many rows at most are sent to every executor (some 30 bytes a row); more meet documents in a shuffle.
BROADCAST_ROWS = 1_000_000
#: Documents meet candidate pairs by a hash of so many values first.
BUCKETS = 1 << 20


def words(text: Column | str) -> Column:
    """Runs of letters and digits, lower-cased; null: none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingle_texts(w: str, size: Column | int) -> Column:
    """All shingles of size words as texts."""
    n = F.lit(size) if isinstance(size, int) else size
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(F.col(w), i, n), " "))).otherwise(F.array().cast("array<string>"))


def shingle_hashes(h: str, size: int) -> Column:
    """Hashes of all shingles, from an array of the words' hashes."""
    return F.when(F.size(h) >= size, F.transform(F.sequence(F.lit(0), F.size(h) - size), lambda i: F.xxhash64(*(F.get(F.col(h), i + j) for j in range(size))))).otherwise(F.array().cast("array<bigint>"))


def contaminated(docs: DataFrame, items: DataFrame, share: float = 0.8, size: int = 5) -> DataFrame:
    """doc_id, item_id, n_item, n_shared and containment of each document (doc_id, text) that holds at least share of an item's (item_id, text) distinct shingles of size words.

    Words are runs of letters and digits, lower-cased. An item with fewer words is one shingle of all of them; one
    without words, or a null text, is in no document. Repeated rows give one pair; rows of one id with different texts
    the pair of the greatest share. Empty tables give no rows; other columns are left out.

    Items are partitioned by their number of shingles, n in [2^c, 2^(c+1)); each partition's sketches hold the
    floor((1 - share) * (2^(c+1) - 1)) + 1 least hashes, which loses no document. Sketches meet the hashes of all
    documents' shingles, where these are read; only documents with a candidate item, and large enough for it, are
    looked at again, and shingles then compared as texts. All native.
    """
    i = items.select("item_id", words("text").alias("w")).where("size(w) > 0").select("item_id", "w", F.least(F.size("w"), F.lit(size)).alias("m"))
    i = i.select("item_id", "m", F.array_distinct(shingle_texts("w", F.col("m"))).alias("sh")).distinct()
    i = cut(i.groupBy("item_id", "m", "sh").agg(F.size("sh").alias("n")), "items")
    hashed = i.select("item_id", "m", "n", F.explode("sh").alias("s")).withColumn("hw", F.transform(F.split("s", " "), lambda x: F.xxhash64(x)))
    lengths = sorted(r["m"] for r in i.select("m").distinct().collect())  # size values at most
    by_length = [hashed.where(F.col("m") == m).select("item_id", "m", "n", F.xxhash64(*(F.get("hw", F.lit(j)) for j in range(m))).alias("h")) for m in lengths]
    if not by_length:
        by_length = [hashed.select("item_id", "m", "n", F.lit(0).cast("long").alias("h"))]
    sketch = by_length[0]
    for x in by_length[1:]:
        sketch = sketch.union(x)
    upper = F.pow(F.lit(2.0), F.floor(F.log2("n")) + 1) - 1  # the partition's greatest number of shingles
    place = F.row_number().over(Window.partitionBy("item_id", "m", "n").orderBy(F.xxhash64("h"), "h"))
    sketch = sketch.withColumn("place", place).where(F.col("place") <= F.floor((1 - F.lit(share)) * upper + 1e-9) + 1).select("item_id", "m", "n", "h")
    sketch = cut(sketch.distinct(), "sketches")
    small = sketch.count() <= BROADCAST_ROWS

    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"), "doc_id", F.xxhash64("text").alias("th"), "text")
    h = d.select("doc", "th", words("text").alias("w")).where("size(w) > 0").select("doc", "th", F.transform("w", lambda x: F.xxhash64(x)).alias("hw"))
    found = None
    for m in lengths or [size]:
        own = sketch.where(F.col("m") == m).select("item_id", "n", "h")
        all_ = h.select("doc", "th", F.size("hw").alias("k"), F.explode(shingle_hashes("hw", m)).alias("h"))
        hit = all_.join(F.broadcast(own) if small else own, "h").where(F.col("k") - (m - 1) >= F.ceil(F.col("n") * share - 1e-9)).select("doc", "th", "item_id")
        found = hit if found is None else found.union(hit)
    pairs = cut(found.distinct(), "candidates")

    bucket = F.pmod(F.xxhash64("doc", "th"), F.lit(BUCKETS))
    near = d.withColumn("_b", bucket).join(F.broadcast(pairs.select(bucket.alias("_b")).distinct()), "_b", "left_semi").drop("_b")
    near = near.dropDuplicates(["doc", "th"]).join(pairs, ["doc", "th"]).select("doc_id", "item_id", words("text").alias("w"))
    both = near.join(i, "item_id").select("doc_id", "item_id", "n", "sh", shingle_texts("w", F.col("m")).alias("own"))
    both = both.select("doc_id", "item_id", F.col("n").alias("n_item"), F.size(F.array_intersect("sh", "own")).alias("n_shared"))
    both = both.withColumn("containment", F.col("n_shared") / F.col("n_item")).where(F.col("n_shared") >= F.col("n_item") * share - 1e-9)
    best = F.max(F.struct("containment", "n_item", "n_shared")).alias("b")
    return both.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", F.col("b.n_item").cast("long").alias("n_item"), F.col("b.n_shared").cast("long").alias("n_shared"), F.col("b.containment").alias("containment"))
