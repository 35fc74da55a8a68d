"""What the operators share: inputs, tables in the shared folder, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word is a longest run of bytes outside these: space and \t \n \v \f \r.
SPACES = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column | str) -> Column:
    """A-Z lower-cased; every other character stays."""
    return F.translate(c, ASCII_UPPER, ASCII_UPPER.lower())


def remainder(doc_id: Column | str, n: int) -> Column:
    """crc32 of an id's decimal text, modulo n (null ids: of the empty text)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. Where it is unset, a local session gets a temporary one; a cluster must name its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


#: Whether a query's shuffle files go when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: its lineage ends there, and a lost executor costs no recomputation. Its shuffles' files go once it is written."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    usual = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if usual is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, usual)
    return spark.read.schema(df.schema).parquet(path)


def batches_of(spark: SparkSession, rows: int = 1000, size: int = 16 << 20) -> None:
    """Arrow batches of so many rows and bytes at most, so that one of long texts stays small; a session's own settings hold."""
    for key, usual, own in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", str(rows)), ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", f"{size}b")):
        if spark.conf.get(key, usual) == usual:
            spark.conf.set(key, own)


def released() -> None:
    """Gives what a Python worker has freed back to its machine: workers outlive tasks, stages and queries."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: run, after which the worker's free memory goes back."""

    def whole(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(it)
        finally:
            released()

    return whole


def rows_out(schema: pa.Schema, columns: Iterable[Iterable]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def per_batch(f: Callable[..., list], schema: pa.Schema, columns: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow: f gets the named columns of a batch as lists and returns the columns of schema."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            yield rows_out(schema, f(*(b.column(b.schema.get_field_index(c)).to_pylist() for c in columns)))

    return tidy(run)


def groups(it: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Groups of a partition that is sorted by key, over the borders of batches."""
    last, held = None, {}
    for b in it:
        cols = b.to_pydict()
        names = list(cols)
        ks = list(zip(*(cols[k] for k in key), strict=True))
        i = 0
        while i < len(ks):
            j = i + 1
            while j < len(ks) and ks[j] == ks[i]:
                j += 1
            if ks[i] != last:
                if last is not None:
                    yield last, held
                last, held = ks[i], {c: [] for c in names}
            for c in names:
                held[c].extend(cols[c][i:j])
            i = j
    if last is not None:
        yield last, held
