"""Company records as JSON and back, with their fields checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A record's fields: those that it must have, and those that it may have.
NEEDED = {"company_name": "string", "ticker": "string", "industry": "string", "report_year": "int", "report_path": "string", "source_url": "string"}
OPTIONAL = {"extracted_text": "string", "keyword_counts": "map<string,bigint>", "category_counts": "map<string,bigint>", "disclosure_score": "double", "validation_status": "string"}


def to_json(records: DataFrame) -> DataFrame:
    """record_id and record, a JSON object of its fields; unset ones are left out."""
    fields = [c for c in (*NEEDED, *OPTIONAL) if c in records.columns]
    return records.select("record_id", F.to_json(F.struct(*fields)).alias("record"))


def from_json(rows: DataFrame, strict: bool = True) -> DataFrame:
    """record_id, all fields, and error: what is wrong with a record (no object, missing or unknown fields); strict: any error ends the query."""
    kinds = NEEDED | OPTIONAL
    d = rows.withColumn("_r", F.from_json("record", ", ".join(f"{k} {v}" for k, v in kinds.items()))).withColumn("_k", F.json_object_keys("record"))
    missing = F.array_except(F.array(*[F.lit(k) for k in NEEDED]), F.col("_k"))
    unknown = F.array_except(F.col("_k"), F.array(*[F.lit(k) for k in kinds]))
    error = (
        F.when(F.col("_k").isNull(), "not a JSON object")
        .when(F.size(missing) > 0, F.concat(F.lit("missing fields: "), F.array_join(F.array_sort(missing), ", ")))
        .when(F.size(unknown) > 0, F.concat(F.lit("unknown fields: "), F.array_join(F.array_sort(unknown), ", ")))
    )
    error = F.when(error.isNotNull(), F.raise_error(F.concat(F.lit("invalid record: "), error))).otherwise(F.lit(None).cast("string")) if strict else error
    return d.select("record_id", *[F.col(f"_r.{k}").alias(k) for k in kinds], error.alias("error"))
