"""Command line: analyse the companies of a master table."""

from __future__ import annotations

import argparse
import sys
import time
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tidemark.operators import analytics, keywords
from tidemark.plans import disclosure
from tidemark.sources import tables


def year(text: str) -> int:
    value = int(text)
    if not 1900 <= value <= 9999:
        raise argparse.ArgumentTypeError("a year is 1900 to 9999")
    return value


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description=__doc__)
    who = p.add_mutually_exclusive_group(required=True)
    who.add_argument("--company", help="a name or ticker, or a part of one")
    who.add_argument("--all", action="store_true")
    p.add_argument("--year", type=year)
    p.add_argument("--company-master", required=True)
    p.add_argument("--reports", required=True, help="a folder of text files, named like the company's slug")
    p.add_argument("--dictionary")
    p.add_argument("--output", required=True)
    return p


def duration(seconds: float) -> str:
    s = max(0, round(seconds))
    return f"{s // 3600:02d}:{s % 3600 // 60:02d}:{s % 60:02d}"


def main(argv: Sequence[str] | None = None) -> int:
    """0: all succeeded; 1: some failed; 2: nothing could be run."""
    args = parser().parse_args(argv)
    began = time.perf_counter()
    spark = SparkSession.builder.getOrCreate()
    try:
        companies = analytics.select_companies(tables.company_master(tables.read_table(spark, args.company_master)), args.company, args.year)
        if not companies.limit(1).count():
            raise ValueError("no company matches")
        entries = tables.dictionary(tables.read_table(spark, args.dictionary)) if args.dictionary else keywords.default_entries(spark)
        results = disclosure.analyse(companies, tables.report_texts(spark, args.reports), entries)
        disclosure.write(results, args.output)
        told = analytics.run_summary(spark.read.parquet(f"{args.output.rstrip('/')}/status")).first()
    except (ValueError, RuntimeError) as e:
        print(e, file=sys.stderr)
        return 2
    print(f"processed {told['processed']}, succeeded {told['success']}, failed {told['failed']}, {duration(time.perf_counter() - began)}")
    return int(told["failed"] > 0)


if __name__ == "__main__":
    sys.exit(main())
