"""Headings of reports and the sections between them."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import lexicons as L
from tidemark.functions import text as X


#: No heading has more characters.
LONGEST = 140


def wordings() -> list[tuple[str, str]]:
    """(canonical, wording) of all headings, the first canonical of a wording's form first."""
    groups = L.HEADING_GROUPS | {h: (h,) for h in L.REPORT_HEADINGS if h not in L.HEADING_GROUPS}
    forms = lambda w: sorted({w, w.replace("&", "and"), w.replace("and", "&"), w.replace("/", " "), w.replace("-", " "), w.rstrip(":")})
    return [(c, f) for c, ws in groups.items() for w in ws for f in forms(w)]


def lexicon(spark: SparkSession) -> DataFrame:
    """pattern, canonical, wording, place: one row for each normalised form, of the first group that has it."""
    rows = spark.createDataFrame([(i, c, w) for i, (c, w) in enumerate(wordings())], "place int, canonical string, wording string")
    rows = rows.withColumn("pattern", X.normalized_heading("wording")).where("pattern != ''")
    return rows.groupBy("pattern").agg(F.min_by("canonical", "place").alias("canonical"), F.min_by("wording", "place").alias("wording"), F.min("place").alias("place"))


def valid_heading(line: X.Text, known: Column) -> Column:
    s = X.strip(line)
    words = F.size(F.regexp_extract_all(s, F.lit("[A-Za-z&]+"), F.lit(0)))
    shape = F.length(s).between(2, LONGEST) & (F.size(F.split(s, r"\s+")) <= 14) & ~s.rlike(r"[.,;]$") & s.rlike("[A-Za-z]")
    return shape & (known | (words <= 4) | X.title_share(s, "[A-Za-z&]+", 0.6))


def candidates(reports: DataFrame) -> DataFrame:
    """record_id, start, end (code points), line and form of all lines that may be headings by their length, by running lengths within the row."""
    a = F.split("text", "\n", -1)
    run = F.aggregate(a, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + F.length(x) + 1)))
    placed = F.transform(F.arrays_zip(a.alias("l"), F.slice(run, 1, F.size(a)).alias("s")), lambda x, i: F.struct(i.alias("i"), x["l"].alias("l"), x["s"].alias("s")))
    # only lines as short as a heading go on, before any pattern looks at them
    short = F.filter(placed, lambda x: F.length(X.strip(x["l"])).between(1, LONGEST))
    rows = X.exploded(reports.select("record_id", short.alias("x")), "x").select("record_id", F.col("x.i").alias("line_no"), F.col("x.l").alias("raw"), F.col("x.s").alias("at"))
    lead = F.length("raw") - F.length(F.regexp_replace("raw", r"^\s+", ""))
    return rows.select("record_id", "line_no", (F.col("at") + lead).cast("long").alias("start"), X.strip("raw").alias("line")).withColumn("end", (F.col("start") + F.length("line")).cast("long")).withColumn("form", X.normalized_heading("line")).where("line != ''")


def fuzzy(cands: DataFrame, lex: DataFrame, least: float = 0.84) -> DataFrame:
    """form, canonical, wording and confidence of distinct forms that resemble a wording; the first best of the lexicon."""
    choices = [(r["pattern"], r["canonical"], r["wording"]) for r in lex.orderBy("place").collect()]  # the lexicon's size

    def match(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for form in pdf["form"]:
                scores = [SequenceMatcher(None, form, p).ratio() for p, _, _ in choices]
                top = max(scores, default=0.0)
                if top * 100 >= least * 100 and top > 0:
                    _, canonical, wording = choices[scores.index(top)]
                    out.append((form, canonical, wording, round(top, 4)))
            yield pd.DataFrame(out, columns=["form", "canonical", "wording", "confidence"])

    return cands.select("form").distinct().mapInPandas(match, "form string, canonical string, wording string, confidence double")


def headings(reports: DataFrame, use_fuzzy: bool = True) -> DataFrame:
    """record_id, heading, start, end, confidence, pattern and line of each detected heading. Exact forms meet the lexicon in a broadcast join; only distinct other forms are compared loosely."""
    spark = reports.sparkSession
    lex = lexicon(spark)
    c = candidates(reports).join(F.broadcast(lex), F.col("form") == F.col("pattern"), "left")
    c = c.where(valid_heading("line", F.col("pattern").isNotNull()))
    pick = lambda df, conf: df.select("record_id", F.col("canonical").alias("heading"), "start", "end", conf.alias("confidence"), F.col("wording").alias("pattern"), "line")
    exact = pick(c.where("pattern is not null"), F.lit(1.0))
    if not use_fuzzy:
        return exact
    rest = c.where("pattern is null").drop("canonical", "wording", "place", "pattern")
    return exact.union(pick(rest.join(fuzzy(rest, lex), "form"), F.col("confidence")))


def by_location(found: DataFrame) -> DataFrame:
    """Of headings at one place of a report the surest, of equals the first by name."""
    best = found.groupBy("record_id", "start", "end").agg(F.min_by(F.struct(*[c for c in found.columns if c not in ("record_id", "start", "end")]), F.struct(-F.col("confidence"), "heading")).alias("x"))
    return best.select("record_id", "start", "end", "x.*").select(*found.columns)


def named(found: DataFrame, heading: str) -> DataFrame:
    """record_id and text of the sections that a wording of a heading stands for; an unknown wording finds none."""
    lex = lexicon(found.sparkSession).where(F.col("pattern") == X.normalized_heading(F.lit(heading))).select(F.col("canonical").alias("name"))
    return found.join(F.broadcast(lex), "name", "left_semi").select("record_id", "text")


def as_json(found: DataFrame) -> DataFrame:
    """record_id and its sections as a JSON object of names and texts, in their order."""
    g = found.groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct("ord", "name", "text"))).alias("x"))
    return g.select("record_id", F.to_json(F.map_from_entries(F.transform("x", lambda y: F.struct(y["name"], y["text"])))).alias("sections"))


def section_text(c: X.Text) -> Column:
    return F.regexp_replace(X.strip(X.each_line(c, lambda x: X.strip(F.regexp_replace(x, r"[ \t]+", " ")))), r"\n{3,}", "\n\n")


def sections(reports: DataFrame, found: DataFrame, targets: tuple[str, ...] = L.EXPECTED_SECTIONS, least: int = 40, most: int | None = None) -> DataFrame:
    """record_id, name, ord, start, end and text: from each target heading to the next heading of any kind."""
    w = Window.partitionBy("record_id").orderBy("start")
    spans = found.select("record_id", "heading", "start", F.lead("start").over(w).alias("next")).where(F.col("heading").isin(*targets))
    s = spans.join(reports.select("record_id", "text"), "record_id").withColumn("end", F.coalesce("next", F.length("text").cast("long")))
    text = section_text(F.substring(F.col("text"), F.col("start").cast("int") + 1, (F.col("end") - F.col("start")).cast("int")))
    text = F.substring(text, 1, most) if most else text
    s = X.exploded(s.withColumn("text", F.filter(F.array(text), lambda x: F.length(x) >= least)), "text")  # as a filter, it would compute texts twice
    return s.select("record_id", F.col("heading").alias("name"), F.row_number().over(w).cast("int").alias("ord"), "start", "end", "text")


def merge(found: DataFrame) -> DataFrame:
    """record_id, name, ord and text: a report's sections of one name as one, distinct texts in order."""
    once = found.groupBy("record_id", "name", "text").agg(F.min("ord").alias("ord"))
    g = once.groupBy("record_id", "name").agg(F.array_sort(F.collect_list(F.struct("ord", "text"))).alias("x"))
    return g.select("record_id", "name", F.col("x")[0]["ord"].alias("ord"), F.array_join(F.transform("x", lambda y: y["text"]), "\n\n").alias("text"))


def or_full_report(reports: DataFrame, found: DataFrame) -> DataFrame:
    """record_id, name, ord, text: the sections, or the whole text as one of reports without any."""
    rest = reports.join(found.select("record_id").distinct(), "record_id", "left_anti").select("record_id", F.lit("Full Report").alias("name"), F.lit(1).alias("ord"), F.col("text"))
    return found.select("record_id", "name", "ord", "text").unionByName(rest)


def summary(found: DataFrame) -> DataFrame:
    w = F.size(F.filter(F.split(X.strip("text"), r"\s+"), lambda x: x != ""))
    return found.select("record_id", "name", F.length("text").cast("long").alias("character_count"), w.cast("long").alias("word_count"), (X.strip("text") != "").alias("present"), F.substring("text", 1, 500).alias("preview"))
