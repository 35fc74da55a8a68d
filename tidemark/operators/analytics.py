"""What a dashboard asks of score tables: selection, rankings, totals, trends, comparisons."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import text as X
from tidemark.operators.keywords import recommendation


def find_column(df: DataFrame, wanted: Sequence[str]) -> str | None:
    """The first wanted column, whatever its case and spaces."""
    names = {"".join(ch for ch in c.lower() if ch.isalnum()): c for c in reversed(df.columns)}
    return next((names[k] for k in ("".join(ch for ch in w.lower() if ch.isalnum()) for w in wanted) if k in names), None)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def select_companies(df: DataFrame, query: str | None = None, year: int | None = None) -> DataFrame:
    """Rows whose ticker or name equals the query in any case, or, only if no row does, contains it; then of the year."""
    if query is not None:
        q = F.lit(query.strip().lower())
        t, n = F.lower("ticker"), F.lower("company_name")
        exact = df.select(F.max(((t == q) | (n == q)).cast("int")).alias("_some"))
        df = df.crossJoin(F.broadcast(exact)).where((t == q) | (n == q) | ((F.coalesce("_some", F.lit(0)) == 0) & (t.contains(q) | n.contains(q)))).drop("_some")
    return df.where(F.col("report_year") == year) if year is not None else df


def dedup_first(df: DataFrame, keys: Sequence[Column], order: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def search(df: DataFrame, needle: str, columns: Sequence[str]) -> DataFrame:
    hit = reduce(lambda a, b: a | b, [F.lower(F.col(c)).contains(needle.lower()) for c in columns])
    return df.where(hit)


def visible(df: DataFrame, chosen: DataFrame, key: str = "record_id") -> DataFrame:
    return df.join(chosen.select(key).distinct(), key, "left_semi")


def enrich(df: DataFrame, lookup: DataFrame, key: str = "ticker", value: str = "industry", order: str | None = None) -> DataFrame:
    """df with value from lookup by key in any case; of a key's rows the first (by order, else as lookup is read). Unknown: Not available."""
    place = F.col(order) if order else F.monotonically_increasing_id()
    small = lookup.withColumn("_p", place).where(F.col(value).isNotNull()).groupBy(X.casefold(key).alias("_k")).agg(F.min_by(value, "_p").alias("_v"))
    j = df.withColumn("_k", X.casefold(key)).join(small, "_k", "left")
    own = F.col(value) if value in df.columns else F.lit(None).cast("string")
    return j.withColumn(value, F.coalesce(own, F.col("_v"), F.lit("Not available"))).drop("_k", "_v")


def with_identity(df: DataFrame, path: X.Text, suffix: str = "_analysis") -> DataFrame:
    """df with _record_id and _workbook_path, and company_name, ticker and report_year where they lack: from the file's name, <ticker>_<year>."""
    p = X.col(path)
    stem = F.regexp_replace(F.regexp_extract(p, r"([^/\\]+?)(?:\.[^./\\]*)?$", 1), rf"\Q{suffix}\E$", "")
    own = {"company_name": F.regexp_replace(stem, r"_(?:19|20)\d{2}$", ""), "ticker": F.upper(F.regexp_replace(stem, r"_(?:19|20)\d{2}$", "")), "report_year": X.parse_year(F.regexp_extract(stem, r"(?:19|20)\d{2}$", 0))}
    out = df.withColumn("_record_id", stem).withColumn("_workbook_path", p)
    return out.withColumns({c: F.coalesce(F.col(c), v.cast(dict(df.dtypes)[c])) if c in df.columns else v for c, v in own.items()})


def report_paths(workbooks: DataFrame, reports: DataFrame) -> DataFrame:
    """workbooks (path) with report: the path of the Markdown report whose name has _report where the workbook's has _analysis; null where there is none."""
    stem = lambda c: F.regexp_extract(c, r"([^/\\]+?)(?:\.[^./\\]*)?$", 1)
    r = reports.select(stem("path").alias("_k"), F.col("path").alias("report")).groupBy("_k").agg(F.min("report").alias("report"))
    return workbooks.withColumn("_k", F.regexp_replace(stem("path"), "_analysis$", "_report")).join(r, "_k", "left").drop("_k")


def where_in(df: DataFrame, chosen: dict[str, Sequence[str]]) -> DataFrame:
    """Rows whose columns, as shown, are among the chosen values; no values choose all."""
    return reduce(lambda d, c: d.where(shown(c[0]).isin(*c[1])) if c[1] else d, chosen.items(), df)


def shown(c: X.Text) -> Column:
    return X.col(c).cast("string")


def options(df: DataFrame, column: str, descending: bool = False) -> DataFrame:
    """A column's distinct values, sorted; nulls and blank ones left out."""
    d = df.where(F.col(column).isNotNull() & (X.strip(shown(column)) != "")).select(column).distinct()
    return d.orderBy(F.desc(column) if descending else F.asc(column))


def latest(files: DataFrame, modified: str = "modified") -> DataFrame:
    return files.agg(F.max(modified).alias("latest"))


def number(c: X.Text, default: float = 0.0) -> Column:
    """A cell as a finite number, else the default."""
    v = X.col(c).try_cast("double")
    return F.when(v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))), F.lit(default)).otherwise(v)


def first_value(columns: Sequence[str], default: str = "Not available") -> Column:
    """The first of a row's columns that isn't blank."""
    return F.coalesce(*[F.when(X.strip(shown(c)) != "", shown(c)) for c in columns], F.lit(default))


def kpis(df: DataFrame, value: str, key: str) -> DataFrame:
    v = F.expr(f"try_cast(`{value}` as double)")
    return df.agg(F.count_distinct(key).alias("n"), X.round4(F.avg(v)).alias("mean"), F.max(v).alias("highest"), F.min(v).alias("lowest"))


def histogram(df: DataFrame, value: str) -> DataFrame:
    """bin, low, high and n of max(5, min(n, 20)) equally wide bins; the last holds its upper end."""
    s = df.where(F.col(value).isNotNull()).agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"), F.least(F.greatest(F.count("*"), F.lit(5)), F.lit(20)).alias("k"))
    w = (F.col("hi") - F.col("lo")) / F.col("k")
    place = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(F.least(F.floor((F.col(value) - F.col("lo")) / w), F.col("k") - 1))
    g = df.where(F.col(value).isNotNull()).crossJoin(F.broadcast(s)).select(place.cast("int").alias("bin"), "lo", "hi", "k").groupBy("bin", "lo", "hi", "k").agg(F.count("*").alias("n"))
    return g.select("bin", X.round4(F.col("lo") + F.col("bin") * w).alias("low"), X.round4(F.col("lo") + (F.col("bin") + 1) * w).alias("high"), "n")


def top(df: DataFrame, value: str, key: str, k: int = 10, ascending: bool = False) -> DataFrame:
    return df.orderBy(F.asc(value) if ascending else F.desc(value), key).limit(k)


def totals(df: DataFrame, group: str, value: str) -> DataFrame:
    return df.groupBy(group).agg(F.sum(value).alias("total")).where("total > 0")


def means(df: DataFrame, group: str, value: str, but: str = "Not available") -> DataFrame:
    return df.where(F.col(group) != but).groupBy(group).agg(X.round4(F.avg(value)).alias("mean"))


def trend(df: DataFrame, year: str, value: str) -> DataFrame:
    """x and y: the mean of each year if there are several, else scores by rank."""
    if df.select(year).distinct().limit(2).count() > 1:
        return df.groupBy(F.col(year).cast("long").alias("x")).agg(X.round4(F.avg(value)).alias("y"))
    # a rank over everything needs one order: ranks within range partitions, moved on by the sizes of those before
    r = df.select(F.col(value).cast("double").alias("y")).repartitionByRange("y").withColumn("p", F.spark_partition_id())
    sizes = r.groupBy("p").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inner = r.withColumn("i", F.row_number().over(Window.partitionBy("p").orderBy("y")))
    return inner.join(F.broadcast(sizes), "p").select((F.col("i") + F.col("before")).cast("long").alias("x"), "y")


def pivot(df: DataFrame, rows: str, columns: str, value: str, names: Sequence[str]) -> DataFrame:
    return df.groupBy(rows).pivot(columns, list(names)).agg(F.sum(value)).na.fill(0)


def melt(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    return df.unpivot(list(keys), list(values), "metric", "value")


def in_order(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """The rows of these names with ord, their place in the list."""
    m = F.create_map(*[x for i, n in enumerate(names) for x in (F.lit(n), F.lit(i))])
    return df.where(F.col(column).isin(*names)).withColumn("ord", F.element_at(m, F.col(column)))


def number_text(c: X.Text) -> Column:
    c = X.col(c)
    return F.when(c == F.floor(c), c.cast("long").cast("string")).otherwise(c.cast("string"))


def label(company: X.Text, ticker: X.Text, year: X.Text) -> Column:
    return F.concat(X.col(company), F.lit(" ("), X.col(ticker), F.lit(" · "), X.col(year).cast("string"), F.lit(")"))


def parse_recommendations(text: X.Text) -> Column:
    """The bullets under a report's Recommendations heading, up to the next."""
    a = F.transform(X.lines(text), lambda x: X.strip(x))
    start = F.array_position(F.transform(a, lambda x: F.lower(x)), "## recommendations")
    rest = F.when(start > 0, F.slice(a, start.cast("int") + 1, F.size(a))).otherwise(F.array().cast("array<string>"))
    ends = F.array_position(F.transform(rest, lambda x: x.startswith("## ")), True)
    body = F.when(ends > 1, F.slice(rest, 1, ends.cast("int") - 1)).when(ends == 1, F.array().cast("array<string>")).otherwise(rest)
    return F.transform(F.filter(body, lambda x: x.startswith("-")), lambda x: F.regexp_replace(x, "^[- ]+", ""))


def run_summary(results: DataFrame) -> DataFrame:
    return results.agg(F.count("*").alias("processed"), F.count_if(F.col("status") == "SUCCESS").alias("success"), F.count_if(F.col("status") != "SUCCESS").alias("failed"))


def violations(records: DataFrame) -> DataFrame:
    """record_id and problem of records that break a rule; nothing for sound ones."""
    rules = {
        "company_name is blank": X.strip(F.coalesce("company_name", F.lit(""))) == "",
        "ticker is blank": X.strip(F.coalesce("ticker", F.lit(""))) == "",
        "report_year is out of range": F.col("report_year").isNull() | ~F.col("report_year").between(1900, F.year(F.current_date()) + 1),
        "source_url isn't a web address": ~F.coalesce(F.col("source_url").rlike(r"^https?://[^/\s]+"), F.lit(False)),
        "disclosure_score is out of range": ~F.coalesce(F.col("disclosure_score").between(0, 100), F.lit(True)),
    }
    bad = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    return records.select("record_id", F.explode(bad).alias("problem"))


def markdown(scores: DataFrame, categories: DataFrame, sections: DataFrame) -> DataFrame:
    """record_id and the report as Markdown: score, words, counts by category, sections, recommendations."""
    c = categories.groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct("cat_pos", "category", "count"))).alias("c"))
    s = sections.groupBy("record_id").agg(F.array_sort(F.collect_list(F.struct("ord", "name"))).alias("s"))
    j = scores.join(c, "record_id", "left").join(s, "record_id", "left")
    lines = lambda a, f, none: F.coalesce(F.array_join(F.transform(a, f), "\n"), F.lit(none))
    body = F.format_string(
        "# %s Annual Report Analysis\n\nReport Year: %s\n\nDisclosure Score: %.2f\n\nTotal Words Analyzed: %d\n\n## Keyword Summary\n\n%s\n\n## Detected Sections\n\n%s\n\n## Recommendations\n\n%s\n",
        "company_name", F.col("report_year").cast("string"), F.coalesce("overall_score", F.lit(0.0)), "total_word_count",
        lines("c", lambda x: F.concat(F.lit("- "), x["category"], F.lit(": "), x["count"].cast("string")), "- No dictionary keywords detected"),
        F.coalesce(F.array_join(F.transform(F.array_distinct(F.transform("s", lambda x: x["name"])), lambda n: F.concat(F.lit("- "), n)), "\n"), F.lit("- No target sections detected")),
        lines("c", lambda x: F.concat(F.lit("- "), recommendation(x["category"], x["count"])), "- Expand disclosure across the configured innovation categories"),
    )
    return j.select("record_id", body.alias("markdown"))


def flatten(df: DataFrame, prefix: str = "") -> DataFrame:
    """Structs as columns joined by _, lists as texts joined by commas."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind == "struct":
            out += [F.col(f"`{f.name}`.`{x.name}`").alias(f"{f.name}_{x.name}") for x in f.dataType.fields]
        elif kind == "array":
            out.append(F.array_join(F.transform(F.col(f.name), lambda x: x.cast("string")), ", ").alias(f.name))
        else:
            out.append(F.col(f.name))
    flat = df.select(*out)
    return flatten(flat) if any(f.dataType.typeName() in ("struct", "array") for f in flat.schema.fields) else flat
