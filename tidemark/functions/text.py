"""Column functions on texts and lines; all native, so they run inside generated code next to the scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import lexicons as L

Text = Column | str


def col(c: Text) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(c: Text, f) -> Column:
    """f of c, which is computed once, however often f names it and within whatever loop."""
    return F.element_at(F.transform(F.array(col(c)), f), 1)


def exploded(df: DataFrame, name: str) -> DataFrame:
    """df with a row for each element (none of them null) of the array name. An inner explode has Spark filter by the array's size first, which computes the array twice."""
    return df.withColumn(name, F.explode_outer(name)).where(F.col(name).isNotNull())


def strip(c: Text) -> Column:
    return F.btrim(col(c), F.lit(" \t\n\x0b\f\r"))


def collapse(c: Text) -> Column:
    return F.regexp_replace(c, r"\s+", " ")


def casefold(c: Text) -> Column:
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def lines(c: Text) -> Column:
    """Lines of a text, at any line end; one ending the text opens no further line. Null: none."""
    rare = r"[\r\x0b\x0c\x1c-\x1e\x85  ]"
    one_end = lambda t: F.when(t.rlike(rare), F.regexp_replace(t, rf"\r\n|{rare}", "\n")).otherwise(t)
    return let(let(F.coalesce(col(c), F.lit("")), one_end), lambda t: F.split(F.when(F.endswith(t, F.lit("\n")), F.regexp_replace(t, r"\n\z", "")).otherwise(t), "\n", -1))


def canonical_line(c: Text) -> Column:
    return casefold(strip(collapse(c)))


def tabs(c: Text) -> Column:
    return F.regexp_replace(c, r"\t+", " ")


def special_characters(c: Text) -> Column:
    return F.regexp_replace(c, rf"[^\p{{L}}\p{{N}}\p{{M}}_\s{L.KEPT}]", " ")


def non_printable(c: Text) -> Column:
    return F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")


def each_line(c: Text, f) -> Column:
    return F.array_join(F.transform(lines(c), f), "\n")


def spaces(c: Text) -> Column:
    return each_line(c, lambda x: strip(F.regexp_replace(x, r" {2,}", " ")))


def blank_lines(c: Text) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"\r\n?", "\n"), r"\n{3,}", "\n\n")


def quotes(c: Text) -> Column:
    return F.translate(c, L.SINGLE_QUOTES + L.DOUBLE_QUOTES, "'" * len(L.SINGLE_QUOTES) + '"' * len(L.DOUBLE_QUOTES))


def hyphens(c: Text) -> Column:
    out = F.translate(c, L.HYPHENS + L.SOFT_HYPHEN, "-" * len(L.HYPHENS))
    return reduce(lambda x, d: F.replace(x, F.lit(d), F.lit(" - ")), L.LONG_DASHES, out)


def bullets(c: Text) -> Column:
    return F.regexp_replace(c, rf"(?m)^\s*[{L.BULLETS}]\s+", "- ")


def newlines(c: Text) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\r\n?", "\n"), r"[ \t]+\n", "\n"), r"\n{3,}", "\n\n")


def inline_spaces(c: Text) -> Column:
    return each_line(c, lambda x: strip(F.regexp_replace(x, r"[^\S\r\n]{2,}", " ")))


def acronyms(c: Text) -> Column:
    """Known acronyms get their casing, whatever they mean there ("it" too). What stands before one is looked at only where its letters are."""
    edge = r"[\p{L}\p{N}\p{M}_]"
    return reduce(lambda x, a: F.regexp_replace(x, rf"(?i)\Q{a}\E(?<!{edge}\Q{a}\E)(?!{edge})", a), sorted(L.ACRONYMS, key=lambda a: (-len(a), a)), col(c))


def lower_but_acronyms(c: Text) -> Column:
    parts = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(?s)\b[A-Z][A-Z0-9]*(?:&[A-Z0-9]+)?\b|."), F.lit(0))
    return F.array_join(F.transform(parts, lambda x: F.when(x.isin(*L.ACRONYMS), x).otherwise(F.lower(x))), "")


def title_share(c: Text, pattern: str, share: float) -> Column:
    """Whether so large a share of a line's words begin with a capital; one at least."""
    n = lambda w: F.size(F.filter(w, lambda x: x.rlike("^[A-Z]")))
    return let(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), lambda w: (F.size(w) > 0) & (n(w) >= F.greatest(F.lit(1), F.floor(F.size(w) * F.lit(share)).cast("int"))))


def heading_key(c: Text) -> Column:
    return casefold(collapse(F.regexp_replace(strip(c), "^:+|:+$", "")))


def known_heading(stripped: Column) -> Column:
    """Whether heading_key makes a known heading of a stripped line, by one pattern: it lower-cases the Kelvin sign to k and turns ß into ss."""
    letter = lambda x: r"\s+" if x == " " else "[kK\u212a]" if x == "k" else f"[{x}{x.upper()}]" if x.isalpha() else rf"\Q{x}\E"
    one = lambda h: "(?:[sS][sS]|[ß\u1e9e])".join("".join(map(letter, p)) for p in h.split("ss"))
    return stripped.rlike(rf"\A:*(?:{'|'.join(one(h.lower()) for h in L.REPORT_HEADINGS)}):*\z")


def heading_like(c: Text, company_suffix: bool = False) -> Column:
    """A line that reads like a heading; with company_suffix, names of companies don't."""
    s = strip(c)
    known = known_heading(s)
    shape = (F.length(s) <= 120) & ~s.rlike(r"[.,;]$") & title_share(s, "[A-Za-z&']+", 0.7)
    out = (s != "") & (known | shape) if company_suffix else (F.length(s).between(1, 120)) & ~s.rlike(r"[.,;]$") & s.rlike("[A-Za-z&']") & (known | shape)
    return out & ~s.rlike(L.COMPANY_SUFFIX) if company_suffix else out


def normalized_heading(c: Text) -> Column:
    """The form that headings are compared in. A first letter counts as a number and goes, from lexicon and text alike."""
    s = F.regexp_replace(F.regexp_replace(strip(c), "^:+|:+$", ""), L.NUMBER_PREFIX, "")
    s = F.replace(F.replace(s, F.lit("&"), F.lit(" and ")), F.lit("+"), F.lit(" plus "))
    return casefold(strip(collapse(F.regexp_replace(s, r"[^\p{L}\p{N}\p{M}_\s&/+-]", " "))))


def normalize_keyword(c: Text) -> Column:
    s = F.regexp_replace(F.coalesce(c, F.lit("")), r"[-‐-―−]", " ")
    s = F.translate(s, L.SINGLE_QUOTES, "'" * len(L.SINGLE_QUOTES))
    return casefold(strip(collapse(F.replace(F.replace(s, F.lit("&"), F.lit(" and ")), F.lit("/"), F.lit(" ")))))


def metric_key(c: Text) -> Column:
    """The metrics' own form of a keyword: unlike the dictionary's it keeps dashes and slashes."""
    return casefold(strip(collapse(F.replace(F.coalesce(col(c), F.lit("")), F.lit("&"), F.lit(" and ")))))


def match_text(c: Text) -> Column:
    """The form that keywords are looked for in: its word tokens, lower-cased, one space apart."""
    s = F.regexp_replace(F.coalesce(c, F.lit("")), r"[-‐-―−]", " ")
    s = F.translate(s, L.SINGLE_QUOTES, "'" * len(L.SINGLE_QUOTES))
    s = F.replace(F.replace(s, F.lit("&"), F.lit(" and ")), F.lit("/"), F.lit(" "))
    return F.array_join(F.regexp_extract_all(casefold(s), F.lit(L.WORD), F.lit(0)), " ")


def word_count(c: Text) -> Column:
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(L.WORD))


def round4(c: Column) -> Column:
    return F.floor(c * F.lit(10000.0) + F.lit(0.5)) / F.lit(10000.0)


def ratio(num: Column, den: Column, scale: float = 1.0) -> Column:
    """round(num / den * scale, 4); 0 where den isn't positive."""
    return F.when(den > 0, round4(num / den * F.lit(scale))).otherwise(F.lit(0.0))


def slug(ticker: Text, year: Text) -> Column:
    return F.concat_ws("_", F.regexp_replace(F.regexp_replace(casefold(ticker), "[^a-z0-9]+", "_"), "^_+|_+$", ""), col(year).cast("string"))


def parse_year(c: Text) -> Column:
    """The first 19xx or 20xx in a text ("2024-25": 2024); null if it has none."""
    return F.try_to_number(F.nullif(F.regexp_extract(c, r"(?:19|20)\d{2}", 0), F.lit("")), F.lit("9999")).cast("int")


def safe_filename(c: Text, replacement: str = "_", most: int = 180) -> Column:
    s = F.regexp_replace(c, r'[<>:"/\\|?*\x00-\x1f]', replacement)
    s = F.regexp_replace(F.regexp_replace(collapse(s), r"^[ .]+|[ .]+$", ""), rf"\Q{replacement}\E+", replacement)
    s = F.when(s == "", F.lit("untitled")).otherwise(s)
    return F.regexp_replace(F.substring(s, 1, most), r"[ .]+$", "")


def clock(seconds: Text) -> Column:
    """HH:MM:SS of seconds, rounded, not below zero."""
    s = F.greatest(F.lit(0), F.round(col(seconds)).cast("long"))
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    h = F.floor(s / 3600).cast("long")
    return F.concat_ws(":", F.when(h < 10, two(h)).otherwise(h.cast("string")), two(F.floor(s % 3600 / 60).cast("long")), two(s % 60))
