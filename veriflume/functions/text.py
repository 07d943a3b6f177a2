"""Column functions over strings. All are built-in expressions: no Python runs per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a URL.
URL = r"(?i)\bhttps?://[^\s<>'\"]+"
# Tokens that point to something other than running text, in the order in which they are tried.
GRAPH_TOKENS = ("figure", "fig.", "fig ", "graph", "diagram", "chart", "table", "image", "photo", "schematic", "map", "plot")
# Quotes that are nothing but such a reference, and hints inside longer quotes.
TRIVIAL_QUOTE = r"(?i)^(?:table|figure|fig\.?\s*\d+|graph|chart|content|n\.?a\.?|na)$"
NON_TEXTUAL_HINT = r"(?i)\b(?:figure|fig\.?|table|graph|chart|diagram|plot)\b|\bshown\s+in\b|\bsee\s+(?:figure|fig\.?|table)\b"


def strip(c: Column) -> Column:
    """Trim any Unicode white space (Spark's trim takes spaces only)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space, no-break spaces and tabs to one space, ends trimmed, null to empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[\s\x{A0}]+", " "))


def match_form(c: Column) -> Column:
    """Form in which quotes and sentences are compared: straight quotes and dashes, no soft hyphens, words joined over
    line breaks, short author-year citations removed. What is left round a removed citation is not squeezed again."""
    c = F.translate(F.coalesce(c, F.lit("")), " \t‘’“”–—­", "  ''\"\"--")
    for pattern, by in ((r"(?U)-\s*\n\s*", ""), (r"(?U)\s*\n+\s*", " "), (r"(?U)\s+", " "), (r"\(\s*[A-Za-z]+(?: et al\.)?,?\s*\d{4}[a-z]?\s*\)", "")):
        c = F.regexp_replace(c, pattern, by)
    return strip(c)


def shorten(c: Column, n: int) -> Column:
    c = squeeze(c)
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n - 1), F.lit("…"))).otherwise(c)


def bm25_tokens(c: Column) -> Column:
    """Lower-case ASCII alphanumeric runs; other letters split words."""
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+"), lambda x: x != "")


def word_tokens(c: Column) -> Column:
    """Case-sensitive words and single punctuation marks: an approximation of a rule-based tokenizer."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"([\p{L}\p{N}_]+|[^\s\p{L}\p{N}_])"), F.lit(1))


def marker_count(c: Column, markers: tuple[str, ...]) -> Column:
    """Occurrences of all markers in the lower-cased, squeezed text."""
    t = squeeze(F.lower(c))
    counts = []
    for m in markers:
        if m.endswith(" "):
            counts.append(((F.length(t) - F.length(F.replace(t, F.lit(m), F.lit("")))) / len(m)).cast("int"))
        else:
            counts.append(F.regexp_count(t, F.lit(r"\b" + "".join("\\" + x if not x.isalnum() and x != " " else x for x in m) + r"\b")))
    return reduce(lambda a, b: a + b, counts, F.lit(0)).cast("int")


def group_key(c: Column) -> Column:
    return F.lower(squeeze(c))


def sha_normal(c: Column) -> Column:
    """Trimmed, lower-cased hex digest of 64 digits; sentinels and anything else are null."""
    v = F.lower(strip(c.cast("string")))
    return F.when(v.rlike("^[0-9a-f]{64}$"), v)


def sha_loose(c: Column) -> Column:
    v = F.lower(strip(c.cast("string")))
    return F.when(~v.isin("", "none", "nan", "null"), v)


def basename(c: Column) -> Column:
    return F.regexp_extract(c, "([^/]*)/?$", 1)


def suffix(c: Column) -> Column:
    """Lower-cased extension with its dot; none for dot-files."""
    return F.lower(F.regexp_extract(basename(c), r"[^.](\.[^.]+)$", 1))


def stem(c: Column) -> Column:
    return F.regexp_replace(basename(c), r"(?<=[^.])\.[^.]+$", "")


def sanitize_filename(c: Column) -> Column:
    last = F.regexp_extract(F.coalesce(c, F.lit("")), "([^/]*)$", 1)
    return F.coalesce(F.nullif(strip(F.regexp_replace(last, r'[\\:*?"<>|]+', "_")), F.lit("")), F.lit("download.bin"))


def unhyperlink(c: Column) -> Column:
    """``=HYPERLINK("url","text")`` cells become their text."""
    return F.regexp_replace(c, r'(?i)^\s*=\s*HYPERLINK\s*\(\s*"([^"]*)"\s*,\s*"([^"]*)"\s*\)\s*$', "$2")


def urls_in(c: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"({URL})"), F.lit(1))


def non_empty(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(?U)\S"), F.lit(False))


def truthy(c: Column) -> Column:
    return F.coalesce(F.lower(strip(c.cast("string"))).isin("1", "true", "t", "yes", "y"), F.lit(False))


def whitespace_normal(c: Column) -> Column:
    """Blanks and tabs squeezed, carriage returns dropped, newlines kept, ends trimmed."""
    return strip(F.replace(F.regexp_replace(c, r"[ \t]+", " "), F.lit("\r"), F.lit("")))


def valid_utf8(content: Column) -> Column:
    """Bytes as text without what is not UTF-8 (genuine replacement characters go too)."""
    return F.replace(F.make_valid_utf8(content.cast("string")), F.lit("�"), F.lit(""))


def quote_intent(c: Column) -> Column:
    kind = lambda q: F.when(q == "", "empty").when(q.rlike(TRIVIAL_QUOTE), "non_verifiable_trivial").when(q.rlike(NON_TEXTUAL_HINT), "non_textual_hint").otherwise("textual")
    return F.element_at(F.transform(F.array(match_form(c)), kind), 1)  # the form is made once


def graph_reason(source_quote: Column, report_quote: Column) -> Column:
    """Why a row seems to cite a figure or table; empty if it doesn't. The rules are tried in order."""
    src, rep = strip(F.coalesce(source_quote, F.lit(""))), strip(F.coalesce(report_quote, F.lit("")))
    n_src, n_rep = F.length(src), F.length(rep)
    out = F.when((n_src < 40) & (n_rep > 0) & (n_rep / F.greatest(F.lit(1), n_src + 1) >= 3), "short_source_vs_long_report")
    for token in GRAPH_TOKENS:
        out = out.when(F.contains(F.lower(src), F.lit(token)), f"token:{token}")
    return out.when((n_src == 0) & (n_rep >= 80), "empty_source_long_report").otherwise("")


def candidate_id(*parts: Column) -> Column:
    """sha256 of the parts joined by bars; nulls count as empty."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)


def clock(pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(F.current_timestamp(), pattern)
