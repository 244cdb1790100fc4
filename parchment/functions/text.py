"""Text expressions: Columns in, Columns out, all inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that must match as the formats have them.
NUMBER = r"[-+]?\d[\d,]*(?:\.\d+)?%?"
SPACE = r"(?U)[\s\x1c-\x1f]+"
# The characters of SPACE.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
CIRCLED = r"[①-㊿]"
TITLE = r"^(#{1,6}\s+|[■☑]\s*|\d+\.\s*)"
TITLE_PREFIX = r"^(?:#{1,6}\s*|[■☑]\s*|\d+\.\s*)"
TAG = r"<[^>]+>"
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "'"), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def normalize_space(c: Column) -> Column:
    """Runs of Unicode white space become one space; none at the ends. Null becomes empty."""
    return F.trim(F.regexp_replace(or_empty(c), SPACE, " "))


def strip(c: Column) -> Column:
    """White space off both ends, inner runs as they are."""
    return F.btrim(or_empty(c), F.lit(WHITE))


def numbers(c: Column) -> Column:
    return F.regexp_extract_all(or_empty(c), F.lit(NUMBER), F.lit(0))


def count_numbers(c: Column) -> Column:
    return F.regexp_count(or_empty(c), F.lit(NUMBER))


def count_data_numbers(c: Column) -> Column:
    """Numbers, without circled and other enclosed ones, which mark footnotes."""
    return F.regexp_count(F.regexp_replace(or_empty(c), CIRCLED, ""), F.lit(NUMBER))


def escape_html(c: Column) -> Column:
    for raw, entity in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")]:
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def unescape_basic(c: Column) -> Column:
    """The entities that escape_html writes, and the non-breaking space; ampersands last."""
    for entity, raw in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(raw))
    return c


def safe_html(c: Column) -> Column:
    return F.replace(escape_html(or_empty(c)), F.lit("\n"), F.lit("<br />"))


def lines(c: Column) -> Column:
    """Normalised lines that are not empty, in order."""
    return F.filter(F.transform(F.split(or_empty(c), LINE_END), normalize_space), lambda x: x != "")


def tokens(c: Column) -> Column:
    """Distinct words in the order of their first place."""
    return F.array_distinct(F.filter(F.split(normalize_space(c), " "), lambda x: x != ""))


def truncate(c: Column, limit: int = 220) -> Column:
    c = normalize_space(c)
    return F.when(F.char_length(c) <= limit, c).otherwise(F.concat(F.left(c, F.lit(limit - 3)), F.lit("...")))


def is_title(c: Column) -> Column:
    return normalize_space(c).rlike(TITLE)


def is_contextual_title(line: Column, following: Column) -> Column:
    """A title by its mark, or a short line before a table: with one number at most, or a colon at its end."""
    line = normalize_space(line)
    table_next = F.lower(or_empty(following)).contains("<table") | or_empty(following).contains("|")
    short = (F.char_length(line) <= 40) & table_next & ((count_numbers(line) <= 1) | line.endswith(":"))
    return (line != "") & (is_title(line) | short)


def without_title_prefix(c: Column) -> Column:
    return normalize_space(F.regexp_replace(or_empty(c), TITLE_PREFIX, ""))


def heading_text(c: Column) -> Column:
    return F.regexp_replace(or_empty(c), r"^#{1,6}\s+", "")


def badge(text: Column, tone: Column) -> Column:
    kind = F.when(tone == "warn", F.lit("badge warn")).when(tone == "bad", F.lit("badge bad")).otherwise(F.lit("badge"))
    return F.concat(F.lit('<span class="'), kind, F.lit('">'), safe_html(text), F.lit("</span>"))


def status_tone(status: Column) -> Column:
    return F.when(status.isin("match", "review_ok"), "normal").when(status.isin("partial", "needs_review"), "warn").otherwise("bad")


def html_path(path: Column) -> Column:
    parent = F.regexp_extract(path, r"([^/]*)/[^/]*$", 1)
    return F.when(parent == "source_pages", F.concat(parent, F.lit("/"), F.regexp_extract(path, r"([^/]*)$", 1))).otherwise(path)
