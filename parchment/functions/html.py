"""Expressions over HTML and markdown tables kept as text, all inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parchment.functions.text import TAG, bound, escape_html, normalize_space, or_empty, strip, unescape_basic

# Patterns of the table formats.
TABLE = r"(?is)(<table\b.*?</table>)"
TABLE_PARTS = r"(?is)(<table\b[^>]*>)(.*?)(</table>)"
ROW = r"(?is)<tr\b[^>]*>.*?</tr>"
ROW_INNER = r"(?is)<tr\b[^>]*>(.*?)</tr>"
CELL_INNER = r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>"
CELL_OPEN = r"(?i)<t[dh]\b[^>]*>"
# A cell's opening tag, and what follows it up to the next closing tag, if there is one.
CELL_PARTS = r"(?is)(<t[dh]\b[^>]*>)(?=(?:(.*?)</t[dh]>)?)"
STYLE = r"""(?i)\s*style\s*=\s*["'][^"']*["']"""
PIPE_TABLE = r"(?m)(?:^|\n)(\|.+\|\n\|[-:| ]+\|\n(?:\|.*\|\n?)*)"
HEADER_HINT = "(?=[가-힣])(구분|공정|가동율|계획|실적|수량|금액|달성율|진척율|양품|불량)"
BLOCK_TAG = r"(?i)</?(?:tr|p|div|section|article|h[1-6]|li|ul|ol|blockquote|br)\b[^>]*>"
CELL_TAG = r"(?i)</?(?:td|th)\b[^>]*>"
FRAGMENT = r"(?i)<\s*(table|div|p|h[1-6]|ul|ol|li|blockquote|span|section|article)\b"
NATIVE_CELL = r"(?s)<(?:fcel|lcel|xcel)>(.*?)</(?:fcel|lcel|xcel)>"
TEXT_RUN = "[0-9A-Za-z가-힣]+"


def extract_all(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(or_empty(c), F.lit(pattern), F.lit(group))


def first_table(c: Column) -> Column:
    """The first table in a text, or empty."""
    return F.trim(F.regexp_extract(or_empty(c), TABLE, 1))


def clean_table(html: Column) -> Column:
    """The first table without style attributes in its own tag and its cells' and without white space between tags; empty without a table."""
    table = F.regexp_extract(or_empty(html), TABLE, 1)
    return strip(F.regexp_replace(F.regexp_replace(table, STYLE, ""), r">\s+<", "><"))


def clean_for_training(html: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(or_empty(html), STYLE, ""), r">\s+<", "><"))


def pipe_table_to_html(md: Column) -> Column:
    """The first pipe table as HTML with head and body; empty without one. A pipe within a cell splits it, even if escaped."""
    table = strip(F.regexp_extract(or_empty(md), PIPE_TABLE, 1))
    rows = F.filter(F.transform(F.split(table, "\n"), strip), lambda x: x != "")
    cells = lambda row: F.transform(F.split(F.regexp_replace(row, r"^\|+|\|+$", ""), r"\|"), lambda c: escape_html(strip(c)))
    row_html = lambda row, tag: F.concat(F.lit(f"<tr><{tag}>"), F.array_join(cells(row), f"</{tag}><{tag}>"), F.lit(f"</{tag}></tr>"))
    body = F.array_join(F.transform(F.slice(rows, 3, F.greatest(F.size(rows) - 2, F.lit(0))), lambda r: row_html(r, "td")), "")
    html = F.concat(F.lit("<table><thead>"), row_html(F.get(rows, F.lit(0)), "th"), F.lit("</thead><tbody>"), body, F.lit("</tbody></table>"))
    return F.when((table != "") & (F.size(rows) >= 2), html).otherwise("")


def cell_text(inner: Column) -> Column:
    """A cell's text: tags become spaces, basic entities are decoded."""
    return strip(unescape_basic(F.regexp_replace(inner, TAG, " ")))


def row_cells(row: Column) -> Column:
    """Texts of a row's cells that are not empty, normalised."""
    text = lambda c: normalize_space(unescape_basic(F.regexp_replace(c, TAG, " ")))
    return F.filter(F.transform(extract_all(row, CELL_INNER), text), lambda x: x != "")


def html_to_text(c: Column) -> Column:
    """Plain lines: block ends break lines, cell ends become spaces, other tags go. Text without tags stays as it is."""
    text = F.regexp_replace(or_empty(c), BLOCK_TAG, "\n")
    text = F.regexp_replace(text, CELL_TAG, "\t")
    text = unescape_basic(F.regexp_replace(text, TAG, " "))
    kept = F.filter(F.transform(F.split(text, "\n"), normalize_space), lambda x: x != "")
    return F.when(or_empty(c).contains("<") & or_empty(c).contains(">"), F.array_join(kept, "\n")).otherwise(or_empty(c))


def span_of(cell_open: Column, name: str) -> Column:
    """rowspan or colspan of an opening tag; 1 without one."""
    value = F.regexp_extract(cell_open, rf"""(?i)\b{name}\s*=\s*["']?(\d+)["']?""", 1)
    return F.when(value == "", F.lit(1)).otherwise(value.cast("int"))


def set_span(attrs: Column, name: str, value: Column) -> Column:
    """A tag's attributes with the span replaced, added, or taken out if it is 1 or less."""
    has = attrs.rlike(rf"(?i)\b{name}\s*=")
    out = F.regexp_replace(attrs, rf"""(?i)\s*\b{name}\s*=\s*["']?\d+["']?""", "")
    changed = F.regexp_replace(attrs, F.lit(rf"""(?i)(\b{name}\s*=\s*["']?)\d+(["']?)"""), F.concat(F.lit("$1"), F.lit("\u0000"), F.lit("$2")))
    changed = F.replace(changed, F.lit("\u0000"), value.cast("string"))
    return F.when(value <= 1, out).when(has, changed).otherwise(F.concat(attrs, F.lit(f' {name}="'), value.cast("string"), F.lit('"')))


def structure_score(shapes: Column) -> Column:
    """Of rows (cells, empty, columns): 5 times the share of filled cells, and 3 if all rows have equally many columns; 0 for fewer than two rows."""
    total = lambda name: F.aggregate(shapes, F.lit(0), lambda a, r: a + r[name])
    even = F.when(F.size(F.array_distinct(F.transform(shapes, lambda r: r.columns))) == 1, F.lit(3.0)).otherwise(0.0)
    filled = F.greatest(F.lit(0.0), F.lit(5.0) * (1.0 - total("empty") / F.nullif(total("cells"), F.lit(0))))
    return F.when((F.size(shapes) < 2) | (total("cells") == 0), F.lit(0.0)).otherwise(filled + even)


def row_shape(row: Column) -> Column:
    """(cells, empty, columns) of a row: how many cells it has, how many of them hold nothing but tags and white space, and how many columns they span."""
    empty = lambda x: (x == "") | ~F.when(x.contains("<"), F.regexp_replace(x, TAG, "")).otherwise(x).rlike(r"\S")
    spans = F.aggregate(extract_all(row, CELL_OPEN, 0), F.lit(0), lambda a, t: a + span_of(t, "colspan"))
    shape = lambda c: F.struct(
        F.size(c).alias("cells"),
        F.size(F.filter(c, empty)).alias("empty"),
        F.when(row.rlike("(?i)colspan"), spans).otherwise(F.regexp_count(row, F.lit(CELL_OPEN))).alias("columns"),
    )
    return bound(extract_all(row, CELL_INNER), shape)


def table_score(html: Column, markdown: Column, text: Column) -> Column:
    """How much a table candidate holds: rows, cells, header words, text, length and structure."""
    html, markdown = or_empty(html), or_empty(markdown)
    first = F.when(html != "", html).when(markdown != "", markdown).otherwise(normalize_space(text))
    runs = F.regexp_count(F.regexp_replace(html, TAG, " "), F.lit(TEXT_RUN))
    runs = runs + F.when((html == "") & (markdown != ""), F.regexp_count(markdown, F.lit(TEXT_RUN))).otherwise(0)
    rest = F.regexp_count(html, F.lit(CELL_INNER)) * 0.6 + F.regexp_count(first, F.lit(HEADER_HINT)) * 2.5 + runs * 0.2
    rest = rest + F.least(F.char_length(html), F.lit(4000)) / 400.0 + F.least(F.char_length(markdown), F.lit(2000)) / 500.0
    # Rows are taken out once for their number and their shapes, which are worked out once.
    shapes = F.transform(extract_all(html, ROW_INNER), row_shape)
    return bound(shapes, lambda rows: F.size(rows) * 2.0 + structure_score(rows)) + rest


def table_cells(c: Column) -> Column:
    """Cell texts of an HTML table, or else of the native cell format; empty ones are left out."""
    bare = lambda x: strip(F.when(x.contains("<"), F.regexp_replace(x, TAG, "")).otherwise(x))
    native = F.filter(F.transform(extract_all(c, NATIVE_CELL), strip), lambda x: x != "")
    return bound(extract_all(c, r"(?s)<t[dh][^>]*>(.*?)</t[dh]>"), lambda html: F.when(F.size(html) > 0, F.filter(F.transform(html, bare), lambda x: x != "")).otherwise(native))


def table_rows(c: Column) -> Column:
    c = or_empty(c)
    rows, breaks = F.regexp_count(c, F.lit(r"(?i)<tr\b")), F.regexp_count(c, F.lit("<nl>"))
    return F.coalesce(F.nullif(rows, F.lit(0)), F.nullif(breaks, F.lit(0)) + 1, F.regexp_count(c, F.lit("<xcel>")))


def table_columns(c: Column) -> Column:
    """Columns of the first row, spans in double quotes counted; null if there is no row. Rows after the first are not read."""
    c = or_empty(c)

    def wide(first: Column) -> Column:
        spans = F.regexp_extract_all(first, F.lit(r'(?i)colspan\s*=\s*"(\d+)"'), F.lit(1))
        return F.regexp_count(first, F.lit(r"(?i)<t[dh]\b")) + F.aggregate(spans, F.lit(0), lambda a, x: a + x.cast("int") - 1)

    native = F.regexp_count(F.get(F.split(c, "<nl>|<xcel>", 2), F.lit(0)), F.lit("<(?:fcel|lcel|xcel)>"))
    return F.when(c.rlike(ROW_INNER), bound(F.regexp_extract(c, ROW_INNER, 1), wide)).otherwise(F.nullif(native, F.lit(0)))


def table_format(c: Column) -> Column:
    c = or_empty(c)
    return F.when(c.contains("<table"), "html").when(c.contains("<fcel>"), "native").otherwise("unknown")


def is_fragment(c: Column) -> Column:
    """Whether a text, once decoded, holds a block of HTML."""
    return unescape_basic(strip(c)).rlike(FRAGMENT)


def structure_tokens(rows: Column) -> Column:
    """Structure tokens of a table's rows for training: rows, cells by their tag, and around spans over 1 tokens of their own."""

    def cell(full: Column) -> Column:
        tag = F.lower(F.substring(full, 2, 2))
        begin, end = F.concat(F.lit("<"), tag, F.lit(">")), F.concat(F.lit("</"), tag, F.lit(">"))

        def spanned(s: Column) -> Column:
            start = [F.when(s[n] > 1, F.concat(F.lit(f"<{n}="), s[n].cast("string"), F.lit(">"))) for n in ("rowspan", "colspan")]
            return F.array_compact(F.array(begin, *start, *[F.when(s[n] > 1, F.lit(f"</{n}>")) for n in ("colspan", "rowspan")], end))

        spans = F.struct(*[span_of(full, n).alias(n) for n in ("rowspan", "colspan")])
        return F.when(full.rlike("(?i)span"), bound(spans, spanned)).otherwise(F.array(begin, end))

    return F.flatten(F.transform(rows, lambda r: F.concat(F.array(F.lit("<tr>")), F.flatten(F.transform(extract_all(r, CELL_INNER, 0), cell)), F.array(F.lit("</tr>")))))


def cell_characters(rows: Column) -> Column:
    """Characters of the text of each cell of a table's rows."""
    cells = F.flatten(F.transform(rows, lambda r: extract_all(r, CELL_INNER)))
    text = lambda c: F.when(c.contains("<") | c.contains("&"), unescape_basic(F.regexp_replace(c, TAG, ""))).otherwise(c)
    return F.transform(cells, lambda c: F.filter(F.split(strip(text(c)), ""), lambda x: x != ""))
