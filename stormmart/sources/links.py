"""Links of HTML index pages: text of every <a> element that holds a token."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stormmart.functions.text import strip_whitespace

ANCHOR = r"(?is)<a\b[^>]*>(.*?)</a>"
TAG = r"<[^>]*>"
REFERENCE = r"&#[0-9]+;?|&#[xX][0-9a-fA-F]+;?|&[A-Za-z][A-Za-z0-9]*;|[^&]+|&"
# --- fixed values: what the HTML standard reads numeric references 128 to 159 as
# (the characters of Windows-1252; the five that it lacks stay as they are).
WINDOWS_1252 = {
    128: 8364, 130: 8218, 131: 402, 132: 8222, 133: 8230, 134: 8224, 135: 8225, 136: 710, 137: 8240,
    138: 352, 139: 8249, 140: 338, 142: 381, 145: 8216, 146: 8217, 147: 8220, 148: 8221, 149: 8226,
    150: 8211, 151: 8212, 152: 732, 153: 8482, 154: 353, 155: 8250, 156: 339, 158: 382, 159: 376,
}
REPLACEMENT = 0xFFFD
# --- end of fixed values


def named_references() -> dict[str, str]:
    """Named references with their semicolon, as Python's standard library has them."""
    from html.entities import html5

    return {f"&{name}": text for name, text in html5.items() if name.endswith(";")}


def character(code: Column) -> Column:
    """The character of a numeric reference; U+FFFD where there is none."""
    mapped = F.coalesce(F.try_element_at(_literal_map(WINDOWS_1252), code), code)
    known = (mapped > 0) & (mapped <= 0x10FFFF) & ~mapped.between(0xD800, 0xDFFF)
    code = F.when(known, mapped).otherwise(REPLACEMENT)
    return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")


def _literal_map(values: dict) -> Column:
    """A map literal; Spark folds it into one constant."""
    return F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*map(F.lit, values.values())))


def decode_references(text: Column) -> Column:
    """Text with its character references decoded, in one pass from left to right:
    what a reference gives is never read as one again."""
    names = _literal_map(named_references())

    def piece(p: Column) -> Column:
        digits = F.regexp_extract(p, "^&#([0-9]+)", 1)
        hexes = F.regexp_extract(p, "^&#[xX]([0-9a-fA-F]+)", 1)
        # Longer numbers are no code points.
        number = F.when(digits != "", F.coalesce(digits.try_cast("int"), F.lit(-1)))
        number = number.when(hexes != "", F.coalesce(
            F.when(F.length(F.regexp_replace(hexes, "^0+", "")) <= 6,
                   F.conv(hexes, 16, 10).try_cast("int")), F.lit(-1)))
        return (F.when(F.startswith(p, F.lit("&#")) & (F.length(p) > 2), character(number))
                .when(F.startswith(p, F.lit("&")) & (F.length(p) > 1), F.coalesce(F.try_element_at(names, p), p))
                .otherwise(p))

    pieces = F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0))
    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(pieces, piece), "")).otherwise(text)


def anchor_text(inner: Column) -> Column:
    """Visible text of an anchor body: tags removed, references decoded."""
    return decode_references(F.regexp_replace(inner, TAG, ""))


def extract_links(pages: DataFrame, token: str | None, html_col: str = "html",
                  id_col: str = "page_id", max_anchors: int | None = None) -> DataFrame:
    """One row per matching link: (id, link_pos, link_text).

    Runs per page inside the scan task (no shuffle); ``link_pos`` is the 0-based
    position among all anchors of the page, ``link_text`` is stripped.
    ``max_anchors`` looks at only the first n anchors of each page (the
    parser's ``limit``), before the token test.
    """
    links = pages.select(
        id_col,
        F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(ANCHOR), F.lit(1)))
        .alias("link_pos", "inner"),
    ).withColumn("raw_text", anchor_text(F.col("inner")))
    if max_anchors is not None:
        links = links.filter(F.col("link_pos") < max_anchors)
    if token is not None:
        links = links.filter(F.col("raw_text").contains(token))
    return links.select(id_col, "link_pos", strip_whitespace("raw_text").alias("link_text"))


def count_links(links: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Number of matching links per page."""
    return links.groupBy(id_col).agg(F.count(F.lit(1)).alias("num_links"))
