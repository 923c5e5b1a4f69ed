"""Records out of stored pages, as column expressions over a table of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.text import plain_text


def titles(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    found = F.regexp_extract(F.col(html), r"(?is)<title[^>]*>(.*?)</title>", 1)
    return pages.select(key, F.nullif(F.trim(found), F.lit("")).alias("title"))


def links(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per link in order: position (from 0), href and its plain text."""
    anchors = F.regexp_extract_all(F.col(html), F.lit(r"""(?is)<a\b[^>]*href\s*=\s*["'][^"']*["'][^>]*>.*?</a>"""), 0)
    rows = pages.select(key, F.posexplode(anchors).alias("position", "a"))
    return rows.select(key, "position", F.regexp_extract("a", r"""(?is)href\s*=\s*["']([^"']*)["']""", 1).alias("href"), plain_text(F.col("a")).alias("label"))


def texts(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    return pages.select(key, plain_text(F.col(html)).alias("text"))


def elements(pages: DataFrame, tag: str, key: str = "page_id", html: str = "html") -> DataFrame:
    """Plain text of all elements of a tag, in order."""
    found = F.regexp_extract_all(F.col(html), F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"), 1)
    rows = pages.select(key, F.posexplode(found).alias("position", "inner"))
    return rows.select(key, "position", plain_text(F.col("inner")).alias("text"))


def labelled(texts: DataFrame, labels: list[str], key: str = "page_id", text: str = "text") -> DataFrame:
    """Values that follow a label and a colon on its line; null where the label is missing."""
    value = lambda n: F.nullif(F.trim(F.regexp_extract(F.col(text), rf"(?im)^\s*{n}\s*:\s*(.+)$", 1)), F.lit(""))
    return texts.select(key, *[value(n).alias(n.lower().replace(" ", "_")) for n in labels])


def table_cells(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Cells of all tables: row and column positions and plain text."""
    rows = pages.select(key, F.posexplode(F.regexp_extract_all(F.col(html), F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"), 1)).alias("row", "inner"))
    cells = rows.select(key, "row", F.posexplode(F.regexp_extract_all(F.col("inner"), F.lit(r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]\s*>"), 1)).alias("column", "cell"))
    return cells.select(key, "row", "column", plain_text(F.col("cell")).alias("text"))
