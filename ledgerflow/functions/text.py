"""Text as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words of street addresses and their short forms.
SUFFIXES = {
    "STREET": "ST", "AVENUE": "AVE", "ROAD": "RD", "BOULEVARD": "BLVD", "DRIVE": "DR", "LANE": "LN",
    "COURT": "CT", "PLACE": "PL", "TERRACE": "TER", "HIGHWAY": "HWY",
}
DIRECTIONS = {"NORTH": "N", "SOUTH": "S", "EAST": "E", "WEST": "W"}
#: Characters by which a spreadsheet takes a cell for a formula, and numbers with a sign.
FORMULA = r"^ *[=+\-@\t\r\n]"
SIGNED_NUMBER = r"^\s*[+-](?:\d+(?:\.\d*)?|\.\d+)(?:[Ee][+-]?\d+)?\s*$"
#: Named characters of HTML.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&amp;": "&"}


def clean(c: Column) -> Column:
    """White space of any kind collapsed and trimmed; blank becomes null."""
    return F.nullif(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit(""))


def clean_loose(c: Column) -> Column:
    """clean, without commas and asterisks at the ends."""
    return F.nullif(F.trim(F.btrim(clean(c), F.lit(" ,*"))), F.lit(""))


def canonical(c: Column) -> Column:
    return F.upper(clean(c))


def token(c: Column) -> Column:
    """Only A-Z and 0-9, in upper case."""
    return F.nullif(F.regexp_replace(F.upper(c), "[^A-Z0-9]", ""), F.lit(""))


def project_key(c: Column) -> Column:
    """Upper case with everything that is no letter or digit as one blank."""
    return F.nullif(F.trim(F.regexp_replace(F.upper(c), "[^A-Z0-9]+", " ")), F.lit(""))


def normalize_address(c: Column, directions: bool = True) -> Column:
    """Upper case, punctuation as blanks, street words (and directions) in their short forms."""
    short = SUFFIXES | (DIRECTIONS if directions else {})
    table = F.create_map(*[F.lit(x) for kv in short.items() for x in kv])
    words = F.split(project_key(c), " ")
    return F.array_join(F.transform(words, lambda w: F.coalesce(F.element_at(table, w), w)), " ")


def address_parts(c: Column) -> Column:
    """struct of street_number, street_name and postal_code; null where absent."""
    text = clean(c)
    part = lambda pattern, group: F.nullif(F.trim(F.regexp_extract(text, pattern, group)), F.lit(""))
    return F.struct(
        part(r"^(\d+[A-Za-z]?)\s", 1).alias("street_number"),
        part(r"^(?:\d+[A-Za-z]?\s+)?([^,]+)", 1).alias("street_name"),
        part(r"\b(\d{5})(?:-\d{4})?$", 1).alias("postal_code"),
    )


def extract_url(c: Column, *fallback: Column) -> Column:
    """The first http(s) address inside c, else c itself, else the fallbacks."""
    found = F.nullif(F.regexp_extract(c, r"""https?://[^"<> ]+""", 0), F.lit(""))
    return F.coalesce(found, clean(c), *fallback)


def display_value(c: Column) -> Column:
    return F.coalesce(clean(c), F.lit("(blank)"))


def plain_text(html: Column) -> Column:
    """Text of a page: scripts, styles and tags out, entities resolved, a line per block."""
    out = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    out = F.regexp_replace(out, r"(?i)<br\s*/?>|</(p|div|li|tr|h[1-6])\s*>", "\n")
    out = F.regexp_replace(out, r"(?s)<[^>]*>", " ")
    for name, char in ENTITIES.items():
        out = F.replace(out, F.lit(name), F.lit(char))
    out = F.regexp_replace(out, r"[ \t\x0B\f\r]+", " ")
    return F.trim(F.regexp_replace(out, r" ?\n[ \n]*", "\n"))


def _formula(c: Column) -> Column:
    return c.rlike(FORMULA) & ~c.rlike(SIGNED_NUMBER)


def neutralize_csv_cell(c: Column) -> Column:
    """An apostrophe before text that a spreadsheet would run; signed numbers stay."""
    rest = F.ltrim(c, F.lit("'"))
    literal = c.startswith("'") & rest.rlike(SIGNED_NUMBER)
    return F.when(_formula(rest) | literal, F.concat(F.lit("'"), c)).otherwise(c)


def restore_csv_cell(c: Column) -> Column:
    """The inverse of neutralize_csv_cell."""
    rest = F.ltrim(c, F.lit("'"))
    ours = c.startswith("'") & (_formula(rest) | rest.rlike(SIGNED_NUMBER))
    return F.when(ours, F.substring(c, 2, 2**31 - 1)).otherwise(c)


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length, in 0 to 1; null if either is null."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, 1.0).otherwise(1 - F.levenshtein(a, b) / longer)


def header_name(name: str) -> str:
    """A column header in lower case with single blanks."""
    return " ".join(name.lower().split())


def parcel_folio(c: Column) -> Column:
    """Digits with a point before the last four."""
    digits = F.regexp_replace(c, r"\D", "")
    return F.nullif(F.regexp_replace(digits, r"^(\d+)(\d{4})$", "$1.$2"), F.lit(""))


def strip_prefix(c: Column, prefix: str) -> Column:
    """A path prefix taken out wherever it stands."""
    return F.replace(c, F.lit(prefix), F.lit(""))
