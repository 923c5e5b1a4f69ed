"""JSON objects as maps of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.functions.text import clean

EMPTY = "map<string,string>"


def json_map(c: Column, strict: bool = False) -> Column:
    """A JSON object as a map of text values. Anything else is null if strict, else an empty map."""
    parsed = F.from_json(c, EMPTY)
    return parsed if strict else F.coalesce(parsed, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))


def lower_keys(m: Column) -> Column:
    """Keys in lower case; of keys that then clash the last one stands."""
    entries = F.map_entries(m)
    keys = F.transform(entries, lambda e: F.lower(e["key"]))
    last = F.filter(entries, lambda e, i: F.array_position(F.slice(keys, i + 2, F.size(keys)), F.lower(e["key"])) == 0)
    return F.map_from_entries(F.transform(last, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))


def lookup(lowered: Column, *names: str) -> Column:
    """The first value that is not blank, in a map with lower-case keys."""
    return F.coalesce(*[clean(F.element_at(lowered, F.lit(n.lower()))) for n in names])


def combined(lowered: Column, *names: str) -> Column:
    """Values that are not blank, joined by ' | '; null if there is none."""
    return F.nullif(F.concat_ws(" | ", *[lookup(lowered, n) for n in names]), F.lit(""))


def field_value(stored: Column, field: str) -> Column:
    """One field of a stored JSON object, by name in any case; the text itself if it is no object."""
    parsed = F.from_json(stored, EMPTY)
    return F.when(parsed.isNull(), stored).otherwise(lookup(lower_keys(parsed), field))


def without_keys(m: Column, blocked: list[str]) -> Column:
    names = F.array(*[F.lit(b.lower()) for b in blocked])
    return F.map_filter(m, lambda k, v: ~F.array_contains(names, F.lower(k)))


def only_keys(m: Column, allowed: list[str]) -> Column:
    names = F.array(*[F.lit(a.lower()) for a in allowed])
    return F.map_filter(m, lambda k, v: F.array_contains(names, F.lower(k)))


def changed_keys(old: Column, new: Column, volatile: list[str]) -> Column:
    """Sorted keys of either map whose cleaned values differ, without the volatile ones."""
    names = F.array(*[F.lit(v) for v in volatile]) if volatile else F.array().cast("array<string>")
    both = F.map_zip_with(old, new, lambda k, a, b: ~clean(a).eqNullSafe(clean(b)))
    return F.array_sort(F.map_keys(F.map_filter(both, lambda k, differs: differs & ~F.array_contains(names, F.lower(k)))))


def split_list(c: Column, by: str = ";") -> Column:
    """Sorted distinct entries of a list kept as text."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.coalesce(c, F.lit("")), by), lambda x: x != "")))
