"""Values that each source keeps under names of its own."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.functions.classify import first_match
from ledgerflow.functions.jsonmap import combined, lookup


def by_source(source: Column, values: Mapping[str, Column], otherwise: Column) -> Column:
    return first_match([(source == name, value) for name, value in values.items()], otherwise)


def native_id(source: Column, lowered: Column, fields: Mapping[str, str], otherwise: str) -> Column:
    """The native id from the field that a source keeps it in (lowered: a map with lower-case keys)."""
    return by_source(source, {name: lookup(lowered, field) for name, field in fields.items()}, lookup(lowered, otherwise))


def tracked_values(source: Column, lowered: Column, fields: Mapping[str, Mapping[str, Sequence[str]]]) -> Column:
    """struct of all tracked names: each from the fields its source has for it, joined by ' | '; null where it has none."""
    names = sorted({n for own in fields.values() for n in own})
    nothing = F.lit(None).cast("string")
    return F.struct(*[by_source(source, {s: combined(lowered, *own[n]) for s, own in fields.items() if n in own}, nothing).alias(n) for n in names])
