"""Numbers and estimators as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.functions.text import clean

Z95 = 1.959963984540054
EARTH_M = 6371000.0


def number(c: Column) -> Column:
    """A number with thousands commas and currency signs allowed; null if it is none."""
    return F.regexp_replace(clean(c.cast("string")), "[,$]", "").try_cast("double")


def money(c: Column) -> Column:
    """decimal(18,2); parentheses make it negative; null if it is no amount."""
    text = clean(c.cast("string"))
    bare = F.regexp_replace(text, r"[()$,\s]", "").try_cast("decimal(18,2)")
    return F.when(text.rlike(r"^\(.*\)$"), -bare).otherwise(bare)


def rate(n: Column, d: Column) -> Column:
    """n / d to six places; null where d is 0."""
    return F.round(n / F.nullif(d.cast("double"), F.lit(0.0)), 6)


def percent(n: Column, d: Column) -> Column:
    return F.round(100 * n / F.nullif(d.cast("double"), F.lit(0.0)), 1)


def wilson(successes: Column, total: Column, z: float = Z95) -> Column:
    """struct of estimate, lower and upper of the Wilson score interval; null for no trials."""
    n = F.when(total > 0, total.cast("double"))
    p = successes / n
    scale = 1 + z * z / n
    center = (p + z * z / (2 * n)) / scale
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / scale
    bounds = F.struct(p.alias("estimate"), F.greatest(F.lit(0.0), center - half).alias("lower"), F.least(F.lit(1.0), center + half).alias("upper"))
    return F.when(total > 0, bounds)


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle distance in metres."""
    dp, dl = F.radians(lat2 - lat1) / 2, F.radians(lon2 - lon1) / 2
    a = F.pow(F.sin(dp), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dl), 2)
    return EARTH_M * 2 * F.atan2(F.sqrt(a), F.sqrt(F.greatest(F.lit(0.0), 1 - a)))
