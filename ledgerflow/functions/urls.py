"""Addresses of pages as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def valid_url(url: Column) -> Column:
    scheme = F.lower(F.try_parse_url(url, F.lit("PROTOCOL")))
    return F.coalesce(scheme.isin("http", "https") & (F.length(host(url)) > 0), F.lit(False))


def on_host(name: Column, allowed: str) -> Column:
    """Is it the allowed host or one below it?"""
    return (name == allowed) | name.endswith(f".{allowed}")


def source_tier(url: Column, tiers: dict[str, int]) -> Column:
    """struct of tier (null if refused) and reason. Only https, port 443 and hosts of the list pass."""
    name = host(url)
    authority = F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit(""))
    tier = F.lit(None).cast("int")
    for allowed, level in tiers.items():
        tier = F.when(on_host(name, allowed), F.lit(level)).otherwise(tier)
    reason = (
        F.when(~valid_url(url), "invalid_url")
        .when(F.lower(F.try_parse_url(url, F.lit("PROTOCOL"))) != "https", "not_https")
        .when(authority.contains("@"), "user_info")
        .when(authority.rlike(r":\d+$") & ~authority.endswith(":443"), "port")
        .when(tier.isNull(), "host_not_listed")
        .otherwise("allowed")
    )
    return F.struct(F.when(reason == "allowed", tier).alias("tier"), reason.alias("reason"))


def query_value(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name))
