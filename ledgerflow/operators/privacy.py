"""Personal data and secrets: scans, redaction, attribute removal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.jsonmap import json_map, only_keys, without_keys
from ledgerflow.functions.text import neutralize_csv_cell, restore_csv_cell

#: What counts as personal data, in the order in which it is reported.
PII = (
    ("email address", r"(?i)\b[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\b"),
    ("phone number", r"(?<!\d)(?:\+?1[-. ]?)?(?:\(\d{3}\)|\d{3}[-. ])\d{3}[-. ]\d{4}(?!\d)"),
    ("Social Security number", r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)"),
)
#: Credentials in text and what stays of them: tokens as RFC 6750 spells them behind their scheme, values of
#: parameters of a query string that are keys to something, and values given to names of secrets.
B64TOKEN = r"[A-Za-z0-9\-._~+/]+=*"
KEY_PARAMETERS = ("access_token", "refresh_token", "id_token", "token", "signature", "sig", "api_key", "apikey", "client_secret")
SECRET_NAMES = ("passphrase", "password", "passwd", "pwd", "secret", "token", "api_key", "apikey")
SECRETS = (
    (rf"(?i)\b(bearer)[ \t]+{B64TOKEN}", "$1 [redacted]"),
    (rf"(?i)([?&;](?:{'|'.join(KEY_PARAMETERS)})=)[^&;#\s]+", "$1[redacted]"),
    (rf"(?i)\b({'|'.join(SECRET_NAMES)})(\s*[:=]\s*)[\"']?[^\s\"']+", "$1$2[redacted]"),
)
BLOCKED_NAMES = ("owner", "email", "phone", "contact", "ssn", "mailing")


def pii_label(*values: Column) -> Column:
    """The first kind of personal data found in any of the values, else null."""
    text = F.concat_ws(chr(31), *values)
    return F.coalesce(*[F.when(text.rlike(pattern), F.lit(label)) for label, pattern in PII])


def redact(text: Column) -> Column:
    for pattern, kept in SECRETS:
        text = F.regexp_replace(text, pattern, kept)
    return text


def redact_keys(m: Column, names: Sequence[str]) -> Column:
    """Values of a map replaced where the key holds one of the names."""
    hit = lambda k: F.lower(k).rlike("|".join(names))
    return F.transform_values(m, lambda k, v: F.when(hit(k), F.lit("[redacted]")).otherwise(v))


def scrubbed(df: DataFrame, attributes: str, blocked: Sequence[str]) -> DataFrame:
    """df with a map column without the blocked keys."""
    return df.withColumn(attributes, without_keys(F.col(attributes), list(blocked)))


def removal_counts(df: DataFrame, attributes: str, blocked: Sequence[str]) -> DataFrame:
    """How many values, not blank, each blocked key would lose."""
    entries = df.select(F.explode(only_keys(F.col(attributes), list(blocked))).alias("key", "value"))
    return entries.where("value is not null and trim(value) <> ''").groupBy(F.lower("key").alias("key")).agg(F.count("*").alias("removed"))


def leaks(df: DataFrame, stored: str, blocked: Sequence[str]) -> DataFrame:
    """Rows whose stored JSON still holds a blocked key."""
    names = F.array(*[F.lit(b.lower()) for b in blocked])
    return df.where(F.exists(F.map_keys(json_map(F.col(stored))), lambda k: F.array_contains(names, F.lower(k))))


def blocked_columns(df: DataFrame, tokens: Sequence[str] = BLOCKED_NAMES) -> list[str]:
    return [c for c in df.columns if any(t in c.lower() for t in tokens)]


def safe_csv(df: DataFrame) -> DataFrame:
    """All text columns made safe for spreadsheets."""
    return df.select(*[neutralize_csv_cell(F.col(f"`{n}`")).alias(n) if t == "string" else F.col(f"`{n}`") for n, t in df.dtypes])


def restored_csv(df: DataFrame) -> DataFrame:
    return df.select(*[restore_csv_cell(F.col(f"`{n}`")).alias(n) if t == "string" else F.col(f"`{n}`") for n, t in df.dtypes])
