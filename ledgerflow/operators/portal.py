"""Records read from a portal and what belongs to them: details, inspections, and merges of many partitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.dates import parse_date
from ledgerflow.functions.ids import child_id
from ledgerflow.functions.numbers import money
from ledgerflow.functions.text import address_parts, clean, token
from ledgerflow.operators import quality

#: Labels under which a detail page may give a value; the first that is not blank counts.
DETAIL = {
    "record_number": ("record number",),
    "record_type": ("record type",),
    "record_status": ("record status", "status"),
    "category": ("record category", "category"),
    "filed_date": ("filed date", "application date"),
    "issued_date": ("issued date", "issue date"),
    "expiration_date": ("expiration date",),
    "completed_date": ("completed date", "completion date"),
    "valuation": ("job value", "valuation"),
    "description": ("project description",),
    "address": ("address",),
}
CHILD = {
    "source_id": ("inspection id", "id", "inspection number"),
    "kind": ("inspection type", "type"),
    "status": ("status", "inspection status"),
    "result": ("result", "result status"),
    "scheduled_date": ("scheduled date", "schedule date"),
    "completed_date": ("completed date", "completion date"),
    "result_date": ("result date", "date"),
    "inspector": ("inspector", "inspector name"),
}


def labelled(values: Column, names: Sequence[str]) -> Column:
    """The first value that is not blank among some labels of a map with lower-case keys."""
    return F.coalesce(*[clean(F.element_at(values, F.lit(n))) for n in names])


def _typed(name: str, value: Column) -> Column:
    if name.endswith("_date"):
        return F.date_format(parse_date(value), "yyyy-MM-dd")
    return money(value) if name == "valuation" else value


def enriched(records: DataFrame, details: DataFrame, key: str, values: str = "values", labels: Mapping[str, Sequence[str]] = DETAIL) -> DataFrame:
    """records with the labelled values of their details: a value that is there overrides, none erases.

    details: one row per key, values as a map with lower-case keys. The address also gives
    street_number, street_name and postal_code.
    """
    told = details.select(key, *[_typed(n, labelled(F.col(values), names)).alias(f"_{n}") for n, names in labels.items()])
    out = records.join(told, key, "left")
    for name in labels:
        old = F.col(name) if name in records.columns else F.lit(None).cast(told.schema[f"_{name}"].dataType)
        out = out.withColumn(name, F.coalesce(f"_{name}", old))
    if "address" in labels:
        parts = address_parts(F.col("address"))
        for name in ("street_number", "street_name", "postal_code"):
            old = F.col(name) if name in records.columns else F.lit(None).cast("string")
            out = out.withColumn(name, F.coalesce(parts[name], old))
    return out.drop(*[f"_{n}" for n in labels])


def children(rows: DataFrame, parent: str, values: str = "values", labels: Mapping[str, Sequence[str]] = CHILD) -> DataFrame:
    """Rows of a nested list in one schema, each named within its parent: by its own number, else by its type and dates.

    The values of a row are cleaned once, in a row of their own that no condition on the named columns is moved below:
    else each name cleaned them anew and the map was built for every one, in code too long to be compiled.
    """
    told = rows.select(parent, F.explode(F.array(F.transform_values(values, lambda _, v: clean(v)))).alias("_told"))
    given = lambda names: F.coalesce(*[F.element_at("_told", F.lit(n)) for n in names])
    named = told.select(parent, *[_typed(n, given(names)).alias(n) for n, names in labels.items()])
    own = child_id(F.col(parent), F.col("source_id"), F.col("kind"), F.col("scheduled_date"), F.col("completed_date"), F.col("result_date"))
    return named.withColumn("child_id", own)


def is_layout(source_id: str = "source_id", kind: str = "kind") -> Column:
    """Rows that hold neither a number nor a type come from a page's layout."""
    return F.col(source_id).isNull() & F.col(kind).isNull()


def upsert_children(stored: DataFrame, fresh: DataFrame, parents: DataFrame, parent: str, number: str, first: str, last: str) -> DataFrame:
    """Children by id, after moving those whose parent's public number is known to that parent's own id.

    parents: parent and number, one row per record. Fresh values that are not null override
    stored ones; first and last widen. Rows without a parent and rows from a page's layout go.
    """
    canonical = parents.select(F.col(parent).alias("_parent"), token(F.col(number)).alias("_number")).where("_number is not null")
    canonical = canonical.groupBy("_number").agg(F.min("_parent").alias("_parent"))
    every = stored.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)))
    moved = every.withColumn("_number", token(F.col(number))).join(canonical, "_number", "left").withColumn(parent, F.coalesce("_parent", F.col(parent)))
    own = child_id(F.col(parent), F.col("source_id"), F.col("kind"), F.col("scheduled_date"), F.col("completed_date"), F.col("result_date"))
    moved = moved.withColumn("child_id", own).where(F.col(parent).isNotNull() & ~is_layout())
    rest = [c for c in stored.columns if c not in ("child_id", parent, first, last)]
    newest = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_new"))).alias(c)
    return moved.groupBy(parent, "child_id").agg(*[newest(c) for c in rest], F.min(first).alias(first), F.max(last).alias(last))


def merged_partitions(parts: Sequence[DataFrame], key: str, order: str, first: str, last: str) -> DataFrame:
    """Many partitions of records as one table, each record once: later values that are not null win, first and last widen.

    Read a path once, however often it is listed: ``distinct_paths``.
    """
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    rest = [c for c in rows.columns if c not in (key, first, last)]
    newest = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(*[newest(c) for c in rest], F.min(first).alias(first), F.max(last).alias(last))


def distinct_paths(paths: Sequence[str]) -> list[str]:
    """Sorted, each once, whatever slashes they end in."""
    return sorted({p.rstrip("/") for p in paths})


def child_checks(rows: DataFrame, parents: DataFrame, parent: str, columns: Sequence[str], words: Sequence[str], label: str = "temporal_label") -> DataFrame:
    """Checks of a child table: columns in order, ids, parents, vocabulary, and no rows of layout; one pass over the rows."""
    spark = rows.sparkSession
    order = spark.createDataFrame([("columns_in_order", list(rows.columns) == list(columns), 0 if list(rows.columns) == list(columns) else 1)], "check string, passed boolean, faults long")
    filled = lambda c: F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))
    known = parents.select(F.col(parent).cast("string").alias("_known")).distinct()
    # rows without a parent are dealt by their own id, as one key for all of them would be one task's
    every = rows.join(known, F.coalesce(F.col(parent).cast("string"), F.col("child_id")) == F.col("_known"), "left")
    holds = {
        "parent_known": F.col(parent).isNull() | F.col("_known").isNotNull(),
        "parent_there": filled(parent),
        "labels": quality.words_hold(label, words),
        "no_layout_rows": ~is_layout(),
    }
    of_ids = every.groupBy("child_id").agg(F.count("*").alias("_n"), *[quality.fails(h).alias(name) for name, h in holds.items()])
    faults = of_ids.agg(F.count_if((F.col("_n") > 1) | ~filled("child_id")).alias("child_ids"), *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in holds])
    return order.unionByName(quality.listed(faults, ["child_ids", *holds]))


def attempted(rows: DataFrame, runs: DataFrame, parent: str, complete: str = "complete") -> DataFrame:
    """How far the collection of children has come: rows, parents with any, parents attempted, runs by completeness.

    runs: a row per run, with the ids it has attempted as an array.
    """
    tried = runs.select(F.explode("attempted").alias("p"))
    have = rows.agg(F.count("*").alias("rows"), F.countDistinct(parent).alias("parents_with_rows"))
    of_runs = runs.agg(F.count_if(F.col(complete)).alias("complete_runs"), F.count_if(~F.coalesce(F.col(complete), F.lit(False))).alias("incomplete_runs"))
    return have.join(F.broadcast(tried.agg(F.countDistinct("p").alias("parents_attempted")))).join(F.broadcast(of_runs))  # one row each
