"""Typed changes between observations.

Both sides of a comparison are brought together by one aggregation per record, with map-side
combination, on the partitioning that the identity step has left; changes are then derived
row by row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.ids import short_id
from ledgerflow.functions.jsonmap import split_list
from ledgerflow.functions.text import display_value

#: A word of caution that goes with each type of change.
NOTES = {
    "new_record": "This observation holds the record and the one before does not. When it came into being is not known.",
    "record_disappeared": "This observation lacks the record. Whether it was removed, renamed or finished is open.",
    "estimated_cost_changed": "A forecast was revised; no payment follows from that.",
    "reported_actual_cost_changed": "The source now states another amount as paid; nobody has checked it here.",
    "planned_date_changed": "The schedule moved. It says nothing about what happens on site.",
    "other_field_changed": "Attributes that are not tracked by name differ.",
}
NOTE_OTHERWISE = "Both values are what the source published when it was read."
#: Attributes that change with every publication.
VOLATILE = ("objectid", "globalid", "lastupdate", "last_edited_date", "editdate", "created_date")


@dataclass(frozen=True)
class Tracked:
    """A change type and the columns it reports together."""

    change_type: str
    fields: tuple[str, ...]


TRACKED = (
    Tracked("status_changed", ("status",)),
    Tracked("description_changed", ("description",)),
    Tracked("project_name_changed", ("project_name",)),
    Tracked("record_type_changed", ("record_type",)),
    Tracked("estimated_cost_changed", ("estimated_cost",)),
    Tracked("reported_actual_cost_changed", ("actual_cost",)),
    Tracked("planned_date_changed", ("planned_start", "planned_end")),
    Tracked("capital_project_phase_changed", ("capital_phase",)),
)


def paired(identified: DataFrame, pairs: Sequence[tuple[str, str]], values: Sequence[str], date: str = "snapshot_date") -> DataFrame:
    """One row per pair of dates and record: before and after as structs of values, null where absent."""
    roles = []
    for before, after in pairs:
        if not before < after:
            raise ValueError(f"{before} is not before {after}")
        for name, day in (("old", before), ("new", after)):
            roles.append(F.when(F.col(date).cast("string") == day, F.struct(F.lit(before).alias("before_date"), F.lit(after).alias("after_date"), F.lit(name).alias("role"))))
    rows = identified.withColumn("r", F.explode(F.array_compact(F.array(*roles))))
    kept = F.struct(*[F.col(v) for v in values])
    side = lambda role: F.first(F.when(F.col("r.role") == role, kept), ignorenulls=True)
    return rows.groupBy("base_identity", "record_identity", F.col("r.before_date").alias("before_date"), F.col("r.after_date").alias("after_date")).agg(
        side("old").alias("old"), side("new").alias("new")
    )


def _json(side: str, fields: Column) -> Column:
    return F.to_json(F.map_from_entries(F.transform(fields, lambda f: F.struct(f["name"].alias("key"), F.coalesce(f[side], F.lit("")).alias("value")))))


def changes(
    both: DataFrame,
    tracked: Sequence[Tracked] = TRACKED,
    residual: Sequence[str] = (),
    semantic: dict[str, Column] | None = None,
) -> DataFrame:
    """Change rows of paired records.

    Each tracked type gives a row with those of its fields that differ (null equals blank);
    residual fields that differ give one row of type other_field_changed. ``semantic`` labels
    rows of a type; its columns may use old and new.
    """
    present = set(both.schema["new"].dataType.names)
    labels = semantic or {}

    def differing(fields: Sequence[str]) -> Column:
        items = [F.struct(F.lit(f).alias("name"), F.col(f"old.{f}").cast("string").alias("old"), F.col(f"new.{f}").cast("string").alias("new")) for f in fields if f in present]
        return F.filter(F.array(*items), lambda x: ~F.nullif(x["old"], F.lit("")).eqNullSafe(F.nullif(x["new"], F.lit(""))))

    nothing = F.array().cast("array<struct<name:string,old:string,new:string>>")
    of = lambda kind, fields: F.struct(F.lit(kind).alias("change_type"), labels.get(kind, F.lit("")).alias("semantic_type"), fields.alias("fields"))
    kept = [t for t in tracked if any(f in present for f in t.fields)]
    updates = [of(t.change_type, differing(t.fields)) for t in kept]
    if residual:
        updates.append(of("other_field_changed", differing(residual)))
    events = (
        F.when(F.col("old").isNull(), F.array(of("new_record", nothing)))
        .when(F.col("new").isNull(), F.array(of("record_disappeared", nothing)))
        .otherwise(F.filter(F.array(*updates), lambda e: F.size(e["fields"]) > 0))
    )
    out = both.withColumn("e", F.explode(events)).withColumn("row", F.coalesce("new", "old"))
    names = F.array_join(F.transform("e.fields", lambda f: f["name"]), ";")
    note = F.lit(NOTE_OTHERWISE)
    for kind, text in NOTES.items():
        note = F.when(F.col("e.change_type") == kind, text).otherwise(note)
    return out.select(
        short_id("chg", F.col("before_date"), F.col("after_date"), F.col("e.change_type"), F.col("e.semantic_type"), F.col("record_identity"), names).alias("change_id"),
        F.substring("after_date", 1, 7).alias("comparison_month"),
        F.col("before_date").alias("before_snapshot_date"),
        F.col("after_date").alias("after_snapshot_date"),
        F.col("e.change_type").alias("change_type"),
        F.col("e.semantic_type").alias("semantic_type"),
        F.col("row.source_name").alias("source_name"),
        "record_identity",
        F.col("row.native_id").alias("source_record_id"),
        names.alias("changed_fields"),
        F.when(F.size("e.fields") > 0, _json("old", F.col("e.fields"))).otherwise("").alias("old_value"),
        F.when(F.size("e.fields") > 0, _json("new", F.col("e.fields"))).otherwise("").alias("new_value"),
        note.alias("interpretation_note"),
    )


def changed_fields(both: DataFrame, tracked: Sequence[Tracked] = TRACKED) -> Column:
    """change_type, name, old and new of every tracked field that differs, as an array; empty unless both sides are there."""
    present = set(both.schema["new"].dataType.names)
    value = lambda side, f: F.coalesce(F.col(f"{side}.{f}").cast("string"), F.lit(""))
    items = [
        F.struct(F.lit(t.change_type).alias("change_type"), F.lit(f).alias("name"), value("old", f).alias("old"), value("new", f).alias("new"))
        for t in tracked
        for f in t.fields
        if f in present
    ]
    differ = F.filter(F.array(*items), lambda x: x["old"] != x["new"])
    return F.when(F.col("old").isNotNull() & F.col("new").isNotNull(), differ).otherwise(F.filter(F.array(*items), lambda x: F.lit(False)))


def field_rows(both: DataFrame, tracked: Sequence[Tracked] = TRACKED) -> DataFrame:
    """One row per record and field that differs, with old_raw and new_raw, straight from paired records."""
    rows = both.withColumn("f", F.explode(changed_fields(both, tracked)))
    return rows.select(
        "before_date", "after_date", "f.change_type", F.col("new.source_name").alias("source_name"), "record_identity",
        F.col("f.name").alias("field"), F.col("f.old").alias("old_raw"), F.col("f.new").alias("new_raw"),
    )


def summary(change_rows: DataFrame) -> DataFrame:
    """Rows and distinct records per pair, source, type and semantic type."""
    return change_rows.groupBy("before_snapshot_date", "after_snapshot_date", "source_name", "change_type", "semantic_type").agg(
        F.count("*").alias("change_rows"), F.countDistinct("record_identity").alias("records")
    )


def drilldown(change_rows: DataFrame) -> DataFrame:
    """One row per change and field with the old and new display values."""
    fields = split_list(F.col("changed_fields"))
    out = change_rows.withColumn("field", F.explode_outer(fields))
    parsed = lambda c: F.element_at(F.from_json(c, "map<string,string>"), F.col("field"))
    return out.select(
        "change_id", "change_type", "source_name", "record_identity", "field",
        F.when(F.col("field").isNotNull(), display_value(parsed("old_value"))).alias("old_display"),
        F.when(F.col("field").isNotNull(), display_value(parsed("new_value"))).alias("new_display"),
    )
