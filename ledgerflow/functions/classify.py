"""Rules as ordered data, compiled to CASE expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.functions.text import clean

#: Words in a status and the stage, basis and confidence they stand for, in order.
STAGES = (
    (("complete", "closeout", "closed", "final inspection"), ("completed_or_closeout", "official_status", "medium")),
    (("construction", "inspection"), ("construction_or_inspection", "official_status", "medium")),
    (("issued", "approved"), ("permit_or_funding_approved", "authorization_only", "low")),
    (("cancel", "withdraw", "deny", "expire"), ("inactive", "official_status", "medium")),
)
PLANNING = ("planning_review", "application_only", "low")
OTHERWISE = ("preconstruction_or_unknown", "official_record_only", "low")
#: Words that tell the class of an activity.
DEMOLITION = r"\b(demo|demolition|demolish)\b"
NOT_DEMOLITION = r"\b(addition|remodel|renovation|alteration|repair|rebuild|new sfr|new construction|build[- ]?out)\b"
BUILDING = r"\b(new construction|new sfr|addition|foundation|rebuild|renovation|remodel|alteration|build[- ]?out)\b"


def _struct(values: Sequence[str], names: Sequence[str]) -> Column:
    return F.struct(*[F.lit(v).alias(n) for v, n in zip(values, names, strict=True)])


def first_match(rules: Sequence[tuple[Column, Column]], otherwise: Column) -> Column:
    """The result of the first rule whose condition holds."""
    out = otherwise
    for condition, result in reversed(rules):
        out = F.when(condition, result).otherwise(out)
    return out


def stage(status: Column, planning: Column) -> Column:
    """struct of stage, basis and confidence from the words of a status."""
    names = ("stage", "basis", "confidence")
    text = F.lower(F.coalesce(status, F.lit("")))
    rules = [(F.array_contains(F.transform(F.array(*[F.lit(w) for w in words]), lambda w: text.contains(w)), True), _struct(v, names)) for words, v in STAGES]
    rules.append((planning, _struct(PLANNING, names)))
    return first_match(rules, _struct(OTHERWISE, names))


def activity_class(title: Column, corpus: Column, size: Column) -> Column:
    head, words = F.lower(F.coalesce(title, F.lit(""))), F.lower(F.coalesce(corpus, F.lit("")))
    demolition = head.rlike(DEMOLITION) & ~head.rlike(NOT_DEMOLITION)
    building = (F.coalesce(size, F.lit(0.0)) > 0) | words.rlike(BUILDING)
    return F.when(demolition, "demolition").when(building, "building_construction").otherwise("other_permitted_work")


def value_change(old_raw: Column, new_raw: Column, old: Column, new: Column, less: str, more: str, same: str) -> Column:
    """How a value moved: added, removed, unparseable, or by comparison of the parsed values."""
    a, b = clean(old_raw), clean(new_raw)
    return (
        F.when(a.isNull() & b.isNotNull(), "value_added")
        .when(a.isNotNull() & b.isNull(), "value_removed")
        .when(old.isNull() | new.isNull(), "unparseable")
        .when(new > old, more)
        .when(new < old, less)
        .otherwise(same)
    )


def date_movement(old_raw: Column, new_raw: Column, old: Column, new: Column) -> Column:
    return value_change(old_raw, new_raw, old, new, "moved_earlier", "moved_later", "unchanged_after_normalization")


def cost_movement(old_raw: Column, new_raw: Column, old: Column, new: Column) -> Column:
    return value_change(old_raw, new_raw, old, new, "decrease", "increase", "formatting_only_or_equivalent")


def inspection_outcome(result: Column) -> Column:
    text = F.lower(result)
    return F.when(text.rlike("final") & text.rlike("pass|approv"), "final").when(text.rlike("pass|approv"), "passed").when(text.rlike("fail|reject|deni"), "failed")


def temporal_label(event: Column, boundary: Column) -> Column:
    """retrospective before the boundary, prospective from it on, unknown without a date."""
    return F.when(event.isNull(), "unknown").when(event < boundary, "retrospective").otherwise("prospective")


def evidence_grade(completed: Column, started: Column, issued: Column, applied: Column) -> Column:
    """struct of grade and basis from what is known of an activity, the strongest first."""
    names = ("grade", "basis")
    rules = [
        (completed, _struct(("A", "completion_reported"), names)),
        (started, _struct(("B", "work_reported"), names)),
        (issued, _struct(("C", "authorization_reported"), names)),
        (applied, _struct(("D", "application_reported"), names)),
    ]
    return first_match(rules, _struct(("U", "record_only"), names))
