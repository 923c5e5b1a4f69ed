"""Entity resolution: merges, components, crosswalks, integration, upserts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.ids import short_id
from ledgerflow.functions.matching import matching_ratio
from ledgerflow.operators.spread import frequent, spread_join
from ledgerflow.sources.workspace import cut


def merged_by(df: DataFrame, key: str, order: Column, columns: Sequence[str], largest: Sequence[str] = (), sets: Sequence[str] = ()) -> DataFrame:
    """One row per key: for each column the value, not null or blank, that stands highest in order.

    ``largest`` columns take their maximum, ``sets`` their distinct values, sorted and joined by ;.
    """

    def best(c: str) -> Column:
        filled = F.nullif(F.col(c).cast("string"), F.lit("")).isNotNull()
        return F.max_by(F.when(filled, F.col(c)), F.when(filled, order)).alias(c)

    return df.groupBy(key).agg(
        *[best(c) for c in columns],
        *[F.max(c).alias(c) for c in largest],
        *[F.array_join(F.array_sort(F.collect_set(c)), ";").alias(c) for c in sets],
        F.count("*").alias("component_count"),
    )


def last_nonblank(df: DataFrame, key: str, columns: Sequence[str], order: Sequence[str], seen: str) -> DataFrame:
    """Latest filled values by the order columns, with the first and last time seen."""
    out = merged_by(df, key, F.struct(*[F.col(c) for c in order]), columns)
    span = df.groupBy(key).agg(F.min(seen).alias("first_observed"), F.max(seen).alias("last_observed"))
    return out.join(span, key)


def preferred(df: DataFrame, module: str, number: Column, columns: Sequence[str], link: str, recency: str, key: str, first: str, last: str) -> DataFrame:
    """One record for each module and public number: the preferred one, its blanks filled from the others.

    Preferred is the record with a link, then that with more filled columns, then the later, then the larger key; blanks
    take the value of the earliest record that has one. The range of observation is widened to that of all. Records
    without module or number stay as they are. Blank means null or white space only.
    """
    filled = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit("")).isNotNull()
    count = sum((filled(c).cast("int") for c in columns), F.lit(0))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rank = F.struct(filled(link), count, text(recency), text(key))
    rows = df.withColumn("_module", F.when(filled(module), F.upper(F.trim(module)))).withColumn("_number", number)
    keyed = rows.where("_module is not null and _number is not null")
    own = lambda c: F.max_by(F.when(filled(c), F.col(c)), rank)
    other = lambda c: F.min_by(F.when(filled(c), F.col(c)), F.when(filled(c), F.struct(text(recency), text(key))))
    rest = [c for c in df.columns if c not in (key, first, last)]
    one = keyed.groupBy("_module", "_number").agg(
        F.max_by(key, rank).alias(key), F.min(first).alias(first), F.max(last).alias(last), F.count("*").alias("merged_records"),
        *[(F.coalesce(own(c), other(c)) if c in columns else F.max_by(c, rank)).alias(c) for c in rest],
    )
    alone = rows.where("_module is null or _number is null").withColumn("merged_records", F.lit(1).cast("long"))
    return one.select(*df.columns, "merged_records").unionByName(alone.select(*df.columns, "merged_records"))


def dedup_audit(df: DataFrame, key: Column, order: Sequence[Column]) -> DataFrame:
    """df with status: kept, duplicate, or missing_key (kept apart, never merged)."""
    out = df.withColumn("audit_key", key)
    status = F.when(F.col("audit_key").isNull(), "missing_key").when(F.col("position") == 1, "kept").otherwise("duplicate")
    # rows without a key must not gather in one group
    spread = F.coalesce(F.col("audit_key"), F.concat(F.lit("\0"), F.xxhash64(*df.columns).cast("string")))
    return out.withColumn("audit_group", spread).withColumn("position", F.row_number().over(Window.partitionBy("audit_group").orderBy(*order))).withColumn("status", status).drop("audit_group")


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component (the least node reachable) for every node of an edge; labels spread and jump until nothing changes.

    Neighbours of nodes with very many edges, and members of very large components, are dealt over several tasks.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    both = cut(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    labels = cut(both.groupBy(F.col("u").alias("v")).agg(F.least(F.col("u"), F.min("v")).alias("component")))
    hubs = frequent(both, "v")
    while True:
        near = spread_join(both, labels, ["v"], [F.col("u")], hot=hubs).groupBy(F.col("u").alias("v")).agg(F.min("component").alias("near"))
        step = cut(labels.join(near, "v").select("v", F.col("component").alias("old"), F.least("component", "near").alias("mid")))
        beyond = labels.select(F.col("v").alias("mid"), F.col("component").alias("far"))
        step = spread_join(step, beyond, ["mid"], [F.col("v")], hot=frequent(step, "mid"))
        step = cut(step.select("v", "old", F.least("mid", "far").alias("component")))
        labels = step.select("v", "component")
        if step.where("component <> old").isEmpty():
            return labels.select(F.col("v").alias("node"), "component")


def title_components(records: DataFrame, key: str, title: Column, source: str) -> DataFrame:
    """Records whose exact normalised titles occur in at least two sources, joined to components.

    Edges lead from each record to the least of its title, so a title of any size gives as many
    edges as it has records. Returns key, component and alias_id of the records in a component.
    """
    named = records.select(F.col(key).alias("k"), title.alias("t"), F.col(source).alias("s")).where("t is not null")
    groups = named.groupBy("t").agg(F.min("k").alias("least"), F.countDistinct("s").alias("sources")).where("sources >= 2")
    edges = named.join(groups, "t").select(F.col("k").alias("b"), F.col("least").alias("a"))
    return connected(edges).select(F.col("node").alias(key), "component", short_id("grp", F.col("component")).alias("alias_id"))


def renamed(rows: DataFrame, aliases: DataFrame, key: str) -> DataFrame:
    """rows of another table with the ids of components in place of those that aliases (key, alias_id) replace."""
    new = aliases.select(key, F.col("alias_id").alias("_alias"))
    return rows.join(new, key, "left").withColumn(key, F.coalesce("_alias", F.col(key).cast("string"))).drop("_alias").select(*rows.columns)


def redirected(incoming: DataFrame, known: DataFrame, key: str, number: Column) -> DataFrame:
    """incoming with the id that its public number is known under (known: number, key), else its own."""
    home = known.groupBy("number").agg(F.min(key).alias("_home")).where("number is not null")
    return incoming.withColumn("number", number).join(home, "number", "left").withColumn(key, F.coalesce("_home", F.col(key))).drop("_home", "number")


def crosswalk(left: DataFrame, right: DataFrame, days: int = 45, least_similarity: float = 0.84, likeness: Callable[[Column, Column], Column] = matching_ratio) -> DataFrame:
    """The best match of every left row, by number, parcel, address and date, or similar address and date.

    Both sides have id, number, parcel, address and day (normalised; null where unknown). Each rule is
    an equi-join of its own; similar addresses are compared within equal house numbers and spans of
    ``days`` days, of which neighbouring ones meet, by matching blocks (or another ``likeness`` from 0 to 1;
    ``functions.text.similarity`` is one of edit distances that needs no Python). The best score
    wins; several targets with the best score make an ambiguous candidate; rows without any match stay
    as unmatched.

    Rows that share what a rule compares are counted before they meet: a rule joins different numbers,
    parcels or addresses with days, however many rows have each. Only ids with several different rows are
    joined pair by pair, as their targets must be told apart.
    """
    columns = ("id", "number", "parcel", "address", "day")
    a = left.select(*[F.col(c).alias(f"l_{c}") for c in columns])
    b = right.select(*[F.col(c).alias(f"r_{c}") for c in columns]).distinct()
    once = lambda df, key: df.withColumn("_one", (F.count("*").over(Window.partitionBy(key)) == 1) & F.col(key).isNotNull())
    a_ids, b_ids = once(a.where("l_id is not null").distinct(), "l_id"), once(b, "r_id")
    a_one, a_more = a_ids.where("_one").drop("_one"), a_ids.where("not _one").drop("_one")
    b_one, b_more = b_ids.where("_one").drop("_one"), b_ids.where("not _one").drop("_one")
    found = _counted_matches(a_one, b_one, days, least_similarity, likeness)
    for x, y in ((a_one, b_more), (a_more, b)):
        if not (x if x is a_more else y).isEmpty():
            found = found.unionByName(_paired_matches(x, y, days, least_similarity, likeness))
    # a score belongs to one rule, so the targets of the best score are those of one rule
    found = found.groupBy("l_id", "score").agg(F.sum("targets").alias("targets"), F.min("r_id").alias("r_id"))
    top = found.groupBy("l_id").agg(F.max(F.struct("score", "targets", "r_id")).alias("m")).select("l_id", "m.*")
    out = a.select("l_id").join(top, "l_id", "left")
    many = F.col("targets") > 1
    method = F.lit("similar_address_candidate")
    for name, score in _EXACT.items():
        method = F.when(F.col("score") == score, name).otherwise(method)
    status = F.when(F.col("r_id").isNull(), "unmatched").when(many | (F.col("score") < 0.9), "candidate").otherwise("matched")
    return out.select(
        F.col("l_id").alias("id"),
        F.when(~many, F.col("r_id")).alias("target_id"),
        F.coalesce(F.col("targets"), F.lit(0).cast("long")).alias("targets"),
        F.when(F.col("r_id").isNull(), "none").when(many, F.concat(method, F.lit("_ambiguous"))).otherwise(method).alias("method"),
        F.round(F.coalesce("score", F.lit(0.0)), 3).alias("score"),
        status.alias("status"),
        (status == "candidate").alias("review_required"),
    )


#: The scores of the exact rules; similar addresses have at most 0.8.
_EXACT = {"exact_number": 1.0, "exact_parcel": 0.95, "exact_address_compatible_date": 0.9}


def _near_days(a: DataFrame, b: DataFrame, on: str, days: int) -> DataFrame:
    """Rows of a and b that agree in a key (named on in both) and whose days are close, each pair once."""
    span = lambda c: F.floor(F.datediff(F.col(c), F.to_date(F.lit("1970-01-01"))) / max(1, days)).cast("int")
    spans = a.where("l_day is not null").withColumn("span", F.explode(F.array(*[span("l_day") + k for k in (-1, 0, 1)])))
    return spans.join(b.withColumn("span", span("r_day")), [on, "span"]).where(F.abs(F.datediff("l_day", "r_day")) <= days).drop("span", on)


def _addresses_met(a: DataFrame, b: DataFrame, days: int, least_similarity: float, likeness: Callable[[Column, Column], Column]) -> DataFrame:
    """Rows of a and b with equal or similar addresses and close days, with the score; each different pair of addresses is compared once."""
    number = lambda c: F.nullif(F.regexp_extract(c, r"^(\d+) ", 1), F.lit(""))
    same = _near_days(a.withColumn("key", F.col("l_address")), b.withColumn("key", F.col("r_address")), "key", days)
    blocked = lambda df, c: df.withColumn("key", number(c)).where("key is not null")
    near = _near_days(blocked(a, "l_address"), blocked(b, "r_address"), "key", days).where(F.col("l_address") != F.col("r_address"))
    alike = near.select("l_address", "r_address").distinct().withColumn("likeness", likeness(F.col("l_address"), F.col("r_address")))
    scored = near.join(alike.where(F.col("likeness") >= least_similarity), ["l_address", "r_address"])
    scored = scored.withColumn("score", F.round(0.55 + 0.25 * F.col("likeness"), 3).cast("double")).drop("likeness")
    return same.withColumn("score", F.lit(_EXACT["exact_address_compatible_date"])).unionByName(scored)


def _counted_matches(a: DataFrame, b: DataFrame, *rule) -> DataFrame:  # noqa: ANN002
    """l_id, score, number of targets and the smallest one, where every id has one row."""
    targets = (F.count("*").alias("targets"), F.min("r_id").alias("r_id"))
    out = []
    for name, c in (("exact_number", "number"), ("exact_parcel", "parcel")):
        met = a.select("l_id", F.col(f"l_{c}").alias("key")).join(b.groupBy(F.col(f"r_{c}").alias("key")).agg(*targets), "key")
        out.append(met.select("l_id", F.lit(_EXACT[name]).alias("score"), "targets", "r_id"))
    places = a.select("l_address", "l_day").distinct()
    met = _addresses_met(places, b.groupBy("r_address", "r_day").agg(*targets), *rule)
    met = met.groupBy("l_address", "l_day", "score").agg(F.sum("targets").alias("targets"), F.min("r_id").alias("r_id"))
    best = met.groupBy("l_address", "l_day").agg(F.max(F.struct("score", "targets", "r_id")).alias("m"))
    out.append(a.select("l_id", "l_address", "l_day").join(best, ["l_address", "l_day"]).select("l_id", "m.*"))
    return out[0].unionByName(out[1]).unionByName(out[2])


def _paired_matches(a: DataFrame, b: DataFrame, *rule) -> DataFrame:  # noqa: ANN002
    """The same where ids have several rows: by pairs of ids."""
    pairs = _addresses_met(a, b, *rule).select("l_id", "r_id", "score")
    for name, c in (("exact_number", "number"), ("exact_parcel", "parcel")):
        pairs = pairs.unionByName(a.join(b, F.col(f"l_{c}") == F.col(f"r_{c}")).select("l_id", "r_id", F.lit(_EXACT[name]).alias("score")))
    best = pairs.groupBy("l_id", "r_id").agg(F.max("score").alias("score"))
    return best.groupBy("l_id", "score").agg(F.count("*").alias("targets"), F.min("r_id").alias("r_id"))


def integrate(core: DataFrame, links: DataFrame, incoming: DataFrame, key: str, fill: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(integrated core, audit of incoming).

    core has key and the fill columns, links has number and key, incoming has number and the fill
    columns (one row per number). One linked key: its blanks are filled, never overwritten. Several:
    held for review. None: appended under a deterministic id; if core has a row of that id already (it was
    appended before), that row is enriched instead.
    """
    targets = links.groupBy("number").agg(F.countDistinct(key).alias("targets"), F.min(key).alias("only"))
    own = short_id("new", F.col("number"))
    there = core.select(F.col(key).alias("_own"), F.lit(True).alias("_there"))
    met = incoming.withColumn("_own", own).join(targets, "number", "left").join(there, "_own", "left")
    again = F.col("targets").isNull() & F.col("_there").isNotNull()
    audit = met.withColumn("only", F.when(again, F.col("_own")).otherwise(F.col("only"))).withColumn(
        "outcome", F.when(again, "enriched_again").when(F.col("targets").isNull(), "appended").when(F.col("targets") == 1, "enriched").otherwise("held")
    )
    offered = audit.where("outcome in ('enriched', 'enriched_again')").groupBy(F.col("only").alias(key)).agg(
        *[F.min_by(F.nullif(F.col(c), F.lit("")), F.when(F.nullif(F.col(c), F.lit("")).isNotNull(), F.col("number"))).alias(f"new_{c}") for c in fill],
        F.count("*").alias("added"),
    )
    enriched = core.join(offered, key, "left").select(
        key,
        *[F.coalesce(F.nullif(F.col(c), F.lit("")), F.col(f"new_{c}")).alias(c) for c in fill],
        (1 + F.coalesce("added", F.lit(0))).cast("long").alias("component_count"),
        F.lit("core").alias("origin"),
    )
    new = audit.where("outcome = 'appended'").select(
        F.col("_own").alias(key), *fill, F.lit(1).cast("long").alias("component_count"), F.lit("appended").alias("origin")
    )
    return enriched.unionByName(new), audit.select("number", "outcome", F.coalesce("targets", F.lit(0).cast("long")).alias("targets"))


def candidate_pairs(records: DataFrame, key: str, reasons: dict[str, Column], most: int = 25) -> DataFrame:
    """Pairs that share a value of at least one reason, with the reasons joined by ;.

    A reason's value counts only between 2 and ``most`` records: values of larger groups say too
    little to propose a merge. Proposals only; nothing is merged.
    """
    items = F.array(*[F.struct(F.lit(n).alias("reason"), c.cast("string").alias("value")) for n, c in reasons.items()])
    long = records.select(F.col(key).alias("k"), F.explode(items).alias("i")).select("k", "i.reason", "i.value").where("value is not null and value <> ''")
    sizes = long.groupBy("reason", "value").agg(F.count("*").alias("n")).where(F.col("n").between(2, most)).drop("n")
    small = long.join(sizes, ["reason", "value"])
    x, y = small.withColumnRenamed("k", "a"), small.withColumnRenamed("k", "b")
    pairs = x.join(y, ["reason", "value"]).where("a < b")
    return pairs.groupBy("a", "b").agg(F.array_join(F.array_sort(F.collect_set("reason")), ";").alias("reasons")).withColumn("merge_applied", F.lit(False))


def reconcile(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Full outer join of two id lists per key: matched, left_only, right_only or ambiguous."""
    l = left.groupBy(on).agg(F.count("*").alias("left_rows"))  # noqa: E741
    r = right.groupBy(on).agg(F.count("*").alias("right_rows"))
    many = (F.col("left_rows") > 1) | (F.col("right_rows") > 1)
    status = (
        F.when(F.col("right_rows").isNull(), "left_only").when(F.col("left_rows").isNull(), "right_only").when(many, "ambiguous").otherwise("matched")
    )
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return l.join(r, on, "full_outer").select(on, zero("left_rows"), zero("right_rows"), status.alias("status"))


def upsert(existing: DataFrame, incoming: DataFrame, key: str, columns: Sequence[str], seen: str) -> DataFrame:
    """existing with incoming merged in: new values that are not blank win; the observed range widens. Applying it twice changes nothing.

    Both sides have key, the columns, and (existing) first_observed and last_observed or (incoming) seen.
    """
    new = merged_by(incoming, key, F.struct(F.col(seen)), columns).drop("component_count")
    span = incoming.groupBy(key).agg(F.min(seen).alias("n_first"), F.max(seen).alias("n_last"))
    new = new.select(key, *[F.col(c).alias(f"n_{c}") for c in columns]).join(span, key)
    return existing.join(new, key, "full_outer").select(
        key,
        *[F.coalesce(F.col(f"n_{c}"), F.col(c)).alias(c) for c in columns],
        F.least("first_observed", "n_first").alias("first_observed"),
        F.greatest("last_observed", "n_last").alias("last_observed"),
    )


def upsert_by_time(existing: DataFrame, incoming: DataFrame, key: str, columns: Sequence[str], seen: str) -> DataFrame:
    """As upsert, but of two filled values the one seen later wins, whichever side it comes from; of equal times, the greater value.

    existing and the result also have <column>_seen of each column: when its value was seen.
    """
    sides = [
        existing.select(key, *[F.col(x) for c in columns for x in (c, f"{c}_seen")], "first_observed", "last_observed"),
        incoming.select(key, *[x for c in columns for x in (F.col(c), F.col(seen).alias(f"{c}_seen"))], F.col(seen).alias("first_observed"), F.col(seen).alias("last_observed")),
    ]
    best = lambda c: F.max(F.when(F.nullif(F.col(c).cast("string"), F.lit("")).isNotNull(), F.struct(F.col(f"{c}_seen").alias("seen"), F.col(c).alias("value"))))
    out = sides[0].unionByName(sides[1]).groupBy(key).agg(*[best(c).alias(c) for c in columns], F.min("first_observed").alias("first_observed"), F.max("last_observed").alias("last_observed"))
    return out.select(key, *[x for c in columns for x in (F.col(f"{c}.value").alias(c), F.col(f"{c}.seen").alias(f"{c}_seen"))], "first_observed", "last_observed")


def carry_forward(reviews: DataFrame, current: DataFrame, key: str, context: Sequence[str], reviewed: Sequence[str]) -> DataFrame:
    """current with the reviewed columns of a former review, where the context has not changed.

    carried is carried, changed (the context differs; the review is left out) or new.
    """
    old = reviews.select(key, *[F.col(c).alias(f"o_{c}") for c in (*context, *reviewed)], F.lit(True).alias("was"))
    same = F.lit(True)
    for c in context:
        same = same & F.col(c).eqNullSafe(F.col(f"o_{c}"))
    state = F.when(F.col("was").isNull(), "new").when(same, "carried").otherwise("changed")
    out = current.join(old, key, "left").withColumn("carried", state)
    return out.select(*current.columns, *[F.when(F.col("carried") == "carried", F.col(f"o_{c}")).alias(c) for c in reviewed], "carried")


def key_multiplicity(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Keys that repeat, and which columns differ within them."""
    differs = [F.when(F.countDistinct(F.coalesce(F.col(c).cast("string"), F.lit("\0"))) > 1, F.lit(c)) for c in columns]
    return df.groupBy(key).agg(F.count("*").alias("rows"), F.array_join(F.array(*differs), ";").alias("differing")).where("rows > 1")
