"""Change capture and keyed state: gates, tombstones, keyset pages, folds and merges.

State tables are snapshots. A merge is an expression over a full outer join; the caller writes the
result as a new snapshot. Folding a batch at once equals folding its events one by one.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def changed(current: DataFrame, committed: DataFrame, keys: list[str], signature: str = "signature") -> DataFrame:
    """Rows of ``current`` that are new or whose signature differs from the committed one."""
    old = committed.select(*keys, F.col(signature).alias("_old"))
    return current.join(old, keys, "left").filter(~F.col(signature).eqNullSafe(F.col("_old"))).drop("_old")


def two_level(sources: DataFrame, items: DataFrame, committed_sources: DataFrame, committed_items: DataFrame) -> DataFrame:
    """Changed items of changed sources only; a source whose own signature stands is not looked into."""
    due = changed(sources, committed_sources, ["source_id"]).select("source_id")
    return changed(items.join(due, "source_id", "left_semi"), committed_items, ["source_id", "item_id"])


def certified_sources(results: DataFrame) -> DataFrame:
    """Sources of (source_id, item_id, ok) without a failure: only their signature may be committed."""
    return results.groupBy("source_id").agg(F.bool_and("ok").alias("ok")).filter("ok").select("source_id")


def tombstones(known: DataFrame, current: DataFrame, keys: list[str], complete: bool = True) -> DataFrame:
    """Known keys that are gone; none unless discovery was complete."""
    gone = known.join(current.select(*keys), keys, "left_anti")
    return gone if complete else gone.limit(0)


def known_after(known: DataFrame, current: DataFrame, keys: list[str], complete: bool = True) -> DataFrame:
    """The keys to hold from now on: what is current, and the old ones too if discovery was cut short."""
    return current.select(*keys).distinct() if complete else current.select(*keys).union(known.select(*keys)).distinct()


def reappeared(state: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """``state`` in which removed keys that are seen again lose their committed signature."""
    seen = current.select(*keys).distinct().withColumn("_seen", F.lit(True))
    back = F.col("removed") & F.coalesce("_seen", F.lit(False))
    return state.join(seen, keys, "left").withColumn("signature", F.when(~back, F.col("signature"))).withColumn("removed", F.col("removed") & ~back).drop("_seen")


def is_ghost(full: Column, lines: Column, attachments: Column) -> Column:
    """Advertised, but every way to its body answers 404."""
    return (full == 404) & (lines == 404) & (attachments == 404)


def keyset_page(rows: DataFrame, key: list[str], after: tuple | None, until=None, lower=None, limit: int | None = None) -> DataFrame:
    """Rows after a composite key, in key order, above ``lower`` and up to ``until`` on the key's first column."""
    out = rows
    if lower is not None:
        out = out.filter(F.col(key[0]) > F.lit(lower))
    if until is not None:
        out = out.filter(F.col(key[0]) <= F.lit(until))
    if after is not None:
        beyond, equal = F.lit(False), F.lit(True)
        for c, v in zip(key, after, strict=True):
            beyond, equal = beyond | (equal & (F.col(c) > F.lit(v))), equal & (F.col(c) == F.lit(v))
        # The first column alone bounds the scan; it reaches the file reader as a pushed filter.
        out = out.filter(F.col(key[0]) >= F.lit(after[0])).filter(beyond)
    out = out.orderBy(*key)
    return out if limit is None else out.limit(limit)


def missing_increments(available: DataFrame, last: int, head: int) -> DataFrame:
    """Numbers after ``last`` up to ``head`` that the feed no longer offers; any means starting over."""
    spark = available.sparkSession
    return spark.range(last + 1, head + 1).select(F.col("id").alias("number")).join(available.select("number"), "number", "left_anti")


def last_writer(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key with the greatest order; no window, so a hot key combines map-side."""
    rest = [c for c in rows.columns if c not in keys]
    packed = F.struct(*order, *(c for c in rest if c not in order))
    best = rows.groupBy(*keys).agg(F.max(packed).alias("b")) if _orderable(rows, rest) else rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("b"))
    return best.select(*keys, *(F.col(f"b.{c}").alias(c) for c in rest))


def _orderable(rows: DataFrame, cols: list[str]) -> bool:
    return not any(t.startswith(("map", "variant")) for c, t in rows.dtypes if c in cols)


def first_seen(stored: DataFrame, incoming: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Insert or ignore: stored rows as they are, and for new keys the first incoming row."""
    rest = [c for c in incoming.columns if c not in keys]
    fresh = incoming.join(stored.select(*keys), keys, "left_anti").groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("b"))
    return stored.select(*keys, *rest).unionByName(fresh.select(*keys, *(F.col(f"b.{c}").alias(c) for c in rest)))


def fold_events(state: DataFrame, events: DataFrame, now: str, priority: int = 60) -> DataFrame:
    """The queue after an ordered batch of (registry, name, deleted, ord, source).

    The last event of a name decides its status; priority never falls and a deletion does not reset
    it; the first sighting stays. Names that are blank are left out.
    """
    e = events.withColumn("name", F.trim("name")).filter("name <> ''")
    last = e.groupBy("registry", "name").agg(
        F.max_by("deleted", "ord").alias("deleted"), F.max_by("source", "ord").alias("new_source"), F.bool_or(~F.col("deleted")).alias("upserted")
    )
    both = state.join(last, ["registry", "name"], "full_outer")
    hit = F.col("deleted").isNotNull()
    raised = F.when(F.col("upserted"), F.greatest(F.coalesce("priority", F.lit(0)), F.lit(priority))).otherwise(F.coalesce("priority", F.lit(0)))
    return both.select(
        "registry", "name", F.when(hit, F.col("new_source")).otherwise(F.col("source")).alias("source"), F.when(hit, raised).otherwise(F.col("priority")).alias("priority"),
        F.when(hit, F.when(F.col("deleted"), "DELETED").otherwise("PENDING")).otherwise(F.col("status")).alias("status"),
        F.coalesce("first_seen_at", F.lit(now)).alias("first_seen_at"), F.when(hit, F.lit(now)).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
    )


def upsert(state: DataFrame, incoming: DataFrame, keys: list[str], policy: dict[str, str]) -> DataFrame:
    """Merge one incoming row a key by column: overwrite, coalesce (null keeps the old), keep (old wins), max, or nonempty ('' keeps the old)."""
    cols = [c for c in state.columns if c not in keys]
    new = incoming.select(*keys, *(F.col(c).alias(f"_n_{c}") for c in cols if c in incoming.columns), F.lit(True).alias("_hit"))
    both = state.join(new, keys, "full_outer")
    out = []
    for c in cols:
        if f"_n_{c}" not in both.columns:
            out.append(F.col(c))
            continue
        old, fresh = F.col(c), F.col(f"_n_{c}")
        rule = policy.get(c, "overwrite")
        merged = {
            "overwrite": F.when(F.col("_hit"), fresh).otherwise(old), "coalesce": F.coalesce(fresh, old), "keep": F.coalesce(old, fresh),
            "max": F.greatest(old, fresh), "nonempty": F.coalesce(F.when(fresh.cast("string") != "", fresh), old),
        }[rule]
        out.append(merged.alias(c))
    return both.select(*keys, *out)


def merge_by_key(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Replace rows by key: old rows whose key is not in ``new``, and all of ``new``."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def liveness(events: DataFrame) -> DataFrame:
    """(package, version, live) after (package, version, hash, ord, kind) events: an artifact counts if its last event is ADD."""
    final = events.groupBy("package", "version", "hash").agg(F.max_by("kind", "ord").alias("kind"))
    return final.groupBy("package", "version").agg(F.count_if(F.col("kind") == "ADD").alias("live"))


def package_alive(versions: DataFrame) -> DataFrame:
    """(package, alive): whether any version is live."""
    return versions.groupBy("package").agg((F.max("live") > 0).alias("alive"))


def diff_events(diff: DataFrame) -> DataFrame:
    """(ord, name, deleted) from (ord, status, old_name, new_name): renames delete and add, copies add."""
    kind = F.left("status", F.lit(1))
    event = lambda n, d: F.struct(n.alias("name"), F.lit(d).alias("deleted"))
    moved = (kind == "R") & (F.col("old_name") != F.coalesce("new_name", F.lit("")))
    both = F.array_compact(F.array(
        F.when(moved | (kind == "D"), event(F.col("old_name"), True)), F.when(kind.isin("R", "C"), event(F.col("new_name"), False)), F.when(kind.isin("A", "M", "T"), event(F.col("old_name"), False)),
    ))
    return diff.select("ord", F.posexplode(both).alias("pos", "e")).filter("e.name is not null").select("ord", "pos", "e.name", "e.deleted")


def transfer_plan(items: DataFrame, per_item: int, budget: int, by: str | None = None) -> DataFrame:
    """(…, item_id, decision): items in order of ``ord`` are taken while they fit what is left of the budget.

    Too large ones are skipped and ones that do not fit now are deferred, but later, smaller items may
    still fit, so this is a fold over a run's catalogue and not a running sum. Unknown sizes are taken
    at no cost. ``by`` (text) separates runs; each decision depends on all before it, so a run folds in one task.
    """
    key = F.lit("") if by is None else F.col(by).cast("string")
    rows = items.select(key.alias("run"), "ord", F.col("item_id").cast("string").alias("item_id"), F.col("size").cast("long").alias("size"))

    def fold(table):
        t, left, decisions = table.sort_by([("ord", "ascending"), ("item_id", "ascending")]), budget, []
        for size in t["size"].to_pylist():
            if size is not None and size > per_item:
                decisions.append("SKIPPED_OVERSIZE")
            elif size is not None and size > left:
                decisions.append("DEFERRED_BUDGET")
            else:
                left -= max(0, size or 0)
                decisions.append("TAKEN")
        return t.select(["run", "item_id"]).append_column("decision", pa.array(decisions, pa.string()))

    out = rows.groupBy("run").applyInArrow(fold, "run string, item_id string, decision string")
    return out.drop("run") if by is None else out.withColumnRenamed("run", by)


def fair_selection(candidates: DataFrame, group: str, order: list, limit: int, rotation: list[str] | None = None) -> DataFrame:
    """``limit`` rows in rounds: the first of every group, then the second, and so on.

    Groups take turns in ``rotation``, else by name. Only the first ``limit`` rows of a group can be
    chosen, so ranks beyond that are dropped where they arise.
    """
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    ranked = candidates.withColumn("_rank", rank).filter(F.col("_rank") <= limit)
    turn = F.col(group) if not rotation else F.array_position(F.array(*map(F.lit, rotation)), F.col(group))
    return ranked.orderBy("_rank", turn).limit(limit).drop("_rank")


def two_lanes(candidates: DataFrame, keys: list[str], group: str, order: list, limit: int, fast: Column) -> DataFrame:
    """A third of the limit goes to the first ``fast`` rows in order, the rest in fair rounds."""
    first = candidates.filter(fast).orderBy(*order).limit(max(1, min(limit, limit // 3 or 1))).withColumn("lane", F.lit("fast"))
    rest = candidates.join(first.select(*keys), keys, "left_anti")
    both = first.unionByName(fair_selection(rest, group, order, limit).withColumn("lane", F.lit("fair")))
    return both.orderBy(F.col("lane") == "fair", group).limit(limit)
