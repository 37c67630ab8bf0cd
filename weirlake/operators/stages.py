"""The catalogue pipeline's stage selections: equi-joins on (registry, name) with residual predicates.

They are plain joins: Catalyst pushes their filters into the scans and AQE picks broadcast or shuffle
from what the tables measure at run time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirlake.functions.urls import is_landing

KEY = ["registry", "name"]


def _best(rows: DataFrame, order: tuple[str, ...], keep: tuple[str, ...], limit: int | None) -> DataFrame:
    """``rows`` in order (``-`` is descending; columns that there are none of are left out), ``keep`` of them, the first ``limit``.

    With a limit Spark keeps that many a task and never sorts them all.
    """
    there = [c for c in order if c.lstrip("-") in rows.columns]
    out = rows.orderBy(*(F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in there)).select(*(c for c in keep if c in rows.columns))
    return out if limit is None else out.limit(limit)


def eligible(status: Column, attempts: Column, retry_at: Column, now: Column, most: int = 5) -> Column:
    """Pending, or due for another try with attempts left; rows never tried have null status."""
    return (F.coalesce(status, F.lit("PENDING")).isin("PENDING", "RETRY")) & (F.coalesce(attempts, F.lit(0)) < most) & (retry_at.isNull() | (retry_at <= now))


def to_qualify(candidates: DataFrame, qualification: DataFrame, now: Column, least_priority: int = 0, limit: int | None = None) -> DataFrame:
    """Candidates without a finished qualification: by priority, then seen last, then by name."""
    q = qualification.select(*KEY, F.col("status").alias("q_status"), "attempts", "retry_at")
    both = candidates.filter((F.col("status") == "PENDING") & (F.col("priority") >= least_priority)).join(q, KEY, "left")
    due = both.filter(eligible(F.col("q_status"), F.col("attempts"), F.col("retry_at"), now))
    return _best(due, ("-priority", "-last_seen_at", "name", "registry"), (*KEY, "priority"), limit)


def to_authorise(qualification: DataFrame, candidates: DataFrame, authority: DataFrame, limit: int | None = None) -> DataFrame:
    """Qualified candidates whose authority is missing or older than their qualification: by score, importance, longest unchecked, name."""
    a = authority.select(*KEY, F.col("qualification_checked_at").alias("a_seen"))
    q = qualification.filter("qualification_status = 'READY_FOR_AUTHORITY'")
    q = q.select(*KEY, "score", "checked_at", *(c for c in ("importance",) if c in q.columns))
    live = candidates.filter("status <> 'DELETED'").select(*KEY)
    both = q.join(live, KEY).join(a, KEY, "left").filter(F.col("a_seen").isNull() | (F.col("a_seen") < F.col("checked_at")))
    return _best(both, ("-score", "-importance", "checked_at", "name", "registry"), (*KEY, "score"), limit)


def to_target(authority: DataFrame, qualification: DataFrame, targets: DataFrame, limit: int | None = None) -> DataFrame:
    """Verified packages without a target, or whose authority changed since: by score, importance, name."""
    t = targets.select(*KEY, F.col("authority_checked_at").alias("t_seen"))
    a = authority.filter("authority_status = 'AUTHORITY_VERIFIED'").select(*KEY, "checked_at")
    q = qualification.select(*KEY, "score", *(c for c in ("importance",) if c in qualification.columns))
    both = a.join(q, KEY).join(t, KEY, "left").filter(F.col("t_seen").isNull() | (F.col("t_seen") != F.col("checked_at")))
    return _best(both, ("-score", "-importance", "name", "registry"), (*KEY, "score"), limit)


def to_discover(targets: DataFrame, authority: DataFrame, discovery: DataFrame, now: Column, most: int = 5, limit: int | None = None) -> DataFrame:
    """Verified packages whose documentation has to be looked for, with what their authority says of it.

    A target is missing or only a registry's own page; and it was never looked for, was resolved anew since, or
    is due for another try with attempts left.
    """
    a = authority.filter("authority_status = 'AUTHORITY_VERIFIED'").select(*KEY, F.col("checked_at").alias("authority_checked_at"), F.col("documentation_url").alias("authority_documentation_url"))
    d = discovery.select(*KEY, F.col("target_resolved_at").alias("x_seen"), "discovery_status", "attempts", "next_retry_at", F.lit(True).alias("x_known"))
    wanted = F.col("target_status").isin("DOCS_DISCOVERY_REQUIRED", "DOCS_TARGET_MISSING") | F.coalesce(is_landing(F.col("target_url")), F.lit(False))
    again = F.col("discovery_status").isin("RETRY", "NO_MATCH") & (F.col("attempts") < most) & (F.col("next_retry_at").isNull() | (F.col("next_retry_at") <= now))
    due = F.col("x_known").isNull() | F.coalesce(F.col("resolved_at") > F.col("x_seen"), F.lit(False)) | F.coalesce(again, F.lit(False))
    both = targets.filter(wanted).join(a, KEY).join(d, KEY, "left").filter(due)
    out = both.select("language", *KEY, "target_url", "authority_documentation_url").orderBy("language", *KEY)
    return out if limit is None else out.limit(limit)


def to_fetch(targets: DataFrame, state: DataFrame, limit: int | None = None) -> DataFrame:
    """Targets never fetched, or whose url differs from the fetched one (those first), then by language, registry, name."""
    f = state.select(*KEY, F.col("target_url").alias("f_url"), F.col("status").alias("f_status"))
    both = targets.join(f, KEY, "left")
    moved = F.col("f_url").isNotNull() & (F.col("target_url") != F.col("f_url"))
    due = F.col("f_status").isNull() | moved | (F.col("f_status") != "SUCCESS")
    return _best(both.filter(due).withColumn("moved", moved), ("-moved", "language", *KEY), (*KEY, "target_url", "moved"), limit)


def stage_counts(table: DataFrame, by: str) -> DataFrame:
    return table.groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), by)


#: What counts a registry's backlog: name, table, column, and whether its values are those listed or any others.
BACKLOG = (
    ("pending", "candidates", "status", True, ("PENDING", "RETRY")), ("ready", "qualification", "qualification_status", True, ("READY_FOR_AUTHORITY",)),
    ("verified", "authority", "authority_status", True, ("AUTHORITY_VERIFIED",)), ("unverified", "authority", "authority_status", False, ("AUTHORITY_VERIFIED",)),
    ("docs_discovery_required", "targets", "target_status", True, ("DOCS_DISCOVERY_REQUIRED",)), ("docs_ready", "targets", "target_status", True, ("READY_FOR_DOCS_CONNECTOR",)),
    ("fetch_retry_or_partial", "state", "status", True, ("RETRY", "PARTIAL")),
)


def backlog(candidates: DataFrame, qualification: DataFrame, authority: DataFrame, targets: DataFrame | None = None, state: DataFrame | None = None) -> DataFrame:
    """Per registry with any work: the counts of ``BACKLOG``; those of a table that is not given are left out.

    Candidates that wait for another try are pending too.
    """
    tables = {"candidates": candidates, "qualification": qualification, "authority": authority, "targets": targets, "state": state}
    rules = [r for r in BACKLOG if tables[r[1]] is not None]
    names, parts = [r[0] for r in rules], None
    for table in dict.fromkeys(r[1] for r in rules):
        own = {n: F.count_if(F.col(c).isin(*v) if among else ~F.col(c).isin(*v)).alias(n) for n, t, c, among, v in rules if t == table}
        part = tables[table].groupBy("registry").agg(*own.values()).select("registry", *(F.col(n) if n in own else F.lit(0).cast("bigint").alias(n) for n in names))
        parts = part if parts is None else parts.unionByName(part)
    total = parts.groupBy("registry").agg(*(F.sum(c).alias(c) for c in names))
    return total.filter(F.greatest(*(F.col(c) for c in names)) > 0)
