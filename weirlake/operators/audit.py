"""Audits: group counts, coverage, quality, gates and certification, over state tables.

All of them are aggregations that combine before they shuffle; status tables are small next to the
lake but nothing here relies on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirlake.functions.scoring import COVERAGE_WEIGHTS, PRIORITY_WEIGHTS, SEVERITY_RANK, case_map, issue_severity


def dimension_counts(rows: DataFrame, dimensions: list[str], sums: list[str] = ()) -> DataFrame:
    """(dimension, value, n, and each sum): independent group counts of several columns in one pass.

    Null or empty values count as UNKNOWN. The grand total has dimension ``all`` and value ``all``.
    """
    named = [F.when(F.coalesce(F.col(d).cast("string"), F.lit("")) == "", "UNKNOWN").otherwise(F.col(d).cast("string")).alias(d) for d in dimensions]
    base = rows.select(*named, *(F.coalesce(F.col(s), F.lit(0)).alias(s) for s in sums))
    sets = [[F.col(d)] for d in dimensions] + [[]]
    grouped = base.groupingSets(sets, *(F.col(d) for d in dimensions)).agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"), *(F.sum(s).alias(s) for s in sums)
    )
    top = 1 << len(dimensions)
    which = F.lit("all")
    value = F.lit("all")
    for i, d in enumerate(dimensions):
        own = top - 1 - (top >> (i + 1))
        which = F.when(F.col("gid") == own, d).otherwise(which)
        value = F.when(F.col("gid") == own, F.col(d)).otherwise(value)
    return grouped.select(which.alias("dimension"), value.alias("value"), "n", *sums)


def upstream_audit(artifacts: DataFrame, most_errors: int = 50) -> DataFrame:
    """Per source: artifacts, counts a result and a method, bytes of what was last downloaded, latest times, errors.

    ``errors`` counts all of a source's errors, ``first_errors`` holds the first ``most_errors`` by artifact as
    (artifact_id, error, http_status). Artifacts without a method count in no method.
    """
    filled = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    # A count for each pair of result and method is what both maps are folded from.
    per = artifacts.groupBy("source_id", F.when(filled("last_result"), F.col("last_result")).otherwise("UNKNOWN").alias("last_result"), F.when(filled("method"), F.col("method")).alias("method")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("size_bytes", F.lit(0))).alias("bytes"),
        F.max("last_checked").alias("last_checked"), F.max("last_downloaded").alias("last_downloaded"),
    )
    counts = lambda k: F.map_from_entries(F.array_sort(F.collect_list(F.struct(k, "n")))).alias(f"{k}s")
    maps = [per.filter(F.col(k).isNotNull()).groupBy("source_id", k).agg(F.sum("n").alias("n")).groupBy("source_id").agg(counts(k)) for k in ("last_result", "method")]
    folded = per.groupBy("source_id").agg(
        F.sum("n").alias("artifacts"), F.sum(F.when(F.col("last_result") == "DOWNLOADED", F.col("bytes")).otherwise(0)).alias("last_downloaded_bytes"),
        F.max("last_checked").alias("last_checked"), F.max("last_downloaded").alias("last_downloaded"),
    )
    failed = artifacts.filter(filled("error"))
    errors = failed.groupBy("source_id").agg(F.count(F.lit(1)).alias("errors"))
    # A source may have any number of failed artifacts; the limit of the rank is pushed below the shuffle.
    rank = F.row_number().over(Window.partitionBy("source_id").orderBy("artifact_id"))
    first = failed.select("source_id", "artifact_id", "error", "http_status", rank.alias("k")).filter(F.col("k") <= most_errors)
    first = first.groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct("k", "artifact_id", "error", "http_status"))).alias("e"))
    first = first.select("source_id", F.transform("e", lambda x: F.struct(*(x[c].alias(c) for c in ("artifact_id", "error", "http_status")))).alias("first_errors"))
    out = folded
    for more in (*maps, errors, first):
        # Sources are compared null-safely: artifacts of no source have a row too.
        out = out.join(more.withColumnRenamed("source_id", "_s"), F.col("source_id").eqNullSafe(F.col("_s")), "left").drop("_s")
    none = F.from_json(F.lit("{}"), "map<string,bigint>")
    return out.fillna(0, ["errors"]).withColumns({"methods": F.coalesce("methods", none), "first_errors": F.coalesce("first_errors", F.from_json(F.lit("[]"), first.schema["first_errors"].dataType))})


def upstream_totals(audit: DataFrame) -> DataFrame:
    """One row over the rows of ``upstream_audit``: sources, artifacts, errors and a count a result."""
    results = audit.select(F.explode("last_results").alias("last_result", "n")).groupBy("last_result").agg(F.sum("n").alias("n"))
    every = results.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("last_result", "n")))).alias("last_results"))
    sums = audit.agg(F.count(F.lit(1)).alias("sources"), F.coalesce(F.sum("artifacts"), F.lit(0)).alias("artifacts"), F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"))
    return sums.crossJoin(every)


def coverage_status(policy: Column, declared: Column, registered: Column, enabled_public: Column, controlled: Column, disabled: Column, usable: Column, minimum: Column) -> Column:
    """The status of a coverage item from how many of its sources are in which state."""
    missing, empty = declared - registered, enabled_public - usable
    return (
        F.when(policy.isin("CONTROLLED", "UNAVAILABLE"), policy).when((missing > 0) & (registered == 0), "MISSING")
        .when((disabled > 0) & (enabled_public == 0) & (controlled == 0), "UNRESOLVED").when((controlled > 0) & (enabled_public == 0), "CONTROLLED")
        .when((usable >= minimum) & (missing == 0) & (empty == 0), "COVERED").when((usable > 0) | (enabled_public > 0) | (registered > 0), "PARTIAL")
        .otherwise("MISSING")
    )


def weighted_coverage(items: DataFrame, sources: DataFrame) -> DataFrame:
    """Per item: priority, status, counts and weights.

    ``items`` is (item_id, priority, policy_status, minimum_usable, source_ids array), ``sources``
    (source_id, enabled, public, delivery_status).
    """
    wide = items.select("item_id", F.upper(F.coalesce("priority", F.lit("P1"))).alias("priority"), F.upper(F.coalesce("policy_status", F.lit(""))).alias("policy_status"), F.greatest(F.lit(1), F.coalesce("minimum_usable", F.lit(1))).alias("minimum"), F.explode_outer("source_ids").alias("source_id"))
    own = sources.select("source_id", "enabled", "public", "delivery_status", F.lit(True).alias("known"))
    has = wide.join(own, "source_id", "left")
    known, on = F.coalesce(F.col("known"), F.lit(False)), F.col("enabled") & F.col("public")
    full = ~F.coalesce("delivery_status", F.lit("")).isin("", "EMPTY")
    count = lambda c: F.count_if(known & c)
    counted = has.groupBy("item_id", "priority", "policy_status", "minimum").agg(
        F.count("source_id").alias("declared"), F.count_if(known).alias("registered"), count(on).alias("enabled_public"),
        count(~F.col("public")).alias("controlled"), count(~F.col("enabled")).alias("disabled"), count(on & full).alias("usable"),
    )
    status = coverage_status(*(F.col(c) for c in ("policy_status", "declared", "registered", "enabled_public", "controlled", "disabled", "usable", "minimum")))
    out = counted.withColumn("status", status)
    return out.withColumn("weight", case_map(F.col("priority"), PRIORITY_WEIGHTS, 1.0)).withColumn("value", case_map(F.col("status"), COVERAGE_WEIGHTS, 0.0))


def coverage_summary(coverage: DataFrame) -> DataFrame:
    """(items, coverage_score, p0_blockers): the weighted share covered, in percent."""
    blocked = (F.col("priority") == "P0") & F.col("status").isin("PARTIAL", "MISSING", "UNRESOLVED")
    score = F.when(F.sum("weight") > 0, 100.0 * F.sum(F.col("value") * F.col("weight")) / F.sum("weight")).otherwise(0.0)
    return coverage.agg(F.count(F.lit(1)).alias("items"), F.round(score, 2).alias("coverage_score"), F.count_if(blocked).alias("p0_blockers"))


def quality_issues(sources: DataFrame) -> DataFrame:
    """(source_id, priority, issue, severity), an issue a row.

    ``sources`` has priority, manifest_version (null: none), missing_metadata, delivery_status,
    sync_status, rights_tier, access_tier, failed, backlog, ignored, zero_byte, needs_ocr, missing_columns.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    over = lambda c: F.coalesce(F.col(c), F.lit(0)) > 0
    marks = (
        (F.col("manifest_version").isNull(), "MANIFEST_MISSING"), (F.col("manifest_version") < 3, "MANIFEST_SCHEMA_LEGACY"),
        (over("missing_metadata"), "MANIFEST_METADATA_INCOMPLETE"), (F.coalesce("delivery_status", F.lit("EMPTY")) == "EMPTY", "EMPTY_DELIVERY"),
        (F.col("sync_status") == "ERROR", "SYNC_ERROR"), (empty("rights_tier") | empty("access_tier"), "RIGHTS_METADATA_MISSING"),
        (over("failed"), "UPSTREAM_PARTIAL_FAILURE"), (over("backlog"), "UPSTREAM_BACKLOG"), (over("ignored"), "UPSTREAM_IGNORED_ITEMS"),
        (over("zero_byte"), "ZERO_BYTE_FILES"), (over("needs_ocr"), "DOCUMENTS_NEED_OCR"), (over("missing_columns"), "DOCUMENT_METADATA_COLUMNS_INCOMPLETE"),
    )
    found = F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in marks)))
    return sources.select("source_id", "priority", F.explode(found).alias("issue")).withColumn("severity", issue_severity(F.col("priority"), F.col("issue")))


def quality_summary(sources: DataFrame) -> DataFrame:
    """Per source its worst severity, OK where nothing is amiss."""
    rank = case_map(F.col("severity"), SEVERITY_RANK, 0)
    worst = quality_issues(sources).groupBy("source_id").agg(F.max_by("severity", rank).alias("severity"), F.count(F.lit(1)).alias("issues"))
    return sources.select("source_id").join(worst, "source_id", "left").select("source_id", F.coalesce("severity", F.lit("OK")).alias("severity"), F.coalesce("issues", F.lit(0)).alias("issues"))


GATE_WEIGHTS = {"coverage": 0.25, "quality_provenance": 0.20, "classification": 0.15, "freshness": 0.15, "stability": 0.10, "rights": 0.10, "handoff": 0.05}


def certification(facts: DataFrame) -> DataFrame:
    """Components, weighted score and gates of one-row facts; approved only if every gate holds.

    Facts: active, non_error, non_empty, freshish, rights_ok, manifests_ok, catalog_ok, coverage_score,
    p0_blockers, critical_issues, warnings, schema_pct, partial_sources, backlog_sources, legacy_manifests, elapsed_days,
    cycles_total, cycles_with_errors, exercised, qualified.
    """
    c = F.col
    share = lambda n: F.when(c("active") > 0, c(n) / c("active") * 100.0).otherwise(0.0)
    steady = F.least(
        F.lit(90.0),
        F.least(c("elapsed_days") / 14.0, F.lit(1.0)) * 45.0 + F.least(c("cycles_total") / 14.0, F.lit(1.0)) * 30.0
        + F.when(c("exercised"), 15.0).otherwise(0.0) - F.least(c("cycles_with_errors") * 10.0, F.lit(40.0)),
    )
    parts = {
        "coverage": c("coverage_score"), "quality_provenance": F.greatest(F.lit(0.0), 100.0 - c("critical_issues") * 10.0 - c("warnings") * 1.5),
        "classification": c("schema_pct").cast("double"), "freshness": share("freshish"),
        "stability": F.greatest(F.lit(0.0), F.when(c("qualified") & c("exercised"), 100.0).otherwise(steady)), "rights": share("rights_ok"),
        "handoff": F.when(c("active") > 0, c("manifests_ok") / c("active") * 80.0 + F.when(c("catalog_ok"), 20.0).otherwise(0.0)).otherwise(0.0),
    }
    out = facts.select("*", *(F.round(v, 2).alias(f"c_{k}") for k, v in parts.items()))
    score = sum((c(f"c_{k}") * w for k, w in GATE_WEIGHTS.items()), F.lit(0.0))
    out = out.withColumn("score", score)
    gates = {
        "score_at_least_95": c("score") >= 95.0, "no_p0_coverage_blocker": c("p0_blockers") == 0, "no_critical_quality_issue": c("critical_issues") == 0,
        "structured_upstreams_complete": (c("partial_sources") == 0) & (c("backlog_sources") == 0), "no_active_empty": c("non_empty") == c("active"),
        "no_active_sync_error": c("non_error") == c("active"), "rights_complete": c("rights_ok") == c("active"),
        "document_metadata_complete": c("schema_pct") >= 99.0, "manifest_v3_complete": c("legacy_manifests") == 0, "qualification_14_days": c("qualified"),
        "automatic_sources_exercised": c("exercised"), "catalog_present": c("catalog_ok"), "all_manifests_present": c("manifests_ok") == c("active"),
    }
    names = [k for k in gates]
    out = out.select(*(f"c_{k}" for k in parts), F.round("score", 2).alias("score"), *(g.alias(k) for k, g in gates.items()))
    return out.withColumn("approved", F.least(*(F.col(n) for n in names)))


def qualification_window(results: DataFrame, started: Column, now: Column) -> DataFrame:
    """One row from (cycle, source_id, status): counters and whether the window qualifies.

    Fourteen days and cycles, at least one success and no error.
    """
    cycles = results.groupBy("cycle").agg(F.count(F.lit(1)).alias("attempts"), F.count_if(F.col("status") == "success").alias("successes"))
    total = cycles.agg(
        F.count(F.lit(1)).alias("cycles_total"), F.count_if(F.col("attempts") > F.col("successes")).alias("cycles_with_errors"),
        F.coalesce(F.sum("attempts"), F.lit(0)).alias("sync_attempts"), F.coalesce(F.sum("successes"), F.lit(0)).alias("sync_successes"),
    )
    days = F.greatest(F.lit(0.0), (F.unix_micros(now) - F.unix_micros(started)) / 86400e6)
    ok = (days >= 14) & (F.col("cycles_total") >= 14) & (F.col("sync_successes") > 0) & (F.col("cycles_with_errors") == 0)
    return total.select("*", F.round(days, 3).alias("elapsed_days"), ok.alias("qualified"))


def portal_coverage(official: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row: how much of an official catalogue (id) is tracked, fetched and verified in a ledger (id, status, verification)."""
    both = official.select("id", F.lit(True).alias("o")).distinct().join(ledger.select("id", "status", "verification", F.lit(True).alias("t")), "id", "full_outer")
    o, t = F.coalesce("o", F.lit(False)), F.coalesce("t", F.lit(False))
    ghost = o & (F.coalesce("status", F.lit("")) == "UPSTREAM_GHOST")
    held = o & ~ghost & F.coalesce("status", F.lit("")).isin("FETCHED", "UNCHANGED")
    sure = held & (F.coalesce("verification", F.lit("")) == "VERIFIED")
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(1.0)
    out = both.agg(
        F.count_if(o).alias("official_visible"), F.count_if(o & ~ghost).alias("official_retrievable"), F.count_if(ghost).alias("upstream_ghost"),
        F.count_if(o & t).alias("ledger_tracked"), F.count_if(held).alias("physical"), F.count_if(sure).alias("verified"), F.count_if(held & ~sure).alias("unverified_physical"),
        F.count_if(o & ~t).alias("not_tracked"), F.count_if(o & F.coalesce("status", F.lit("")).isin("LOCAL_MISSING", "CORRUPTED", "FAILED")).alias("bad"), F.count_if(t & ~o).alias("unexpected"),
    )
    return out.select("*", ratio("physical", "official_retrievable").alias("physical_ratio"), ratio("verified", "official_retrievable").alias("verified_ratio"))


def ledger_audit(artifacts: DataFrame) -> DataFrame:
    """(status, verification, n, bytes, physical_bytes)."""
    size = F.coalesce("size_bytes", F.lit(0))
    return artifacts.groupBy("status", "verification").agg(
        F.count(F.lit(1)).alias("n"), F.sum(size).alias("bytes"), F.sum(F.when(F.col("status").isin("FETCHED", "UNCHANGED"), size).otherwise(0)).alias("physical_bytes")
    )


def docs_audit(sources: DataFrame) -> DataFrame:
    """Per language: sources, chunks, sorted frameworks, and the share of bodies that no request was needed for."""
    pages, avoided = F.sum(F.coalesce("pages", F.lit(0))), F.sum(F.coalesce("avoided", F.lit(0)))
    return sources.groupBy("language").agg(
        F.count(F.lit(1)).alias("sources"), F.sum(F.coalesce("chunks", F.lit(0))).alias("chunks"), F.sort_array(F.collect_set("framework")).alias("frameworks"),
        F.round(F.when(pages > 0, 100.0 * avoided / pages).otherwise(100.0), 2).alias("efficiency_pct"),
    )


def country_scope(sources: DataFrame, by: str) -> DataFrame:
    """Per group the one country code of its sources, MIXED for several."""
    codes = sources.groupBy(by).agg(F.min("country_code").alias("low"), F.max("country_code").alias("high"))
    return codes.select(by, F.when(F.col("low") == F.col("high"), F.col("low")).otherwise("MIXED").alias("country_scope"))


def missing_columns(tables: DataFrame, required: list[str]) -> DataFrame:
    """(source_id, missing): what of ``required`` a source's columns (source_id, columns) lack; complete ones are left out."""
    own = tables.groupBy("source_id").agg(F.array_distinct(F.flatten(F.collect_list("columns"))).alias("own"))
    found = own.select("source_id", F.array_except(F.array(*map(F.lit, required)), "own").alias("missing"))
    return found.filter(F.size("missing") > 0)


def inventory(spark, path: str) -> DataFrame:
    """(files, bytes, rows) of a Parquet folder, from file metadata and footers."""
    df = spark.read.parquet(path)
    return df.groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")).count().agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), F.sum("count").alias("rows")
    )
