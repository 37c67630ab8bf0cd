"""Reconciliation of claims and identities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirlake.functions.urls import normalize_repository_url
from weirlake.operators.technologies import merged_unique


def reconcile_claims(claims: DataFrame, subject: str) -> DataFrame:
    """Per subject: the value with the most authority, then the most claims, then the earliest claim.

    ``claims`` is (subject, value, authority, ord). Confidence is the winner's share of authority
    (each at least 0.01), and 0.1 more if it has several claims, at most 1. Values are counted
    map-side, so a subject with many claims meets as its distinct values only.
    """
    floor = F.greatest(F.coalesce("authority", F.lit(0.5)), F.lit(0.01))
    groups = claims.groupBy(subject, "value").agg(
        F.sum(F.coalesce("authority", F.lit(0.5))).alias("authority"), F.sum(floor).alias("support"), F.count(F.lit(1)).alias("n"), F.min("ord").alias("first")
    )
    best = F.max(F.struct("authority", "n", (-F.col("first")).alias("earliest"), "value", "support")).alias("w")
    per = groups.groupBy(subject).agg(best, F.sum("support").alias("total"), F.count(F.lit(1)).alias("distinct_values"))
    sure = F.least(F.lit(1.0), F.col("w.support") / F.col("total") + F.when(F.col("w.n") > 1, 0.1).otherwise(0.0))
    return per.select(
        subject, F.when(F.col("distinct_values") == 1, "consensus").otherwise("conflict").alias("status"), F.col("w.value").alias("value"),
        F.round(sure, 4).alias("confidence"), F.col("w.n").alias("supporting"), (F.col("distinct_values") - 1).alias("alternatives"),
    )


def identity_groups(records: DataFrame) -> DataFrame:
    """Groups of two or more records that share a normalised repository: repository, status, canonical, members.

    ``records`` is (technology_id, canonical_repository, officiality_score). One package makes the others
    its aliases; several stay ambiguous; without any the most official record stands for the rest, the
    least id of equals.
    """
    rows = records.select("technology_id", normalize_repository_url(F.col("canonical_repository")).alias("repository"), F.coalesce("officiality_score", F.lit(0)).alias("score")).filter("repository is not null")
    package = F.col("technology_id").startswith("pkg:")
    best = F.min_by("technology_id", F.struct(-F.col("score"), "technology_id"))
    groups = rows.groupBy("repository").agg(
        F.count(F.lit(1)).alias("members"), F.count_if(package).alias("packages"), F.min(F.when(package, F.col("technology_id"))).alias("package"), best.alias("best")
    ).filter("members > 1")
    status = F.when(F.col("packages") == 1, "MERGED_ALIAS").when(F.col("packages") > 1, "MONOREPO_AMBIGUOUS").otherwise("LINKED")
    canonical = F.when(F.col("packages") == 1, F.col("package")).when(F.col("packages") == 0, F.col("best"))
    return groups.select("repository", "members", "packages", status.alias("status"), canonical.alias("canonical"))


def identity_members(records: DataFrame) -> DataFrame:
    """(technology_id, identity_status, canonical): each grouped record's part in its group."""
    groups = identity_groups(records).select(F.col("repository").alias("_r"), "status", "canonical")
    rows = records.select("technology_id", normalize_repository_url(F.col("canonical_repository")).alias("_r"))
    own = F.col("technology_id") == F.col("canonical")
    package = F.col("technology_id").startswith("pkg:")
    part = (
        F.when(F.col("status") == "MONOREPO_AMBIGUOUS", "MONOREPO_AMBIGUOUS").when(F.col("status") == "MERGED_ALIAS", F.when(own, "CANONICAL").when(~package, "ALIAS_OF_PACKAGE"))
        .otherwise(F.when(own, "CANONICAL_NON_PACKAGE").otherwise("ALIAS_OF_ENTITY"))
    )
    return rows.join(groups, "_r").select("technology_id", part.alias("identity_status"), F.when(~own, F.col("canonical")).alias("canonical"))


def identity_merged(records: DataFrame) -> DataFrame:
    """The packages that stand for their group (MERGED_ALIAS), completed from its other members in order of their ids.

    Beside what ``identity_groups`` reads, ``records`` has documentation_url, official_website, latest_stable_version, qid
    and the lists discovery_sources, identity_aliases and wikidata_qids. Empty values are taken from the first member
    that has one; lists hold distinct values, the package's own first.
    """
    groups = identity_groups(records).filter("status = 'MERGED_ALIAS'").select(F.col("repository").alias("_r"), "canonical")
    rows = records.withColumn("_r", normalize_repository_url(F.col("canonical_repository"))).join(groups, "_r")
    others = rows.filter(F.col("technology_id") != F.col("canonical"))
    gaps, filled = ("documentation_url", "official_website", "latest_stable_version"), lambda c: F.nullif(F.col(c), F.lit(""))
    lists = F.array_sort(F.collect_list(F.struct("technology_id", "qid", "discovery_sources"))).alias("_m")
    of = others.groupBy("canonical").agg(lists, *(F.min_by(filled(c), F.when(filled(c).isNotNull(), F.col("technology_id"))).alias(f"_{c}") for c in gaps))
    both = rows.filter(F.col("technology_id") == F.col("canonical")).drop("_r").join(of, "canonical")
    trimmed = lambda x: F.transform(x, lambda v: F.regexp_replace(v, r"(?U)^\s+|\s+$", ""))
    member = lambda f: F.transform("_m", lambda m: m[f])
    sources = F.flatten(F.transform("_m", lambda m: F.coalesce(m["discovery_sources"], F.array().cast("array<string>"))))
    return both.select(
        "technology_id", *(F.coalesce(filled(c), F.col(f"_{c}")).alias(c) for c in gaps),
        merged_unique(trimmed(F.col("discovery_sources")), trimmed(sources)).alias("discovery_sources"),
        merged_unique(trimmed(F.col("identity_aliases")), trimmed(member("technology_id"))).alias("identity_aliases"),
        merged_unique(trimmed(F.col("wikidata_qids")), trimmed(member("qid"))).alias("wikidata_qids"),
    )


def latest_alias(static: DataFrame, dynamic: DataFrame, targets: DataFrame) -> DataFrame:
    """(target_url, source_id): a static alias first, else the latest successful dynamic one."""
    last = dynamic.filter("status = 'SUCCESS'").groupBy("target_url").agg(F.max_by("source_id", "finished_at").alias("dynamic_id"))
    return (
        targets.select("target_url").distinct().join(static.select("target_url", F.col("source_id").alias("static_id")), "target_url", "left").join(last, "target_url", "left")
        .select("target_url", F.coalesce("static_id", "dynamic_id").alias("source_id"))
    )


def best_candidate(candidates: DataFrame, least: int = 85) -> DataFrame:
    """Per group the candidate url of the highest score, the least url of equals, if it reaches ``least``.

    Candidates of one url count once, with their best score and all their evidence.
    """
    urls = candidates.groupBy("group_id", "url").agg(F.max("score").alias("score"), F.sort_array(F.collect_set("evidence")).alias("evidence"))
    best = urls.groupBy("group_id").agg(F.min_by(F.struct("url", "score", "evidence"), F.struct(-F.col("score"), "url")).alias("b"))
    return best.select("group_id", "b.url", "b.score", "b.evidence").filter(F.col("score") >= least)


def carried_sections(lines: DataFrame) -> DataFrame:
    """(name, type) of the sections of a YAML text given as (doc, line_no, line): headers stand at column zero."""
    header = F.col("line").rlike(r"^[^\s#].*:$")
    section = F.sum(header.cast("int")).over(Window.partitionBy("doc").orderBy("line_no"))
    kept = lines.filter("line <> '' and line not rlike '^\\\\s*#'").withColumn("section", section).filter("section > 0")
    kind = F.nullif(F.regexp_extract("line", r"^\s+type:\s*(.*?)\s*$", 1), F.lit(""))
    return kept.groupBy("doc", "section").agg(
        F.max(F.when(F.col("line").rlike(r"^[^\s#].*:$"), F.trim(F.regexp_extract("line", "^(.*):$", 1)))).alias("name"), F.max(kind).alias("type")
    )
