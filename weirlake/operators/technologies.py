"""The technology catalogue: stored-state rechecks, statistics, metadata and repository identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirlake.functions.bind import once
from weirlake.functions.scoring import present, qualification_score, qualification_status
from weirlake.functions.text import infer_document_type, infer_domains
from weirlake.functions.urls import normalize_repository_url
from weirlake.operators.audit import dimension_counts

KEY = ["registry", "name"]


def conflicts_to_recheck(authority: DataFrame, qualification: DataFrame, limit: int = 25) -> DataFrame:
    """Conflicting packages with their stored evidence, the best qualified first."""
    both = authority.filter("authority_status = 'AUTHORITY_CONFLICT'").join(qualification.select(*KEY, "score"), KEY)
    return both.orderBy(F.desc("score"), *KEY).limit(limit)


def same_repository(left: Column, right: Column, identities: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` with ``transferred``: whether two differing urls have the same immutable id in (url, repository_id)."""
    ids = identities.select(normalize_repository_url(F.col("url")).alias("_u"), "repository_id").groupBy("_u").agg(F.max("repository_id").alias("_id"))
    keyed = rows.withColumn("_a", normalize_repository_url(left)).withColumn("_b", normalize_repository_url(right))
    a, b = ids.toDF("_a", "_ia"), ids.toDF("_b", "_ib")
    out = keyed.join(a, "_a", "left").join(b, "_b", "left")
    same = (F.col("_a") != F.col("_b")) & (F.col("_ia") == F.col("_ib"))
    return out.withColumn("transferred", F.coalesce(same, F.lit(False))).drop("_a", "_b", "_ia", "_ib")


def recalibrated(qualification: DataFrame, candidates: DataFrame) -> DataFrame:
    """(registry, name, score, status) from stored scores and the candidates' present priority, where either differs."""
    c = candidates.select(*KEY, "priority")
    q = qualification.join(c, KEY)
    score = qualification_score(F.col("importance"), F.col("native"), F.col("priority"))
    new = q.withColumn("new_score", score)
    status = qualification_status(F.col("stable"), F.col("repository"), F.col("native"), F.col("new_score"), F.col("priority"), F.col("registry"))
    new = new.withColumn("new_status", status).filter("new_score <> score or new_status <> status")
    return new.select(*KEY, F.col("new_score").alias("score"), F.col("new_status").alias("status"))


#: Dimensions of the catalogue's audit, and what a missing value counts as; None: in no group.
CATALOGUE_DIMENSIONS = {"category": "UNKNOWN", "officiality_status": "UNVERIFIED", "registry": None, "importance_tier": "UNSCORED", "authority_source": "UNKNOWN"}


def catalogue_audit(records: DataFrame) -> DataFrame:
    """(dimension, value, n, and how many are enabled, have a repository, documentation or version, are verified, or are what identity).

    Groups of each of ``CATALOGUE_DIMENSIONS`` in one pass, and the total with dimension and value ``all``.
    """
    absent = "\0"  # no value of a table
    named = {d: F.coalesce(F.nullif(F.col(d).cast("string"), F.lit("")), F.lit(absent if v is None else v)) for d, v in CATALOGUE_DIMENSIONS.items()}
    identity = F.coalesce("identity_status", F.lit(""))
    marks = {
        "enabled": F.col("enabled_for_corpus"), "with_repository": present(F.col("canonical_repository")), "with_documentation": present(F.col("documentation_url")),
        "with_version": present(F.col("latest_stable_version")), "verified": F.col("officiality_score") >= 80,
        "canonical": identity.startswith("CANONICAL"), "aliases": identity.startswith("ALIAS"), "ambiguous": identity == "MONOREPO_AMBIGUOUS",
    }
    rows = records.select(*(c.alias(d) for d, c in named.items()), *(c.cast("bigint").alias(m) for m, c in marks.items()))
    return dimension_counts(rows, list(named), list(marks)).filter(F.col("value") != absent)


def registry_stats(packages: DataFrame) -> DataFrame:
    """(registry, packages, live, deleted)."""
    return packages.groupBy("registry").agg(F.count(F.lit(1)).alias("packages"), F.count_if("alive").alias("live"), F.count_if(~F.col("alive")).alias("deleted"))


def fetch_coverage(targets: DataFrame, state: DataFrame) -> DataFrame:
    """One row: targets fetched at their present url, and migrations due."""
    both = targets.join(state.select(*KEY, F.col("target_url").alias("live_url"), F.col("status").alias("fetch_status")), KEY)
    return both.agg(
        F.count_if((F.col("fetch_status") == "SUCCESS") & (F.col("live_url") == F.col("target_url"))).alias("covered"),
        F.count_if((F.col("fetch_status") == "SUCCESS") & (F.col("live_url") != F.col("target_url"))).alias("migrations_due"),
    )


def all_exercised(automatic: DataFrame, attempted: DataFrame, baseline: DataFrame) -> bool:
    """Whether there are automatic sources and each was attempted or in the baseline."""
    covered = attempted.select("source_id").union(baseline.select("source_id"))
    return not automatic.isEmpty() and automatic.join(covered, "source_id", "left_anti").isEmpty()


def merged_unique(*lists: Column) -> Column:
    """Distinct values of several lists in the order in which they come; empty ones are left out."""
    every = F.flatten(F.array(*(F.coalesce(x, F.array().cast("array<string>")) for x in lists)))
    return F.array_distinct(F.filter(every, lambda x: F.coalesce(x, F.lit("")) != ""))


#: Defaults of a source's metadata (fixed values).
METADATA_DEFAULTS = {"language": "fr", "geographic_scope": "NATIONAL", "document_type": "OTHER", "primary_domain": "unknown"}


def source_metadata(sources: DataFrame, country_code: str, country_name: str) -> DataFrame:
    """One metadata row a source; options (a map) come before the source's own columns, those before defaults."""
    option = lambda k: F.nullif(F.try_element_at("options", F.lit(k)), F.lit(""))
    primary = F.coalesce(option("primary_domain"), F.nullif("domain", F.lit("")), F.lit(METADATA_DEFAULTS["primary_domain"]))
    fixed = primary != "multidomain"
    return sources.select(
        F.coalesce(option("country_code"), F.lit(country_code)).alias("country_code"), F.coalesce(option("country_name"), F.lit(country_name)).alias("country_name"), "source_id", "provider", F.col("domain").alias("source_domain"),
        primary.alias("primary_domain"), *(F.coalesce(option(k), F.lit(METADATA_DEFAULTS[k])).alias(k) for k in ("language", "geographic_scope", "document_type")), "rights_tier", "access_tier",
        F.when(fixed, "CONFIGURED").otherwise("PARTIAL").alias("classification_status"), F.when(fixed, 1.0).otherwise(0.5).alias("classification_confidence"),
    )


def classified_documents(documents: DataFrame, metadata: DataFrame, taxonomy: dict[str, tuple[str, ...]]) -> DataFrame:
    """Documents (source_id, url, text) with their source's metadata, refined by what the text says."""
    both = documents.join(metadata, "source_id")
    found = once(both, {"_d": infer_domains(F.col("source_domain"), F.col("text"), taxonomy)})
    kind = infer_document_type(F.col("url"), F.col("text"), "")
    return found.withColumns({
        "primary_domain": F.col("_d.primary"), "secondary_domains_json": F.to_json("_d.secondary"), "classification_confidence": F.col("_d.confidence"),
        "document_type": F.coalesce(F.nullif(kind, F.lit("")), "document_type"), "classification_status": F.when(F.col("_d.primary") != "multidomain", "CLASSIFIED").otherwise("PARTIAL"),
    }).drop("_d")
