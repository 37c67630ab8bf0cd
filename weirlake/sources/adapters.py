"""Native package metadata and knowledge-base entities, from VARIANT payloads to one canonical record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirlake.functions.markup import xml_text
from weirlake.functions.scoring import listed, officiality_status
from weirlake.functions.urls import is_landing, normalize_repository_url
from weirlake.functions.versions import go_key, is_maven_stable, latest_stable, nuget_key
from weirlake.sources.records import field, first_present


def _number(*paths: str) -> Column:
    return F.coalesce(*(field("payload", p, "bigint") for p in paths), F.lit(0).cast("bigint"))


def _none() -> Column:
    return F.lit(None).cast("string")


def _labelled(*labels: str) -> Column:
    """A project URL by any of its labels, whatever their case."""
    urls = F.map_from_entries(F.transform(F.map_entries(F.expr("try_variant_get(payload, '$.info.project_urls', 'map<string,string>')")), lambda e: F.struct(F.lower(e["key"]), e["value"])))
    return F.coalesce(*(F.nullif(F.try_element_at(urls, F.lit(x)), F.lit("")) for x in labels))


def _record(authority: str, name: Column, version: Column, repository: Column, docs: Column, website: Column, downloads: Column | None = None, recent: Column | None = None, dependents: Column | None = None, favourites: Column | None = None) -> list[Column]:
    zero = F.lit(0).cast("bigint")
    return [
        F.lit(authority).alias("authority_source"), F.coalesce(name, F.col("asked")).alias("name"), F.nullif(F.trim(version), F.lit("")).alias("latest_stable_version"),
        normalize_repository_url(repository).alias("canonical_repository"), docs.alias("documentation_url"), website.alias("official_website"),
        (downloads if downloads is not None else zero).alias("downloads_total"), (recent if recent is not None else zero).alias("downloads_recent"), (dependents if dependents is not None else zero).alias("dependents_count"), (favourites if favourites is not None else zero).alias("favorites_count"),
    ]


def _repo(*paths: str) -> Column:
    """A repository given as text or as an object with a url."""
    return F.coalesce(*(x for p in paths for x in (first_present("payload", f"{p}.url", f"{p}.web"), F.when(F.schema_of_variant(F.expr(f"try_variant_get(payload, '{p}', 'variant')")) == "STRING", first_present("payload", p)))))


def npm(rows: DataFrame) -> DataFrame:
    latest = F.nullif(F.trim(field("payload", '$["dist-tags"].latest')), F.lit(""))
    current = F.try_element_at(F.expr("try_variant_get(payload, '$.versions', 'map<string,variant>')"), latest)
    repo = F.coalesce(F.try_variant_get(current, "$.repository.url", "string"), F.try_variant_get(current, "$.repository", "string"), _repo("$.repository"))
    site = F.coalesce(F.try_variant_get(current, "$.homepage", "string"), first_present("payload", "$.homepage"))
    return rows.select(*_record("npm", first_present("payload", "$.name"), latest, repo, _none(), site))


def pypi(rows: DataFrame) -> DataFrame:
    repo = _labelled("source", "source code", "repository", "github", "gitlab", "code")
    docs = _labelled("documentation", "docs", "documentation site")
    site = F.coalesce(first_present("payload", "$.info.home_page"), _labelled("homepage", "home"))
    return rows.select(*_record("pypi", first_present("payload", "$.info.name"), field("payload", "$.info.version"), repo, docs, site))


def packagist(rows: DataFrame) -> DataFrame:
    versions = F.expr("try_variant_get(payload, '$.package.versions', 'map<string,variant>')")
    latest = latest_stable(F.map_keys(versions))
    current = F.try_element_at(versions, latest)
    return rows.select(*_record(
        "packagist", first_present("payload", "$.package.name"), latest, F.coalesce(_repo("$.package.repository"), F.try_variant_get(current, "$.source.url", "string")), _none(), F.try_variant_get(current, "$.homepage", "string"),
        _number("$.package.downloads.total"), _number("$.package.downloads.monthly"), _number("$.package.dependents"), _number("$.package.favers"),
    ))


def crates(rows: DataFrame) -> DataFrame:
    return rows.select(*_record(
        "crates.io", first_present("payload", "$.crate.name", "$.crate.id"), first_present("payload", "$.crate.max_stable_version", "$.crate.max_version"), _repo("$.crate.repository"),
        first_present("payload", "$.crate.documentation"), first_present("payload", "$.crate.homepage"), _number("$.crate.downloads"), _number("$.crate.recent_downloads"),
    ))


def rubygems(rows: DataFrame) -> DataFrame:
    return rows.select(*_record(
        "rubygems", first_present("payload", "$.name"), field("payload", "$.version"), _repo("$.source_code_uri"), first_present("payload", "$.documentation_uri"), first_present("payload", "$.homepage_uri"),
        _number("$.downloads"), _number("$.version_downloads"),
    ))


def nuget(rows: DataFrame) -> DataFrame:
    leaf = lambda x, p: F.try_variant_get(x, f"$.catalogEntry.{p}", "string")
    pages = F.flatten(F.transform(F.expr("try_variant_get(payload, '$.items', 'array<variant>')"), lambda p: F.coalesce(F.try_variant_get(p, "$.items", "array<variant>"), F.expr("cast(array() as array<variant>)"))))
    entries = F.transform(pages, lambda x, i: F.struct(
        nuget_key(leaf(x, "version")).alias("k"), i.alias("i"), leaf(x, "id").alias("id"), leaf(x, "version").alias("version"), leaf(x, "projectUrl").alias("site"), leaf(x, "repository").alias("repo"), leaf(x, "readmeUrl").alias("docs"),
        F.coalesce(F.try_variant_get(x, "$.catalogEntry.listed", "boolean"), F.lit(True)).alias("listed"),
    ))
    best = F.coalesce(F.array_max(F.filter(entries, lambda e: e["listed"] & e["k"].isNotNull())), F.try_element_at(entries, F.lit(-1)))
    return rows.withColumn("b", best).select(*_record("nuget", F.col("b.id"), F.col("b.version"), F.col("b.repo"), F.col("b.docs"), F.col("b.site")))


def go(rows: DataFrame) -> DataFrame:
    """``payload`` holds the module's document and the proxy's version list under ``versions``."""
    versions = F.expr("try_variant_get(payload, '$.versions', 'array<string>')")
    best = F.array_max(F.filter(F.transform(versions, lambda v, i: F.struct(go_key(v).alias("k"), i.alias("i"), v.alias("v"))), lambda x: x["k"].isNotNull()))["v"]
    own = F.when(go_key(field("payload", "$.version")).isNotNull(), field("payload", "$.version"))
    name = F.coalesce(first_present("payload", "$.path"), F.col("asked"))
    hint = F.regexp_extract(name, r"^((?:github|gitlab)\.com/[^/]+/[^/]+)", 1)
    docs = F.concat(F.lit("https://pkg.go.dev/"), name)
    return rows.select(*_record("go", name, F.coalesce(best, own), F.coalesce(_repo("$.repoUrl"), F.when(hint != "", F.concat(F.lit("https://"), hint))), docs, docs))


ADAPTERS = {"npmjs.org": npm, "pypi.org": pypi, "packagist.org": packagist, "crates.io": crates, "rubygems.org": rubygems, "nuget.org": nuget, "proxy.golang.org": go}


def native_metadata(rows: DataFrame) -> DataFrame:
    """Canonical records of (registry, asked, payload VARIANT); registries without an adapter are left out."""
    out = None
    for registry, adapter in ADAPTERS.items():
        own = adapter(rows.filter(F.col("registry") == registry)).withColumn("registry", F.lit(registry))
        out = own if out is None else out.unionByName(own)
    return out


def entities(rows: DataFrame) -> DataFrame:
    """Scored records of knowledge-base entities (qid, payload VARIANT)."""
    first = lambda p: F.nullif(F.trim(F.get(F.filter(F.transform(F.expr(f"try_variant_get(payload, '$.claims.{p}', 'array<variant>')"), lambda x: F.try_variant_get(x, "$.mainsnak.datavalue.value", "string")), lambda v: F.coalesce(F.trim(v), F.lit("")) != ""), F.lit(0))), F.lit(""))
    got = rows.select(
        "qid", F.coalesce(first_present("payload", "$.labels.en.value", "$.labels.fr.value"), F.col("qid")).alias("name"), first("P856").alias("official_website"), normalize_repository_url(first("P1324")).alias("canonical_repository"),
        first("P2078").alias("documentation_url"), first("P348").alias("latest_stable_version"),
    )
    parts = (("canonical_repository", 35, "WIKIDATA_REPOSITORY"), ("official_website", 20, "WIKIDATA_OFFICIAL_WEBSITE"), ("documentation_url", 25, "WIKIDATA_DOCUMENTATION"), ("latest_stable_version", 10, "WIKIDATA_VERSION"))
    score = F.least(F.lit(90), sum((F.when(F.col(c).isNotNull(), n).otherwise(0) for c, n, _ in parts), F.lit(0)))
    evidence = F.concat(F.array(F.lit("WIKIDATA_ENTITY")), listed(*((F.col(c).isNotNull(), e) for c, _, e in parts)))
    return got.withColumn("officiality_score", score).withColumn("officiality_status", officiality_status(F.col("officiality_score"))).withColumn("evidence", evidence)


def maven(rows: DataFrame) -> DataFrame:
    """Records of (asked, metadata, pom), both XML texts, asked as ``group:artifact``.

    The release is taken if it is stable, else the latest, else the last listed stable version.
    """
    listed_versions = F.regexp_extract_all(F.coalesce("metadata", F.lit("")), F.lit(r"<(?:\w+:)?version>\s*([^<\s]+)\s*</(?:\w+:)?version>"), F.lit(1))
    release, latest = xml_text(F.col("metadata"), "release"), xml_text(F.col("metadata"), "latest")
    stable = F.coalesce(F.when(is_maven_stable(release), release), F.when(is_maven_stable(latest), latest), F.try_element_at(F.filter(listed_versions, is_maven_stable), F.lit(-1)))
    scm = F.regexp_extract(F.coalesce("pom", F.lit("")), r"(?s)<(?:\w+:)?scm>(.*?)</(?:\w+:)?scm>", 1)
    repo = F.coalesce(xml_text(scm, "url"), F.regexp_replace(xml_text(scm, "connection"), "^scm:git:", ""))
    body = F.regexp_replace(F.coalesce("pom", F.lit("")), r"(?s)<(?:\w+:)?(scm|licenses|developers|organization|parent|dependencies|build)>.*?</(?:\w+:)?\1>", "")
    site = xml_text(body, "url")
    out = rows.select(*_record("maven", F.col("asked"), stable, repo, _none(), F.when(~is_landing(site), site)))
    return out.withColumn("registry", F.lit("repo1.maven.org"))
