"""Scores and decisions as column expressions. Weights and thresholds are fixed values of the model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirlake.functions.bind import let
from weirlake.functions.urls import canonical_documentation_url, hosts_related, is_http, normalize_repository_url, part

OFFICIAL_PROVIDERS = ("minist", "direction", "anstat", "bceao", "gouv", "office", "autorité", "autorite")
COVERAGE_WEIGHTS = {"COVERED": 1.0, "PARTIAL": 0.55, "CONTROLLED": 0.75, "UNAVAILABLE": 0.50, "UNRESOLVED": 0.0, "MISSING": 0.0}
PRIORITY_WEIGHTS = {"P0": 3.0, "P1": 2.0, "P2": 1.0}
SEVERITY_RANK = {"OK": 0, "ADVISORY": 1, "WARNING": 2, "CRITICAL": 3}
CRITICAL_ISSUES = (
    "MANIFEST_MISSING", "MANIFEST_SCHEMA_LEGACY", "EMPTY_DELIVERY", "SYNC_ERROR", "RIGHTS_METADATA_MISSING",
    "UPSTREAM_PARTIAL_FAILURE", "UPSTREAM_BACKLOG",
)
STRUCTURED = (
    "data_gouv_ci", "world_bank_wdi", "world_bank_projects", "ilostat_ref_area", "faostat_country", "uis_country", "geoboundaries", "http_file",
)


def present(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("")) != ""


def case_map(key: Column, table: dict, default) -> Column:
    out = F.lit(default)
    for k, v in table.items():
        out = F.when(key == k, F.lit(v)).otherwise(out)
    return out


def listed(*marks: tuple[Column, str]) -> Column:
    """The names whose condition holds, in order."""
    return F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in marks)))


def is_public(rights: Column, access: Column, metadata_only: Column) -> Column:
    """Whether unattended ingestion is allowed."""
    return (
        F.when(F.upper(rights).startswith("D_"), False).when(F.upper(access).isin("OPEN", "OPEN_PUBLIC"), True)
        .otherwise(F.coalesce(metadata_only, F.lit(False)))
    )


def source_score(priority: Column, provider: Column, rights: Column, domain: Column, wanted: str | None = None) -> Column:
    score = case_map(F.upper(priority), {"P0": 1.0, "P1": 0.85, "P2": 0.7, "P3": 0.55}, 0.5)
    score = score + F.when(F.lower(provider).rlike("|".join(OFFICIAL_PROVIDERS)), 0.08).otherwise(0.0)
    score = score + F.when(rights.startswith("A_"), 0.03).otherwise(0.0)
    if wanted:
        score = score + F.when(domain.isin(wanted, "multidomain"), 0.08).otherwise(0.0)
    return F.round(F.least(F.lit(1.0), score), 4)


def _points(condition: Column, n: int) -> Column:
    return F.when(condition, n).otherwise(0)


def _evidence(registry_repo: Column, deps_repo: Column, match: Column, homepage: Column, docs: Column, version: Column) -> Column:
    return listed(
        (present(registry_repo), "REGISTRY_REPOSITORY"), (match, "DEPS_DEV_REPOSITORY_MATCH"), (present(deps_repo) & ~match, "DEPS_DEV_REPOSITORY"),
        (present(homepage), "HOMEPAGE"), (present(docs), "DOCUMENTATION_URL"), (present(version), "STABLE_VERSION"),
    )


def officiality(registry_repo: Column, deps_repo: Column, homepage: Column, docs: Column, version: Column) -> Column:
    """(score, evidence)."""
    same = present(deps_repo) & present(registry_repo) & normalize_repository_url(deps_repo).eqNullSafe(normalize_repository_url(registry_repo))

    def scored(match: Column) -> Column:
        score = (
            _points(present(registry_repo), 40) + _points(match, 30) + _points(present(deps_repo) & ~match, 10)
            + _points(present(homepage), 5) + _points(present(docs), 15) + _points(present(version), 10)
        )
        return F.struct(F.least(score, F.lit(100)).alias("score"), _evidence(registry_repo, deps_repo, match, homepage, docs, version).alias("evidence"))

    return let(same, scored)


def officiality_status(score: Column) -> Column:
    return F.when(score >= 80, "VERIFIED_OFFICIAL").when(score >= 55, "PROBABLE_OFFICIAL").when(score >= 30, "CANDIDATE").otherwise("UNVERIFIED")


def importance(downloads: Column, recent: Column, dependents: Column, stars: Column, official: Column) -> Column:
    """0 to 100, rounded half to even: capped logarithms and a tenth of the officiality."""
    at = lambda c: F.greatest(F.coalesce(c, F.lit(0)).cast("double"), F.lit(0.0))
    term = lambda c, most, k: F.least(F.lit(most), F.log10(at(c) + 1) * k)
    o = F.greatest(F.lit(0), F.least(F.lit(100), F.coalesce(official, F.lit(0))))
    total = term(downloads, 35.0, 5.0) + term(recent, 15.0, 2.5) + term(dependents, 25.0, 6.0) + term(stars, 15.0, 3.0) + o * 0.10
    return F.least(F.lit(100), F.rint(total).cast("int"))


def tier(score: Column) -> Column:
    return F.when(score >= 80, "CORE").when(score >= 60, "MAJOR").when(score >= 40, "SIGNIFICANT").otherwise("LONG_TAIL")


def bounded_int(value: Column, low: int = 0, high: int = 100) -> Column:
    """Parsed or 0, clamped."""
    return F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(value.try_cast("int"), F.lit(0))))


def qualification_score(importance_: Column, native: Column, priority: Column) -> Column:
    return F.least(F.lit(100), F.rint(importance_ * 0.45 + native * 0.35 + priority * 0.20).cast("int"))


def qualification_status(stable: Column, repository: Column, native: Column, score: Column, priority: Column, registry: Column) -> Column:
    has = present(stable)
    ready = has & (((native >= 55) & (score >= 40)) | ((priority >= 80) & (native >= 30)))
    maven = (registry == "repo1.maven.org") & has & present(repository) & (native >= 60)
    return F.when(ready | maven, "READY_FOR_AUTHORITY").when(has & (native >= 30), "QUALIFIED_ON_DEMAND").otherwise("NEEDS_METADATA")


def authority_decision(native_repo: Column, eco_repo: Column, deps_repo: Column, homepage: Column, docs: Column, stable: Column, has_native: Column, errors: Column) -> Column:
    """(repository, alternate, match, conflict, score, status, evidence) from three sources' repositories."""
    yes = lambda c: F.coalesce(c, F.lit(False))
    repos = F.struct(*(normalize_repository_url(c).alias(n) for n, c in (("n", native_repo), ("e", eco_repo), ("d", deps_repo))))

    def compared(r: Column) -> Column:
        n, e, d = r["n"], r["e"], r["d"]
        repo, match = F.coalesce(n, e, d), yes(n == e) | yes(n == d)
        return F.struct(
            repo.alias("repository"), F.when(yes(e != repo), e).when(yes(d != repo), d).alias("alternate"), match.alias("match"), (yes(n != e) | yes(n != d) | yes(e != d)).alias("conflict"),
            F.when(match, n).when(yes(e == d), e).alias("corroborating"), yes(n == e).alias("by_eco"), yes(n == d).alias("by_deps"),
        )

    def decided(c: Column) -> Column:
        # The repositories are normalised by now, so they are compared as they are.
        same = present(c["corroborating"]) & (c["corroborating"] == c["repository"])
        base = F.struct(
            F.least(F.lit(100), _points(present(c["repository"]), 40) + _points(same, 30) + _points(present(c["corroborating"]) & ~same, 10) + _points(present(homepage), 5) + _points(present(docs), 15) + _points(present(stable), 10)).alias("score"),
            _evidence(c["repository"], c["corroborating"], same, homepage, docs, stable).alias("evidence"),
        )
        raised = F.when(has_native, F.least(F.lit(100), base["score"] + 10)).otherwise(base["score"])
        score = F.when(c["conflict"], F.least(raised, F.lit(79))).otherwise(raised)
        evidence = F.array_distinct(F.concat(
            listed((has_native, "NATIVE_REGISTRY_METADATA_REUSED")), base["evidence"],
            listed((c["by_eco"], "ECOSYSTEMS_REPOSITORY_MATCH"), (c["by_deps"], "DEPSDEV_REPOSITORY_MATCH"), (c["conflict"], "REPOSITORY_CONFLICT")),
        ))
        return F.struct(c.alias("c"), score.alias("score"), evidence.alias("evidence"))

    def told(x: Column) -> Column:
        c = x["c"]
        status = (
            F.when(c["conflict"], "AUTHORITY_CONFLICT").when((x["score"] >= 80) & c["match"], "AUTHORITY_VERIFIED")
            .when(F.coalesce(errors, F.lit(0)) > 0, "AUTHORITY_PARTIAL_RETRY").when(x["score"] >= 55, "AUTHORITY_PROBABLE").otherwise("AUTHORITY_REVIEW")
        )
        return F.struct(
            c["repository"].alias("repository"), c["alternate"].alias("alternate"), c["match"].alias("match"), c["conflict"].alias("conflict"),
            x["score"].alias("score"), status.alias("status"), x["evidence"].alias("evidence"),
        )

    return let(let(let(repos, compared), decided), told)


def documentation_target(docs: Column, website: Column, repository: Column) -> Column:
    """(url, kind, status, confidence): documentation, else website, else repository."""
    urls = F.struct(canonical_documentation_url(docs).alias("d"), canonical_documentation_url(website).alias("w"), normalize_repository_url(repository).alias("r"))
    segments = lambda u: F.transform(F.slice(F.filter(F.split(part(u, "path"), "/"), lambda x: x != ""), 1, 2), F.lower)
    pick = lambda url, kind, status, conf: F.struct(url.alias("url"), F.lit(kind).alias("kind"), F.lit(status).alias("status"), conf.alias("confidence"))
    look = F.lit("DISCOVERY_REQUIRED")

    def chosen(u: Column) -> Column:
        d, w, r = u["d"], u["w"], u["r"]
        on_github = (part(d, "host") == "github.com") & (part(r, "host") == "github.com") & (F.size(segments(d)) == 2) & (segments(d) == segments(r))
        confidence = F.when(F.coalesce(on_github, F.lit(False)), "VERIFIED_REPOSITORY_RELATION").when(w.isNotNull() & hosts_related(d, w), "VERIFIED_WEBSITE_RELATION").otherwise("AUTHORITY_DERIVED")
        return (
            F.when(d.isNotNull(), pick(d, "DOCUMENTATION_URL", "READY_FOR_DOCS_CONNECTOR", confidence))
            .when(w.isNotNull(), pick(w, "OFFICIAL_WEBSITE_DISCOVERY", "DOCS_DISCOVERY_REQUIRED", look))
            .when(r.isNotNull() & is_http(r), pick(canonical_documentation_url(r), "CANONICAL_REPOSITORY_DISCOVERY", "DOCS_DISCOVERY_REQUIRED", look))
            .otherwise(pick(F.lit(None).cast("string"), "MISSING", "DOCS_TARGET_MISSING", F.lit("MISSING")))
        )

    return let(urls, chosen)


def delivery_status(connector: Column, metadata_only: Column, rows: Column, raw_files: Column, document_files: Column) -> Column:
    some = (rows > 0) | (document_files > 0) | (raw_files > 0)
    return (
        F.when(metadata_only, F.when(some, "METADATA_ONLY").otherwise("EMPTY"))
        .when(connector == "osm_geofabrik", F.when(raw_files > 0, "SNAPSHOT_ONLY").otherwise("EMPTY"))
        .when(connector.isin("public_web", "official_docs"), F.when(some, "DOCUMENTS_ONLY").otherwise("EMPTY"))
        .when(connector.isin(*STRUCTURED) & (rows > 0), "FULL_STRUCTURED").when(document_files > 0, "DOCUMENTS_ONLY")
        .when(raw_files > 0, "SNAPSHOT_ONLY").when(rows > 0, "FULL_STRUCTURED").otherwise("EMPTY")
    )


def delivery_warnings(delivery: Column, metadata_only: Column, sync_status: Column, url: Column, verify_ssl: Column) -> Column:
    degraded = ~F.lower(url).startswith("http://") & ~F.coalesce(verify_ssl, F.lit(True))
    return listed(
        (metadata_only & (delivery != "EMPTY"), "METADATA_ONLY_SOURCE"), ((sync_status == "success") & (delivery == "EMPTY"), "EMPTY_AFTER_SUCCESS"),
        ((sync_status == "error") & (delivery != "EMPTY"), "SYNC_ERROR_WITH_STALE_DATA"), (degraded, "TLS_VERIFICATION_DISABLED"),
    )


def issue_severity(priority: Column, issue: Column) -> Column:
    return (
        F.when(issue == "DOCUMENTS_NEED_OCR", "ADVISORY").when(issue == "UPSTREAM_IGNORED_ITEMS", "WARNING")
        .when((F.upper(priority) == "P0") & issue.isin(*CRITICAL_ISSUES), "CRITICAL").otherwise("WARNING")
    )


def is_due(last_success: Column, refresh_hours: Column, now: Column) -> Column:
    return F.coalesce(now >= last_success + F.make_dt_interval(hours=refresh_hours), F.lit(True))


def freshness(last_status: Column, last_success: Column, due: Column) -> Column:
    return (
        F.when(F.lower(last_status) == "error", F.when(last_success.isNotNull(), "STALE").otherwise("NEVER_SYNCED"))
        .when(last_success.isNull(), "NEVER_SYNCED").when(due, "DUE").otherwise("FRESH")
    )


def backoff_seconds(attempts: Column, base: int = 300, most: int = 86400) -> Column:
    """Doubles with each attempt up to the twelfth, never above ``most``."""
    return F.least(F.lit(most), (F.lit(base) * F.pow(F.lit(2.0), F.least(attempts, F.lit(12)))).cast("long"))


def harvest_priority(downloads: Column, favourites: Column) -> Column:
    return F.least(F.lit(100), 40 + F.least(F.lit(40), F.floor(downloads / 100000)) + F.least(F.lit(20), F.floor(favourites / 100))).cast("int")


def completion(result: Column, pending: Column, attempts: Column, most: int = 5) -> Column:
    """SUCCESS, PARTIAL if items are pending, else RETRY until attempts run out."""
    return (
        F.when((result == "success") & (pending == 0), "SUCCESS").when(result == "success", "PARTIAL")
        .when(attempts >= most, "REVIEW_EXHAUSTED").otherwise("RETRY")
    )


def physical_state(last_result: Column, removed: Column, error: Column, downloaded: Column, present_locally: Column) -> Column:
    r = F.upper(F.coalesce(last_result, F.lit("")))
    claimed = F.coalesce(downloaded, F.lit(False)) | r.isin("DOWNLOADED", "UNCHANGED")
    return (
        F.when(F.coalesce(removed, F.lit(False)) | (r == "REMOVED_UPSTREAM"), "REMOVED").when(r == "UPSTREAM_GHOST", "UPSTREAM_GHOST")
        .when((r == "ERROR") | present(error), "FAILED").when(claimed & ~F.coalesce(present_locally, F.lit(False)), "LOCAL_MISSING")
        .when(claimed & (r == "UNCHANGED"), "UNCHANGED").when(claimed, "FETCHED").otherwise("DISCOVERED")
    )


def repair_action(connector: Column, url: Column, normal_url: Column, upload_dir: Column, status: Column, expected: Column, source_host: Column) -> Column:
    return (
        F.when(connector.isNull(), "UNKNOWN_SOURCE").when((connector != "public_web") | ~present(url), "SOURCE_RESYNC")
        .when((normal_url != url) | upload_dir, "TOMBSTONE_INVALID_LEGACY_URL").when(~F.upper(status).isin("LOCAL_MISSING", "CORRUPTED"), "SOURCE_RESYNC")
        .when(~present(expected), "SOURCE_RESYNC").when(~present(source_host) | (part(normal_url, "host") != source_host), "SOURCE_RESYNC")
        .otherwise("DIRECT_URL_REPAIR")
    )


def format_of(path_or_url: Column, content_type: Column) -> Column:
    """csv, json, jsonl, xlsx, xls or parquet by suffix, else by content type, else the suffix or ``binary``."""
    suffix = F.lower(F.regexp_extract(part(path_or_url, "path"), r"[^/.][^/]*\.([^./]+)$", 1))
    c = F.lower(F.coalesce(content_type, F.lit("")))
    return (
        F.when(suffix.isin("csv", "json", "jsonl", "xlsx", "xls", "parquet"), suffix).when(c.contains("csv"), "csv").when(c.contains("json"), "json")
        .when(c.contains("spreadsheet") | c.contains("excel"), "xlsx").when(c.contains("parquet"), "parquet").when(suffix != "", suffix).otherwise("binary")
    )


def connector_of(url: Column, portal_host: str) -> Column:
    host, path = part(url, "host"), F.lower(part(url, "path"))
    return (
        F.when(host.endswith(portal_host) & path.contains("/datasets/"), "data_gouv_ci")
        .when(path.rlike(r"\.(csv|json|jsonl|parquet|xml|xlsx|xls)$"), "http_file").otherwise("public_web")
    )
