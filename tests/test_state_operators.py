"""Operators on small tables, where the derived tables cannot show a case."""

from weirlake.operators import audit, claims, stages, technologies


def test_upstream_audit_keeps_first_errors_methods_and_totals(spark):
    rows = [(1, f"a{i:02}", None, "GET" if i % 2 else None, 5, 1, 1, f"e{i}", 500 + i) for i in reversed(range(60))] + [(2, "b", "DOWNLOADED", "HEAD", 7, 3, 2, "", None), (None, "c", "DOWNLOADED", "HEAD", 1, 1, 1, "lost", 404)]
    a = audit.upstream_audit(spark.createDataFrame(rows, "source_id int, artifact_id string, last_result string, method string, size_bytes int, last_checked int, last_downloaded int, error string, http_status int"))
    got = {r.source_id: r for r in a.collect()}
    assert [tuple(e) for e in got[1].first_errors] == [(f"a{i:02}", f"e{i}", 500 + i) for i in range(50)] and got[1].errors == 60
    assert got[1].methods == {"GET": 30} and got[1].last_results == {"UNKNOWN": 60} and got[2].methods == {"HEAD": 1}
    assert got[2].first_errors == [] and got[2].last_downloaded_bytes == 7 and [e.error for e in got[None].first_errors] == ["lost"]
    total = audit.upstream_totals(a).first()
    assert (total.sources, total.artifacts, total.errors, total.last_results) == (3, 62, 61, {"DOWNLOADED": 2, "UNKNOWN": 60})


def test_backlog_counts_retries_and_documentation(spark):
    of = lambda rows, column: spark.createDataFrame(rows, f"registry string, {column} string")
    got = stages.backlog(
        of([("npm", "PENDING"), ("npm", "RETRY"), ("pypi", "DELETED")], "status"), of([("npm", "READY_FOR_AUTHORITY")], "qualification_status"), of([("npm", "AUTHORITY_VERIFIED"), ("npm", "AUTHORITY_REVIEW")], "authority_status"),
        of([("npm", "DOCS_DISCOVERY_REQUIRED"), ("go", "READY_FOR_DOCS_CONNECTOR")], "target_status"), of([("go", "RETRY"), ("go", "PARTIAL"), ("go", "SUCCESS")], "status"),
    )
    names = ["registry", "pending", "ready", "verified", "unverified", "docs_discovery_required", "docs_ready", "fetch_retry_or_partial"]
    assert sorted(map(tuple, got.select(*names).collect())) == [("go", 0, 0, 0, 0, 0, 1, 2), ("npm", 2, 1, 1, 1, 1, 0, 0)]


def test_catalogue_audit_counts_every_dimension(spark):
    columns = "category string, officiality_status string, registry string, importance_tier string, authority_source string, enabled_for_corpus boolean, canonical_repository string, documentation_url string, latest_stable_version string, officiality_score int, identity_status string"
    rows = [("", "VERIFIED", "npmjs.org", None, None, True, "r", "", "1", 90, "CANONICAL"), (None, None, "", "A", "x", None, None, "d", "", None, None)]
    got = {(r.dimension, r.value): (r.n, r.enabled, r.with_repository, r.with_documentation, r.with_version, r.verified, r.canonical) for r in technologies.catalogue_audit(spark.createDataFrame(rows, columns)).collect()}
    one, other = (1, 1, 1, 0, 1, 1, 1), (1, 0, 0, 1, 0, 0, 0)
    assert got == {
        ("all", "all"): (2, 1, 1, 1, 1, 1, 1), ("category", "UNKNOWN"): (2, 1, 1, 1, 1, 1, 1), ("officiality_status", "VERIFIED"): one, ("officiality_status", "UNVERIFIED"): other,
        ("registry", "npmjs.org"): one, ("importance_tier", "UNSCORED"): one, ("importance_tier", "A"): other, ("authority_source", "UNKNOWN"): one, ("authority_source", "x"): other,
    }


def test_merged_package_takes_over_what_its_aliases_know(spark):
    columns = "technology_id string, canonical_repository string, officiality_score int, documentation_url string, official_website string, latest_stable_version string, qid string, discovery_sources array<string>, identity_aliases array<string>, wikidata_qids array<string>"
    rows = [
        ("pkg:npm/a", "https://github.com/o/a", 1, "", None, "2.0", None, ["npm"], ["old"], None), ("b", "https://github.com/o/a.git", 9, None, "https://b", "1.0", " Q2 ", [" wikidata", "npm", ""], None, None),
        ("a", "https://github.com/o/a", 3, "https://d", "", None, "Q1", None, None, None), ("pkg:npm/lone", "https://github.com/o/l", 1, "", None, None, None, None, None, None),
    ]
    got = [tuple(r) for r in claims.identity_merged(spark.createDataFrame(rows, columns)).collect()]
    assert got == [("pkg:npm/a", "https://d", "https://b", "2.0", ["npm", "wikidata"], ["old", "a", "b"], ["Q1", "Q2"])]
