"""Decisions, names and versions over the driver's tables: what the small fixed inputs of the catalogue show, for values that vary with the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirlake.functions import scoring, urls, versions
from weirlake.operators import changes
from weirlake.plans import tables as t
from weirlake.plans.registered import query


def _by(k: Column, *values) -> Column:
    """The value at ``k`` modulo their number; values are columns, or text."""
    out = F.lit(None)
    for i, v in reversed(list(enumerate(values))):
        out = F.when(k % len(values) == i, v if isinstance(v, Column) else F.lit(v)).otherwise(out)
    return out


def _text(*parts) -> Column:
    return F.concat(*(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts))


@query("feed_states", """SELECT o_orderkey, least(100, 40 + least(40, k * 37001 // 100000) + least(20, k * 777 % 5000 // 100))::INT AS priority, least(86400, 300 * pow(2, least(k % 20, 12)))::BIGINT AS backoff,
    CASE WHEN k % 3 <> 0 AND k % 2 = 0 THEN 'SUCCESS' WHEN k % 3 <> 0 THEN 'PARTIAL' WHEN k % 20 >= 5 THEN 'REVIEW_EXHAUSTED' ELSE 'RETRY' END AS outcome, CASE WHEN k % 4 = 0 THEN 0 ELSE least(100, k * 13) END::INT AS bounded FROM (SELECT *, o_orderkey AS k FROM orders)""")
def feed_states(spark, sf_dir):
    k = F.col("o_orderkey")
    return t.table(spark, sf_dir, "orders").select(
        "o_orderkey", scoring.harvest_priority(k * 37001, k * 777 % 5000).alias("priority"), scoring.backoff_seconds(k % 20).alias("backoff"),
        scoring.completion(F.when(k % 3 != 0, "success").otherwise("error"), k % 2, k % 20).alias("outcome"), scoring.bounded_int(F.when(k % 4 == 0, "x").otherwise((k * 13).cast("string"))).alias("bounded"),
    )


@query("artifact_states", """SELECT l_orderkey, l_linenumber, CASE WHEN gone OR res = 'REMOVED_UPSTREAM' THEN 'REMOVED' WHEN res = 'UPSTREAM_GHOST' THEN 'UPSTREAM_GHOST' WHEN res = 'ERROR' OR err <> '' THEN 'FAILED'
    WHEN (got OR res IN ('DOWNLOADED', 'UNCHANGED')) AND NOT here THEN 'LOCAL_MISSING' WHEN res = 'UNCHANGED' THEN 'UNCHANGED' WHEN got OR res = 'DOWNLOADED' THEN 'FETCHED' ELSE 'DISCOVERED' END AS state
    FROM (SELECT *, CASE k % 6 WHEN 0 THEN 'DOWNLOADED' WHEN 1 THEN 'UNCHANGED' WHEN 2 THEN 'ERROR' WHEN 3 THEN 'UPSTREAM_GHOST' WHEN 4 THEN 'REMOVED_UPSTREAM' ELSE '' END AS res, k % 11 = 0 AS gone, CASE WHEN k % 7 = 0 THEN 'why' ELSE '' END AS err, k % 4 = 0 AS got, k % 5 <> 0 AS here
        FROM (SELECT *, l_orderkey + l_linenumber AS k FROM lineitem))""")
def artifact_states(spark, sf_dir):
    k = F.col("l_orderkey") + F.col("l_linenumber")
    result = _by(k, "DOWNLOADED", "unchanged", "ERROR", "UPSTREAM_GHOST", "REMOVED_UPSTREAM", F.lit(None).cast("string"))
    state = scoring.physical_state(result, k % 11 == 0, F.when(k % 7 == 0, "why"), k % 4 == 0, k % 5 != 0)
    return t.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", state.alias("state"))


@query("package_officiality", """SELECT s_suppkey, least(100, CASE WHEN k % 2 = 1 THEN 40 ELSE 0 END + CASE WHEN k % 3 = 0 THEN 0 WHEN k % 2 = 1 AND k % 3 = 1 THEN 30 ELSE 10 END + CASE WHEN k % 5 > 0 THEN 5 ELSE 0 END + CASE WHEN k % 7 > 2 THEN 15 ELSE 0 END + CASE WHEN k % 4 > 0 THEN 10 ELSE 0 END) AS score
    FROM (SELECT *, s_suppkey AS k FROM supplier)""")
def package_officiality(spark, sf_dir):
    k = F.col("s_suppkey")
    own, other = _text("https://github.com/o/r", k), _text("git+https://www.github.com/o/r", k, ".git")
    found = scoring.officiality(F.when(k % 2 == 1, own), F.when(k % 3 == 1, other).when(k % 3 == 2, "https://github.com/x/y"), F.when(k % 5 > 0, "h"), F.when(k % 7 > 2, "d").otherwise(""), F.when(k % 4 > 0, "1.0"))
    return t.table(spark, sf_dir, "supplier").select("s_suppkey", found["score"].alias("score"))


@query("resource_formats", """SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'csv' WHEN 1 THEN 'json' WHEN 2 THEN 'xlsx' WHEN 3 THEN 'pdf' ELSE 'binary' END AS format, CASE page_id % 5 WHEN 0 THEN 'http_file' WHEN 1 THEN 'data_gouv_ci' ELSE 'public_web' END AS connector FROM pages""")
def resource_formats(spark, sf_dir):
    k = F.col("page_id")
    url = _by(k, _text("https://x/a", k, ".CSV?x=1"), _text("https://p.org/datasets/", k), _text("https://x/a", k), _text("https://x/a", k, ".pdf"), _text("https://x/a", k))
    kind = _by(k, "", "application/json", "application/vnd.ms-excel", "application/pdf", F.lit(None).cast("string"))
    return t.table(spark, sf_dir, "pages").select("page_id", scoring.format_of(url, kind).alias("format"), scoring.connector_of(url, "p.org").alias("connector"))


@query("part_versions", """SELECT p_partkey, k % 5 IN (1, 2) AS prerelease, k % 5 IN (0, 3) AS maven_stable, CASE WHEN k % 5 = 0 THEN p_size || '.' || k % 10 || '.0.0' END AS nuget, CASE WHEN k % 5 = 0 THEN 'minor_branch' ELSE 'release_tag' END AS strategy,
    p_size || '.' || k % 10 || '.' || CASE k % 5 WHEN 1 THEN 1 WHEN 4 THEN 2 ELSE 0 END AS first_three FROM (SELECT *, p_partkey AS k FROM part)""")
def part_versions(spark, sf_dir):
    k = F.col("p_partkey")
    v = F.concat(_text(F.col("p_size"), ".", k % 10), _by(k, "", "-rc.1", "-SNAPSHOT", ".RELEASE", "b2"))
    three = F.array_join(F.slice(versions.version_key(v), 1, 3).cast("array<string>"), ".")
    nuget = F.array_join(versions.nuget_key(v).cast("array<string>"), ".")
    return t.table(spark, sf_dir, "part").select("p_partkey", versions.is_prerelease(v).alias("prerelease"), versions.is_maven_stable(v).alias("maven_stable"), nuget.alias("nuget"), versions.ref_strategy(v).alias("strategy"), three.alias("first_three"))


@query("index_rows", """SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'crate' || c_custkey WHEN 1 THEN 'ab' END AS crate, CASE WHEN c_custkey % 2 = 0 THEN 'a' || c_custkey END AS artifact FROM customer""")
def index_rows(spark, sf_dir):
    k = F.col("c_custkey")
    path, info = _by(k, _text("cr/at/crate", k), "2/ab", "config.json"), _by(k, _text("g|a", k, "|1|NA|jar"), _text("g|a", k, "||NA|jar"))
    return t.table(spark, sf_dir, "customer").select("c_custkey", versions.crate_name(path).alias("crate"), versions.uinfo(info)["artifact_id"].alias("artifact"))


@query("page_kinds", "SELECT page_id, page_id % 4 = 0 AS upload, page_id % 4 = 2 AS landing, page_id % 4 = 3 AS doc_like, page_id % 4 = 3 AS signal FROM pages")
def page_kinds(spark, sf_dir):
    k = F.col("page_id")
    url = _by(k, _text("https://x.org/wp-content/uploads/p", k), _text("https://x.org/uploads/p", k, ".pdf"), _text("https://search.maven.org/artifact/p", k), _text("https://x.org/Guide/p", k))
    return t.table(spark, sf_dir, "pages").select("page_id", urls.is_upload_directory(url).alias("upload"), urls.is_landing(url).alias("landing"), urls.doc_like_path(urls.part(url, "path")).alias("doc_like"), urls.doc_signal(url).alias("signal"))


@query("source_links", "SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 15 + 85 + 35 + 25 WHEN 1 THEN 15 + 75 + 15 - 45 WHEN 2 THEN 15 + 65 + 25 WHEN 3 THEN 15 + 15 END AS score FROM supplier")
def source_links(spark, sf_dir):
    k = F.col("s_suppkey")
    url = _by(k, _text("https://github.com/o/r", k, "/edit/main/docs/a.txt"), _text("https://github.com/o/r", k, "/blob/main/src/a.py"), _text("https://github.com/o/r", k, "/tree/main/guide"), _text("https://github.com/o/r", k), _text("https://example.org/o/r", k))
    return t.table(spark, sf_dir, "supplier").select("s_suppkey", urls.git_link_score(url, _by(k, "Edit this page", "source", "", "GitHub", "x")).alias("score"))


@query("ghosts", "SELECT event_id, event_id % 2 = 0 AND event_id % 3 = 0 AND event_id % 5 <> 0 AS ghost FROM events")
def ghosts(spark, sf_dir):
    k = F.col("event_id")
    code = lambda gone: F.when(gone, 404).otherwise(200)
    return t.table(spark, sf_dir, "events").select("event_id", changes.is_ghost(code(k % 2 == 0), code(k % 3 == 0), code(k % 5 != 0)).alias("ghost"))


@query("repairs", """SELECT l_orderkey, l_linenumber, CASE WHEN con IS NULL THEN 'UNKNOWN_SOURCE' WHEN con <> 'public_web' THEN 'SOURCE_RESYNC' WHEN k % 4 > 1 THEN 'TOMBSTONE_INVALID_LEGACY_URL' WHEN k % 7 = 0 OR k % 6 = 0 OR k % 4 = 1 THEN 'SOURCE_RESYNC' ELSE 'DIRECT_URL_REPAIR' END AS action
    FROM (SELECT *, CASE WHEN k % 11 = 0 THEN NULL WHEN k % 5 = 0 THEN 'http_file' ELSE 'public_web' END AS con FROM (SELECT *, l_orderkey + l_linenumber AS k FROM lineitem))""")
def repairs(spark, sf_dir):
    k = F.col("l_orderkey") + F.col("l_linenumber")
    con = F.when(k % 11 == 0, F.lit(None).cast("string")).when(k % 5 == 0, "http_file").otherwise("public_web")
    url = _by(k, _text("https://x.org/a", k, ".pdf"), _text("https://y.org/a", k, ".pdf"), _text("https://x.org/a", k, ".pdf%20"), _text("https://x.org/uploads/", k))
    action = scoring.repair_action(con, url, urls.crawl_url(url), urls.is_upload_directory(url), F.when(k % 7 == 0, "FAILED").otherwise("Corrupted"), F.when(k % 6 != 0, "sha"), F.lit("x.org"))
    return t.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", action.alias("action"))
