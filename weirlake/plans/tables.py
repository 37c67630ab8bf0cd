"""Tables that the catalogue's queries work on: the driver's, and state tables derived from them.

Derived tables are plain SELECTs that mean the same in Spark SQL and in the oracle's dialect.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DERIVED = {
    "candidates": """
        SELECT lower(c_mktsegment) AS registry, c_name AS name, CAST(c_custkey % 100 AS INT) AS priority,
               CASE WHEN c_custkey % 11 = 0 THEN 'DELETED' ELSE 'PENDING' END AS status FROM customer""",
    "qualification": """
        SELECT lower(c_mktsegment) AS registry, c_name AS name, CASE WHEN c_custkey % 4 = 0 THEN 'RETRY' WHEN c_custkey % 4 = 1 THEN 'DONE' ELSE 'PENDING' END AS status,
               CAST(c_custkey % 7 AS INT) AS attempts, CASE WHEN c_custkey % 5 = 0 THEN CAST(c_custkey AS BIGINT) END AS retry_at,
               CASE WHEN c_custkey % 2 = 0 THEN 'READY_FOR_AUTHORITY' ELSE 'QUALIFIED_ON_DEMAND' END AS qualification_status,
               CAST(c_custkey % 97 AS INT) AS score, CAST(c_custkey AS BIGINT) AS checked_at
        FROM customer WHERE c_custkey % 3 <> 0""",
    "authority": """
        SELECT lower(c_mktsegment) AS registry, c_name AS name, CAST(c_custkey - c_custkey % 2 AS BIGINT) AS qualification_checked_at, CAST(c_custkey AS BIGINT) AS checked_at,
               CASE WHEN c_custkey % 4 < 2 THEN 'AUTHORITY_VERIFIED' ELSE 'AUTHORITY_REVIEW' END AS authority_status
        FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 5 <> 0""",
    "targets": """
        SELECT lower(c_mktsegment) AS registry, c_name AS name, CAST(c_custkey - c_custkey % 3 AS BIGINT) AS authority_checked_at,
               'https://docs.example.org/' || CAST(c_custkey % 50 AS VARCHAR(20)) AS target_url
        FROM customer WHERE c_custkey % 4 < 2 AND c_custkey % 3 <> 0""",
    "fetched": """
        SELECT lower(c_mktsegment) AS registry, c_name AS name, 'https://docs.example.org/' || CAST(c_custkey % 25 AS VARCHAR(20)) AS target_url,
               CASE WHEN c_custkey % 6 = 0 THEN 'RETRY' ELSE 'SUCCESS' END AS status
        FROM customer WHERE c_custkey % 8 < 5""",
    "backlog_candidates": """
        SELECT lower(c_mktsegment) AS registry, c_name AS name, CASE WHEN c_custkey % 11 = 0 THEN 'DELETED' WHEN c_custkey % 4 = 1 THEN 'RETRY' ELSE 'PENDING' END AS status FROM customer""",
    "backlog_targets": """
        SELECT lower(c_mktsegment) AS registry, c_name AS name, CASE WHEN c_custkey % 5 = 0 THEN 'DOCS_DISCOVERY_REQUIRED' WHEN c_custkey % 5 < 3 THEN 'READY_FOR_DOCS_CONNECTOR' ELSE 'BLOCKED' END AS target_status
        FROM customer WHERE c_custkey % 4 < 2 AND c_custkey % 3 <> 0""",
    "backlog_state": """
        SELECT lower(c_mktsegment) AS registry, c_name AS name, CASE WHEN c_custkey % 6 = 0 THEN 'RETRY' WHEN c_custkey % 6 = 1 THEN 'PARTIAL' ELSE 'SUCCESS' END AS status
        FROM customer WHERE c_custkey % 8 < 5""",
    "technologies": """
        SELECT c_name AS technology_id, c_mktsegment AS category, CASE WHEN c_custkey % 5 = 1 THEN 'VERIFIED' WHEN c_custkey % 5 = 2 THEN '' END AS officiality_status,
               CASE WHEN c_custkey % 3 = 0 THEN 'npmjs.org' WHEN c_custkey % 3 = 1 THEN 'pypi.org' END AS registry, CASE WHEN c_custkey % 7 < 3 THEN 'A' END AS importance_tier,
               CASE WHEN c_custkey % 6 = 0 THEN 'wikidata' END AS authority_source, c_custkey % 2 = 0 AS enabled_for_corpus, CASE WHEN c_custkey % 3 <> 0 THEN 'r' END AS canonical_repository,
               CASE WHEN c_custkey % 4 <> 0 THEN 'd' ELSE '' END AS documentation_url, CASE WHEN c_custkey % 9 <> 0 THEN '1.0' END AS latest_stable_version, CAST(c_custkey % 100 AS INT) AS officiality_score,
               CASE WHEN c_custkey % 8 = 0 THEN 'CANONICAL_NON_PACKAGE' WHEN c_custkey % 8 = 1 THEN 'ALIAS_OF_ENTITY' WHEN c_custkey % 8 = 2 THEN 'MONOREPO_AMBIGUOUS' END AS identity_status
        FROM customer""",
    "sources": """
        SELECT s_suppkey AS source_id, s_name AS title, CASE WHEN s_suppkey % 5 = 0 THEN 'multidomain' ELSE n_name END AS domain,
               CASE WHEN s_suppkey % 4 = 0 THEN 'Direction of ' || n_name ELSE n_name || ' Ltd' END AS provider,
               CASE WHEN s_suppkey % 9 = 0 THEN 'D_CLOSED' WHEN s_suppkey % 2 = 0 THEN 'A_OPEN' ELSE 'B_TERMS' END AS rights_tier,
               CASE WHEN s_suppkey % 6 = 0 THEN 'MIXED' ELSE 'OPEN' END AS access_tier, 'P' || CAST(s_suppkey % 4 AS VARCHAR(20)) AS priority,
               s_suppkey % 7 <> 0 AS enabled, s_suppkey % 3 = 0 AS auto_sync, s_suppkey % 12 = 0 AS metadata_only,
               CASE WHEN s_suppkey % 8 = 0 THEN 'EMPTY' WHEN s_suppkey % 8 = 1 THEN CAST(NULL AS VARCHAR(20)) ELSE 'FULL_STRUCTURED' END AS delivery_status,
               CASE WHEN s_suppkey % 10 = 3 THEN 'ERROR' ELSE 'SUCCESS' END AS sync_status, CAST(s_suppkey % 5 AS INT) AS manifest_version,
               CAST(s_suppkey % 3 AS INT) AS failed, CAST(s_suppkey % 4 AS INT) AS backlog, CAST(s_suppkey % 2 AS INT) AS needs_ocr, s_nationkey AS nation
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "artifacts": """
        SELECT l_suppkey AS source_id, CAST(l_orderkey AS VARCHAR(20)) || '-' || CAST(l_linenumber AS VARCHAR(20)) AS artifact_id,
               CASE WHEN l_returnflag = 'N' THEN 'DOWNLOADED' WHEN l_returnflag = 'R' THEN 'UNCHANGED' END AS last_result,
               CAST(l_quantity * 100 AS BIGINT) AS size_bytes, l_orderkey AS last_checked, l_partkey AS last_downloaded,
               CASE WHEN l_linenumber = 7 THEN 'timeout' END AS error, CASE WHEN l_linestatus = 'O' THEN 'FETCHED' WHEN l_returnflag = 'A' THEN 'FAILED' ELSE 'UNCHANGED' END AS status,
               CASE WHEN l_orderkey % 2 = 0 THEN 'VERIFIED' ELSE 'UNVERIFIED' END AS verification
        FROM lineitem""",
    "upstream_artifacts": """
        SELECT l_suppkey AS source_id, CAST(l_orderkey AS VARCHAR(20)) || '-' || CAST(l_linenumber AS VARCHAR(20)) AS artifact_id,
               CASE WHEN l_returnflag = 'N' THEN 'DOWNLOADED' WHEN l_returnflag = 'R' THEN 'UNCHANGED' END AS last_result,
               CASE WHEN l_linenumber % 3 = 0 THEN 'HEAD' WHEN l_linenumber % 3 = 1 THEN 'HTTP_DOCUMENT' END AS method,
               CAST(l_quantity * 100 AS BIGINT) AS size_bytes, l_orderkey AS last_checked, l_partkey AS last_downloaded,
               CASE WHEN l_linenumber = 7 THEN 'timeout' END AS error, CASE WHEN l_linenumber = 7 AND l_orderkey % 2 = 0 THEN 504 END AS http_status
        FROM lineitem""",
    "before": "SELECT o_orderkey AS k, CAST(floor(o_totalprice) AS BIGINT) % 1000 AS signature FROM orders WHERE o_orderkey % 5 <> 0",
    "now": "SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE CAST(floor(o_totalprice) AS BIGINT) % 1000 END AS signature FROM orders WHERE o_orderkey % 7 <> 0",
    "changes": """
        SELECT event_type AS registry, 'u' || CAST(user_id AS VARCHAR(20)) AS name, event_id % 4 = 0 AS deleted, event_id AS ord, 'feed' || CAST(event_id % 3 AS VARCHAR(20)) AS source
        FROM events WHERE event_id % 2 = 0""",
    "queue": """
        SELECT event_type AS registry, 'u' || CAST(user_id AS VARCHAR(20)) AS name, 'seed' AS source, CAST(max(event_id % 90) AS INT) AS priority, 'DONE' AS status, 't0' AS first_seen_at, 't0' AS last_seen_at
        FROM events WHERE event_id % 2 = 1 AND user_id % 3 <> 0 GROUP BY event_type, user_id""",
    "index_events": """
        SELECT 'p' || CAST(user_id % 40 AS VARCHAR(20)) AS package, CAST(user_id AS VARCHAR(20)) AS version, CAST(event_id % 5 AS VARCHAR(20)) AS hash, event_id AS ord,
               CASE WHEN event_type = 'error' OR event_id % 3 = 0 THEN 'REMOVE' ELSE 'ADD' END AS kind FROM events""",
    "records": """
        SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'pkg:npm/' || s_name ELSE s_name END AS technology_id,
               'git+https://www.github.com/o' || CAST(s_nationkey AS VARCHAR(20)) || '//r' || CAST(s_suppkey % 4 AS VARCHAR(20)) || '.git' AS canonical_repository, CAST(s_suppkey % 17 AS INT) AS officiality_score
        FROM supplier""",
    "identity_records": """
        SELECT CASE WHEN s_suppkey % 5 = 0 THEN 'pkg:npm/' || s_name ELSE s_name END AS technology_id,
               'https://github.com/o/r' || CAST(floor(s_suppkey / 5) AS VARCHAR(20)) AS canonical_repository, CAST(s_suppkey % 17 AS INT) AS officiality_score,
               CASE WHEN s_suppkey % 5 > 2 THEN 'd' || CAST(s_suppkey AS VARCHAR(20)) ELSE '' END AS documentation_url, CASE WHEN s_suppkey % 3 = 0 THEN 'w' || CAST(s_suppkey AS VARCHAR(20)) END AS official_website,
               CASE WHEN s_suppkey % 2 = 0 THEN CAST(s_suppkey AS VARCHAR(20)) END AS latest_stable_version, CASE WHEN s_suppkey % 4 <> 0 THEN 'Q' || CAST(s_suppkey % 7 AS VARCHAR(20)) END AS qid,
               's' || CAST(s_suppkey % 3 AS VARCHAR(20)) AS source
        FROM supplier""",
}

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "conversations", "labels", "benchmark")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = DERIVED[name]
    for t in BASE:
        if f" {t}" in sql:
            table(spark, sf_dir, t).createOrReplaceTempView(t)
    return spark.sql(sql)


def with_derived(*names: str) -> str:
    """The WITH clause that defines derived tables for the oracle."""
    return "WITH " + ", ".join(f"{n} AS ({DERIVED[n]})" for n in names)


def literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, list):
        return "[" + ", ".join(map(literal, v)) + "]"
    return str(v) if isinstance(v, int | float) else "'" + str(v).replace("'", "''") + "'"


def values_sql(columns: str, rows: list[tuple]) -> str:
    """``(VALUES …) AS t(…)`` of small fixed inputs; ``columns`` is a Spark schema string."""
    names = [c.split()[0] for c in columns.replace(", ", ",").split(",")]
    return "(VALUES " + ", ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows) + f") AS t({', '.join(names)})"
