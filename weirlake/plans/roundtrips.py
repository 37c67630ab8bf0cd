"""Queries over files, payloads and snapshots made from the driver's tables and read back by the sources, sinks and ledgers.

What is written goes to the cluster's shared folder, by Spark or as small files; oracles work on the tables themselves.
"""

from __future__ import annotations

import csv
import io
import json
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirlake.functions import markup, text, urls, versions
from weirlake.operators import audit, corpus, ledger, sinks, stages, technologies
from weirlake.operators.staging import put_bytes, ranked, shared_dir
from weirlake.plans import catalogue
from weirlake.plans import tables as t
from weirlake.plans.query import run_sql
from weirlake.plans.registered import query
from weirlake.sources import adapters, feeds, files, records, registry


def _nations(spark: SparkSession, sf_dir: str) -> list:
    """The nations' rows; the table has 25 at any scale."""
    return t.table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey").orderBy("n_nationkey").collect()


# --- files ----------------------------------------------------------------------------------------


@query("csv_scan", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name || ' é;\"x\"' AS c_name, c_mktsegment FROM customer")
def csv_scan(spark, sf_dir):
    path = shared_dir(spark, "csv")
    c = t.table(spark, sf_dir, "customer").select("c_custkey", F.concat("c_name", F.lit(' é;"x"')).alias("c_name"), "c_mktsegment")
    c.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").option("escape", '"').csv(path)
    return files.read_csv(spark, path)


@query("jsonl_scan", "SELECT o_orderkey, o_orderpriority FROM orders")
def jsonl_scan(spark, sf_dir):
    path = shared_dir(spark, "jsonl")
    t.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority").write.json(path)
    return files.read_any(spark, path, "jsonl", "s").select("o_orderkey", "o_orderpriority")


@query("json_scan", "SELECT CAST(n_nationkey AS BIGINT) AS key, n_name AS name FROM nation")
def json_scan(spark, sf_dir):
    rows = [{"key": r.n_nationkey, "name": r.n_name} for r in _nations(spark, sf_dir)]
    path = put_bytes(spark, f"{shared_dir(spark, 'json')}/a.json", json.dumps({"total": len(rows), "results": rows}).encode())
    v = files.read_json(spark, path)
    return v.select(records.field("value", "$.key", "bigint").alias("key"), records.first_present("value", "$.title", "$.name").alias("name"))


@query("parquet_scan", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal END AS s_acctbal, CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS s_name FROM supplier")
def parquet_scan(spark, sf_dir):
    path = shared_dir(spark, "parquet")
    s = t.table(spark, sf_dir, "supplier").withColumn("s_acctbal", F.when(F.col("s_suppkey") % 3 != 0, F.col("s_acctbal")).otherwise(float("nan")))
    s.filter("s_suppkey % 2 = 0").select("s_suppkey", "s_acctbal", "s_name").write.parquet(path)
    s.filter("s_suppkey % 2 = 1").select("s_suppkey", "s_acctbal").write.mode("append").parquet(path)
    return files.read_parquet(spark, path).select("s_suppkey", "s_acctbal", "s_name")


@query("zip_csv_scan", "SELECT n_name AS area, n_nationkey AS value FROM nation WHERE lower(n_name) IN (SELECT lower(n_name) FROM nation WHERE n_regionkey = 1)")
def zip_csv_scan(spark, sf_dir):
    rows, out = _nations(spark, sf_dir), io.BytesIO()
    sheet = io.StringIO()
    w = csv.writer(sheet)
    w.writerows([("Area", "Value"), *((r.n_name, r.n_nationkey) for r in rows)])
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("all_Normalized.csv", "﻿" + sheet.getvalue())
        z.writestr("notes.csv", "Area,Value\nnone,1\n")
    path = put_bytes(spark, f"{shared_dir(spark, 'zip')}/a.zip", out.getvalue())
    found = files.read_zip_csv(spark, path, tuple(f" {r.n_name.upper()} " for r in rows if r.n_regionkey == 1))
    return found.select(F.col("row")["Area"].alias("area"), F.col("row")["Value"].cast("int").alias("value"))


@query("spreadsheet_scan", "SELECT 'Nations' AS sheet, row_number() OVER (ORDER BY n_nationkey) - 1 AS row_index, CAST(n_nationkey AS VARCHAR) AS key, n_name AS name FROM nation")
def spreadsheet_scan(spark, sf_dir):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    cell = lambda c, i, v: f'<c r="{c}{i}" t="inlineStr"><is><t>{v}</t></is></c>'
    body = [("key", "name"), *((r.n_nationkey, r.n_name) for r in _nations(spark, sf_dir))]
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main}><sheets><sheet name="Nations" sheetId="1"/></sheets></workbook>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {main}><sheetData>" + "".join(f'<row r="{i}">{cell("A", i, a)}{cell("B", i, b)}</row>' for i, (a, b) in enumerate(body, 1)) + "</sheetData></worksheet>")
    path = put_bytes(spark, f"{shared_dir(spark, 'xlsx')}/a.xlsx", out.getvalue())
    return files.read_spreadsheet(spark, path).select("sheet", "row_index", F.col("row")["key"].alias("key"), F.col("row")["name"].alias("name"))


@query("extract_facts", "SELECT 900 AS size_bytes, md5(repeat('map', 300)) AS md5")
def extract_facts(spark, sf_dir):
    path = put_bytes(spark, f"{shared_dir(spark, 'extract')}/a.pbf", b"map" * 300)
    return records.extract_snapshot(spark, path, None).select("size_bytes", "md5")


@query("parquet_inventory", "SELECT count(*) AS rows FROM lineitem")
def parquet_inventory(spark, sf_dir):
    return audit.inventory(spark, f"{sf_dir}/lineitem.parquet").select("rows")


# --- payloads -------------------------------------------------------------------------------------


@query("catalogue_items", "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS title FROM orders")
def catalogue_items(spark, sf_dir):
    o = t.table(spark, sf_dir, "orders")
    page = F.to_json(F.struct(F.collect_list(F.struct(F.col("o_orderkey").cast("string").alias("slug"), F.col("o_orderpriority").alias("title"))).alias("results")))
    pages = o.groupBy(F.floor(F.col("o_orderkey") / 200).alias("page")).agg(F.parse_json(page).alias("payload"))
    # A page comes twice: an id counts once.
    return records.catalogue_pages(pages.unionByName(pages.filter("page % 2 = 0")), o.count()).select("id", records.field("item", "$.title").alias("title"))


@query("cursor_order", "SELECT n_name AS name, n_nationkey // 5 AS place FROM nation")
def cursor_order(spark, sf_dir):
    """Pages come in any order and are put together by their cursors."""
    rows = _nations(spark, sf_dir)
    parts = [rows[i : i + 5] for i in range(0, len(rows), 5)]
    pages = [(f"c{i}", f"c{i + 1}" if i + 1 < len(parts) else None, json.dumps([r.n_name for r in p])) for i, p in enumerate(parts)]
    df = spark.createDataFrame(pages[::-1], "cursor string, next string, names string")
    order = records.cursor_chain(df, "c0")
    place = F.array_position(F.array(*map(F.lit, order)), F.col("cursor")) - 1
    return df.select(F.explode(F.from_json("names", "array<string>")).alias("name"), place.alias("place"))


@query("attachment_rows", "SELECT s_suppkey, s_name AS name, 'https://x.org/' || s_suppkey AS url FROM supplier")
def attachment_rows(spark, sf_dir):
    """Attachments as a list, inside an object, and keyed."""
    s = t.table(spark, sf_dir, "supplier")
    k, url = F.col("s_suppkey"), F.concat(F.lit("https://x.org/"), F.col("s_suppkey").cast("string"))
    one = F.struct(F.col("s_name").alias("name"), url.alias("url"))
    as_list, nested = F.to_json(F.struct(F.array(one).alias("attachments"))), F.to_json(F.struct(F.struct(F.array(one).alias("files")).alias("attachments")))
    keyed = F.to_json(F.struct(F.create_map("s_name", F.struct(url.alias("url"))).alias("attachments")))
    p = s.select("s_suppkey", F.parse_json(F.when(k % 3 == 0, as_list).when(k % 3 == 1, nested).otherwise(keyed)).alias("payload"))
    return p.select("s_suppkey", F.explode(records.attachments()).alias("a")).select("s_suppkey", "a.name", "a.url")


@query("row_signatures", "SELECT p_partkey, sha256('{\"p_brand\":\"' || p_brand || '\",\"p_size\":' || p_size || ',\"p_type\":\"' || p_type || '\"}') AS signature FROM part")
def row_signatures(spark, sf_dir):
    return t.table(spark, sf_dir, "part").select("p_partkey", records.signature("p_type", "p_brand", "p_size").alias("signature"))


@query("group_signatures", """SELECT n_regionkey, sha256(string_agg(sha256('{"n_name":"' || n_name || '"}'), '' ORDER BY n_nationkey)) AS signature FROM nation GROUP BY 1""")
def group_signatures(spark, sf_dir):
    return records.group_signature(t.table(spark, sf_dir, "nation"), "n_regionkey", ["n_name"], "n_nationkey")


@query("geo_levels", "SELECT 'ADM' || n_regionkey AS level, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS feature_index, CAST(n_nationkey AS VARCHAR) AS feature_id, '{\"name\":\"' || n_name || '\"}' AS properties FROM nation")
def geo_levels(spark, sf_dir):
    n = t.table(spark, sf_dir, "nation")
    feature = F.struct(F.col("n_nationkey").cast("string").alias("id"), F.struct(F.col("n_name").alias("name")).alias("properties"))
    by = n.groupBy("n_regionkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", feature.alias("f")))), lambda x: x["f"]).alias("features"))
    payload = F.parse_json(F.to_json(F.struct("features")))
    g = records.geo_features(by.select(F.concat(F.lit("ADM"), F.col("n_regionkey").cast("string")).alias("level"), payload.alias("payload")))
    return g.select("level", F.col("feature_index").cast("long").alias("feature_index"), "feature_id", "properties")


@query("entity_records", """SELECT 'Q' || s_suppkey AS qid, s_name AS name, least(90, 20 + CASE WHEN s_suppkey % 2 = 0 THEN 35 ELSE 0 END) AS officiality_score FROM supplier""")
def entity_records(spark, sf_dir):
    k = F.col("s_suppkey")
    claim = lambda v: F.array(F.struct(F.struct(F.struct(v.alias("value")).alias("datavalue")).alias("mainsnak")))
    site, repo = claim(F.concat(F.lit("https://s.org/"), k.cast("string"))), claim(F.when(k % 2 == 0, F.concat(F.lit("https://github.com/o/"), k.cast("string"))))
    payload = F.struct(F.struct(F.struct(F.col("s_name").alias("value")).alias("en")).alias("labels"), F.struct(site.alias("P856"), repo.alias("P1324")).alias("claims"))
    e = t.table(spark, sf_dir, "supplier").select(F.concat(F.lit("Q"), k.cast("string")).alias("qid"), F.parse_json(F.to_json(payload)).alias("payload"))
    return adapters.entities(e).select("qid", "name", "officiality_score")


@query("registry_records", """SELECT CASE s_suppkey % 2 WHEN 0 THEN 'crates.io' ELSE 'rubygems.org' END AS registry, s_name AS name, s_suppkey || '.0' AS latest_stable_version, CASE WHEN s_suppkey % 2 = 0 THEN 'https://github.com/o/r' || s_suppkey END AS canonical_repository FROM supplier""")
def registry_records(spark, sf_dir):
    k, even = F.col("s_suppkey"), F.col("s_suppkey") % 2 == 0
    version = F.concat(k.cast("string"), F.lit(".0"))
    crate = F.to_json(F.struct(F.struct(F.col("s_name").alias("id"), version.alias("max_stable_version"), F.concat(F.lit("https://github.com/o/r"), k.cast("string")).alias("repository")).alias("crate")))
    gem = F.to_json(F.struct(F.col("s_name").alias("name"), version.alias("version")))
    rows = t.table(spark, sf_dir, "supplier").select(F.when(even, "crates.io").otherwise("rubygems.org").alias("registry"), F.col("s_name").alias("asked"), F.parse_json(F.when(even, crate).otherwise(gem)).alias("payload"))
    return adapters.native_metadata(rows).select("registry", "name", "latest_stable_version", "canonical_repository")


@query("maven_records", "SELECT 'g:' || p_brand AS name, '1.' || count(*) AS latest_stable_version FROM part GROUP BY p_brand")
def maven_records(spark, sf_dir):
    p = t.table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count(F.lit(1)).cast("string").alias("n"))
    meta = F.concat(F.lit("<m:metadata><m:versioning><m:release>1."), F.col("n"), F.lit("</m:release><m:latest>2.0-SNAPSHOT</m:latest></m:versioning></m:metadata>"))
    rows = p.select(F.concat(F.lit("g:"), "p_brand").alias("asked"), meta.alias("metadata"), F.lit("<project><url>https://x.org</url></project>").alias("pom"))
    return adapters.maven(rows).select("name", "latest_stable_version")


# --- markup, names and times ----------------------------------------------------------------------


@query("sitemap_rows", "SELECT replace(url, '&amp;', '&') AS url, page_id % 2 = 0 AS dated FROM pages WHERE trim(url) <> ''")
def sitemap_rows(spark, sf_dir):
    p = t.table(spark, sf_dir, "pages").filter("trim(url) <> ''")
    entry = F.concat(F.lit("<url><loc> "), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit(" </loc>"), F.when(F.col("page_id") % 2 == 0, "<lastmod>2024-01-01</lastmod>").otherwise(""), F.lit("</url>"))
    maps = p.groupBy(F.floor(F.col("page_id") / 100).alias("m")).agg(F.concat(F.lit("<urlset>"), F.array_join(F.collect_list(entry), "\n"), F.lit("</urlset>")).alias("xml"))
    return maps.select(F.explode(markup.sitemap_entries(F.col("xml"))).alias("e")).select("e.url", F.col("e.lastmod").isNotNull().alias("dated"))


@query("llms_links", "SELECT n_regionkey, count(*) + 1 AS n FROM nation GROUP BY 1")
def llms_links(spark, sf_dir):
    """Markdown links and bare URLs, each once."""
    url = F.concat(F.lit("https://x.org/"), F.col("n_nationkey").cast("string"))
    line = F.concat(F.lit("- ["), F.col("n_name"), F.lit("]("), url, F.lit(" 'title')\n"), url)
    n = t.table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.concat(F.array_join(F.collect_list(line), "\n"), F.lit("\nhttps://y.org/all")).alias("md"))
    return n.select("n_regionkey", F.size(markup.markdown_links(F.col("md"))).cast("long").alias("n"))


@query("property_values", "SELECT s_suppkey, s_name AS chain, CAST(s_nationkey AS VARCHAR) AS last FROM supplier")
def property_values(spark, sf_dir):
    body = F.concat(F.lit("# comment\nnexus.index.id = x\nnexus.index.id: "), F.col("s_name"), F.lit("\r\n\n! other\nnexus.index.last-incremental="), F.col("s_nationkey").cast("string"), F.lit("\n"))
    m = t.table(spark, sf_dir, "supplier").select("s_suppkey", markup.properties(body).alias("m"))
    return m.select("s_suppkey", F.col("m")["nexus.index.id"].alias("chain"), F.col("m")["nexus.index.last-incremental"].alias("last"))


@query("snapshot_names", r"""SELECT c_custkey, left(regexp_replace(regexp_replace(c_name || ' /é ', '[^a-zA-Z0-9_.-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g'), 120) || '--' || sha256(c_name) || '.parquet' AS name FROM customer""")
def snapshot_names(spark, sf_dir):
    return t.table(spark, sf_dir, "customer").select("c_custkey", text.snapshot_name(F.concat("c_name", F.lit(" /é ")), F.sha2("c_name", 256), F.lit(".parquet")).alias("name"))


@query("related_hosts", rf"SELECT page_id, coalesce(({catalogue._HOST} = 'example.com' OR ends_with({catalogue._HOST}, '.example.com')), FALSE) AS related FROM pages")
def related_hosts(spark, sf_dir):
    return t.table(spark, sf_dir, "pages").select("page_id", F.coalesce(urls.hosts_related(F.col("url"), F.lit("https://Example.com/x")), F.lit(False)).alias("related"))


@query("parsed_times", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate END AS at FROM orders")
def parsed_times(spark, sf_dir):
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return t.table(spark, sf_dir, "orders").select("o_orderkey", versions.parse_time(F.when(k % 3 == 0, day).when(k % 3 == 1, "").otherwise("soon")).cast("timestamp_ntz").alias("at"))


@query("repositories", "SELECT s_suppkey, CASE s_suppkey % 3 WHEN 2 THEN 'https://example.org/o/r' || s_suppkey ELSE 'https://github.com/o/r' || s_suppkey END AS repository FROM supplier")
def repositories(spark, sf_dir):
    """The forms of a repository's address, over a table."""
    k, n = F.col("s_suppkey"), F.col("s_suppkey").cast("string")
    url = F.when(k % 3 == 0, F.concat(F.lit("git+https://www.github.com/o//r"), n, F.lit(".git"))).when(k % 3 == 1, F.concat(F.lit("git@github.com:o/r"), n, F.lit(".git"))).otherwise(F.concat(F.lit("http://Example.org/o/r"), n, F.lit("/")))
    return t.table(spark, sf_dir, "supplier").select("s_suppkey", urls.normalize_repository_url(url).alias("repository"))


@query("purls", """SELECT p_partkey, 'pkg:' || CASE p_partkey % 4 WHEN 0 THEN 'npm/%40' WHEN 1 THEN 'hackage/' WHEN 2 THEN 'cran/' ELSE 'maven/g/' END || replace(p_brand, '#', '%23') || '@' || p_size AS purl FROM part""")
def purls(spark, sf_dir):
    k = F.col("p_partkey") % 4
    registry_name = F.when(k == 0, "npm").when(k == 1, "hackage").when(k == 2, "CRAN").otherwise("maven")
    name = F.concat(F.when(k == 0, "@").when(k == 3, "g:").otherwise(""), F.col("p_brand"))
    return t.table(spark, sf_dir, "part").select("p_partkey", urls.build_purl(registry_name, name, F.col("p_size").cast("string")).alias("purl"))


@query("module_paths", "SELECT c_custkey, 'x.org/!a/%C3%89' || replace(lower(regexp_replace(c_name, '([A-Z])', '!\\1', 'g')), '#', '%23') AS path FROM customer")
def module_paths(spark, sf_dir):
    return t.table(spark, sf_dir, "customer").select("c_custkey", versions.go_proxy_escape(F.concat(F.lit("x.org/A/É"), F.col("c_name"))).alias("path"))


@query("size_texts", "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_size * 1024 WHEN 1 THEN floor(p_size * 1.5 * 1048576)::BIGINT WHEN 2 THEN p_size END AS bytes FROM part")
def size_texts(spark, sf_dir):
    k, n = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    size = F.when(k == 0, F.concat(n, F.lit(" kb"))).when(k == 1, F.concat((F.col("p_size") * 1.5).cast("string"), F.lit("MB"))).when(k == 2, n).otherwise("many")
    return t.table(spark, sf_dir, "part").select("p_partkey", versions.size_bytes(size).alias("bytes"))


# --- tables, ledgers and stages -------------------------------------------------------------------


@query("table_sink", "SELECT l_returnflag AS flag, count(*) AS n, sum(l_linenumber)::BIGINT AS lines FROM lineitem WHERE l_returnflag <> 'R' OR l_orderkey % 2 = 0 GROUP BY 1")
def table_sink(spark, sf_dir):
    """Rows go to their tables; writing one table again replaces it and no other."""
    path = shared_dir(spark, "tables")
    rows = t.table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("_table"), "l_linenumber", "l_orderkey")
    sinks.write_tables(rows, path)
    sinks.write_tables(rows.filter("_table = 'R' and l_orderkey % 2 = 0"), path)
    return spark.read.parquet(path).groupBy(F.col("_table").alias("flag")).agg(F.count(F.lit(1)).alias("n"), F.sum("l_linenumber").alias("lines"))


@query("merged_sink", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'new' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def merged_sink(spark, sf_dir):
    path = shared_dir(spark, "merged")
    c = t.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    sinks.write_merged(c.filter("c_custkey % 5 <> 0"), path, 0, ["c_custkey"])
    new = c.filter("c_custkey % 3 = 0 or c_custkey % 5 = 0").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 3 == 0, "new").otherwise(F.col("c_mktsegment")))
    return spark.read.parquet(sinks.write_merged(new, path, 1, ["c_custkey"]))


@query("archived_tables", "SELECT count(*) FILTER (l_returnflag <> 'R') AS live, count(*) FILTER (l_returnflag = 'R') AS legacy FROM lineitem")
def archived_tables(spark, sf_dir):
    path = shared_dir(spark, "archive")
    sinks.write_tables(t.table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("_table"), "l_orderkey"), path)
    sinks.archive_tables(spark, path, ["R", "none"])
    live, legacy = (spark.read.parquet(p).agg(F.count(F.lit(1)).alias(n)) for p, n in ((path, "live"), (f"{path}_legacy", "legacy")))
    return live.join(legacy, how="cross")  # one row each


@query("corpus_written", f"SELECT min(doc_id) AS doc_id, fingerprint AS sha256 FROM ({catalogue._SCORED}) WHERE quality >= 0.35 GROUP BY fingerprint")
def corpus_written(spark, sf_dir):
    """Shards read back after a corpus was written."""
    path = shared_dir(spark, "corpus")
    corpus.write_corpus(t.table(spark, sf_dir, "documents"), path, "v1", "doc_id", shard_size=100)
    return spark.read.json(f"{path}/v1/shards").select("doc_id", "sha256")


@query("ranked_rows", "SELECT c_custkey, row_number() OVER (ORDER BY c_mktsegment, c_custkey) - 1 AS rank FROM customer")
def ranked_rows(spark, sf_dir):
    return ranked(t.table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment", "c_custkey"]).select("c_custkey", "rank")


@query("provenance", "SELECT s_suppkey, 'src' AS _prov_source_id, row_number() OVER (ORDER BY s_name) - 1 AS _prov_row_index FROM supplier")
def provenance(spark, sf_dir):
    s = records.with_provenance(t.table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "src", "suppliers", "https://x.org", "now", ["s_name"])
    return s.select("s_suppkey", "_prov_source_id", "_prov_row_index")


_MARKED = """SELECT l_orderkey AS source_id, l_linenumber AS artifact_id, CASE l_linenumber % 5 WHEN 0 THEN 'downloaded' WHEN 1 THEN 'unchanged' WHEN 2 THEN 'error' WHEN 3 THEN 'ghost' ELSE 'removed' END AS mark FROM lineitem WHERE l_orderkey % 2 = 0"""


@query("upstream_marks", f"""WITH m AS ({_MARKED}) SELECT l_orderkey AS source_id, l_linenumber AS artifact_id,
    CASE mark WHEN 'downloaded' THEN 'DOWNLOADED' WHEN 'unchanged' THEN 'UNCHANGED' WHEN 'error' THEN 'ERROR' WHEN 'ghost' THEN 'UPSTREAM_GHOST' WHEN 'removed' THEN 'REMOVED_UPSTREAM' ELSE 'OLD' END AS last_result,
    CASE WHEN mark IN ('downloaded', 'unchanged', 'ghost') THEN FALSE WHEN mark = 'removed' THEN TRUE ELSE l_linenumber = 1 END AS removed,
    CASE WHEN mark IN ('error', 'ghost') THEN 'why' WHEN mark IN ('downloaded', 'unchanged') THEN NULL ELSE 'before' END AS error,
    CASE WHEN mark IS NULL OR mark = 'error' THEN 'old' ELSE 'new' END AS signature, CASE WHEN mark IS NULL THEN 't0' ELSE 't1' END AS last_checked
    FROM lineitem LEFT JOIN m ON m.source_id = l_orderkey AND m.artifact_id = l_linenumber""")
def upstream_marks(spark, sf_dir):
    li = t.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("source_id"), F.col("l_linenumber").alias("artifact_id"))
    n = F.col("artifact_id") % 5
    mark = F.when(n == 0, "downloaded").when(n == 1, "unchanged").when(n == 2, "error").when(n == 3, "ghost").otherwise("removed")
    state = li.select(
        "source_id", "artifact_id", F.lit("OLD").alias("last_result"), F.lit(True).alias("downloaded"), (F.col("artifact_id") == 1).alias("removed"), F.lit("before").alias("error"),
        F.lit("old").alias("signature"), F.lit("t0").alias("last_checked"), F.lit("t0").alias("last_downloaded"),
    )
    marks = li.filter("source_id % 2 = 0").select("source_id", "artifact_id", mark.alias("mark"), F.lit("new").alias("signature"), F.lit("why").alias("error"))
    return ledger.mark(state, marks, "t1").select("source_id", "artifact_id", "last_result", "removed", "error", "signature", "last_checked")


@query("ledger_verified", """SELECT s_suppkey AS artifact_id, CASE s_suppkey % 4 WHEN 0 THEN 'LOCAL_MISSING' WHEN 1 THEN 'CORRUPTED' ELSE 'FETCHED' END AS status,
    CASE WHEN s_suppkey % 4 < 2 THEN 'FAILED' ELSE 'VERIFIED' END AS verification, CASE s_suppkey % 4 WHEN 0 THEN 'local artifact is missing' WHEN 1 THEN 'sha256 mismatch' END AS error FROM supplier""")
def ledger_verified(spark, sf_dir):
    s = t.table(spark, sf_dir, "supplier")
    k, n = F.col("s_suppkey"), F.col("s_suppkey").cast("string")
    sha = F.sha2("s_name", 256)
    rows = s.select(
        F.lit("s").alias("source_id"), k.alias("artifact_id"), F.lit("u").alias("url"), F.lit("g").alias("signature"), F.when(k % 4 == 1, F.sha2(F.lit("other"), 256)).otherwise(sha).alias("sha256"),
        F.octet_length("s_name").alias("size_bytes"), F.concat(F.lit("/a/"), n).alias("local_path"), F.when(k % 4 == 3, "CORRUPTED").otherwise("FETCHED").alias("status"), F.lit("UNVERIFIED").alias("verification"),
        F.lit(None).cast("string").alias("verified_sha256"), F.lit("old").alias("error"), F.lit("t0").alias("first_seen_at"), F.lit("t0").alias("last_checked_at"),
    )
    facts = s.filter("s_suppkey % 4 <> 0").select(F.concat(F.lit("/a/"), n).alias("local_path"), F.octet_length("s_name").alias("actual_size"), sha.alias("actual_sha256"))
    return ledger.verify(rows, facts, "t1").select("artifact_id", "status", "verification", "error")


@query("ledger_ingested", """SELECT coalesce(s_suppkey, 0) AS artifact_id, CASE WHEN s_suppkey % 2 = 0 THEN 'VERIFIED' ELSE 'UNVERIFIED' END AS verification, 't0' AS first_seen_at FROM supplier WHERE s_suppkey % 3 <> 0
    UNION ALL SELECT s_suppkey, 'UNVERIFIED', 't1' FROM supplier WHERE s_suppkey % 3 = 0""")
def ledger_ingested(spark, sf_dir):
    """A verification stands while the hash does; rows that were not there come in unverified."""
    s = t.table(spark, sf_dir, "supplier")
    k, sha, path = F.col("s_suppkey"), F.sha2("s_name", 256), F.concat(F.lit("/a/"), F.col("s_suppkey").cast("string"))
    old = s.filter("s_suppkey % 3 <> 0").select(
        F.lit("s").alias("source_id"), k.alias("artifact_id"), F.lit("u").alias("url"), F.lit("g").alias("signature"), sha.alias("sha256"), F.lit(1).alias("size_bytes"), path.alias("local_path"), F.lit("FETCHED").alias("status"),
        F.lit("VERIFIED").alias("verification"), sha.alias("verified_sha256"), F.lit(None).cast("string").alias("error"), F.lit("t0").alias("first_seen_at"), F.lit("t0").alias("last_checked_at"),
    )
    up = s.select(
        F.lit("s").alias("source_id"), k.alias("artifact_id"), F.lit("u").alias("url"), F.lit("g2").alias("signature"), F.when(k % 2 == 0, sha).otherwise(F.sha2(F.lit("changed"), 256)).alias("sha256"), F.lit(1).alias("size_bytes"),
        path.alias("local_path"), F.lit("DOWNLOADED").alias("last_result"), F.lit(False).alias("removed"), F.lit(True).alias("downloaded"), F.lit(None).cast("string").alias("error"),
    )
    return ledger.ingest(old, up, up.select("local_path"), "t1").select("artifact_id", "verification", "first_seen_at")


@query("migrations", "SELECT c_mktsegment AS registry, c_name AS name, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 = 0 THEN 'new' ELSE 'old' END AS target_url, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 3 = 0 THEN 2 ELSE 1 END AS generation FROM customer")
def migrations(spark, sf_dir):
    """A new root is prepared beside the live one and takes its place where the fetch succeeded."""
    c = t.table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("registry"), F.col("c_name").alias("name"), "c_custkey")
    state = c.select("registry", "name", F.lit("old").alias("target_url"), F.lit(1).alias("generation"))
    due = ledger.prepare_migration(c.select("registry", "name", F.when(F.col("c_custkey") % 2 == 0, "new").otherwise("old").alias("target_url")), state)
    return ledger.finish_migration(state, due, c.filter("c_custkey % 3 = 0"))


@query("ledger_versions", "SELECT s_suppkey, 'UNVERIFIED' AS verification, TRUE AS no_method FROM supplier")
def ledger_versions(spark, sf_dir):
    out = ledger.migrated(t.table(spark, sf_dir, "supplier").select("s_suppkey"), 1)
    return out.select("s_suppkey", "verification", F.col("fetch_method").isNull().alias("no_method"))


@query("docs_to_discover", """SELECT language, name, target_url FROM (SELECT c_mktsegment AS language, c_name AS name, c_custkey AS k, CASE WHEN c_custkey % 3 = 1 THEN 'https://search.maven.org/a' ELSE 'https://docs.org/a' END AS target_url FROM customer)
    WHERE k % 2 = 0 AND (k % 3 = 0 OR k % 3 = 1) AND (k % 4 <> 0 OR k % 5 = 0 OR (k % 7 = 0 AND k % 6 < 5))""")
def docs_to_discover(spark, sf_dir):
    c, k = t.table(spark, sf_dir, "customer"), F.col("c_custkey")
    key = [F.col("c_mktsegment").alias("registry"), F.col("c_name").alias("name")]
    targets = c.select(
        *key, F.col("c_mktsegment").alias("language"), F.when(k % 3 == 1, "https://search.maven.org/a").otherwise("https://docs.org/a").alias("target_url"),
        F.when(k % 3 == 0, "DOCS_DISCOVERY_REQUIRED").otherwise("READY_FOR_DOCS_CONNECTOR").alias("target_status"), F.when(k % 5 == 0, 9).otherwise(1).alias("resolved_at"),
    )
    authority = c.select(*key, F.when(k % 2 == 0, "AUTHORITY_VERIFIED").otherwise("AUTHORITY_REVIEW").alias("authority_status"), F.lit(1).alias("checked_at"), F.lit("d").alias("documentation_url"))
    seen = c.filter("c_custkey % 4 = 0").select(*key, F.lit(1).alias("target_resolved_at"), F.when(k % 7 == 0, "RETRY").otherwise("SUCCESS").alias("discovery_status"), (k % 6).alias("attempts"), F.lit(None).cast("int").alias("next_retry_at"))
    return stages.to_discover(targets, authority, seen, F.lit(1)).select("language", "name", "target_url")


@query("registry_rows", "SELECT 'src-' || s_suppkey AS source_id, s_name AS title, 'P' || s_suppkey % 4 AS priority FROM supplier")
def registry_rows(spark, sf_dir):
    """Two registries as CSV, read as one."""
    s = t.table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey").cast("string")
    rows = s.select(
        F.concat(F.lit(" src-"), k).alias("source_id"), F.col("s_name").alias("title"), F.lit("economy").alias("domain"), F.lit("p").alias("provider"), F.concat(F.lit("https://x.org/"), k).alias("source_url"), F.lit("A_OPEN").alias("rights_tier"),
        F.lit("OPEN").alias("access_tier"), F.concat(F.lit("P"), (F.col("s_suppkey") % 4).cast("string")).alias("priority"),
    )
    paths = [shared_dir(spark, "registry") for _ in range(2)]
    for i, path in enumerate(paths):
        rows.filter(F.col("source_url").isNotNull() & (F.xxhash64("title") % 2 == 0 if i else F.xxhash64("title") % 2 != 0)).write.option("header", True).csv(path)
    return registry.read_registries(spark, paths).select("source_id", "title", "priority")


@query("registry_problems", "SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'title is empty' ELSE 'source_url is no web address' END AS problem FROM supplier WHERE s_suppkey % 2 = 0 OR s_suppkey % 3 = 0")
def registry_problems(spark, sf_dir):
    k = F.col("s_suppkey")
    rows = t.table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s-"), k.cast("string")).alias("source_id"), F.when(k % 2 == 0, " ").otherwise("t").alias("title"), F.lit("d").alias("domain"), F.lit("p").alias("provider"), F.when((k % 3 == 0) & (k % 2 != 0), "ftp://x").otherwise("https://x").alias("source_url"),
        F.lit("A").alias("rights_tier"), F.lit("O").alias("access_tier"), F.lit("P1").alias("priority"),
    )
    return registry.validate_registry(rows, "s-").select(F.regexp_extract("source_id", "([0-9]+)", 1).cast("long").alias("s_suppkey"), "problem")


@query("sql_passthrough", "SELECT n_regionkey, count(*) AS n FROM nation GROUP BY n_regionkey ORDER BY n_regionkey LIMIT 3")
def sql_passthrough(spark, sf_dir):
    return run_sql(spark, "SELECT n_regionkey, count(*) AS n FROM nation_of_source GROUP BY n_regionkey ORDER BY n_regionkey", {"nation_of_source": t.table(spark, sf_dir, "nation")}, 3)


@query("sources_exercised", "SELECT FALSE AS some_left, TRUE AS all_covered")
def sources_exercised(spark, sf_dir):
    s = t.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("source_id"))
    half, rest = s.filter("source_id % 2 = 0"), s.filter("source_id % 2 = 1")
    return spark.createDataFrame([(technologies.all_exercised(s, half, half), technologies.all_exercised(s, half, rest))], "some_left boolean, all_covered boolean")


@query("documents_classified", f"""WITH t AS ({catalogue._topic_sql()}) SELECT doc_id, primary_domain, confidence AS classification_confidence, CASE WHEN primary_domain <> 'multidomain' THEN 'CLASSIFIED' ELSE 'PARTIAL' END AS classification_status FROM t""")
def documents_classified(spark, sf_dir):
    docs = t.table(spark, sf_dir, "documents").select("doc_id", F.lit("s").alias("source_id"), F.lit("https://x.org").alias("url"), "text")
    source = spark.createDataFrame([("s", "multidomain", None)], "source_id string, domain string, options map<string,string>").withColumns({c: F.lit("p") for c in ("provider", "rights_tier", "access_tier")})
    metadata = technologies.source_metadata(source, "XX", "Nowhere")
    return technologies.classified_documents(docs, metadata, catalogue.TOPICS).select("doc_id", "primary_domain", "classification_confidence", "classification_status")


@query("missing_columns", "SELECT s_suppkey AS source_id, CASE WHEN s_suppkey % 2 = 0 THEN 'url' ELSE 'title,url' END AS missing FROM supplier WHERE s_suppkey % 3 <> 0")
def missing_columns(spark, sf_dir):
    k = F.col("s_suppkey")
    columns = F.array_compact(F.array(F.lit("id"), F.when((k % 2 == 0) | (k % 3 == 0), "title"), F.when(k % 3 == 0, "url"), F.lit("more")))
    rows = t.table(spark, sf_dir, "supplier").select(k.alias("source_id"), columns.alias("columns"))
    return audit.missing_columns(rows, ["id", "title", "url"]).select("source_id", F.array_join("missing", ",").alias("missing"))


@query("utc_times", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS at FROM orders")
def utc_times(spark, sf_dir):
    return t.table(spark, sf_dir, "orders").select("o_orderkey", versions.utc_text(F.to_utc_timestamp(F.col("o_orderdate").cast("timestamp"), "UTC")).alias("at"))


def unmapped_page(discovered: DataFrame, mapped: DataFrame, limit: int) -> DataFrame:
    """The first unmapped discoveries in order, and whether there are more."""
    rest = discovered.join(mapped, "id", "left_anti").orderBy("domain", "title", "id").limit(limit + 1)
    total = rest.agg((F.count(F.lit(1)) > limit).alias("truncated"))
    return rest.orderBy("domain", "title", "id").limit(limit).join(total, how="cross")  # one row


@query("unmapped_page", "SELECT o_orderkey AS id, o_orderpriority AS domain, TRUE AS truncated FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') ORDER BY o_orderpriority, o_orderstatus, o_orderkey LIMIT 20")
def unmapped(spark, sf_dir):
    o = t.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("domain"), F.col("o_orderstatus").alias("title"))
    mapped = t.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    return unmapped_page(o, mapped, 20).select("id", "domain", "truncated")


# --- feeds ----------------------------------------------------------------------------------------


def _pages(rows: DataFrame, element, place: str, size: int = 500) -> DataFrame:
    """(page, payload): feed pages of ``element`` under ``place``, in order of ``k``."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct("k", element.alias("e")))), lambda x: x["e"])
    by = rows.groupBy(F.floor(F.col("k") / size).alias("page")).agg(listed.alias("x"))
    return by.select("page", F.parse_json(F.to_json(F.struct(F.col("x").alias(place)))).alias("payload"))


@query("feed_changes", """SELECT 'npm-changes' AS source, 'u' || user_id AS name, event_id % 3 = 0 AS deleted, 60 AS priority, event_id // 500 * 1000000 + event_id % 500 AS ord FROM events WHERE event_id % 7 <> 0
    UNION ALL SELECT 'packagist-changes', 'u/' || user_id, event_id % 2 = 0, 60, event_id // 500 * 1000000 + event_id % 500 FROM events WHERE event_id % 3 <> 2""")
def feed_changes(spark, sf_dir):
    """Ordered changes of two registries; documents that are no packages and other actions are left out."""
    e = t.table(spark, sf_dir, "events").select(F.col("event_id").alias("k"), F.col("user_id").cast("string").alias("u"))
    npm = F.struct(F.when(F.col("k") % 7 == 0, "_design/x").otherwise(F.concat(F.lit("u"), "u")).alias("id"), (F.col("k") % 3 == 0).alias("deleted"))
    action = F.when(F.col("k") % 3 == 2, "resync").when(F.col("k") % 2 == 0, "Delete").otherwise("update")
    packagist = F.struct(action.alias("type"), F.concat(F.lit("u/"), "u", F.lit("~dev")).alias("package"))
    both = feeds.feed_rows(_pages(e, npm, "results"), "npm-changes").unionByName(feeds.feed_rows(_pages(e, packagist, "actions"), "packagist-changes"))
    return both.select("source", "name", "deleted", "priority", "ord")


@query("feed_names", """SELECT 'pypi.org' AS registry, 'pypi-simple' AS source, c_name AS name, 10 AS priority FROM customer UNION ALL SELECT 'pub.dev', 'pubdev-package-names', c_name, 30 FROM customer UNION ALL SELECT 'npmjs.org', 'npm-all-docs', c_name, 15 FROM customer
    UNION ALL SELECT 'packagist.org', 'packagist-popular', c_name, least(100, 40 + least(40, c_custkey * 9000 // 100000) + least(20, c_custkey * 7 // 100))::INT FROM customer UNION ALL SELECT 'packagist.org', 'packagist-all', c_name, 20 FROM customer
    UNION ALL SELECT 'rubygems.org', 'rubygems-latest', c_name, 45 FROM customer""")
def feed_names(spark, sf_dir):
    c = t.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), "c_name")
    name = F.col("c_name")
    popular = F.struct(name.alias("name"), (F.col("k") * 9000).alias("downloads"), (F.col("k") * 7).alias("favers"))
    keyed = c.groupBy(F.floor(F.col("k") / 500).alias("page")).agg(F.parse_json(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("c_name", F.struct(F.lit("library").alias("type"))))).alias("package")))).alias("payload"))
    bare = _pages(c, F.struct(name.alias("name")), "x").select("page", F.expr("try_variant_get(payload, '$.x', 'variant')").alias("payload"))
    every = [
        feeds.feed_rows(_pages(c, F.struct(name.alias("name")), "projects"), "pypi-simple"), feeds.feed_rows(_pages(c, name, "packages"), "pubdev-package-names"), feeds.feed_rows(_pages(c, F.struct(name.alias("key")), "rows"), "npm-all-docs"),
        feeds.feed_rows(_pages(c, popular, "packages"), "packagist-popular"), feeds.feed_rows(keyed, "packagist-all"), feeds.feed_rows(bare, "rubygems-latest"),
    ]
    out = every[0]
    for more in every[1:]:
        out = out.unionByName(more)
    return out.select("registry", "source", "name", "priority")


@query("feed_cursors", "SELECT CAST(max(event_id) AS VARCHAR) AS seq, 'https://x.org/2' AS next, '77' AS serial, TRUE AS resync FROM events")
def feed_cursors(spark, sf_dir):
    e = t.table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 500).alias("page"), "event_id")
    npm = e.groupBy("page").agg(F.parse_json(F.to_json(F.struct(F.max("event_id").alias("last_seq")))).alias("payload"))
    one = lambda j: spark.createDataFrame([(0, "{}"), (1, j)], "page int, j string").select("page", F.expr("parse_json(j)").alias("payload"))
    row = (feeds.feed_cursor(npm, "npm-changes"), feeds.feed_cursor(one('{"nextUrl": "https://x.org/2"}'), "pubdev-package-names"), feeds.feed_cursor(one('{"meta": {"_last-serial": 77}}'), "pypi-simple"), feeds.needs_resync(one('{"actions": [{"type": "Resync"}]}')))
    return spark.createDataFrame([row], "seq string, next string, serial string, resync boolean")


@query("public_queue", t.with_derived("sources") + """ SELECT source_id, domain, rights_tier, 'LOCAL_CACHE_ONLY' AS raw_action FROM sources WHERE NOT starts_with(rights_tier, 'D_')""")
def public_queue(spark, sf_dir):
    s = t.derived(spark, sf_dir, "sources").withColumn("source_url", F.lit("https://x.org"))
    return feeds.public_queue(s).select("source_id", "domain", "rights_tier", "raw_action")
