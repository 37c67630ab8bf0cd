"""The catalogue of queries: each operator over the driver's tables, with its equivalent for the oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirlake.functions import markup, scoring, text, urls, versions
from weirlake.functions.bind import once
from weirlake.operators import audit, changes, claims, corpus, ledger, sinks, stages, technologies
from weirlake.operators.staging import spread
from weirlake.plans import tables as t
from weirlake.plans.query import search_documents
from weirlake.plans.registered import ORACLES, QUERIES, query
from weirlake.sources import adapters, records, registry, web
from weirlake.streaming.change_feed import windowed_counts

def inline(name: str, columns: str, rows: list[tuple], outputs: Callable[[], dict], sql: dict[str, str], shared: Callable[[], Column] | None = None):
    """A query of column expressions over fixed rows; ``sql`` gives the expressions of the oracle.

    Columns need a running session, so ``outputs`` makes them when the query is asked for. ``shared`` is
    evaluated once, as ``shared``.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = spark.createDataFrame(rows, columns)
        df = once(df, {"shared": shared()}) if shared else df
        return df.select(*(c.alias(n) for n, c in outputs().items()))

    QUERIES[name] = run
    ORACLES[name] = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in sql.items()) + f" FROM {t.values_sql(columns, rows)}"


# --- text -----------------------------------------------------------------------------------------

_CLEAN = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]', '', 'g'),
    '\r\n?', chr(10), 'g'), '[ \t]+', ' ', 'g'), '(?m)^[ \t]+|[ \t]+$', '', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), '^\n+|\n+$', '', 'g')"""
_CLEANED = f"SELECT doc_id, {_CLEAN} AS c FROM documents"
_FOLD = "replace(lower(c), 'ß', 'ss')"
_SCORED = rf"""SELECT *, CASE WHEN length(c) = 0 THEN 0.0::DOUBLE WHEN length(c) < 80 OR len(w) < 12 THEN 0.15::DOUBLE ELSE round(greatest(0.0::DOUBLE, least(1.0::DOUBLE,
    0.45::DOUBLE * ((length(c) - length(regexp_replace(c, '\p{{L}}+', '', 'g')))::DOUBLE / greatest(length(c), 1))
    + 0.35::DOUBLE * least(1.0::DOUBLE, len(list_distinct(w))::DOUBLE / greatest(len(w), 1) * 2.0::DOUBLE)
    + 0.20::DOUBLE * least(1.0::DOUBLE, log10(greatest(length(c), 10)::DOUBLE) / 4.0::DOUBLE))), 4) END AS quality, sha256({_FOLD}) AS fingerprint
    FROM (SELECT doc_id, c, list_filter(string_split_regex({_FOLD}, '[^\p{{L}}\p{{N}}_]+'), lambda x: x <> '') AS w FROM ({_CLEANED}))"""


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(t.table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("doc_clean_stats", f"SELECT doc_id, length(c) AS n_chars, md5(c) AS digest FROM ({_CLEANED})")
def doc_clean_stats(spark, sf_dir):
    c = once(_docs(spark, sf_dir), {"c": text.clean_text(F.col("text"))})
    return c.select("doc_id", F.char_length("c").cast("long").alias("n_chars"), F.md5(F.encode("c", "UTF-8")).alias("digest"))


@query("doc_quality", f"SELECT doc_id, quality, quality >= 0.35 AS acceptable FROM ({_SCORED})")
def doc_quality(spark, sf_dir):
    return corpus.scored(_docs(spark, sf_dir)).select("doc_id", "quality", text.acceptable(F.col("quality")).alias("acceptable"))


@query("doc_fingerprint_dedup", f"SELECT min(doc_id) AS doc_id, fingerprint FROM ({_SCORED}) GROUP BY fingerprint")
def doc_fingerprint_dedup(spark, sf_dir):
    rows = _docs(spark, sf_dir).select("doc_id", text.fingerprint(text.clean_text(F.col("text"))).alias("fingerprint"))
    return rows.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "fingerprint")


@query("corpus_build", f"SELECT min(doc_id) AS doc_id, fingerprint AS sha256, any_value(length(c)) AS n_chars FROM ({_SCORED}) WHERE quality >= 0.35 GROUP BY fingerprint")
def corpus_build(spark, sf_dir):
    return corpus.build_corpus(_docs(spark, sf_dir), "doc_id").select("doc_id", "sha256", F.char_length("text").cast("long").alias("n_chars"))


@query("corpus_stats", f"""SELECT (SELECT count(*) FROM documents) AS documents_seen, count(*) FILTER (NOT good)::BIGINT AS rejected_quality,
    count(DISTINCT fingerprint) FILTER (good) AS documents_written, count(*) FILTER (good) - count(DISTINCT fingerprint) FILTER (good) AS duplicates
    FROM (SELECT fingerprint, quality >= 0.35 AS good FROM ({_SCORED}))""")
def corpus_stats(spark, sf_dir):
    return corpus.corpus_stats(_docs(spark, sf_dir), "doc_id")


@query("corpus_shards", "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS rank, (row_number() OVER (ORDER BY doc_id) - 1) // 100 AS shard FROM documents")
def corpus_shards(spark, sf_dir):
    ranked = corpus.global_rank(t.table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 256)
    return ranked.select("doc_id", "rank", F.floor(F.col("rank") / 100).cast("long").alias("shard"))


def _chunk_sql(size: int, overlap: int) -> str:
    step = size - overlap
    return f"""SELECT doc_id, i::BIGINT AS chunk_index, sha256(doc_id || '|' || i) AS chunk_id, length(substring(c, i * {step} + 1, {size})) AS n_chars, md5(substring(c, i * {step} + 1, {size})) AS digest
        FROM (SELECT doc_id, c, unnest(range(0, greatest(ceil((length(c) - {size}) / {step}.0), 0)::BIGINT + 1)) AS i FROM ({_CLEANED}) WHERE length(c) > 0)"""


def _chunks(spark, sf_dir, size, overlap):
    rows = once(_docs(spark, sf_dir), {"cleaned": text.clean_text(F.col("text"))})
    out = corpus.chunked(rows, "doc_id", size=size, overlap=overlap)
    return out.select("doc_id", F.col("chunk_index").cast("long").alias("chunk_index"), "chunk_id", F.col("n_chars").cast("long").alias("n_chars"), F.md5(F.encode("chunk", "UTF-8")).alias("digest"))


query("doc_chunks", _chunk_sql(3500, 250))(lambda s, d: _chunks(s, d, 3500, 250))
query("doc_chunks_docs", _chunk_sql(5000, 300))(lambda s, d: _chunks(s, d, 5000, 300))
query("doc_chunks_script", _chunk_sql(2200, 250))(lambda s, d: _chunks(s, d, 2200, 250))

#: A taxonomy is a parameter; this one suits the generated texts.
TOPICS = {"articles": (" the ", " der ", " la "), "verbs": ("tion", "ing"), "joints": (" und ", " et ", " of ", " de "), "rare": ("licensed", "token")}


def _topic_sql() -> str:
    n = "trim(regexp_replace(lower(coalesce(text, '')), '\\s+', ' ', 'g'))"
    score = lambda ws: " + ".join(f"(length(n) - length(replace(n, '{w}', ''))) // {len(w)}" for w in ws)
    parts = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS name, {score(ws)} AS score FROM n" for k, ws in TOPICS.items())
    return f"""WITH n AS (SELECT doc_id, {n} AS n FROM documents), s AS ({parts}), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, name) AS k FROM s WHERE score > 0)
        SELECT d.doc_id, coalesce(max(name) FILTER (k = 1), 'multidomain') AS primary_domain, coalesce(string_agg(name, ',' ORDER BY k) FILTER (k BETWEEN 2 AND 4), '') AS secondary,
        CASE WHEN max(score) IS NULL THEN 0.5 ELSE least(0.98, 0.65 + least(max(score) FILTER (k = 1), 6) * 0.05) END::DOUBLE AS confidence FROM documents d LEFT JOIN r USING (doc_id) GROUP BY d.doc_id"""


@query("doc_domains", _topic_sql())
def doc_domains(spark, sf_dir):
    found = once(_docs(spark, sf_dir), {"d": text.infer_domains(F.lit("multidomain"), F.col("text"), TOPICS)})
    return found.select("doc_id", F.col("d.primary").alias("primary_domain"), F.array_join("d.secondary", ",").alias("secondary"), "d.confidence")


def _doc_type_sql() -> str:
    n = lambda e: f"trim(regexp_replace(lower(coalesce({e}, '')), '\\s+', ' ', 'g'))"
    q = lambda w: w.replace("'", "''")
    whens = " ".join("WHEN " + " OR ".join(f"contains(hay, '{q(w)}')" for w in ws) + f" THEN '{k}'" for k, ws in text.DOCUMENT_RULES)
    data = " OR ".join(f"contains(u, '{w}')" for w in text.DATASET_TOKENS)
    return f"SELECT page_id, CASE {whens} WHEN {data} THEN 'DATASET' ELSE 'OTHER' END AS document_type FROM (SELECT page_id, ' ' || {n('url')} || ' ' || {n('left(html, 12000)')} || ' ' AS hay, {n('url')} AS u FROM pages)"


@query("doc_type", _doc_type_sql())
def doc_type(spark, sf_dir):
    return t.table(spark, sf_dir, "pages").select("page_id", text.infer_document_type(F.col("url"), F.col("html")).alias("document_type"))


@query("doc_title", r"""SELECT doc_id, left(list_filter(list_transform(string_split_regex(coalesce(text, ''), '\r\n|[\n\r]'), lambda x: regexp_replace(regexp_replace(x, '\s+', ' ', 'g'), '^[ |\t-]+|[ |\t-]+$', '', 'g')), lambda x: length(x) >= 4)[1], 300) AS title FROM documents""")
def doc_title(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", text.title(F.col("text")).alias("title"))


@query("training_text", """SELECT o_orderkey, 'o_orderkey: ' || o_orderkey || chr(10) || 'o_orderstatus: ' || o_orderstatus || chr(10) || 'o_orderpriority: ' || o_orderpriority AS body FROM orders""")
def training_text(spark, sf_dir):
    o = t.table(spark, sf_dir, "orders")
    fields = {c: F.col(c) for c in ("o_orderkey", "o_orderstatus", "o_orderpriority")} | {"__hidden": F.lit("x"), "empty": F.lit("")}
    return o.select("o_orderkey", text.training_text(None, fields).alias("body"))


@query("search_docs", "SELECT doc_id, source FROM documents WHERE contains(lower(text), 'token') OR contains(lower(text), 'licensed') ORDER BY doc_id LIMIT 100")
def search_docs(spark, sf_dir):
    return search_documents([t.table(spark, sf_dir, "documents")], "a Token of licensed", max_rows=100).select("doc_id", "source")


@query("part_names",
    r"""SELECT p_partkey, CASE WHEN n = '' THEN 'unknown' ELSE n END AS safe, 'part_' || left(lower(regexp_replace(regexp_replace(p_type, '[^a-zA-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')), 100) AS table_name FROM (SELECT *, regexp_replace(regexp_replace(trim(p_name || ' ('), '[^a-zA-Z0-9_.-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') AS n FROM part)""")
def part_names(spark, sf_dir):
    p = t.table(spark, sf_dir, "part")
    return p.select("p_partkey", text.safe_name(F.concat("p_name", F.lit(" ("))).alias("safe"), text.table_name(F.col("p_type"), "part_").alias("table_name"))


@query("source_slugs", r"""SELECT c_custkey, 'techdocs-' || left(regexp_replace(lower(c_mktsegment), '[^a-z0-9]+', '-', 'g'), 20) || '-' || left(trim(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), '-'), 48) || '-' || left(sha256(c_mktsegment || chr(0) || c_name), 12) AS slug FROM customer""")
def source_slugs(spark, sf_dir):
    return t.table(spark, sf_dir, "customer").select("c_custkey", text.source_slug(F.col("c_mktsegment"), F.col("c_name")).alias("slug"))


@query("corpus_union", "SELECT '_a' AS _prov_table, conv_id, turn, -1 AS page_id FROM conversations UNION ALL SELECT '_b', -1, -1, page_id FROM pages")
def corpus_union(spark, sf_dir):
    both = corpus.union_tables({"_a": t.table(spark, sf_dir, "conversations").select("conv_id", "turn"), "_b": t.table(spark, sf_dir, "pages").select("page_id")})
    return both.select("_prov_table", "conv_id", "turn", "page_id").fillna(-1)


# --- markup and URLs ------------------------------------------------------------------------------

_PAGE_TEXT = r"""trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
    '(?is)<script.*?>.*?</script>', ' ', 'g'), '(?is)<style.*?>.*?</style>', ' ', 'g'), '(?is)<noscript.*?>.*?</noscript>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&#x27;', ''''), '&apos;', ''''), '&nbsp;', ' '), '&amp;', '&'), '\s+', ' ', 'g'))"""


@query("page_text", f"SELECT page_id, length(x) AS n_chars, md5(x) AS digest FROM (SELECT page_id, {_PAGE_TEXT} AS x FROM pages)")
def page_text(spark, sf_dir):
    p = t.table(spark, sf_dir, "pages").select("page_id", markup.html_text_regex(F.col("html")).alias("x"))
    return p.select("page_id", F.char_length("x").cast("long").alias("n_chars"), F.md5(F.encode("x", "UTF-8")).alias("digest"))


@query("page_text_parsed")
def page_text_parsed(spark, sf_dir):
    return t.table(spark, sf_dir, "pages").select("page_id", text.clean_text(markup.html_text_parsed(F.col("html"))).alias("body"))


_LINKS = r"""regexp_extract_all(coalesce(html, ''), '(?is)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']', 1)"""


@query("page_links", f"SELECT page_id, len(l) AS n_links, md5(array_to_string(l, ' ')) AS digest FROM (SELECT page_id, list_filter(list_transform({_LINKS}, lambda x: replace(trim(x), '&amp;', '&')), lambda x: x <> '') AS l FROM pages)")
def page_links(spark, sf_dir):
    p = t.table(spark, sf_dir, "pages").select("page_id", markup.html_links(F.col("html")).alias("l"))
    return p.select("page_id", F.size("l").cast("long").alias("n_links"), F.md5(F.encode(F.array_join("l", " "), "UTF-8")).alias("digest"))


_HOST = r"lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1))"
_PATH = r"regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
_QUERY = r"regexp_extract(url, '\?([^#]*)', 1)"


@query("url_canonical", rf"""SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) || '://' || {_HOST} || CASE WHEN p IN ('', '/') THEN '/' ELSE regexp_replace(p, '/+$', '') END || CASE WHEN k = '' THEN '' ELSE '?' || k END AS canonical
    FROM (SELECT *, {_PATH} AS p, array_to_string(list_filter(string_split({_QUERY}, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(ref|source|campaign|mc_cid|mc_eid)(=|$)|^(utm_|ref_)')), '&') AS k FROM pages)""")
def url_canonical(spark, sf_dir):
    return t.table(spark, sf_dir, "pages").select("page_id", urls.canonical_documentation_url(F.col("url")).alias("canonical"))


@query("url_crawl_docs", rf"""SELECT page_id, regexp_replace(url, '#.*$', '') AS crawl, regexp_extract(url, '^([^?#]*)', 1) || CASE WHEN k = '' THEN '' ELSE '?' || k END AS docs
    FROM (SELECT *, array_to_string(list_filter(string_split({_QUERY}, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_source|utm_medium|utm_campaign|utm_term|utm_content|utm_id|gclid|fbclid)(=|$)')), '&') AS k FROM pages)""")
def url_crawl_docs(spark, sf_dir):
    return t.table(spark, sf_dir, "pages").select("page_id", urls.crawl_url(F.col("url")).alias("crawl"), urls.docs_url(F.col("url")).alias("docs"))


@query("url_scope", rf"""SELECT page_id, regexp_matches({_PATH}, '^/(en|fr)/') AND {_HOST} = 'www.ththhe.example.com' AND NOT regexp_matches({_QUERY}, '^(q|query|search)=') AS in_scope,
    {_HOST} = 'www.ththhe.example.com' AND (regexp_replace({_PATH}, '/+$', '') = '/en' OR starts_with({_PATH}, '/en/')) AS in_subtree FROM pages""")
def url_scope(spark, sf_dir):
    u = F.col("url")
    return t.table(spark, sf_dir, "pages").select("page_id", urls.in_scope(u, "www.ththhe.example.com", ("/en/", "/fr/")).alias("in_scope"), urls.within_subtree(u, "www.ththhe.example.com", "/en/").alias("in_subtree"))


@query("site_links", rf"""WITH l AS (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS base, unnest({_LINKS}) AS h FROM pages)
    SELECT page_id, count(DISTINCT base || regexp_replace(trim(replace(h, '&amp;', '&')), '#.*$', '')) AS n_links FROM l WHERE starts_with(trim(h), '/') AND NOT starts_with(trim(h), '//')
    AND NOT regexp_matches(regexp_replace(h, '[?#].*$', ''), '(?i)\.(7z|avi|bin|bmp|css|doc|docx|dta|exe|gif|gz|ico|jpeg|jpg|js|mp3|mp4|odt|pbf|png|por|ppt|pptx|rar|rdata|rds|sas7bdat|sav|svg|tar|webp|woff|woff2|xpt|zip)$') GROUP BY page_id""")
def site_links(spark, sf_dir):
    p = t.table(spark, sf_dir, "pages")
    local = F.filter(markup.html_links(F.col("html")), lambda h: h.startswith("/") & ~h.startswith("//"))
    return p.select("page_id", F.size(urls.same_host_links(F.col("url"), local)).cast("long").alias("n_links")).filter("n_links > 0")


@query("host_counts", rf"SELECT {_HOST} AS host, count(*) AS n FROM pages WHERE url IS NOT NULL GROUP BY 1")
def host_counts(spark, sf_dir):
    return t.table(spark, sf_dir, "pages").filter("url is not null").groupBy(urls.part(F.col("url"), "host").alias("host")).agg(F.count(F.lit(1)).alias("n"))


# --- small fixed inputs: URLs, versions, decisions ------------------------------------------------

_ADDRESSES = [
    (1, "git+https://www.github.com/Own/Repo.git"), (2, "git@github.com:own/repo.git"), (3, "git@gitlab.com:own/repo"), (4, "http://Example.org//a//b/"),
    (5, "https://github.com/own/repo/"), (6, "not a url"), (7, ""), (8, None), (9, "https://gitlab.com/x/y.git"),
]
inline("repository_urls", "id int, url string", _ADDRESSES, lambda: {"id": F.col("id"), "repository": urls.normalize_repository_url(F.col("url"))}, {
    "id": "id", "repository": "CASE id WHEN 1 THEN 'https://github.com/Own/Repo' WHEN 2 THEN 'https://github.com/own/repo' WHEN 3 THEN 'https://gitlab.com/own/repo' WHEN 4 THEN 'https://example.org/a/b' "
    "WHEN 5 THEN 'https://github.com/own/repo' WHEN 6 THEN 'not a url' WHEN 9 THEN 'https://gitlab.com/x/y' END"})

inline("upload_and_landing", "id int, url string", [
    (1, "https://x.org/uploads/"), (2, "https://x.org/uploads/publications"), (3, "https://x.org/wp-content/uploads/a.pdf"), (4, "https://x.org/up/a"), (5, "https://search.maven.org/artifact/a"), (6, "https://docs.x.org/guide/a.md"),
], lambda: {
    "id": F.col("id"), "upload": urls.is_upload_directory(F.col("url")), "landing": urls.is_landing(F.col("url")), "doc_like": urls.doc_like_path(urls.part(F.col("url"), "path")), "doc_signal": urls.doc_signal(F.col("url")),
}, {"id": "id", "upload": "id IN (1, 2)", "landing": "id = 5", "doc_like": "id = 6", "doc_signal": "id = 6"})

inline("git_link_scores", "id int, url string, label string", [
    (1, "https://github.com/o/r/edit/main/docs/a.md", "Edit this page"), (2, "https://github.com/o/r/blob/main/src/a.py", "source"), (3, "https://github.com/o/r/tree/main/guide", ""), (4, "https://github.com/o/r", "GitHub"),
    (5, "https://github.com/o", "x"), (6, "https://example.org/o/r", "edit page"),
], lambda: {"id": F.col("id"), "score": urls.git_link_score(F.col("url"), F.col("label")).cast("double")}, {"id": "id", "score": "(CASE id WHEN 1 THEN 15 + 85 + 35 + 25 WHEN 2 THEN 15 + 75 + 15 - 45 WHEN 3 THEN 15 + 65 + 25 WHEN 4 THEN 15 + 15 END)::DOUBLE"})

inline("package_urls", "id int, registry string, name string, version string", [
    (1, "npm", "@scope/pkg", "1.0.0"), (2, "maven", "org.a:b", "2.0+x"), (3, "pypi", "a b", None), (4, "golang", "github.com/a/b", "v1"), (5, "unknown", "a", "1"), (6, "Cargo ", "serde", ""),
], lambda: {"id": F.col("id"), "registry": urls.normalize_registry(F.col("registry")), "purl": urls.build_purl(F.col("registry"), F.col("name"), F.col("version"))}, {
    "id": "id", "registry": "CASE id WHEN 1 THEN 'npmjs.org' WHEN 2 THEN 'repo1.maven.org' WHEN 3 THEN 'pypi.org' WHEN 4 THEN 'proxy.golang.org' WHEN 5 THEN 'unknown' ELSE 'crates.io' END",
    "purl": "CASE id WHEN 1 THEN 'pkg:npm/%40scope/pkg@1.0.0' WHEN 2 THEN 'pkg:maven/org.a/b@2.0+x' WHEN 3 THEN 'pkg:pypi/a%20b' WHEN 4 THEN 'pkg:golang/github.com/a/b@v1' WHEN 6 THEN 'pkg:cargo/serde' END"})

_VERSIONS = [
    (1, "1.10.0"), (2, "1.9.9"), (3, "2.0.0-rc.1"), (4, "v3.1.0"), (5, "dev-main"), (6, "1.0.0+build"), (7, "v1.2.3+incompatible"), (8, "1.0alpha1"), (9, "5.0.1.RELEASE"), (10, "2.0b"), (11, "2.0b3"), (12, ""), (13, "1.2.3.4.5"),
]
inline("version_flags", "id int, v string", _VERSIONS, lambda: {
    "id": F.col("id"), "prerelease": versions.is_prerelease(F.col("v")), "nuget": F.array_join(versions.nuget_key(F.col("v")).cast("array<string>"), "."), "go": F.array_join(versions.go_key(F.col("v")).cast("array<string>"), "."),
    "maven_stable": versions.is_maven_stable(F.col("v")), "numbers": F.array_join(versions.version_key(F.col("v")).cast("array<string>"), "."), "strategy": versions.ref_strategy(F.col("v")),
}, {
    "id": "id", "prerelease": "id IN (3, 5, 12)", "nuget": "CASE id WHEN 1 THEN '1.10.0.0' WHEN 2 THEN '1.9.9.0' WHEN 6 THEN '1.0.0.0' END", "go": "CASE id WHEN 4 THEN '3.1.0' WHEN 7 THEN '1.2.3' END", "maven_stable": "id NOT IN (3, 5, 8, 11, 12)",
    "numbers": "array_to_string(list_transform(range(1, 7), lambda i: coalesce(TRY_CAST(regexp_extract_all(v, '\\d+')[i] AS BIGINT), 0)), '.')",
    "strategy": "CASE WHEN regexp_matches(v, '^\\d+\\.x$') THEN 'major_branch' WHEN regexp_matches(v, '^\\d+\\.\\d+$') THEN 'minor_branch' WHEN regexp_matches(v, '\\d') THEN 'release_tag' ELSE 'fixed_ref' END"})

@query("latest_stable", """WITH v AS (SELECT o_custkey AS k, (o_orderkey % 5) || '.' || (o_orderkey % 12) || '.' || (o_orderkey % 3) || CASE WHEN o_orderkey % 4 = 0 THEN '-beta' ELSE '' END AS v, o_orderkey % 5 AS a, o_orderkey % 12 AS b, o_orderkey % 3 AS c, o_orderkey % 4 = 0 AS pre FROM orders)
    SELECT k, max_by(v, a * 10000 + b * 100 + c) AS latest FROM v WHERE NOT pre GROUP BY k""")
def latest_stable(spark, sf_dir):
    o = t.table(spark, sf_dir, "orders")
    s = lambda n: (F.col("o_orderkey") % n).cast("string")
    v = F.concat(s(5), F.lit("."), s(12), F.lit("."), s(3), F.when(F.col("o_orderkey") % 4 == 0, "-beta").otherwise(""))
    return o.groupBy(F.col("o_custkey").alias("k")).agg(F.collect_set(v).alias("vs")).select("k", versions.latest_stable(F.col("vs")).alias("latest")).filter("latest is not null")


inline("size_and_time", "id int, size string, ts string", [
    (1, "12.5 MB", "2024-01-02T03:04:05Z"), (2, "1KB", "2024-01-02T03:04:05.123456789Z"), (3, "7", "2024-01-02T03:04:05.5Z"), (4, "x", "yesterday"), (5, None, None), (6, "2 gb", "2024-13-02T03:04:05Z"),
], lambda: {"id": F.col("id"), "bytes": versions.size_bytes(F.col("size")).cast("double"), "nanos": versions.nanosecond_key(F.col("ts"))}, {
    "id": "id", "bytes": "(CASE id WHEN 1 THEN 13107200 WHEN 2 THEN 1024 WHEN 3 THEN 7 WHEN 6 THEN 2147483648 END)::DOUBLE",
    "nanos": "CASE id WHEN 1 THEN '2024-01-02T03:04:05.000000000Z' WHEN 2 THEN '2024-01-02T03:04:05.123456789Z' WHEN 3 THEN '2024-01-02T03:04:05.500000000Z' WHEN 6 THEN '2024-13-02T03:04:05.000000000Z' ELSE '' END"})

inline("index_names", "id int, path string, uinfo string, module string", [
    (1, "se/rd/serde", "g|a|1|NA|jar", "github.com/Azure/go"), (2, "3/a/abc", "g|a||NA|jar", "x"), (3, "config.json", "g|a|1", "A"), (4, "1/a", "g|a|1|c|pom|x", ""), (5, ".github/x", None, None), (6, "se/rd/x/y", "", "b"),
], lambda: {"id": F.col("id"), "crate": versions.crate_name(F.col("path")), "artifact": versions.uinfo(F.col("uinfo"))["artifact_id"], "escaped": versions.go_proxy_escape(F.col("module"))}, {
    "id": "id", "crate": "CASE id WHEN 1 THEN 'serde' WHEN 2 THEN 'abc' WHEN 4 THEN 'a' END", "artifact": "CASE WHEN id IN (1, 4) THEN 'a' END", "escaped": "CASE id WHEN 1 THEN 'github.com/!azure/go' WHEN 3 THEN '!a' ELSE module END"})

_EVIDENCE = [(i, "https://github.com/a/b" if i & 1 else None, ("https://github.com/a/b.git" if i & 2 else "https://github.com/c/d") if i & 4 else None, "https://h.org" if i & 8 else None, "https://d.org" if i & 16 else "", "1.0" if i & 32 else None) for i in range(64)]
_OFFICIAL = "(CASE WHEN rr IS NOT NULL THEN 40 ELSE 0 END + CASE WHEN dr IS NULL THEN 0 WHEN rr IS NOT NULL AND (id & 2) > 0 THEN 30 ELSE 10 END + CASE WHEN hp IS NOT NULL THEN 5 ELSE 0 END + CASE WHEN dc <> '' THEN 15 ELSE 0 END + CASE WHEN ver IS NOT NULL THEN 10 ELSE 0 END)"
def _score():
    return scoring.officiality(*(F.col(c) for c in ("rr", "dr", "hp", "dc", "ver")))


inline("officiality", "id int, rr string, dr string, hp string, dc string, ver string", _EVIDENCE, lambda: {
    "id": F.col("id"), "score": F.col("shared")["score"], "status": scoring.officiality_status(F.col("shared")["score"]), "n_evidence": F.size(F.col("shared")["evidence"]),
}, {
    "id": "id", "score": _OFFICIAL, "status": f"CASE WHEN {_OFFICIAL} >= 80 THEN 'VERIFIED_OFFICIAL' WHEN {_OFFICIAL} >= 55 THEN 'PROBABLE_OFFICIAL' WHEN {_OFFICIAL} >= 30 THEN 'CANDIDATE' ELSE 'UNVERIFIED' END",
    "n_evidence": "(rr IS NOT NULL)::INT + (dr IS NOT NULL)::INT + (hp IS NOT NULL)::INT + (dc <> '')::INT + (ver IS NOT NULL)::INT"}, _score)

_REPOS = [None, "https://github.com/a/b", "https://github.com/c/d"]
_CROSS = [(27 * v + 9 * i + 3 * j + k, _REPOS[i], _REPOS[j], _REPOS[k], "1.0" if v else None, v) for v in (0, 1) for i in range(3) for j in range(3) for k in range(3)]


def _auth():
    return scoring.authority_decision(F.col("n"), F.col("e"), F.col("d"), F.lit("https://h.org"), F.lit("https://d.org"), F.col("ver"), F.lit(True), F.col("errs"))


_MATCH, _CONFLICT = "coalesce(n = e, FALSE) OR coalesce(n = d, FALSE)", "coalesce(n <> e, FALSE) OR coalesce(n <> d, FALSE) OR coalesce(e <> d, FALSE)"
_RAW = f"least(100, (CASE WHEN coalesce(n, e, d) IS NOT NULL THEN 40 ELSE 0 END) + (CASE WHEN ({_MATCH}) OR coalesce(e = d, FALSE) THEN (CASE WHEN ({_MATCH}) OR coalesce(n, e, d) = e THEN 30 ELSE 10 END) ELSE 0 END) + 20 + (CASE WHEN ver IS NOT NULL THEN 10 ELSE 0 END) + 10)"
_AUTH_SCORE = f"CASE WHEN {_CONFLICT} THEN least(79, {_RAW}) ELSE {_RAW} END"
inline("authority_decisions", "id int, n string, e string, d string, ver string, errs int", _CROSS, lambda: {
    "id": F.col("id"), "repository": F.col("shared")["repository"], "match": F.col("shared")["match"], "conflict": F.col("shared")["conflict"], "score": F.col("shared")["score"], "status": F.col("shared")["status"],
}, {
    "id": "id", "repository": "coalesce(n, e, d)", "match": _MATCH, "conflict": _CONFLICT, "score": _AUTH_SCORE,
    "status": f"CASE WHEN {_CONFLICT} THEN 'AUTHORITY_CONFLICT' WHEN ({_AUTH_SCORE}) >= 80 AND ({_MATCH}) THEN 'AUTHORITY_VERIFIED' WHEN errs > 0 THEN 'AUTHORITY_PARTIAL_RETRY' WHEN ({_AUTH_SCORE}) >= 55 THEN 'AUTHORITY_PROBABLE' ELSE 'AUTHORITY_REVIEW' END"}, _auth)


def _tgt():
    return scoring.documentation_target(F.col("dc"), F.col("w"), F.col("r"))


inline("documentation_targets", "id int, dc string, w string, r string", [
    (1, "https://github.com/a/b/wiki", None, "git@github.com:A/b.git"), (2, "https://docs.x.org/", "https://x.org", None), (3, "https://y.io", "https://x.org", None), (4, None, "https://x.org/?utm_source=a", "https://github.com/a/b"),
    (5, "", None, "https://github.com/a/b"), (6, None, None, None),
], lambda: {"id": F.col("id"), "url": F.col("shared")["url"], "kind": F.col("shared")["kind"], "confidence": F.col("shared")["confidence"]}, {
    "id": "id", "url": "CASE id WHEN 1 THEN 'https://github.com/a/b/wiki' WHEN 2 THEN 'https://docs.x.org/' WHEN 3 THEN 'https://y.io/' WHEN 4 THEN 'https://x.org/' WHEN 5 THEN 'https://github.com/a/b' END",
    "kind": "CASE WHEN id < 4 THEN 'DOCUMENTATION_URL' WHEN id = 4 THEN 'OFFICIAL_WEBSITE_DISCOVERY' WHEN id = 5 THEN 'CANONICAL_REPOSITORY_DISCOVERY' ELSE 'MISSING' END",
    "confidence": "CASE id WHEN 1 THEN 'VERIFIED_REPOSITORY_RELATION' WHEN 2 THEN 'VERIFIED_WEBSITE_RELATION' WHEN 3 THEN 'AUTHORITY_DERIVED' WHEN 6 THEN 'MISSING' ELSE 'DISCOVERY_REQUIRED' END"}, _tgt)

inline("file_formats", "id int, url string, ctype string", [
    (1, "https://x/a.CSV?x=1", ""), (2, "https://x/a", "text/csv"), (3, "https://x/a.bin", "application/json"), (4, "https://x/a", "application/vnd.ms-excel"), (5, "https://x/a.pdf", "application/pdf"), (6, "https://x/a", None), (7, "https://p.org/datasets/x.json", ""), (8, "https://x/a.parquet", "x"),
], lambda: {"id": F.col("id"), "format": scoring.format_of(F.col("url"), F.col("ctype")), "connector": scoring.connector_of(F.col("url"), "p.org")}, {
    "id": "id", "format": "CASE id WHEN 1 THEN 'csv' WHEN 2 THEN 'csv' WHEN 3 THEN 'json' WHEN 4 THEN 'xlsx' WHEN 5 THEN 'pdf' WHEN 6 THEN 'binary' WHEN 7 THEN 'json' ELSE 'parquet' END",
    "connector": "CASE id WHEN 7 THEN 'data_gouv_ci' WHEN 1 THEN 'http_file' WHEN 8 THEN 'http_file' ELSE 'public_web' END"})

inline("repair_actions", "id int, con string, url string, status string, sha string, host string", [
    (1, None, "https://x/a", "CORRUPTED", "s", "x"), (2, "http_file", "https://x/a", "CORRUPTED", "s", "x"), (3, "public_web", "https://x/uploads/", "CORRUPTED", "s", "x"), (4, "public_web", "https://x/a.pdf", "FAILED", "s", "x"),
    (5, "public_web", "https://x/a.pdf", "CORRUPTED", "", "x"), (6, "public_web", "https://x/a.pdf", "LOCAL_MISSING", "s", "y"), (7, "public_web", "https://x/a.pdf", "LOCAL_MISSING", "s", "x"), (8, "public_web", "https://x/a%20", "FAILED", "s", "x"),
], lambda: {"id": F.col("id"), "action": scoring.repair_action(F.col("con"), F.col("url"), urls.crawl_url(F.col("url")), urls.is_upload_directory(F.col("url")), F.col("status"), F.col("sha"), F.col("host"))}, {
    "id": "id", "action": "CASE id WHEN 1 THEN 'UNKNOWN_SOURCE' WHEN 3 THEN 'TOMBSTONE_INVALID_LEGACY_URL' WHEN 8 THEN 'TOMBSTONE_INVALID_LEGACY_URL' WHEN 7 THEN 'DIRECT_URL_REPAIR' ELSE 'SOURCE_RESYNC' END"})

inline("physical_states", "id int, res string, gone boolean, err string, got boolean, here boolean", [
    (1, "DOWNLOADED", False, None, True, True), (2, "UNCHANGED", False, "", None, True), (3, "DOWNLOADED", False, None, True, False), (4, "ERROR", False, None, False, False), (5, None, True, None, None, None), (6, "UPSTREAM_GHOST", False, "x", None, None), (7, None, None, None, None, None), (8, "DOWNLOADED", False, "x", True, True),
], lambda: {"id": F.col("id"), "state": scoring.physical_state(*(F.col(c) for c in ("res", "gone", "err", "got", "here")))}, {
    "id": "id", "state": "CASE id WHEN 1 THEN 'FETCHED' WHEN 2 THEN 'UNCHANGED' WHEN 3 THEN 'LOCAL_MISSING' WHEN 4 THEN 'FAILED' WHEN 5 THEN 'REMOVED' WHEN 6 THEN 'UPSTREAM_GHOST' WHEN 7 THEN 'DISCOVERED' ELSE 'FAILED' END"})

inline("feed_decisions", "id int, dl bigint, fav bigint, tries int, res string, pend int, raw string", [
    (i, i * 370_001, i * 777, i, "success" if i % 3 else "error", i % 2, str(i * 13) if i % 4 else "x") for i in range(20)
], lambda: {
    "id": F.col("id"), "priority": scoring.harvest_priority(F.col("dl"), F.col("fav")), "backoff": scoring.backoff_seconds(F.col("tries")), "outcome": scoring.completion(F.col("res"), F.col("pend"), F.col("tries")), "bounded": scoring.bounded_int(F.col("raw")),
}, {
    "id": "id", "priority": "least(100, 40 + least(40, dl // 100000) + least(20, fav // 100))", "backoff": "least(86400, 300 * pow(2, least(tries, 12)))::BIGINT",
    "outcome": "CASE WHEN res = 'success' AND pend = 0 THEN 'SUCCESS' WHEN res = 'success' THEN 'PARTIAL' WHEN tries >= 5 THEN 'REVIEW_EXHAUSTED' ELSE 'RETRY' END", "bounded": "greatest(0, least(100, coalesce(TRY_CAST(raw AS INT), 0)))"})

inline("ghost_states", "id int, a int, b int, c int", [(1, 404, 404, 404), (2, 200, 404, 404), (3, 404, 500, 404)], lambda: {"id": F.col("id"), "ghost": changes.is_ghost(F.col("a"), F.col("b"), F.col("c"))}, {"id": "id", "ghost": "a = 404 AND b = 404 AND c = 404"})

# --- scores over tables ---------------------------------------------------------------------------


@query("source_rank", t.with_derived("sources") + """ SELECT source_id, round(least(1.0::DOUBLE, CASE priority WHEN 'P0' THEN 1.0 WHEN 'P1' THEN 0.85 WHEN 'P2' THEN 0.7 WHEN 'P3' THEN 0.55 END::DOUBLE
    + CASE WHEN regexp_matches(lower(provider), 'minist|direction|anstat|bceao|gouv|office') THEN 0.08 ELSE 0 END::DOUBLE + CASE WHEN starts_with(rights_tier, 'A_') THEN 0.03 ELSE 0 END::DOUBLE + CASE WHEN domain IN ('FRANCE', 'multidomain') THEN 0.08 ELSE 0 END::DOUBLE), 4) AS score FROM sources""")
def source_rank(spark, sf_dir):
    c = F.col
    s = t.derived(spark, sf_dir, "sources").select("source_id", scoring.source_score(c("priority"), c("provider"), c("rights_tier"), c("domain"), "FRANCE").alias("score"))
    return s.orderBy(F.desc("score"), "source_id")


_PUBLIC = "CASE WHEN starts_with(rights_tier, 'D_') THEN FALSE WHEN access_tier IN ('OPEN', 'OPEN_PUBLIC') THEN TRUE ELSE metadata_only END"


def _sources(spark, sf_dir):
    s = t.derived(spark, sf_dir, "sources")
    return s.withColumn("public", scoring.is_public(F.col("rights_tier"), F.col("access_tier"), F.col("metadata_only")))


@query("registry_list", t.with_derived("sources") + f" SELECT source_id, priority, domain FROM sources WHERE enabled AND auto_sync AND {_PUBLIC}")
def registry_list(spark, sf_dir):
    return _sources(spark, sf_dir).filter("enabled and auto_sync and public").select("source_id", "priority", "domain").orderBy("priority", "domain", "source_id")


@query("importance", """WITH d AS (SELECT l_partkey AS k, count(*) AS dependents, CAST(sum(l_quantity) * 100 AS BIGINT) AS downloads, CAST(sum(l_quantity) AS BIGINT) AS recent, max(l_linenumber) AS stars FROM lineitem GROUP BY 1),
    s AS (SELECT k, round_even(least(35.0::DOUBLE, log10(downloads + 1) * 5.0::DOUBLE) + least(15.0::DOUBLE, log10(recent + 1) * 2.5::DOUBLE) + least(25.0::DOUBLE, log10(dependents + 1) * 6.0::DOUBLE) + least(15.0::DOUBLE, log10(stars + 1) * 3.0::DOUBLE) + (k % 101) * 0.1::DOUBLE, 0)::INT AS importance FROM d)
    SELECT k, least(100, importance) AS importance, CASE WHEN importance >= 80 THEN 'CORE' WHEN importance >= 60 THEN 'MAJOR' WHEN importance >= 40 THEN 'SIGNIFICANT' ELSE 'LONG_TAIL' END AS tier FROM s""")
def importance(spark, sf_dir):
    d = t.table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("k")).agg(
        F.count(F.lit(1)).alias("dependents"), (F.sum("l_quantity") * 100).cast("long").alias("downloads"), F.sum("l_quantity").cast("long").alias("recent"), F.max("l_linenumber").alias("stars")
    )
    value = scoring.importance(F.col("downloads"), F.col("recent"), F.col("dependents"), F.col("stars"), (F.col("k") % 101).cast("int"))
    return d.select("k", value.alias("importance")).withColumn("tier", scoring.tier(F.col("importance")))


_QSCORE = "least(100, round_even(c_custkey % 83 * 0.45::DOUBLE + c_custkey % 79 * 0.35::DOUBLE + c_custkey % 101 * 0.20::DOUBLE, 0)::INT)"


@query("qualification_decisions", f"""SELECT c_custkey, {_QSCORE} AS score, CASE WHEN c_custkey % 6 <> 0 AND ((c_custkey % 79 >= 55 AND {_QSCORE} >= 40) OR (c_custkey % 101 >= 80 AND c_custkey % 79 >= 30) OR (c_mktsegment = 'BUILDING' AND c_custkey % 4 <> 0 AND c_custkey % 79 >= 60)) THEN 'READY_FOR_AUTHORITY'
    WHEN c_custkey % 6 <> 0 AND c_custkey % 79 >= 30 THEN 'QUALIFIED_ON_DEMAND' ELSE 'NEEDS_METADATA' END AS status FROM customer""")
def qualification_decisions(spark, sf_dir):
    k = F.col("c_custkey")
    c = t.table(spark, sf_dir, "customer")
    score = scoring.qualification_score((k % 83).cast("int"), (k % 79).cast("int"), (k % 101).cast("int"))
    registry = F.when(F.col("c_mktsegment") == "BUILDING", "repo1.maven.org").otherwise("npmjs.org")
    status = scoring.qualification_status(F.when(k % 6 != 0, "1.0"), F.when(k % 4 != 0, "r"), k % 79, score, k % 101, registry)
    return c.select("c_custkey", score.alias("score"), status.alias("status"))


@query("delivery", """SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN CASE WHEN r + f + d > 0 THEN 'METADATA_ONLY' ELSE 'EMPTY' END WHEN con = 'osm_geofabrik' THEN CASE WHEN f > 0 THEN 'SNAPSHOT_ONLY' ELSE 'EMPTY' END
    WHEN con = 'public_web' THEN CASE WHEN r + f + d > 0 THEN 'DOCUMENTS_ONLY' ELSE 'EMPTY' END WHEN con = 'http_file' AND r > 0 THEN 'FULL_STRUCTURED' WHEN d > 0 THEN 'DOCUMENTS_ONLY' WHEN f > 0 THEN 'SNAPSHOT_ONLY' WHEN r > 0 THEN 'FULL_STRUCTURED' ELSE 'EMPTY' END AS delivery
    FROM (SELECT *, CASE p_partkey % 4 WHEN 0 THEN 'osm_geofabrik' WHEN 1 THEN 'public_web' WHEN 2 THEN 'http_file' ELSE 'other' END AS con, p_partkey % 3 AS r, p_partkey % 5 % 2 AS f, p_partkey % 7 % 2 AS d FROM part)""")
def delivery(spark, sf_dir):
    k = F.col("p_partkey")
    con = F.when(k % 4 == 0, "osm_geofabrik").when(k % 4 == 1, "public_web").when(k % 4 == 2, "http_file").otherwise("other")
    return t.table(spark, sf_dir, "part").select("p_partkey", scoring.delivery_status(con, F.col("p_size") % 10 == 0, k % 3, k % 5 % 2, k % 7 % 2).alias("delivery"))


@query("freshness", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CASE WHEN s IS NOT NULL THEN 'STALE' ELSE 'NEVER_SYNCED' END WHEN s IS NULL THEN 'NEVER_SYNCED' WHEN TIMESTAMP '1996-01-01' >= s + INTERVAL 168 HOUR THEN 'DUE' ELSE 'FRESH' END AS freshness
    FROM (SELECT *, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderdate END AS s FROM orders)""")
def freshness(spark, sf_dir):
    last = F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate"))
    due = scoring.is_due(last, F.lit(168), F.lit("1996-01-01").cast("timestamp"))
    status = F.when(F.col("o_orderstatus") == "F", "error").otherwise("success")
    return t.table(spark, sf_dir, "orders").select("o_orderkey", scoring.freshness(status, last, due).alias("freshness"))


# --- audits ---------------------------------------------------------------------------------------


@query("audit_counts", """WITH b AS (SELECT coalesce(nullif(o_orderstatus, ''), 'UNKNOWN') AS o_orderstatus, coalesce(o_orderpriority, 'UNKNOWN') AS o_orderpriority, CAST(o_custkey % 10 AS BIGINT) AS rows FROM orders)
    SELECT 'o_orderstatus' AS dimension, o_orderstatus AS value, count(*) AS n, sum(rows)::BIGINT AS rows FROM b GROUP BY 2 UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*), sum(rows)::BIGINT FROM b GROUP BY 2 UNION ALL SELECT 'all', 'all', count(*), sum(rows)::BIGINT FROM b""")
def audit_counts(spark, sf_dir):
    o = t.table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority", (F.col("o_custkey") % 10).alias("rows"))
    return audit.dimension_counts(o, ["o_orderstatus", "o_orderpriority"], ["rows"])


@query("upstream_audit", t.with_derived("artifacts") + """, a AS (SELECT *, coalesce(last_result, 'UNKNOWN') AS r FROM artifacts) SELECT source_id, count(*) AS artifacts, count(*) FILTER (r = 'DOWNLOADED') AS downloaded,
    coalesce(sum(size_bytes) FILTER (r = 'DOWNLOADED'), 0)::BIGINT AS last_downloaded_bytes, max(last_checked) AS last_checked, max(last_downloaded) AS last_downloaded, count(error) AS errors FROM a GROUP BY source_id""")
def upstream_audit(spark, sf_dir):
    a = audit.upstream_audit(t.derived(spark, sf_dir, "upstream_artifacts"))
    return a.select("source_id", "artifacts", F.coalesce(F.try_element_at("last_results", F.lit("DOWNLOADED")), F.lit(0)).alias("downloaded"), "last_downloaded_bytes", "last_checked", "last_downloaded", "errors")


@query("upstream_audit_full")
def upstream_audit_full(spark, sf_dir):
    return audit.upstream_audit(t.derived(spark, sf_dir, "upstream_artifacts"))


@query("upstream_errors", t.with_derived("upstream_artifacts") + """ SELECT source_id, artifact_id, error, http_status FROM upstream_artifacts WHERE error <> ''
    QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY artifact_id) <= 50""")
def upstream_errors(spark, sf_dir):
    return audit.upstream_audit(t.derived(spark, sf_dir, "upstream_artifacts")).select("source_id", F.inline("first_errors"))


@query("upstream_methods", t.with_derived("upstream_artifacts") + " SELECT source_id, method, count(*) AS n FROM upstream_artifacts WHERE method <> '' GROUP BY 1, 2")
def upstream_methods(spark, sf_dir):
    return audit.upstream_audit(t.derived(spark, sf_dir, "upstream_artifacts")).select("source_id", F.explode("methods").alias("method", "n"))


@query("upstream_totals", t.with_derived("upstream_artifacts") + """ SELECT count(DISTINCT source_id) AS sources, count(*) AS artifacts, count(error) AS errors, count(*) FILTER (last_result = 'DOWNLOADED') AS downloaded,
    count(*) FILTER (last_result = 'UNCHANGED') AS unchanged, count(*) FILTER (last_result IS NULL) AS unknown FROM upstream_artifacts""")
def upstream_totals(spark, sf_dir):
    a = audit.upstream_totals(audit.upstream_audit(t.derived(spark, sf_dir, "upstream_artifacts")))
    return a.select("sources", "artifacts", "errors", *(F.coalesce(F.try_element_at("last_results", F.lit(r)), F.lit(0)).alias(r.lower()) for r in ("DOWNLOADED", "UNCHANGED", "UNKNOWN")))


@query("ledger_audit", t.with_derived("artifacts") + " SELECT status, verification, count(*) AS n, sum(size_bytes)::BIGINT AS bytes, sum(CASE WHEN status IN ('FETCHED', 'UNCHANGED') THEN size_bytes ELSE 0 END)::BIGINT AS physical_bytes FROM artifacts GROUP BY 1, 2")
def ledger_audit(spark, sf_dir):
    return audit.ledger_audit(t.derived(spark, sf_dir, "artifacts"))


_COVERAGE = t.with_derived("sources") + f""", s AS (SELECT *, {_PUBLIC} AS public, nation AS item FROM sources),
    i AS (SELECT n_nationkey AS item_id, 'P' || (n_nationkey % 3) AS priority, CASE WHEN n_nationkey % 11 = 0 THEN 'CONTROLLED' ELSE '' END AS policy, 1 + n_nationkey % 2 AS minimum, n_nationkey % 6 = 0 AS extra FROM nation),
    c AS (SELECT item_id, i.priority, policy, minimum, count(s.source_id) + any_value(extra::INT) AS declared, count(s.source_id) AS registered, count(*) FILTER (s.enabled AND public) AS enabled_public, count(*) FILTER (NOT public) AS controlled,
        count(*) FILTER (NOT s.enabled) AS disabled, count(*) FILTER (s.enabled AND public AND coalesce(delivery_status, '') NOT IN ('', 'EMPTY')) AS usable FROM i LEFT JOIN s ON s.item = i.item_id GROUP BY 1, 2, 3, 4),
    v AS (SELECT *, CASE WHEN policy = 'CONTROLLED' THEN policy WHEN declared > registered AND registered = 0 THEN 'MISSING' WHEN disabled > 0 AND enabled_public = 0 AND controlled = 0 THEN 'UNRESOLVED' WHEN controlled > 0 AND enabled_public = 0 THEN 'CONTROLLED'
        WHEN usable >= minimum AND declared = registered AND enabled_public = usable THEN 'COVERED' WHEN usable + enabled_public + registered > 0 THEN 'PARTIAL' ELSE 'MISSING' END AS status FROM c),
    w AS (SELECT *, CASE priority WHEN 'P0' THEN 3.0 WHEN 'P1' THEN 2.0 ELSE 1.0 END::DOUBLE AS weight, CASE status WHEN 'COVERED' THEN 1.0 WHEN 'PARTIAL' THEN 0.55 WHEN 'CONTROLLED' THEN 0.75 ELSE 0 END::DOUBLE AS value FROM v)"""


def _coverage(spark, sf_dir):
    s = _sources(spark, sf_dir)
    n = t.table(spark, sf_dir, "nation")
    k = F.col("n_nationkey")
    own = s.groupBy(F.col("nation").alias("n_nationkey")).agg(F.collect_list("source_id").alias("ids"))
    none = F.array().cast("array<bigint>")
    ids = F.concat(F.coalesce("ids", none), F.when(k % 6 == 0, F.array((-k - 1).cast("long"))).otherwise(none))
    items = n.join(own, "n_nationkey", "left").select(
        k.alias("item_id"), F.concat(F.lit("P"), (k % 3).cast("string")).alias("priority"), F.when(k % 11 == 0, "controlled").alias("policy_status"), (1 + k % 2).alias("minimum_usable"), ids.alias("source_ids")
    )
    return audit.weighted_coverage(items, s)


@query("coverage_items", _COVERAGE + " SELECT item_id, status, usable, weight, value FROM w")
def coverage_items(spark, sf_dir):
    return _coverage(spark, sf_dir).select("item_id", "status", "usable", "weight", "value")


@query("coverage_score", _COVERAGE + " SELECT count(*) AS items, round(100.0::DOUBLE * sum(value * weight) / sum(weight), 2) AS coverage_score, count(*) FILTER (priority = 'P0' AND status IN ('PARTIAL', 'MISSING', 'UNRESOLVED')) AS p0_blockers FROM w")
def coverage_score(spark, sf_dir):
    return audit.coverage_summary(_coverage(spark, sf_dir))


_ISSUES = t.with_derived("sources") + """, q AS (SELECT source_id, priority, unnest(list_filter([CASE WHEN manifest_version = 0 THEN 'MANIFEST_MISSING' END, CASE WHEN manifest_version BETWEEN 1 AND 2 THEN 'MANIFEST_SCHEMA_LEGACY' END,
    CASE WHEN coalesce(delivery_status, 'EMPTY') = 'EMPTY' THEN 'EMPTY_DELIVERY' END, CASE WHEN sync_status = 'ERROR' THEN 'SYNC_ERROR' END, CASE WHEN failed > 0 THEN 'UPSTREAM_PARTIAL_FAILURE' END, CASE WHEN backlog > 0 THEN 'UPSTREAM_BACKLOG' END,
    CASE WHEN needs_ocr > 0 THEN 'DOCUMENTS_NEED_OCR' END], lambda x: x IS NOT NULL)) AS issue FROM sources),
    z AS (SELECT *, CASE WHEN issue = 'DOCUMENTS_NEED_OCR' THEN 'ADVISORY' WHEN priority = 'P0' THEN 'CRITICAL' ELSE 'WARNING' END AS severity FROM q)"""


def _quality_rows(spark, sf_dir):
    s = t.derived(spark, sf_dir, "sources").withColumn("manifest_version", F.nullif("manifest_version", F.lit(0)))
    return s.withColumns({c: F.lit(0) for c in ("missing_metadata", "ignored", "zero_byte", "missing_columns")})


@query("quality_issues", _ISSUES + " SELECT * FROM z")
def quality_issues(spark, sf_dir):
    return audit.quality_issues(_quality_rows(spark, sf_dir))


@query("quality_summary", _ISSUES + """ SELECT s.source_id, CASE WHEN bool_or(severity = 'CRITICAL') THEN 'CRITICAL' WHEN bool_or(severity = 'WARNING') THEN 'WARNING' WHEN bool_or(severity = 'ADVISORY') THEN 'ADVISORY' ELSE 'OK' END AS severity, count(issue) AS issues
    FROM sources s LEFT JOIN z ON s.source_id = z.source_id GROUP BY 1""")
def quality_summary(spark, sf_dir):
    return audit.quality_summary(_quality_rows(spark, sf_dir))


@query("certification", t.with_derived("sources") + f""", f AS (SELECT count(*)::DOUBLE AS active, count(*) FILTER (sync_status <> 'ERROR') AS ok, count(*) FILTER (coalesce(delivery_status, 'EMPTY') <> 'EMPTY') AS full_, count(*) FILTER (enabled) AS fresh FROM sources WHERE {_PUBLIC}),
    c AS (SELECT *, 90.0::DOUBLE AS cov, 95.5::DOUBLE AS qp, 99.5::DOUBLE AS cl, round(fresh / active * 100.0::DOUBLE, 2) AS fr, round(least(90.0::DOUBLE, 45.0 + 10 / 14.0::DOUBLE * 30.0::DOUBLE + 15.0 - 10.0), 2) AS st, 100.0::DOUBLE AS ri, round(ok / active * 80.0::DOUBLE + 20.0, 2) AS ha FROM f)
    SELECT cov AS c_coverage, qp AS c_quality_provenance, fr AS c_freshness, st AS c_stability, ha AS c_handoff, round(cov * 0.25::DOUBLE + qp * 0.20::DOUBLE + cl * 0.15::DOUBLE + fr * 0.15::DOUBLE + st * 0.10::DOUBLE + ri * 0.10::DOUBLE + ha * 0.05::DOUBLE, 2) AS score,
    full_ = active AS no_active_empty, ok = active AS no_active_sync_error, FALSE AS approved FROM c""")
def certification(spark, sf_dir):
    s = _sources(spark, sf_dir).filter("public")
    fact = s.agg(
        F.count(F.lit(1)).alias("active"), F.count_if(F.col("sync_status") != "ERROR").alias("non_error"), F.count_if(F.coalesce("delivery_status", F.lit("EMPTY")) != "EMPTY").alias("non_empty"), F.count_if("enabled").alias("freshish"),
        F.count_if(F.col("rights_tier") != "").alias("rights_ok"), F.count_if(F.col("sync_status") != "ERROR").alias("manifests_ok"),
    ).withColumns({
        "catalog_ok": F.lit(True), "coverage_score": F.lit(90.0), "p0_blockers": F.lit(0), "critical_issues": F.lit(0), "warnings": F.lit(3), "schema_pct": F.lit(99.5), "partial_sources": F.lit(0), "backlog_sources": F.lit(0), "legacy_manifests": F.lit(0),
        "elapsed_days": F.lit(20.0), "cycles_total": F.lit(10), "cycles_with_errors": F.lit(1), "exercised": F.lit(True), "qualified": F.lit(False),
    })
    got = audit.certification(fact)
    return got.select("c_coverage", "c_quality_provenance", "c_freshness", "c_stability", "c_handoff", "score", "no_active_empty", "no_active_sync_error", "approved")


@query("qualification_window", """WITH c AS (SELECT o_orderkey % 20 AS cycle, count(*) AS a, count(*) FILTER (o_orderkey % 500 <> 0) AS s FROM orders GROUP BY 1)
    SELECT count(*) AS cycles_total, count(*) FILTER (a > s) AS cycles_with_errors, sum(a)::BIGINT AS sync_attempts, sum(s)::BIGINT AS sync_successes, 31.5::DOUBLE AS elapsed_days, count(*) FILTER (a > s) = 0 AS qualified FROM c""")
def qualification_window(spark, sf_dir):
    k = F.col("o_orderkey")
    results = t.table(spark, sf_dir, "orders").select((k % 20).alias("cycle"), F.when(k % 500 == 0, "error").otherwise("success").alias("status"))
    stamp = lambda x: F.lit(x).cast("timestamp")
    return audit.qualification_window(results, stamp("2024-01-01 00:00:00"), stamp("2024-02-01 12:00:00"))


@query("portal_coverage", """WITH o AS (SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 3 <> 0), l AS (SELECT o_orderkey AS id, CASE o_orderkey % 7 WHEN 0 THEN 'UPSTREAM_GHOST' WHEN 1 THEN 'FETCHED' WHEN 2 THEN 'UNCHANGED' WHEN 3 THEN 'FAILED' ELSE 'DISCOVERED' END AS s, o_orderkey % 2 = 0 AS v FROM orders WHERE o_orderkey % 5 <> 0),
    b AS (SELECT o.id IS NOT NULL AS o, l.id IS NOT NULL AS t, coalesce(s, '') AS s, coalesce(v, FALSE) AS v FROM o FULL JOIN l ON o.id = l.id), c AS (SELECT count(*) FILTER (o) AS official_visible, count(*) FILTER (o AND s <> 'UPSTREAM_GHOST') AS official_retrievable, count(*) FILTER (o AND s = 'UPSTREAM_GHOST') AS upstream_ghost,
    count(*) FILTER (o AND t) AS ledger_tracked, count(*) FILTER (o AND s IN ('FETCHED', 'UNCHANGED')) AS physical, count(*) FILTER (o AND v AND s IN ('FETCHED', 'UNCHANGED')) AS verified, count(*) FILTER (o AND NOT v AND s IN ('FETCHED', 'UNCHANGED')) AS unverified_physical,
    count(*) FILTER (o AND NOT t) AS not_tracked, count(*) FILTER (o AND s = 'FAILED') AS bad, count(*) FILTER (t AND NOT o) AS unexpected FROM b) SELECT *, physical::DOUBLE / official_retrievable AS physical_ratio, verified::DOUBLE / official_retrievable AS verified_ratio FROM c""")
def portal_coverage(spark, sf_dir):
    o = t.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    status = F.when(k % 7 == 0, "UPSTREAM_GHOST").when(k % 7 == 1, "FETCHED").when(k % 7 == 2, "UNCHANGED").when(k % 7 == 3, "FAILED").otherwise("DISCOVERED")
    ledger = o.filter(k % 5 != 0).select(k.alias("id"), status.alias("status"), F.when(k % 2 == 0, "VERIFIED").otherwise("UNVERIFIED").alias("verification"))
    return audit.portal_coverage(o.filter(k % 3 != 0).select(k.alias("id")), ledger)


@query("docs_audit", """SELECT p_brand AS language, count(*) AS sources, sum(p_size)::BIGINT AS chunks, array_to_string(list_sort(list_distinct(list(split_part(p_type, ' ', 1)))), ',') AS frameworks, round(100.0::DOUBLE * sum(p_size % 7) / sum(p_size), 2) AS efficiency_pct FROM part GROUP BY 1""")
def docs_audit(spark, sf_dir):
    p = t.table(spark, sf_dir, "part")
    s = p.select(F.col("p_brand").alias("language"), F.col("p_size").alias("chunks"), F.split("p_type", " ")[0].alias("framework"), F.col("p_size").alias("pages"), (F.col("p_size") % 7).alias("avoided"))
    return audit.docs_audit(s).withColumn("frameworks", F.array_join("frameworks", ","))


@query("country_scope", "SELECT n_regionkey AS region, CASE WHEN count(DISTINCT n_name) = 1 THEN min(n_name) ELSE 'MIXED' END AS country_scope FROM nation GROUP BY 1 UNION ALL SELECT -1, 'SOLO'")
def country_scope(spark, sf_dir):
    n = t.table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("int").alias("region"), F.col("n_name").alias("country_code"))
    return audit.country_scope(n.union(spark.createDataFrame([(-1, "SOLO"), (-1, "SOLO")], "region int, country_code string")), "region")


@query("catalogue_lists", "SELECT n_regionkey AS region, array_to_string(list(n_name ORDER BY n_name), ',') AS members, count(*) AS n FROM nation GROUP BY 1")
def catalogue_lists(spark, sf_dir):
    n = t.table(spark, sf_dir, "nation").groupBy(F.col("n_regionkey").alias("region"))
    return n.agg(F.array_join(F.sort_array(F.collect_list("n_name")), ",").alias("members"), F.count(F.lit(1)).alias("n"))


# --- change capture and state ---------------------------------------------------------------------


@query("changed_signatures", t.with_derived("before", "now") + " SELECT now.k, now.signature FROM now LEFT JOIN before ON now.k = before.k WHERE now.signature IS DISTINCT FROM before.signature")
def changed_signatures(spark, sf_dir):
    return changes.changed(t.derived(spark, sf_dir, "now"), t.derived(spark, sf_dir, "before"), ["k"])


@query("two_level_gate", """WITH i AS (SELECT l_orderkey AS source_id, l_linenumber AS item_id, CAST(l_quantity AS BIGINT) AS signature FROM lineitem), s AS (SELECT o_orderkey AS source_id, o_custkey AS signature FROM orders),
    cs AS (SELECT source_id, CASE WHEN source_id % 4 = 0 THEN signature + 1 ELSE signature END AS signature FROM s WHERE source_id % 9 <> 0), ci AS (SELECT source_id, item_id, CASE WHEN item_id = 1 THEN -1 ELSE signature END AS signature FROM i WHERE item_id <> 3)
    SELECT i.source_id, i.item_id, i.signature FROM i JOIN (SELECT s.source_id FROM s LEFT JOIN cs USING (source_id) WHERE s.signature IS DISTINCT FROM cs.signature) d USING (source_id) LEFT JOIN ci ON i.source_id = ci.source_id AND i.item_id = ci.item_id WHERE i.signature IS DISTINCT FROM ci.signature""")
def two_level_gate(spark, sf_dir):
    i = t.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("source_id"), F.col("l_linenumber").alias("item_id"), F.col("l_quantity").cast("long").alias("signature"))
    s = t.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("source_id"), F.col("o_custkey").alias("signature"))
    cs = s.filter("source_id % 9 <> 0").withColumn("signature", F.when(F.col("source_id") % 4 == 0, F.col("signature") + 1).otherwise(F.col("signature")))
    ci = i.filter("item_id <> 3").withColumn("signature", F.when(F.col("item_id") == 1, -1).otherwise(F.col("signature")))
    return changes.two_level(s, i, cs, ci).select("source_id", "item_id", "signature")


@query("certified_sources", "SELECT l_orderkey AS source_id FROM lineitem GROUP BY 1 HAVING bool_and(l_returnflag <> 'R')")
def certified_sources(spark, sf_dir):
    return changes.certified_sources(t.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("source_id"), (F.col("l_returnflag") != "R").alias("ok")))


@query("removed_keys", t.with_derived("before", "now") + " SELECT k, signature FROM before WHERE k NOT IN (SELECT k FROM now)")
def removed_keys(spark, sf_dir):
    return changes.tombstones(t.derived(spark, sf_dir, "before"), t.derived(spark, sf_dir, "now"), ["k"])


@query("known_keys", t.with_derived("before", "now") + " SELECT k FROM before UNION SELECT k FROM now")
def known_keys(spark, sf_dir):
    return changes.known_after(t.derived(spark, sf_dir, "before"), t.derived(spark, sf_dir, "now"), ["k"], complete=False)


@query("reappeared_keys", t.with_derived("before", "now") + " SELECT b.k, CASE WHEN b.k % 2 = 0 AND n.k IS NOT NULL THEN -5 ELSE b.signature END AS signature, b.k % 2 = 0 AND n.k IS NULL AS removed FROM before b LEFT JOIN now n ON b.k = n.k")
def reappeared_keys(spark, sf_dir):
    state = t.derived(spark, sf_dir, "before").withColumn("removed", F.col("k") % 2 == 0)
    return changes.reappeared(state, t.derived(spark, sf_dir, "now"), ["k"]).select("k", F.coalesce("signature", F.lit(-5)).alias("signature"), "removed")


@query("keyset_page", "SELECT user_id, event_id FROM events WHERE (user_id > 20 OR (user_id = 20 AND event_id > 500)) AND user_id <= 60 ORDER BY 1, 2 LIMIT 200")
def keyset_page(spark, sf_dir):
    return changes.keyset_page(t.table(spark, sf_dir, "events").select("user_id", "event_id"), ["user_id", "event_id"], (20, 500), until=60, limit=200)


@query("missing_increments", "SELECT i AS number FROM range(11, 401) r(i) WHERE i NOT IN (SELECT event_id FROM events WHERE event_id % 13 <> 0)")
def missing_increments(spark, sf_dir):
    return changes.missing_increments(t.table(spark, sf_dir, "events").filter("event_id % 13 <> 0").select(F.col("event_id").alias("number")), 10, 400)


@query("lww_fold", "SELECT user_id, max_by(event_type, (ts, event_id)) AS event_type, max_by(event_id, (ts, event_id)) AS event_id FROM events GROUP BY 1")
def lww_fold(spark, sf_dir):
    return changes.last_writer(t.table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_type", "event_id")


@query("first_seen", """WITH s AS (SELECT user_id, min(event_id) AS event_id FROM events WHERE event_id % 2 = 0 AND user_id % 2 = 0 GROUP BY 1)
    SELECT * FROM s UNION ALL SELECT user_id, min(event_id) FROM events WHERE event_id % 2 = 1 AND user_id NOT IN (SELECT user_id FROM s) GROUP BY 1""")
def first_seen(spark, sf_dir):
    e = t.table(spark, sf_dir, "events").select("user_id", "event_id")
    stored = e.filter("event_id % 2 = 0 and user_id % 2 = 0").groupBy("user_id").agg(F.min("event_id").alias("event_id"))
    return changes.first_seen(stored, e.filter("event_id % 2 = 1"), ["user_id"], ["event_id"])


@query("event_fold", t.with_derived("changes", "queue") + """, l AS (SELECT registry, name, max_by(deleted, ord) AS deleted, max_by(source, ord) AS new_source, bool_or(NOT deleted) AS upserted FROM changes GROUP BY 1, 2)
    SELECT registry, name, coalesce(new_source, source) AS source, CASE WHEN upserted THEN greatest(coalesce(priority, 0), 60) ELSE coalesce(priority, 0) END AS priority, CASE WHEN deleted THEN 'DELETED' WHEN NOT deleted THEN 'PENDING' ELSE status END AS status,
    coalesce(first_seen_at, 't1') AS first_seen_at, CASE WHEN deleted IS NOT NULL THEN 't1' ELSE last_seen_at END AS last_seen_at FROM queue FULL JOIN l USING (registry, name)""")
def event_fold(spark, sf_dir):
    return changes.fold_events(t.derived(spark, sf_dir, "queue"), t.derived(spark, sf_dir, "changes"), "t1")


@query("stage_upsert", """WITH s AS (SELECT c_custkey AS k, c_name AS a, CAST(c_custkey % 10 AS INT) AS p, 'old' AS d, 'seen' AS f FROM customer WHERE c_custkey % 2 = 0), i AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'new' END AS a, CAST(c_custkey % 7 AS INT) AS p, '' AS d, 'later' AS f FROM customer WHERE c_custkey % 5 = 0)
    SELECT k, coalesce(i.a, s.a) AS a, greatest(s.p, i.p) AS p, CASE WHEN s.d IS NULL THEN '-' ELSE s.d END AS d, coalesce(s.f, i.f) AS f FROM s FULL JOIN i USING (k)""")
def stage_upsert(spark, sf_dir):
    c = t.table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    s = c.filter(k % 2 == 0).select(k.alias("k"), F.col("c_name").alias("a"), (k % 10).cast("int").alias("p"), F.lit("old").alias("d"), F.lit("seen").alias("f"))
    i = c.filter(k % 5 == 0).select(k.alias("k"), F.when(k % 3 != 0, "new").alias("a"), (k % 7).cast("int").alias("p"), F.lit("").alias("d"), F.lit("later").alias("f"))
    return changes.upsert(s, i, ["k"], {"a": "coalesce", "p": "max", "d": "nonempty", "f": "keep"}).withColumn("d", F.coalesce("d", F.lit("-")))


@query("merge_by_key", t.with_derived("before", "now") + " SELECT k, signature FROM before WHERE k NOT IN (SELECT k FROM now) UNION ALL SELECT k, signature FROM now")
def merge_by_key(spark, sf_dir):
    return changes.merge_by_key(t.derived(spark, sf_dir, "before"), t.derived(spark, sf_dir, "now"), ["k"])


_LIVE = t.with_derived("index_events") + ", f AS (SELECT package, version, hash, max_by(kind, ord) AS kind FROM index_events GROUP BY 1, 2, 3), v AS (SELECT package, version, count(*) FILTER (kind = 'ADD') AS live FROM f GROUP BY 1, 2)"


@query("version_liveness", _LIVE + " SELECT * FROM v")
def version_liveness(spark, sf_dir):
    return changes.liveness(t.derived(spark, sf_dir, "index_events"))


@query("package_liveness", _LIVE + " SELECT package, max(live) > 0 AS alive FROM v GROUP BY 1")
def package_liveness(spark, sf_dir):
    return changes.package_alive(changes.liveness(t.derived(spark, sf_dir, "index_events")))


_DIFF = [(1, "A", "se/rd/serde", None), (2, "R100", "se/rd/old1", "se/rd/new1"), (3, "C75", "ab/cd/abcd", "ab/cd/abce"), (4, "D", "3/a/abc", None), (5, "M", "config.json", None), (6, "T", "1/a", None), (7, "X", "1/b", None), (8, "R90", "se/rd/same", "se/rd/same")]


@query("git_diff_events", "SELECT * FROM (VALUES (1, 'serde', FALSE), (2, 'old1', TRUE), (2, 'new1', FALSE), (3, 'abce', FALSE), (4, 'abc', TRUE), (6, 'a', FALSE), (8, 'same', FALSE)) AS t(ord, name, deleted)")
def git_diff_events(spark, sf_dir):
    d = spark.createDataFrame(_DIFF, "ord int, status string, old string, new string")
    return changes.diff_events(d.select("ord", "status", versions.crate_name(F.col("old")).alias("old_name"), versions.crate_name(F.col("new")).alias("new_name"))).select("ord", "name", "deleted")


@query("transfer_budget", """WITH RECURSIVE i AS (SELECT p_partkey AS ord, p_size AS size, row_number() OVER (ORDER BY p_partkey) AS n FROM part), f AS (SELECT 0::BIGINT AS n, 900::BIGINT AS rest, 0::BIGINT AS ord, '' AS decision
    UNION ALL SELECT i.n, CASE WHEN size <= 45 AND size <= rest THEN rest - size ELSE rest END, i.ord, CASE WHEN size > 45 THEN 'SKIPPED_OVERSIZE' WHEN size > rest THEN 'DEFERRED_BUDGET' ELSE 'TAKEN' END FROM f JOIN i ON i.n = f.n + 1) SELECT ord AS item, decision FROM f WHERE n > 0""")
def transfer_budget(spark, sf_dir):
    p = t.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("ord"), F.col("p_partkey").alias("item_id"), F.col("p_size").alias("size"))
    return changes.transfer_plan(p, 45, 900).select(F.col("item_id").cast("long").alias("item"), "decision")


@query("fair_selection", "SELECT o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) ORDER BY r, o_orderpriority LIMIT 23")
def fair_selection(spark, sf_dir):
    o = t.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return changes.fair_selection(o, "o_orderpriority", [F.desc("o_totalprice"), F.col("o_orderkey")], 23).select("o_orderkey", "o_orderpriority")


@query("two_lane_selection", t.with_derived("candidates") + """, fast AS (SELECT registry, name, 'fast' AS lane FROM candidates WHERE priority >= 70 ORDER BY priority DESC, name LIMIT 10), r AS (SELECT c.registry, c.name, row_number() OVER (PARTITION BY c.registry ORDER BY c.priority DESC, c.name) AS k FROM candidates c ANTI JOIN fast USING (registry, name)),
    fair AS (SELECT registry, name, 'fair' AS lane FROM r ORDER BY k, registry LIMIT 20) SELECT * FROM fast UNION ALL SELECT * FROM fair""")
def two_lane_selection(spark, sf_dir):
    c = t.derived(spark, sf_dir, "candidates")
    first = c.filter("priority >= 70").orderBy(F.desc("priority"), "name").limit(10).withColumn("lane", F.lit("fast"))
    rest = changes.fair_selection(c.join(first.select("registry", "name"), ["registry", "name"], "left_anti"), "registry", [F.desc("priority"), F.col("name")], 20)
    return first.unionByName(rest.withColumn("lane", F.lit("fair"))).select("registry", "name", "lane")


# --- claims, identities, stages -------------------------------------------------------------------


@query("claim_reconcile", """WITH c AS (SELECT user_id AS subject, event_type AS value, (event_id % 8) * 0.125::DOUBLE AS authority, event_id AS ord FROM events),
    g AS (SELECT subject, value, sum(authority) AS a, sum(greatest(authority, 0.01::DOUBLE)) AS s, count(*) AS n, min(ord) AS f FROM c GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY a DESC, n DESC, f) AS k, sum(s) OVER (PARTITION BY subject) AS t, count(*) OVER (PARTITION BY subject) AS v FROM g)
    SELECT subject, CASE WHEN v = 1 THEN 'consensus' ELSE 'conflict' END AS status, value, round(least(1.0::DOUBLE, s / t + CASE WHEN n > 1 THEN 0.1::DOUBLE ELSE 0 END), 4) AS confidence, n AS supporting, v - 1 AS alternatives FROM r WHERE k = 1""")
def claim_reconcile(spark, sf_dir):
    e = t.table(spark, sf_dir, "events")
    c = e.select(F.col("user_id").alias("subject"), F.col("event_type").alias("value"), (F.col("event_id") % 8 * 0.125).alias("authority"), F.col("event_id").alias("ord"))
    return claims.reconcile_claims(c, "subject")


_GROUPS = t.with_derived("records") + r""", n AS (SELECT technology_id, regexp_replace(replace(replace(canonical_repository, 'git+https://www.github.com/', 'https://github.com/'), '//r', '/r'), '\.git$', '') AS repository, officiality_score AS s, starts_with(technology_id, 'pkg:') AS p FROM records),
    g AS (SELECT repository, count(*) AS members, count(*) FILTER (p) AS packages, min(technology_id) FILTER (p) AS package, min_by(technology_id, (-s, technology_id)) AS best FROM n GROUP BY 1 HAVING count(*) > 1),
    o AS (SELECT repository, members, packages, CASE WHEN packages = 1 THEN 'MERGED_ALIAS' WHEN packages > 1 THEN 'MONOREPO_AMBIGUOUS' ELSE 'LINKED' END AS status, CASE WHEN packages = 1 THEN package WHEN packages = 0 THEN best END AS canonical FROM g)"""


@query("identity_groups", _GROUPS + " SELECT * FROM o")
def identity_groups(spark, sf_dir):
    return claims.identity_groups(t.derived(spark, sf_dir, "records"))


@query("identity_members", _GROUPS + """ SELECT n.technology_id, CASE status WHEN 'MONOREPO_AMBIGUOUS' THEN status WHEN 'MERGED_ALIAS' THEN CASE WHEN n.technology_id = canonical THEN 'CANONICAL' ELSE 'ALIAS_OF_PACKAGE' END
    ELSE CASE WHEN n.technology_id = canonical THEN 'CANONICAL_NON_PACKAGE' ELSE 'ALIAS_OF_ENTITY' END END AS identity_status, CASE WHEN n.technology_id <> canonical THEN canonical END AS canonical FROM n JOIN o USING (repository)""")
def identity_members(spark, sf_dir):
    return claims.identity_members(t.derived(spark, sf_dir, "records"))


@query("identity_merged", t.with_derived("identity_records") + """, p AS (SELECT * FROM identity_records WHERE starts_with(technology_id, 'pkg:')), o AS (SELECT * FROM identity_records WHERE NOT starts_with(technology_id, 'pkg:')),
    g AS (SELECT canonical_repository, min_by(documentation_url, technology_id) FILTER (documentation_url <> '') AS d, min_by(official_website, technology_id) FILTER (official_website <> '') AS w, min_by(latest_stable_version, technology_id) FILTER (latest_stable_version <> '') AS v,
        list(technology_id ORDER BY technology_id) AS aliases, list(qid ORDER BY technology_id) FILTER (qid <> '') AS qids, list(source ORDER BY technology_id) AS sources FROM o GROUP BY 1)
    SELECT p.technology_id, coalesce(nullif(documentation_url, ''), d) AS documentation_url, coalesce(official_website, w) AS official_website, coalesce(latest_stable_version, v) AS latest_stable_version, array_to_string(aliases, ' ') AS identity_aliases,
    array_to_string(list_transform(list_filter(list_zip(qids, range(1, len(qids) + 1)), lambda x: list_position(qids, x[1]) = x[2]), lambda x: x[1]), ' ') AS wikidata_qids,
    array_to_string(list_transform(list_filter(list_zip(list_prepend(source, sources), range(1, len(sources) + 2)), lambda x: list_position(list_prepend(source, sources), x[1]) = x[2]), lambda x: x[1]), ' ') AS discovery_sources FROM p JOIN g USING (canonical_repository)""")
def identity_merged(spark, sf_dir):
    none = F.lit(None).cast("array<string>")
    r = t.derived(spark, sf_dir, "identity_records").withColumns({"discovery_sources": F.array("source"), "identity_aliases": none, "wikidata_qids": none})
    m = claims.identity_merged(r)
    return m.withColumns({c: F.array_join(c, " ") for c in ("discovery_sources", "identity_aliases", "wikidata_qids")})


@query("alias_lookup", """WITH t AS (SELECT DISTINCT 'u' || c_nationkey AS target_url FROM customer), s AS (SELECT 'u' || n_nationkey AS target_url, n_name AS id FROM nation WHERE n_nationkey % 4 = 0), d AS (SELECT 'u' || c_nationkey AS target_url, max_by(c_name, c_custkey) AS id FROM customer WHERE c_custkey % 3 = 0 GROUP BY 1)
    SELECT t.target_url, coalesce(s.id, d.id) AS source_id FROM t LEFT JOIN s USING (target_url) LEFT JOIN d USING (target_url)""")
def alias_lookup(spark, sf_dir):
    u = lambda c: F.concat(F.lit("u"), F.col(c).cast("string")).alias("target_url")
    c, n = t.table(spark, sf_dir, "customer"), t.table(spark, sf_dir, "nation")
    dynamic = c.select(u("c_nationkey"), F.col("c_name").alias("source_id"), F.col("c_custkey").alias("finished_at"), F.when(F.col("c_custkey") % 3 == 0, "SUCCESS").otherwise("ERROR").alias("status"))
    return claims.latest_alias(n.filter("n_nationkey % 4 = 0").select(u("n_nationkey"), F.col("n_name").alias("source_id")), dynamic, c.select(u("c_nationkey")))


@query("best_candidates", """WITH c AS (SELECT l_orderkey AS g, 'u' || (l_partkey % 5) AS url, l_quantity * 2 AS score, l_returnflag AS e FROM lineitem), u AS (SELECT g, url, max(score) AS score, array_to_string(list_sort(list_distinct(list(e))), ',') AS evidence FROM c GROUP BY 1, 2)
    SELECT g AS group_id, url, score, evidence FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY score DESC, url) AS k FROM u) WHERE k = 1 AND score >= 85""")
def best_candidates(spark, sf_dir):
    li = t.table(spark, sf_dir, "lineitem")
    c = li.select(F.col("l_orderkey").alias("group_id"), F.concat(F.lit("u"), (F.col("l_partkey") % 5).cast("string")).alias("url"), (F.col("l_quantity") * 2).alias("score"), F.col("l_returnflag").alias("evidence"))
    return claims.best_candidate(c).withColumn("evidence", F.array_join("evidence", ","))


_YAML = ["# languages", "Ada:", "  type: programming", "  language_id: 11", "", "CSV:", "  type: data", "Go:", "  type: programming", "  group: x"]


@query("yaml_sections", "SELECT * FROM (VALUES ('Ada', 'programming'), ('Go', 'programming')) AS t(name, type)")
def yaml_sections(spark, sf_dir):
    lines = spark.createDataFrame([(1, i, x) for i, x in enumerate(_YAML)], "doc int, line_no int, line string")
    return claims.carried_sections(lines).filter("type = 'programming'").select("name", "type")


@query("stage_qualify", t.with_derived("candidates", "qualification") + """ SELECT c.registry, c.name, c.priority FROM candidates c LEFT JOIN qualification q ON c.registry = q.registry AND c.name = q.name
    WHERE c.status = 'PENDING' AND c.priority >= 10 AND coalesce(q.status, 'PENDING') IN ('PENDING', 'RETRY') AND coalesce(q.attempts, 0) < 5 AND (q.retry_at IS NULL OR q.retry_at <= 700)""")
def stage_qualify(spark, sf_dir):
    return stages.to_qualify(t.derived(spark, sf_dir, "candidates"), t.derived(spark, sf_dir, "qualification"), F.lit(700), 10)


@query("stage_authorise", t.with_derived("candidates", "qualification", "authority") + """ SELECT q.registry, q.name, q.score FROM qualification q JOIN candidates c ON c.registry = q.registry AND c.name = q.name LEFT JOIN authority a ON a.registry = q.registry AND a.name = q.name
    WHERE q.qualification_status = 'READY_FOR_AUTHORITY' AND c.status <> 'DELETED' AND (a.qualification_checked_at IS NULL OR a.qualification_checked_at < q.checked_at)""")
def stage_authorise(spark, sf_dir):
    return stages.to_authorise(t.derived(spark, sf_dir, "qualification"), t.derived(spark, sf_dir, "candidates"), t.derived(spark, sf_dir, "authority"))


@query("stage_target", t.with_derived("authority", "qualification", "targets") + """ SELECT a.registry, a.name, q.score FROM authority a JOIN qualification q ON a.registry = q.registry AND a.name = q.name LEFT JOIN targets t ON t.registry = a.registry AND t.name = a.name
    WHERE a.authority_status = 'AUTHORITY_VERIFIED' AND (t.authority_checked_at IS NULL OR t.authority_checked_at <> a.checked_at)""")
def stage_target(spark, sf_dir):
    return stages.to_target(t.derived(spark, sf_dir, "authority"), t.derived(spark, sf_dir, "qualification"), t.derived(spark, sf_dir, "targets"))


@query("stage_fetch", t.with_derived("targets", "fetched") + """ SELECT t.registry, t.name, t.target_url, f.target_url IS NOT NULL AND t.target_url <> f.target_url AS moved FROM targets t LEFT JOIN fetched f ON t.registry = f.registry AND t.name = f.name
    WHERE f.status IS NULL OR f.status <> 'SUCCESS' OR t.target_url <> f.target_url""")
def stage_fetch(spark, sf_dir):
    return stages.to_fetch(t.derived(spark, sf_dir, "targets"), t.derived(spark, sf_dir, "fetched"))


@query("stage_counts", t.with_derived("qualification") + " SELECT qualification_status, count(*) AS n FROM qualification GROUP BY 1")
def stage_counts(spark, sf_dir):
    return stages.stage_counts(t.derived(spark, sf_dir, "qualification"), "qualification_status")


@query("backlog", t.with_derived("candidates", "qualification", "authority") + """ SELECT registry, pending, coalesce(ready, 0) AS ready, coalesce(unverified, 0) AS unverified FROM (SELECT registry, count(*) FILTER (status = 'PENDING') AS pending FROM candidates GROUP BY 1)
    LEFT JOIN (SELECT registry, count(*) FILTER (qualification_status = 'READY_FOR_AUTHORITY') AS ready FROM qualification GROUP BY 1) USING (registry) LEFT JOIN (SELECT registry, count(*) FILTER (authority_status <> 'AUTHORITY_VERIFIED') AS unverified FROM authority GROUP BY 1) USING (registry)""")
def backlog(spark, sf_dir):
    return stages.backlog(*(t.derived(spark, sf_dir, n) for n in ("candidates", "qualification", "authority"))).select("registry", "pending", "ready", "unverified")


def _counted(table: str, name: str, test: str) -> str:
    return f"LEFT JOIN (SELECT registry, count(*) AS {name} FROM {table} WHERE {test} GROUP BY 1) USING (registry)"


@query("backlog_full", t.with_derived("backlog_candidates", "qualification", "authority", "backlog_targets", "backlog_state") + """ SELECT registry, coalesce(pending, 0) AS pending, coalesce(ready, 0) AS ready, coalesce(verified, 0) AS verified, coalesce(unverified, 0) AS unverified,
    coalesce(docs_discovery_required, 0) AS docs_discovery_required, coalesce(docs_ready, 0) AS docs_ready, coalesce(fetch_retry_or_partial, 0) AS fetch_retry_or_partial FROM (SELECT DISTINCT registry FROM backlog_candidates) """ + " ".join((
        _counted("backlog_candidates", "pending", "status IN ('PENDING', 'RETRY')"), _counted("qualification", "ready", "qualification_status = 'READY_FOR_AUTHORITY'"),
        _counted("authority", "verified", "authority_status = 'AUTHORITY_VERIFIED'"), _counted("authority", "unverified", "authority_status <> 'AUTHORITY_VERIFIED'"),
        _counted("backlog_targets", "docs_discovery_required", "target_status = 'DOCS_DISCOVERY_REQUIRED'"), _counted("backlog_targets", "docs_ready", "target_status = 'READY_FOR_DOCS_CONNECTOR'"),
        _counted("backlog_state", "fetch_retry_or_partial", "status IN ('RETRY', 'PARTIAL')"),
    )))
def backlog_full(spark, sf_dir):
    return stages.backlog(*(t.derived(spark, sf_dir, n) for n in ("backlog_candidates", "qualification", "authority", "backlog_targets", "backlog_state")))


@query("event_windows", "SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def event_windows(spark, sf_dir):
    return windowed_counts(t.table(spark, sf_dir, "events")).withColumn("total", F.round("total", 4))


@query("event_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) >= 50")
def event_props(spark, sf_dir):
    return t.table(spark, sf_dir, "events").select("event_id", F.expr("try_variant_get(parse_json(props), '$.k', 'bigint')").alias("k")).filter("k >= 50")


# --- sources over tables --------------------------------------------------------------------------


@query("area_rows", "SELECT c_custkey, c_name AS id FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'CIV_' ELSE 'X_' END || c_custkey || '_' || CASE WHEN c_custkey % 2 = 0 THEN 'A' ELSE 'M' END AS c_name, CASE WHEN c_custkey % 7 = 0 THEN 'civ' ELSE 'FRA' END AS a FROM customer) WHERE (upper(a) = 'CIV' OR starts_with(c_name, 'CIV_')) AND c_name LIKE '%A'")
def area_rows(spark, sf_dir):
    k = F.col("c_custkey")
    rid = F.concat(F.when(k % 3 == 0, "CIV_").otherwise("X_"), k.cast("string"), F.lit("_"), F.when(k % 2 == 0, "A").otherwise("M"))
    c = t.table(spark, sf_dir, "customer").select("c_custkey", rid.alias("id"), F.when(k % 7 == 0, "civ").otherwise("FRA").alias("ref_area"), F.lit(None).cast("string").alias("freq"))
    return records.reference_area(c, "CIV", ("a",)).select("c_custkey", "id")


@query("alias_rows", "SELECT n_nationkey FROM nation WHERE n_name IN ('FRANCE', 'KENYA')")
def alias_rows(spark, sf_dir):
    n = t.table(spark, sf_dir, "nation").withColumn("other", F.lit(None).cast("string"))
    return records.country_rows(n, ["other", "n_name"], [" france", "Kenya "]).select("n_nationkey")


@query("request_batches", "SELECT n // 60 AS batch, count(*) AS n_keys, min(k) AS low FROM (SELECT s_suppkey AS k, row_number() OVER (ORDER BY s_suppkey) - 1 AS n FROM supplier) GROUP BY 1")
def request_batches(spark, sf_dir):
    b = records.batches(t.table(spark, sf_dir, "supplier"), "s_suppkey", 60)
    return b.select("batch", F.size("keys").cast("long").alias("n_keys"), F.array_min("keys").alias("low"))


@query("tree_diff", t.with_derived("before", "now") + """ SELECT 'docs/' || coalesce(b.k, n.k) || '.md' AS path, CASE WHEN b.k IS NULL THEN 'ADDED' WHEN n.k IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS change FROM before b FULL JOIN now n ON b.k = n.k WHERE b.signature IS DISTINCT FROM n.signature""")
def tree_diff(spark, sf_dir):
    tree = lambda n: t.derived(spark, sf_dir, n).select(F.concat(F.lit("docs/"), F.col("k").cast("string"), F.lit(".md")).alias("path"), F.col("signature").cast("string").alias("sha"))
    return web.tree_diff(tree("before"), tree("now"), ("docs/",))


@query("revalidation", t.with_derived("before", "now") + """ SELECT CAST(n.k AS VARCHAR) AS url, CASE WHEN n.signature = b.signature THEN 'SKIP' ELSE 'FETCH' END AS action FROM now n LEFT JOIN before b ON b.k = n.k UNION ALL SELECT CAST(k AS VARCHAR), 'REMOVE' FROM before WHERE k NOT IN (SELECT k FROM now)""")
def revalidation(spark, sf_dir):
    rows = lambda n: t.derived(spark, sf_dir, n).select(F.col("k").cast("string").alias("url"), F.col("signature").cast("string").alias("lastmod"))
    return web.revalidation_plan(rows("now"), rows("before"), True)


@query("link_catalogue", rf"SELECT page_url, count(*) AS n, count(*) FILTER (d) AS n_downloads FROM (SELECT DISTINCT url AS page_url, replace(trim(h), '&amp;', '&') AS h, regexp_matches(h, '(?i)\.(csv|json|jsonl|parquet|xlsx?|zip|gz|pdf|dta|sav|pbf)([?#]|$)') AS d FROM (SELECT url, unnest({_LINKS}) AS h FROM pages)) GROUP BY 1")
def link_catalogue(spark, sf_dir):
    return web.link_catalogue(t.table(spark, sf_dir, "pages")).groupBy("page_url").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_download").alias("n_downloads"))


@query("page_chunks")
def page_chunks(spark, sf_dir):
    return web.page_chunks(t.table(spark, sf_dir, "pages"), "pages")


@query("repair_plan", t.with_derived("artifacts") + " SELECT source_id, artifact_id, status FROM artifacts WHERE status IN ('LOCAL_MISSING', 'CORRUPTED', 'FAILED')")
def repair_plan(spark, sf_dir):
    return ledger.repair_plan(t.derived(spark, sf_dir, "artifacts")).select("source_id", "artifact_id", "status")


@query("run_close_out", "SELECT l_shipdate AS run_id, count(DISTINCT (l_orderkey, l_linenumber)) AS artifacts, sum(l_quantity)::BIGINT AS bytes FROM lineitem GROUP BY 1")
def run_close_out(spark, sf_dir):
    li = t.table(spark, sf_dir, "lineitem")
    return ledger.finish_runs(li.select(F.col("l_shipdate").alias("run_id"), F.col("l_orderkey").alias("source_id"), F.col("l_linenumber").alias("artifact_id"), F.col("l_quantity").cast("long").alias("size_bytes")))


_STATS = "CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END + CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 0 END"


def _runs(spark, sf_dir):
    k = F.col("o_orderkey")
    stats = F.struct(F.when(k % 5 == 0, 1).otherwise(0).alias("failed"), F.when(k % 7 == 0, 2).alias("backlog_count"), F.lit(0).alias("deferred_budget"), F.lit(None).cast("int").alias("skipped_oversize"))
    o = t.table(spark, sf_dir, "orders")
    return o.select(k.alias("source_id"), F.when(k % 3 == 0, "error").otherwise("success").alias("status"), stats.alias("stats"), F.col("o_orderdate").cast("timestamp").alias("last_attempt"), F.when(k % 2 == 0, 24).alias("retry_hours"))


@query("partial_runs", f"SELECT o_orderkey AS source_id, CASE WHEN o_orderkey % 3 = 0 THEN 'error' WHEN {_STATS} > 0 THEN 'partial' ELSE 'success' END AS status FROM orders")
def partial_runs(spark, sf_dir):
    return ledger.mark_partial(_runs(spark, sf_dir)).select("source_id", "status")


@query("retry_due", f"SELECT o_orderkey AS source_id FROM orders WHERE {_STATS} > 0 AND o_orderkey % 4 <> 0 AND TIMESTAMP '1995-06-17 12:00:00' >= o_orderdate + CASE WHEN o_orderkey % 2 = 0 THEN INTERVAL 24 HOUR ELSE INTERVAL 6 HOUR END")
def retry_due(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    return ledger.retry_due(runs, F.lit("1995-06-17 12:00:00").cast("timestamp"), runs.filter("source_id % 4 = 0"))


@query("baseline", t.with_derived("sources") + f" SELECT source_id FROM sources WHERE enabled AND auto_sync AND {_PUBLIC} AND sync_status = 'SUCCESS' AND delivery_status <> 'EMPTY'")
def baseline(spark, sf_dir):
    return _sources(spark, sf_dir).filter("enabled and auto_sync and public and sync_status = 'SUCCESS' and delivery_status <> 'EMPTY'").select("source_id").orderBy("source_id")


@query("registry_audit", t.with_derived("sources", "artifacts") + " SELECT s.source_id, s.priority, coalesce(n, 0) AS artifacts FROM sources s LEFT JOIN (SELECT source_id, count(*) AS n FROM artifacts GROUP BY 1) a ON a.source_id = s.source_id")
def registry_audit(spark, sf_dir):
    n = t.derived(spark, sf_dir, "artifacts").groupBy("source_id").agg(F.count(F.lit(1)).alias("artifacts"))
    return t.derived(spark, sf_dir, "sources").select("source_id", "priority").join(n, "source_id", "left").fillna(0, ["artifacts"])


@query("classified_rows", "SELECT p_type, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1")
def classified_rows(spark, sf_dir):
    li = t.table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_quantity")
    both = records.classified(li, t.table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_partkey")
    return both.groupBy("p_type").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query("unmapped_datasets", "SELECT o_orderkey AS id, o_orderpriority AS domain FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') ORDER BY o_orderpriority, o_orderkey LIMIT 50")
def unmapped_datasets(spark, sf_dir):
    o = t.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("domain"))
    mapped = t.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    return o.join(mapped, "id", "left_anti").orderBy("domain", "id").limit(50)


@query("catalogue_top", "SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0 ORDER BY c_custkey % 100 DESC, c_custkey % 37 DESC, lower(c_name) LIMIT 100")
def catalogue_top(spark, sf_dir):
    k = F.col("c_custkey")
    return t.table(spark, sf_dir, "customer").filter("c_acctbal > 0").orderBy(F.desc(k % 100), F.desc(k % 37), F.lower("c_name")).limit(100).select("c_custkey", "c_name")


@query("upsert_nonempty", "SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 AND c_custkey % 4 <> 0 THEN 'new' ELSE c_name END AS name, c_mktsegment AS segment FROM customer")
def upsert_nonempty(spark, sf_dir):
    k = F.col("c_custkey")
    c = t.table(spark, sf_dir, "customer").select(k.alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    new = c.filter("k % 3 = 0").select("k", F.when(F.col("k") % 4 != 0, "new").otherwise("").alias("name"), F.lit("").alias("segment"))
    return changes.upsert(c, new, ["k"], {"name": "nonempty", "segment": "nonempty"})


@query("site_crawl")
def site_crawl(spark, sf_dir):
    pages = t.table(spark, sf_dir, "pages").select("url", "html").filter("url is not null")
    return web.crawl(pages, pages.agg(F.min("url")).first()[0].split("#")[0])


@query("package_records", "SELECT * FROM (VALUES ('crates.io', 'c', '0.3.0', 'https://github.com/a/c'), ('rubygems.org', 'r', '4.0', NULL)) AS t(registry, name, latest_stable_version, canonical_repository)")
def package_records(spark, sf_dir):
    rows = [("crates.io", '{"crate": {"id": "c", "max_stable_version": "0.3.0", "repository": "https://github.com/a/c"}}'), ("rubygems.org", '{"name": "r", "version": "4.0"}')]
    v = spark.createDataFrame(rows, "registry string, j string").select("registry", F.lit("x").alias("asked"), F.expr("parse_json(j)").alias("payload"))
    return adapters.native_metadata(v).select("registry", "name", "latest_stable_version", "canonical_repository")


@query("config_layers", "SELECT * FROM (VALUES ('a.b', '3'), ('a.c', '2'), ('d', '\"x\"')) AS t(path, value)")
def config_layers(spark, sf_dir):
    return registry.layered(spark, [{"a": {"b": 1, "c": 2}}, {"a": {"b": 3}, "d": "x"}])


@query("manifests", t.with_derived("sources") + """ SELECT source_id, '{"schema_version":3,"source_id":' || source_id || ',"status":{"delivery_status":"' || delivery_status || '","sync_status":"' || sync_status || '"},"rights":{"rights_tier":"' || rights_tier || '","access_tier":"' || access_tier
    || '"},"inventory":{"files":' || failed || ',"bytes":' || backlog || ',"rows":' || needs_ocr || '}}' AS manifest FROM sources WHERE delivery_status IS NOT NULL""")
def manifests(spark, sf_dir):
    s = t.derived(spark, sf_dir, "sources").filter("delivery_status is not null").withColumn("freshness_status", F.lit(None).cast("string"))
    return sinks.manifest(s.withColumnsRenamed({"failed": "files", "backlog": "bytes", "needs_ocr": "rows"}))


@query("conflict_recheck", t.with_derived("authority", "qualification") + " SELECT a.registry, a.name, q.score FROM authority a JOIN qualification q ON a.registry = q.registry AND a.name = q.name WHERE authority_status = 'AUTHORITY_REVIEW' ORDER BY q.score DESC, a.registry, a.name LIMIT 25")
def conflict_recheck(spark, sf_dir):
    a = t.derived(spark, sf_dir, "authority").replace({"AUTHORITY_REVIEW": "AUTHORITY_CONFLICT"}, subset=["authority_status"])
    return technologies.conflicts_to_recheck(a, t.derived(spark, sf_dir, "qualification")).select("registry", "name", "score")


@query("recalibration", t.with_derived("candidates", "qualification") + """, s AS (SELECT q.registry, q.name, q.score AS old, q.score AS native, least(100, round_even(q.score * 0.45::DOUBLE + q.score * 0.35::DOUBLE + c.priority * 0.20::DOUBLE, 0)::INT) AS score, c.priority FROM qualification q JOIN candidates c ON c.registry = q.registry AND c.name = q.name),
    d AS (SELECT *, CASE WHEN (native >= 55 AND score >= 40) OR (priority >= 80 AND native >= 30) THEN 'READY_FOR_AUTHORITY' WHEN native >= 30 THEN 'QUALIFIED_ON_DEMAND' ELSE 'NEEDS_METADATA' END AS status FROM s) SELECT registry, name, score, status FROM d WHERE score <> old OR status <> 'QUALIFIED_ON_DEMAND'""")
def recalibration(spark, sf_dir):
    q = t.derived(spark, sf_dir, "qualification").select("registry", "name", "score", F.lit("QUALIFIED_ON_DEMAND").alias("status"), F.col("score").alias("importance"), F.col("score").alias("native"), F.lit("1").alias("stable"), F.lit(None).cast("string").alias("repository"))
    return technologies.recalibrated(q, t.derived(spark, sf_dir, "candidates"))


@query("catalogue_audit", "SELECT c_mktsegment AS category, count(*) AS n, count(*) FILTER (c_custkey % 3 <> 0) AS with_repository, count(*) FILTER (c_custkey % 4 <> 0) AS with_documentation, count(*) FILTER (c_custkey % 100 >= 80) AS verified FROM customer GROUP BY 1")
def catalogue_audit(spark, sf_dir):
    a = technologies.catalogue_audit(t.derived(spark, sf_dir, "technologies")).filter("dimension = 'category'")
    return a.select(F.col("value").alias("category"), "n", "with_repository", "with_documentation", "verified")


_TECHNOLOGY_GROUPS = {"category": "category", "officiality_status": "coalesce(nullif(officiality_status, ''), 'UNVERIFIED')", "registry": "registry", "importance_tier": "coalesce(importance_tier, 'UNSCORED')", "authority_source": "coalesce(authority_source, 'UNKNOWN')", "all": "'all'"}


@query("catalogue_audit_full", t.with_derived("technologies") + " " + " UNION ALL ".join(f"""SELECT '{d}' AS dimension, {e} AS value, count(*) AS n, count(*) FILTER (enabled_for_corpus) AS enabled, count(*) FILTER (canonical_repository <> '') AS with_repository,
    count(*) FILTER (documentation_url <> '') AS with_documentation, count(*) FILTER (latest_stable_version <> '') AS with_version, count(*) FILTER (officiality_score >= 80) AS verified, count(*) FILTER (starts_with(identity_status, 'CANONICAL')) AS canonical,
    count(*) FILTER (starts_with(identity_status, 'ALIAS')) AS aliases, count(*) FILTER (identity_status = 'MONOREPO_AMBIGUOUS') AS ambiguous FROM technologies WHERE {e} IS NOT NULL GROUP BY 2""" for d, e in _TECHNOLOGY_GROUPS.items()))
def catalogue_audit_full(spark, sf_dir):
    return technologies.catalogue_audit(t.derived(spark, sf_dir, "technologies"))


@query("registry_stats", _LIVE + ", a AS (SELECT package, max(live) > 0 AS alive FROM v GROUP BY 1) SELECT 'nuget.org' AS registry, count(*) AS packages, count(*) FILTER (alive) AS live, count(*) FILTER (NOT alive) AS deleted FROM a")
def registry_stats(spark, sf_dir):
    alive = changes.package_alive(changes.liveness(t.derived(spark, sf_dir, "index_events")))
    return technologies.registry_stats(alive.withColumn("registry", F.lit("nuget.org")))


@query("fetch_coverage", t.with_derived("targets", "fetched") + " SELECT count(*) FILTER (f.status = 'SUCCESS' AND f.target_url = t.target_url) AS covered, count(*) FILTER (f.status = 'SUCCESS' AND f.target_url <> t.target_url) AS migrations_due FROM targets t JOIN fetched f ON t.registry = f.registry AND t.name = f.name")
def fetch_coverage(spark, sf_dir):
    return technologies.fetch_coverage(t.derived(spark, sf_dir, "targets"), t.derived(spark, sf_dir, "fetched"))


@query("source_metadata", t.with_derived("sources") + " SELECT source_id, CASE WHEN source_id % 4 = 0 THEN 'en' ELSE 'fr' END AS language, domain AS primary_domain, CASE WHEN domain = 'multidomain' THEN 'PARTIAL' ELSE 'CONFIGURED' END AS classification_status FROM sources")
def source_metadata(spark, sf_dir):
    s = t.derived(spark, sf_dir, "sources").withColumn("options", F.when(F.col("source_id") % 4 == 0, F.create_map(F.lit("language"), F.lit("en"))).otherwise(F.create_map(F.lit("language"), F.lit(""))))
    return technologies.source_metadata(s, "XX", "Nowhere").select("source_id", "language", "primary_domain", "classification_status")


@query("unique_merge", "SELECT c_custkey, array_to_string(list_distinct([x FOR x IN [c_mktsegment, 'A', c_mktsegment, 'B'] IF x <> '']), ',') = '' AS none, len(list_distinct([c_mktsegment, 'A', 'B'])) AS n FROM customer")
def unique_merge(spark, sf_dir):
    m = technologies.merged_unique(F.array("c_mktsegment", F.lit("A")), F.array("c_mktsegment", F.lit(""), F.lit("B")), F.lit(None).cast("array<string>"))
    return t.table(spark, sf_dir, "customer").select("c_custkey", (F.array_join(m, ",") == "").alias("none"), F.size(m).alias("n"))
