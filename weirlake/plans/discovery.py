"""Documentation candidates, their redirects and the trust that links carry, from the pages of the driver's table."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirlake.functions.urls import canonical_documentation_url
from weirlake.operators import documentation as docs
from weirlake.operators.staging import spread
from weirlake.plans import tables as t
from weirlake.plans.registered import query

# A project a site (the last three labels of a host). Its pages are its website's, some of whose links lead to documentation here or
# elsewhere; every third page comes with the payloads of a repository, every fourth with an llms.txt.
_CANON = r"""regexp_extract(u, '^([a-z]+)://', 1) || '://' || lower(regexp_extract(u, '^[a-z]+://([^/?#]*)', 1)) ||
    CASE WHEN regexp_replace(regexp_extract(u, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') = '' THEN '/' ELSE regexp_replace(regexp_extract(u, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') END ||
    CASE WHEN k = '' THEN '' ELSE '?' || k END"""
_KEPT = r"""array_to_string(list_transform(list_filter(string_split(regexp_extract(u, '^[^?#]*\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(ref|source|campaign|mc_cid|mc_eid)(=|$)|^(utm_|ref_)')),
    lambda x: CASE WHEN contains(x, '=') THEN x ELSE x || '=' END), '&')"""
_SIGNAL = "regexp_matches(lower(regexp_replace({0}, '[^a-zA-Z0-9]+', ' ', 'g')), '(^| )(docs|documentation|developer|developers|guide|guides|manual|reference|api|learn|tutorial|handbook)( |$)')"
CANDIDATES_SQL = rf"""
pg AS (SELECT page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host, regexp_extract(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '([^.]+\.[^.]+\.[^.]+)$', 1) AS project,
       CASE page_id % 3 WHEN 0 THEN replace(html, 'href="/th', 'href="/docs/th') WHEN 1 THEN replace(html, 'href="/', 'href="https://api.example.dev/') ELSE html END AS body FROM pages),
l AS (SELECT project, host, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS base, unnest(regexp_extract_all(body, '<a href="([^"]*)"', 1)) AS h FROM pg),
raw AS (
    SELECT project, url AS u, NULL AS host, 'root' AS sort FROM pg
    UNION ALL SELECT project, CASE WHEN starts_with(h, 'https:') THEN h ELSE base || h END, host, 'link' FROM (SELECT project, host, base, replace(trim(h), '&amp;', '&') AS h FROM l)
    UNION ALL SELECT project, 'https://' || host || '/docs/all' || (page_id % 5), NULL, 'llms' FROM pg WHERE page_id % 4 = 0
    UNION ALL SELECT project, url, NULL, 'home' FROM pg WHERE page_id % 6 = 0
    UNION ALL SELECT project, 'https://github.com/o/' || project || '/tree/dev/docs', NULL, 'dir' FROM pg WHERE page_id % 9 = 0
    UNION ALL SELECT project, 'https://github.com/o/' || project || '/guide/p' || (page_id % 7) || '.md', NULL, 'readme' FROM pg WHERE page_id % 3 = 0),
cn AS (SELECT project, host, sort, {_CANON} AS url FROM (SELECT *, {_KEPT} AS k FROM raw)),
sc AS (SELECT project, url, sort, CASE WHEN host IS NULL THEN NULL ELSE h = host OR ends_with(h, '.' || host) OR ends_with(host, '.' || h) END AS near, {_SIGNAL.format("url")} AS sig FROM (SELECT *, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS h FROM cn)),
cd AS (SELECT project, url, CASE sort WHEN 'home' THEN CASE WHEN sig THEN 94 ELSE 90 END WHEN 'dir' THEN 100 WHEN 'readme' THEN 97 WHEN 'root' THEN CASE WHEN sig THEN 92 ELSE 86 END WHEN 'link' THEN CASE WHEN near THEN 96 ELSE 94 END ELSE 98 END AS score,
       CASE sort WHEN 'home' THEN 0 WHEN 'dir' THEN 1 WHEN 'readme' THEN 2 WHEN 'root' THEN 3 WHEN 'link' THEN 4 ELSE 5 END AS surface,
       CASE sort WHEN 'home' THEN 'VERIFIED_REPOSITORY_DECLARED_HOMEPAGE' WHEN 'dir' THEN 'VERIFIED_REPOSITORY_DOCS_DIRECTORY' WHEN 'readme' THEN 'VERIFIED_REPOSITORY_README_DOCS_LINK' WHEN 'root' THEN 'VERIFIED_PROJECT_WEBSITE'
           WHEN 'link' THEN 'OFFICIAL_WEBSITE_LINKS_DOCUMENTATION,' || CASE WHEN near THEN 'RELATED_DOCUMENTATION_HOST' ELSE 'EXTERNAL_DOCS_LINK_FROM_OFFICIAL_WEBSITE' END ELSE 'OFFICIAL_WEBSITE_LLMS_TXT_DOCUMENTATION' END AS evidence,
       CASE sort WHEN 'home' THEN 'CANONICAL_REPOSITORY_HOMEPAGE' WHEN 'dir' THEN 'CANONICAL_REPOSITORY_DOCS_DIRECTORY' WHEN 'readme' THEN 'CANONICAL_REPOSITORY_README_DOCS_LINK' WHEN 'root' THEN 'VERIFIED_OFFICIAL_WEBSITE_ROOT'
           WHEN 'link' THEN 'OFFICIAL_WEBSITE_DOCS_LINK' ELSE 'OFFICIAL_WEBSITE_LLMS_DOCS_LINK' END AS kind
       FROM sc WHERE sort <> 'link' OR sig),
un AS (SELECT DISTINCT project, url, score, surface, kind, evidence FROM cd),
best AS (SELECT project, url, max(score) AS score FROM un GROUP BY project, url),
mg AS (SELECT project, url, score, min_by(kind, surface) AS kind, string_agg(evidence, ',' ORDER BY surface) AS evidence FROM un JOIN best USING (project, url, score) GROUP BY project, url, score)
"""


def _pages(spark, sf_dir):
    host = F.lower(F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1))
    body = F.when(F.col("page_id") % 3 == 0, F.replace("html", F.lit('href="/th'), F.lit('href="/docs/th'))).when(F.col("page_id") % 3 == 1, F.replace("html", F.lit('href="/'), F.lit('href="https://api.example.dev/'))).otherwise(F.col("html"))
    pages = spread(t.table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.select("page_id", "url", host.alias("host"), F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1).alias("project"), body.alias("body"))


def _repositories(pages):
    """The payloads of every third page's repository."""
    k = F.col("page_id")
    text = F.concat(F.lit("Read [this]("), F.lit("guide/p"), (k % 7).cast("string"), F.lit(".md 'title')."))
    homepage = F.when(k % 6 == 0, F.col("url"))
    contents = F.when(k % 9 == 0, F.lit('[{"type":"dir","name":"docs","path":"docs"},{"type":"file","name":"guide"}]'))
    rows = pages.filter(k % 3 == 0)
    return rows.select(
        "project", F.concat(F.lit("git+https://www.github.com/o/"), F.col("project"), F.lit(".git")).alias("repository"),
        F.to_json(F.struct(F.lit("dev").alias("default_branch"), homepage.alias("homepage"))).alias("metadata"), contents.alias("contents"),
        F.to_json(F.struct(F.base64(F.encode(text, "UTF-8")).alias("content"))).alias("readme"),
    )


def _merged(pages):
    sites = pages.select("project", F.col("url").alias("website"), F.col("url").alias("final_url"), F.lit("text/html").alias("content_type"), "body")
    home = F.concat(F.lit("https://"), F.col("host"))
    llms = pages.filter("page_id % 4 = 0").select("project", home.alias("website"), F.lit(None).cast("string").alias("final_url"), F.concat(F.lit("- [all](/docs/all"), (F.col("page_id") % 5).cast("string"), F.lit(")\n- [none](/x)")).alias("body"))
    found = docs.repository_candidates(_repositories(pages)).unionByName(docs.website_candidates(sites)).unionByName(docs.llms_candidates(llms))
    return docs.merged_candidates(found)


@query("docs_candidates", f"WITH {CANDIDATES_SQL} SELECT project, url, score, kind, evidence FROM mg")
def docs_candidates(spark, sf_dir):
    """Every candidate of every site, from repositories, pages and llms.txt."""
    return _merged(_pages(spark, sf_dir)).withColumn("evidence", F.array_join("evidence", ","))


# Pages redirect to the page of half their number, odd ones of a residue in a circle of two.
REDIRECTS_SQL = rf"""
cu AS (SELECT page_id, {_CANON} AS url FROM (SELECT *, {_KEPT} AS k FROM (SELECT page_id, url AS u FROM pages))),
rp AS (SELECT a.url AS url, min(b.url) AS target FROM cu a JOIN cu b ON b.page_id = CASE WHEN a.page_id % 8 = 7 THEN a.page_id - 2 WHEN a.page_id % 8 = 5 THEN a.page_id + 2 WHEN a.page_id % 2 = 0 THEN a.page_id // 2 END WHERE a.url <> b.url GROUP BY a.url),
ch AS (SELECT url AS start, target AS cur, 1 AS hops FROM rp UNION ALL SELECT start, target, hops + 1 FROM ch JOIN rp ON rp.url = cur WHERE hops < 31),
en AS (SELECT start AS url, CASE WHEN max(hops) <= 30 THEN max_by(cur, hops) END AS "end" FROM ch GROUP BY start)
"""


def _redirects(pages):
    k = F.col("page_id")
    onto = F.when(k % 8 == 7, k - 2).when(k % 8 == 5, k + 2).when(k % 2 == 0, F.expr("page_id div 2"))
    return pages.select("url", onto.alias("to")).join(pages.select(k.alias("to"), F.col("url").alias("target")), "to").select("url", "target")


@query("docs_redirects", f"WITH RECURSIVE {REDIRECTS_SQL} SELECT url, \"end\" FROM en")
def docs_redirects(spark, sf_dir):
    """Where the pages' redirects end; those in circles end nowhere."""
    moved = _redirects(t.table(spark, sf_dir, "pages").select("page_id", canonical_documentation_url(F.col("url")).alias("url")))
    return docs.redirect_ends(moved).select("url", "end")


@query("docs_selected", f"""WITH RECURSIVE {CANDIDATES_SQL}, {REDIRECTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY project ORDER BY score DESC, url) AS k FROM mg WHERE score >= 85)
    SELECT project, CASE WHEN en.url IS NULL THEN r.url ELSE en."end" END AS url, score, kind, evidence || CASE WHEN en.url IS NULL THEN '' ELSE ',TARGET_REDIRECT_CANONICALIZED' END AS evidence
    FROM r LEFT JOIN en ON en.url = r.url WHERE k = 1 AND (en.url IS NULL OR en."end" IS NOT NULL)""")
def docs_selected(spark, sf_dir):
    """Every site's documentation, moved to where it redirects."""
    pages = _pages(spark, sf_dir)
    return docs.selected_candidates(_merged(pages), _redirects(pages.select("page_id", "url"))).withColumn("evidence", F.array_join("evidence", ","))


# Pages, hosts and sites as a graph: a page speaks for its host and for what it links to, a host for its site, a site for its hosts.
TRUST_SQL = rf"""
p AS (SELECT page_id, regexp_extract(url, '^[^#?]*') AS page, lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)) AS host, regexp_extract(lower(regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)), '([^.]+\.[^.]+\.[^.]+)$', 1) AS site,
      regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) AS base, html FROM pages),
w AS (SELECT src, dst, max(weight) AS weight FROM (
    SELECT page AS src, host AS dst, 97 AS weight FROM p UNION ALL SELECT host, site, 98 FROM p WHERE host <> site UNION ALL SELECT site, host, 99 FROM p WHERE host <> site UNION ALL SELECT host, page, 96 FROM p WHERE page_id % 3 = 0
    UNION ALL SELECT page, base || regexp_replace(replace(trim(h), '&amp;', '&'), '[?#].*$', ''), 95 FROM (SELECT page, base, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS h FROM p)) WHERE src <> dst GROUP BY src, dst),
s AS (SELECT page AS node, 100 AS score FROM p WHERE page_id % 7 = 0 UNION SELECT (score_node).node, (score_node).score FROM (
    SELECT {{'node': w.dst, 'score': s.score * w.weight // 100}} AS score_node FROM s JOIN w ON w.src = s.node WHERE s.score * w.weight // 100 >= 85))
"""


@query("docs_trust", f"WITH RECURSIVE {TRUST_SQL} SELECT node, max(score)::BIGINT AS score FROM s GROUP BY node")
def docs_trust(spark, sf_dir):
    """The trust that arrives at pages, hosts and sites from every seventh page."""
    host = F.lower(F.regexp_extract("url", r"^[a-z]+://([^/?#]*)", 1))
    pages = spread(t.table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    p = pages.select("page_id", F.regexp_extract("url", r"^([^#?]*)", 1).alias("page"), host.alias("host"), F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1).alias("site"), "url", "html")
    weighted = lambda rows, a, b, w: rows.select(F.col(a).alias("src"), F.col(b).alias("dst"), F.lit(w).alias("weight"))
    anchors = p.select("page", "url", F.explode(docs.html_anchors(F.col("html"))).alias("a")).select("page", F.regexp_replace(docs.resolved(F.col("url"), F.col("a.href")), r"[?#].*$", "").alias("to"))
    links = weighted(p, "page", "host", 97).unionByName(weighted(p, "host", "site", 98)).unionByName(weighted(p, "site", "host", 99)).unionByName(weighted(p.filter("page_id % 3 = 0"), "host", "page", 96)).unionByName(weighted(anchors, "page", "to", 95))
    return docs.carried_trust(p.filter("page_id % 7 = 0").select(F.col("page").alias("node"), F.lit(100).alias("score")), links).select("node", "score")
