"""Web and documentation sources over stored pages: link catalogues, bounded crawls, discovery and tree diffs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirlake.functions.markup import html_links, html_text_parsed, markdown_links, sitemap_entries
from weirlake.functions.text import chunk_id, chunks, clean_text, title
from weirlake.functions.urls import crawl_url, docs_url, git_link_score, in_scope, part, same_host_links, within_subtree
from weirlake.operators.changes import changed, tombstones

DOWNLOADS = r"(?i)\.(csv|json|jsonl|parquet|xlsx?|zip|gz|pdf|dta|sav|pbf)$"
GIT_TEXT = r"(?i)\.(md|mdx|markdown|rst|adoc|asciidoc|txt)$"


def link_catalogue(pages: DataFrame, pattern: str = DOWNLOADS) -> DataFrame:
    """(page_url, url, is_download) of the links of pages (url, html), a link once a page, however many rows the page has."""
    links = pages.select(F.col("url").alias("page_url"), F.explode(F.array_distinct(html_links(F.col("html")))).alias("url")).distinct()
    return links.withColumn("is_download", part(F.col("url"), "path").rlike(pattern))


def crawl(pages: DataFrame, seed: str, most: int = 500) -> DataFrame:
    """(url, depth) of at most ``most`` pages of (url, html) reached from the seed by links on its host, breadth first.

    The limit is the crawl's feature and counts stored pages only; within a level urls come in order. Links to
    pages that are not stored are left out before that, and a chain of links is followed to its end.
    """
    spark = pages.sparkSession
    known = pages.select(crawl_url(F.col("url")).alias("url"), "html").dropDuplicates(["url"])
    links = known.select("url", F.explode(same_host_links(F.col("url"), html_links(F.col("html")))).alias("to"))
    # Asked once a level, so pages are parsed once.
    edges = links.join(known.select(F.col("url").alias("to")), "to", "left_semi").persist()
    named = lambda urls, name: spark.createDataFrame([(u,) for u in urls], f"{name} string")
    try:
        here = [r.url for r in known.select("url").join(named([seed], "url"), "url", "left_semi").collect()]
        seen, depth = [], 0
        while here:
            seen += [(u, depth) for u in here]
            depth += 1
            if len(seen) >= most:
                break
            step = edges.join(named(here, "url"), "url", "left_semi").select("to").distinct()
            here = [r.to for r in step.join(named((u for u, _ in seen), "to"), "to", "left_anti").orderBy("to").limit(most - len(seen)).collect()]
    finally:
        edges.unpersist()
    return spark.createDataFrame(seen, "url string, depth int")


def page_chunks(pages: DataFrame, source_id: str, size: int = 3500, overlap: int = 250) -> DataFrame:
    """Chunk rows of pages (url, html): id, source, url, title, digest of the text, index and text."""
    body = pages.select("url", clean_text(html_text_parsed(F.col("html"))).alias("body"))
    sha = F.sha2(F.encode("body", "UTF-8"), 256)
    rows = body.select("url", title(F.col("body")).alias("title"), sha.alias("content_sha256"), F.posexplode(chunks(F.col("body"), size, overlap)).alias("chunk_index", "text"))
    return rows.select(chunk_id(F.lit(source_id), F.col("url"), F.col("content_sha256"), F.col("chunk_index")).alias("chunk_id"), F.lit(source_id).alias("source_id"), "url", "title", "content_sha256", "chunk_index", "text")


def discovered(indexes: DataFrame, host: str, prefix: str) -> DataFrame:
    """(url, lastmod) of the documentation pages that indexes (kind, url, body) name, within a subtree.

    Kinds are sitemap, llms and html. A page that several name keeps its latest time.
    """
    sitemap = indexes.filter("kind = 'sitemap'").select(F.inline(sitemap_entries(F.col("body"))))
    listed = indexes.filter("kind = 'llms'").select(F.explode(markdown_links(F.col("body"))).alias("url")).withColumn("lastmod", F.lit(None).cast("string"))
    linked = indexes.filter("kind = 'html'").select(F.explode(same_host_links(F.col("url"), html_links(F.col("body")))).alias("url")).withColumn("lastmod", F.lit(None).cast("string"))
    every = sitemap.unionByName(listed).unionByName(linked).withColumn("url", docs_url(F.col("url")))
    ok = within_subtree(F.col("url"), host, prefix) & in_scope(F.col("url"), host)
    return every.filter(ok).groupBy("url").agg(F.max("lastmod").alias("lastmod"))


def revalidation_plan(found: DataFrame, state: DataFrame, complete: bool) -> DataFrame:
    """(url, action): SKIP where the time of change stands, FETCH otherwise, REMOVE for known pages that are gone."""
    s = state.select("url", F.col("lastmod").alias("old"), F.lit(True).alias("known"))
    same = F.coalesce(F.col("known"), F.lit(False)) & F.col("lastmod").isNotNull() & (F.col("lastmod") == F.col("old"))
    plan = found.join(s, "url", "left").select("url", F.when(same, "SKIP").otherwise("FETCH").alias("action"))
    gone = tombstones(state.select("url"), found.select("url"), ["url"], complete)
    return plan.unionByName(gone.withColumn("action", F.lit("REMOVE")))


def tree_diff(old: DataFrame, new: DataFrame, prefixes: tuple[str, ...] = (), complete: bool = True) -> DataFrame:
    """(path, change) between two trees (path, sha) of documentation files: ADDED, CHANGED or REMOVED."""
    def scoped(df):
        ok = F.col("path").rlike(GIT_TEXT)
        return df.filter(ok & F.greatest(F.lit(False), *(F.col("path").startswith(p) for p in prefixes)) if prefixes else ok)

    a, b = scoped(old).select("path", F.col("sha").alias("old")), scoped(new).select("path", F.col("sha").alias("new"))
    both = a.join(b, "path", "full_outer").withColumn("change", F.when(F.col("old").isNull(), "ADDED").when(F.col("new").isNull(), "REMOVED").when(F.col("old") != F.col("new"), "CHANGED"))
    out = both.filter("change is not null").select("path", "change")
    return out if complete else out.filter("change <> 'REMOVED'")


def changed_pages(pages: DataFrame, committed: DataFrame) -> DataFrame:
    """Pages of (url, signature) whose body has to be read again."""
    return changed(pages, committed, ["url"])


def strategy(links: DataFrame, least: int = 80) -> DataFrame:
    """(page_url, strategy, repository_url) from labelled links (page_url, url, label): the best scored Git link, else the web."""
    scored = links.withColumn("score", F.coalesce(git_link_score(F.col("url"), F.col("label")), F.lit(-1)))
    best = scored.groupBy("page_url").agg(F.min_by(F.struct("score", "url"), F.struct(-F.col("score"), "url")).alias("b"))
    tree = F.col("page_url").rlike(r"^https?://github\.com/[^/]+/[^/]+/tree/")
    git = F.col("b.score") >= least
    return best.select("page_url", F.when(tree | git, "GIT").otherwise("WEB").alias("strategy"), F.when(tree, F.col("page_url")).when(git, F.col("b.url")).alias("repository_url"))


def one_hop(portals: DataFrame, robots_denied: DataFrame) -> DataFrame:
    """(portal, url): same-host links of portal pages (url, html) that no robots rule (host, prefix) denies."""
    links = portals.select(F.col("url").alias("portal"), F.explode(same_host_links(F.col("url"), html_links(F.col("html")))).alias("url"))
    rules = robots_denied.groupBy("host").agg(F.collect_set("prefix").alias("denied"))
    both = links.withColumn("host", part(F.col("url"), "host")).join(rules, "host", "left")
    hit = F.exists(F.coalesce("denied", F.array().cast("array<string>")), lambda p: part(F.col("url"), "path").startswith(p))
    return both.filter(~hit).select("portal", "url")
