"""Registry feeds: landed pages of each feed as rows of names, ordered change events, or hints.

A page is (page, payload VARIANT) in the order in which pages came; what they hold is folded into the queue by the
change operators (`operators/changes.py`), whatever registry it is from.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirlake.functions.scoring import harvest_priority
from weirlake.sources.records import field


@dataclass(frozen=True)
class Feed:
    """Where a feed's rows are, where a row's name is, how urgent its names are, and whether its rows are changes."""

    registry: str
    rows: str
    names: tuple[str, ...]
    priority: int
    changes: bool = False
    keyed: bool = False


#: Feeds by name: registry, place of rows and names, and priority (fixed values).
FEEDS = {
    "npm-all-docs": Feed("npmjs.org", "$.rows", ("$.id", "$.key"), 15),
    "npm-changes": Feed("npmjs.org", "$.results", ("$.id",), 60, changes=True),
    "packagist-popular": Feed("packagist.org", "$.packages", ("$.name",), 40),
    "packagist-all": Feed("packagist.org", "$.package", (), 20, keyed=True),
    "packagist-changes": Feed("packagist.org", "$.actions", ("$.package",), 60, changes=True),
    "rubygems-latest": Feed("rubygems.org", "$", ("$.name",), 45),
    "rubygems-just_updated": Feed("rubygems.org", "$", ("$.name",), 55),
    "pubdev-ranked": Feed("pub.dev", "$.packages", ("$",), 50),
    "pubdev-package-names": Feed("pub.dev", "$.packages", ("$",), 30),
    "pypi-simple": Feed("pypi.org", "$.projects", ("$.name",), 10),
}
#: Names of npm documents that are no packages.
NOT_PACKAGES = ("_design/", "_local/")


def _rows(feed: Feed) -> Column:
    """Elements as (key, value VARIANT); a keyed object's entries in order of key."""
    if feed.keyed:
        entries = F.array_sort(F.map_keys(F.expr(f"try_variant_get(payload, '{feed.rows}', 'map<string,variant>')")))
        values = F.expr(f"try_variant_get(payload, '{feed.rows}', 'map<string,variant>')")
        return F.transform(entries, lambda k: F.struct(k.alias("key"), F.try_element_at(values, k).alias("value")))
    listed = F.expr(f"try_variant_get(payload, '{feed.rows}', 'array<variant>')")
    return F.transform(listed, lambda v: F.struct(F.lit(None).cast("string").alias("key"), v.alias("value")))


def feed_rows(pages: DataFrame, name: str) -> DataFrame:
    """(registry, name, source, priority, deleted, ord, repository_hint) of a feed's pages (page, payload).

    ``ord`` puts rows in the order in which they came. Rows without a name, and npm's own documents, are left out, as are
    change actions that are neither updates nor deletions.
    """
    feed = FEEDS[name]
    rows = pages.select("page", F.posexplode(_rows(feed)).alias("at", "r")).select("page", "at", "r.key", "r.value")
    own = F.coalesce(*(F.nullif(F.trim(field("value", p)), F.lit("")) for p in feed.names), F.nullif(F.trim("key"), F.lit("")))
    action = F.lower(F.coalesce(field("value", "$.type"), F.lit("update")))
    deleted = F.coalesce(field("value", "$.deleted", "boolean"), F.lit(False)) | (action == "delete") if feed.changes else F.lit(False)
    priority = F.lit(feed.priority)
    if name == "packagist-popular":
        count = lambda p: F.coalesce(field("value", p, "bigint"), F.lit(0))
        priority = harvest_priority(count("$.downloads"), count("$.favers"))
    out = rows.select(
        F.lit(feed.registry).alias("registry"), F.trim(F.replace(own, F.lit("~dev"), F.lit(""))).alias("name") if name == "packagist-changes" else own.alias("name"), F.lit(name).alias("source"), priority.alias("priority"),
        deleted.alias("deleted"), (F.col("page").cast("bigint") * 1_000_000 + F.col("at")).alias("ord"), F.nullif(field("value", "$.repository"), F.lit("")).alias("repository_hint"), action.alias("_action"),
    )
    out = out.filter((F.coalesce("name", F.lit("")) != "") & ~F.startswith("name", F.lit(NOT_PACKAGES[0])) & ~F.startswith("name", F.lit(NOT_PACKAGES[1])))
    if feed.changes and name != "npm-changes":
        out = out.filter(F.col("_action").isin("update", "delete"))
    return out.drop("_action")


def needs_resync(pages: DataFrame) -> bool:
    """Whether a change feed says that it has lost its place: the registry is to be read in full again."""
    actions = pages.select(F.explode(F.expr("try_variant_get(payload, '$.actions', 'array<variant>')")).alias("value"))
    return not actions.filter(F.lower(field("value", "$.type")) == "resync").isEmpty()


def feed_cursor(pages: DataFrame, name: str) -> str | None:
    """Where the feed goes on: the last sequence number, time, serial or page that the last page names; null at the end."""
    last = pages.orderBy(F.desc("page")).limit(1)
    place = {"npm-changes": "$.last_seq", "packagist-changes": "$.timestamp", "pypi-simple": "$.meta._last-serial", "pubdev-package-names": "$.nextUrl"}.get(name)
    if name == "npm-all-docs":
        got = last.select(F.element_at(F.expr("try_variant_get(payload, '$.rows', 'array<variant>')"), -1).alias("value")).select(field("value", "$.id").alias("c")).first()
    else:
        path = "$.meta[\"_last-serial\"]" if name == "pypi-simple" else place
        got = last.select(F.nullif(F.trim(field("payload", path)), F.lit("")).alias("c")).first() if place else None
    return got["c"] if got else None


#: What a public queue does with a source's raw files, by rights (fixed values).
RAW_ACTIONS = {"A_REDISTRIBUTABLE": "FETCH_OPEN"}


def public_queue(sources: DataFrame, most: int | None = None, source_id: str | None = None) -> DataFrame:
    """(source_id, url, domain, rights_tier, raw_action, derived_action) of the sources that may be read in public.

    Closed rights and language sources are left out; ``most`` and ``source_id`` bound one run.
    """
    rows = sources.filter(~F.startswith("rights_tier", F.lit("D_")) & ~F.startswith("domain", F.lit("language_")))
    raw = F.coalesce(*(F.when(F.col("rights_tier") == k, v) for k, v in RAW_ACTIONS.items()), F.lit("LOCAL_CACHE_ONLY"))
    out = rows.select("source_id", F.col("source_url").alias("url"), "domain", "rights_tier", raw.alias("raw_action"), F.lit("BUILD_FACTS_AND_RAG").alias("derived_action"))
    if source_id is not None:
        out = out.filter(F.col("source_id") == source_id)
    return out if most is None else out.limit(most)
