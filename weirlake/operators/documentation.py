"""Documentation candidates of projects from what their repositories and websites publish, redirects, and trust that links carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirlake.functions.bind import let, once
from weirlake.functions.markup import html_anchors, labelled_links, markdown_links
from weirlake.functions.urls import canonical_documentation_url, doc_signal, documentation_candidate, hosts_related, normalize_repository_url, part, resolved
from weirlake.operators.staging import discarded, staged_at

#: Directories that hold documentation, the least score that is taken, and hops of a redirect that are followed (fixed values).
DOC_DIRS = ("doc", "docs", "documentation", "guide", "guides", "manual", "reference")
LEAST = 85
MOST_HOPS = 30
CANDIDATE = "project, url, score, kind, evidence, surface, place"
_METADATA = "html_url string, default_branch string, homepage string"
_CONTENTS = "array<struct<type:string,name:string,path:string,html_url:string>>"


def _candidate(surface: int, place: Column, url: Column, score: Column | int, kind: str, *evidence: Column | str) -> Column:
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(
        url.alias("url"), as_col(score).cast("int").alias("score"), F.lit(kind).alias("kind"), F.array(*map(as_col, evidence)).alias("evidence"),
        F.lit(surface).alias("surface"), place.cast("int").alias("place"),
    )


def _listed(rows: DataFrame, found: Column) -> DataFrame:
    return rows.select("project", F.inline(found)).filter("url is not null").selectExpr(*CANDIDATE.split(", "))


def repository_candidates(repositories: DataFrame) -> DataFrame:
    """Candidates of ``repositories`` (project, repository, metadata, contents, readme), the last three as JSON payloads.

    The declared homepage, directories of documentation, and links of the readme (base64) whose label or target speaks of
    documentation. Only repositories on github.com are looked at. A payload that is null or no JSON gives nothing; without
    metadata the repository's own URL and the branch ``main`` stand in.
    """
    own = normalize_repository_url(F.col("repository"))
    meta = F.from_json("metadata", _METADATA)
    rows = once(repositories.select("project", "metadata", "contents", "readme", own.alias("_own")), {"_m": meta})
    parts = F.filter(F.split(part(F.col("_own"), "path"), "/"), lambda x: x != "")
    rows = rows.filter((part(F.col("_own"), "host") == "github.com") & (F.size(parts) >= 2))
    packed = F.regexp_replace(F.from_json("readme", "content string")["content"], r"\s", "")
    rows = once(rows, {
        "_repo": F.coalesce(normalize_repository_url(F.col("_m.html_url")), F.col("_own")), "_branch": F.coalesce(F.nullif("_m.default_branch", F.lit("")), F.lit("main")),
        "_home": documentation_candidate(F.col("_m.homepage")), "_text": F.make_valid_utf8(F.try_to_binary(packed, F.lit("base64")).cast("string")),
    })
    home = F.array(_candidate(0, F.lit(0), F.col("_home"), F.when(doc_signal(F.col("_home")), 94).otherwise(90), "CANONICAL_REPOSITORY_HOMEPAGE", "VERIFIED_REPOSITORY_DECLARED_HOMEPAGE"))
    dirs = F.filter(F.coalesce(F.from_json("contents", _CONTENTS), F.array().cast(_CONTENTS)), lambda x: (x["type"] == "dir") & F.lower(x["name"]).isin(*DOC_DIRS))
    within = lambda x: canonical_documentation_url(F.concat(F.col("_repo"), F.lit("/tree/"), F.col("_branch"), F.lit("/"), F.coalesce(F.nullif(x["path"], F.lit("")), F.lower(x["name"]))))
    folders = F.transform(dirs, lambda x, i: _candidate(1, i, F.coalesce(documentation_candidate(x["html_url"]), within(x)), 100, "CANONICAL_REPOSITORY_DOCS_DIRECTORY", "VERIFIED_REPOSITORY_DOCS_DIRECTORY"))

    def link(x, i):
        said = lambda u: F.when(doc_signal(x["label"]) | doc_signal(u), u)
        url = let(documentation_candidate(resolved(F.concat(F.col("_repo"), F.lit("/")), x["href"])), said)
        return _candidate(2, i, url, 97, "CANONICAL_REPOSITORY_README_DOCS_LINK", "VERIFIED_REPOSITORY_README_DOCS_LINK")

    return _listed(rows, home).unionByName(_listed(rows, folders)).unionByName(_listed(rows, F.transform(labelled_links(F.col("_text")), link)))


def website_candidates(websites: DataFrame) -> DataFrame:
    """Candidates of ``websites`` (project, website, final_url, content_type, body): the page itself and its links.

    A link counts if its label or target speaks of documentation; it scores more on a related host. Rows whose website is
    no possible documentation are left out; ``final_url`` is where the request ended, null if it was not moved.
    """
    rows = once(websites.select("project", "content_type", "body", documentation_candidate(F.col("website")).alias("_site"), F.coalesce("final_url", "website").alias("_at")).filter("_site is not null"), {
        "_final": F.coalesce(documentation_candidate(F.col("_at")), F.col("_site")),
    })
    root = F.array(_candidate(3, F.lit(0), F.col("_final"), F.when(doc_signal(F.col("_final")), 92).otherwise(86), "VERIFIED_OFFICIAL_WEBSITE_ROOT", "VERIFIED_PROJECT_WEBSITE"))
    html = F.coalesce(F.lower("content_type").contains("html"), F.lit(False)) | F.coalesce(F.col("body").rlike(r"^\s*<"), F.lit(False))

    def link(x, i):
        url = let(documentation_candidate(resolved(F.col("_at"), x["href"])), lambda u: F.when(doc_signal(x["label"]) | doc_signal(u), u))

        def scored(u):
            near = hosts_related(u, F.col("_final"))
            return _candidate(
                4, i, u, F.when(near, 96).otherwise(94), "OFFICIAL_WEBSITE_DOCS_LINK", "OFFICIAL_WEBSITE_LINKS_DOCUMENTATION",
                F.when(near, "RELATED_DOCUMENTATION_HOST").otherwise("EXTERNAL_DOCS_LINK_FROM_OFFICIAL_WEBSITE"),
            )

        return let(url, scored)

    return _listed(rows, root).unionByName(_listed(rows.filter(html), F.transform(html_anchors(F.col("body")), link)))


def llms_candidates(texts: DataFrame) -> DataFrame:
    """Candidates of ``texts`` (project, website, final_url, body): links of a website's llms.txt that speak of documentation."""
    rows = texts.filter(documentation_candidate(F.col("website")).isNotNull()).select("project", "body", F.coalesce("final_url", "website").alias("_at"))
    url = lambda h: let(documentation_candidate(resolved(F.col("_at"), h)), lambda u: F.when(doc_signal(u), u))
    link = lambda h, i: _candidate(5, i, url(h), 98, "OFFICIAL_WEBSITE_LLMS_DOCS_LINK", "OFFICIAL_WEBSITE_LLMS_TXT_DOCUMENTATION")
    return _listed(rows, F.transform(markdown_links(F.col("body")), link))


def merged_candidates(candidates: DataFrame) -> DataFrame:
    """(project, url, score, kind, evidence): each URL of a project once, with its highest score.

    Of equal scores the kind is that found first, and the evidence is that of all, in order, each once. Equal finds are
    put together map-side, so what meets in a group are the few sorts of find, however often a page is linked. A null project is one.
    """
    sorts = candidates.groupBy("project", "url", "score", "kind", "evidence").agg(F.min(F.struct("surface", "place")).alias("at"))
    best = sorts.groupBy("project", "url").agg(F.max("score").alias("score"), F.array_sort(F.collect_list(F.struct("at", "score", "kind", "evidence"))).alias("all"))
    top = F.filter("all", lambda x: x["score"] == F.col("score"))
    return best.select("project", "url", "score", top.alias("top")).select(
        "project", "url", "score", F.get("top", F.lit(0))["kind"].alias("kind"), F.array_distinct(F.flatten(F.transform("top", lambda x: x["evidence"]))).alias("evidence")
    )


def redirect_ends(redirects: DataFrame, most_hops: int = MOST_HOPS) -> DataFrame:
    """(url, end, hops) of ``redirects`` (url, target): where chains end; ``end`` is null for loops and for more hops than allowed.

    URLs have one target, the least if there are more; nulls and redirects to the same URL are left out. Pointers are
    doubled: each round joins every chain with the chain that begins where it ends, so the rounds are the hops' logarithm.
    Targets that half of all chains share are no hot key to split by hand: the joined side has one row a URL, and AQE splits the other.
    """
    ends, path = staged_at(redirects.filter("url is not null and target is not null and url <> target").groupBy("url").agg(F.min("target").alias("end")).withColumn("hops", F.lit(1)), "redirects")
    spark = redirects.sparkSession
    for _ in range(max(most_hops, 1).bit_length()):
        on = ends.select(F.col("url").alias("end"), F.col("end").alias("_end"), F.col("hops").alias("_hops"))
        longer, new = staged_at(ends.join(on, "end", "left").select("url", F.coalesce("_end", "end").alias("end"), (F.col("hops") + F.coalesce("_hops", F.lit(0))).alias("hops")), "redirects")
        moved = longer.agg(F.sum("hops")).first()[0] != ends.agg(F.sum("hops")).first()[0]
        discarded(spark, path)
        ends, path = longer, new
        if not moved:
            break
    return ends.select("url", F.when(F.col("hops") <= most_hops, F.col("end")).alias("end"), "hops")


def selected_candidates(merged: DataFrame, redirects: DataFrame | None = None, least: int = LEAST) -> DataFrame:
    """(project, url, score, kind, evidence): a project's best candidate of ``least`` or more, the least URL of equals.

    With ``redirects`` it is moved to where they end, with that as further evidence; a project whose candidate leads into a
    loop is left out, as is one that ends at a page that may not be documentation's. Projects are aggregated map-side.
    """
    won = F.min_by(F.struct("url", "score", "kind", "evidence"), F.struct(-F.col("score"), F.col("url"))).alias("w")
    best = merged.filter(F.col("score") >= least).groupBy("project").agg(won).select("project", "w.*")
    if redirects is None:
        return best
    ends = redirect_ends(redirects.select(canonical_documentation_url(F.col("url")).alias("url"), canonical_documentation_url(F.col("target")).alias("target")))
    both = best.join(ends.withColumn("_moved", F.lit(True)), "url", "left")
    end = F.when(F.col("_moved"), documentation_candidate(F.col("end"))).otherwise(F.col("url"))
    moved = F.when(F.col("_moved"), F.array_distinct(F.array_append("evidence", F.lit("TARGET_REDIRECT_CANONICALIZED")))).otherwise(F.col("evidence"))
    return both.select("project", end.alias("url"), "score", "kind", moved.alias("evidence")).filter("url is not null")


def carried_trust(seeds: DataFrame, links: DataFrame, least: int = LEAST, most_rounds: int = 100) -> DataFrame:
    """(node, score, rounds): what of the scores of ``seeds`` (node, score) arrives over ``links`` (src, dst, weight).

    A link passes on ``weight`` percent, rounded down; a node has the best of its own and what arrives, and what is below
    ``least`` is not passed on. ``rounds`` tells the length of the shortest way by which its score arrived. Weights are cut to 0 to 100,
    so scores never grow along a way and the result is the only fixpoint.

    Each round joins only nodes whose score rose with the links, staged and with one row a node, so that AQE splits the links
    of a node that has a third of them; what arrives is a maximum, combined map-side, for a node that many link to.
    With weights below 100 scores die out in a few rounds. Nulls are left out; not to settle in ``most_rounds`` is an error.
    """
    spark = seeds.sparkSession
    # One link a pair of nodes and direction: the heaviest.
    weight = F.least(F.greatest(F.col("weight"), F.lit(0)), F.lit(100)).cast("long")
    ways, links_at = staged_at(links.filter("src is not null and dst is not null and weight is not null and src <> dst").groupBy("src", "dst").agg(F.max(weight).alias("weight")), "trust-links")
    known, path = staged_at(seeds.filter(F.col("node").isNotNull() & (F.col("score") >= least)).groupBy("node").agg(F.max("score").cast("long").alias("score")).withColumn("rounds", F.lit(0)), "trust")
    for turn in range(1, most_rounds + 1):
        front = known.filter(F.col("rounds") == turn - 1).select(F.col("node").alias("src"), F.col("score").alias("_s"))
        sent = F.floor(F.col("_s") * F.col("weight") / 100)
        arrived = ways.join(front, "src").select(F.col("dst").alias("node"), sent.alias("score")).filter(F.col("score") >= least).groupBy("node").agg(F.max("score").alias("_new"))
        better = F.coalesce(F.col("_new") > F.col("score"), F.col("score").isNull())
        after = known.join(arrived, "node", "full").select("node", F.when(better, F.col("_new")).otherwise(F.col("score")).alias("score"), F.when(better, turn).otherwise(F.col("rounds")).alias("rounds"))
        after, new = staged_at(after, "trust")
        discarded(spark, path)
        known, path = after, new
        if not known.filter(F.col("rounds") == turn).limit(1).count():
            discarded(spark, links_at)
            return known
    raise RuntimeError(f"trust did not settle in {most_rounds} rounds")
