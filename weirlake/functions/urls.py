"""URL functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirlake.functions.bind import let

#: Tracking parameters (fixed values).
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "utm_id", "gclid", "fbclid")
TRACKING_KEYS = ("ref", "source", "campaign", "mc_cid", "mc_eid")
TRACKING_PREFIXES = ("utm_", "ref_")
#: Hosts that only show a registry's own page of a package (fixed values).
LANDING_HOSTS = ("central.sonatype.com", "search.maven.org", "repo1.maven.org", "repo.maven.apache.org", "appdoc.app", "www.appdoc.app")
#: Hosts of registries' pages and of social media, which are no documentation (fixed values).
LOW_VALUE_HOSTS = (
    "central.sonatype.com", "search.maven.org", "repo1.maven.org", "repo.maven.apache.org", "www.npmjs.com", "npmjs.com", "pypi.org", "www.nuget.org", "nuget.org", "crates.io",
)
SOCIAL_HOSTS = ("twitter.com", "x.com", "facebook.com", "linkedin.com", "discord.com", "discord.gg", "youtube.com", "www.youtube.com")
#: Words, extensions and paths of documentation, extensions that link lists leave out, names of registries and their package URL types (fixed values).
DOC_MARKERS = ("docs", "documentation", "guide", "guides", "manual", "reference")
DOC_EXTENSIONS = ("md", "mdx", "markdown", "rst", "adoc", "asciidoc", "txt")
DOC_TERMS = ("docs", "documentation", "developer", "developers", "guide", "guides", "manual", "reference", "api", "learn", "tutorial", "handbook")
#: Extensions that a crawl leaves out (fixed values).
SKIPPED = (
    "7z", "avi", "bin", "bmp", "css", "dmg", "doc", "docx", "epub", "exe", "gif", "gz", "ico", "jpeg", "jpg", "js",
    "map", "mp3", "mp4", "png", "rar", "svg", "tar", "tgz", "webm", "webp", "woff", "woff2", "zip",
)
LINK_SKIPPED = (
    "7z", "avi", "bin", "bmp", "css", "doc", "docx", "dta", "exe", "gif", "gz", "ico", "jpeg", "jpg", "js", "mp3", "mp4", "odt", "pbf", "png", "por", "ppt",
    "pptx", "rar", "rdata", "rds", "sas7bdat", "sav", "svg", "tar", "webp", "woff", "woff2", "xpt", "zip",
)
EXCLUDED = (
    r"/(?:blog|news|community|showcase|partners?|pricing|jobs?|events?)(?:/|$)", r"/(?:login|signin|signup|account|search)(?:/|$)", r"[?&](?:q|query|search)=",
)
REGISTRY_ALIASES = {
    "npm": "npmjs.org", "npmjs": "npmjs.org", "pypi": "pypi.org", "packagist": "packagist.org", "cargo": "crates.io", "crates": "crates.io",
    "rubygems": "rubygems.org", "nuget": "nuget.org", "maven": "repo1.maven.org", "go": "proxy.golang.org", "golang": "proxy.golang.org",
    "pub": "pub.dev", "hex": "hex.pm", "hackage": "hackage.haskell.org", "cran": "cran.r-project.org",
}
PURL_TYPES = {
    "npmjs.org": "npm", "pypi.org": "pypi", "packagist.org": "composer", "crates.io": "cargo", "rubygems.org": "gem", "nuget.org": "nuget",
    "repo1.maven.org": "maven", "proxy.golang.org": "golang", "pub.dev": "pub", "hex.pm": "hex",
    "hackage.haskell.org": "hackage", "cran.r-project.org": "cran",
}
#: scheme, authority, path, query of a URL; a missing part is empty.
_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def part(url: Column, which: str) -> Column:
    """``scheme`` (lower-cased), ``netloc``, ``path``, ``query``, or ``host`` (lower-cased, without user or port)."""
    if which == "host":
        own = F.regexp_replace(part(url, "netloc"), r"^.*@", "")
        return F.lower(F.regexp_replace(own, r":[0-9]*$", ""))
    at = {"scheme": 1, "netloc": 2, "path": 3, "query": 4}[which]
    got = F.coalesce(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, at), F.lit(""))
    return F.lower(got) if which == "scheme" else got


def is_http(url: Column) -> Column:
    u = F.trim(F.coalesce(url, F.lit("")))
    return part(u, "scheme").isin("http", "https") & (part(u, "host") != "")


def _kept_query(query: Column, dropped) -> Column:
    pairs = F.filter(F.split(query, "&"), lambda x: (x != "") & ~dropped(F.lower(F.regexp_extract(x, r"^([^=]*)", 1))))
    return F.array_join(F.transform(pairs, lambda x: F.when(x.contains("="), x).otherwise(F.concat(x, F.lit("=")))), "&")


def canonical_documentation_url(url: Column) -> Column:
    """Lower-cased scheme and host, no default port, single slashes, no fragment or tracking; null if not http(s)."""
    u = F.trim(url)
    scheme, host = part(u, "scheme"), part(u, "host")
    port = F.regexp_extract(part(u, "netloc"), r":([0-9]+)$", 1)
    usual = (port == "") | ((scheme == "https") & (port == "443")) | ((scheme == "http") & (port == "80"))
    path = F.regexp_replace(part(u, "path"), "/{2,}", "/")
    path = F.when(path.isin("", "/"), "/").otherwise(F.regexp_replace(path, "/+$", ""))
    drop = lambda k: k.isin(*TRACKING_KEYS) | k.rlike("^(" + "|".join(TRACKING_PREFIXES) + ")")
    query = _kept_query(part(u, "query"), drop)
    out = F.concat(scheme, F.lit("://"), host, F.when(usual, "").otherwise(F.concat(F.lit(":"), port)), path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    return F.when(is_http(u), out)


def crawl_url(url: Column) -> Column:
    """No fragment, and no encoded white space at the path's end."""
    u = F.trim(F.coalesce(url, F.lit("")))
    path = F.regexp_replace(F.rtrim(part(u, "path")), r"(?i)(%20|%09|%0a|%0d)+$", "")
    head = F.regexp_extract(u, r"^((?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?)", 1)
    return F.concat(head, path, F.when(part(u, "query") == "", "").otherwise(F.concat(F.lit("?"), part(u, "query"))))


def docs_url(url: Column) -> Column:
    """No fragment and no tracking parameters; relative references only lose the fragment."""
    u = F.regexp_replace(F.trim(url), "#.*$", "")
    query = _kept_query(part(u, "query"), lambda k: k.isin(*TRACKING))
    whole = F.concat(F.regexp_extract(u, r"^([^?]*)", 1), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    return F.when((part(u, "scheme") == "") | (part(u, "netloc") == ""), u).otherwise(whole)


def normalize_repository_url(url: Column) -> Column:
    """``git+``, ``.git``, SSH forms and doubled slashes removed; https; known hosts without ``www.``."""
    u = F.regexp_replace(F.trim(url), r"^git\+", "")
    u = F.regexp_replace(u, r"^git@(github|gitlab)\.com:", "https://$1.com/")
    u = F.regexp_replace(u, r"\.git$", "")
    host = F.regexp_replace(part(u, "host"), r"^www\.(github|gitlab)\.com$", "$1.com")
    path = F.regexp_replace(F.regexp_replace(part(u, "path"), "/+", "/"), "/+$", "")
    bare = F.regexp_replace(u, "/+$", "")
    out = F.when((part(u, "scheme") == "") | (part(u, "netloc") == ""), F.when(bare != "", bare)).otherwise(F.concat(F.lit("https://"), host, path))
    return F.when(F.coalesce(url, F.lit("")) != "", out)


def is_upload_directory(url: Column) -> Column:
    """A path below an uploads folder that ends in a slash or names no file."""
    path = part(url, "path")
    last = F.regexp_extract(path, "([^/]*)$", 1)
    return path.rlike(r"(?i)/(?:uploads?|wp-content/uploads)(?:/|$)") & (path.endswith("/") | ~last.rlike(r"^.+\.[^.]+$"))


def in_scope(url: Column, host: str, prefixes: tuple[str, ...] = (), excludes: tuple[str, ...] = EXCLUDED) -> Column:
    """Same host, no skipped extension, an allowed path prefix and no excluded pattern."""
    path, query = part(url, "path"), part(url, "query")
    suffix = F.lower(F.regexp_extract(F.regexp_replace(path, "/+$", ""), r"[^/]\.([^./]+)$", 1))
    ok = (part(url, "host") == host.lower()) & ~suffix.isin(*SKIPPED)
    if prefixes:
        ok = ok & F.greatest(F.lit(False), *(path.startswith(p) for p in prefixes))
    target = F.concat(path, F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    for x in excludes:
        ok = ok & ~target.rlike(x)
    return ok


def within_subtree(url: Column, host: str, prefix: str) -> Column:
    own = prefix.rstrip("/")
    path = part(url, "path")
    return (part(url, "host") == host.lower()) & ((F.regexp_replace(path, "/+$", "") == own) | path.startswith(own + "/"))


def doc_like_path(path: Column) -> Column:
    clean = F.regexp_replace(F.coalesce(path, F.lit("")), "^/+|/+$", "")
    parts = F.split(F.lower(clean), "/")
    suffix = F.regexp_extract(F.element_at(parts, -1), r"\.([^.]*)$", 1)
    return (clean != "") & (F.arrays_overlap(parts, F.array(*map(F.lit, DOC_MARKERS))) | suffix.isin(*DOC_EXTENSIONS))


def doc_signal(value: Column) -> Column:
    tokens = F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(value, F.lit(""))), "[^a-z0-9]+", " ")), " ")
    return F.arrays_overlap(tokens, F.array(*map(F.lit, DOC_TERMS)))


def is_landing(url: Column) -> Column:
    return part(F.trim(url), "host").isin(*LANDING_HOSTS)


def hosts_related(left: Column, right: Column) -> Column:
    """Equal hosts, or one a subdomain of the other."""
    a, b = part(left, "host"), part(right, "host")
    return (a != "") & (b != "") & ((a == b) | a.endswith(F.concat(F.lit("."), b)) | b.endswith(F.concat(F.lit("."), a)))


def git_link_score(url: Column, label: Column) -> Column:
    """How likely a GitHub link is a page's documentation source; null for other links."""
    parts = F.filter(F.split(part(url, "path"), "/"), lambda x: x != "")
    action = F.coalesce(F.get(parts, F.lit(2)), F.lit(""))
    ref = action.isin("tree", "blob", "edit") & (F.size(parts) > 3)
    path = F.when(ref, F.array_join(F.slice(parts, 5, 1000), "/")).otherwise("")
    low = F.lower(F.coalesce(label, F.lit("")))
    by_action = F.when(action == "edit", 85).when(action == "blob", 75).when(action == "tree", 65).otherwise(0)
    by_label = F.when(low.rlike("edit this page|edit page|documentation source|docs source"), 35).when(low.rlike("source|github|repository|repo"), 15).otherwise(0)
    by_path = F.when(doc_like_path(path), 25).when(action.isin("blob", "edit", "tree"), -45).otherwise(0)
    ok = part(url, "host").isin("github.com", "www.github.com") & (F.size(parts) >= 2)
    return F.when(ok, 15 + by_action + by_label + by_path)


def same_host_links(base: Column, hrefs: Column) -> Column:
    """Ordered distinct absolute links of ``hrefs`` on the base's host; paths relative to the base's folder."""
    scheme_host = F.concat(part(base, "scheme"), F.lit("://"), part(base, "netloc"))
    folder = F.regexp_extract(part(base, "path"), r"^(.*/)", 1)

    def absolute(h):
        return (
            F.when(h.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), h).when(h.startswith("//"), F.concat(part(base, "scheme"), F.lit(":"), h))
            .when(h.startswith("/"), F.concat(scheme_host, h)).otherwise(F.concat(scheme_host, F.when(folder == "", "/").otherwise(folder), h))
        )

    skipped = "(?i)\\.(" + "|".join(LINK_SKIPPED) + ")$"
    links = F.transform(F.filter(F.transform(hrefs, lambda h: F.trim(h)), lambda h: h != ""), lambda h: crawl_url(absolute(h)))
    ok = lambda u: part(u, "scheme").isin("http", "https") & (part(u, "host") == part(base, "host")) & ~is_upload_directory(u) & ~part(u, "path").rlike(skipped)
    return F.array_distinct(F.filter(links, ok))


def resolved(base: Column, href: Column) -> Column:
    """``href`` as an absolute URL, seen from ``base``: relative paths, ``.`` and ``..``, a query or a fragment alone."""
    def joined(path):
        # A dot at the end names a folder, so a slash follows.
        step = lambda acc, x: F.when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == ".", acc).otherwise(F.array_append(acc, x))
        kept = F.aggregate(F.split(F.regexp_replace(path, "^/", ""), "/"), F.array().cast("array<string>"), step)
        return let(kept, lambda k: F.concat(F.lit("/"), F.array_join(k, "/"), F.when(path.rlike(r"(?:^|/)\.{1,2}$") & (F.size(k) > 0), "/").otherwise("")))

    def relative(b, h):
        own, tail, path = F.regexp_extract(h, r"(?s)^([^?#]*)", 1), F.regexp_extract(h, r"(?s)^[^?#]*(.*)$", 1), b["path"]
        same = F.concat(path, F.when(tail.startswith("?") | (b["query"] == ""), "").otherwise(F.concat(F.lit("?"), b["query"])))
        folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
        onto = let(F.when(own.startswith("/"), own).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), own)), joined)
        return F.concat(b["scheme"], F.lit("://"), b["netloc"], F.when(own == "", same).otherwise(onto), tail)

    parts = F.struct(*(part(base, x).alias(x) for x in ("scheme", "netloc", "path", "query")))
    absolute = lambda h: F.when(h.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), h).when(h.startswith("//"), F.concat(part(base, "scheme"), F.lit(":"), h))
    return let(F.trim(href), lambda h: F.coalesce(absolute(h), let(parts, lambda b: relative(b, h))))


def documentation_candidate(url: Column) -> Column:
    """The canonical form of a URL that may be documentation; null for registries' pages, social media and what is not http(s)."""
    return let(let(url, canonical_documentation_url), lambda u: F.when(~part(u, "host").isin(*LOW_VALUE_HOSTS, *SOCIAL_HOSTS), u))


def normalize_registry(value: Column) -> Column:
    """The registry's canonical host for any of its usual names."""
    key = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    known = F.create_map(*(x for k, v in REGISTRY_ALIASES.items() for x in (F.lit(k), F.lit(v))))
    return F.coalesce(F.try_element_at(known, key), key)


def quoted(value: Column, safe: str) -> Column:
    """Percent-encoding that leaves letters, digits, ``_.-~`` and ``safe`` alone."""
    out = F.replace(F.url_encode(value), F.lit("+"), F.lit("%20"))
    for c in "~" + safe:
        if c not in "_.-*":
            out = F.replace(out, F.lit(f"%{ord(c):02X}"), F.lit(c))
    return out if "*" in safe else F.replace(out, F.lit("*"), F.lit("%2A"))


def build_purl(registry: Column, name: Column, version: Column | None = None) -> Column:
    """Package URL; scoped npm and ``group:artifact`` names become two path segments. Null for unknown registries."""
    types = F.create_map(*(x for k, v in PURL_TYPES.items() for x in (F.lit(k), F.lit(v))))
    kind = F.try_element_at(types, normalize_registry(registry))
    raw = F.trim(name)
    maven = F.when(raw.contains(":"), F.concat(quoted(F.substring_index(raw, ":", 1), ""), F.lit("/"), quoted(F.regexp_extract(raw, "^[^:]*:(.*)$", 1), "")))
    out = F.concat(F.lit("pkg:"), kind, F.lit("/"), F.when(kind == "maven", F.coalesce(maven, quoted(raw, "/"))).otherwise(quoted(raw, "/")))
    return out if version is None else F.concat(out, F.when(F.coalesce(version, F.lit("")) != "", F.concat(F.lit("@"), quoted(F.trim(version), "+"))).otherwise(""))
