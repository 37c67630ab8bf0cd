"""Version strings, timestamps and sizes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weirlake.functions.urls import quoted

#: What marks a pre-release, and what a module path may have unescaped (fixed values).
GO_SAFE = "/!$&'()*+,;=:@"
_PRE = r"(?:^|[.\-_])(alpha|beta|rc|pre|preview|dev|snapshot|nightly)(?:[.\-_0-9]|$)"
#: Qualifiers that stand before a general release; the short ones only with a number after them (fixed values).
MAVEN_PRE = ("alpha", "beta", "milestone", "rc", "cr", "snapshot", "preview", "pre", "dev", "nightly", "ea")
MAVEN_SHORT = ("a", "b", "m")


def is_prerelease(version: Column) -> Column:
    v = F.regexp_replace(F.lower(F.trim(F.coalesce(version, F.lit("")))), "^v+", "")
    return (v == "") | v.startswith("dev-") | v.endswith("-dev") | v.rlike(_PRE)


def version_key(version: Column) -> Column:
    """The first six numbers, padded with zeros."""
    nums = F.slice(F.transform(F.regexp_extract_all(F.coalesce(version, F.lit("")), F.lit(r"(\d+)"), F.lit(1)), lambda x: x.cast("long")), 1, 6)
    return F.slice(F.concat(nums, F.array_repeat(F.lit(0).cast("long"), 6)), 1, 6)


def latest_stable(versions: Column) -> Column:
    """The greatest version of an array that is no pre-release; the first listed of equals."""
    keyed = F.transform(F.coalesce(versions, F.array().cast("array<string>")), lambda v, i: F.struct(version_key(v).alias("k"), (-i).alias("i"), v.alias("v")))
    return F.array_max(F.filter(keyed, lambda x: ~is_prerelease(x["v"])))["v"]


def nuget_key(version: Column) -> Column:
    """One to four numbers and optional build metadata, padded to four; null for anything else."""
    core = F.regexp_extract(F.trim(version), r"^([0-9]+(?:\.[0-9]+){0,3})(?:\+.*)?$", 1)
    nums = F.transform(F.split(core, r"\."), lambda x: x.cast("long"))
    return F.when(core != "", F.slice(F.concat(nums, F.array_repeat(F.lit(0).cast("long"), 4)), 1, 4))


def go_key(version: Column) -> Column:
    """``vX.Y.Z`` with or without ``+incompatible`` as numbers; null for anything else."""
    m = [F.regexp_extract(F.trim(version), r"^v(\d+)\.(\d+)\.(\d+)(?:\+incompatible)?$", i) for i in (1, 2, 3)]
    return F.when(m[0] != "", F.array(*(x.cast("long") for x in m)))


def is_maven_stable(version: Column) -> Column:
    """No pre-release token; letters and digits that meet are tokens of their own."""
    tokens = F.regexp_extract_all(F.lower(F.trim(F.coalesce(version, F.lit("")))), F.lit(r"([a-z]+|\d+)"), F.lit(1))
    short = F.exists(
        F.arrays_zip(tokens.alias("t"), F.slice(tokens, 2, 1000).alias("u")),
        lambda x: x["t"].isin(*MAVEN_SHORT) & x["u"].rlike("^[0-9]+$"),
    )
    return (F.size(tokens) > 0) & ~F.arrays_overlap(tokens, F.array(*map(F.lit, MAVEN_PRE))) & ~F.coalesce(short, F.lit(False))


def go_proxy_escape(path: Column) -> Column:
    """ASCII upper-case letters as ``!`` and the lower-case letter; other characters than a path's own percent-encoded."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    marked = F.translate(F.regexp_replace(path, "([A-Z])", r"!$1"), upper, upper.lower())
    return quoted(marked, GO_SAFE)


def ref_strategy(ref: Column) -> Column:
    r = F.trim(F.coalesce(ref, F.lit("")))
    return (
        F.when(r.rlike(r"^\d+\.x$"), "major_branch").when(r.rlike(r"^\d+\.\d+$"), "minor_branch")
        .when(F.lower(r).isin("main", "master", "stable", "current", "latest"), "fixed_ref")
        .when(r.rlike(r"^[^0-9]*\d"), "release_tag").otherwise("fixed_ref")
    )


def size_bytes(value: Column) -> Column:
    """``12.5 MB`` as bytes (1024-based); null if malformed."""
    v = F.replace(F.upper(F.trim(F.coalesce(value, F.lit("")))), F.lit(" "), F.lit(""))
    number, unit = F.regexp_extract(v, r"^([0-9]+(?:\.[0-9]+)?)(KB|MB|GB|B)?$", 1), F.regexp_extract(v, r"^([0-9]+(?:\.[0-9]+)?)(KB|MB|GB|B)?$", 2)
    factor = F.when(unit == "KB", 1024).when(unit == "MB", 1024**2).when(unit == "GB", 1024**3).otherwise(1)
    return F.when(number != "", F.floor(F.when(number != "", number).cast("double") * factor))


def uinfo(value: Column) -> Column:
    """``group|artifact|version|classifier|extension`` as a struct; null if a mandatory part is missing."""
    p = F.split(F.coalesce(value, F.lit("")), r"\|")
    get = lambda i, name: F.get(p, F.lit(i)).alias(name)
    ok = (F.size(p) >= 5) & (F.get(p, F.lit(0)) != "") & (F.get(p, F.lit(1)) != "") & (F.get(p, F.lit(2)) != "")
    return F.when(ok, F.struct(get(0, "group_id"), get(1, "artifact_id"), get(2, "version"), get(3, "classifier"), get(4, "extension")))


def nanosecond_key(value: Column) -> Column:
    """RFC 3339 UTC times as fixed-width text that sorts by time; empty if malformed."""
    pattern = r"^(\d{4}-\d{2}-\d{2})[Tt](\d{2}:\d{2}:\d{2})(?:\.(\d{1,9}))?[Zz]$"
    v = F.trim(F.coalesce(value, F.lit("")))
    date, time, fraction = (F.regexp_extract(v, pattern, i) for i in (1, 2, 3))
    return F.when(date != "", F.concat(date, F.lit("T"), time, F.lit("."), F.rpad(fraction, 9, "0"), F.lit("Z"))).otherwise("")


def parse_time(value: Column) -> Column:
    """ISO 8601 text as a timestamp; null if empty or malformed."""
    return F.try_to_timestamp(F.when(F.coalesce(value, F.lit("")) != "", value))


def utc_text(at: Column | None = None) -> Column:
    """A time, the present one if none is given, as UTC text to the second that ends in ``Z``."""
    now = F.current_timestamp() if at is None else at
    return F.date_format(F.convert_timezone(F.current_timezone(), F.lit("UTC"), now.cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def crate_name(path: Column) -> Column:
    """The crate that an index path stands for; null for other files."""
    v = F.regexp_replace(F.trim(F.coalesce(path, F.lit(""))), "^/+|/+$", "")
    name = F.regexp_extract(v, r"^(?:[12]|3/[^/]|[^/]{2}/[^/]{2})/([A-Za-z][A-Za-z0-9_-]{0,63})$", 1)
    return F.when((name != "") & ~v.startswith("."), name)
