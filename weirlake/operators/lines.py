"""Lines that repeat across documents (navigation, headers, footers) and words broken at line ends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirlake.functions.bind import let
from weirlake.operators.staging import discarded, fresh, may_be_among, staged_at

#: Repeated lines up to which their table is broadcast.
BROADCAST = 200_000
SPACE = "[\\x09\\x0B\\x0C\\x20\\u00A0]+"


def joined_hyphens(text: Column) -> Column:
    """Words broken by a hyphen at a line's end, written together: a letter, the hyphen, the break, a lower-case letter.

    The word's rest is drawn up to the first line; a hyphen before anything else, or after a digit, stays. Soft hyphens at an end go too.
    """
    return F.regexp_replace(text, "(?<=\\p{L})[-\\u00AD\\u2010]\\x20*\\r?\\n\\x20*(?=\\p{Ll})", "")


def line_key(line: Column) -> Column:
    """What is compared of a line: runs of blanks as one, trimmed, numbers as ``0`` (page numbers and dates do not tell lines apart)."""
    return F.regexp_replace(F.trim(F.regexp_replace(line, SPACE, " ")), "[0-9]+", "0")


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\\r\\n|\\n|\\r", -1)


def line_frequencies(rows: DataFrame, text: str = "text", scope: Column | None = None, shortest: int = 4) -> DataFrame:
    """(scope, line_hash, documents): in how many rows of a scope each line is, by the MD5 of its ``line_key``.

    A row counts a line once. Counts are summed map-side before they move, so a line of a third of all rows is a row a
    task. Lines of fewer than ``shortest`` characters do not count. Null scopes are a scope of their own.
    """
    keys = F.array_distinct(F.filter(F.transform(split_lines(F.col(text)), line_key), lambda k: F.char_length(k) >= shortest))
    hashes = F.transform(keys, lambda k: F.md5(k.cast("binary")))
    lines = rows.select((F.lit(None).cast("string") if scope is None else scope.cast("string")).alias("scope"), F.explode(hashes).alias("line_hash"))
    return lines.groupBy("scope", "line_hash").agg(F.count(F.lit(1)).alias("documents"))


def without_repeated_lines(rows: DataFrame, row_id: str, text: str = "text", scope: Column | None = None, least: int = 5, shortest: int = 4, removed: str = "removed_lines") -> DataFrame:
    """``rows`` with ``text`` less the lines that at least ``least`` rows of the scope have, and how many went in ``removed``.

    Such lines are found from counts alone; what is then looked up is where they lie in which row. Only rows that lose
    a line meet their list of places: others stay where they lie, texts and all. What remains keeps its order and its
    line ends as LF; a row that loses nothing keeps its text as it is, null too. Rows are told by id and text, so null
    and repeated ids are cleaned like all others. ``removed`` must not be a column of ``rows`` yet.
    """
    if removed.lower() in {c.lower() for c in rows.columns}:
        raise ValueError(f"there is a column {removed} already")
    spark = rows.sparkSession
    own_scope = F.lit(None).cast("string") if scope is None else scope.cast("string")
    hot, at = staged_at(line_frequencies(rows, text, scope, shortest).filter(F.col("documents") >= least).select(F.col("scope").alias("_scope"), "line_hash"), "repeated-lines")
    n = hot.count()
    told = F.concat_ws(":", F.col(row_id).cast("string"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))
    places = rows.select(told.alias("_told"), own_scope.alias("scope"), F.posexplode(split_lines(F.col(text))).alias("at", "line")).select("_told", "scope", "at", line_key(F.col("line")).alias("k"))
    places = places.filter(F.char_length("k") >= shortest).select("_told", "scope", "at", F.md5(F.col("k").cast("binary")).alias("line_hash"))
    found = places.join(F.broadcast(hot) if n <= BROADCAST else hot, (places.line_hash == hot.line_hash) & F.col("scope").eqNullSafe(F.col("_scope")), "left_semi")
    lists, _ = staged_at(found.groupBy("_told").agg(F.collect_set("at").alias("_places")), "line-places")
    discarded(spark, at)

    mark, own, key, at_ = (fresh(rows, n) for n in ("_mark", "_own", "_told", "_places"))
    lists = lists.toDF(key, at_)
    asked = may_be_among(rows.withColumn(own, told), F.col(own), lists.select(key), mark)
    same = asked.filter(~F.col(mark)).select(*rows.columns, F.lit(0).alias(removed))
    met = asked.filter(F.col(mark)).join(lists, F.col(own) == F.col(key), "left")

    def kept(lines: Column) -> Column:
        return F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(at_)), lambda i: F.get(lines, i)), "\n")

    cleaned = F.when(F.col(at_).isNull(), F.col(text)).otherwise(let(split_lines(F.col(text)), kept))
    changed = met.select(*(cleaned.alias(c) if c == text else F.col(c) for c in rows.columns), F.coalesce(F.size(at_), F.lit(0)).alias(removed))
    return same.unionByName(changed)
