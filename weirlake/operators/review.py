"""Quality review: several metrics of a text, a score, thresholds by domain fitted to labels, PASS / REVIEW / DROP with reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirlake.functions.bind import let, once

#: Metrics are whole ten-thousandths, scores 0 to 10,000, so that a count by score is an exact summary of any number of rows.
FULL = 10_000
METRICS = ("n_chars", "n_words", "letters", "digits", "symbols", "distinct_words", "repeated_pairs", "repeated_lines", "links", "broken")
#: (reason, condition) of metrics that a reviewer would name.
REASONS = (
    ("EMPTY", "n_words = 0"), ("SHORT", "n_words between 1 and 19"), ("FEW_LETTERS", "n_words > 0 and letters < 6000"), ("MANY_DIGITS", "digits > 2000"), ("MANY_SYMBOLS", "symbols > 1000"),
    ("FEW_DISTINCT_WORDS", "n_words >= 50 and distinct_words < 3000"), ("REPEATED_PAIRS", "repeated_pairs > 3000"), ("REPEATED_LINES", "repeated_lines > 3000"), ("MANY_LINKS", "links > 500"), ("BROKEN_CHARACTERS", "broken > 0"),
)


def with_metrics(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with ``METRICS``: lengths, and shares in ten-thousandths of characters (letters, digits, symbols, broken ones), of words
    (distinct ones, pairs met before, links) and of lines (met before). Null counts as empty, and an empty text has zeros."""
    s = F.coalesce(F.col(text), F.lit(""))
    share = lambda a, b: F.call_function("div", (a * F.lit(FULL)).cast("long"), F.greatest(b, F.lit(1)).cast("long"))
    left = lambda pattern: F.char_length(F.regexp_replace(s, pattern, ""))

    def of(words: Column) -> Column:
        n = F.size(words)
        pairs = F.when(n > 1, F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.concat(F.get(words, i), F.lit(" "), F.get(words, i + 1)))).otherwise(F.array().cast("array<string>"))
        return F.struct(n.cast("long").alias("n"), F.size(F.array_distinct(words)).alias("distinct"), let(pairs, lambda p: F.size(p) - F.size(F.array_distinct(p))).alias("pairs"))

    words = let(F.regexp_extract_all(s, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), of)
    lines = let(F.split(s, "\n", -1), lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")))
    got = once(rows, {"_w": words, "_l": lines, "_n": F.char_length(s)})
    n, w, l = F.col("_n"), F.col("_w"), F.col("_l")
    return got.select(
        "*", n.cast("long").alias("n_chars"), w["n"].alias("n_words"), share(left(r"[^\p{L}]"), n).alias("letters"), share(left("[^0-9]"), n).alias("digits"), share(left(r"[\p{L}\p{N}\x09-\x0D\x20]"), n).alias("symbols"),
        share(w["distinct"], w["n"]).alias("distinct_words"), share(w["pairs"], w["n"] - 1).alias("repeated_pairs"), share(l["n"] - l["distinct"], l["n"]).alias("repeated_lines"),
        share(F.regexp_count(s, F.lit("https?://")), w["n"]).alias("links"), share(n - left("�"), n).alias("broken"),
    ).drop("_w", "_l", "_n")


def score() -> Column:
    """0 to 10,000 from the metrics: letters, distinct words, symbols and repeated lines, each up to where prose has it."""
    up_to = lambda c, most, points: F.call_function("div", F.least(F.col(c), F.lit(most)) * points, F.lit(most).cast("long"))
    value = up_to("letters", 8_000, 4_000) + up_to("distinct_words", 7_000, 3_000) + (2_000 - up_to("symbols", 1_000, 2_000)) + (1_000 - up_to("repeated_lines", FULL, 1_000))
    return F.when(F.col("n_words") == 0, F.lit(0)).otherwise(value).cast("long")


def reasons() -> Column:
    return F.filter(F.array(*(F.when(F.expr(condition), F.lit(name)) for name, condition in REASONS)), lambda r: r.isNotNull())


def fitted_thresholds(labelled: DataFrame, precision: float = 0.95, least: int = 200) -> DataFrame:
    """(domain, pass_at, drop_at, labelled): from rows (domain, score, good), one row a domain with ``least`` rows or more, and one for all others.

    ``pass_at`` is the least score from which on the share of good rows reaches ``precision``, ``drop_at`` the
    greatest below which that of bad rows does, and at most ``pass_at``; null where no score does. The row for all others has
    the domain null and ``rest`` true, and is fitted to all rows. What is gathered is a count by domain and score, summed
    map-side; windows run over at most 10,001 rows a domain.
    """
    counted = labelled.filter("score is not null and good is not null").groupBy("domain", "score").agg(F.count(F.lit(1)).alias("n"), F.count_if("good").alias("g"))
    every = counted.groupBy("score").agg(F.sum("n").alias("n"), F.sum("g").alias("g")).select(F.lit(None).cast("string").alias("domain"), F.lit(True).alias("rest"), "score", "n", "g")
    both = counted.filter("domain is not null").select("domain", F.lit(False).alias("rest"), "score", "n", "g").unionByName(every)
    by = Window.partitionBy("domain", "rest")
    up, down = by.orderBy(F.desc("score")), by.orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    sums = both.select("*", F.sum("n").over(up).alias("un"), F.sum("g").over(up).alias("ug"), F.sum("n").over(down).alias("dn"), F.sum("g").over(down).alias("dg"))
    passes = F.min(F.when(F.col("ug") >= F.col("un") * precision, F.col("score")))
    drops = F.max(F.when((F.col("dn") > 0) & (F.col("dn") - F.col("dg") >= F.col("dn") * precision), F.col("score")))
    out = sums.groupBy("domain", "rest").agg(passes.alias("pass_at"), drops.alias("drop_at"), F.sum("n").alias("labelled")).filter(F.col("rest") | (F.col("labelled") >= least))
    return out.select("domain", "rest", "pass_at", F.least("drop_at", "pass_at").alias("drop_at"), "labelled")


def decided(rows: DataFrame, thresholds: DataFrame, domain: str = "domain") -> DataFrame:
    """``rows`` (with the metrics and ``score``) with ``decision`` and ``reasons``: by the thresholds of their domain, or those of the rest.

    Without a threshold to pass a row stays for REVIEW, without one to drop none is dropped but empty texts, which always are.
    Thresholds have a row a domain that has enough labels, which bounds them by the labels.
    """
    own = thresholds.filter("not rest").select(F.col("domain").alias("_d"), F.struct("pass_at", "drop_at").alias("_own"))
    rest = thresholds.filter("rest").agg(F.first(F.struct("pass_at", "drop_at")).alias("_rest"))
    met = rows.join(own, F.col(domain) == F.col("_d"), "left").crossJoin(F.broadcast(rest))
    met = met.withColumn("_at", F.coalesce("_own", "_rest"))
    decision = F.when(F.col("n_words") == 0, "DROP").when(F.col("score") >= F.col("_at.pass_at"), "PASS").when(F.col("score") < F.col("_at.drop_at"), "DROP").otherwise("REVIEW")
    return met.withColumn("decision", decision).withColumn("reasons", reasons()).drop("_d", "_own", "_rest", "_at")
