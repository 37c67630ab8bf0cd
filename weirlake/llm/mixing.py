"""Mixing sources to target weights.

A source's share of all words is its weight's share of all weights, but no source is repeated more than
``epochs`` times: targets above that are clamped, and what is over is reshared by weight among the others
until none is above (water-filling). Every document of a source is then taken a whole number of times and some
once more: those whose seeded hash comes first, up to the place where the source's words come nearest its target.
That place is found by histograms over the digits of the hash, so no source is ever sorted or gathered.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirlake.llm.common import few, fresh, saved, scratch, spread
from weirlake.operators.staging import ranked

WORD = r"[^\x20\x09-\x0D]+"
#: Hex digits of a hash in one histogram, and of a whole hash (the row's own place in its task comes last, so that equal rows differ).
DIGITS, LENGTH = 3, 48
#: Sources up to which their table is broadcast.
BROADCAST = 100_000


def _level(sources: DataFrame) -> tuple[int, int, int]:
    """(words left, weights open, rounds): the water level as a fraction; no weights open means that all are at their cap.

    ``sources`` has cap and weight, whole numbers. Each round clamps the sources that the level would put
    above their cap and raises it for the others; a level only rises, so rounds end when no more are clamped.
    """
    total, left, weights = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    rounds = 0
    while weights:
        rounds += 1
        over = _over(left, weights)
        caps, still = sources.agg(
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))
        ).first()
        if still == weights:
            break
        left, weights = total - caps, still
    return left, weights, rounds


def _over(left: int, weights: int) -> Column:
    """Whether a source's cap is at or below its part of the level, exactly."""
    if not weights:
        return F.lit(True)
    return F.col("cap").cast("decimal(19,0)") * F.lit(Decimal(weights)).cast("decimal(18,0)") <= F.lit(Decimal(left)).cast("decimal(19,0)") * F.col("weight").cast("decimal(18,0)")


def water_fill(sources: DataFrame, epochs: int = 3) -> DataFrame:
    """``sources`` (source_size, weight and more) with ``target``: shares of all words by weight, none above ``epochs`` sizes."""
    capped = sources.withColumn("cap", F.col("source_size") * epochs)
    left, weights, _ = _level(capped)
    level = F.lit(float(left)) * F.col("weight") / F.lit(float(weights or 1))
    return capped.withColumn("target", F.when(_over(left, weights), F.col("cap").cast("double")).otherwise(level)).drop("cap")


def _bounds(rows: DataFrame, sources: DataFrame, n: int) -> DataFrame:
    """(source, bound, last): what is taken once more has a hash that begins below ``bound``, or with it where ``last``.

    A round counts a source's words by the next digits of the hash below what is settled, and settles in which of them
    its rest runs out; only rows that begin so are looked at again. The last row goes in if that is nearer than to leave it.
    """
    front = sources.filter("rest > 0").select("source", "rest", F.lit("").alias("bound"), F.lit(2).cast("long").alias("n"), F.lit(0).cast("long").alias("words"))
    for width in range(0, LENGTH, DIGITS):
        if (front.agg(F.max("n")).first()[0] or 0) <= 1:
            break
        here = front.select(F.col("source").alias("of"), "rest", "bound")
        inside = rows.join(F.broadcast(here) if n <= BROADCAST else here, F.col("source").eqNullSafe(F.col("of")) & (F.substring("key", 1, width) == F.col("bound")))
        inside = inside.select("source", "key", "size", "rest", "bound")
        digits = inside.groupBy("source", F.substring("key", width + 1, DIGITS).alias("digits")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"), F.first("rest").alias("rest"), F.first("bound").alias("bound")
        )
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("digits"))
        crossing = digits.withColumn("upto", upto).filter("upto > rest and upto - words <= rest")
        front = saved(crossing.select("source", (F.col("rest") - F.col("upto") + F.col("words")).alias("rest"), F.concat("bound", "digits").alias("bound"), "n", "words"), "mixing-front", few(n, 250_000))
    return front.select("source", "bound", (F.col("words") <= 2 * F.col("rest")).alias("last"))


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: tuple[str, ...] = ()
) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken, copies, source and the columns of ``carry``.

    ``weights`` go to the sources in code-point order, again from the first when they run out, null last. ``size`` is
    the words of a text; null and empty texts have none, and a source of such texts has the target 0. ``copies`` is how
    often the mix repeats the row, ``epochs`` at most; a source's ``taken`` words are within half a document of its target.
    The choice rests on id, text and ``seed``: reruns agree, and of equal rows any may be taken, always as many.
    Null ids are rows like others. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text).cast("binary"))
    place = F.lpad(F.hex(F.monotonically_increasing_id()), LENGTH - 32, "0")
    taken = {"doc_id", "size", "source", "key", "of", "source_size", "target", "whole", "bound", "last", "taken", "copies"} & {c.lower() for c in carry}
    if taken:
        raise ValueError(f"columns of the result can't be carried: {sorted(taken)}")
    with scratch(spark, "mixing-rows", "mixing-plan"):
        rows = saved(
            spread(docs).select(
                F.col(id_col).cast("long").alias("doc_id"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                F.col(source_col).cast("string").alias("source"), F.concat(own, place).alias("key"), *carry,
            ),
            "mixing-rows",
        )
        by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("none", F.col("source").isNull())
        number = F.pmod(F.col("rank"), F.lit(len(weights))).cast("int")
        weight = F.element_at(F.array(*(F.lit(int(w)).cast("long") for w in weights)), number + 1)
        sources = saved(ranked(by_source, ["none", "source"]).select("source", "source_size", weight.alias("weight")), "mixing-sources", 1)
        plan = water_fill(sources, epochs)
        whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
        plan = plan.withColumn("whole", whole).withColumn("rest", F.floor(F.col("target") - F.col("whole") * F.col("source_size")))
        plan = saved(plan, "mixing-targets", 1)
        n = plan.count()
        b = _bounds(rows, plan, n).select(F.col("source").alias("of"), "bound", "last")
        plan = plan.join(b, F.col("source").eqNullSafe(F.col("of")), "left").drop("of", "rest", "weight")
        plan = saved(plan.withColumnRenamed("source", "of"), "mixing-plan", few(n, 250_000))
    begins = F.expr("substring(key, 1, length(bound))")
    more = F.coalesce((begins < F.col("bound")) | ((begins == F.col("bound")) & F.col("last")), F.lit(False))
    copies = F.col("whole") + more.cast("long")
    out = rows.join(F.broadcast(plan) if n <= BROADCAST else plan, F.col("source").eqNullSafe(F.col("of")))
    return out.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"), "source", *carry)


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row of ``mix_sources`` as often as it is taken, numbered from 1 in ``copy`` (or a longer free name)."""
    return mixed.filter("copies > 0").select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias(fresh(mixed, "copy")))
