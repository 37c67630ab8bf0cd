"""Exact samples of groups by hash, from summaries that merge: no group is sorted or gathered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirlake.operators.staging import discarded, staged_at

#: Hex digits of the hash counted in one round.
DIGITS = 3
#: Groups up to which their table is broadcast.
BROADCAST = 100_000


def hash_key(seed: int, *columns: Column) -> Column:
    """A row's place in the order of samples: the hash of its columns (null differs from empty), then of where it lies.

    Equal rows differ in the last part only, so any of them may be taken, always as many.
    """
    own = F.md5(F.to_json(F.struct(F.lit(seed).alias("_"), *(c.cast("string").alias(f"c{i}") for i, c in enumerate(columns)))).cast("binary"))
    return F.concat(own, F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0"))


def bounds(rows: DataFrame, quotas: DataFrame, group: str = "group_id") -> DataFrame:
    """(group, bound, open): a group's rows whose key begins below ``bound`` are those that fit its quota, in order of their keys.

    ``rows`` is (group, key, amount) and staged, ``quotas`` is (group, quota) with whole amounts. A round sums
    amounts by the key's next digits below what is settled, and settles in which of them the quota runs out; only rows that begin
    so are looked at again, until that is one row, which does not fit any more. What is shuffled is a row for each group and
    digits, summed map-side. A group that fits whole has no row here.
    """
    spark = rows.sparkSession
    n = quotas.count()
    sizes = rows.groupBy(group).agg(F.sum("amount").alias("_size"))
    front, path = staged_at(quotas.join(sizes, group).filter("_size > quota").select(group, F.greatest("quota", F.lit(0)).cast("long").alias("rest"), F.lit("").alias("bound"), F.lit(2).cast("long").alias("n")), "front")
    width = 0
    while (front.agg(F.max("n")).first()[0] or 0) > 1:
        begins = F.substring("key", 1, width)
        here = front.select(group, "rest", "bound")
        inside = rows.join(F.broadcast(here) if n <= BROADCAST else here, group).filter(begins == F.col("bound"))
        digits = inside.groupBy(group, F.substring("key", width + 1, DIGITS).alias("digits")).agg(
            F.sum("amount").alias("words"), F.count(F.lit(1)).alias("n"), F.first("rest").alias("rest"), F.first("bound").alias("bound")
        )
        upto = F.sum("words").over(Window.partitionBy(group).orderBy("digits"))
        crossing = digits.withColumn("upto", upto).filter("upto > rest and upto - words <= rest")
        new, at = staged_at(crossing.select(group, (F.col("rest") - F.col("upto") + F.col("words")).alias("rest"), F.concat("bound", "digits").alias("bound"), "n"), "front")
        discarded(spark, path)
        front, path, width = new, at, width + DIGITS
    return front.select(group, "bound")


def within(rows: DataFrame, quotas: DataFrame, group: str = "group_id") -> DataFrame:
    """The rows of each group, in the order of their keys, up to where the group's quota of amounts is full.

    With amounts of one these are exactly ``quota`` rows. Groups without a quota have no rows.
    """
    n = quotas.count()
    hint = (lambda d: F.broadcast(d)) if n <= BROADCAST else (lambda d: d)
    kept = rows.join(hint(quotas.select(group)), group, "left_semi").join(hint(bounds(rows, quotas, group)), group, "left")
    return kept.filter("bound is null or substring(key, 1, length(bound)) < bound").drop("bound")


def stratified(rows: DataFrame, stratum: Column, each: int, key: Column) -> DataFrame:
    """``rows`` with ``stratum``: exactly ``each`` of every stratum, or all where there are fewer, however rows are dealt.

    Null is a stratum of its own. Which rows are taken rests on ``key`` (``hash_key``).
    """
    spark = rows.sparkSession
    keyed, _ = staged_at(rows.select("*", stratum.cast("string").alias("stratum"), key.alias("key"), F.lit(1).cast("long").alias("amount")), "stratified")
    strata = keyed.select("stratum").distinct().select("stratum", F.sha2(F.coalesce(F.concat(F.lit("="), F.col("stratum")), F.lit("")), 256).alias("group_id"))
    own = keyed.withColumn("group_id", F.sha2(F.coalesce(F.concat(F.lit("="), F.col("stratum")), F.lit("")), 256))
    return within(own, strata.select("group_id", F.lit(each).cast("long").alias("quota"))).drop("group_id", "key", "amount")
