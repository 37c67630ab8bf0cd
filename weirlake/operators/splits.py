"""Splits of a corpus that keep what belongs together in one part: links, connected components, hash buckets, a leak check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirlake.operators.staging import discarded, staged_at

#: Buckets of the hash, and how many of them each part has.
BUCKETS = 10_000
SHARES = {"train": 9_800, "validation": 100, "test": 100}


def links_of_keys(rows: DataFrame, row_id: str, *keys: str) -> DataFrame:
    """(a, b): every row linked to the least id that shares one of its keys; a null key or id links nothing.

    A star a key, not all pairs of it: a key that a third of the rows share makes a row each. The least ids are aggregated
    map-side and staged, so that AQE knows their size and splits a hot key's rows in the join.
    """
    out = None
    for key in keys:
        own = rows.select(F.col(row_id).alias("a"), F.col(key).alias("_key")).filter("a is not null and _key is not null")
        least, _ = staged_at(own.groupBy("_key").agg(F.min("a").alias("b"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_key", "b"), "least-of-keys")
        found = own.join(least, "_key").filter("a <> b").select("a", "b")
        out = found if out is None else out.unionByName(found)
    return out.distinct()


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """(node, component): for every node of a link the least node that links lead to. Nulls and links to oneself are left out.

    Stars are grown from both sides by turns (Kiveris and others): each node's greater neighbours are hung on its
    least neighbour, then each node's lesser ones. Both are joins with one row a node, so a node with a third of all links
    is split by AQE; rounds are logarithmic in the length of a chain, and each is staged.
    """
    both = links.toDF("a", "b").filter("a is not null and b is not null and a <> b")
    edges, path = staged_at(both.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "links")
    spark = edges.sparkSession
    for _ in range(most_rounds):
        least, at = staged_at(edges.groupBy("hi").agg(F.min("lo").alias("least"), F.count(F.lit(1)).alias("n")), "least")
        below = least.select(F.col("hi").alias("lo"), F.col("least").alias("below"))
        if not edges.join(below, "lo", "left_semi").limit(1).count() and not least.filter("n > 1").limit(1).count():
            break
        large = edges.join(below, "lo", "left").select("hi", F.coalesce("below", "lo").alias("lo")).distinct()
        large, at2 = staged_at(large, "links")
        least2, at3 = staged_at(large.groupBy("hi").agg(F.min("lo").alias("least")), "least")
        small = large.join(least2, "hi").filter("lo <> least").select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
        edges, new = staged_at(small.unionByName(least2.select("hi", F.col("least").alias("lo"))).distinct(), "links")
        discarded(spark, path, at, at2, at3)
        path = new
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())


def bucket(row_id: Column, buckets: int = BUCKETS) -> Column:
    """The first 32 bits of an id's SHA-256, modulo ``buckets``."""
    return F.pmod(F.conv(F.substring(F.sha2(row_id.cast("string").cast("binary"), 256), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def part_of(at: Column, shares: dict[str, int]) -> Column:
    """The part whose range of buckets ``at`` lies in, in the order of ``shares``; beyond all ranges null."""
    out, upto = F.lit(None).cast("string"), 0
    bounds = []
    for name, width in shares.items():
        upto += width
        bounds.append((upto, name))
    for end, name in reversed(bounds):
        out = F.when(at < end, name).otherwise(out)
    return out


def assign_splits(rows: DataFrame, links: DataFrame, row_id: str = "doc_id", shares: dict[str, int] | None = None) -> DataFrame:
    """(id, cluster_id, bucket, split) of every row: rows that links connect share the bucket of their least id.

    The bucket rests on an id's hash alone: the same id falls into the same part in every run, whatever else is there,
    as long as its cluster's least member stays. Null ids are a cluster of their own. ``links`` is (a, b) of ids.
    """
    shares = shares or SHARES
    if sum(shares.values()) != BUCKETS:
        raise ValueError(f"shares must add up to {BUCKETS}")
    found = components(links).select(F.col("node").alias("_node"), "component")
    ids = rows.select(F.col(row_id).alias(row_id))
    out = ids.join(found, F.col(row_id) == F.col("_node"), "left").select(row_id, F.coalesce("component", row_id).alias("cluster_id"))
    at = F.coalesce(bucket(F.col("cluster_id")), bucket(F.lit("")))
    return out.withColumn("bucket", at).withColumn("split", part_of(F.col("bucket"), shares))


def split_leaks(assigned: DataFrame, links: DataFrame, row_id: str = "doc_id") -> DataFrame:
    """(a, b, a_split, b_split): links whose ends are in different parts; none if the splits hold."""
    of = assigned.select(F.col(row_id).alias("_id"), "split").filter("_id is not null").distinct()
    both = links.toDF("a", "b").join(of.select(F.col("_id").alias("a"), F.col("split").alias("a_split")), "a").join(of.select(F.col("_id").alias("b"), F.col("split").alias("b_split")), "b")
    return both.filter("a_split <> b_split").select("a", "b", "a_split", "b_split")


def split_shares(assigned: DataFrame) -> DataFrame:
    """(split, rows, clusters, share): counted over clusters first, so that one large cluster is no hot key."""
    clusters = assigned.groupBy("split", "cluster_id").agg(F.count(F.lit(1)).alias("n"))
    parts = clusters.groupBy("split").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("clusters"))
    return parts.crossJoin(F.broadcast(assigned.agg(F.count(F.lit(1)).alias("_all")))).select("split", "rows", "clusters", F.round(F.col("rows") / F.col("_all"), 6).alias("share"))
