"""Differences of two file trees by their directories' digests: what is equal is left out a directory at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirlake.operators.merkle import multiset_digest, settled
from weirlake.operators.staging import shared_dir, staged

#: Entries of a level lie in so many folders by the hash of their directory, so that a walk opens only some.
BUCKETS = 64
ENTRY = "path string, parent string, kind string, digest string, depth int, bucket int"


def _parent(path: Column) -> Column:
    """The directory of a path; of a top-level one the root, whose name is empty."""
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def _bucket(parent: Column) -> Column:
    return F.pmod(F.xxhash64(parent), F.lit(BUCKETS)).cast("int")


def write_tree(files: DataFrame, name: str = "tree") -> DataFrame:
    """The entries (path, parent, kind, digest, depth, bucket) of all directories of ``files`` (path, sha), written by depth and bucket.

    A directory's digest is that of the multiset of its entries' names, kinds and digests: a sum, combined map-side, so one
    directory may hold a third of all files. Levels are made from the deepest up, a stage each. Paths are unique and have no
    slash at either end; rows without a path are left out; a null sha is a digest of its own.
    """
    leaves = files.filter("path <> ''").select("path", _parent(F.col("path")).alias("parent"), F.lit("file").alias("kind"), F.coalesce("sha", F.lit("null")).alias("digest"))
    leaves = staged(leaves.withColumn("depth", F.char_length("path") - F.char_length(F.replace("path", F.lit("/"), F.lit("")))), "tree-files")
    deepest = leaves.agg(F.max("depth")).first()[0] or 0
    path = shared_dir(files.sparkSession, name)
    below = None
    for depth in range(deepest, -1, -1):
        level = leaves.filter(F.col("depth") == depth)
        level = level if below is None else level.unionByName(below)
        level.withColumn("bucket", _bucket(F.col("parent"))).repartition("bucket").write.mode("append").partitionBy("depth", "bucket").parquet(path)
        level = files.sparkSession.read.schema(ENTRY).parquet(path).filter(F.col("depth") == depth)
        mark = F.sha2(F.concat_ws("\n", "path", "kind", "digest").cast("binary"), 256)
        sums = level.select(F.col("parent").alias("path"), mark.alias("digest")).groupBy("path").agg(*multiset_digest())
        below = sums.select("path", _parent(F.col("path")).alias("parent"), F.lit("dir").alias("kind"), settled().alias("digest"), F.lit(depth - 1).alias("depth"))
    return files.sparkSession.read.schema(ENTRY).parquet(path)


def _opened(spark: SparkSession, tree: DataFrame, depth: int, dirs: DataFrame, buckets: list[int], name: str) -> DataFrame:
    """The entries of ``dirs`` at a depth; only their buckets' folders are read."""
    rows = tree.filter((F.col("depth") == depth) & F.col("bucket").isin(buckets))
    return rows.join(dirs, rows["parent"] == dirs["dir"], "left_semi").select("path", "kind", F.col("digest").alias(name))


def walk(old: DataFrame, new: DataFrame, prefixes: tuple[str, ...] = (), complete: bool = True) -> tuple[DataFrame, list[int]]:
    """((path, change), entries compared a level) between two trees of ``write_tree``: ADDED, CHANGED or REMOVED files.

    Goes down from the root, or from the directories ``prefixes``, and opens a directory only where its digests differ:
    what is read grows with the changes and the directories they lie in. Equal scopes end the walk at once. Unless the new
    tree is ``complete``, nothing counts as removed. A file that became a directory is removed, what lies in it added.
    """
    spark = new.sparkSession
    scope = sorted({p.strip("/") for p in prefixes} - {""}) if all(p.strip("/") for p in prefixes) else []
    starts: dict[int, list[str]] = {}
    for p in scope or [""]:
        starts.setdefault(p.count("/") + 1 if p else 0, []).append(p)
    found, read = spark.createDataFrame([], "path string, change string"), []
    opened, depth = spark.createDataFrame([], "dir string"), 0
    last = max(starts)
    while True:
        begin = starts.get(depth, [])
        if depth and begin:
            # A scope's own entries lie a level up; equal ones stay closed.
            pick = lambda t: t.filter((F.col("depth") == depth - 1) & (F.col("kind") == "dir") & F.col("path").isin(begin)).select("path", "digest")  # noqa: B023, E731
            both = pick(old).withColumnRenamed("digest", "_o").join(pick(new).withColumnRenamed("digest", "_n"), "path", "full")
            begin = [r[0] for r in both.filter(~F.col("_o").eqNullSafe(F.col("_n"))).select("path").collect()]
        dirs = staged(opened.unionByName(spark.createDataFrame([(p,) for p in begin], "dir string")).distinct(), "tree-open")
        buckets = [r[0] for r in dirs.select(_bucket(F.col("dir"))).distinct().collect()]
        if buckets:
            both = staged(_opened(spark, old, depth, dirs, buckets, "_o").join(_opened(spark, new, depth, dirs, buckets, "_n"), ["path", "kind"], "full"), "tree-level")
            read.append(both.count())
            differ = both.filter(~F.col("_o").eqNullSafe(F.col("_n")))
            change = F.when(F.col("_o").isNull(), "ADDED").when(F.col("_n").isNull(), "REMOVED").otherwise("CHANGED")
            found = found.unionByName(differ.filter("kind = 'file'").select("path", change.alias("change")))
            opened = differ.filter("kind = 'dir'").select(F.col("path").alias("dir"))
        else:
            opened = spark.createDataFrame([], "dir string")
            if depth >= last:
                break
        depth += 1
    return (found if complete else found.filter("change <> 'REMOVED'")), read
