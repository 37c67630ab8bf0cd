"""Digests of tables as hash trees: the same for any order and layout of the rows, mergeable, and comparable part by part."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

#: A tree's leaves are the rows whose SHA-256 begins with the same so many hex digits.
DIGITS = 3


def row_digest(rows: DataFrame, columns: list[str] | None = None) -> Column:
    """SHA-256 of a row's values by column name: ``n`` for null, else ``s``, the length and the value as text (JSON if nested)."""
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    parts = []
    for name in sorted(columns or rows.columns):
        c = F.col(f"`{name}`")
        text = (F.hex(c) if kinds[name].typeName() == "binary" else c.cast("string")) if isinstance(kinds[name], AtomicType) else F.to_json(F.struct(c.alias("v")))
        parts.append(F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.char_length(text).cast("string"), F.lit(":"), text)))
    return F.sha2(F.concat(F.lit(""), *parts).cast("binary"), 256)


def _half(digest: str, begin: int) -> Column:
    return F.conv(F.substring(digest, begin, 15), 16, 10).cast("decimal(38,0)")


def multiset_digest(digest: str = "digest") -> list[Column]:
    """(rows, sum_a, sum_b) aggregates of row digests, from which ``settled`` makes the digest of all: sums do not mind the order, and count repeats."""
    return [F.count(F.lit(1)).alias("rows"), F.sum(_half(digest, 4)).alias("sum_a"), F.sum(_half(digest, 19)).alias("sum_b")]


def settled() -> Column:
    return F.sha2(F.concat_ws(":", F.col("rows").cast("string"), F.col("sum_a").cast("string"), F.col("sum_b").cast("string")).cast("binary"), 256)


def tree(rows: DataFrame, columns: list[str] | None = None, digits: int = DIGITS) -> DataFrame:
    """(level, node, rows, digest): leaves by the first digits of their rows' digests, parents by one digit less, the root at level 0.

    Leaves are sums, combined map-side, so a table's tree costs one pass and a few thousand rows; a parent hashes its at
    most 16 children. Tables with the same rows, repeats included, have the same tree. An empty table has no nodes.
    """
    hashed = rows.select(row_digest(rows, columns).alias("digest"))
    level = hashed.groupBy(F.substring("digest", 1, digits).alias("node")).agg(*multiset_digest()).select(F.lit(digits).alias("level"), "node", "rows", settled().alias("digest"))
    out = level
    for at in range(digits - 1, -1, -1):
        children = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "digest"))), lambda c: F.concat(c["node"], F.lit("="), c["digest"])), ",")
        level = level.groupBy(F.substring("node", 1, at).alias("node")).agg(F.sum("rows").alias("rows"), F.sha2(children.cast("binary"), 256).alias("digest")).select(F.lit(at).alias("level"), "node", "rows", "digest")
        out = out.unionByName(level)
    return out


def root_of(nodes: DataFrame) -> tuple[str, int]:
    """(digest, rows) at the root; an empty table's digest is that of no bytes."""
    top = nodes.filter("level = 0").first()
    return (top["digest"], top["rows"]) if top else ("e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855", 0)


def differing_leaves(left: DataFrame, right: DataFrame) -> DataFrame:
    """(node): leaves of two trees of the same depth that are not equal, found by descending from the root.

    Children are compared only below nodes that differ, level by level.
    """
    depth = left.agg(F.max("level")).first()[0] or right.agg(F.max("level")).first()[0] or 0
    open_ = None
    for at in range(depth + 1):
        l, r = (x.filter(F.col("level") == at).select("node", F.col("digest").alias(n)) for x, n in ((left, "_l"), (right, "_r")))
        if open_ is not None:
            below = lambda x: x.join(F.broadcast(open_), F.substring("node", 1, at - 1) == F.col("_up"), "left_semi")  # noqa: B023, E731
            l, r = below(l), below(r)
        # Levels are a few thousand nodes at most: what is open is settled before the next is read.
        nodes = [x["node"] for x in l.join(r, "node", "full").filter(~F.col("_l").eqNullSafe(F.col("_r"))).select("node").collect()]
        open_ = left.sparkSession.createDataFrame([(n,) for n in nodes], "_up string")
    return open_.withColumnRenamed("_up", "node")


def changed_rows(new: DataFrame, old: DataFrame, key: str, columns: list[str] | None = None, digits: int = DIGITS) -> DataFrame:
    """(key, change): rows added, removed or changed from ``old`` to ``new``; only rows of differing leaves are joined.

    ``key`` is unique in each; rows are read once for their digests, but only those of leaves that differ are shuffled.
    """
    names = columns or new.columns
    leaves = F.broadcast(differing_leaves(tree(new, names, digits), tree(old, names, digits)))
    pick = lambda x: x.select(F.col(key).alias("key"), row_digest(x, names).alias("digest")).join(leaves, F.substring("digest", 1, digits) == F.col("node"), "left_semi")
    both = pick(new).select("key", F.col("digest").alias("_new")).join(pick(old).select("key", F.col("digest").alias("_old")), "key", "full")
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").when(F.col("_new") != F.col("_old"), "changed")
    return both.select(F.col("key").alias(key), change.alias("change")).filter("change is not null")
