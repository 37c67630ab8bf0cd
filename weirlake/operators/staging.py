"""Intermediate tables in the cluster's shared folder, and what rests on them: marking, dropping and ranking rows without one large task."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bits of the tables below; a table is BITS / 64 rows at most, whatever it was made from.
BITS = 1 << 24


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder.

    Only a local session without ``spark.checkpoint.dir`` gets a temporary folder instead; on a cluster
    that setting must be there.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder where the master is {master!r}")
        top = tempfile.mkdtemp(prefix="weirlake-")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage and survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``staged``, and the folder, for ``discarded`` once nothing reads it any more."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discarded(spark: SparkSession, *paths: str) -> None:
    """Deletes folders of ``staged_at``."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: Bytes, by Spark's estimate, up to which an input of few files is dealt out.
SMALL = 256 << 20


def spread(rows: DataFrame) -> DataFrame:
    """``rows``, dealt to all cores where they come from fewer files than there are cores and are small; else as they lie.

    Spark reads a file's row group in one task, so a small table in one file would keep one core busy.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if not 0 < len(rows._jdf.inputFiles()) < cores:
        return rows
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return rows.repartition(cores) if size <= SMALL else rows


def may_be_among(rows: DataFrame, key: Column, keys: DataFrame, mark: str) -> DataFrame:
    """``rows`` with a column ``mark``: false where ``key`` is surely not in the one column of ``keys``.

    A table of bits of a fixed size is broadcast, so that only rows that may match need to move to meet the keys.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(BITS))
    w, bits = fresh(rows, "_w"), fresh(rows, "_bits")
    at = keys.select(place(F.col(keys.columns[0])).alias("at")).selectExpr(f"at div 64 AS {w}", "shiftleft(1L, int(at % 64)) AS bit")
    table = at.groupBy(w).agg(F.expr("bit_or(bit)").alias(bits))
    found = rows.withColumn(mark, place(key)).withColumn(w, F.expr(f"`{mark}` div 64")).join(F.broadcast(table), w, "left")
    bit = F.expr(f"coalesce(shiftrightunsigned(`{bits}`, int(`{mark}` % 64)) & 1 = 1, false)")
    return found.withColumn(mark, bit).drop(w, bits)


def without(rows: DataFrame, gone: DataFrame, *keys: Column) -> DataFrame:
    """The rows whose ``keys`` are not a row of ``gone`` (a column a key, in order); nulls are equal.

    Rows whose last key is surely not there stay where they lie; only the others move to be looked up.
    """
    mark = fresh(rows, "_mark")
    names = [f"{mark}_{i}" for i in range(len(keys))]
    gone = gone.toDF(*names).distinct()
    told = may_be_among(rows, keys[-1], gone.select(names[-1]), mark)
    same = F.lit(True)
    for k, n in zip(keys, names, strict=True):
        same = same & k.eqNullSafe(F.col(n))
    some = told.filter(F.col(mark)).join(gone, same, "left_anti")
    return told.filter(~F.col(mark)).unionByName(some).drop(mark)


def ranked(rows: DataFrame, order: list[str], rank: str = "rank") -> DataFrame:
    """``rows`` with their place from 0 in the order of any columns; ties in any order.

    Rows are dealt by ranges and sorted where they lie, and written in that order; a row's place is that in its file
    and the sizes of the files before it. The only window without partitions is over a row a file.
    """
    spark = rows.sparkSession
    path = shared_dir(spark, "ranked")
    rows.orderBy(*order).write.parquet(path)
    file, at, before = (fresh(rows, n) for n in ("_file", "_at", "_before"))
    back = spark.read.schema(rows.schema).parquet(path).select("*", F.col("_metadata.file_name").alias(file), F.col("_metadata.row_index").alias(at))
    # A task's files are numbered by the task, and a large one's by their turn.
    sizes = back.groupBy(file).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy(F.regexp_extract(file, r"^part-(\d+)", 1), F.regexp_extract(file, r"-c(\d+)", 1)).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(file, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias(before))
    return back.join(F.broadcast(sizes), file).withColumn(rank, F.col(before) + F.col(at)).drop(file, at, before)


def head_bytes(spark: SparkSession, path: str, most: int) -> bytes:
    """The first bytes of a file, or of the first file of a folder or pattern that is not empty, wherever Spark can read it."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop.Path(path)) or []
    files = []
    for s in found:
        files += [x.getPath() for x in fs.listStatus(s.getPath()) if x.isFile() and x.getLen() > 0 and not x.getPath().getName().startswith(("_", "."))] if s.isDirectory() else [s.getPath()]
    if not files:
        return b""
    stream = fs.open(min(files, key=lambda p: p.getName()))
    try:
        return bytes(stream.readNBytes(most))
    finally:
        stream.close()


def put_bytes(spark: SparkSession, path: str, content: bytes) -> str:
    """``path`` with the content of a small file, written wherever Spark can write."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.create(hadoop.Path(path), True)
    try:
        stream.write(bytearray(content))
    finally:
        stream.close()
    return path


def md5_of(spark: SparkSession, path: str) -> tuple[int, str]:
    """(size, MD5) of a file of any size, read as a stream."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.open(hadoop.Path(path))
    try:
        return fs.getFileStatus(hadoop.Path(path)).getLen(), spark._jvm.org.apache.commons.codec.digest.DigestUtils.md5Hex(stream)
    finally:
        stream.close()
