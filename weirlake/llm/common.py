"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirlake.functions.bind import let
from weirlake.operators.staging import fresh, may_be_among, shared_dir, spread, without  # noqa: F401

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Whether a statement's shuffle files go when it ends, not when the driver's garbage collector finds them unused.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 2_000):
    """Arrow batches of fewer rows meanwhile, where the session has Spark's default: rows here are whole texts.

    Spark bounds a batch by bytes as well; the session is left as it was found.
    """
    before = spark.conf.get(BATCH)
    if before == "10000":
        spark.conf.set(BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """What is written meanwhile leaves no shuffle files behind: many steps one after the other take the disk of the largest, not of all."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


#: What ``saved`` wrote in each scope that is open, the innermost last.
_SCOPES: list[list[tuple[str, str]]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession, *keep: str):
    """Deletes what is saved meanwhile under other names than ``keep``; those pass to the scope around this one.

    ``keep`` names all that the result is read from once it leaves the scope.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        own = _SCOPES.pop()
        hadoop = spark._jvm.org.apache.hadoop.fs
        for name, path in own:
            if name not in keep:
                where = hadoop.Path(path)
                where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
            elif _SCOPES:
                _SCOPES[-1].append((name, path))


def saved(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage and survives lost executors.

    ``files`` bounds how many files (and tasks of the last stage) there are; callers derive it from row counts, so
    that small results do not become a file a shuffle partition.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    if _SCOPES:
        _SCOPES[-1].append((name, path))
    with small_batches(spark), shuffles_dropped(spark):
        (df if files is None else df.coalesce(max(1, files))).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few(rows: int, each: int) -> int:
    """How many files hold ``rows`` rows, ``each`` a file."""
    return max(1, -(-rows // each))


def counted(df: DataFrame, name: str, files: int | None = None) -> tuple[DataFrame, int]:
    """``saved``, and how many rows there are."""
    out = saved(df, name, files)
    return out, out.count()


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; texts of one byte per character take the faster built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def running(values: Column, f) -> Column:
    """Running totals of an array under an associative ``f``, by doubling: each step joins every value with that 1, 2, 4, ... places before."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"))

    def step(acc: Column, k: Column) -> Column:
        far = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(acc, lambda v, i: F.when(i >= far, f(F.get(acc, i - far), v)).otherwise(v))

    return F.aggregate(steps, values, step)


def spans_of(text: Column, pattern: str, kind: str, keep=None, group: int = 0) -> Column:
    """Array of (s, e, kind, v) for the leftmost non-overlapping matches of a Java regex, JVM-side.

    ``split`` gives the text between matches and ``regexp_extract_all`` the matches, so offsets
    (code points, end exclusive) follow from running lengths, in time n log n for n matches. ``keep`` filters on the value of ``group``.
    """
    gaps = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.arrays_zip(gaps.alias("g"), whole.alias("m"), value.alias("v"))

    def placed(xs: Column) -> Column:
        lengths = F.transform(xs, lambda x: F.char_length(x["g"]) + F.coalesce(F.char_length(x["m"]), F.lit(0)))
        one = lambda ends: F.transform(F.slice(xs, F.lit(1), F.size(xs) - 1), lambda x, i: F.struct((F.get(ends, i) - F.char_length(x["m"])).alias("s"), F.get(ends, i).alias("e"), F.lit(kind).alias("kind"), x["v"].alias("v")))
        return let(running(lengths, lambda a, b: a + b), one)

    # The last part is what follows the last match.
    out = let(parts, placed)
    out = out if keep is None else F.filter(out, keep)
    return out


def bernoulli(row_id: Column, fraction: float) -> Column:
    """A repeatable coin for a row id, used only to draw bounded fitting samples."""
    return F.pmod(F.xxhash64(row_id.cast("string"), F.lit("sample")), F.lit(1_000_000)) < int(fraction * 1_000_000)


def once_a_worker(key: str, make):
    """What ``make`` returned the first time in this Python process; workers serve many tasks.

    Only the last key's value is held, so that one operator's tables do not stay beside the next one's.
    """
    held = sys.modules.setdefault("_weirlake_worker", types.ModuleType("_weirlake_worker")).__dict__.setdefault("held", {})
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]
