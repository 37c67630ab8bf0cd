"""Exact deduplication as a stateful stream.

The keyed state (RocksDB, below the shared checkpoint folder, no expiry) holds for each digest the
number of copies seen, the surviving identifier and the locator of its content: the load and row under which it
lies. Rows whose digest was hit, within a load or by an earlier one, have their full bytes compared with
what the locator leads to before they are called equal; texts that only share a digest stay groups of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from weirlake.llm.common import few, fresh, may_be_among, saved, shared_dir, without

STATE = "spark.sql.streaming.stateStore."
STATE_CONF = {
    STATE + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    STATE + "rocksdb.boundedMemoryUsage": "true",
    STATE + "rocksdb.maxMemoryUsageMB": "64",
    STATE + "rocksdb.changelogCheckpointing.enabled": "true",
    # Else each state partition holds megabytes of preallocated, empty files.
    STATE + "rocksdb.allowFAllocate": "false",
}


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _with_load(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("load", IntegerType())])


def _fold(landing: DataFrame, state_dir: str) -> DataFrame:
    """Run what has landed through the keyed state; one row per digest touched: keeper, copies, locator."""
    spark = landing.sparkSession
    schema = _with_load(landing.schema)
    out = f"{state_dir}/updates"
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)
    try:
        # The largest id; of rows that share it the one landed last.
        best = F.max(F.struct("doc_id", "load", "row_no")).alias("best")
        state = (
            spark.readStream.schema(schema).parquet(f"{state_dir}/landing")
            .groupBy("digest", "n_bytes").agg(best, F.count(F.lit(1)).alias("copies"))
        )

        def write(batch: DataFrame, batch_id: int) -> None:
            # One folder a batch: a replay after a failure overwrites its own output.
            batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

        (
            state.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", f"{state_dir}/checkpoint")
            .trigger(availableNow=True).start().awaitTermination()
        )
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return _state(landing, state_dir)


def _state(landing: DataFrame, state_dir: str) -> DataFrame:
    """What the state says of each digest: keeper, copies, locator."""
    out = f"{state_dir}/updates"
    key = landing.schema["doc_id"].dataType.simpleString()
    kind = f"digest string, n_bytes int, best struct<doc_id:{key},load:int,row_no:bigint>, copies bigint, batch int"
    seen = landing.sparkSession.read.schema(kind).option("basePath", out).parquet(out)
    return seen.groupBy("digest", "n_bytes").agg(F.max("copies").alias("copies"), F.max("best").alias("best"))


def _loads(spark: SparkSession, state_dir: str) -> int:
    """How many loads have landed below ``state_dir``."""
    try:
        return spark.read.parquet(f"{state_dir}/landing").agg(F.max("load")).first()[0] + 1
    except AnalysisException:
        return 0


def exact_dedup(
    spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", state_dir: str | None = None,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (the digest).

    Texts are equal when their bytes are; the largest id of a group stays, and of rows that share
    that id the one landed last. Null text counts as empty. A null id loses to any other and stays
    only when its group has no other; an empty table gives no rows; other columns are not read.
    ``state_dir`` continues an earlier run's state, so a later load is held against all before it; the texts of all
    loads are then kept there, where locators lead. ``digest`` is the key of the state. Unequal texts with one
    digest are told apart by their bytes, in each load that brings a copy of either.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if rows.isEmpty():
        return rows.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), digest(F.col("text")).alias("text_sha256"))
    lasting = state_dir is not None
    state_dir = state_dir or shared_dir(spark, "dedup-state")
    load = _loads(spark, state_dir) if lasting else 0
    keyed = rows.select(digest(F.col("text")).alias("digest"), F.octet_length("text").alias("n_bytes"), "doc_id", F.monotonically_increasing_id().alias("row_no"), "text")
    if lasting:
        content = f"{state_dir}/content"
        keyed.write.parquet(f"{content}/load={load}")
        keyed = spark.read.schema(keyed.schema).parquet(f"{content}/load={load}")
    landing = keyed.drop("text")
    path = f"{state_dir}/landing/load={load}"
    landing.write.parquet(path)
    landed = spark.read.schema(landing.schema).parquet(path)
    total = landed.count()
    # Where earlier loads' content of these digests lies, before this load's rows take its place in the state.
    before = saved(landed.select("digest").distinct().join(_state(landing, state_dir), "digest"), "dedup-before", few(total, 250_000)) if load else None
    groups = saved(_fold(landing, state_dir), "dedup-groups", few(total, 50_000))

    # Full bytes on hits: the digests that this load hit, in itself or in an earlier one.
    hit = saved(groups.filter("copies > 1").join(landed.select("digest"), "digest", "left_semi").select("digest"), "dedup-hits", few(total, 250_000))
    met = keyed.select("digest", "text")
    if load:
        # The keepers of earlier loads, by their locators: the folder, then the row.
        earlier = spark.read.schema(_with_load(keyed.schema)).option("basePath", content).parquet(content).filter(F.col("load") < load)
        met = met.unionByName(earlier.join(before.select("best.load", "best.row_no"), ["load", "row_no"], "left_semi").select("digest", "text"))
    met = may_be_among(met, F.col("digest"), hit, "hit").filter("hit")
    # A task sends a text once, however many copies it has, so a large group of copies does not meet in one task.
    unlike = met.select("digest", "text").distinct().groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    unlike = saved(unlike.select("digest"), "dedup-unlike", few(total, 250_000))
    if lasting:
        # Once known to be shared by unequal texts, a digest is never taken for one group again.
        unlike.write.parquet(f"{state_dir}/unlike/load={load}")
        unlike = spark.read.schema("digest string").parquet(*(f"{state_dir}/unlike/load={i}" for i in range(load + 1))).distinct()

    found = landed.join(groups.select("digest", "n_bytes", "copies", "best"), ["digest", "n_bytes"], "left")
    if not unlike.isEmpty():
        found = _told_apart(found, earlier if load else None, keyed, unlike, load)
    return found.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("copies").alias("group_size"),
        ((F.col("best.load") == load) & (F.col("row_no") == F.col("best.row_no"))).alias("kept"), F.col("digest").alias("text_sha256"),
    )


def _told_apart(found: DataFrame, earlier: DataFrame | None, own: DataFrame, unlike: DataFrame, load: int) -> DataFrame:
    """``found`` with the groups of digests that unequal texts share put together by text instead."""
    rows = own.withColumn("load", F.lit(load))
    if earlier is not None:
        rows = rows.unionByName(earlier)
    groups = (
        rows.join(unlike, "digest", "left_semi").groupBy("digest", "text")
        .agg(F.max(F.struct("doc_id", "load", "row_no")).alias("own_best"), F.count(F.lit(1)).alias("own_copies"))
    )
    mine = own.join(unlike, "digest", "left_semi").join(groups, ["digest", "text"]).select("row_no", "own_best", "own_copies")
    return (
        found.join(mine, "row_no", "left").withColumn("best", F.coalesce("own_best", "best"))
        .withColumn("copies", F.coalesce("own_copies", "copies")).drop("own_best", "own_copies")
    )


def drop_copies(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``exact_dedup`` keeps, with all their columns; rows alike in id and text keep one.

    Only rows that may have copies move; all others stay where they lie.
    """
    found = exact_dedup(spark, docs, id_col, text_col).filter("group_size > 1")
    found = saved(found.groupBy("doc_id", "text_sha256").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("rows")), "dedup-rows", few(docs.count(), 250_000))
    sha = sha256(F.coalesce(F.col(text_col), F.lit("")))
    left = without(docs, found.filter("not kept").select("doc_id", "text_sha256"), F.col(id_col), sha)
    alike = found.filter("kept and rows > 1")
    if not alike.isEmpty():
        mark, maybe = fresh(docs, "_sha"), fresh(docs, "_maybe")
        told = may_be_among(left.withColumn(mark, sha), F.col(mark), alike.select("text_sha256"), maybe)
        left = told.filter(~F.col(maybe)).unionByName(told.filter(F.col(maybe)).dropDuplicates([id_col, mark])).drop(mark, maybe)
    return left.select(*(F.col(f"`{c}`") for c in docs.columns))
