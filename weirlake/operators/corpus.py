"""Corpus building: text, quality gate, fingerprint dedup, chunks, shards and manifest."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirlake.functions.bind import once
from weirlake.functions.text import LEAST_QUALITY, chunk_id, chunks, clean_text, fingerprint, score_text
from weirlake.operators.staging import ranked, staged, without


def scored(rows: DataFrame, text: str = "text", full_fold: bool = False) -> DataFrame:
    """``rows`` with ``cleaned``, ``quality`` and ``fingerprint``."""
    out = once(rows, {"cleaned": clean_text(F.col(text))})
    return once(out, {"quality": score_text(F.col("cleaned")), "fingerprint": fingerprint(F.col("cleaned"), full_fold)})


def first_copies(rows: DataFrame, order: str, key: str = "fingerprint") -> DataFrame:
    """The first row in ``order`` (a unique column) of each key.

    What ``rows`` computes is staged, so computed once. Only keys and places are aggregated, map-side first, so a
    key with very many copies costs a row a task; later copies are dropped by their places, and rows that are surely none stay
    where they lie, texts and all.
    """
    rows = staged(rows, "copies")
    own = rows.select(key, order)
    first = own.groupBy(key).agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(key, "_first")
    later = staged(own.join(first, key).filter(F.col(order) > F.col("_first")).select(order), "later")
    return without(rows, later, F.col(order)).select(*rows.columns)


def global_rank(rows: DataFrame, order: str, width: int = 10_000) -> DataFrame:
    """``rows`` with ``rank`` from 0 by a unique whole-number column, without ordering all rows in one task.

    Rows are ranked inside blocks of ``width`` consecutive values, blocks are summed up inside blocks of blocks, and only
    those in order in one task: a row for each ``width * width`` values.
    """
    block = F.floor(F.col(order) / width)
    blocks = rows.groupBy(block.alias("_b")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_s", F.floor(F.col("_b") / width))
    before = lambda by: F.coalesce(F.sum("_n").over(by), F.lit(0))
    supers = blocks.groupBy("_s").agg(F.sum("_n").alias("_n")).select("_s", before(Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)).alias("_p"))
    offsets = blocks.withColumn("_q", before(Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))).join(supers, "_s").select("_b", (F.col("_p") + F.col("_q")).alias("_o"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy(order)) - 1
    return rows.withColumn("_b", block).withColumn("_i", inside).join(offsets, "_b").withColumn("rank", (F.col("_o") + F.col("_i")).cast("long")).drop("_b", "_i", "_o")


def chunked(rows: DataFrame, id_col: str, text: str = "cleaned", size: int = 3500, overlap: int = 250) -> DataFrame:
    """(id, chunk_index, chunk_id, n_chars, chunk)."""
    out = rows.select(id_col, F.posexplode(chunks(F.col(text), size, overlap)).alias("chunk_index", "chunk"))
    return out.select(id_col, "chunk_index", chunk_id(F.col(id_col), F.col("chunk_index")).alias("chunk_id"), F.char_length("chunk").alias("n_chars"), "chunk")


def union_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """All tables' rows under the union of their columns, with their table's name."""
    out = None
    for name, df in tables.items():
        own = df.withColumn("_prov_table", F.lit(name))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def build_corpus(rows: DataFrame, order: str, text: str = "text", least: float = LEAST_QUALITY) -> DataFrame:
    """Rows of a corpus: cleaned text, sha256, quality; good enough ones, first copies only."""
    return _chosen(scored(rows.select(order, text), text), order, least)


def _chosen(scored_rows: DataFrame, order: str, least: float) -> DataFrame:
    good = scored_rows.filter(F.col("quality") >= least).select(order, "cleaned", "quality", "fingerprint")
    return first_copies(good, order).select(order, F.col("cleaned").alias("text"), F.col("fingerprint").alias("sha256"), "quality")


def corpus_stats(rows: DataFrame, order: str, text: str = "text", least: float = LEAST_QUALITY) -> DataFrame:
    """(documents_seen, rejected_quality, documents_written, duplicates)."""
    return _stats(scored(rows.select(order, text), text), least)


def _stats(scored_rows: DataFrame, least: float) -> DataFrame:
    good = F.col("quality") >= least
    by_key = scored_rows.groupBy("fingerprint", good.alias("good")).agg(F.count(F.lit(1)).alias("n"))
    return by_key.agg(
        F.sum("n").alias("documents_seen"), F.coalesce(F.sum(F.when(~F.col("good"), F.col("n"))), F.lit(0)).alias("rejected_quality"),
        F.count_if("good").alias("documents_written"), F.coalesce(F.sum(F.when(F.col("good"), F.col("n") - 1)), F.lit(0)).alias("duplicates"),
    )


def write_corpus(rows: DataFrame, path: str, version: str, order: str, text: str = "text", shard_size: int = 100_000, least: float = LEAST_QUALITY) -> dict:
    """JSONL shards of at most ``shard_size`` records below ``path/version``, and the manifest with the shards' digest and its own.

    Texts are scored once. ``records_sha256`` is over the digests of all records in order of the corpus, so it says what the shards hold
    however they are cut.
    """
    own = staged(scored(rows.select(order, text), text), "scored")
    chosen = staged(_chosen(own, order, least), "chosen")
    chosen.write.option("maxRecordsPerFile", shard_size).mode("errorifexists").json(f"{path}/{version}/shards")
    line = F.sha2(F.to_json(F.struct(*chosen.columns)), 256)
    # Digests are folded block by block of the order, so that no task holds all of them.
    folded = ranked(chosen.select(order, line.alias("d")), [order])
    while (total := folded.count()) > 1:
        blocks = folded.groupBy(F.floor(F.col("rank") / 4096).alias("rank")).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "d"))), lambda x: x["d"]), ""), 256).alias("d"))
        folded = staged(blocks, "digests")
        if total <= 4096:
            break
    digest_row = folded.first()
    stats = _stats(own, least).first().asDict()
    manifest = {"version": version, "immutable": True, "format": "jsonl", "stats": stats, "records_sha256": digest_row["d"] if digest_row else hashlib.sha256(b"").hexdigest()}
    payload = json.dumps(manifest, sort_keys=True, indent=2) + "\n"
    digest = hashlib.sha256(payload.encode()).hexdigest()
    rows.sparkSession.createDataFrame([(payload, digest)], "manifest string, sha256 string").coalesce(1).write.mode("errorifexists").json(f"{path}/{version}/manifest")
    return manifest | {"sha256": digest}
