"""Stages that resume, and immutable corpus releases: both are known by the digests of what they were made from."""

from __future__ import annotations

import datetime
import hashlib
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirlake.operators.merkle import multiset_digest, root_of, row_digest, settled, tree


@dataclass
class Stage:
    """A step from rows to rows; ``config`` and ``version`` are part of what its result is known by."""

    name: str
    run: Callable[[DataFrame], DataFrame]
    config: dict = field(default_factory=dict)
    version: int = 1


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text, None where there is none."""
    where, fs = _hadoop(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written under another name, then renamed."""
    where, fs = _hadoop(spark, path)
    other, _ = _hadoop(spark, f"{path}.tmp")
    stream = fs.create(other, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    fs.delete(where, False)
    if not fs.rename(other, where):
        raise OSError(f"could not put {path} in place")


def files_of(spark: SparkSession, path: str) -> dict[str, int]:
    """Data files of a folder and their sizes."""
    where, fs = _hadoop(spark, path)
    if not fs.exists(where):
        return {}
    found, out = fs.listFiles(where, True), {}
    while found.hasNext():
        f = found.next()
        name = f.getPath().toString().split(path.rstrip("/").split(":", 1)[-1], 1)[-1].lstrip("/")
        if not name.rsplit("/", 1)[-1].startswith(("_", ".")):
            out[name] = f.getLen()
    return out


def digest_of_files(files: dict[str, int]) -> str:
    return hashlib.sha256(json.dumps(sorted(files.items())).encode()).hexdigest()


def _now() -> str:
    return datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def config_digest(config: dict) -> str:
    return hashlib.sha256(json.dumps(config, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


def run_stage(spark: SparkSession, folder: str, stage: Stage, rows: DataFrame, input_root: str, input_rows: int, thorough: bool = False) -> tuple[DataFrame, dict]:
    """(rows, manifest) of a stage, made only if the result for this input, configuration and version is not there yet.

    A result counts as there if its manifest is, Spark's ``_SUCCESS`` is and its files are those of the manifest; with
    ``thorough`` its rows must have the manifest's digest as well. Anything else, such as what a killed run left, is
    written anew. The manifest comes last and at once.
    """
    config = config_digest(stage.config)
    key = hashlib.sha256(f"{stage.name}|{stage.version}|{config}|{input_root}".encode()).hexdigest()[:16]
    home = f"{folder.rstrip('/')}/{stage.name}/{key}"
    known = json.loads(read_text(spark, f"{home}/manifest.json") or "null")
    if known and read_text(spark, f"{home}/data/_SUCCESS") is not None and digest_of_files(files_of(spark, f"{home}/data")) == known["files_sha256"]:
        there = spark.read.parquet(f"{home}/data")
        if not thorough or root_of(tree(there))[0] == known["output_root"]:
            return there, known | {"resumed": True}
    started = _now()
    stage.run(rows).write.mode("overwrite").parquet(f"{home}/data")
    made = spark.read.parquet(f"{home}/data")
    root, n = root_of(tree(made))
    files = files_of(spark, f"{home}/data")
    manifest = {
        "stage": stage.name, "version": stage.version, "key": key, "config": stage.config, "config_sha256": config, "input_root": input_root, "output_root": root, "input_docs": input_rows,
        "output_docs": n, "rejected_docs": max(input_rows - n, 0), "files": len(files), "bytes": sum(files.values()), "files_sha256": digest_of_files(files), "started_at": started, "finished_at": _now(),
    }
    put_text(spark, f"{home}/manifest.json", json.dumps(manifest, sort_keys=True, indent=1))
    return made, manifest | {"resumed": False}


def run_stages(rows: DataFrame, stages: list[Stage], folder: str, thorough: bool = False) -> tuple[DataFrame, list[dict]]:
    """All stages in order, each from the written result of the one before; a run after a failure redoes only what is missing.

    The input is known by its hash tree, so the same rows in another order or layout resume as well, and a stage whose
    result did not change lets all after it resume.
    """
    spark = rows.sparkSession
    root, n = root_of(tree(rows))
    manifests = []
    for stage in stages:
        rows, manifest = run_stage(spark, folder, stage, rows, root, n, thorough)
        manifests.append(manifest)
        root, n = manifest["output_root"], manifest["output_docs"]
    return rows, manifests


def shard_digests(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(shard, rows, bytes, digest) by the file that a row lies in; files are read in parts, as any scan does."""
    own = rows.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"), row_digest(rows, columns).alias("digest"))
    out = own.groupBy("path").agg(F.max("bytes").alias("bytes"), *multiset_digest())
    return out.select(F.regexp_extract("path", "([^/]+/[^/]+)$", 1).alias("shard"), "rows", "bytes", settled().alias("digest"))


def publish(rows: DataFrame, folder: str, release_id: str, split: str, domain: Column, source: Column, tokens: Column, config: dict | None = None, rejected: int = 0, seed: int = 0) -> dict:
    """A release below ``folder``: shards by split, their digests, statistics by source, and ``manifest.json`` last.

    A release that is there is never written again: asked for with the same rows and configuration its manifest is returned, with others it is
    an error. Without a manifest what lies there is a run that did not end, and is replaced. Digests of shards and
    statistics are tables, so that the manifest stays small whatever the release's size.
    """
    spark = rows.sparkSession
    home = f"{folder.rstrip('/')}/{release_id}"
    given, known = config_digest((config or {}) | {"seed": seed}), json.loads(read_text(spark, f"{home}/manifest.json") or "null")
    if known:
        if known["config_sha256"] != given or known["root"] != root_of(tree(rows))[0]:
            raise FileExistsError(f"release {release_id} is there with other content")
        return known
    rows.write.mode("overwrite").partitionBy(split).parquet(f"{home}/data")
    data = spark.read.schema(rows.schema).parquet(f"{home}/data")
    shards = shard_digests(data)
    shards.write.mode("overwrite").parquet(f"{home}/shards.parquet")
    shards = spark.read.schema(shards.schema).parquet(f"{home}/shards.parquet")
    stats = data.groupBy(F.col(split).alias("split"), domain.cast("string").alias("domain"), source.cast("string").alias("source")).agg(F.count(F.lit(1)).alias("documents"), F.sum(tokens).cast("long").alias("tokens"))
    stats.write.mode("overwrite").parquet(f"{home}/source-stats.parquet")
    stats = spark.read.schema(stats.schema).parquet(f"{home}/source-stats.parquet")
    total = shards.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    by_split = stats.groupBy("split").agg(F.sum("documents").alias("documents"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens")).collect()
    manifest = {
        "release_id": release_id, "created_at": _now(), "root": root_of(tree(data))[0], "shards_root": root_of(tree(shards))[0], "shards": total["n"], "documents": total["rows"], "bytes": total["bytes"],
        "rejected_documents": rejected, "tokens": sum(r["tokens"] for r in by_split), "splits": {str(r["split"]): {"documents": r["documents"], "tokens": r["tokens"]} for r in by_split},
        "config": config or {}, "config_sha256": given, "seed": seed,
    }
    put_text(spark, f"{home}/manifest.json", json.dumps(manifest, sort_keys=True, indent=1))
    return manifest


def verify_release(spark: SparkSession, folder: str, release_id: str, schema) -> DataFrame:
    """(shard, status): ``ok``, ``changed``, ``missing`` or ``unknown``, by the digests of what lies there now."""
    home = f"{folder.rstrip('/')}/{release_id}"
    said = spark.read.parquet(f"{home}/shards.parquet").select("shard", F.col("digest").alias("_said"))
    now = shard_digests(spark.read.schema(schema).parquet(f"{home}/data")).select("shard", F.col("digest").alias("_now"))
    status = F.when(F.col("_now").isNull(), "missing").when(F.col("_said").isNull(), "unknown").when(F.col("_now") != F.col("_said"), "changed").otherwise("ok")
    return said.join(now, "shard", "full").select("shard", status.alias("status"))
