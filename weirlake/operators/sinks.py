"""Sinks: routed tables with safe replace, snapshots, manifests, catalogues, reports and small state files."""

from __future__ import annotations

import contextlib
import hashlib
import json
import os
import tempfile
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tables(rows: DataFrame, path: str, table: str = "_table") -> None:
    """Rows to the folders of their tables; only tables that are in ``rows`` are replaced."""
    spark = rows.sparkSession
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        rows.write.partitionBy(table).mode("overwrite").parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def write_merged(new: DataFrame, path: str, version: int, keys: list[str]) -> str:
    """The next snapshot of a keyed table below ``path``: rows of the last one by key, replaced by ``new``."""
    from weirlake.operators.changes import merge_by_key

    spark = new.sparkSession
    out = f"{path}/v={version}"
    rows = new if version == 0 else merge_by_key(spark.read.parquet(f"{path}/v={version - 1}"), new, keys)
    rows.write.mode("overwrite").parquet(out)
    return out


def archive_tables(spark, path: str, names: list[str], table: str = "_table") -> int:
    """Move removed tables' folders under ``legacy`` instead of deleting them; how many were moved."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    top = hadoop.Path(path)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    moved = 0
    for name in names:
        here = hadoop.Path(f"{path}/{table}={name}")
        if fs.exists(here):
            fs.mkdirs(hadoop.Path(f"{path}_legacy"))
            moved += bool(fs.rename(here, hadoop.Path(f"{path}_legacy/{table}={name}")))
    return moved


def manifest(sources: DataFrame) -> DataFrame:
    """One manifest document a source as JSON: identity, delivery, rights and inventory."""
    part = lambda *cols: F.struct(*cols)
    doc = F.struct(
        F.lit(3).alias("schema_version"), "source_id", part("delivery_status", "sync_status", "freshness_status").alias("status"),
        part("rights_tier", "access_tier").alias("rights"), part("files", "bytes", "rows").alias("inventory"),
    )
    return sources.select("source_id", F.to_json(doc).alias("manifest"))


def catalogue(sources: DataFrame) -> DataFrame:
    """(domain, sources): each domain's sources, by id."""
    one = F.struct("source_id", "delivery_status", "country_code")
    return sources.groupBy("domain").agg(F.sort_array(F.collect_list(one)).alias("sources"))


def needs_ocr(pages: DataFrame, least: int = 80) -> DataFrame:
    """PDF documents with fewer than ``least`` extracted characters."""
    return pages.filter((F.col("format") == "pdf") & (F.char_length(F.coalesce("text", F.lit(""))) < least)).select("source_id", "url", "sha256", F.char_length(F.coalesce("text", F.lit(""))).alias("text_chars"))


def atomic_json(path: str, payload) -> None:
    """Write beside the target, flush to disk, rename."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    handle, temporary = tempfile.mkstemp(dir=os.path.dirname(path) or ".", prefix=".tmp-")
    try:
        with os.fdopen(handle, "w", encoding="utf-8") as f:
            json.dump(payload, f, ensure_ascii=False, sort_keys=True, indent=2)
            f.flush()
            os.fsync(f.fileno())
        os.replace(temporary, path)
    except BaseException:
        with contextlib.suppress(FileNotFoundError):
            os.unlink(temporary)
        raise


def load_json(path: str, default=None):
    """A state file's content; a corrupt file is set aside and ``default`` takes its place."""
    try:
        with open(path, encoding="utf-8") as f:
            return json.load(f)
    except FileNotFoundError:
        return default
    except ValueError:
        os.replace(path, f"{path}.corrupt-{int(time.time())}")
        return default


def save_snapshot(folder: str, stem: str, chunks, extension: str, most: int | None = None, expected: str | None = None) -> dict:
    """Stream bytes into ``stem--digest.ext``; nothing is left if they are too many or not the ones expected."""
    os.makedirs(folder, exist_ok=True)
    digest, size = hashlib.sha256(), 0
    handle, temporary = tempfile.mkstemp(dir=folder, prefix=".part-")
    try:
        with os.fdopen(handle, "wb") as f:
            for c in chunks:
                size += len(c)
                if most is not None and size > most:
                    raise ValueError(f"more than {most} bytes")
                digest.update(c)
                f.write(c)
            f.flush()
            os.fsync(f.fileno())
        sha = digest.hexdigest()
        if expected and expected.lower() != sha:
            raise ValueError("unexpected digest")
        path = os.path.join(folder, f"{stem[:120]}--{sha[:16]}{extension[:16]}")
        known = os.path.exists(path)
        os.unlink(temporary) if known else os.replace(temporary, path)
    except BaseException:
        with contextlib.suppress(FileNotFoundError):
            os.unlink(temporary)
        raise
    return {"path": path, "sha256": sha, "size_bytes": size, "known": known}


def write_report(folder: str, parts: dict[str, DataFrame], title: str, gates: dict[str, bool]) -> None:
    """One JSON file for each part, and a Markdown page with the gates as a check-list. Parts are report-sized."""
    for name, df in parts.items():
        atomic_json(os.path.join(folder, f"{name}.json"), [json.loads(r["j"]) for r in df.select(F.to_json(F.struct("*")).alias("j")).collect()])
    lines = [f"# {title}", "", *(f"- [{'x' if ok else ' '}] {name}" for name, ok in gates.items()), ""]
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "report.md"), "w", encoding="utf-8") as f:
        f.write("\n".join(lines))
