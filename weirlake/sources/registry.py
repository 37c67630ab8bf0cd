"""Source registries and layered configuration."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("source_id", "title", "domain", "provider", "source_url", "rights_tier", "access_tier", "priority")


def read_registries(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All registries' rows; a repeated or malformed id is an error."""
    rows = spark.read.option("header", True).csv(paths).select(*(F.trim(c).alias(c) for c in COLUMNS)).filter("coalesce(source_id, '') <> ''")
    repeated = [r.source_id for r in rows.groupBy("source_id").count().filter("count > 1").select("source_id").limit(5).collect()]
    if repeated:
        raise ValueError(f"repeated source ids: {repeated}")
    return rows


def validate_registry(rows: DataFrame, prefix: str) -> DataFrame:
    """(source_id, problem), a problem a row."""
    empty = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    marks = [(empty(c), f"{c} is empty") for c in COLUMNS]
    marks += [(~F.col("source_id").startswith(prefix), "source_id has another prefix"), (~F.col("source_url").rlike("^https?://"), "source_url is no web address"), (~F.col("priority").isin("P0", "P1", "P2", "P3"), "priority is unknown")]
    return rows.select("source_id", F.explode(F.array_compact(F.array(*(F.when(c, F.lit(n)) for c, n in marks)))).alias("problem"))


def _flat(value, path: str = "") -> list[tuple[str, str]]:
    if isinstance(value, dict) and value:
        return [x for k, v in value.items() for x in _flat(v, f"{path}.{k}" if path else str(k))]
    return [(path, json.dumps(value, sort_keys=True))]


def layered(spark: SparkSession, layers: list[dict]) -> DataFrame:
    """(path, value): each leaf's value from the last layer that has it."""
    rows = [(p, v, i) for i, layer in enumerate(layers) for p, v in _flat(layer)]
    return spark.createDataFrame(rows, "path string, value string, layer int").groupBy("path").agg(F.max_by("value", "layer").alias("value"))


def expand_groups(config: dict) -> dict:
    """Source groups spread to their members; a member's own settings win."""
    out = {k: v for k, v in config.items() if k != "source_groups"}
    sources = dict(out.get("sources", {}))
    for group in (config.get("source_groups") or {}).values():
        for member in group.get("members", []):
            sources[member] = {**group.get("options", {}), **sources.get(member, {})}
    return out | {"sources": sources}


IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def checked_identifier(name: str) -> str:
    if not IDENTIFIER.match(name):
        raise ValueError(f"unsafe table name: {name}")
    return name
