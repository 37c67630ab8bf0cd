"""Record-set sources: delivered payloads as VARIANT rows, normalised, gated by signature, and planned.

Payloads come as files that a transport has left in the lake; what is read, what changed and what is
emitted follows the same rules whatever brought them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirlake.functions.versions import size_bytes
from weirlake.operators.changes import changed, transfer_plan, two_level
from weirlake.operators.staging import md5_of, ranked

SHAPES = ("results", "data", "items", "datasets", "rows", "records")


def items(payload: str, keys: tuple[str, ...] = SHAPES) -> Column:
    """The elements of a VARIANT: a list itself, the first key that holds a list, else an empty array."""
    own = F.expr(f"try_variant_get({payload}, '$', 'array<variant>')")
    return F.coalesce(own, *(F.expr(f"try_variant_get({payload}, '$.{k}', 'array<variant>')") for k in keys), F.expr("cast(array() as array<variant>)"))


def field(value: str, path: str, kind: str = "string") -> Column:
    return F.expr(f"try_variant_get({value}, '{path}', '{kind}')")


def first_present(value: str, *paths: str) -> Column:
    """The first of several text fields that is not empty."""
    return F.coalesce(*(F.nullif(F.trim(field(value, p)), F.lit("")) for p in paths))


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """(path, payload VARIANT) of JSON documents."""
    return spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), F.expr("parse_json(value)").alias("payload"))


def catalogue_pages(pages: DataFrame, advertised: int | None = None) -> DataFrame:
    """(id, item) of all pages' items, an id once; an error if there are fewer than advertised."""
    rows = pages.select(F.explode(items("payload")).alias("item"))
    found = rows.withColumn("id", first_present("item", "$.id", "$.slug", "$.name")).filter("id is not null")
    found = found.withColumn("_json", F.to_json("item")).groupBy("id").agg(F.min("_json").alias("_json")).select("id", F.expr("parse_json(_json)").alias("item"))
    if advertised is not None and (n := found.count()) < advertised:
        raise ValueError(f"{n} of {advertised} advertised items")
    return found


def cursor_chain(pages: DataFrame, start: str) -> list[str]:
    """The order of cursor pages (cursor, next) from ``start``; an error if it loops or breaks.

    There is a row a page, so the chain is small and is followed on the driver.
    """
    following = {r["cursor"]: r["next"] for r in pages.select("cursor", "next").collect()}
    out, at = [], start
    while at is not None:
        if at in out:
            raise ValueError(f"the cursor {at} comes again")
        if at not in following:
            raise ValueError(f"the page {at} is missing")
        out.append(at)
        at = following[at]
    return out


def attachments(detail: str = "payload") -> Column:
    """Attachments of a dataset's metadata as (name, url): a list, an object that holds one, or a keyed object."""
    whole = F.expr(f"try_variant_get({detail}, '$.attachments', 'variant')")
    listed = F.coalesce(F.expr(f"try_variant_get({detail}, '$.attachments', 'array<variant>')"), *(F.expr(f"try_variant_get({detail}, '$.attachments.{k}', 'array<variant>')") for k in ("items", "files", "results", "data")))
    of_list = F.transform(listed, lambda x: F.struct(F.coalesce(F.try_variant_get(x, "$.name", "string"), F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string"))).alias("name"), F.try_variant_get(x, "$.url", "string").alias("url")))
    keyed = F.try_variant_get(whole, "$", "map<string,variant>")
    of_map = F.transform(F.map_entries(keyed), lambda e: F.struct(F.coalesce(F.try_variant_get(e["value"], "$.name", "string"), e["key"]).alias("name"), F.coalesce(F.try_variant_get(e["value"], "$.url", "string"), F.when(F.schema_of_variant(e["value"]) == "STRING", F.try_variant_get(e["value"], "$", "string"))).alias("url")))
    return F.coalesce(of_list, of_map)


def signature(*columns: str) -> Column:
    """SHA-256 of the named columns as JSON, in the order of their names."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def group_signature(rows: DataFrame, by: str, columns: list[str], order: str) -> DataFrame:
    """One signature a group, over its rows' signatures in order."""
    own = rows.select(by, order, signature(*columns).alias("s"))
    return own.groupBy(by).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "s"))), lambda x: x["s"]), ""), 256).alias("signature"))


def country_rows(rows: DataFrame, columns: list[str], aliases: list[str]) -> DataFrame:
    """Rows in which any of the columns is an alias, caselessly and trimmed."""
    named = F.array(*(F.lower(F.trim(F.coalesce(c, F.lit("")))) for c in columns))
    return rows.filter(F.arrays_overlap(named, F.array(*(F.lit(a.lower().strip()) for a in aliases))))


def reference_area(rows: DataFrame, country: str, frequencies: tuple[str, ...] = ()) -> DataFrame:
    """Rows of (id, ref_area, freq) of a country by area or id prefix; a missing frequency is the id's last part."""
    rid = F.upper(F.coalesce("id", F.lit("")))
    freq = F.upper(F.when(F.coalesce("freq", F.lit("")) != "", F.col("freq")).when(rid.contains("_"), F.regexp_extract(rid, "([^_]*)$", 1)).otherwise(""))
    ok = (F.upper(F.coalesce("ref_area", F.lit(""))) == country.upper()) | rid.startswith(country.upper() + "_")
    return rows.filter(ok & freq.isin(*(f.upper() for f in frequencies)) if frequencies else ok)


def bulk_plan(catalogue: DataFrame, committed: DataFrame, per_file: int, budget: int) -> DataFrame:
    """What to transfer of a bulk catalogue (code, size text, signature): changed files, in order of code, within budgets."""
    due = changed(catalogue.withColumn("source_id", F.lit("bulk")), committed.withColumn("source_id", F.lit("bulk")), ["source_id", "code"])
    return transfer_plan(due.select(F.col("code").alias("ord"), F.col("code").alias("item_id"), size_bytes(F.col("size")).alias("size")), per_file, budget)


def indicator_plan(toc: DataFrame, indicators: DataFrame, committed_toc: DataFrame, committed_indicators: DataFrame) -> DataFrame:
    """Indicators to read: those that changed, in countries whose table of contents changed."""
    return two_level(toc, indicators, committed_toc, committed_indicators)


def batches(rows: DataFrame, key: str, size: int) -> DataFrame:
    """(batch, keys): keys in order, ``size`` to a batch."""
    numbered = ranked(rows.select(key).distinct(), [key], "_n")
    return numbered.groupBy(F.floor(F.col("_n") / size).cast("long").alias("batch")).agg(F.sort_array(F.collect_list(key)).alias("keys"))


def bisected(keys: list[str], fetch) -> tuple[list, list[str]]:
    """(results, refused keys): a refused batch is halved until the refused keys stand alone."""
    if not keys:
        return [], []
    try:
        return [fetch(keys)], []
    except ValueError:
        if len(keys) == 1:
            return [], keys
    half = len(keys) // 2
    a, b = bisected(keys[:half], fetch), bisected(keys[half:], fetch)
    return a[0] + b[0], a[1] + b[1]


def classified(observations: DataFrame, classification: DataFrame, key: str) -> DataFrame:
    """Observations with their indicator's classification; Spark broadcasts it while it is small."""
    return observations.join(classification, key, "left")


def geo_features(collections: DataFrame) -> DataFrame:
    """(level, feature_index, feature_id, properties, geometry) of GeoJSON feature collections (level, payload)."""
    f = collections.select("level", F.posexplode(F.expr("try_variant_get(payload, '$.features', 'array<variant>')")).alias("feature_index", "f"))
    return f.select("level", "feature_index", F.coalesce(field("f", "$.id"), F.col("feature_index").cast("string")).alias("feature_id"), F.to_json(F.expr("try_variant_get(f, '$.properties', 'variant')")).alias("properties"), F.to_json(F.expr("try_variant_get(f, '$.geometry', 'variant')")).alias("geometry"))


def rebuild_levels(levels: DataFrame, committed: DataFrame) -> DataFrame:
    """All levels if any of them changed, else none."""
    any_changed = not changed(levels, committed, ["level"]).isEmpty()
    return levels if any_changed else levels.limit(0)


def extract_snapshot(spark: SparkSession, path: str, md5: str | None) -> DataFrame:
    """One row of a big file's facts, read as a stream; an error if its digest is not the advertised one."""
    size, found = md5_of(spark, path)
    if md5 and found != md5.lower():
        raise ValueError("unexpected digest")
    return spark.createDataFrame([(path, size, found)], "path string, size_bytes long, md5 string")


def with_provenance(rows: DataFrame, source_id: str, dataset: str, url: str, retrieved_at: str, order: list[str]) -> DataFrame:
    """Rows with where they came from and their place in the delivered order."""
    out = ranked(rows, order, "_prov_row_index")
    names = [*rows.columns, "_prov_source_id", "_prov_dataset", "_prov_url", "_prov_retrieved_at", "_prov_row_index"]
    return out.withColumns({"_prov_source_id": F.lit(source_id), "_prov_dataset": F.lit(dataset), "_prov_url": F.lit(url), "_prov_retrieved_at": F.lit(retrieved_at)}).select(*(F.col(f"`{c}`") for c in names))
