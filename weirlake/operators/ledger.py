"""The artifact ledger: ingest, verification, state marks, retries and run close-out.

A ledger row is (source_id, artifact_id, …). Every function is a merge or a projection that gives the
next snapshot; nothing is updated in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirlake.functions.scoring import physical_state, present

KEYS = ["source_id", "artifact_id"]
PHYSICAL = ("FETCHED", "UNCHANGED")
SETTLED = ("DISCOVERED", "REMOVED", "UPSTREAM_GHOST")
REPAIRABLE = ("LOCAL_MISSING", "CORRUPTED", "FAILED")


def ingest(ledger: DataFrame, upstream: DataFrame, present_paths: DataFrame, now: str) -> DataFrame:
    """The ledger after a run's upstream rows (source_id, artifact_id, url, signature, sha256, size_bytes, local_path, last_result, removed, downloaded, error).

    ``present_paths`` is (local_path). A verification stands only while hash and path stay the same and
    the artifact is physically there. Null columns of an upstream row keep what the ledger has.
    """
    here = present_paths.select("local_path", F.lit(True).alias("_here")).distinct()
    up = upstream.join(here, "local_path", "left")
    state = physical_state(F.col("last_result"), F.col("removed"), F.col("error"), F.col("downloaded"), F.col("_here"))
    up = up.select(*KEYS, *(F.col(c).alias(f"u_{c}") for c in ("url", "signature", "sha256", "size_bytes", "local_path", "error")), state.alias("u_status"))
    both = ledger.join(up, KEYS, "full_outer")
    hit = F.col("u_status").isNotNull()
    kept = {c: F.coalesce(F.when(present(F.col(f"u_{c}")), F.col(f"u_{c}")), F.col(c)) for c in ("url", "signature", "sha256", "size_bytes", "local_path")}
    same = kept["sha256"].eqNullSafe(F.col("verified_sha256")) & kept["local_path"].eqNullSafe(F.col("local_path"))
    stands = (F.col("verification") == "VERIFIED") & same & F.col("u_status").isin(*PHYSICAL)
    verification = F.when(hit, F.when(F.coalesce(stands, F.lit(False)), "VERIFIED").otherwise("UNVERIFIED")).otherwise(F.col("verification"))
    return both.select(
        *KEYS, *(v.alias(c) for c, v in kept.items()), F.coalesce("u_status", "status").alias("status"), verification.alias("verification"),
        F.when(~hit | (verification == "VERIFIED"), F.col("verified_sha256")).alias("verified_sha256"), F.when(hit, F.col("u_error")).otherwise(F.col("error")).alias("error"),
        F.coalesce("first_seen_at", F.lit(now)).alias("first_seen_at"), F.when(hit, F.lit(now)).otherwise(F.col("last_checked_at")).alias("last_checked_at"),
    )


def file_facts(spark: SparkSession, path: str) -> DataFrame:
    """(local_path, actual_size, actual_sha256) of the files below ``path``."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        F.regexp_replace("path", "^file:/*", "/").alias("local_path"), F.col("length").alias("actual_size"), F.sha2("content", 256).alias("actual_sha256")
    )


def verify(ledger: DataFrame, facts: DataFrame, now: str) -> DataFrame:
    """The ledger after comparing sizes and digests; a mended artifact counts as fetched."""
    both = ledger.join(facts, "local_path", "left")
    skip = F.col("status").isin(*SETTLED)
    wrong_size = F.col("size_bytes").isNotNull() & (F.col("size_bytes") != F.col("actual_size"))
    wrong_hash = present(F.col("sha256")) & (F.lower("sha256") != F.col("actual_sha256"))
    outcome = F.when(skip, "SKIPPED").when(F.col("actual_size").isNull(), "LOCAL_MISSING").when(wrong_size | wrong_hash, "CORRUPTED").otherwise("VERIFIED")
    out = both.withColumn("_o", outcome)
    o, ok = F.col("_o"), F.col("_o") == "VERIFIED"
    error = F.when(o == "LOCAL_MISSING", "local artifact is missing").when((o == "CORRUPTED") & wrong_size, "size mismatch").when(o == "CORRUPTED", "sha256 mismatch").when(o == "SKIPPED", F.col("error"))
    status = F.when(o.isin("LOCAL_MISSING", "CORRUPTED"), o).when(ok & F.col("status").isin(*REPAIRABLE), "FETCHED").otherwise(F.col("status"))
    return out.select(
        *KEYS, "url", "signature", F.when(ok, F.col("actual_sha256")).otherwise(F.col("sha256")).alias("sha256"), F.when(ok, F.col("actual_size")).otherwise(F.col("size_bytes")).alias("size_bytes"), "local_path",
        status.alias("status"), F.when(ok, "VERIFIED").when(skip, F.col("verification")).otherwise("FAILED").alias("verification"), F.when(ok, F.col("actual_sha256")).when(skip, F.col("verified_sha256")).alias("verified_sha256"),
        error.alias("error"), "first_seen_at", F.when(skip, F.col("last_checked_at")).otherwise(F.lit(now)).alias("last_checked_at"),
    )


def repair_plan(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("status").isin(*REPAIRABLE)).orderBy(*KEYS)


#: What a mark sets; columns that it does not name stay (fixed values).
MARKS = {
    "downloaded": {"last_result": "DOWNLOADED", "downloaded": True, "removed": False, "error": None},
    "unchanged": {"last_result": "UNCHANGED", "downloaded": True, "removed": False, "error": None},
    "error": {"last_result": "ERROR"},
    "ghost": {"last_result": "UPSTREAM_GHOST", "downloaded": False, "removed": False},
    "removed": {"last_result": "REMOVED_UPSTREAM", "removed": True},
}


#: Rows that a task of ``mark`` gets, of both tables together.
EACH = 500_000


def mark(state: DataFrame, marks: DataFrame, now: str) -> DataFrame:
    """Upstream state after (source_id, artifact_id, mark, signature, error): one mark an artifact.

    ``state`` has last_result, downloaded, removed, error, signature, last_checked, last_downloaded. A
    ghost keeps the signature it was seen with, so that only a new one brings it back.

    Rows are counted first and dealt in parts of some ``EACH``: their columns repeat few values, so by the bytes that they
    are shuffled in they would be put together into parts far larger in memory.
    """
    new = marks.select(*KEYS, "mark", F.col("signature").alias("_sig"), F.col("error").alias("_err"))
    parts = max(state.sparkSession.sparkContext.defaultParallelism, -(-(state.count() + marks.count()) // EACH))
    both = state.repartition(parts, *KEYS).join(new.repartition(parts, *KEYS), KEYS, "full_outer")

    def value(column: str) -> Column:
        out = F.col(column)
        for name, sets in MARKS.items():
            if column in sets:
                out = F.when(F.col("mark") == name, F.lit(sets[column])).otherwise(out)
        return out

    hit = F.col("mark").isNotNull()
    return both.select(
        *KEYS, value("last_result").alias("last_result"), value("downloaded").alias("downloaded"), value("removed").alias("removed"),
        F.when(F.col("mark").isin("error", "ghost"), F.col("_err")).otherwise(value("error")).alias("error"),
        F.when(hit & (F.col("mark") != "error"), F.coalesce("_sig", "signature")).otherwise(F.col("signature")).alias("signature"),
        F.when(hit, F.lit(now)).otherwise(F.col("last_checked")).alias("last_checked"), F.when(F.col("mark") == "downloaded", F.lit(now)).otherwise(F.col("last_downloaded")).alias("last_downloaded"),
    )


def finish_runs(observed: DataFrame) -> DataFrame:
    """(run_id, artifacts, bytes) of observed artifacts."""
    return observed.groupBy("run_id").agg(F.count_distinct(*KEYS).alias("artifacts"), F.sum(F.coalesce("size_bytes", F.lit(0))).alias("bytes"))


def pending(stats: str = "stats") -> Column:
    """Whether a run left work behind."""
    parts = [F.coalesce(F.col(f"{stats}.{c}"), F.lit(0)) for c in ("failed", "backlog_count", "deferred_budget", "skipped_oversize")]
    return F.greatest(*parts) > 0


def mark_partial(results: DataFrame) -> DataFrame:
    """(source_id, status, stats): a success that left work behind counts as partial."""
    return results.withColumn("status", F.when((F.col("status") == "success") & pending(), "partial").otherwise(F.col("status")))


def retry_due(sources: DataFrame, now: Column, attempted: DataFrame) -> DataFrame:
    """Sources with work left whose last attempt is retry_hours (6 by default, 1 at least) ago, not attempted in this cycle."""
    hours = F.greatest(F.lit(1), F.coalesce("retry_hours", F.lit(6)))
    due = F.col("last_attempt").isNull() | (now >= F.col("last_attempt") + F.make_dt_interval(hours=hours))
    return sources.filter(pending() & due).join(attempted.select("source_id"), "source_id", "left_anti").select("source_id").orderBy("source_id")


def prepare_migration(targets: DataFrame, state: DataFrame) -> DataFrame:
    """Targets whose root changed: the old generation stays live and the new one is pending."""
    s = state.select("registry", "name", F.col("target_url").alias("live_url"), F.col("generation"))
    both = targets.join(s, ["registry", "name"])
    return both.filter("target_url <> live_url").select("registry", "name", "live_url", F.col("target_url").alias("next_url"), (F.col("generation") + 1).alias("next_generation"))


def finish_migration(state: DataFrame, migrations: DataFrame, succeeded: DataFrame) -> DataFrame:
    """The state in which migrations that succeeded have become live; others keep the old generation."""
    done = migrations.join(succeeded.select("registry", "name"), ["registry", "name"], "left_semi").select("registry", "name", "next_url", "next_generation")
    both = state.join(done, ["registry", "name"], "left")
    return both.select("registry", "name", F.coalesce("next_url", "target_url").alias("target_url"), F.coalesce("next_generation", "generation").alias("generation"))


#: Columns that each schema version added, with their defaults (fixed values).
VERSIONS = {2: {"verification": "UNVERIFIED", "verified_sha256": None}, 3: {"fetch_method": None, "last_run_id": None}}


def migrated(ledger: DataFrame, version: int) -> DataFrame:
    """A ledger of an older schema version with what later ones added."""
    out = ledger
    for v, columns in VERSIONS.items():
        if v > version:
            out = out.withColumns({c: F.lit(d).cast("string") for c, d in columns.items() if c not in out.columns})
    return out
