"""Resumable change feeds: ordered batches folded into versioned snapshots, with their cursor.

Each micro-batch writes the next version of the queue and its cursor in one folder and then moves a
pointer. A replay of a batch writes the same folder again, so a crash before the pointer moves leaves
nothing behind and one after it changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirlake.operators.changes import fold_events

STATE = "registry string, name string, source string, priority int, status string, first_seen_at string, last_seen_at string"
EVENT = "registry string, name string, deleted boolean, ord bigint, source string"


class ChangeFeed:
    """The queue below ``path``: versions ``v=N`` with a cursor each, and a pointer to the last committed one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _pointer(self) -> int:
        try:
            row = self.spark.read.schema("version int").json(f"{self.path}/pointer").agg(F.max("version").alias("v")).first()
        except Exception as error:  # the pointer does not exist before the first commit
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return -1
        return -1 if row.v is None else row.v

    def version(self) -> int:
        """The last committed version, -1 before the first."""
        return self._pointer()

    def queue(self) -> DataFrame:
        v = self._pointer()
        return self.spark.createDataFrame([], STATE) if v < 0 else self.spark.read.schema(STATE).parquet(f"{self.path}/v={v}/queue")

    def cursor(self) -> int | None:
        """The greatest order number that the committed queue has seen."""
        v = self._pointer()
        return None if v < 0 else self.spark.read.schema("cursor bigint").json(f"{self.path}/v={v}/cursor").first()["cursor"]

    def apply(self, events: DataFrame, batch_id: int, now: str) -> None:
        """Fold a batch; events at or before the cursor have been applied and are left out."""
        if batch_id <= self._pointer():
            return
        seen = self.cursor()
        fresh = events if seen is None else events.filter(F.col("ord") > seen)
        out = f"{self.path}/v={batch_id}"
        fold_events(self.queue(), fresh, now).write.mode("overwrite").parquet(f"{out}/queue")
        top = fresh.agg(F.max("ord").alias("m")).first()["m"]
        at = seen if top is None else top
        self.spark.createDataFrame([(at,)], "cursor bigint").coalesce(1).write.mode("overwrite").json(f"{out}/cursor")
        self.spark.createDataFrame([(batch_id,)], "version int").coalesce(1).write.mode("append").json(f"{self.path}/pointer")

    def follow(self, landing: str, now: str, files_per_batch: int = 1) -> None:
        """Apply all event files that have landed since the last call, in micro-batches."""
        (
            self.spark.readStream.schema(EVENT).option("maxFilesPerTrigger", files_per_batch).json(landing)
            .writeStream.foreachBatch(lambda df, i: self.apply(df, i, now))
            .option("checkpointLocation", f"{self.path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
        )


def require_bootstrap(cursor: int | None, bootstrapped: bool) -> None:
    """Following from the head needs a finished bootstrap, else what lies before it is never seen."""
    if cursor is None and not bootstrapped:
        raise RuntimeError("bootstrap first")


def windowed_counts(events: DataFrame, window: str = "1 day", late: str = "2 days") -> DataFrame:
    """Counts of event types in time windows, as a stream or at rest; on a stream, rows later than ``late`` are left out."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events
    grouped = timed.groupBy(F.window("ts", window), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return grouped.select(F.col("window.start").alias("window_start"), "event_type", "n", "total")
