"""Dropping, ranking and reading without one large task."""

import random
import re

import pytest
from pyspark.sql import functions as F

from weirlake.operators import corpus, staging
from weirlake.sources import files


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_without_is_null_safe_and_keeps_clashing_columns(spark):
    rows = [(1, "a", 5, 6), (None, "a", 5, 6), (None, None, 5, 6), (2, "b", 5, 6), (2, "b", 5, 6), (3, None, 5, 6)]
    df = spark.createDataFrame(rows, "id int, k string, _mark int, _w int")
    gone = spark.createDataFrame([(None, "a"), (3, None), (2, "b"), (9, "z"), (2, "b")], "x int, y string")
    left = staging.without(df, gone, F.col("id"), F.col("k"))
    assert left.columns == df.columns and sorted(map(str, (tuple(r) for r in left.collect()))) == sorted(map(str, (rows[0], rows[2])))
    assert staging.without(df, gone.limit(0), F.col("id"), F.col("k")).count() == len(rows)


def test_only_rows_that_may_go_move(spark):
    df = spark.range(20_000).select("id", F.repeat(F.lit("text"), 10).alias("body"))
    marked = staging.may_be_among(df, F.col("id"), spark.range(100), "maybe")
    assert marked.filter("maybe and id < 100").count() == 100 and marked.filter("maybe").count() < 400
    assert "BroadcastHashJoin" in plan_of(marked) and "SortMergeJoin" not in plan_of(marked)


def test_ranked_equals_sorting(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("abc"), rnd.randrange(10**6), i) for i in range(5000)]
    df = spark.createDataFrame(rows, "a string, b int, _file int").repartition(7)
    got = sorted((r["rank"], r.a, r.b) for r in staging.ranked(df, ["a", "b"]).collect())
    assert [g[0] for g in got] == list(range(len(rows))) and [g[1:] for g in got] == sorted((a, b) for a, b, _ in rows)
    assert "Window" not in plan_of(staging.ranked(df, ["a"])).split("Scan parquet")[0] or "SinglePartition" not in plan_of(staging.ranked(df, ["a"])).split("row_index")[0]
    assert staging.ranked(df.limit(0), ["a"]).count() == 0


def test_first_copies_move_no_texts(spark):
    """Exchanges of the drop hold keys and places; texts only meet the rows that may be later copies."""
    rows = spark.createDataFrame([(i, f"text {i % 700}") for i in range(1000)], "doc_id long, cleaned string").withColumn("fingerprint", F.sha2("cleaned", 256))
    got = corpus.first_copies(rows, "doc_id")
    assert sorted(r.doc_id for r in got.collect()) == list(range(700))


def test_head_reads_no_more_than_asked(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "_SUCCESS").write_bytes(b"")
    (tmp_path / "d" / "a.csv").write_bytes(b"x;y\n" + b"1;2\n" * 100_000)
    assert staging.head_bytes(spark, str(tmp_path / "d"), 8) == b"x;y\n1;2\n" and staging.head_bytes(spark, str(tmp_path / "none"), 8) == b""
    assert files.read_csv(spark, str(tmp_path / "d")).count() == 100_000


def test_a_cluster_needs_its_shared_folder(spark):
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.shared_dir(Session(), "x")
    assert re.match(r".+/x-[0-9a-f]{32}$", staging.shared_dir(spark, "x"))


def test_corpus_manifest_says_what_the_shards_hold(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"{i % 40} " + "some words that differ enough to be kept in here and make a text of eighty characters or more " * 2) for i in range(60)], "doc_id long, text string")
    one = corpus.write_corpus(rows, str(tmp_path), "a", "doc_id", shard_size=7)
    two = corpus.write_corpus(rows.repartition(5), str(tmp_path), "b", "doc_id", shard_size=30)
    other = corpus.write_corpus(rows.filter("doc_id <> 3"), str(tmp_path), "c", "doc_id")
    assert one["records_sha256"] == two["records_sha256"] != other["records_sha256"] and one["stats"] == two["stats"]
    assert spark.read.json(f"{tmp_path}/a/shards").count() == one["stats"]["documents_written"] == 40


def test_small_inputs_of_few_files_are_spread(spark, tmp_path):
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "one"))
    spark.range(1000).repartition(9).write.parquet(str(tmp_path / "many"))
    one, many = (spark.read.parquet(str(tmp_path / n)) for n in ("one", "many"))
    cores = spark.sparkContext.defaultParallelism
    dealt = staging.spread(one)
    assert dealt.count() == 1000 and dealt.select(F.spark_partition_id()).distinct().count() == cores
    assert "Exchange" not in plan_of(staging.spread(many)) and "Exchange" not in plan_of(staging.spread(spark.range(5)))
