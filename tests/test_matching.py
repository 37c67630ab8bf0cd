"""Keyword topics from a table against counting by hand, and walks of trees against comparing all paths."""

import random

from conftest import SF
from pyspark.sql import functions as F

from weirlake.functions import text
from weirlake.operators import taxonomy, trees


def _counted(texts, words):
    out = {}
    for k, x in texts:
        low = " ".join((x or "").lower().split())
        scores = {}
        for topic, w in {(a, b) for a, b in words if a is not None and b}:
            scores[topic] = scores.get(topic, 0) + low.count(w)
        out[k] = sorted(((n, t) for t, n in scores.items() if n), key=lambda p: (-p[0], p[1]))
    return out


def test_topics_equal_counting(spark):
    """Short, long, nested, overlapping and non-Latin keywords; pieces' borders; nulls, empty texts, repeated keywords."""
    rnd = random.Random(3)
    words = [("a", "ana"), ("a", "anan"), ("a", "ana"), ("b", "n"), ("b", "na"), ("c", "é̀"), ("c", "日本語"), ("d", " an "), ("e", "banana" * 20), ("f", "😀b"), (None, "x"), ("g", None), ("g", ""), ("h", "aa"), ("i", "zzz")]
    texts = [(1, None), (2, ""), (3, "   "), (4, "Banana  an\tananas"), (5, "a" * 1001), (6, "banana" * 75), (7, "日本語" * 50 + "😀b" * 70), (8, "é̀ an é̀")]
    texts += [(9 + i, "".join(rnd.choice("an b日") for _ in range(rnd.randint(0, 700)))) for i in range(40)]
    df = spark.createDataFrame(texts, "doc_id long, body string").withColumn("scores", F.lit(1)).withColumn("topic", F.lit("x"))
    kw = spark.createDataFrame(words, "topic string, keyword string")
    want = _counted(texts, words)
    got = {r["doc_id"]: [(x["score"], x["name"]) for x in r["scores"]] for r in taxonomy.topic_scores(df, "doc_id", F.col("body"), kw).collect()}
    assert got == {k: v for k, v in want.items() if v}
    found = {r["doc_id"]: r for r in taxonomy.domains_by_table(df, "doc_id", F.col("body"), kw).collect()}
    assert len(found) == len(texts) and (found[1]["primary"], found[1]["confidence"]) == ("multidomain", 0.5)
    assert all(found[k]["primary"] == v[0][1] and found[k]["secondary"] == [t for _, t in v[1:4]] for k, v in want.items() if v)
    assert taxonomy.topic_scores(df, "doc_id", F.col("body"), kw.limit(0)).count() == 0
    assert taxonomy.domains_by_table(df.limit(0), "doc_id", F.col("body"), kw).count() == 0


def test_topics_equal_expressions(spark):
    """The table gives what the chain of expressions gives; a taxonomy too large to send is joined and gives the same."""
    topics = {"articles": (" the ", " der ", " la "), "verbs": ("tion", "ing"), "joints": (" und ", " et ", " of ", " de ")}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kw = spark.createDataFrame([(k, w) for k, ws in topics.items() for w in ws], "topic string, keyword string")
    rows = lambda df: sorted((r["doc_id"], r["primary"], tuple(r["secondary"]), round(r["confidence"], 9)) for r in df.collect())
    want = rows(docs.select("doc_id", text.infer_domains(F.lit("multidomain"), F.col("text"), topics).alias("d")).select("doc_id", "d.*"))
    assert rows(taxonomy.domains_by_table(docs, "doc_id", F.col("text"), kw)) == want
    before, taxonomy.MOST_SENT = taxonomy.MOST_SENT, 0
    try:
        assert rows(taxonomy.domains_by_table(docs, "doc_id", F.col("text"), kw)) == want
    finally:
        taxonomy.MOST_SENT = before


def _tree(spark, files):
    return trees.write_tree(spark.createDataFrame(sorted(files.items()), "path string, sha string"))


def test_walk_opens_what_differs(spark):
    old = {f"d{i}/e{j}/f{k}.md": f"{i}{j}{k}" for i in range(6) for j in range(6) for k in range(10)}
    old |= {"top.md": "1", "x/y": "file", "gone/a/b.md": None, "same": None}
    new = dict(old, **{"d3/e2/f7.md": "new", "d3/e2/new.md": "n", "top.md": "2", "x/y/z.md": "now a folder"})
    del new["x/y"], new["gone/a/b.md"]
    want = {("d3/e2/f7.md", "CHANGED"), ("d3/e2/new.md", "ADDED"), ("top.md", "CHANGED"), ("x/y", "REMOVED"), ("x/y/z.md", "ADDED"), ("gone/a/b.md", "REMOVED")}
    a, b = _tree(spark, old), _tree(spark, new)
    rows = lambda x: sorted(tuple(r) for r in x.collect())
    found, read = trees.walk(a, b)
    # Of 364 files: ten entries at the top, the changed folders' six and few, and the files of the folders that differ.
    assert rows(found) == sorted(want) and sum(read) < 35
    assert rows(trees.walk(a, b, complete=False)[0]) == sorted(w for w in want if w[1] != "REMOVED")
    found, read = trees.walk(a, b, ("d3/e2/", "x/"))
    assert rows(found) == sorted(w for w in want if w[0].startswith(("d3/e2/", "x/")))
    found, read = trees.walk(a, b, ("d1", "d2/e5"))
    assert found.count() == 0 and read == []


def test_walk_of_empty_trees(spark):
    none = trees.write_tree(spark.createDataFrame([(None, "1")], "path string, sha string"))
    some = _tree(spark, {"a/b": "1", "c": "2"})
    assert trees.walk(none, none)[0].count() == 0
    assert sorted(map(tuple, trees.walk(none, some)[0].collect())) == [("a/b", "ADDED"), ("c", "ADDED")]
    assert sorted(map(tuple, trees.walk(some, none)[0].collect())) == [("a/b", "REMOVED"), ("c", "REMOVED")]
