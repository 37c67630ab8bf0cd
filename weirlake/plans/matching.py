"""Keyword topics from a taxonomy table, and tree differences by directories, over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirlake.operators import taxonomy, trees
from weirlake.operators.staging import spread
from weirlake.plans import tables as t
from weirlake.plans.registered import query

# The words of four letters or more of the benchmark's items, dealt to eleven topics, are the taxonomy.
TAXONOMY_SQL = """
kw AS (SELECT DISTINCT 'topic' || (item_id % 11) AS topic, w AS keyword FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS w FROM benchmark)),
n AS (SELECT doc_id, trim(regexp_replace(lower(coalesce(text, '')), '\\s+', ' ', 'g')) AS n FROM documents),
s AS (SELECT doc_id, topic, sum((length(n) - length(replace(n, keyword, ''))) // length(keyword))::BIGINT AS score FROM n, kw WHERE contains(n, keyword) GROUP BY doc_id, topic)
"""


def _taxonomy(spark, sf_dir):
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0)))
    return t.table(spark, sf_dir, "benchmark").select(F.concat(F.lit("topic"), (F.col("item_id") % 11).cast("string")).alias("topic"), words.alias("keyword"))


def _docs(spark, sf_dir):
    return spread(t.table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("taxonomy_scores", f"WITH {TAXONOMY_SQL} SELECT doc_id, topic, score FROM s")
def taxonomy_scores(spark, sf_dir):
    """Every document's score for every topic it has."""
    scores = taxonomy.topic_scores(_docs(spark, sf_dir), "doc_id", F.col("text"), _taxonomy(spark, sf_dir))
    return scores.select("doc_id", F.inline("scores")).select("doc_id", F.col("name").alias("topic"), "score")


@query("taxonomy_domains", f"""WITH {TAXONOMY_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, topic) AS k FROM s)
    SELECT d.doc_id, coalesce(max(topic) FILTER (k = 1), 'multidomain') AS primary_domain, coalesce(string_agg(topic, ',' ORDER BY k) FILTER (k BETWEEN 2 AND 4), '') AS secondary,
    CASE WHEN max(score) IS NULL THEN 0.5 ELSE least(0.98, 0.65 + least(max(score) FILTER (k = 1), 6) * 0.05) END::DOUBLE AS confidence FROM documents d LEFT JOIN r USING (doc_id) GROUP BY d.doc_id""")
def taxonomy_domains(spark, sf_dir):
    found = taxonomy.domains_by_table(_docs(spark, sf_dir), "doc_id", F.col("text"), _taxonomy(spark, sf_dir))
    return found.select("doc_id", F.col("primary").alias("primary_domain"), F.array_join("secondary", ",").alias("secondary"), "confidence")


# Two states of a tree with a folder a priority and a few customers; the later one lacks some files, has new ones, and changes some.
TREES_SQL = """
f AS (SELECT o_orderkey AS k, 'docs/' || o_orderpriority || '/' || (o_custkey % 40) || '/' || o_orderkey || '.md' AS path, md5(floor(o_totalprice)::BIGINT::VARCHAR) AS sha FROM orders),
a AS (SELECT path, sha FROM f WHERE k % 50 <> 3),
b AS (SELECT path, CASE WHEN k % 70 = 1 THEN 'new' ELSE sha END AS sha FROM f WHERE k % 60 <> 7),
d AS (SELECT path, CASE WHEN a.path IS NULL THEN 'ADDED' WHEN b.path IS NULL THEN 'REMOVED' ELSE 'CHANGED' END AS change FROM a FULL JOIN b USING (path) WHERE a.sha IS DISTINCT FROM b.sha)
"""


def _trees(spark, sf_dir):
    o = t.table(spark, sf_dir, "orders")
    path = F.concat(F.lit("docs/"), "o_orderpriority", F.lit("/"), (F.col("o_custkey") % 40).cast("string"), F.lit("/"), F.col("o_orderkey").cast("string"), F.lit(".md"))
    f = o.select(F.col("o_orderkey").alias("k"), path.alias("path"), F.md5(F.floor("o_totalprice").cast("long").cast("string").cast("binary")).alias("sha"))
    old = f.filter("k % 50 <> 3").select("path", "sha")
    new = f.filter("k % 60 <> 7").select("path", F.when(F.col("k") % 70 == 1, "new").otherwise(F.col("sha")).alias("sha"))
    return trees.write_tree(old), trees.write_tree(new)


@query("tree_walk", f"WITH {TREES_SQL} SELECT path, change FROM d")
def tree_walk(spark, sf_dir):
    return trees.walk(*_trees(spark, sf_dir))[0]


@query("tree_walk_scope", f"WITH {TREES_SQL} SELECT path, change FROM d WHERE path LIKE 'docs/1-URGENT/%' AND change <> 'REMOVED'")
def tree_walk_scope(spark, sf_dir):
    """One folder of the tree, where the later state may be incomplete."""
    return trees.walk(*_trees(spark, sf_dir), ("docs/1-URGENT/",), complete=False)[0]
