"""Read-only SQL over a source's tables, and document search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirlake.functions.text import search_terms

MOST_ROWS = 5_000
MOST_HITS = 100


def check_read_only(spark: SparkSession, sql: str) -> None:
    """Raise unless the parsed statement only reads, common table expressions and subqueries included."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    forbidden = [
        spark._jvm.java.lang.Class.forName(f"org.apache.spark.sql.catalyst.plans.logical.{n}") for n in ("Command", "ParsedStatement")
    ]

    def walk(node) -> None:
        name = node.getClass().getSimpleName()
        if any(c.isInstance(node) for c in forbidden):
            raise PermissionError(f"only queries may run, not {name}")
        for group in (node.children(), node.innerChildren()):
            for i in range(group.size()):
                walk(group.apply(i))

    walk(plan)


def run_sql(spark: SparkSession, sql: str, tables: dict[str, DataFrame], max_rows: int = 1_000) -> DataFrame:
    """The statement's first rows over ``tables``; the limit is part of the plan."""
    check_read_only(spark, sql)
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql).limit(max(1, min(max_rows, MOST_ROWS)))


def search_documents(tables: list[DataFrame], query: str, text: str = "text", order: str = "doc_id", max_rows: int = 20) -> DataFrame:
    """Rows in which any search term occurs, caselessly and literally; sources in order, then by ``order``."""
    terms = search_terms(query)
    out = None
    for i, df in enumerate(tables):
        low = F.lower(F.col(text))
        hit = F.lit(False)
        for t in terms:
            hit = hit | low.contains(t)
        own = df.filter(hit).withColumn("_ordinal", F.lit(i))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out.orderBy("_ordinal", order).limit(max(1, min(max_rows, MOST_HITS))).drop("_ordinal")
