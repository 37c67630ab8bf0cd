"""Command line: list and run the catalogue's queries, build corpora, search and query tables.

``python -m weirlake.cli run corpus_build /data/lake``
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from weirlake.api import REPORTS
from weirlake.operators import audit, corpus, ledger, sinks
from weirlake.plans import catalogue, decisions, roundtrips, tables  # noqa: F401
from weirlake.plans.control import Controls
from weirlake.plans.query import run_sql, search_documents
from weirlake.sources import files, registry


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="weirlake")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("queries", help="names of the catalogue's queries")
    q = sub.add_parser("run", help="run a query of the catalogue")
    q.add_argument("name", choices=sorted(catalogue.QUERIES))
    q.add_argument("lake")
    q.add_argument("--rows", type=int, default=20)
    q = sub.add_parser("explain", help="physical plan of a query")
    q.add_argument("name", choices=sorted(catalogue.QUERIES))
    q.add_argument("lake")
    q = sub.add_parser("sql", help="read-only SQL over the lake's tables")
    q.add_argument("statement")
    q.add_argument("lake")
    q.add_argument("--rows", type=int, default=1000)
    q = sub.add_parser("search", help="search documents")
    q.add_argument("words")
    q.add_argument("lake")
    q.add_argument("--rows", type=int, default=20)
    q = sub.add_parser("corpus", help="build a corpus version")
    q.add_argument("lake")
    q.add_argument("out")
    q.add_argument("version")
    q.add_argument("--shard-size", type=int, default=100_000)
    q = sub.add_parser("ingest", help="read a file of any known format into a table")
    q.add_argument("path")
    q.add_argument("format", choices=sorted(files.READERS))
    q.add_argument("source_id")
    q.add_argument("out")
    q = sub.add_parser("registry", help="validate source registries")
    q.add_argument("paths", nargs="+")
    q.add_argument("--prefix", default="")
    q = sub.add_parser("report", help="one of the lake's reports, of one source if given")
    q.add_argument("name", choices=sorted(x[1:] for x in REPORTS))
    q.add_argument("lake")
    q.add_argument("--source")
    q.add_argument("--rows", type=int, default=1000)
    q = sub.add_parser("write-report", help="write a report's rows and its page")
    q.add_argument("name", choices=sorted(x[1:] for x in REPORTS))
    q.add_argument("lake")
    q.add_argument("out")
    q = sub.add_parser("languages", help="documentation languages and their sources")
    q.add_argument("lake")
    q = sub.add_parser("updates", help="show or change how updates run")
    q.add_argument("settings")
    q.add_argument("change", nargs="?", choices=("status", "enable", "disable", "interval"), default="status")
    q.add_argument("seconds", nargs="?", type=int)
    q = sub.add_parser("source", help="show or change a source's settings")
    q.add_argument("settings")
    q.add_argument("source_id")
    q.add_argument("change", nargs="?", choices=("status", "enable", "disable", "auto", "manual", "refresh"), default="status")
    q.add_argument("hours", nargs="?", type=int)
    q = sub.add_parser("verify", help="verify a ledger's artifacts against the files below a folder")
    q.add_argument("ledger")
    q.add_argument("files")
    q.add_argument("out")
    q.add_argument("--now", required=True)
    q = sub.add_parser("inventory", help="files, bytes and rows of a Parquet folder")
    q.add_argument("path")
    q = sub.add_parser("repair-plan", help="artifacts of a ledger that need repair")
    q.add_argument("ledger")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    if a.command == "queries":
        print("\n".join(sorted(catalogue.QUERIES)))
        return 0
    if a.command in ("updates", "source"):
        controls, source = Controls(a.settings), getattr(a, "source_id", None)
        values = {"enable": {"enabled" if source else "automatic_enabled": True}, "disable": {"enabled" if source else "automatic_enabled": False}, "auto": {"auto_sync": True}, "manual": {"auto_sync": False}}.get(a.change)
        if a.change == "interval":
            values = {"interval_seconds": a.seconds}
        elif a.change == "refresh":
            values = {"refresh_hours": a.hours}
        if values and None in values.values():
            return 2
        print(json.dumps(controls.update(values, source) if values else controls.settings(source), sort_keys=True))
        return 0
    spark = spark or SparkSession.builder.appName("weirlake").getOrCreate()
    show = lambda df: print("\n".join(r["j"] for r in df.select(F.to_json(F.struct("*")).alias("j")).collect()))
    if a.command == "run":
        show(catalogue.QUERIES[a.name](spark, a.lake).limit(a.rows))
    elif a.command == "explain":
        catalogue.QUERIES[a.name](spark, a.lake).explain("formatted")
    elif a.command == "sql":
        names = {t: tables.table(spark, a.lake, t) for t in tables.BASE}
        show(run_sql(spark, a.statement, names, a.rows))
    elif a.command == "search":
        show(search_documents([tables.table(spark, a.lake, "documents")], a.words, max_rows=a.rows))
    elif a.command == "corpus":
        print(json.dumps(corpus.write_corpus(tables.table(spark, a.lake, "documents"), a.out, a.version, "doc_id", shard_size=a.shard_size), sort_keys=True))
    elif a.command == "ingest":
        files.read_any(spark, a.path, a.format, a.source_id).write.mode("errorifexists").parquet(a.out)
    elif a.command == "registry":
        problems = registry.validate_registry(registry.read_registries(spark, a.paths), a.prefix)
        show(problems)
        return int(not problems.isEmpty())
    elif a.command == "report":
        rows = catalogue.QUERIES[REPORTS[f"/{a.name}"]](spark, a.lake)
        show((rows if a.source is None else rows.filter(F.col("source_id").cast("string") == a.source)).limit(a.rows))
    elif a.command == "write-report":
        sinks.write_report(a.out, {a.name: catalogue.QUERIES[REPORTS[f"/{a.name}"]](spark, a.lake)}, a.name, {})
    elif a.command == "languages":
        show(catalogue.QUERIES[REPORTS["/programming-docs"]](spark, a.lake).select("language", "sources"))
    elif a.command == "verify":
        ledger.verify(spark.read.parquet(a.ledger), ledger.file_facts(spark, a.files), a.now).write.mode("errorifexists").parquet(a.out)
    elif a.command == "inventory":
        show(audit.inventory(spark, a.path))
    elif a.command == "repair-plan":
        show(ledger.repair_plan(spark.read.parquet(a.ledger)))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
