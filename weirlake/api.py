"""A small HTTP façade over the catalogue, search, SQL and settings, on the standard library.

``Api.handle`` does the work and can be called without a server. ``lake`` is a folder of Parquet tables.
"""

from __future__ import annotations

import json
import re
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qsl, urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirlake.operators.sinks import write_report
from weirlake.plans import catalogue, decisions, roundtrips, tables  # noqa: F401
from weirlake.plans.control import Controls
from weirlake.plans.query import MOST_HITS, MOST_ROWS, run_sql, search_documents

#: Reports by their path, and the query that gives each.
REPORTS = {
    "/sources": "source_rank", "/coverage": "coverage_score", "/coverage-audit": "coverage_items", "/quality-audit": "quality_issues", "/upstreams": "upstream_audit_full", "/artifacts": "ledger_audit", "/discoveries": "unmapped_datasets",
    "/certification": "certification", "/docs": "docs_audit", "/qualification": "qualification_window", "/audit": "audit_counts", "/inventory": "catalogue_lists", "/portal": "portal_coverage", "/catalogue": "catalogue_audit_full", "/backlog": "backlog_full",
    "/status": "freshness", "/ci-gold": "certification", "/programming-docs": "docs_audit", "/runs": "run_close_out", "/queue": "stage_counts", "/technologies": "registry_stats", "/registry": "registry_audit",
}
#: Reports whose rows belong to a source each: ``/report/id`` gives one source's.
OF_A_SOURCE = ("/upstreams", "/artifacts", "/sources", "/registry")


class Api:
    def __init__(self, spark: SparkSession, lake: str, settings_path: str, reports: str | None = None):
        self.spark, self.lake, self.controls, self.reports = spark, lake, Controls(settings_path), reports

    def _report(self, path: str) -> DataFrame:
        return catalogue.QUERIES[REPORTS[path]](self.spark, self.lake)

    def _rows(self, df: DataFrame, limit: int) -> list[dict]:
        return [json.loads(r["j"]) for r in df.limit(limit).select(F.to_json(F.struct("*")).alias("j")).collect()]

    def handle(self, method: str, target: str, body: dict | None = None) -> tuple[int, object]:
        """(status, JSON content) of a request."""
        url = urlsplit(target)
        asked = dict(parse_qsl(url.query))
        path = url.path.rstrip("/") or "/"
        try:
            limit = max(1, min(int(asked.get("limit", 100)), MOST_ROWS))
            if (method, path) == ("GET", "/health"):
                return 200, {"status": "ok", "queries": len(catalogue.QUERIES)}
            if method == "GET" and path in REPORTS:
                return 200, self._rows(self._report(path), limit)
            if method == "GET" and (m := re.fullmatch(r"(/[a-z]+)/([\w.-]+)", path)) and m[1] in OF_A_SOURCE:
                own = self._report(m[1])
                if "source_id" not in own.columns:
                    return 404, {"error": "the report has no sources"}
                return 200, self._rows(own.filter(F.col("source_id").cast("string") == m[2]), limit)
            if (method, path) == ("GET", "/programming-docs/languages"):
                return 200, self._rows(self._report("/programming-docs").select("language", "sources"), limit)
            if method == "POST" and (m := re.fullmatch(r"(/[a-z-]+)/report", path)) and m[1] in REPORTS:
                if not self.reports:
                    return 409, {"error": "no folder for reports"}
                name = m[1][1:]
                write_report(self.reports, {name: self._report(m[1]).limit(MOST_ROWS)}, name, {})
                return 200, {"written": name}
            if m := re.fullmatch(r"/sources/([\w.-]+)/settings", path):
                return 200, self.controls.update(body or {}, m[1]) if method == "PUT" else self.controls.settings(m[1])
            if method == "GET" and (m := re.fullmatch(r"/sources/([\w.-]+)/path", path)):
                return 200, {"source_id": m[1], "path": f"{self.lake}/{m[1]}"}
            if path == "/settings/updates":
                return 200, self.controls.update(body or {}) if method == "PUT" else self.controls.settings()
            if method == "POST" and (m := re.fullmatch(r"/query/source/([\w.-]+)", path)):
                if m[1] not in tables.BASE:
                    return 404, {"error": "unknown source"}
                return 200, self._rows(run_sql(self.spark, (body or {}).get("sql", ""), {m[1]: tables.table(self.spark, self.lake, m[1])}, limit), limit)
            if (method, path) == ("GET", "/queries"):
                return 200, sorted(catalogue.QUERIES)
            if method == "GET" and (m := re.fullmatch(r"/queries/(\w+)", path)):
                if m[1] not in catalogue.QUERIES:
                    return 404, {"error": "unknown query"}
                return 200, self._rows(catalogue.QUERIES[m[1]](self.spark, self.lake), limit)
            if (method, path) == ("GET", "/search/documents"):
                return 200, self._rows(search_documents([tables.table(self.spark, self.lake, "documents")], asked.get("q", ""), max_rows=min(limit, MOST_HITS)), MOST_HITS)
            if (method, path) == ("POST", "/query"):
                names = {t: tables.table(self.spark, self.lake, t) for t in tables.BASE}
                return 200, self._rows(run_sql(self.spark, (body or {}).get("sql", ""), names, limit), limit)
            if m := re.fullmatch(r"/settings(?:/([\w-]+))?", path):
                return 200, self.controls.update(body or {}, m[1]) if method == "PUT" else self.controls.settings(m[1])
            return 404, {"error": "no such route"}
        except PermissionError as error:
            return 403, {"error": str(error)}
        except Exception as error:
            return 400, {"error": str(error)[:500]}


def serve(api: Api, host: str = "127.0.0.1", port: int = 8080) -> ThreadingHTTPServer:
    """A server for ``api``; the caller runs and closes it."""

    class Handler(BaseHTTPRequestHandler):
        def _answer(self) -> None:
            size = int(self.headers.get("Content-Length") or 0)
            raw = self.rfile.read(size) if size else b""
            try:
                status, content = api.handle(self.command, self.path, json.loads(raw) if raw else None)
            except ValueError:
                status, content = 400, {"error": "the body is no JSON"}
            out = json.dumps(content, ensure_ascii=False).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json; charset=utf-8")
            self.send_header("Content-Length", str(len(out)))
            self.end_headers()
            self.wfile.write(out)

        do_GET = do_POST = do_PUT = _answer

        def log_message(self, *args) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)
