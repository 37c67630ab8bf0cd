import json
import threading
import urllib.request

import pytest
from conftest import SF
from pyspark.sql import functions as F

from weirlake.api import REPORTS, Api, serve
from weirlake.functions.markup import pdf_text
from weirlake.plans import catalogue
from weirlake.sources import adapters


def test_routes(spark, tmp_path):
    api = Api(spark, SF, str(tmp_path / "s.json"))
    assert set(REPORTS.values()) <= set(catalogue.QUERIES)
    assert api.handle("GET", "/health")[1]["status"] == "ok"
    assert api.handle("GET", "/coverage")[0] == 200 and len(api.handle("GET", "/sources?limit=3")[1]) == 3
    assert api.handle("GET", "/queries/country_scope")[0] == 200 and api.handle("GET", "/queries/none")[0] == 404 and api.handle("GET", "/nowhere")[0] == 404
    assert api.handle("POST", "/query", {"sql": "SELECT count(*) AS n FROM nation"}) == (200, [{"n": 25}])
    assert api.handle("POST", "/query", {"sql": "DROP TABLE nation"})[0] == 403 and api.handle("POST", "/query", {"sql": "SELEC"})[0] == 400
    assert api.handle("GET", "/search/documents?q=token&limit=1")[0] == 200
    assert api.handle("PUT", "/settings/s", {"interval_seconds": 400})[1]["interval_seconds"] == 400 and api.handle("GET", "/settings")[1]["interval_seconds"] == 3600


def test_more_routes(spark, tmp_path):
    api = Api(spark, SF, str(tmp_path / "s.json"), str(tmp_path / "reports"))
    one = api.handle("GET", "/upstreams?limit=1")[1][0]["source_id"]
    assert {r["source_id"] for r in api.handle("GET", f"/upstreams/{one}")[1]} == {one}
    assert api.handle("PUT", "/sources/s-1/settings", {"auto_sync": True})[1]["auto_sync"] and api.handle("GET", "/sources/s-1/path")[1]["path"].endswith("/s-1")
    assert api.handle("GET", "/settings/updates")[1]["interval_seconds"] == 3600
    assert api.handle("POST", "/query/source/nation", {"sql": "SELECT count(*) AS n FROM nation"}) == (200, [{"n": 25}]) and api.handle("POST", "/query/source/none", {})[0] == 404
    assert api.handle("POST", "/coverage/report")[0] == 200 and (tmp_path / "reports" / "coverage.json").exists() and Api(spark, SF, "x").handle("POST", "/coverage/report")[0] == 409
    assert api.handle("GET", "/programming-docs/languages")[0] == 200


def test_command_line(spark, tmp_path, capsys):
    from weirlake import cli

    settings = str(tmp_path / "s.json")
    assert cli.main(["updates", settings, "interval", "900"]) == 0 and json.loads(capsys.readouterr().out)["interval_seconds"] == 900
    assert cli.main(["source", settings, "a", "disable"]) == 0 and json.loads(capsys.readouterr().out)["enabled"] is False and cli.main(["source", settings, "a", "refresh"]) == 2
    assert cli.main(["report", "coverage", SF], spark) == 0 and capsys.readouterr().out
    assert cli.main(["inventory", f"{SF}/nation.parquet"], spark) == 0 and json.loads(capsys.readouterr().out)["rows"] == 25
    assert cli.main(["languages", SF], spark) == 0


def test_server(spark, tmp_path):
    server = serve(Api(spark, SF, str(tmp_path / "s.json")), port=0)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    with urllib.request.urlopen(f"http://127.0.0.1:{server.server_address[1]}/health") as r:
        assert json.load(r)["status"] == "ok"
    server.shutdown()


def test_maven_records(spark):
    meta = "<metadata><versioning><latest>2.0-SNAPSHOT</latest><release>2.0-rc1</release><versions><version>1.0</version><version>1.1</version><version>2.0-rc1</version></versions></versioning></metadata>"
    pom = "<project xmlns='m'><parent><url>https://p</url></parent><url>https://search.maven.org/x</url><scm><connection>scm:git:git@github.com:a/b.git</connection></scm></project>"
    rows = spark.createDataFrame([("g:a", meta, pom), ("g:b", None, None)], "asked string, metadata string, pom string")
    got = {r["name"]: (r.latest_stable_version, r.canonical_repository, r.official_website) for r in adapters.maven(rows).collect()}
    assert got == {"g:a": ("1.1", "https://github.com/a/b", None), "g:b": (None, None, None)}


def test_pdf_needs_its_library(spark):
    try:
        import pypdf  # noqa: F401
    except ImportError:
        with pytest.raises(ImportError):
            pdf_text()
    else:
        assert spark.createDataFrame([(b"x",)], "b binary").select(pdf_text()(F.col("b"))).first()[0] is None
