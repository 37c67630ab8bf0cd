import hashlib
import json
import time

import pytest
from pyspark.sql import functions as F

from weirlake import cli
from weirlake.operators import ledger, sinks
from weirlake.plans import control
from weirlake.sources import adapters, records, web
from weirlake.sources.feed_source import FeedSource


def variants(spark, **rows):
    return spark.createDataFrame([(k, json.dumps(v)) for k, v in rows.items()], "k string, j string").select("k", F.expr("parse_json(j)").alias("payload"))


def test_shapes_and_pages(spark):
    v = variants(spark, a=[{"id": "x"}, {"id": "y"}], b={"results": [{"id": "x"}]}, c={"other": 1}, d=5)
    assert {r.k: r.n for r in v.select("k", F.size(records.items("payload")).alias("n")).collect()} == {"a": 2, "b": 1, "c": 0, "d": 0}
    assert records.catalogue_pages(v, 2).count() == 2
    with pytest.raises(ValueError):
        records.catalogue_pages(v, 3)


def test_cursor_chain(spark):
    p = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", None)], "cursor string, next string")
    assert records.cursor_chain(p, "a") == ["a", "b", "c"]
    with pytest.raises(ValueError):
        records.cursor_chain(p.replace({"c": "a"}, subset=["next"]), "a")


def test_attachments(spark):
    v = variants(spark, a={"attachments": [{"name": "n", "url": "u"}, "m"]}, b={"attachments": {"items": [{"name": "n"}]}}, c={"attachments": {"k": {"url": "u"}, "l": "w"}}, d={})
    got = {r.k: r.x and [(a.name, a.url) for a in r.x] for r in v.select("k", records.attachments().alias("x")).collect()}
    assert got == {"a": [("n", "u"), ("m", None)], "b": [("n", None)], "c": [("k", "u"), ("l", "w")], "d": None}


def test_country_and_area(spark):
    r = spark.createDataFrame([("CIV_A", None, None), ("X_M", "civ", "M"), ("Y", "FRA", "A")], "id string, ref_area string, freq string")
    assert records.reference_area(r, "CIV").count() == 2 and records.reference_area(r, "CIV", ("A",)).count() == 1
    assert records.country_rows(r, ["ref_area", "id"], [" fra "]).count() == 1


def test_bulk_plan_and_batches(spark):
    c = spark.createDataFrame([("a", "3 KB", "1"), ("b", "9 KB", "1"), ("c", "2 KB", "2"), ("d", "1 KB", "1"), ("e", None, "1")], "code string, size string, signature string")
    old = spark.createDataFrame([("d", "1"), ("c", "1")], "code string, signature string")
    got = {r.item_id: r.decision for r in records.bulk_plan(c, old, 8 * 1024, 4 * 1024).collect()}
    assert got == {"a": "TAKEN", "b": "SKIPPED_OVERSIZE", "c": "DEFERRED_BUDGET", "e": "TAKEN"}
    assert [list(r["keys"]) for r in records.batches(c, "code", 2).orderBy("batch").collect()] == [["a", "b"], ["c", "d"], ["e"]]

    def fetch(keys):
        if "b" in keys:
            raise ValueError
        return keys

    assert records.bisected(list("abcd"), fetch) == ([["a"], ["c", "d"]], ["b"])


def test_signatures(spark):
    r = spark.createDataFrame([("g", 1, "x"), ("g", 2, None)], "g string, i int, v string")
    a, b = records.group_signature(r, "g", ["v", "i"], "i").first().signature, records.group_signature(r.orderBy(F.desc("i")), "g", ["i", "v"], "i").first().signature
    assert a == b != records.group_signature(r.fillna("z"), "g", ["v", "i"], "i").first().signature


def test_geo_and_extracts(spark, tmp_path):
    v = variants(spark, ADM0={"features": [{"id": "f", "properties": {"p": 1}, "geometry": None}, {"properties": {}}]}).withColumnRenamed("k", "level")
    assert [(r.feature_index, r.feature_id) for r in records.geo_features(v).orderBy("feature_index").collect()] == [(0, "f"), (1, "1")]
    levels = spark.createDataFrame([("A", "1"), ("B", "2")], "level string, signature string")
    assert records.rebuild_levels(levels, levels).count() == 0 and records.rebuild_levels(levels, levels.limit(1)).count() == 2
    (tmp_path / "x.pbf").write_bytes(b"abc")
    assert records.extract_snapshot(spark, str(tmp_path / "x.pbf"), hashlib.md5(b"abc").hexdigest()).first().size_bytes == 3
    with pytest.raises(ValueError):
        records.extract_snapshot(spark, str(tmp_path / "x.pbf"), "0" * 32)


def test_adapters(spark):
    docs = {
        "npmjs.org": {"name": "n", "dist-tags": {"latest": "2.0.0"}, "versions": {"2.0.0": {"repository": {"url": "git+https://github.com/a/n.git"}, "homepage": "https://n.io"}}},
        "pypi.org": {"info": {"name": "p", "version": "1.1", "project_urls": {"Source": "https://github.com/a/p", "Documentation": "https://p.io"}, "home_page": ""}},
        "packagist.org": {"package": {"name": "v/p", "repository": "https://github.com/v/p", "versions": {"1.0.0": {"homepage": "https://h"}, "dev-main": {}, "2.0.0-beta": {}}, "downloads": {"total": 7, "monthly": 2}, "favers": 3}},
        "crates.io": {"crate": {"id": "c", "max_stable_version": "0.3.0", "repository": "https://github.com/a/c", "downloads": 5}},
        "rubygems.org": {"name": "r", "version": "4.0", "source_code_uri": "https://github.com/a/r/"},
        "nuget.org": {"items": [{"items": [{"catalogEntry": {"id": "G", "version": "1.2.0"}}, {"catalogEntry": {"id": "G", "version": "1.10.0", "projectUrl": "https://g"}}, {"catalogEntry": {"id": "G", "version": "2.0.0-rc"}}, {"catalogEntry": {"id": "G", "version": "3.0.0", "listed": False}}]}]},
        "proxy.golang.org": {"path": "github.com/a/g/v2", "versions": ["v1.2.0", "v1.10.0", "v2.0.0-rc.1"]},
    }
    rows = variants(spark, **docs).select(F.col("k").alias("registry"), F.lit("asked").alias("asked"), "payload")
    got = {r.registry: (r.name, r.latest_stable_version, r.canonical_repository, r.downloads_total) for r in adapters.native_metadata(rows).collect()}
    assert got == {
        "npmjs.org": ("n", "2.0.0", "https://github.com/a/n", 0), "pypi.org": ("p", "1.1", "https://github.com/a/p", 0), "packagist.org": ("v/p", "1.0.0", "https://github.com/v/p", 7), "crates.io": ("c", "0.3.0", "https://github.com/a/c", 5),
        "rubygems.org": ("r", "4.0", "https://github.com/a/r", 0), "nuget.org": ("G", "1.10.0", None, 0), "proxy.golang.org": ("github.com/a/g/v2", "v1.10.0", "https://github.com/a/g", 0),
    }


def test_entities(spark):
    claim = lambda v: [{"mainsnak": {"datavalue": {"value": v}}}]
    rows = variants(spark, Q1={"labels": {"fr": {"value": "Nom"}}, "claims": {"P1324": claim("https://github.com/a/b.git"), "P856": claim(" "), "P348": claim("1.0")}}, Q2={}).withColumnRenamed("k", "qid")
    got = {r.qid: (r.name, r.canonical_repository, r.official_website, r.officiality_score, r.officiality_status) for r in adapters.entities(rows).collect()}
    assert got == {"Q1": ("Nom", "https://github.com/a/b", None, 45, "CANDIDATE"), "Q2": ("Q2", None, None, 0, "UNVERIFIED")}


def test_crawl_is_breadth_first_and_bounded(spark):
    page = lambda *to: "".join(f"<a href='{x}'>x</a>" for x in to)
    pages = spark.createDataFrame([("https://h/a", page("b", "/c", "https://o/z")), ("https://h/b", page("d", "a")), ("https://h/c", page()), ("https://h/d", page("e")), ("https://h/x", page())], "url string, html string")
    assert sorted((r.url[-1], r.depth) for r in web.crawl(pages, "https://h/a").collect()) == [("a", 0), ("b", 1), ("c", 1), ("d", 2)]
    assert web.crawl(pages, "https://h/a", most=2).count() == 2 and web.crawl(pages, "https://h/none").count() == 0
    assert web.link_catalogue(pages.limit(1)).count() == 3
    assert web.page_chunks(spark.createDataFrame([("u", "<p>" + "word " * 1000 + "</p>")], "url string, html string"), "s").count() == 2


def test_link_catalogue_has_a_link_once_a_page_of_many_rows(spark):
    rows = [("https://h/a", "<a href='x.pdf'>x</a><a href='y'>y</a>"), ("https://h/a", "<a href='y'>y</a><a href='z'>z</a>"), ("https://h/b", "<a href='y'>y</a>")]
    got = sorted((r.page_url, r.url, r.is_download) for r in web.link_catalogue(spark.createDataFrame(rows, "url string, html string")).collect())
    assert got == [("https://h/a", "x.pdf", True), ("https://h/a", "y", False), ("https://h/a", "z", False), ("https://h/b", "y", False)]


def test_crawl_counts_stored_pages_and_follows_long_chains(spark):
    page = lambda to: "".join(f"<a href='/{x}'>x</a>" for x in to)
    wide = [("https://h/seed", page(f"p{i:03}" for i in range(600))), *((f"https://h/p{i:03}", "") for i in range(500, 600))]
    chain = [(f"https://h/c{i}", page([f"c{i + 1}"])) for i in range(53)]
    pages = spark.createDataFrame(wide + chain, "url string, html string")
    got = web.crawl(pages, "https://h/seed").collect()
    assert len(got) == 101 and {r.depth for r in got} == {0, 1}
    assert web.crawl(pages, "https://h/seed", most=40).count() == 40
    assert sorted(r.depth for r in web.crawl(pages, "https://h/c0").collect()) == list(range(53))


def test_documentation_discovery(spark):
    site = "<urlset><url><loc>https://d/docs/a?utm_source=x</loc><lastmod>2</lastmod></url><url><loc>https://d/blog/b</loc></url></urlset>"
    idx = spark.createDataFrame([("sitemap", "https://d/s.xml", site), ("llms", "https://d/l", "[a](https://d/docs/a) [b](https://d/docs/b)"), ("html", "https://d/docs/", "<a href='c'>c</a><a href='/docs/login'>l</a>")], "kind string, url string, body string")
    found = web.discovered(idx, "d", "/docs/")
    assert {(r.url, r.lastmod) for r in found.collect()} == {("https://d/docs/a", "2"), ("https://d/docs/b", None), ("https://d/docs/c", None)}
    state = spark.createDataFrame([("https://d/docs/a", "2"), ("https://d/docs/old", "1")], "url string, lastmod string")
    assert {(r.url[-1], r.action) for r in web.revalidation_plan(found, state, True).collect()} == {("a", "SKIP"), ("b", "FETCH"), ("c", "FETCH"), ("d", "REMOVE")}
    assert web.revalidation_plan(found, state, False).filter("action = 'REMOVE'").count() == 0


def test_tree_diff_and_strategy(spark):
    t = lambda *x: spark.createDataFrame(list(x), "path string, sha string")
    a, b = t(("docs/a.md", "1"), ("docs/b.md", "1"), ("src/x.py", "1"), ("docs/s.md", "1")), t(("docs/a.md", "2"), ("docs/c.md", "1"), ("src/x.py", "2"), ("docs/s.md", "1"))
    assert {(r.path, r.change) for r in web.tree_diff(a, b, ("docs/",)).collect()} == {("docs/a.md", "CHANGED"), ("docs/b.md", "REMOVED"), ("docs/c.md", "ADDED")}
    assert web.tree_diff(a, b, complete=False).filter("change = 'REMOVED'").count() == 0
    links = spark.createDataFrame([("https://d", "https://github.com/o/r/edit/main/docs/a.md", "Edit this page"), ("https://e", "https://github.com/o/r", "x"), ("https://github.com/o/r/tree/main/docs", "https://y", "")], "page_url string, url string, label string")
    assert {r.page_url: r.strategy for r in web.strategy(links).collect()} == {"https://d": "GIT", "https://e": "WEB", "https://github.com/o/r/tree/main/docs": "GIT"}
    portal = spark.createDataFrame([("https://p/", "<a href='/a'>a</a><a href='/no/b'>b</a>")], "url string, html string")
    assert [r.url for r in web.one_hop(portal, spark.createDataFrame([("p", "/no")], "host string, prefix string")).collect()] == ["https://p/a"]


def test_ledger(spark, tmp_path):
    (tmp_path / "ok").write_bytes(b"abc")
    (tmp_path / "bad").write_bytes(b"abd")
    sha = hashlib.sha256(b"abc").hexdigest()
    cols = "source_id string, artifact_id string, url string, signature string, sha256 string, size_bytes long, local_path string, status string, verification string, verified_sha256 string, error string, first_seen_at string, last_checked_at string"
    empty = spark.createDataFrame([], cols)
    up = spark.createDataFrame([("s", n, "u", "1", sha, 3, f"{tmp_path}/{n}", "DOWNLOADED", False, True, None) for n in ("ok", "bad", "gone")], "source_id string, artifact_id string, url string, signature string, sha256 string, size_bytes long, local_path string, last_result string, removed boolean, downloaded boolean, error string")
    facts = ledger.file_facts(spark, str(tmp_path))
    led = ledger.ingest(empty, up, facts, "t1")
    assert {r.artifact_id: r.status for r in led.collect()} == {"ok": "FETCHED", "bad": "FETCHED", "gone": "LOCAL_MISSING"}
    led = ledger.verify(led, facts, "t2")
    assert {r.artifact_id: (r.status, r.verification) for r in led.collect()} == {"ok": ("FETCHED", "VERIFIED"), "bad": ("CORRUPTED", "FAILED"), "gone": ("LOCAL_MISSING", "FAILED")}
    assert [r.artifact_id for r in ledger.repair_plan(led).collect()] == ["bad", "gone"]
    again = ledger.ingest(led, up.filter("artifact_id = 'ok'").withColumn("sha256", F.lit(None).cast("string")), facts, "t3")
    assert {r.artifact_id: r.verification for r in again.collect()}["ok"] == "VERIFIED"
    moved = ledger.ingest(led, up.filter("artifact_id = 'ok'").withColumn("sha256", F.lit("0")), facts, "t3")
    assert {r.artifact_id: r.verification for r in moved.collect()}["ok"] == "UNVERIFIED"
    assert set(ledger.migrated(empty.drop("verification", "verified_sha256"), 1).columns) >= {"verification", "fetch_method"}


def test_marks_and_retries(spark):
    state = spark.createDataFrame([("s", "a", "DOWNLOADED", True, False, None, "1", "t0", "t0")], "source_id string, artifact_id string, last_result string, downloaded boolean, removed boolean, error string, signature string, last_checked string, last_downloaded string")
    marks = spark.createDataFrame([("s", "a", "error", None, "boom"), ("s", "b", "ghost", "9", None)], "source_id string, artifact_id string, mark string, signature string, error string")
    got = {r.artifact_id: (r.last_result, r.downloaded, r.signature, r.error, r.last_downloaded) for r in ledger.mark(state, marks, "t1").collect()}
    assert got == {"a": ("ERROR", True, "1", "boom", "t0"), "b": ("UPSTREAM_GHOST", False, "9", None, None)}
    stats = "struct<failed:int,backlog_count:int,deferred_budget:int,skipped_oversize:int>"
    runs = spark.createDataFrame([("a", "success", (0, 1, 0, 0)), ("b", "success", (0, None, 0, 0)), ("c", "error", (1, 0, 0, 0))], f"source_id string, status string, stats {stats}")
    assert {r.source_id: r.status for r in ledger.mark_partial(runs).collect()} == {"a": "partial", "b": "success", "c": "error"}
    due = runs.select("source_id", "stats", F.lit("2024-01-01 00:00:00").cast("timestamp").alias("last_attempt"), F.lit(None).cast("int").alias("retry_hours"))
    at = lambda x: F.lit(x).cast("timestamp")
    assert [r.source_id for r in ledger.retry_due(due, at("2024-01-01 06:00:00"), due.filter("source_id = 'c'")).collect()] == ["a"]
    assert ledger.retry_due(due, at("2024-01-01 05:00:00"), due.limit(0)).count() == 0
    t = spark.createDataFrame([("r", "n", "new")], "registry string, name string, target_url string")
    s = spark.createDataFrame([("r", "n", "old", 1)], "registry string, name string, target_url string, generation int")
    m = ledger.prepare_migration(t, s)
    assert tuple(ledger.finish_migration(s, m, t.limit(0)).first()) == ("r", "n", "old", 1) and tuple(ledger.finish_migration(s, m, t).first()) == ("r", "n", "new", 2)
    assert ledger.finish_runs(spark.createDataFrame([("r", "s", "a", 5), ("r", "s", "b", None)], "run_id string, source_id string, artifact_id string, size_bytes int")).first()["bytes"] == 5


def test_safe_replace_and_archive(spark, tmp_path):
    path = str(tmp_path / "lake")
    sinks.write_tables(spark.createDataFrame([("a", 1), ("b", 1)], "_table string, x int"), path)
    sinks.write_tables(spark.createDataFrame([("a", 2)], "_table string, x int"), path)
    assert sorted(map(tuple, spark.read.parquet(path).select("_table", "x").collect())) == [("a", 2), ("b", 1)]
    assert sinks.archive_tables(spark, path, ["b", "none"]) == 1 and spark.read.parquet(path).count() == 1
    sinks.write_merged(spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"), str(tmp_path / "m"), 0, ["k"])
    out = sinks.write_merged(spark.createDataFrame([(2, "c")], "k int, v string"), str(tmp_path / "m"), 1, ["k"])
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(1, "a"), (2, "c")]


def test_small_state(spark, tmp_path):
    path = str(tmp_path / "s" / "x.json")
    sinks.atomic_json(path, {"a": 1})
    assert sinks.load_json(path) == {"a": 1} and sinks.load_json(path + "no", 5) == 5
    with open(path, "w") as f:
        f.write("{")
    assert sinks.load_json(path, 7) == 7 and sinks.load_json(path, 8) == 8
    a = sinks.save_snapshot(str(tmp_path / "n"), "stem", [b"ab", b"c"], ".bin")
    assert not a["known"] and sinks.save_snapshot(str(tmp_path / "n"), "stem", [b"abc"], ".bin")["known"]
    for bad in ({"most": 2}, {"expected": "0"}):
        with pytest.raises(ValueError):
            sinks.save_snapshot(str(tmp_path / "n"), "other", [b"abc"], ".bin", **bad)
    assert len(list((tmp_path / "n").iterdir())) == 1
    sinks.write_report(str(tmp_path / "r"), {"p": spark.range(2)}, "Title", {"g": True, "h": False})
    assert "- [x] g\n- [ ] h" in (tmp_path / "r/report.md").read_text() and sinks.load_json(str(tmp_path / "r/p.json")) == [{"id": 0}, {"id": 1}]


def test_lease_budget_cooldown(tmp_path):
    now = [0.0]
    lease = control.Lease(str(tmp_path / "l"), 10, lambda: now[0])
    assert lease.acquire("a") and not lease.acquire("b") and lease.acquire("a")
    now[0] = 11
    assert lease.acquire("b")
    with pytest.raises(RuntimeError):
        lease.heartbeat("a")
    lease.release("b")
    assert lease.acquire("c")
    b = control.Budget(requests=1, clock=lambda: now[0])
    b.spend(requests=1)
    with pytest.raises(control.BudgetExceeded):
        b.spend(requests=1)
    c = control.Cooldown(str(tmp_path / "c"), lambda: now[0])
    c.set(5)
    assert c.left() == 5
    assert control.is_rate_limited(403, {"X-RateLimit-Remaining": "0"}) and not control.is_rate_limited(403, {}) and control.retry_after({"Retry-After": "7"}, 0) == 7
    assert control.is_public_address("8.8.8.8") and not any(map(control.is_public_address, ("10.0.0.1", "127.0.0.1", "::1", "224.0.0.1", "x")))
    robots = "User-agent: *\nDisallow: /no\n\nUser-agent: Bot\nUser-agent: Other\nDisallow:\nDisallow: /b # x"
    assert control.robots_denied(robots) == ["/no"] and control.robots_denied(robots, "my-bot/1") == ["/b"] and control.robots_denied("") == []


def test_fair_stages_and_orchestrator(tmp_path):
    work = {"a": 5, "b": 1, "c": 9}

    def runner(registry, limit):
        if registry == "c":
            raise RuntimeError
        done = min(limit, work[registry])
        work[registry] -= done
        return done

    got = control.run_fair_stage(["a", "b", "c"], 10, 2, runner)
    assert got["by_registry"] == {"a": 5, "b": 1} and got["stopped_reason"] == "ALL_EXHAUSTED" and got["errors"] == 1
    assert control.run_fair_stage([], 1, 1, runner)["stopped_reason"] == "NO_REGISTRIES" and control.run_fair_stage(["a"], 0, 1, runner)["stopped_reason"] == "BUDGET_ZERO"
    assert control.rotated(["a", "b", "c"], "a") == ["b", "c", "a"]
    o = control.Orchestrator(str(tmp_path), {"qualify": lambda r, n: n, "fetch": lambda r, n: 0}, ["a", "b"])
    first = o.run("r1", {"qualify": 1, "fetch": 1})
    assert first["stages"]["qualify"]["by_registry"] == {"a": 1} and o.run("r2", {"qualify": 1, "fetch": 1})["stages"]["qualify"]["by_registry"] == {"b": 1}
    assert o.lease.acquire("x") and o.run("r3")["status"] == "LEASE_HELD"
    assert control.run_cycle(["a"], lambda s: "success", lambda seen: [] if "a" not in seen else ["b"]) == [("a", "success"), ("b", "success")]
    c = control.Controls(str(tmp_path / "controls.json"))
    assert c.update({"interval_seconds": 1})["interval_seconds"] == 300 and c.update({"automatic_enabled": False}, "s")["automatic_enabled"] is False and c.settings()["automatic_enabled"]


def test_deadline_cancels_jobs(spark):
    began = time.monotonic()
    with pytest.raises(control.DeadlineExceeded), control.hard_deadline(spark, 1.0, "slow"):
        spark.range(0, 8, 1, 8).select(F.expr("reflect('java.lang.Thread', 'sleep', 20000L + id)")).collect()
    assert time.monotonic() - began < 15
    with control.hard_deadline(spark, 60, "fast"):
        assert spark.range(3).count() == 3


def test_feed_source(spark, tmp_path):
    spark.dataSource.register(FeedSource)
    folder = tmp_path / "f"
    folder.mkdir()
    write = lambda a, b: (folder / f"{a}-{b}.ndjson").write_text("".join(json.dumps({"seq": i, "name": f"n{i}", "deleted": i % 2 == 0}) + "\n" for i in range(a, b + 1)))
    write(1, 3)
    assert spark.read.format("feed").option("path", str(folder)).load().count() == 3

    def drain():
        spark.readStream.format("feed").option("path", str(folder)).load().writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()

    drain()
    write(4, 6)
    drain()
    assert sorted(r.seq for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [1, 2, 3, 4, 5, 6]


def test_command_line(spark, capsys, tmp_path):
    from conftest import SF

    assert cli.main(["queries"]) == 0 and "corpus_build" in capsys.readouterr().out
    assert cli.main(["run", "country_scope", SF], spark) == 0 and "MIXED" in capsys.readouterr().out
    assert cli.main(["sql", "SELECT count(*) AS n FROM nation", SF], spark) == 0 and json.loads(capsys.readouterr().out) == {"n": 25}
    assert cli.main(["search", "token", SF, "--rows", "1"], spark) == 0
    assert cli.main(["corpus", SF, str(tmp_path / "c"), "v1"], spark) == 0


def test_marks_meet_in_parts_by_rows(spark, monkeypatch):
    """Rows whose columns repeat few values are dealt by their number, not by the few bytes that they are shuffled in."""
    monkeypatch.setattr(ledger, "EACH", 100)
    state = spark.range(1600).selectExpr("id AS source_id", "id % 7 AS artifact_id", "'OLD' AS last_result", "true AS downloaded", "false AS removed", "'e' AS error", "'s' AS signature", "'t0' AS last_checked", "'t0' AS last_downloaded")
    marks = state.select("source_id", "artifact_id", F.lit("ghost").alias("mark"), "signature", "error")
    rows = ledger.mark(state, marks, "t1").withColumn("part", F.spark_partition_id()).collect()
    assert len(rows) == 1600 and {r.last_result for r in rows} == {"UPSTREAM_GHOST"}
    assert len({r.part for r in rows}) > 20
