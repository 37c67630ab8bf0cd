import hashlib
import json

from pyspark.sql import functions as F

from weirlake.operators import technologies
from weirlake.sources import dispatch
from weirlake.streaming.pinned import Cursor, advance, next_page, pin


def test_portal_plan(spark):
    page = json.dumps({"results": [{"id": "same"}, {"id": "new"}, {"id": "ghost"}, {"id": "back"}]})
    pages = spark.createDataFrame([(page,)], "j string").select(F.expr("parse_json(j)").alias("payload"))
    sig = lambda i: hashlib.sha256(json.dumps({"id": i}, separators=(",", ":")).encode()).hexdigest()
    state = spark.createDataFrame([("same", sig("same"), False, False), ("ghost", sig("ghost"), False, True), ("back", sig("back"), True, False), ("gone", "1", False, False), ("long gone", "1", True, False)], "id string, signature string, removed boolean, ghost boolean")
    plan = dispatch.portal_plan(pages, state)
    ids = {k: {r.id for r in v.collect()} for k, v in plan.items() if k != "state"}
    assert ids == {"read": {"new", "back"}, "removed": {"gone"}, "skipped": {"ghost"}}
    assert plan["read"].filter("id = 'new'").first().table == "portal_new"


def test_materialize_and_repair(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n2,b\n1,a\n")
    assert dispatch.materialize(spark, str(tmp_path / "a.csv"), str(tmp_path / "o"), "s", "d", "u", "t", ["x"]) == 2
    assert [r["_prov_row_index"] for r in spark.read.parquet(str(tmp_path / "o/parquet")).orderBy("x").collect()] == [0, 1]
    sha = hashlib.sha256(b"abc").hexdigest()
    assert dispatch.direct_repair({"artifact_id": "a/b", "url": "u", "sha256": sha}, lambda u: b"abc", str(tmp_path / "r"))["repaired"]
    assert not dispatch.direct_repair({"artifact_id": "a", "url": "u", "sha256": sha}, lambda u: b"abd", str(tmp_path / "r"))["repaired"]
    assert dispatch.connector("http_file") and set(dispatch.CONNECTORS) >= {"public_web", "official_docs"}


def test_pinned_scan(spark):
    rows = lambda n: spark.createDataFrame([(f"t{i // 2:02d}", i) for i in range(n)], "ts string, k int")
    seen, cursor = [], pin(Cursor(), rows(9), "ts")
    while cursor.target:
        page = next_page(cursor, rows(13), ["ts", "k"], 4).collect()
        seen += [r.k for r in page]
        cursor = advance(cursor, page, ["ts", "k"], 4)
    # Rows that came after the target was pinned wait for the next scan; those at the target itself belong to this one.
    assert seen == list(range(10)) and cursor.base == "t04"
    cursor = pin(cursor, rows(13), "ts")
    assert [r.k for r in next_page(cursor, rows(13), ["ts", "k"], 10).collect()] == [10, 11, 12]
    assert pin(Cursor(base="t06"), rows(13), "ts").target is None


def test_identities_and_metadata(spark):
    rows = spark.createDataFrame([("https://github.com/a/old", "https://github.com/a/new"), ("https://github.com/a/x", "https://github.com/a/y"), (None, "https://github.com/a/y")], "l string, r string")
    ids = spark.createDataFrame([("https://github.com/a/old", 5), ("git+https://github.com/a/new.git", 5), ("https://github.com/a/x", 6)], "url string, repository_id int")
    assert sorted(r.transferred for r in technologies.same_repository(F.col("l"), F.col("r"), ids, rows).collect()) == [False, False, True]
    one = lambda *x: spark.createDataFrame([(i,) for i in x], "source_id string")
    assert technologies.all_exercised(one("a", "b"), one("a"), one("b")) and not technologies.all_exercised(one("a", "c"), one("a"), one("b")) and not technologies.all_exercised(one(), one(), one())
    s = spark.createDataFrame([("s", "p", "multidomain", "A", "OPEN", {"language": "de"})], "source_id string, provider string, domain string, rights_tier string, access_tier string, options map<string,string>")
    docs = spark.createDataFrame([("s", "https://x/dataset/1", "tax and tax and roads"), ("s", "https://x/a", None)], "source_id string, url string, text string")
    got = technologies.classified_documents(docs, technologies.source_metadata(s, "XX", "X"), {"tax": ("tax",), "roads": ("road",)}).orderBy("url").collect()
    assert [(r.primary_domain, r.document_type, r.classification_status, r.language) for r in got] == [("multidomain", "OTHER", "PARTIAL", "de"), ("tax", "DATASET", "CLASSIFIED", "de")]
    assert json.loads(got[1].secondary_domains_json) == ["roads"]
