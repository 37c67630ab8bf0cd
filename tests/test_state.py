import gzip
import io
import json
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from weirlake.operators import changes, corpus
from weirlake.plans.query import check_read_only, run_sql, search_documents
from weirlake.sources import files, maven_index, registry
from weirlake.streaming.change_feed import EVENT, ChangeFeed, require_bootstrap, windowed_counts


def test_folding_in_batches_equals_folding_once(spark):
    events = [("npm", f"p{i % 7}", i % 5 == 0, i, f"s{i % 3}") for i in range(60)]
    df = lambda rows: spark.createDataFrame(rows, EVENT)
    empty = spark.createDataFrame([], "registry string, name string, source string, priority int, status string, first_seen_at string, last_seen_at string")
    once = changes.fold_events(empty, df(events), "t")
    twice = changes.fold_events(changes.fold_events(empty, df(events[:31]), "t"), df(events[31:]), "t")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))


def test_feed_resumes_and_replays(spark, tmp_path):
    landing = tmp_path / "in"
    landing.mkdir()

    def land(name, rows):
        (landing / name).write_text("".join(json.dumps(dict(zip(("registry", "name", "deleted", "ord", "source"), r, strict=True))) + "\n" for r in rows))

    feed = ChangeFeed(spark, str(tmp_path / "feed"))
    assert feed.cursor() is None and feed.version() == -1
    land("a.json", [("npm", "a", False, 1, "s"), ("npm", "b", False, 2, "s")])
    feed.follow(str(landing), "t1")
    assert feed.cursor() == 2
    land("b.json", [("npm", "a", True, 3, "s"), ("npm", " ", False, 4, "s")])
    feed.follow(str(landing), "t2")
    feed.follow(str(landing), "t3")
    assert feed.cursor() == 4
    got = {r.name: (r.status, r.first_seen_at, r.last_seen_at, r.priority) for r in feed.queue().collect()}
    assert got == {"a": ("DELETED", "t1", "t2", 60), "b": ("PENDING", "t1", "t1", 60)}
    # A batch that was committed is not applied again.
    feed.apply(spark.createDataFrame([("npm", "z", False, 9, "s")], EVENT), feed.version(), "t4")
    assert feed.cursor() == 4


def test_bootstrap_before_follow():
    with pytest.raises(RuntimeError):
        require_bootstrap(None, False)
    require_bootstrap(None, True)


def test_windows_on_a_stream(spark, tmp_path):
    from conftest import SF

    rows = spark.read.parquet(f"{SF}/events.parquet")
    rows.write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "e"))
    windowed_counts(stream).writeStream.outputMode("complete").format("memory").queryName("w").trigger(availableNow=True).start().awaitTermination()
    assert spark.table("w").agg(F.sum("n")).first()[0] == rows.count()


def test_tombstones_need_complete_discovery(spark):
    known, now = spark.range(5).toDF("k"), spark.range(3).toDF("k")
    assert changes.tombstones(known, now, ["k"]).count() == 2
    assert changes.tombstones(known, now, ["k"], complete=False).count() == 0


def test_keyset_pages_cover_everything_once(spark):
    rows = spark.createDataFrame([(i // 3, i) for i in range(20)], "a int, b int")
    seen, after = [], None
    while page := [tuple(r) for r in changes.keyset_page(rows, ["a", "b"], after, limit=6).collect()]:
        seen += page
        after = page[-1]
    assert seen == [(i // 3, i) for i in range(20)]


def test_global_rank_of_gaps(spark):
    ids = [0, 5, 6, 40, 41, 1000]
    got = corpus.global_rank(spark.createDataFrame([(i,) for i in ids], "k long"), "k", 7)
    assert [(r.k, r["rank"]) for r in got.orderBy("k").collect()] == list(zip(ids, range(6), strict=True))


def test_write_corpus(spark, tmp_path):
    line = " ".join(f"word{i}" for i in range(40))
    rows = spark.createDataFrame([(1, line), (2, line.upper()), (3, "short"), (4, line + " more"), (5, None)], "doc_id int, text string")
    m = corpus.write_corpus(rows, str(tmp_path), "v1", "doc_id", shard_size=1)
    assert m["stats"] == {"documents_seen": 5, "rejected_quality": 2, "documents_written": 2, "duplicates": 1}
    shards = [p for p in (tmp_path / "v1/shards").glob("part-*") if p.stat().st_size]
    assert sorted(len(p.read_text().splitlines()) for p in shards) == [1, 1]


@pytest.mark.parametrize("sql", ["INSERT INTO t SELECT 1", "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a", "DROP TABLE t", "CREATE TABLE x AS SELECT 1", "SET a=b"])
def test_only_queries_run(spark, sql):
    with pytest.raises(PermissionError):
        check_read_only(spark, sql)


def test_sql_is_limited_in_the_plan(spark):
    got = run_sql(spark, "WITH a AS (SELECT x, ';' AS s FROM t) SELECT * FROM a WHERE x IN (SELECT x FROM t)", {"t": spark.range(100).toDF("x")}, 7)
    assert got.count() == 7


def test_search_is_literal(spark):
    d = spark.createDataFrame([(1, "100% sure"), (2, "Under_score"), (3, None)], "doc_id int, text string")
    assert [r.doc_id for r in search_documents([d], "100%").collect()] == [1]
    assert [r.doc_id for r in search_documents([d], "under_").collect()] == [2]
    assert search_documents([d], "a b").count() == 0


def test_csv_encodings_and_delimiters(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿année;valeur\n2020;é\n".encode())
    (tmp_path / "b.csv").write_bytes("nom|x\ncafé €|1\n".encode("cp1252"))
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "a.csv")).collect()] == [("2020", "é")]
    assert files.read_csv(spark, str(tmp_path / "a.csv")).columns == ["année", "valeur"]
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "b.csv")).collect()] == [("café €", "1")]
    with pytest.raises(ValueError):
        files.sniff_csv(b"\nx")


def test_json_shapes(spark, tmp_path):
    for name, body, want in (("a", '[{"x":1},{"x":2}]', 2), ("b", '{"data":[{"x":1}]}', 1), ("c", '{"x":1}', 1), ("d", "5", 1)):
        (tmp_path / f"{name}.json").write_text(body)
        got = files.read_json(spark, str(tmp_path / f"{name}.json"))
        assert got.count() == want
    assert got.select(F.expr("variant_get(value, '$.value', 'int')")).first()[0] == 5


def test_jsonl_and_any(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x":1}\n\n{"x":2}\n')
    got = files.read_any(spark, str(tmp_path / "a.jsonl"), "jsonl", "src")
    assert got.count() == 2 and got.first()["_prov_source_id"] == "src"
    with pytest.raises(ValueError):
        files.read_any(spark, "x", "pdf", "src")


def test_parquet_nan(spark, tmp_path):
    spark.createDataFrame([(float("nan"),), (1.0,)], "x double").write.parquet(str(tmp_path / "p"))
    assert files.read_parquet(spark, str(tmp_path / "p")).filter("x is null").count() == 1


def test_zip_of_csv(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x_normalized.csv", "Area,v\nFrance,1\n fRANCE ,2\nSpain,3\n")
        z.writestr("other.csv", "Area,v\nFrance,9\n")
    got = files.read_zip_csv(spark, str(tmp_path / "a.zip"), ("france",)).collect()
    assert sorted(r.row["v"] for r in got) == ["1", "2"]


def test_spreadsheet(spark, tmp_path):
    ns = "xmlns='http://schemas.openxmlformats.org/spreadsheetml/2006/main'"
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook {ns}><sheets><sheet name='S'/></sheets></workbook>")
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>h1</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData><row><c r='A1' t='s'><v>0</v></c><c r='B1' t='inlineStr'><is><t>h2</t></is></c></row><row><c r='A2'><v>7</v></c></row></sheetData></worksheet>")
    got = files.read_spreadsheet(spark, str(tmp_path / "a.xlsx")).first()
    assert (got.sheet, got.row_index, got.row) == ("S", 0, {"h1": "7"})


def test_maven_index(spark, tmp_path):
    def record(fields):
        out = struct.pack(">i", len(fields))
        for k, v in fields.items():
            out += b"\x01" + struct.pack(">H", len(k)) + k.encode() + struct.pack(">i", len(v.encode())) + v.encode()
        return out

    body = b"\x01" + struct.pack(">q", 5) + record({"u": "g|a|1|NA|jar", "m": "12"}) + record({"DESCRIPTOR": "x"}) + record({"del": "g|b|1|NA|jar"})
    (tmp_path / "c.gz").write_bytes(gzip.compress(body))
    got = maven_index.read_maven_index(spark, str(tmp_path / "c.gz")).collect()
    assert [(r.ordinal, r.kind, r.uinfo, r.modified) for r in got] == [(0, "ADD", "g|a|1|NA|jar", 12), (2, "REMOVE", "g|b|1|NA|jar", None)]
    with pytest.raises(EOFError):
        list(maven_index.index_events(gzip.compress(body[:-3])))
    assert maven_index._modified_utf8(b"a\xc0\x80") == "a\x00" and io.BytesIO


def test_registries_and_layers(spark, tmp_path):
    head = ",".join(registry.COLUMNS)
    (tmp_path / "a.csv").write_text(f"{head}\nx_1,T,D,P,https://a,A_OPEN,OPEN,P0\n")
    (tmp_path / "b.csv").write_text(f"{head}\nx_2,T,D,P,nope,A_OPEN,OPEN,P9\n")
    rows = registry.read_registries(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert {r.problem for r in registry.validate_registry(rows, "x_").collect()} == {"source_url is no web address", "priority is unknown"}
    with pytest.raises(ValueError):
        registry.read_registries(spark, [str(tmp_path / "a.csv"), str(tmp_path / "a.csv")])
    got = {r.path: r.value for r in registry.layered(spark, [{"a": {"b": 1, "c": 2}}, {"a": {"b": 3}}]).collect()}
    assert got == {"a.b": "3", "a.c": "2"}
    assert registry.expand_groups({"sources": {"s": {"x": 1}}, "source_groups": {"g": {"members": ["s", "t"], "options": {"x": 0, "y": 2}}}}) == {"sources": {"s": {"x": 1, "y": 2}, "t": {"x": 0, "y": 2}}}
    with pytest.raises(ValueError):
        registry.checked_identifier("a; drop")


def test_csv_encoding_is_that_of_all_lines(spark, tmp_path):
    """A first file with a header alone, and plain text longer than any sample, say nothing of what follows."""
    (tmp_path / "parts").mkdir()
    (tmp_path / "parts/part-0.csv").write_bytes(b"")
    (tmp_path / "parts/part-1.csv").write_bytes(b"name;n\n")
    (tmp_path / "parts/part-2.csv").write_bytes("name;n\ncafé;1\n".encode("latin-1"))
    assert [tuple(r) for r in files.read_csv(spark, str(tmp_path / "parts")).collect()] == [("café", "1")]
    plain = "name,n\n" + "plain,1\n" * (files.SAMPLE // 8 + 1)
    for name, end, encoding, got in (("l.csv", "é\x81,2\n", "latin-1", "é\x81"), ("c.csv", "é€,2\n", "cp1252", "é€"), ("u.csv", "é€,2\n", "utf-8", "é€")):
        (tmp_path / name).write_bytes((plain + end).encode(encoding))
        assert [r.name for r in files.read_csv(spark, str(tmp_path / name)).filter("n = '2'").collect()] == [got]
