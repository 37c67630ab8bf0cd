import re
import unicodedata

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weirlake.functions import markup, text, urls


def run(spark, values, expr, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    got = spark.createDataFrame(rows, f"i int, x {kind}").select("i", expr(F.col("x")).alias("y")).collect()
    return [r.y for r in sorted(got, key=lambda r: r.i)]


def clean(t):
    t = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "", unicodedata.normalize("NFKC", t or "")).replace("\r\n", "\n").replace("\r", "\n")
    t = "\n".join(re.sub(r"[ \t]+", " ", x).strip() for x in t.split("\n"))
    return re.sub(r"\n{3,}", "\n\n", t).strip()


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.text(alphabet=st.sampled_from("aB ßé\t\n\r\x00\x0b\x85\xa0ﬁ²Ǻ   x."), max_size=30), min_size=20, max_size=60))
def test_clean_text_equals_plain_python(spark, values):
    assert run(spark, values, text.clean_text) == [clean(v) for v in values]


def test_clean_text_of_null_and_long(spark):
    assert run(spark, [None, "", "a " * 100_000], text.clean_text) == ["", "", ("a " * 100_000).strip()]


def test_stable_characters_are_stable():
    ok = re.compile(f"[{text._STABLE}]")
    assert all(unicodedata.normalize("NFKC", chr(c)) == chr(c) for c in range(0x250) if ok.fullmatch(chr(c)))


def test_full_folding(spark):
    values = ["Straße", "ΣΑΣ", "ﬁn", "ABC", None]
    assert run(spark, values, text.fold_full) == [v and v.casefold() for v in values]
    assert run(spark, ["Straße"], text.fold) == ["strasse"]


def test_chunks_cover_the_text(spark):
    for n in (0, 1, 10, 11, 29, 30, 31):
        got = run(spark, ["x" * n], lambda c: text.chunks(c, 10, 3))[0]
        want, at = [], 0
        while at < n:
            end = min(n, at + 10)
            want.append("x" * (end - at))
            if end == n:
                break
            at = end - 3
        assert got == want


def test_title(spark):
    assert run(spark, ["--\n ab \n | Tïtle  here -\nx", "", None], text.title) == ["Tïtle here", None, None]


def test_names(spark):
    assert run(spark, ["a b/c", "..", None, "é"], text.safe_name) == ["a_b_c", "unknown", "unknown", "unknown"]
    assert run(spark, ["x" * 300], lambda c: text.snapshot_name(c, F.lit("d" * 64), F.lit(".csv")))[0] == "x" * 120 + "--" + "d" * 64 + ".csv"


def test_canonical_urls(spark):
    values = ["HTTPS://Ex.org:443//a//b/?utm_source=x&q=1&ref=2#f", "http://ex.org:8080", "ftp://x", None, "https://user@h.org/p?k"]
    assert run(spark, values, urls.canonical_documentation_url) == ["https://ex.org/a/b?q=1", "http://ex.org:8080/", None, None, "https://h.org/p?k="]


def test_crawl_url(spark):
    assert run(spark, ["https://x.org/a%20%0A#f", "https://x.org/a?b=c"], urls.crawl_url) == ["https://x.org/a", "https://x.org/a?b=c"]


def test_relative_links(spark):
    got = spark.createDataFrame([("https://x.org/a/b", ["c", "/d", "//x.org/e", "https://y.org/f", "g.zip", "c#h", "uploads/"])], "u string, h array<string>")
    assert got.select(urls.same_host_links(F.col("u"), F.col("h")).alias("l")).first().l == ["https://x.org/a/c", "https://x.org/d", "https://x.org/e"]


def test_markup(spark):
    page = "<p>a&amp;b</p><script>x</script><a href='/q'>l</a><style>s</style>"
    assert run(spark, [page], markup.html_text_regex) == ["a&b l"]
    assert run(spark, [page, None], markup.html_text_parsed) == ["a&b\nl", None]
    assert run(spark, [page], markup.html_links) == [["/q"]]
    assert run(spark, ["[a](/x) [b](<y> t)\nhttps://z.org q"], markup.markdown_links) == [["/x", "y", "https://z.org"]]
    site = "<urlset xmlns='s'><url><loc> https://x/a?b&amp;c </loc><lastmod>2024</lastmod></url><url><loc>https://x/b</loc></url></urlset>"
    assert [tuple(x) for x in run(spark, [site], markup.sitemap_entries)[0]] == [("https://x/a?b&c", "2024"), ("https://x/b", None)]
    assert run(spark, ["# c\na=1\nb : 2\na=3"], markup.properties) == [{"b": "2", "a": "3"}]
    assert run(spark, ["<m:x><m:release>1.2</m:release></m:x>"], lambda c: markup.xml_text(c, "release")) == ["1.2"]


def test_parsed_pages_are_held_in_small_parts():
    import pyarrow as pa

    parts = list(markup.html_text_parsed.func(iter([pa.array(["<p>a</p>", None] * 500), pa.array([], pa.string())])))
    assert max(map(len, parts)) <= markup.PAGES
    assert [t for p in parts for t in p.to_pylist()] == ["a", None] * 500
