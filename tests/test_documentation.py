"""Documentation candidates from payloads, redirects and carried trust, against plain Python."""

import base64
import json
import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from weirlake.functions import markup, urls
from weirlake.operators import documentation as d


def test_resolved_urls(spark):
    bases = ["https://a.org/x/y?q=1", "https://a.org", "http://a.org:8080/x/"]
    hrefs = ["", "z", "/z/", "../z", "../../../z", "./", "..", "?k=v", "#f", "//b.org/p", "mailto:x@y", "https://c.org/../d", "a/./b/../c#f", "z?r=../s", "g;x=1/./y"]
    rows = [(b, h) for b in bases for h in hrefs if h != "https://c.org/../d"]
    got = spark.createDataFrame(rows, "b string, h string").select("b", "h", urls.resolved(F.col("b"), F.col("h")).alias("u")).collect()
    assert [(r.b, r.h, r.u.split("#")[0].rstrip("/")) for r in got] == [(b, h, urljoin(b, h).split("#")[0].rstrip("/")) for b, h in rows]


def test_anchors_and_labelled_links(spark):
    page = "<script>var a='<a href=\"/no\">x</a>'</script><a class=x HREF='/one'>O<b>ne</b> &amp; two</a><a href=/lost>open<a title=\"t\" href=\"/two?a=1&amp;b\">\nTwo</A ><a name=n>none</a><abbr>x</abbr>"
    text = "[a](b) ![img [docs](c 'title') [](d) [e] (f) [[x](<g>)\n[multi\nline](h)](i) [![badge](j)](k)"
    rows = spark.createDataFrame([(page, text), (None, None), ("", "")], "p string, t string")
    got = rows.select(markup.html_anchors(F.col("p")).alias("a"), markup.labelled_links(F.col("t")).alias("l")).collect()
    assert [(x.href, " ".join(x.label.split())) for x in got[0].a] == [("/one", "O ne & two"), ("/two?a=1&b", "Two")]
    import re

    want = [(h.strip("<>"), label) for label, h in re.findall(r"\[([^\]]+)\]\(([^)\s]+)(?:\s+[^)]*)?\)", text)]
    assert [(x.href, x.label) for x in got[0].l] == want
    assert [list(r) for r in got[1:]] == [[[], []]] * 2


def test_long_open_markup_is_linear(spark):
    n = 200_000
    rows = spark.createDataFrame([("<a href='x'>" * n, "[" * n + "](" * 10), ("<" * n, "[x](" * n)], "p string, t string")
    assert [r[0] + r[1] for r in rows.select(F.size(markup.html_anchors(F.col("p"))), F.size(markup.labelled_links(F.col("t")))).collect()] == [0, 0]


def _found(df):
    return {(r["project"], r["url"]): (r["score"], r["kind"], list(r["evidence"])) for r in df.collect()}


def test_repository_candidates(spark):
    readme = base64.encodebytes("See [the guide](docs/intro.md), [home](https://o.dev/), [API](https://pypi.org/p) and [chat](https://discord.gg/x) [manual](mailto:a@b)".encode()).decode()
    contents = [{"type": "dir", "name": "Docs", "path": "Docs", "html_url": "https://github.com/o/r/tree/dev/Docs"}, {"type": "dir", "name": "manual", "path": "manual"}, {"type": "file", "name": "docs"}, {"type": "dir", "name": "src"}]
    rows = [
        ("p", "git+https://github.com/o/r.git", json.dumps({"html_url": "https://github.com/o/r", "default_branch": "dev", "homepage": "https://o.dev/docs/"}), json.dumps(contents), json.dumps({"content": readme})),
        ("q", "https://github.com/o/q", "not json", None, "{}"), ("r", "https://gitlab.com/o/q", "{}", json.dumps(contents), None), ("s", None, None, None, None),
        ("t", "https://github.com/o/t", None, json.dumps(contents[1:2]), None),
    ]
    df = spark.createDataFrame(rows, "project string, repository string, metadata string, contents string, readme string").withColumn("url", F.lit("clash")).withColumn("score", F.lit(1))
    assert _found(d.merged_candidates(d.repository_candidates(df))) == {
        ("p", "https://o.dev/docs"): (94, "CANONICAL_REPOSITORY_HOMEPAGE", ["VERIFIED_REPOSITORY_DECLARED_HOMEPAGE"]),
        ("p", "https://github.com/o/r/tree/dev/Docs"): (100, "CANONICAL_REPOSITORY_DOCS_DIRECTORY", ["VERIFIED_REPOSITORY_DOCS_DIRECTORY"]),
        ("p", "https://github.com/o/r/tree/dev/manual"): (100, "CANONICAL_REPOSITORY_DOCS_DIRECTORY", ["VERIFIED_REPOSITORY_DOCS_DIRECTORY"]),
        ("p", "https://github.com/o/r/docs/intro.md"): (97, "CANONICAL_REPOSITORY_README_DOCS_LINK", ["VERIFIED_REPOSITORY_README_DOCS_LINK"]),
        ("t", "https://github.com/o/t/tree/main/manual"): (100, "CANONICAL_REPOSITORY_DOCS_DIRECTORY", ["VERIFIED_REPOSITORY_DOCS_DIRECTORY"]),
    }


def test_website_candidates_and_choice(spark):
    body = "<a href='/docs'>x</a><a href='/docs#again'>y</a><a href='https://api.w.org/b?utm_source=u'>z</a><a href='https://else.net/p'>Reference</a><a href='https://x.com/docs'>docs</a><a href='/blog'>news</a>"
    sites = [("w", "https://w.org", "https://www.w.org/start", "text/html", body), ("v", "https://v.org/guide", None, None, "plain"), ("u", "https://npmjs.com/u", None, "text/html", body), (None, "https://n.org", None, None, None)]
    df = spark.createDataFrame(sites, "project string, website string, final_url string, content_type string, body string")
    llms = spark.createDataFrame([("w", "https://w.org", None, "- [D](/docs/all)\nhttps://w.org/manual/x\n[z](/zzz)"), ("u", "https://npmjs.com/u", None, "[D](/docs)")], "project string, website string, final_url string, body string")
    merged = d.merged_candidates(d.website_candidates(df).unionByName(d.llms_candidates(llms)))
    got = _found(merged)
    link = "OFFICIAL_WEBSITE_LINKS_DOCUMENTATION"
    external = (94, "OFFICIAL_WEBSITE_DOCS_LINK", [link, "EXTERNAL_DOCS_LINK_FROM_OFFICIAL_WEBSITE"])
    assert got == {
        ("w", "https://www.w.org/start"): (86, "VERIFIED_OFFICIAL_WEBSITE_ROOT", ["VERIFIED_PROJECT_WEBSITE"]),
        ("w", "https://www.w.org/docs"): (96, "OFFICIAL_WEBSITE_DOCS_LINK", [link, "RELATED_DOCUMENTATION_HOST"]),
        ("w", "https://api.w.org/b"): external, ("w", "https://else.net/p"): external,
        ("w", "https://w.org/docs/all"): (98, "OFFICIAL_WEBSITE_LLMS_DOCS_LINK", ["OFFICIAL_WEBSITE_LLMS_TXT_DOCUMENTATION"]),
        ("w", "https://w.org/manual/x"): (98, "OFFICIAL_WEBSITE_LLMS_DOCS_LINK", ["OFFICIAL_WEBSITE_LLMS_TXT_DOCUMENTATION"]),
        ("v", "https://v.org/guide"): (92, "VERIFIED_OFFICIAL_WEBSITE_ROOT", ["VERIFIED_PROJECT_WEBSITE"]),
        (None, "https://n.org/"): (86, "VERIFIED_OFFICIAL_WEBSITE_ROOT", ["VERIFIED_PROJECT_WEBSITE"]),
    }
    redirects = spark.createDataFrame([("https://W.org/docs/all/", "https://w.org/new"), ("https://w.org/new", "https://w.org/newest"), ("https://v.org/guide", "https://v.org/b"), ("https://v.org/b", "https://v.org/guide")], "url string, target string")
    chosen = {r["project"]: r for r in d.selected_candidates(merged, redirects).collect()}
    assert set(chosen) == {"w", None} and chosen["w"]["url"] == "https://w.org/newest" and chosen["w"]["evidence"][-1] == "TARGET_REDIRECT_CANONICALIZED"
    assert {r["project"]: r["url"] for r in d.selected_candidates(merged).collect()} == {"w": "https://w.org/docs/all", "v": "https://v.org/guide", None: "https://n.org/"}
    assert d.selected_candidates(merged.limit(0), redirects.limit(0)).count() == 0


def test_ties_keep_all_evidence(spark):
    rows = [("p", "u", 94, "B", ["b", "c"], 4, 1), ("p", "u", 94, "A", ["a", "b"], 0, 0), ("p", "u", 94, "B", ["b", "c"], 4, 0), ("p", "u", 90, "C", ["d"], 0, 0)]
    df = spark.createDataFrame(rows, "project string, url string, score int, kind string, evidence array<string>, surface int, place int")
    assert _found(d.merged_candidates(df)) == {("p", "u"): (94, "A", ["a", "b", "c"])}


def test_redirects_follow_thirty_hops(spark):
    chain = [(f"c{i}", f"c{i + 1}") for i in range(40)] + [("x", "y"), ("y", "z"), ("z", "x"), ("in", "x"), ("s", "s"), ("m", "n2"), ("m", "n1"), (None, "a"), ("b", None)]
    got = {r["url"]: (r["end"], r["hops"]) for r in d.redirect_ends(spark.createDataFrame(chain, "url string, target string")).collect()}
    for i in range(40):
        assert got[f"c{i}"][0] == ("c40" if 40 - i <= 30 else None)
    assert all(got[k][0] is None for k in ("x", "y", "z", "in")) and got["m"] == ("n1", 1) and "s" not in got and "b" not in got


def test_trust_is_the_fixpoint(spark):
    rnd = random.Random(5)
    links = [(f"n{rnd.randrange(60)}", f"n{rnd.randrange(60)}", rnd.choice([90, 95, 97, 99, 100, 130, -5])) for _ in range(260)] + [(None, "n1", 99), ("n1", None, 99), ("n1", "n2", None)]
    seeds = [("n0", 100), ("n0", 90), ("n7", 95), ("n8", 40), (None, 100), ("alone", 99)]
    best = {}
    for n, s in seeds:
        if n and s >= 85:
            best[n] = max(best.get(n, 0), s)
    changed = True
    while changed:
        changed = False
        for a, b, w in links:
            if a in best and b and w is not None and a != b:
                s = best[a] * min(max(w, 0), 100) // 100
                if s >= 85 and s > best.get(b, 0):
                    best[b], changed = s, True
    got = d.carried_trust(spark.createDataFrame(seeds, "node string, score int"), spark.createDataFrame(links, "src string, dst string, weight int"))
    assert {r["node"]: r["score"] for r in got.collect()} == best
    assert d.carried_trust(spark.createDataFrame([], "node string, score int"), spark.createDataFrame(links, "src string, dst string, weight int")).count() == 0
    line = spark.createDataFrame([(f"l{i}", f"l{i + 1}", 100) for i in range(6)], "src string, dst string, weight int")
    with pytest.raises(RuntimeError):
        d.carried_trust(spark.createDataFrame([("l0", 100)], "node string, score int"), line, most_rounds=3)
