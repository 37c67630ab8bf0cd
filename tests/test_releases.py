"""Splits, mixtures, samples, repeated lines, hash trees, stages, releases and review on small, awkward tables."""

import collections
import hashlib
import json
import random

import pytest
from conftest import SF
from pyspark.sql import functions as F

from weirlake.operators import lines, merkle, mixture, release, review, sampling, splits
from weirlake.plans import releases

# --- components and splits ------------------------------------------------------------------------


def joined_by_hand(links):
    least = {}

    def find(x):
        while least.setdefault(x, x) != x:
            x = least[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            least[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(least)}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "cliques", "odd", "none"])
def test_components(spark, shape):
    rng = random.Random(4)
    links = {
        "chain": [(i, i + 1) for i in range(300)], "star": [(500, i) for i in range(0, 1000) if i != 500], "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(220)],
        "cliques": [(c * 10 + i, c * 10 + j) for c in range(20) for i in range(6) for j in range(i)], "odd": [(None, 1), (2, None), (3, 3), (9, 5), (5, 9), (9, 5), (-4, 9)], "none": [],
    }[shape]
    rng.shuffle(links)
    got = splits.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert len(got) == len({r.node for r in got})
    assert {r.node: r.component for r in got} == joined_by_hand(links)


def test_links_of_keys(spark):
    rows = spark.createDataFrame([(5, "x", "p"), (3, "x", "q"), (9, "x", "q"), (1, None, "z"), (None, "x", "q"), (7, "y", None), (3, "x", "q")], "id long, k1 string, k2 string")
    assert {tuple(r) for r in splits.links_of_keys(rows, "id", "k1", "k2").collect()} == {(5, 3), (9, 3)}


def test_splits_keep_clusters_together(spark):
    rng = random.Random(8)
    rows = [(i, i % 7) for i in range(3000)] + [(None, 0), (12, 3)]
    links = [(rng.randrange(3000), rng.randrange(3000)) for _ in range(900)]
    docs, joined = spark.createDataFrame(rows, "doc_id long, bucket int"), spark.createDataFrame(links, "a long, b long")
    got = splits.assign_splits(docs, joined)
    of = joined_by_hand(links)
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        cluster = of.get(r.doc_id, r.doc_id)
        text = "" if cluster is None else str(cluster)
        bucket = int(hashlib.sha256(text.encode()).hexdigest()[:8], 16) % 10_000
        assert (r.cluster_id, r.bucket) == (cluster, bucket)
        assert r.split == ("train" if bucket < 9_800 else "validation" if bucket < 9_900 else "test")
    assert splits.split_leaks(got, joined).count() == 0
    alone = splits.assign_splits(docs, joined.limit(0))
    assert splits.split_leaks(alone, joined).count() > 0
    shares = {r.split: r.share for r in splits.split_shares(alone).collect()}
    assert abs(shares["train"] - 0.98) < 0.01 and sum(shares.values()) == pytest.approx(1)
    assert splits.assign_splits(docs.limit(0), joined).count() == 0
    with pytest.raises(ValueError, match="add up"):
        splits.assign_splits(docs, joined, shares={"train": 1})


# --- samples and mixtures -------------------------------------------------------------------------


def test_stratified_sample_is_exact_and_the_same_however_dealt(spark):
    rows = [(i, "big" if i % 3 else f"s{i % 5}") for i in range(900)] + [(None, None), (1, "twin"), (1, "twin"), (1, "twin")]
    df = spark.createDataFrame(rows, "id long, s string")
    there = collections.Counter(s for _, s in rows)
    takes = [sampling.stratified(df.repartition(n), F.col("s"), 2, sampling.hash_key(5, F.col("id"))) for n in (1, 9)]
    for got in takes:
        assert {r.stratum: r["count"] for r in got.groupBy("stratum").count().collect()} == {s: min(n, 2) for s, n in there.items()}
    assert len({tuple(sorted(map(repr, got.collect()))) for got in takes}) == 1
    other = sampling.stratified(df, F.col("s"), 2, sampling.hash_key(6, F.col("id")))
    assert sorted(map(repr, other.collect())) != sorted(map(repr, takes[0].collect()))
    assert sampling.stratified(df.limit(0), F.col("s"), 2, sampling.hash_key(5, F.col("id"))).count() == 0


def test_sample_of_few_digits(spark, monkeypatch):
    """Rounds go down to single rows whatever a round settles."""
    monkeypatch.setattr(sampling, "DIGITS", 1)
    df = spark.range(2_000).select("id", F.lit("one").alias("s"))
    assert sampling.stratified(df, F.col("s"), 777, sampling.hash_key(5, F.col("id"))).count() == 777


def test_amounts_stay_within_quotas(spark):
    rng = random.Random(2)
    rows = [(f"g{i % 4}", i, rng.randrange(0, 50)) for i in range(800)]
    df = spark.createDataFrame(rows, "group_id string, id long, amount long").withColumn("key", sampling.hash_key(1, F.col("id")))
    df.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.checkpoint.dir')}/amounts")
    df = spark.read.parquet(path)
    quotas = {"g0": 0, "g1": 500, "g2": 10**9}
    got = sampling.within(df, spark.createDataFrame(list(quotas.items()), "group_id string, quota long"))
    taken = {r[0]: r[1] for r in got.groupBy("group_id").agg(F.sum("amount")).collect()}
    assert taken.get("g0", 0) == 0 and 500 - 50 < taken["g1"] <= 500 and taken["g2"] == sum(a for g, _, a in rows if g == "g2") and "g3" not in taken


def test_mixture_caps_hold(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["law", "law", "law", "health", None]), rng.choice(["hot"] * 4 + ["a", "b", None]), "x" * rng.randrange(0, 200)) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, domain string, source string, text string")
    budget = 60_000
    plan = mixture.Mixture(budget, 1, {"law": 2}, {"law": 400_000}, {"hot": 250_000}, source_cap=300_000, seed=4)
    chosen, report = mixture.mixed(docs, plan, F.col("domain"), F.col("source"), F.char_length("text"), F.col("doc_id"))
    got = chosen.collect()
    assert len({r.doc_id for r in got}) == len(got) and chosen.columns[0] == "doc_id" and "text" in chosen.columns
    of = lambda k: collections.Counter({v: sum(r.amount for r in got if r[k] == v) for v in {r[k] for r in got}})
    assert of("domain")["law"] <= 0.4 * budget and of("source")["hot"] <= 0.25 * budget and all(v <= 0.3 * budget for v in of("source").values())
    assert 0.6 * budget < sum(r.amount for r in got) <= budget
    rep = report.collect()
    assert all(r.taken_amount <= r.quota for r in rep) and sum(r.taken_documents for r in rep) == len(got) and sum(r.share for r in rep) == pytest.approx(1, abs=1e-4)
    again = mixture.mixed(docs.repartition(7), plan, F.col("domain"), F.col("source"), F.char_length("text"), F.col("doc_id"))[0]
    assert {r.doc_id for r in again.collect()} == {r.doc_id for r in got}
    none, empty = mixture.mixed(docs.limit(0), plan, F.col("domain"), F.col("source"), F.char_length("text"), F.col("doc_id"))
    assert none.count() == 0 and empty.count() == 0


@pytest.mark.parametrize(("budget", "most", "weights"), [(100, [10, 80, 80], [5, 2, 1]), (1000, [1, 2, 3], [1, 1, 1]), (0, [5, 5], [1, 2]), (90, [100, 100, 100], [1, 1, 1]), (10**15, [10**15, 7, 0], [3, 2, 1])])
def test_water_filled(spark, budget, most, weights):
    rows = spark.createDataFrame(list(enumerate(zip(most, weights, strict=True))), "i int, x struct<most:long,weight:long>").select("i", "x.most", "x.weight")
    got = {r.i: r.quota for r in mixture.water_filled(rows, budget).collect()}
    assert all(0 <= got[i] <= m for i, m in enumerate(most)) and sum(got.values()) <= budget
    assert sum(got.values()) >= min(budget, sum(most)) - len(most)


# --- lines ----------------------------------------------------------------------------------------


def test_repeated_lines(spark):
    head, foot = "Home | News | Contact", "page {} of 90"
    rows = [(i, f"{head}\r\nbody of {'abcdefghijkl'[i]}\n\n{foot.format(i)}") for i in range(12)] + [(50, "own text\nalone"), (51, None), (52, ""), (None, f"{head}\nno id"), (3, f"other\n {head}  "), (53, f"{head}\n{head}\nx"), (54, "tiny\ntiny"), (54, "tiny\ntiny")]
    df = spark.createDataFrame([(*r, "s", 7) for r in rows], "doc_id long, text string, _mark string, _told int")
    got = lines.without_repeated_lines(df, "doc_id", least=5).collect()
    by = {(r.doc_id, r.removed_lines, r.text) for r in got}
    assert len(got) == len(rows) and {c for c in got[0].asDict()} == {"doc_id", "text", "_mark", "_told", "removed_lines"}
    for i in range(12):
        assert (i, 2, f"body of {'abcdefghijkl'[i]}\n") in by
    assert {(50, 0, "own text\nalone"), (51, 0, None), (52, 0, ""), (None, 1, "no id"), (3, 1, "other"), (53, 2, "x"), (54, 0, "tiny\ntiny")} <= by
    apart = lines.without_repeated_lines(df.withColumn("scope", F.col("doc_id") % 4), "doc_id", least=5, scope=F.col("scope"))
    assert apart.filter("removed_lines > 0").count() == 0
    assert lines.without_repeated_lines(df.limit(0), "doc_id").count() == 0
    with pytest.raises(ValueError, match="already"):
        lines.without_repeated_lines(df, "doc_id", removed="_MARK")


def test_line_of_a_third_of_all_rows_is_summed_before_it_moves(spark):
    plan = lines.line_frequencies(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and plan.index("Exchange") < plan.index("partial_count")


@pytest.mark.parametrize(("text", "want"), [
    ("agri-\nculture", "agriculture"), ("agri- \r\n culture", "agriculture"), ("Abidjan-\nPlateau", "Abidjan-\nPlateau"), ("1-\nabc", "1-\nabc"), ("a -\nb", "a -\nb"), ("é­\nté", "été"), ("co‐\nop", "coop"), ("x-\n\ny", "x-\n\ny"), ("", ""),
])
def test_hyphens(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(lines.joined_hyphens(F.col("t"))).first()[0] == want


# --- hash trees, stages, releases -----------------------------------------------------------------


def test_tree_tells_tables_apart_and_nothing_else(spark):
    rows = [(i, f"t{i % 50}" if i % 9 else None, [i, None], b"\x00\x01", {"k": i}) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, text string, xs array<long>, raw binary, m map<string,long>")
    root = lambda x: merkle.root_of(merkle.tree(x))
    assert root(df) == root(df.repartition(5).orderBy(F.rand(3)).select(*reversed(df.columns)))
    assert root(df)[1] == 400
    others = [df.limit(399), df.unionByName(df.limit(1)), df.withColumn("text", F.coalesce("text", F.lit(""))), df.withColumn("text", F.coalesce("text", F.lit("n"))), df.withColumn("id", F.when(F.col("id") != 7, F.col("id")).otherwise(8)), df.limit(0)]
    assert len({root(x) for x in [df, *others]}) == 7
    assert root(df.limit(0)) == (hashlib.sha256(b"").hexdigest(), 0)
    swapped = spark.createDataFrame([("ab", "c")], "a string, b string"), spark.createDataFrame([("a", "bc")], "a string, b string")
    assert root(swapped[0]) != root(swapped[1])


def test_changed_rows(spark):
    old = spark.range(500).select("id", (F.col("id") * 3).alias("v"))
    new = old.filter("id <> 5").withColumn("v", F.when(F.col("id") == 9, -1).otherwise(F.col("v"))).unionByName(spark.createDataFrame([(900, 1)], "id long, v long"))
    assert {tuple(r) for r in merkle.changed_rows(new, old, "id").collect()} == {(5, "removed"), (9, "changed"), (900, "added")}
    assert merkle.differing_leaves(merkle.tree(old), merkle.tree(new)).count() <= 4
    assert merkle.changed_rows(old, old, "id").count() == 0
    assert merkle.changed_rows(old, old.limit(0), "id").count() == 500


def test_killed_run_redoes_only_what_did_not_end(spark, tmp_path):
    ran = []

    def step(name, f, fail=()):
        def run(d):
            ran.append(name)
            if ran.count(name) in fail:
                # As a run that is killed leaves it: some files, no success, no manifest.
                f(d).write.mode("overwrite").parquet(f"{tmp_path}/half")
                raise RuntimeError("killed")
            return f(d)

        return run

    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string")
    stages = [
        release.Stage("even", step("even", lambda d: d.filter("doc_id % 2 = 0"))), release.Stage("upper", step("upper", lambda d: d.withColumn("text", F.upper("text")), fail=(1,)), {"case": "upper"}), release.Stage("few", step("few", lambda d: d.filter("doc_id < 10"))),
    ]
    with pytest.raises(RuntimeError, match="killed"):
        release.run_stages(docs, stages, str(tmp_path / "run"))
    assert ran == ["even", "upper"]
    out, manifests = release.run_stages(docs.repartition(3), stages, str(tmp_path / "run"))
    assert ran == ["even", "upper", "upper", "few"]
    assert [m["resumed"] for m in manifests] == [True, False, False]
    assert [(m["input_docs"], m["output_docs"], m["rejected_docs"]) for m in manifests] == [(40, 20, 20), (20, 20, 0), (20, 5, 15)]
    assert sorted(r.text for r in out.collect()) == sorted(f"TEXT {i}" for i in (0, 2, 4, 6, 8))
    assert all(m["resumed"] for m in release.run_stages(docs, stages, str(tmp_path / "run"), thorough=True)[1])
    # Another configuration redoes its stage; a result that did not change lets the next one resume.
    stages[1].config = {"case": "upper", "note": 1}
    assert [m["resumed"] for m in release.run_stages(docs, stages, str(tmp_path / "run"))[1]] == [True, False, True]
    # A result without its success mark, or with other files, does not count.
    home = tmp_path / "run" / "few" / manifests[2]["key"] / "data"
    (home / "_SUCCESS").unlink()
    assert [m["resumed"] for m in release.run_stages(docs, stages, str(tmp_path / "run"))[1]] == [True, True, False]
    next(home.glob("part-*.parquet")).unlink()
    assert [m["resumed"] for m in release.run_stages(docs, stages, str(tmp_path / "run"))[1]] == [True, True, False]
    # Other rows are other work.
    assert [m["resumed"] for m in release.run_stages(docs.filter("doc_id <> 4"), stages, str(tmp_path / "run"))[1]] == [False, False, False]


def test_thorough_resume_finds_altered_rows(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string").coalesce(1)
    stage = [release.Stage("same", lambda d: d)]
    _, (said,) = release.run_stages(docs, stage, str(tmp_path))
    home = tmp_path / "same" / said["key"]
    manifest = json.loads((home / "manifest.json").read_text())
    (home / "manifest.json").write_text(json.dumps(manifest | {"output_root": "0" * 64}))
    (home / ".manifest.json.crc").unlink(missing_ok=True)
    assert release.run_stages(docs, stage, str(tmp_path))[1][0]["resumed"]
    assert not release.run_stages(docs, stage, str(tmp_path), thorough=True)[1][0]["resumed"]


def test_release_is_immutable_and_verified(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}", "en" if i % 2 else None, f"s{i % 3}", "train" if i % 5 else "test") for i in range(60)], "doc_id long, text string, lang string, source string, split string")
    ask = lambda d, **more: release.publish(d, str(tmp_path), "r1", "split", F.col("lang"), F.col("source"), F.char_length("text"), **more)
    said = ask(docs, config={"a": 1}, rejected=4, seed=9)
    assert (said["documents"], said["rejected_documents"], said["splits"]["test"]["documents"]) == (60, 4, 12) and said["shards"] == spark.read.parquet(f"{tmp_path}/r1/shards.parquet").count()
    assert said["root"] == merkle.root_of(merkle.tree(docs))[0]
    assert ask(docs.repartition(2), config={"a": 1}, seed=9) == said
    for other, config in ((docs.limit(59), {"a": 1}), (docs, {"a": 2})):
        with pytest.raises(FileExistsError):
            ask(other, config=config, seed=9)
    status = lambda: collections.Counter(r.status for r in release.verify_release(spark, str(tmp_path), "r1", docs.schema).collect())
    assert status() == {"ok": said["shards"]}
    files = sorted((tmp_path / "r1" / "data" / "split=train").glob("part-*.parquet"))
    files[0].unlink()
    docs.limit(1).drop("split").coalesce(1).write.mode("append").parquet(str(tmp_path / "r1" / "data" / "split=train"))
    assert status() == {"ok": said["shards"] - 1, "missing": 1, "unknown": 1}
    # Without its manifest a release did not end, and is replaced.
    (tmp_path / "r1" / "manifest.json").unlink()
    assert ask(docs.limit(10))["documents"] == 10 and set(status()) == {"ok"}


# --- review ---------------------------------------------------------------------------------------


def test_thresholds_by_hand(spark):
    rng = random.Random(6)
    rows = []
    for domain, n in (("a", 400), ("b", 300), ("few", 20), (None, 50)):
        for _ in range(n):
            s = rng.randrange(0, 100) * 100
            rows.append((domain, s, rng.random() * 10_000 < s if domain != "b" else rng.random() < 0.5))
    rows += [("a", None, True), ("a", 5, None)]
    got = {(r.domain, r.rest): (r.pass_at, r.drop_at, r.labelled) for r in review.fitted_thresholds(spark.createDataFrame(rows, "domain string, score long, good boolean"), 0.9, 100).collect()}
    want = {}
    for key, own in {("a", False): [r for r in rows if r[0] == "a"], ("b", False): [r for r in rows if r[0] == "b"], (None, True): rows}.items():
        own = [(s, g) for _, s, g in own if s is not None and g is not None]
        share = lambda x, good: sum(g is good for _, g in x) / len(x)
        passes = [s for s in {s for s, _ in own} if share([x for x in own if x[0] >= s], True) >= 0.9]
        drops = [s for s in {s for s, _ in own} if (below := [x for x in own if x[0] < s]) and share(below, False) >= 0.9]
        at = min(passes, default=None)
        drop = max(drops, default=None)
        want[key] = (at, drop if at is None else at if drop is None else min(drop, at), len(own))
    assert got == want


def test_metrics_and_decisions(spark):
    texts = [None, "", "word " * 60, "The river ran past the old mill and the people there spoke of the harvest, of rain and of the road to the sea that nobody had built yet.", "$$$ ### @@@ !!!", "line\nline\nline\nline", "see http://a.b http://c.d", "bad � char"]
    rows = review.with_metrics(spark.createDataFrame([(i, t, "en", 5) for i, t in enumerate(texts)], "doc_id long, text string, domain string, extra int")).withColumn("score", review.score())
    by = {r.doc_id: r for r in rows.collect()}
    assert (by[0].n_words, by[0].score, by[1].letters, by[2].distinct_words, by[2].repeated_pairs) == (0, 0, 0, 166, 9830)
    assert by[5].repeated_lines == 7500 and by[6].links == 6666 and by[7].broken == 1000 and by[3].score > 8500 > by[2].score
    at = spark.createDataFrame([("en", False, 8000, 5000, 9), (None, True, None, None, 9)], "domain string, rest boolean, pass_at long, drop_at long, labelled long")
    got = {r.doc_id: (r.decision, r.reasons) for r in review.decided(rows, at).collect()}
    assert got[0] == got[1] == ("DROP", ["EMPTY"]) and got[3] == ("PASS", []) and "FEW_DISTINCT_WORDS" in got[2][1] and "MANY_SYMBOLS" in got[4][1] and got[4][0] == "DROP"
    none = {r.doc_id: r.decision for r in review.decided(rows.withColumn("domain", F.lit("fr")), at).collect()}
    assert none[0] == "DROP" and set(none.values()) == {"DROP", "REVIEW"} and none[3] == "REVIEW"


def test_precision_on_rows_that_nothing_was_fitted_to(spark):
    found = {r.decision: (r.labelled, r.good_share) for r in releases.quality_precision(spark, "/root/testdata/sf0.01").collect()}
    assert found["PASS"][0] >= 50 and found["PASS"][1] >= 0.97
    assert found["DROP"][1] <= 0.03


def test_resumed_stages_get_rows_in_parts_of_bounded_size(spark, monkeypatch):
    """Rows dealt otherwise are not dealt by a few languages."""
    confs, given = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}, []
    real = releases.release.run_stages
    monkeypatch.setattr(releases.release, "run_stages", lambda rows, *rest: given.append(rows) or real(rows, *rest))
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        releases.stages_resumed(spark, SF)
        parts = collections.Counter(r.part for r in given[1].withColumn("part", F.spark_partition_id()).collect()).values()
    finally:
        for k in confs:
            spark.conf.unset(k)
    assert max(parts) < sum(parts) / 4
