"""Making a corpus release over the driver's tables: cleaning, review, splits, mixture, samples, digests and manifests."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirlake.operators import lines, merkle, mixture, release, review, sampling, splits
from weirlake.operators.staging import shared_dir, staged
from weirlake.plans import tables as t
from weirlake.plans.registered import query

# Documents that begin or end with the same eight words belong together here.
LINKS_SQL = """
w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9]+') AS w FROM documents),
k AS (SELECT doc_id, 'h ' || array_to_string(w[1:8], ' ') AS key FROM w WHERE len(w) >= 16 UNION ALL SELECT doc_id, 't ' || array_to_string(w[-8:], ' ') FROM w WHERE len(w) >= 16),
links AS (SELECT DISTINCT k.doc_id AS a, m.b FROM k JOIN (SELECT key, min(doc_id) AS b FROM k GROUP BY key) m USING (key) WHERE k.doc_id <> m.b),
ends AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT ends.b, reach.c FROM reach JOIN ends ON reach.id = ends.a),
clusters AS (SELECT id AS doc_id, min(c) AS cluster_id FROM reach GROUP BY id),
assigned AS (SELECT *, CASE WHEN bucket < 9800 THEN 'train' WHEN bucket < 9900 THEN 'validation' ELSE 'test' END AS split
    FROM (SELECT *, (('0x' || substr(sha256(cluster_id::VARCHAR), 1, 8))::BIGINT % 10000)::INTEGER AS bucket FROM clusters)),
alone AS (SELECT *, CASE WHEN bucket < 9800 THEN 'train' WHEN bucket < 9900 THEN 'validation' ELSE 'test' END AS split
    FROM (SELECT doc_id, (('0x' || substr(sha256(doc_id::VARCHAR), 1, 8))::BIGINT % 10000)::INTEGER AS bucket FROM documents))
"""


def _links(spark, sf_dir):
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit("[A-Za-z0-9]+"), F.lit(0))
    docs = t.table(spark, sf_dir, "documents").select("doc_id", words.alias("w")).filter("size(w) >= 16")
    joined = lambda part: F.array_join(F.slice("w", *part), " ")
    keys = staged(docs.select("doc_id", joined((F.lit(1), F.lit(8))).alias("head"), joined((F.lit(-8), F.lit(8))).alias("tail")), "link-keys")
    return staged(splits.links_of_keys(keys, "doc_id", "head", "tail"), "links")


@query("corpus_splits", f"WITH RECURSIVE {LINKS_SQL} SELECT doc_id, cluster_id, bucket, split FROM assigned")
def corpus_splits(spark, sf_dir):
    return splits.assign_splits(t.table(spark, sf_dir, "documents"), _links(spark, sf_dir))


@query("split_shares", f"""WITH RECURSIVE {LINKS_SQL} SELECT split, count(*) AS "rows", count(DISTINCT cluster_id) AS clusters, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM assigned GROUP BY split""")
def split_shares(spark, sf_dir):
    return splits.split_shares(splits.assign_splits(t.table(spark, sf_dir, "documents"), _links(spark, sf_dir)))


@query("split_leaks", f"""WITH RECURSIVE {LINKS_SQL},
    rules AS (SELECT 'clusters' AS rule, doc_id, split FROM assigned UNION ALL SELECT 'ids', doc_id, split FROM alone)
    SELECT x.rule, count(*) AS links, count(*) FILTER (x.split <> y.split) AS leaks FROM links JOIN rules x ON x.doc_id = a JOIN rules y ON y.doc_id = b AND x.rule = y.rule GROUP BY x.rule""")
def split_leaks(spark, sf_dir):
    """Links across parts when clusters stay together (none), and when each id is assigned for itself."""
    docs, links = t.table(spark, sf_dir, "documents"), _links(spark, sf_dir)
    none = links.limit(0)
    out = None
    for rule, with_links in (("clusters", links), ("ids", none)):
        leaks = splits.split_leaks(splits.assign_splits(docs, with_links), links)
        one = links.agg(F.count(F.lit(1)).alias("links")).crossJoin(F.broadcast(leaks.agg(F.count(F.lit(1)).alias("leaks")))).select(F.lit(rule).alias("rule"), "links", "leaks")
        out = one if out is None else out.unionByName(one)
    return out


MIX_SQL = """
d AS (SELECT doc_id, lang AS domain, source, coalesce(greatest(1, length(text) // 4), 0) AS amount, md5('{"_":7,"c0":"' || doc_id || '"}') AS key FROM documents),
b AS (SELECT sum(amount)::BIGINT // 2 AS budget FROM d),
g AS (SELECT domain, source, count(*) AS documents, sum(amount)::BIGINT AS amount FROM d GROUP BY domain, source),
s AS (SELECT source, sum(amount)::BIGINT AS everything, (CASE WHEN source = 'src0' THEN 100000 ELSE 150000 END * any_value(budget)) // 1000000 AS cap FROM g, b GROUP BY source),
o AS (SELECT g.*, CASE WHEN everything <= cap THEN amount ELSE amount * cap // greatest(everything, 1) END AS open FROM g JOIN s ON g.source IS NOT DISTINCT FROM s.source),
dm AS (SELECT domain, sum(open)::BIGINT AS total, least(sum(open)::BIGINT, CASE WHEN domain = 'en' THEN 300000 ELSE 1000000 END * any_value(budget) // 1000000) AS most, CASE domain WHEN 'en' THEN 3 WHEN 'fr' THEN 2 ELSE 1 END AS weight FROM o, b GROUP BY domain),
levels AS (SELECT *, budget - coalesce(sum(most) OVER (lower ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS still, sum(weight) OVER (lower ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM dm, b WINDOW lower AS (ORDER BY most::DOUBLE / weight, domain)),
capped AS (SELECT *, most * weights <= still * weight AS is_capped FROM levels),
level AS (SELECT any_value(budget) - coalesce(sum(most) FILTER (is_capped), 0) AS still, coalesce(sum(weight) FILTER (NOT is_capped), 1) AS weights FROM capped),
filled AS (SELECT domain, total, CASE WHEN is_capped THEN most ELSE least(most, level.still * capped.weight // level.weights) END AS dq FROM capped, level),
q AS (SELECT o.domain, o.source, documents, amount, (CASE WHEN dq >= total THEN open ELSE open * dq // greatest(total, 1) END)::BIGINT AS quota FROM o JOIN filled ON o.domain IS NOT DISTINCT FROM filled.domain),
taken AS (SELECT * FROM (SELECT d.*, quota, sum(d.amount) OVER (PARTITION BY d.domain, d.source ORDER BY key ROWS UNBOUNDED PRECEDING) AS upto FROM d JOIN q ON d.domain IS NOT DISTINCT FROM q.domain AND d.source IS NOT DISTINCT FROM q.source) WHERE upto <= quota)
"""


def _mixed(spark, sf_dir):
    docs = t.table(spark, sf_dir, "documents")
    amount = F.greatest(F.lit(1), F.expr("char_length(text) div 4"))
    amount = F.when(F.col("text").isNotNull(), amount)
    budget = docs.agg(F.coalesce(F.sum(amount), F.lit(0))).first()[0] // 2
    plan = mixture.Mixture(budget, 1, {"en": 3, "fr": 2}, {"en": 300_000}, {"src0": 100_000}, source_cap=150_000, seed=7)
    return mixture.mixed(docs.select("doc_id", "lang", "source", "text"), plan, F.col("lang"), F.col("source"), amount, F.col("doc_id"))


@query("corpus_mixture", f"WITH {MIX_SQL} SELECT doc_id, domain, source, amount FROM taken")
def corpus_mixture(spark, sf_dir):
    """Half of all text by estimated tokens, domains by weight, English at most 30 %, the largest source at most 10 %, others 15 %."""
    return _mixed(spark, sf_dir)[0].select("doc_id", "domain", "source", "amount")


@query("mixture_report", f"""WITH {MIX_SQL},
    of AS (SELECT domain, source, count(*) AS taken_documents, sum(amount)::BIGINT AS taken_amount FROM taken GROUP BY domain, source)
    SELECT q.domain, q.source, documents, q.amount, quota, coalesce(taken_documents, 0) AS taken_documents, coalesce(taken_amount, 0) AS taken_amount, coalesce(round(taken_amount / (SELECT sum(amount) FROM taken), 6), 0.0) AS share
    FROM q LEFT JOIN of ON q.domain IS NOT DISTINCT FROM of.domain AND q.source IS NOT DISTINCT FROM of.source""")
def mixture_report(spark, sf_dir):
    return _mixed(spark, sf_dir)[1]


SAMPLE_SQL = """
d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, coalesce(lang, '?') || '/' || coalesce(source, '?') AS stratum, row_number() OVER (PARTITION BY coalesce(lang, '?') || '/' || coalesce(source, '?') ORDER BY md5('{"_":3,"c0":"' || doc_id || '"}')) AS n FROM documents),
sample AS (SELECT * FROM d WHERE n <= 8)
"""


def _sample(spark, sf_dir):
    docs = t.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", F.coalesce("text", F.lit("")).alias("text"))
    stratum = F.concat_ws("/", F.coalesce("lang", F.lit("?")), F.coalesce("source", F.lit("?")))
    return sampling.stratified(docs, stratum, 8, sampling.hash_key(3, F.col("doc_id")))


@query("tokenizer_sample", f"WITH {SAMPLE_SQL} SELECT doc_id, stratum FROM sample")
def tokenizer_sample(spark, sf_dir):
    """Exactly eight documents of every domain and source (all, if fewer), whatever their sizes."""
    return _sample(spark, sf_dir).select("doc_id", "stratum")


@query("tokenizer_sample_metrics", f"""WITH {SAMPLE_SQL},
    p AS (SELECT lang, text, length(text) AS chars, strlen(text) AS bytes, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words, len(regexp_extract_all(text, '[A-Za-z]+|[0-9]|[^\\x00-\\x7F]+|[\\x21-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7E]')) AS pieces, length(regexp_replace(text, '[^0-9]', '', 'g')) AS digits FROM sample)
    SELECT lang, count(*) AS documents, sum(chars)::BIGINT AS chars, sum(bytes)::BIGINT AS bytes, sum(words)::BIGINT AS words, sum(pieces)::BIGINT AS pieces, round(sum(pieces) / greatest(sum(words), 1), 6) AS pieces_a_word, round(sum(pieces) / greatest(sum(chars), 1), 6) AS pieces_a_char,
        round(sum(digits) / greatest(sum(chars), 1), 6) AS digit_share FROM p GROUP BY lang""")
def tokenizer_sample_metrics(spark, sf_dir):
    """Fertility and coverage of the sample by domain, for a plain pre-tokenization."""
    count = lambda pattern: F.regexp_count("text", F.lit(pattern)).cast("long")
    some = _sample(spark, sf_dir).select(
        "lang", F.char_length("text").alias("chars"), F.octet_length("text").alias("bytes"), count(r"[^\x20\x09-\x0D]+").alias("words"), count(r"[A-Za-z]+|[0-9]|[^\x00-\x7F]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]").alias("pieces"), count("[0-9]").alias("digits")
    )
    ratio = lambda a, b: F.round(F.sum(a) / F.greatest(F.sum(b), F.lit(1)), 6)
    return some.groupBy("lang").agg(
        F.count(F.lit(1)).alias("documents"), *(F.sum(c).cast("long").alias(c) for c in ("chars", "bytes", "words", "pieces")), ratio("pieces", "words").alias("pieces_a_word"), ratio("pieces", "chars").alias("pieces_a_char"), ratio("digits", "chars").alias("digit_share")
    )


LINES_SQL = r"""
d AS (SELECT doc_id, source, text, string_split(replace(replace(coalesce(text, ''), chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10)) AS ls FROM documents),
p AS (SELECT doc_id, source, i, ls[i] AS line, regexp_replace(trim(regexp_replace(ls[i], '[\x09\x0B\x0C\x20\x{A0}]+', ' ', 'g'), ' '), '[0-9]+', '0', 'g') AS key FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM d)),
f AS (SELECT source AS scope, key, count(DISTINCT doc_id) AS documents FROM p WHERE length(key) >= 4 GROUP BY source, key)
"""


@query("line_frequencies", f"WITH {LINES_SQL} SELECT scope, md5(key) AS line_hash, documents FROM f")
def line_frequencies(spark, sf_dir):
    return lines.line_frequencies(t.table(spark, sf_dir, "documents"), scope=F.col("source"))


@query("repeated_lines_removed", f"""WITH {LINES_SQL},
    q AS (SELECT p.*, coalesce(documents >= 3, false) AS gone FROM p LEFT JOIN f ON p.source IS NOT DISTINCT FROM f.scope AND p.key = f.key)
    SELECT d.doc_id, md5(CASE WHEN n = 0 THEN coalesce(d.text, '') ELSE coalesce(kept, '') END) AS text_md5, n AS removed_lines
    FROM d JOIN (SELECT doc_id, count(*) FILTER (gone)::INTEGER AS n, string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone) AS kept FROM q GROUP BY doc_id) x ON d.doc_id = x.doc_id""")
def repeated_lines_removed(spark, sf_dir):
    """Lines that three or more documents of a source share go."""
    out = lines.without_repeated_lines(t.table(spark, sf_dir, "documents"), "doc_id", scope=F.col("source"), least=3)
    return out.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("text_md5"), "removed_lines")


@query("hyphens_joined", r"""SELECT doc_id, md5(regexp_replace(broken, '([\p{L}])[-­‐]\x20*\r?\n\x20*([\p{Ll}])', '\1\2', 'g')) AS joined_md5 FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '([aeiou])([a-z]) ', '\1\2-' || chr(10) || ' ', 'g') AS broken FROM documents)""")
def hyphens_joined(spark, sf_dir):
    """Texts broken after many words (a vowel, a letter, a blank), and joined again."""
    broken = F.regexp_replace(F.coalesce("text", F.lit("")), "([aeiou])([a-z]) ", "$1$2-\n ")
    return t.table(spark, sf_dir, "documents").select("doc_id", F.md5(lines.joined_hyphens(broken).cast("binary")).alias("joined_md5"))


def _encoded(*columns: str) -> str:
    return " || ".join(f"CASE WHEN {c} IS NULL THEN 'n' ELSE 's' || length({c}::VARCHAR) || ':' || {c}::VARCHAR END" for c in sorted(columns))


def _tree_sql(rows: str) -> str:
    """CTEs of a hash tree over ``rows``, a query with one column ``digest``."""
    return f"""
h AS ({rows}),
l3 AS (SELECT 3 AS level, substr(digest, 1, 3) AS node, count(*) AS "rows", sha256(count(*) || ':' || sum(('0x' || substr(digest, 4, 15))::HUGEINT) || ':' || sum(('0x' || substr(digest, 19, 15))::HUGEINT)) AS digest FROM h GROUP BY substr(digest, 1, 3)),
l2 AS (SELECT 2 AS level, substr(node, 1, 2) AS up, sum("rows")::BIGINT AS "rows", sha256(string_agg(node || '=' || digest, ',' ORDER BY node)) AS digest FROM l3 GROUP BY up),
l1 AS (SELECT 1 AS level, substr(up, 1, 1) AS up1, sum("rows")::BIGINT AS "rows", sha256(string_agg(up || '=' || digest, ',' ORDER BY up)) AS digest FROM l2 GROUP BY up1),
l0 AS (SELECT 0 AS level, '' AS node, sum("rows")::BIGINT AS "rows", sha256(string_agg(up1 || '=' || digest, ',' ORDER BY up1)) AS digest FROM l1 HAVING count(*) > 0),
nodes AS (SELECT level, node, "rows", digest FROM l3 UNION ALL SELECT level, up, "rows", digest FROM l2 UNION ALL SELECT level, up1, "rows", digest FROM l1 UNION ALL SELECT level, node, "rows", digest FROM l0)"""


DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


@query("hash_tree", f"WITH {_tree_sql(f'SELECT sha256({_encoded(*DOCUMENT)}) AS digest FROM documents')} SELECT level, node, \"rows\", digest FROM nodes")
def hash_tree(spark, sf_dir):
    return merkle.tree(t.table(spark, sf_dir, "documents"))


@query("changed_documents", """SELECT doc_id, CASE WHEN doc_id % 50 = 7 THEN 'removed' WHEN doc_id % 50 = 8 THEN 'added' ELSE 'changed' END AS change FROM documents WHERE doc_id % 50 IN (7, 8, 9)""")
def changed_documents(spark, sf_dir):
    """What became of the documents when some went, some came and some texts were altered, from their trees."""
    docs = t.table(spark, sf_dir, "documents")
    old = docs.filter("doc_id % 50 <> 8")
    new = docs.filter("doc_id % 50 <> 7").withColumn("text", F.when(F.col("doc_id") % 50 == 9, F.concat(F.coalesce("text", F.lit("")), F.lit("!"))).otherwise(F.col("text")))
    return merkle.changed_rows(new, old, "doc_id")


KEPT_SQL = "SELECT doc_id, text, lang, source, CASE WHEN b < 9800 THEN 'train' WHEN b < 9900 THEN 'validation' ELSE 'test' END AS split FROM (SELECT *, ('0x' || substr(sha256(doc_id::VARCHAR), 1, 8))::BIGINT % 10000 AS b FROM documents WHERE length(text) >= 80)"


def _stages():
    at = splits.bucket(F.col("doc_id"))
    return [
        release.Stage("long-enough", lambda d: d.filter(F.char_length("text") >= 80).select("doc_id", "text", "lang", "source"), {"shortest": 80}),
        release.Stage("split", lambda d: d.withColumn("split", splits.part_of(at, splits.SHARES)), {"shares": splits.SHARES}),
    ]


@query("stages_resumed", f"""WITH kept AS ({KEPT_SQL}) SELECT * FROM (VALUES (1, 'long-enough', false), (1, 'split', false), (2, 'long-enough', true), (2, 'split', true)) AS r(run, stage, resumed),
    (SELECT (SELECT count(*) FROM documents) AS all_docs, (SELECT count(*) FROM kept) AS output_docs) AS n""")
def stages_resumed(spark, sf_dir):
    """Two stages twice, the second time from the same rows dealt otherwise, in parts of bounded size: nothing is made again."""
    docs, folder = t.table(spark, sf_dir, "documents"), shared_dir(spark, "stages")
    n, out = docs.count(), []
    for run, rows in ((1, docs), (2, docs.hint("rebalance", "doc_id"))):
        _, manifests = release.run_stages(rows, _stages(), folder)
        out += [(run, m["stage"], m["resumed"], n, m["output_docs"]) for m in manifests]
    return spark.createDataFrame(out, "run int, stage string, resumed boolean, all_docs long, output_docs long")


@query("release_published", f"""WITH kept AS ({KEPT_SQL}), {_tree_sql(f'SELECT sha256({_encoded("doc_id", "text", "lang", "source", "split")}) AS digest FROM kept')}
    SELECT split, count(*) AS documents, sum(length(text) // 4)::BIGINT AS tokens, (SELECT digest FROM l0) AS root FROM kept GROUP BY split""")
def release_published(spark, sf_dir):
    """A release by its manifest: documents and estimated tokens by split, and the digest of all."""
    folder = shared_dir(spark, "releases")
    kept, manifests = release.run_stages(t.table(spark, sf_dir, "documents"), _stages(), f"{folder}/stages")
    said = release.publish(kept, folder, "corpus-0001", "split", F.col("lang"), F.col("source"), F.expr("char_length(text) div 4"), {"stages": [m["config_sha256"] for m in manifests]}, rejected=manifests[0]["rejected_docs"])
    return spark.createDataFrame([(k, v["documents"], v["tokens"], said["root"]) for k, v in said["splits"].items()], "split string, documents long, tokens long, root string")


@query("release_statistics", f"WITH kept AS ({KEPT_SQL}) SELECT split, lang AS domain, source, count(*) AS documents, sum(length(text) // 4)::BIGINT AS tokens FROM kept GROUP BY split, lang, source")
def release_statistics(spark, sf_dir):
    folder = shared_dir(spark, "releases")
    kept, _ = release.run_stages(t.table(spark, sf_dir, "documents"), _stages(), f"{folder}/stages")
    release.publish(kept, folder, "corpus-0001", "split", F.col("lang"), F.col("source"), F.expr("char_length(text) div 4"))
    return spark.read.parquet(f"{folder}/corpus-0001/source-stats.parquet")


METRICS_SQL = r"""
s AS (SELECT doc_id, lang, coalesce(text, '') AS s, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
metrics AS (SELECT doc_id, lang, length(s) AS n_chars, len(w) AS n_words, 10000 * length(regexp_replace(s, '[^\p{L}]', '', 'g')) // greatest(length(s), 1) AS letters, 10000 * length(regexp_replace(s, '[^0-9]', '', 'g')) // greatest(length(s), 1) AS digits,
    10000 * length(regexp_replace(s, '[\p{L}\p{N}\x09-\x0D\x20]', '', 'g')) // greatest(length(s), 1) AS symbols, 10000 * len(list_distinct(w)) // greatest(len(w), 1) AS distinct_words,
    CASE WHEN len(w) > 1 THEN 10000 * (len(w) - 1 - len(list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])))) // (len(w) - 1) ELSE 0 END AS repeated_pairs,
    10000 * (len(l) - len(list_distinct(l))) // len(l) AS repeated_lines, 10000 * len(regexp_extract_all(s, 'https?://')) // greatest(len(w), 1) AS links, 10000 * (length(s) - length(replace(s, chr(65533), ''))) // greatest(length(s), 1) AS broken FROM s),
scored AS (SELECT *, CASE WHEN n_words = 0 THEN 0 ELSE 4000 * least(letters, 8000) // 8000 + 3000 * least(distinct_words, 7000) // 7000 + 2000 - 2000 * least(symbols, 1000) // 1000 + 1000 - 1000 * least(repeated_lines, 10000) // 10000 END::BIGINT AS score FROM metrics),
labelled AS (SELECT scored.*, quality = 1 AS good, ('0x' || substr(sha256(scored.doc_id::VARCHAR), 1, 8))::BIGINT % 5 = 0 AS held_out FROM scored JOIN labels ON scored.doc_id = labels.doc_id WHERE quality IS NOT NULL),
c AS (SELECT lang AS domain, false AS rest, score, count(*) AS n, count(*) FILTER (good) AS g FROM labelled WHERE NOT held_out AND lang IS NOT NULL GROUP BY lang, score UNION ALL SELECT NULL, true, score, count(*), count(*) FILTER (good) FROM labelled WHERE NOT held_out GROUP BY score),
sums AS (SELECT *, sum(n) OVER up AS un, sum(g) OVER up AS ug, sum(n) OVER down AS dn, sum(g) OVER down AS dg FROM c
    WINDOW up AS (PARTITION BY domain, rest ORDER BY score DESC), down AS (PARTITION BY domain, rest ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
fitted AS (SELECT domain, rest, pass_at, least(drop_at, pass_at) AS drop_at, labelled FROM (
    SELECT domain, rest, min(score) FILTER (ug >= un * 0.98) AS pass_at, max(score) FILTER (dn > 0 AND dn - dg >= dn * 0.98) AS drop_at, sum(n)::BIGINT AS labelled FROM sums GROUP BY domain, rest) WHERE rest OR labelled >= 50),
decided AS (SELECT scored.*, CASE WHEN n_words = 0 THEN 'DROP' WHEN score >= coalesce(f.pass_at, CASE WHEN f.domain IS NULL THEN r.pass_at END) THEN 'PASS' WHEN score < coalesce(f.drop_at, CASE WHEN f.domain IS NULL THEN r.drop_at END) THEN 'DROP' ELSE 'REVIEW' END AS decision
    FROM scored LEFT JOIN (SELECT * FROM fitted WHERE NOT rest) f ON scored.lang = f.domain, (SELECT * FROM fitted WHERE rest) r)
"""


def _scored(spark, sf_dir):
    return review.with_metrics(t.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")).drop("text").withColumn("score", review.score())


def _review(spark, sf_dir):
    """(scored documents, labelled ones with the held-out fold, thresholds fitted to the others)."""
    rows = staged(_scored(spark, sf_dir), "scored")
    labels = t.table(spark, sf_dir, "labels").filter("quality is not null").select("doc_id", (F.col("quality") == 1).alias("good"))
    labelled = staged(rows.join(labels, "doc_id").withColumn("held_out", splits.bucket(F.col("doc_id"), 5) == 0), "labelled")
    fitted = review.fitted_thresholds(labelled.filter("not held_out").select(F.col("lang").alias("domain"), "score", "good"), 0.98, least=50)
    return rows, labelled, staged(fitted, "thresholds")


@query("quality_metrics", f"WITH {METRICS_SQL} SELECT doc_id, n_chars, n_words, letters, digits, symbols, distinct_words, repeated_pairs, repeated_lines, links, broken, score FROM scored")
def quality_metrics(spark, sf_dir):
    return _scored(spark, sf_dir).drop("lang")


@query("quality_thresholds", f"WITH {METRICS_SQL} SELECT domain, rest, pass_at, drop_at, labelled FROM fitted")
def quality_thresholds(spark, sf_dir):
    """Scores from which documents pass, and below which they are dropped, with a precision of 98 % each, by language."""
    return _review(spark, sf_dir)[2]


@query("quality_decisions", f"""WITH {METRICS_SQL} SELECT doc_id, score, decision, array_to_string(list_filter([{", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in review.REASONS)}], lambda x: x IS NOT NULL), ',') AS reasons FROM decided""")
def quality_decisions(spark, sf_dir):
    rows, _, thresholds = _review(spark, sf_dir)
    return review.decided(rows, thresholds, "lang").select("doc_id", "score", "decision", F.array_join("reasons", ",").alias("reasons"))


@query("quality_precision", f"""WITH {METRICS_SQL} SELECT decision, count(*) AS labelled, count(*) FILTER (good) AS good, round(count(*) FILTER (good) / count(*), 6) AS good_share FROM decided JOIN (SELECT doc_id, good FROM labelled WHERE held_out) USING (doc_id) GROUP BY decision""")
def quality_precision(spark, sf_dir):
    """How the decisions fare on labelled documents that no threshold was fitted to."""
    _, labelled, thresholds = _review(spark, sf_dir)
    out = review.decided(labelled.filter("held_out"), thresholds, "lang").groupBy("decision").agg(F.count(F.lit(1)).alias("labelled"), F.count_if("good").alias("good"))
    return out.withColumn("good_share", F.round(F.col("good") / F.col("labelled"), 6))
