"""The ``opN_`` queries: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weirlake.functions.bind import let
from weirlake.llm.common import UPPER, few, saved, scratch
from weirlake.llm.decontaminate import contaminated
from weirlake.llm.exact_dedup import exact_dedup
from weirlake.llm.langid import identify_languages
from weirlake.llm.mixing import mix_sources
from weirlake.llm.near_dedup import near_duplicates
from weirlake.llm.packing import pack
from weirlake.llm.periods import periodic_runs
from weirlake.llm.pii import find_pii
from weirlake.llm.quality import score_quality
from weirlake.llm.ranking import TERM, build_index, search
from weirlake.llm.secrets import BASE, MORE, find_secrets, written
from weirlake.llm.tokens import count_tokens
from weirlake.llm.url_filter import filter_urls


def _vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("found")).alias("spans"),
    )


def _op2_sql() -> str:
    """Spans from the lengths of matches and of the texts between them, for each rule by itself."""

    def spans(n: int, rule) -> str:
        p = rule.regex.replace("'", "''")
        kept = f"WHERE length(v) >= {rule.least}" if rule.least else ""
        return f"""
        SELECT doc_id, {n} AS o, '{rule.kind}' AS kind, s, e FROM (
            SELECT doc_id, vs[i] AS v,
                   coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s,
                   s + length(ms[i]) AS e
            FROM (SELECT doc_id, gaps, ms, vs, unnest(range(1, len(ms) + 1)) AS i FROM (
                SELECT doc_id, string_split_regex(text, '{p}') AS gaps, regexp_extract_all(text, '{p}', 0) AS ms, regexp_extract_all(text, '{p}', {rule.group}) AS vs
                FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents) WHERE regexp_matches(text, '{p}')))
        ) {kept}"""

    every = " UNION ALL ".join(spans(n, r) for n, r in enumerate([*BASE, *MORE]))
    name = "kind || ':' || s::BIGINT || ':' || e::BIGINT"
    return f"""
WITH found AS ({every}),
by_doc AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
           string_agg({name}, ',' ORDER BY s, o) FILTER (o < {len(BASE)}) AS base, string_agg({name}, ',' ORDER BY s, o) AS spans
    FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN by_doc b ON d.doc_id = b.doc_id
"""


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")),
        F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("found")).alias("spans"),
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
        "n_near", F.array_join("near_items", ",").alias("near_items"),
    )


OP6_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
    SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
    SELECT DISTINCT item_id, list_aggregate(w[i:i + 9], 'string_agg', ' ') AS win, least(10, len(w)) AS n
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
grams AS (
    SELECT doc_id, i, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS win
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n)),
hits AS (SELECT doc_id, i, g.n, item_id FROM grams g JOIN wins v ON g.win = v.win AND g.n = v.n),
counted AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
term_counts AS (SELECT term, count(*) AS c FROM (SELECT unnest(w) AS term FROM d) GROUP BY term),
listed AS (SELECT item_id, win, n, string_split(win, ' ') AS ws FROM wins),
offsets AS (SELECT item_id, win, n, ws, unnest(range(1, n + 1)) AS o FROM listed),
ranked AS (SELECT item_id, win, n, any_value(ws) AS ws, count(c) AS known, min(struct_pack(c := c, o := o)) AS rarest FROM offsets LEFT JOIN term_counts ON term = ws[o] GROUP BY item_id, win, n),
anchors AS (SELECT item_id, ws, ws[rarest.o] AS term FROM ranked WHERE known = n),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d),
close AS (
    SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM (SELECT doc_id, w, p, w[p] AS term FROM places) JOIN anchors USING (term)
    WHERE list_has_all(w[greatest(p - 9, 1):p + 9], ws)),
near AS (SELECT doc_id, count(*) AS n_near, string_agg(item, ',' ORDER BY item) AS near_items FROM close GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       coalesce(n_near, 0) AS n_near, coalesce(near_items, '') AS near_items
FROM d LEFT JOIN counted USING (doc_id) LEFT JOIN items USING (doc_id) LEFT JOIN near USING (doc_id)
"""


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(_table(spark, sf_dir, "documents"), _vocabulary())


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, _table(spark, sf_dir, "documents"), words=3, percent=85)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), _vocabulary())


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, _table(spark, sf_dir, "documents"))


OP10_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""

def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    with scratch(spark, "ranking-best", "ranking-queries", "ranked-items"):
        found = search(build_index(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "benchmark"))
        return saved(found, "ranked-items", few(found.count(), 250_000))


OP11_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{TERM}') AS w FROM documents),
b AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{TERM}')) AS term FROM benchmark),
n AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_words FROM d WHERE len(w) > 0),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM d) GROUP BY doc_id, term),
df AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, n GROUP BY term),
q AS (SELECT item_id, term, count(*) AS c FROM b GROUP BY item_id, term),
m AS (SELECT doc_id, 75 + (25 * len(w) * n_docs) // n_words AS m FROM d, n WHERE len(w) > 0),
scored AS (
    SELECT item_id, doc_id, sum(c * df.w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
    FROM q JOIN tf USING (term) JOIN df USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""


def looped(text: Column, row_id: Column) -> Column:
    """The text of a tenth of all rows with a repeated block: from a word on, the words from there to a period later, again and again.

    Which rows, where and which period follow from the crc32 of the id. Other texts, those without words and those of null ids stay.
    """
    hashed = F.crc32(row_id.cast("string").cast("binary"))
    g = F.floor(hashed / 10)

    def loop(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (F.lit(1) + F.floor((n - a) / (g % 8 + 3))).cast("int")
        block = F.slice(words, a + 1, p)
        rest = F.slice(F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
        return F.when(n > 0, F.array_join(F.concat(F.slice(words, F.lit(1), a), rest), " ")).otherwise("")

    return F.when(hashed % 10 == 0, let(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)), loop)).otherwise(text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = periodic_runs(docs.select("doc_id", looped(F.col("text"), F.col("doc_id")).alias("text")))
    every = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"].cast("string"), F.lit("\n")))), "")
    best = F.col("strongest")
    out = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(every, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    return saved(out, "periodic-runs")


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


OP13_SQL = r"""
WITH d AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
           md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, 3 * source_size AS cap, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight FROM s),
levels AS (
    SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER (lower ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words_left,
           sum(weight) OVER (lower ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
    FROM w WINDOW lower AS (ORDER BY cap::DOUBLE / weight, source)),
capped AS (SELECT *, cap * open <= words_left * weight AS is_capped FROM levels),
level AS (
    SELECT sum(source_size) - coalesce(sum(cap) FILTER (is_capped), 0) AS words_left, coalesce(sum(weight) FILTER (NOT is_capped), 1) AS open FROM capped),
targets AS (
    SELECT source, source_size, CASE WHEN is_capped THEN cap::DOUBLE ELSE level.words_left::DOUBLE * weight / level.open::DOUBLE END AS target FROM capped, level),
parts AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole, floor(target - whole * source_size)::BIGINT AS rest FROM targets),
placed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key ROWS UNBOUNDED PRECEDING) AS upto FROM d)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN upto <= rest OR upto - size <= rest AND 2 * upto - size <= 2 * rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed JOIN parts ON placed.source IS NOT DISTINCT FROM parts.source
"""

QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_secret_scans": op2_secret_scans,
    "op3_pii": op3_pii,
    "op4_language_id": op4_language_id,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_decontamination": op6_decontamination,
    "op7_token_counts": op7_token_counts,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_lexical_search": op11_lexical_search,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_source_mix": op13_source_mix,
}

ORACLES = {
    "op2_secret_scans": _op2_sql(),
    "op6_decontamination": OP6_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op11_lexical_search": OP11_SQL,
    "op13_source_mix": OP13_SQL,
}
