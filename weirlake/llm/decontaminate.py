"""Benchmark decontamination over a distributed positional inverted index.

One pass counts, over all texts, the words that the benchmark uses. A benchmark window is looked up from its rarest
word on. A second pass stores that word's postings, (text, word, position, words near); a window is a candidate of the texts in which
its three rarest words stand near each other. For candidates the lists (text, word, positions) of all the window's words are
put together, moved by the words' offsets and intersected, rarest first: what is left are the places where
the window stands as an exact phrase. For proximity matches the lists are widened by a window's reach instead: what is left are
places of the rarest word with all others near, in any order. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirlake.llm.common import ascii_lower, few, may_be_among, saved, scratch, spread

#: What stands between words: any ASCII character but digits and letters.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words that one pass over the texts looks for; more take more passes.
BLOCK = 20_000
#: Windows up to which the table of their rarest words is sent to every executor; beyond, it is joined like any other.
MOST_SENT = 200_000


def with_words(rows: DataFrame, text: str = "text") -> DataFrame:
    """``rows`` with ``words`` for ``text``: A-Z lowered, null has none.

    Splitting at the gaps costs a fifth of extracting the words; a gap at either end leaves an empty string there.
    """
    split = rows.withColumn("words", F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP)).drop(text)
    first = F.when(F.get("words", F.lit(0)) == "", 1).otherwise(0)
    last = F.when(F.element_at("words", -1) == "", 1).otherwise(0)
    return split.withColumn("words", F.slice("words", first + 1, F.greatest(F.size("words") - first - last, F.lit(0))))


def each(words: str = "words"):
    """Explodes an array column without naming it as it is.

    Exploding a bare column makes Catalyst infer a filter on its size, and the filter, pushed below, computes the
    column several times over.
    """
    return F.explode(F.slice(words, 1, F.size(words)))


def windows_of(items: DataFrame, size: int) -> DataFrame:
    """(item_id, win, n): each run of ``size`` consecutive item words, or the whole of a shorter item."""
    words = with_words(items.select("item_id", "text")).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - size, F.lit(0)))
    return (
        words.select("item_id", "words", F.explode(starts).alias("at"))
        .select("item_id", F.slice("words", F.col("at") + 1, size).alias("win")).distinct()
        .withColumn("n", F.size("win"))
    )


def anchored(windows: DataFrame, docs: DataFrame) -> DataFrame:
    """(wid, win, n, items, terms, anchor): the distinct windows whose words all occur in the texts.

    ``terms`` are (count, offset, term), rarest first; ``anchor`` is the first of them.
    """
    windows = windows.groupBy("win", "n").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    windows = saved(windows.select(F.monotonically_increasing_id().alias("wid"), "win", "n", "items"), "windows", 1)
    spoken = windows.select("wid", F.posexplode("win").alias("offset", "term"))
    asked = saved(spoken.select("term").distinct(), "asked", 1)
    words = with_words(docs.select("text"))
    if asked.count() <= BLOCK:
        names = [r.term for r in asked.collect()]
        words = words.select(F.filter("words", lambda w: w.isin(names)).alias("words")) if names else words.limit(0)
    # Counted before the join, so each task sends a word once, however often its texts have it. A
    # semi-join here would be pushed below the count and send every word.
    count = words.select(each().alias("term")).groupBy("term").count()
    # The few that are asked for are brought together after they were counted, which all tasks take part in.
    known = saved(count.join(asked, "term").repartition(1), "terms")
    ranked = F.array_sort(F.collect_list(F.struct("count", "offset", "term"))).alias("terms")
    found = spoken.join(known, "term").groupBy("wid").agg(ranked).join(windows, "wid").filter(F.size("terms") == F.col("n"))
    return found.withColumn("anchor", F.col("terms")[0])


def store_postings(rows: DataFrame, windows: DataFrame, reach: int, block: int = BLOCK) -> DataFrame:
    """(doc_id, key, n_words, block, postings): each row's anchor words as (term, pos, near).

    ``near`` holds the words up to ``reach`` places before and after the posting. The anchor words are asked for in blocks of
    bounded size, a pass over the texts for each block.
    """
    terms = saved(windows.select(F.col("anchor.term").alias("term")).distinct(), "anchors", 1)
    blocks = max(1, -(-terms.count() // block))
    every = None
    for b in range(blocks):
        asked = [r.term for r in terms.filter(F.pmod(F.xxhash64("term"), F.lit(blocks)) == b).toLocalIterator()]
        found = with_words(rows.select("doc_id", "key", "text"))
        at = F.array_compact(F.transform("words", lambda w, i: F.when(w.isin(asked), i))) if asked else F.array().cast("array<int>")
        found = found.select("doc_id", "key", "words", at.alias("at"))
        posting = lambda i: F.struct(F.get("words", i).alias("term"), i.alias("pos"), F.slice("words", F.greatest(i - reach, F.lit(0)) + 1, F.least(i, F.lit(reach)) + 1 + reach).alias("near"))
        part = found.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), F.transform("at", posting).alias("postings"), F.lit(b).alias("block"))
        every = part if every is None else every.unionByName(part)
    return saved(every, "postings")


def _sent(table: DataFrame) -> DataFrame:
    """A table of the benchmark's: sent to every executor while it is small, joined like any other beyond."""
    return F.broadcast(table) if table.count() <= MOST_SENT else table


def candidates(stored: DataFrame, windows: DataFrame) -> DataFrame:
    """(key, wid): windows whose three rarest words stand near each other in a text. Postings do not move while the windows are sent to them."""
    entry = stored.filter(F.size("postings") > 0).select("key", F.explode("postings").alias("p")).select("key", "p.term", "p.near")
    first = windows.select("wid", F.col("anchor.term").alias("term"), F.transform(F.slice("terms", 2, 2), lambda x: x["term"]).alias("next"))
    met = entry.join(_sent(first), "term").filter(F.forall("next", lambda w: F.array_contains("near", w)))
    return saved(met.select("key", "wid").distinct(), "candidates", few(stored.count(), 50_000))


def lists_of(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """(kid, term, positions) of the (kid, key, terms) asked for; only texts that may be asked for move, and none of their other words.

    ``terms`` are words of the benchmark's windows, so there are no more than it has, whatever the text.
    """
    some = may_be_among(rows.select("key", "text"), F.col("key"), asked.select("key"), "asked").filter("asked").dropDuplicates(["key"])
    words = saved(with_words(some.join(asked, "key").select("kid", "terms", "text")), "asked-words")
    places = lambda t: F.filter(F.transform("words", lambda w, i: F.when(w == t, i)), lambda i: i.isNotNull())
    found = words.select("kid", F.explode(F.transform("terms", lambda t: F.struct(t.alias("term"), places(t).alias("positions")))).alias("x"))
    return saved(found.select("kid", "x.term", "x.positions"), "lists")


def intersected(rows: DataFrame, found: DataFrame, windows: DataFrame, reach: int) -> DataFrame:
    """(key, wid, starts, near): per text and window the places of exact phrases, and the anchor's places with all words near.

    ``found`` is (key, wid). Windows that a text has neither way are left out.
    """
    total = found.count()
    keys = saved(found.select("key").distinct().withColumn("kid", F.monotonically_increasing_id()), "asked-keys", few(total, 100_000))
    found = found.join(keys, "key").select("kid", "wid")
    each_term = _sent(windows.select("wid", "n", F.posexplode("terms").alias("rank", "t")).select("wid", "n", "rank", "t.offset", "t.term"))
    whole = saved(found.join(each_term, "wid"), "asked-terms", few(total, 20_000))
    lists = lists_of(rows, whole.groupBy("kid").agg(F.collect_set("term").alias("terms")).join(keys, "kid"))
    # A group has a row a word of one window.
    group = whole.join(lists, ["kid", "term"]).groupBy("kid", "wid", "n").agg(F.array_sort(F.collect_list(F.struct("rank", "offset", "positions"))).alias("lists")).filter(F.size("lists") == F.col("n"))
    shift = lambda x: F.transform(x["positions"], lambda p: p - x["offset"])
    wide = lambda x: F.flatten(F.transform(x["positions"], lambda p: F.sequence(p - reach, p + reach)))
    head, rest = F.col("lists")[0], F.slice("lists", 2, F.size("lists"))
    starts = F.aggregate(rest, shift(head), lambda acc, x: F.array_intersect(acc, shift(x)))
    near = F.aggregate(rest, head["positions"], lambda acc, x: F.array_intersect(acc, wide(x)))
    return group.select("kid", "wid", starts.alias("starts"), near.alias("near")).filter("size(starts) > 0 or size(near) > 0").join(keys, "kid").drop("kid")


def contaminated(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, size: int = 10,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items, near_items, n_near, spans, contaminated, text_sha256.

    ``items`` are the benchmark items with a window that occurs as an exact phrase, sorted as strings;
    ``n_hit`` counts the words inside any such occurrence and ``spans`` are the occurrences as (start,
    length) in words. ``near_items`` have a window all of whose words stand within ``size`` - 1 words of its rarest
    one. Null or wordless texts have no words and no hits; equal texts are looked up once; repeated
    rows and null ids keep a row each; null item ids count for hits and are no items; empty tables and other columns are fine.
    """
    items = benchmark.select(F.col(item_col).cast("string").alias("item_id"), F.col(item_text).alias("text"))
    with scratch(spark, "postings", "hits"):
        return _contaminated(spread(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), items, size)


def _contaminated(rows: DataFrame, items: DataFrame, size: int) -> DataFrame:
    rows = rows.withColumn("key", F.sha2(F.coalesce("text", F.lit("")), 256))
    windows = saved(anchored(windows_of(items, size), rows), "anchors", 1)
    stored = store_postings(rows, windows, size - 1)
    met = intersected(rows, candidates(stored, windows), windows, size - 1).join(_sent(windows.select("wid", "n", "items")), "wid")
    spans = F.transform("starts", lambda p: F.struct(p.alias("start"), F.col("n").alias("n")))
    places = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1)))
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c))))
    hits = met.groupBy("key").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(spans)))).alias("spans"),
        union(F.when(F.size("starts") > 0, F.col("items"))).alias("items"), union(F.when(F.size("near") > 0, F.col("items"))).alias("near_items"),
    ).withColumn("n_hit", F.size(F.array_distinct(places)).cast("long"))
    # Read back, so that the join can split a key that very many copies share.
    hits = saved(hits, "hits")
    no_names, no_spans = F.array().cast("array<string>"), F.array().cast("array<struct<start:int,n:int>>")
    out = stored.filter("block = 0").join(hits, "key", "left").select(
        "doc_id", "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", no_names).alias("items"), F.coalesce("near_items", no_names).alias("near_items"), F.coalesce("spans", no_spans).alias("spans"),
    )
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", "near_items",
        F.size("near_items").cast("long").alias("n_near"), "spans", (F.col("n_hit") > 0).alias("contaminated"), F.col("key").alias("text_sha256"),
    )
