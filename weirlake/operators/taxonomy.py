"""Topics of texts by a taxonomy that is a table of any size: one pass over the texts, whatever the number of keywords."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirlake.functions.bind import let
from weirlake.functions.text import domains_of, keyword_text
from weirlake.operators.staging import fresh

#: Keywords are looked up by so many of their first characters (by all, if shorter).
HEAD = 5
#: Texts are gone through in pieces of so many characters at least.
PIECE = 64
#: A taxonomy of up to so many keywords is sent to all tasks as an automaton; a larger one is joined by its heads.
MOST_SENT = 200_000


def keyword_index(taxonomy: DataFrame) -> DataFrame:
    """(topic, keyword, length, head, overlaps) of a taxonomy (topic, keyword): rows with null or empty parts left out, repeats once.

    ``overlaps`` says that a keyword can begin again inside itself, as ``ana`` does.
    """
    kw = taxonomy.select("topic", "keyword").filter("topic is not null and keyword <> ''").distinct().withColumn("length", F.char_length("keyword"))
    border = F.exists(F.sequence(F.lit(1), F.col("length") - 1), lambda k: F.substring(F.col("keyword"), F.lit(1), k) == F.substring(F.col("keyword"), F.col("length") - k + 1, k))
    return kw.select("topic", "keyword", "length", F.left("keyword", F.lit(HEAD)).alias("head"), F.when(F.col("length") > 1, border).otherwise(False).alias("overlaps"))


def _pieces(text: Column, size: int, reach: int) -> Column:
    """Array of (at, own, window): pieces of ``size`` characters, each with ``reach`` more of what follows."""
    def windows(xs: Column) -> Column:
        return F.transform(xs, lambda x, i: F.struct((i.cast("long") * size).alias("at"), F.char_length(x).alias("own"), F.concat(x, F.coalesce(F.left(F.get(xs, i + 1), F.lit(reach)), F.lit(""))).alias("window")))

    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{size}}}"), F.lit(0)), windows)


def _apart(places: Column, length: Column) -> Column:
    """How many of the sorted places are left when each takes ``length`` characters and the leftmost go first."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).cast("long").alias("free"))
    step = lambda acc, p: F.when(p >= acc["free"], F.struct((acc["n"] + 1).alias("n"), (p + length).alias("free"))).otherwise(acc)
    return F.aggregate(places, start, step, lambda acc: acc["n"])


def _by_automaton(texts: DataFrame, key: str, keywords: list[tuple[str, str]]) -> DataFrame:
    """``topic_scores`` of ``texts`` (key, text) where they lie: one automaton a task finds all keywords of a text in one pass."""
    topics: dict[str, list[str]] = {}
    for topic, keyword in keywords:
        topics.setdefault(keyword, []).append(topic)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ahocorasick

        words = ahocorasick.Automaton()
        for i, w in enumerate(topics):
            words.add_word(w, (i, len(w)))
        words.make_automaton()
        of = list(topics.values())
        kind = pa.list_(pa.struct([("score", pa.int64()), ("name", pa.string())]))
        for b in batches:
            scores = []
            for x in b.column(1):
                found: dict[int, int] = {}
                free: dict[int, int] = {}
                for end, (i, length) in words.iter(x.as_py()):
                    if end - length >= free.get(i, -1):
                        found[i] = found.get(i, 0) + 1
                        free[i] = end
                sums: dict[str, int] = {}
                for i, n in found.items():
                    for topic in of[i]:
                        sums[topic] = sums.get(topic, 0) + n
                scores.append([{"score": n, "name": t} for t, n in sorted(sums.items(), key=lambda p: (-p[1], p[0]))] or None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, kind)], [key, "scores"])

    kind = texts.schema[key].dataType.simpleString()
    return texts.mapInArrow(run, f"`{key}` {kind}, scores array<struct<score:bigint,name:string>>").filter("scores is not null")


def topic_scores(rows: DataFrame, key: str, text: Column, taxonomy: DataFrame) -> DataFrame:
    """(key, scores) of the rows that any keyword occurs in; scores are (score, name), the highest first, then by name.

    A score is the number of non-overlapping occurrences of a topic's keywords in the lower-cased text with single
    blanks, each keyword counted for itself, inside words too. A taxonomy of up to ``MOST_SENT`` keywords goes to the tasks
    as an automaton, and nothing is shuffled. With a larger one each place of a text is looked up by the characters that
    begin there; only what agrees is compared in full, and texts move as counts, never whole. ``key`` is unique; rows
    whose key is null are not scored, null texts are empty.
    """
    index = keyword_index(taxonomy)
    facts = index.agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("longest"), F.array_sort(F.collect_set(F.char_length("head"))).alias("heads")).first()
    none = rows.select(key).limit(0).withColumn("scores", F.array().cast("array<struct<score:bigint,name:string>>"))
    if not facts["n"]:
        return none
    if facts["n"] <= MOST_SENT:
        own = rows.filter(F.col(key).isNotNull()).select(key, keyword_text(text).alias("_text"))
        return _by_automaton(own, key, [tuple(r) for r in index.select("topic", "keyword").collect()])
    size = max(PIECE, facts["longest"])
    pieces = rows.filter(F.col(key).isNotNull()).select(F.col(key).alias("_k"), F.inline(_pieces(keyword_text(text), size, facts["longest"] - 1)))
    heads = F.flatten(F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda p: F.array(*(F.struct(p.alias("p"), F.substring(F.col("window"), p + 1, F.lit(q)).alias("head"), F.lit(q).alias("q")) for q in facts["heads"]))))
    places = pieces.select("_k", "at", "window", F.inline(heads))
    same = F.substring(F.col("window"), F.col("p") + 1, F.col("length")) == F.col("keyword")
    # Shorter heads, at a text's end, were looked up under their own length already.
    found = places.filter(F.char_length("head") == F.col("q")).join(index, "head").filter(same)
    # Most keywords are added up by topic where they are found; only those that can overlap themselves keep their places.
    own = lambda c: F.when(F.col("overlaps"), c)
    hits = found.groupBy("_k", "topic", own(F.col("keyword")).alias("again"), own(F.col("length")).alias("length"), own(F.col("at") + F.col("p")).alias("place")).agg(F.count(F.lit(1)).alias("n"))
    hits = hits.repartition("_k").groupBy("_k", "topic", "again", "length").agg(F.sum("n").alias("n"), F.array_sort(F.collect_list("place")).alias("places"))
    n = F.when(F.col("again").isNull(), F.col("n")).otherwise(_apart(F.col("places"), F.col("length")))
    topics = hits.groupBy("_k", "topic").agg(F.sum(n).alias("score"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), F.col("topic").alias("name"))))
    return topics.groupBy("_k").agg(ranked.alias("r")).select(F.col("_k").alias(key), F.transform("r", lambda x: F.struct((-x["minus"]).alias("score"), x["name"].alias("name"))).alias("scores"))


def domains_by_table(rows: DataFrame, key: str, text: Column, taxonomy: DataFrame, source_domain: Column | None = None) -> DataFrame:
    """(key, primary, secondary, confidence), a row each, by the rules of ``infer_domains``; unscored rows count as without hits."""
    name = fresh(rows, "_domain")
    slim = rows.select(key, (F.lit("multidomain") if source_domain is None else source_domain).alias(name))
    both = slim.join(topic_scores(rows, key, text, taxonomy), key, "left")
    scores = F.coalesce("scores", F.array().cast("array<struct<score:bigint,name:string>>"))
    return both.select(key, let(scores, lambda s: domains_of(F.col(name), s)).alias("d")).select(key, "d.primary", "d.secondary", "d.confidence")
