"""URL filtering by association rules.

URLs become sets of tokens, tokens that always occur together one item. Spark's FP-growth mines item
combinations that go with a label; rules kept by support and confidence are filed in an inverted index under their rarest token, and a URL
looks up its own tokens there and verifies the rest of each rule it finds. Explicit host/path rules
go before mined ones. Only DataFrame functions and Spark ML run; no Python on the executors.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirlake.llm.common import UPPER, counted, saved

#: (verdict, host and path) as the query's contract states them.
RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)
LABEL = "label="


def url_host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; A-Z lowered; empty if there is none."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def url_tokens(url: Column) -> Column:
    """The set of a URL's tokens: scheme, last two host labels, each label before them, path words, query keys, fragment.

    Digits in path words are folded to ``0`` so that page numbers share a token.
    """
    host, path = url_host(url), url_path(url)
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    back = F.reverse(labels)
    site = F.array_join(F.slice(back, 1, 2), ".")
    words = F.filter(F.split(F.regexp_replace(path, r"[0-9]+", "0"), r"[/._-]+"), lambda x: x != "")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda x: F.regexp_extract(x, r"^([^=]*)", 1)), lambda x: x != "")
    scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    tag = lambda name, xs: F.transform(xs, lambda x: F.concat(F.lit(name), x))
    every = F.concat(
        tag("scheme:", F.array(scheme)), tag("site:", F.array(site)), tag("host:", F.slice(back, F.lit(3), F.greatest(F.size(back) - 2, F.lit(0)))), tag("path:", words),
        tag("query:", keys), F.when(F.locate("#", url) > 0, F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
    )
    return F.array_distinct(every)


def explicit_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest explicit rule that fits, else nulls.

    A rule fits its own host and all subdomains where the path starts with the rule's path. Of equally
    long rules the one with the longer host wins.
    """
    split = [(v, r, *((r.split("/", 1)[0], "/" + r.split("/", 1)[1]) if "/" in r else (r, ""))) for v, r in rules]
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r, h, p in sorted(split, key=lambda x: (len(x[1]), len(x[2]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def token_items(baskets: DataFrame, least: int) -> DataFrame:
    """(token, item, freq, lift) of the tokens that ``least`` baskets have; baskets are (row, tokens, label).

    Tokens that the same baskets have say the same, and are one item, named after the first of them. ``lift`` is
    the largest share that a label has among the item's baskets over its share of all. There are at most
    (tokens a basket) * (baskets / least) rows, a number that a support given as a share fixes.
    """
    total = baskets.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    share = total.join(baskets.agg(F.count(F.lit(1)).alias("every")), how="cross").select("label", (F.col("n") / F.col("every")).alias("share"))  # a row a label, and one row
    who = [F.expr("bit_xor(xxhash64(row))").alias("h1"), F.expr("bit_xor(xxhash64(row, 1))").alias("h2")]
    told = baskets.select("row", "label", F.explode("tokens").alias("token")).groupBy("token", "label").agg(F.count(F.lit(1)).alias("n"), *who)
    told = told.join(share, "label")
    token = told.groupBy("token").agg(F.sum("n").alias("freq"), F.max(F.col("n") / F.col("share")).alias("most"), F.expr("bit_xor(h1)").alias("h1"), F.expr("bit_xor(h2)").alias("h2"))
    # Few are frequent; they are brought together after all tasks took part in counting.
    token = saved(token.filter(F.col("freq") >= least).repartition(1), "url-tokens")
    name = token.groupBy("freq", "h1", "h2").agg(F.min("token").alias("item"))
    return saved(token.join(name, ["freq", "h1", "h2"]).select("token", "item", "freq", (F.col("most") / F.col("freq")).alias("lift")), "url-items", 1)


def with_items(rows: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """(key, items): the items of (key, tokens), the most telling first; rows without any are left out."""
    told = rows.select(key, F.explode("tokens").alias("token")).join(F.broadcast(items), "token")
    best = F.struct((-F.col("lift")).alias("lift"), (-F.col("freq")).alias("freq"), "item")
    return told.groupBy(key).agg(F.array_sort(F.collect_set(best)).alias("x")).select(key, F.transform("x", lambda x: x["item"]).alias("items"))


def mine_rules(
    labelled: DataFrame, min_support: float = 0.005, min_confidence: float = 0.6, min_lift: float = 1.1, least: int = 5, breadth: int = 12, longest: int = 4,
) -> tuple[DataFrame, DataFrame]:
    """(rules, items) mined from (url, label); rules are (tokens, anchor, verdict, confidence, support).

    Rows without url or label are left out. Rules that say less than the label's own share does
    (``min_lift``) go, as do those with a shorter rule of the same verdict and no less confidence.
    ``anchor`` is the rule's rarest item, where the index files it; its tokens are items (``token_items``).
    ``least`` is a support in rows, where ``min_support`` is less; rules have ``longest`` items at most, and all such
    rules are found. FP-growth makes every itemset of a row, so it gets the items that are always among a row's
    ``breadth`` most telling ones; itemsets with any other item are counted by ``grown_rules``.
    """
    spark = labelled.sparkSession
    rows = labelled.filter("url is not null and label is not null").select(F.monotonically_increasing_id().alias("row"), url_tokens(F.col("url")).alias("tokens"), "label")
    rows, total = counted(rows, "url-baskets")
    none = spark.createDataFrame([], "tokens array<string>, anchor string, verdict string, confidence double, support double")
    if not total:
        return none, spark.createDataFrame([], "token string, item string, freq long, lift double")
    support = max(min_support, least / total)
    items = token_items(rows, math.ceil(support * total - 1e-9))
    if support > 1:
        return none, items
    baskets = with_items(rows, items, "row").join(rows.select("row", "label"), "row")
    # Rows without any frequent item count for supports all the same.
    bare = rows.join(baskets_rows(rows, items), "row", "left_anti").select(F.array().cast("array<string>").alias("items"), "label")
    sets = saved(baskets.select("items", "label").unionByName(bare), "url-sets")
    late = F.slice("items", F.lit(breadth + 1), F.greatest(F.size("items") - breadth, F.lit(0)))
    wide = [r[0] for r in sets.select(F.explode(late).alias("item")).distinct().collect()]  # items: bounded by the support
    narrow = F.array_except("items", F.lit(wide)) if wide else F.col("items")
    mined = sets.select(F.array_append(narrow, F.concat(F.lit(LABEL), F.col("label"))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(mined)
    rules = model.associationRules.filter(F.col("consequent")[0].startswith(LABEL)).filter(~F.exists("antecedent", lambda x: x.startswith(LABEL)))
    rules = rules.filter(F.size("antecedent") <= longest).select(
        F.array_sort("antecedent").alias("tokens"), F.substring(F.col("consequent")[0], len(LABEL) + 1, 1000).alias("verdict"), "confidence", "support", "lift"
    )
    if wide:
        rules = rules.unionByName(grown_rules(sets, wide, math.ceil(support * total), total, longest).filter(F.col("confidence") >= min_confidence))
    rules = rules.filter(F.col("lift") >= min_lift).drop("lift")
    rules = saved(rules, "url-rules")
    # Each rule names the shorter rules it contains; there are fewer than 2 ** longest of them.
    part = F.expr("transform(sequence(1, int(shiftleft(1, size(tokens))) - 2), m -> filter(tokens, (x, i) -> shiftright(m, i) & 1 = 1))")
    parts = rules.filter("size(tokens) > 1").select(F.col("tokens").alias("own"), "verdict", F.col("confidence").alias("floor"), F.explode(part).alias("tokens"))
    idle = parts.join(rules.select("tokens", "verdict", "confidence"), ["tokens", "verdict"]).filter("confidence >= floor").select(F.col("own").alias("tokens"), "verdict").distinct()
    rules = rules.join(idle, ["tokens", "verdict"], "left_anti")
    seen = items.select(F.col("item").alias("token"), "freq").distinct()
    anchor = rules.select("tokens", "verdict", F.explode("tokens").alias("token")).join(seen, "token").groupBy("tokens", "verdict").agg(F.min_by("token", F.struct("freq", "token")).alias("anchor"))
    return rules.join(anchor, ["tokens", "verdict"]).select("tokens", "anchor", "verdict", "confidence", "support"), items


def grown_rules(sets: DataFrame, wide: list[str], least: int, total: int, longest: int) -> DataFrame:
    """(tokens, verdict, confidence, support, lift) of the itemsets of up to ``longest`` items with any of ``wide``.

    ``sets`` is (items, label). Equal rows are one with a weight. Sets grow an item at a time in one order, ``wide``
    ones first, so that each is made once a row, and only from sets that ``least`` rows have with one label. Counts
    combine map-side; a row of n items makes n over ``longest`` sets at most, never 2 ** n.
    """
    first = F.array_sort(F.array_intersect("items", F.lit(wide)))
    rows = sets.withColumn("first", first).filter(F.size("first") > 0).groupBy("first", F.array_sort(F.array_except("items", F.lit(wide))).alias("others"), "label").agg(F.count(F.lit(1)).alias("n"))
    rows = saved(rows, "url-wide")
    of_label = sets.groupBy("label").agg((F.count(F.lit(1)) / total).alias("share"))
    after = lambda xs, at: F.slice(xs, at + 2, F.greatest(F.size(xs) - at - 1, F.lit(0)))
    state = rows.select(F.posexplode("first").alias("at", "item"), "first", "others", "label", "n").select(
        F.array("item").alias("own"), F.concat(after("first", F.col("at")), F.col("others")).alias("rest"), "label", "n"
    )
    out = None
    for size in range(1, longest + 1):
        counts = state.groupBy("own", "label").agg(F.sum("n").alias("n"))
        every = counts.groupBy("own").agg(F.sum("n").alias("all"), F.max("n").alias("most")).filter(F.col("most") >= least)
        counts = saved(counts.join(every, "own").select("own", "label", "n", "all"), "url-grown")
        found = counts.filter(F.col("n") >= least).join(F.broadcast(of_label), "label").select(  # a row a label
            F.array_sort("own").alias("tokens"), F.col("label").alias("verdict"), (F.col("n") / F.col("all")).alias("confidence"), (F.col("n") / total).alias("support"),
            (F.col("n") / F.col("all") / F.col("share")).alias("lift"),
        )
        out = found if out is None else out.unionByName(found)
        if size < longest:
            live = state.join(counts.select("own").distinct(), "own", "left_semi").select("own", F.posexplode("rest").alias("at", "item"), "rest", "label", "n")
            state = live.select(F.array_append("own", F.col("item")).alias("own"), after("rest", F.col("at")).alias("rest"), "label", "n")
    return out


def baskets_rows(rows: DataFrame, items: DataFrame) -> DataFrame:
    """The rows that have an item."""
    return rows.select("row", F.explode("tokens").alias("token")).join(F.broadcast(items.select("token")), "token", "left_semi").select("row").distinct()


def match_rules(urls: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """The best mined rule of each distinct url: url, mined (verdict), mined_rule, confidence.

    The most confident is best, then the best supported, then the first by name. A url that has one token of
    an item has the item. Urls that no rule fits have no row.
    """
    asked = urls.select("url").filter("url is not null").distinct().withColumn("tokens", url_tokens(F.col("url")))
    own = with_items(asked, items, "url")
    found = (
        own.select("url", "items", F.explode(F.slice("items", 1, F.size("items"))).alias("anchor")).join(rules, "anchor")
        .filter(F.size(F.array_except("tokens", "items")) == 0)
    )
    name = F.array_join("tokens", " ")
    best = found.groupBy("url").agg(F.min(F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), name.alias("rule"), "verdict")).alias("b"))
    return best.select("url", F.col("b.verdict").alias("mined"), F.col("b.rule").alias("mined_rule"), (-F.col("b.c")).alias("confidence"))


def filter_urls(
    pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
    min_support: float = 0.005, min_confidence: float = 0.6, default: str = "allow",
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, mined_rule, confidence.

    ``labels`` is (doc_id, quality, toxic); a labelled page of low quality or marked toxic counts as
    ``block``, any other as ``allow``. A page that neither an explicit nor a mined rule fits gets
    ``default``, as do null urls (whose host and path are empty). Repeated rows and urls keep one row
    each; null ids have no label; without labels nothing is mined; other columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    marks = labels.filter("quality is not null or toxic is not null").groupBy(F.col("doc_id").alias("page_id")).agg(F.max(F.when(bad, "block").otherwise("allow")).alias("label"))
    mined, items = mine_rules(rows.join(marks, "page_id"), min_support, min_confidence)
    best = match_rules(rows, saved(mined, "url-index", 1), items)
    # A null url has nothing to look up; a key of its own keeps such rows from meeting in one task.
    keyed = rows.withColumn("key", F.coalesce("url", F.concat(F.lit("\x00"), F.xxhash64("page_id").cast("string"))))
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    out = keyed.join(best.withColumnRenamed("url", "key"), "key", "left").select("page_id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"), "mined", "mined_rule", "confidence")
    rule, verdict = explicit_rule(F.col("host"), F.col("path"), rules)
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, "mined", F.lit(default)).alias("verdict"), "mined_rule", "confidence")
