"""Secret scanning over a trigram inverted index.

Each rule's regex yields a Boolean trigram query (``trigrams.py``). One pass over the texts files
postings (trigram, text) for the trigrams that any query asks for; the postings of each clause are
intersected; and only the candidates of a rule have its regex run over them. Rules without mandatory
trigrams run over every text. All of it is DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirlake.functions.bind import let
from weirlake.llm.common import ascii_lower, running, saved, spans_of
from weirlake.llm.trigrams import trigram_query


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` or more characters, else the match is dropped (no retry)."""

    kind: str
    regex: str
    group: int = 0
    least: int = 0
    quick: str | None = None


#: The rules that the query's contract fixes; of one class repeated, runs that are too short never match at all.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, quick=r"[0-9a-f]{24}"),
)
#: Published formats of provider tokens and key files.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("slack", r"xox[baprs]-[A-Za-z0-9-]{10,}"),
)


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """(tri, key): the trigrams, of those asked for, that each text has; ``key`` is the text's hash."""
    low = texts.select("key", ascii_lower(F.col("text")).alias("low"))
    has = F.array_compact(F.array(*(F.when(F.col("low").contains(t), F.lit(i)) for i, t in enumerate(trigrams))))
    return low.select("key", F.explode(has).alias("tri"))


def candidates(texts: DataFrame, rules) -> DataFrame:
    """(key, rules): for each text that may match an indexed rule, the sorted numbers of those rules."""
    spark = texts.sparkSession
    asked = [(n, c) for n, r in enumerate(rules) for c in trigram_query(r.regex) or []]
    number = {t: i for i, t in enumerate(sorted({t for _, c in asked for t in c}))}
    clauses = spark.createDataFrame(
        [(k, n, number[t], len(c)) for k, (n, c) in enumerate(asked) for t in c], "clause int, rule int, tri int, need int"
    )
    if not number:
        return spark.createDataFrame([], "key bigint, rules array<int>")
    # The clause table is as large as the rules are; the posting lists of its trigrams meet by text.
    met = (
        postings(texts, list(number)).join(F.broadcast(clauses), "tri")
        .groupBy("key", "clause", "rule", "need").agg(F.count_distinct("tri").alias("n")).filter("n = need")
    )
    return met.groupBy("key").agg(F.array_sort(F.collect_set("rule")).alias("rules"))


def _longer(least: int):
    return lambda x: F.char_length(x["v"]) >= least


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base=BASE, more=MORE) -> DataFrame:
    """One row per input row: id, text, and ``base`` and ``found``: arrays of (s, e, kind, v) by start, then rule.

    Offsets are code points, ends exclusive. Null text counts as empty and has no spans; repeated rows
    and null ids keep a row each; an empty table gives none; other columns are not read. Two texts that
    share a hash share candidates too, which costs a scan and changes nothing: candidates are verified.
    """
    rules = [*base, *more]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    # Read back, so that the join can split a key that very many copies share.
    marked = rows.join(saved(candidates(rows, rules), "secret-candidates"), "key", "left")
    none = F.array().cast("array<struct<s:int,e:int,kind:string,v:string>>")
    found: list[Column] = []
    for n, r in enumerate(rules):
        keep = _longer(r.least) if r.least else None
        run = F.array_contains(F.coalesce("rules", F.array().cast("array<int>")), n) if trigram_query(r.regex) else F.col("text").rlike(r.quick or r.regex)
        found.append(F.when(run, spans_of(F.col("text"), r.regex, r.kind, keep, r.group)).otherwise(none))
    order = F.create_map(*(x for n, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(n))))
    by_start = lambda xs: F.transform(
        F.array_sort(F.transform(F.flatten(F.array(*xs)), lambda x: F.struct(x["s"].alias("s"), order[x["kind"]].alias("o"), x["e"].alias("e"), x["kind"].alias("kind"), x["v"].alias("v")))),
        lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"), x["v"].alias("v")),
    )
    got = marked.select("doc_id", "text", *(c.alias(f"f{n}") for n, c in enumerate(found)))
    cols = [F.col(f"f{n}") for n in range(len(rules))]
    return got.select("doc_id", "text", by_start(cols[: len(base)]).alias("base"), by_start(cols).alias("found"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def redact(found: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """(doc_id, text) of ``find_secrets`` with every found span replaced; overlapping spans merge."""

    def pieces(xs: Column, chars: Column) -> Column:
        """What is left between spans, and a mask for each run of overlapping ones; ``upto`` is where all spans so far end."""
        upto = running(F.transform(xs, lambda x: x["e"]), F.greatest)

        def cut(ends: Column) -> Column:
            before = lambda i: F.when(i > 0, F.get(ends, i - 1)).otherwise(0)
            own = F.transform(xs, lambda x, i: F.when(x["s"] >= before(i), F.array_append(F.slice(chars, before(i) + 1, x["s"] - before(i)), F.lit(mask))).otherwise(F.array().cast("array<string>")))
            last = F.get(ends, F.size(ends) - 1)
            return F.concat(F.flatten(own), F.slice(chars, last + 1, F.greatest(F.size(chars) - last, F.lit(0))))

        return F.array_join(let(upto, cut), "")

    text = F.when(F.size("found") == 0, F.col("text")).otherwise(let(F.struct(F.col("found").alias("xs"), F.split("text", "").alias("chars")), lambda b: pieces(b["xs"], b["chars"])))
    return found.select("doc_id", text.alias("text"))
