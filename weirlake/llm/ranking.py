"""Ranked lexical search with block-max pruning.

The index is one row per block, a range of documents as they lie: its words, in how many of its documents each is,
the greatest impact each has there, and the documents' own words with their impacts (a forward index). An impact
is what one occurrence in a query scores before the word's weight, so a block's greatest impacts bound what any of
its documents can score for a query. The blocks with the greatest bounds are scored first and give
each query a threshold; then every task goes through its blocks from the greatest bound down and stops where the
bound is below the threshold, which rises with what is found. Only documents that can be among the best leave a task.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirlake.llm.common import BATCH, counted, few, saved, small_batches, spread

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: A block ends at so many documents, or distinct words of documents.
DOCS, ENTRIES = 64, 1 << 17
#: Blocks a task goes through together, from the greatest bound down; as many are decoded together.
BLOCKS = 32
DECODED = "spark.sql.parquet.columnarReaderBatchSize"
#: Blocks with the greatest bounds that are scored for a query's first threshold.
SEEDS = 4
#: Distinct words of queries in one pass over the index; more queries take more passes.
PASS = 400_000
#: The scale of scores; fixed values of the scoring rule.
UNIT, SATURATION, FLAT, LENGTHS = 1_000_000_000, 12, 75, 25

# Bytes of terms, lower-cased, and a space for every other byte; all bytes of characters beyond ASCII are of terms.
_TO_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_INDEX = "block long, ids array<long>, vocabulary array<string>, docs array<int>, top array<int>, starts array<int>, terms array<int>, impacts array<int>"


@dataclass
class Index:
    """A saved index: ``blocks`` and what was counted over all documents (those with words, and all words)."""

    blocks: DataFrame
    n_docs: int
    n_words: int


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text, in order, only A-Z lower-cased."""
    return (text or "").encode("utf-8").translate(_TO_TERMS).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The block index of all documents; see ``search`` for nulls, repeats and columns.

    Lengths are counted first, since impacts rest on them. A document without words is in no block.
    """
    rows = spread(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = [len(terms_of(text.as_py())) for text in b["text"]]
            yield pa.RecordBatch.from_arrays([pa.array([sum(map(bool, n))], pa.int64()), pa.array([sum(n)], pa.int64())], ["docs", "words"])

    counts = rows.select("text").mapInArrow(lengths, "docs long, words long")
    with small_batches(rows.sparkSession):
        n_docs, n_words = counts.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()

    def block(number: int, ids: list, docs_: list[Counter]) -> tuple:
        vocabulary: dict[bytes, int] = {}
        place = vocabulary.setdefault
        terms, tfs, starts, lengths = [], [], [0], []
        for found in docs_:
            terms += [place(t, len(vocabulary)) for t in found]
            tfs += found.values()
            starts.append(len(terms))
            lengths.append(found.total())
        at, tf = np.array(terms, "int64"), np.array(tfs, "int64")
        short = FLAT + (LENGTHS * np.array(lengths, "int64") * n_docs) // n_words
        impact = (UNIT * tf) // (1000 * tf + SATURATION * np.repeat(short, np.diff(starts)))
        top = np.zeros(len(vocabulary), "int64")
        np.maximum.at(top, at, impact)
        return number, ids, list(vocabulary), np.bincount(at, minlength=len(vocabulary)), top, starts, at, impact

    def write(blocks: list[tuple]) -> pa.RecordBatch:
        number, ids, vocabulary, *ints = zip(*blocks, strict=True)
        flat = lambda x: np.concatenate([np.asarray(y) for y in x]).astype("int32")
        lists = lambda x, values: pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, x)]), pa.int32()), values)
        words = pa.array([w for v in vocabulary for w in v], pa.binary()).cast(pa.string())
        columns = [pa.array(number, pa.int64()), pa.array(ids, pa.list_(pa.int64())), lists(vocabulary, words), *(lists(x, pa.array(flat(x))) for x in ints)]
        return pa.RecordBatch.from_arrays(columns, ["block", "ids", "vocabulary", "docs", "top", "starts", "terms", "impacts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids, held, entries = [], [], 0
        for b in batches:
            done = []
            for i, text in zip(b["doc_id"].to_pylist(), b["text"], strict=True):
                found = Counter(terms_of(text.as_py()))
                if not found:
                    continue
                ids.append(i)
                held.append(found)
                entries += len(found)
                if len(ids) == DOCS or entries >= ENTRIES:
                    done.append(block(number, ids, held))
                    number, ids, held, entries = number + 1, [], [], 0
            if done:
                yield write(done)
        if ids:
            yield write([block(number, ids, held)])

    return Index(saved(rows.mapInArrow(run, _INDEX), "ranking-blocks"), n_docs, n_words)


@dataclass
class _Queries:
    """A pass's queries as arrays: for each its terms (by number, ``starts`` and ``terms``) with weight times repeats."""

    names: list[str]
    starts: np.ndarray
    terms: np.ndarray
    gains: np.ndarray

    def local(self, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(place in the pass's names by place in a block's vocabulary, -1 for others; the reverse)."""
        at = pc.fill_null(pc.index_in(vocabulary, value_set=pa.array(self.names, pa.string())), -1).to_numpy(zero_copy_only=False).astype("int64")
        back = np.full(len(self.names), -1, "int64")
        back[at[at >= 0]] = np.flatnonzero(at >= 0)
        return at, back


class _Block:
    """A block as one pass sees it: bounds of all its queries, and the scores of its documents for one."""

    def __init__(self, row: dict, q: _Queries):
        self.row, self.q = row, q
        self.at, self.back = q.local(row["vocabulary"])
        top = np.zeros(len(q.names) + 1, "int64")
        top[self.at] = row["top"]
        top[-1] = 0
        self.bounds = np.add.reduceat(q.gains * top[q.terms], q.starts[:-1]) if len(q.terms) else np.zeros(0, "int64")
        self.table = None

    def scores(self, query: int) -> np.ndarray:
        """Exact scores of the block's documents, from its forward index."""
        row, q = self.row, self.q
        if self.table is None:
            # The documents' impacts for the pass's words that are in the block; each such word is a column.
            known = np.flatnonzero(self.at >= 0)
            self.column = np.full(len(self.at), -1, "int64")
            self.column[known] = np.arange(len(known))
            column = self.column[row["terms"]]
            doc = np.repeat(np.arange(len(row["ids"])), np.diff(row["starts"]))
            self.table = np.zeros((len(known), len(row["ids"])), "int64")
            self.table[column[column >= 0], doc[column >= 0]] = row["impacts"][column >= 0]
        own = slice(q.starts[query], q.starts[query + 1])
        at = self.back[q.terms[own]]
        return q.gains[own][at >= 0] @ self.table[self.column[at[at >= 0]]]


def _blocks(batch: pa.RecordBatch, names: tuple[str, ...]) -> Iterator[dict]:
    """The rows of a batch of index rows; lists as arrays, the vocabulary as Arrow strings."""
    for k in range(batch.num_rows):
        row = {}
        for name in names:
            values = batch[name][k].values if name != "block" else batch[name][k].as_py()
            row[name] = values if name in ("block", "vocabulary", "ids") else values.to_numpy(zero_copy_only=False)
        yield row


def _pass(index: Index, queries: list[tuple[int, Counter]], k: int) -> DataFrame:
    """(query, doc_id, score) of each task's best for every query, all that can be among the best ``k`` of all."""
    spark = index.blocks.sparkSession
    names = sorted({t for _, found in queries for t in found})
    asked = spark.createDataFrame(pa.table({"term": pa.array(names, pa.string())}))
    each = index.blocks.select(F.explode(F.arrays_zip("vocabulary", "docs")).alias("x")).select(F.col("x.vocabulary").alias("term"), F.col("x.docs").alias("docs"))
    df = {r.term: r.df for r in each.join(F.broadcast(asked), "term").groupBy("term").agg(F.sum("docs").alias("df")).collect()}
    number = {t: i for i, t in enumerate(names)}
    # A word that no document has scores nothing and is left out; a query without any other has no results.
    terms = [[(number[t], weight(index.n_docs, df[t]) * c) for t, c in found.items() if t in df] for _, found in queries]
    asking = [(query, own) for (query, _), own in zip(queries, terms, strict=True) if own]
    flat = [x for _, own in asking for x in own]
    q = spark.sparkContext.broadcast(_Queries(names, np.cumsum([0, *(len(own) for _, own in asking)]), np.array([x for x, _ in flat], "int64"), np.array([g for _, g in flat], "int64")))
    labels = np.array([query for query, _ in asking], "int64")

    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in labels]
        for b in batches:
            for row in _blocks(b, ("block", "vocabulary", "top")):
                bounds = _Block(row, q.value).bounds
                for i in np.flatnonzero(bounds).tolist():
                    x = (int(bounds[i]), row["block"])
                    if len(best[i]) < SEEDS:
                        heapq.heappush(best[i], x)
                    elif x > best[i][0]:
                        heapq.heapreplace(best[i], x)
        rows = [(i, *x) for i, own in enumerate(best) for x in own]
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], ["query", "bound", "block"])

    def best_of(pairs: dict[int, list[int]] | None, least: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: list[list[tuple[int, int, int | None]]] = [[] for _ in labels]
            for b in batches:
                blocks = [_Block(row, q.value) for row in _blocks(b, ("block", "ids", "vocabulary", "top", "starts", "terms", "impacts"))]
                ids = [x.row["ids"].to_pylist() for x in blocks]
                bounds = np.array([x.bounds for x in blocks]).reshape(len(blocks), len(labels))
                at = {x.row["block"]: n for n, x in enumerate(blocks)}
                for i in range(len(labels)):
                    own = best[i]
                    order = np.argsort(-bounds[:, i], kind="stable") if pairs is None else [at[x] for x in pairs.get(i, ()) if x in at]
                    for n in order:
                        bar = max(int(least[i]), own[0][0] if len(own) == k else 0, 1)
                        if bounds[n, i] < bar:
                            break
                        scores = blocks[n].scores(i)
                        for d in np.flatnonzero(scores >= bar).tolist():
                            # Of equal scores the smaller id is better, and a null id the last.
                            x = (int(scores[d]), math.inf if ids[n][d] is None else ids[n][d])
                            x = (x[0], -x[1], ids[n][d])
                            if len(own) < k:
                                heapq.heappush(own, x)
                            elif x[:2] > own[0][:2]:
                                heapq.heapreplace(own, x)
            rows = [(int(labels[i]), x[2], x[0]) for i, own in enumerate(best) for x in own]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], ["query", "doc_id", "score"])

        return run

    few_blocks = index.blocks.select("block", "vocabulary", "top").mapInArrow(promising, "query long, bound long, block long")
    first = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("bound"), "block"))
    pairs: dict[int, list[int]] = {}
    for r in few_blocks.withColumn("place", first).filter(F.col("place") <= SEEDS).orderBy("query", "place").collect():
        pairs.setdefault(r["query"], []).append(r["block"])
    seeds = sorted({x for own in pairs.values() for x in own})
    chosen = index.blocks.filter(F.col("block").isin(seeds)) if len(seeds) <= 1_000 else index.blocks.join(F.broadcast(spark.createDataFrame([(x,) for x in seeds], "block long")), "block", "left_semi")
    seeded = chosen.mapInArrow(best_of(pairs, np.zeros(len(labels))), "query long, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    kth = {r["query"]: r["score"] for r in seeded.withColumn("place", place).filter(F.col("place") == k).collect()}
    least = np.array([kth.get(int(x), 0) for x in labels], "int64")
    return saved(index.blocks.mapInArrow(best_of(None, least), "query long, doc_id long, score long"), "ranking-best")


def search(index: Index, queries: DataFrame, k: int = 20, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): for every query row its ``k`` best documents with a score above 0, best first.

    Equal scores rank by ascending doc_id, null last; documents that share an id are ranked as rows of their own, as are
    queries. Null and empty texts have no terms: such documents are never found and such queries find nothing, as
    do all where there are no documents. Other columns are not read. A query's terms are held in memory
    whole; queries go in passes of some ``PASS`` terms.
    """
    spark = queries.sparkSession
    items = queries.select(F.monotonically_increasing_id().alias("query"), F.col(id_col).alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    items, n = counted(items, "ranking-queries", few(queries.count(), 50_000))
    total = items.agg(F.coalesce(F.sum(F.regexp_count("text", F.lit(TERM))), F.lit(0))).first()[0]
    passes = -(-total // PASS)
    found = spark.createDataFrame([], "query long, doc_id long, score long")
    before = {name: spark.conf.get(name) for name in (BATCH, DECODED)}
    for name in before:
        spark.conf.set(name, str(BLOCKS))
    try:
        for turn in range(passes if index.n_words else 0):
            own = items.filter(F.pmod(F.xxhash64("query"), F.lit(passes)) == turn).select("query", "text")
            asked = [(r["query"], Counter(t.decode() for t in terms_of(r["text"]))) for r in own.collect()]
            asked = [x for x in asked if x[1]]
            if asked:
                found = found.unionByName(_pass(index, asked, k))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    ask = items.select("query", "item_id")
    return best.join(F.broadcast(ask) if n <= 1_000_000 else ask, "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
