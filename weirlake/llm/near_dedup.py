"""Near-duplicate groups by MinHash with tensored banding, verified on full shingle sets.

Two collections of ``2 * SIDE`` minhashes form ``SIDE`` pairs each, and every pair of the first is combined with
every pair of the second: ``SIDE * SIDE`` tables out of ``4 * SIDE`` minhashes. A table's small buckets
give candidate pairs, which are verified on full sets.

Texts that meet in large buckets are families, and all pairs of a family are settled without being formed: a
family's template is the set of shingles that most of it has, and a text is written as its difference from
that. Two texts whose differences are small enough together are linked for certain, so the one nearest to
the template links to all of those at once. Others can only be linked if their differences share
shingles; the rarest of those, as many as any link needs, are indexed, and a list that is too long is a
family of its own, with some half the texts at most and a closer template. A template is drawn from a few texts, but any
set would do: within a family every link between components is found. Links are joined to components by contraction.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirlake.llm.common import counted, few, once_a_worker, saved, scratch, spread

#: Pairs of minhashes in each collection; tables are their product.
SIDE = 8
HASHES = 4 * SIDE
#: Of the minhashes, at least so many agree for any similarity from 0.8 on, but for 3 pairs in 100 million.
AGREE = 12
#: Larger buckets are families.
BUCKET = 32
#: Lists of shared differences that more open texts than this are in are families of their own.
LIST = 64
#: A text in so many long lists, too far from a template to be linked to what is near it, waits for a template of its own.
SPREAD = 8
#: Texts that make a template. Links do not depend on it; a good one makes differences short.
VOTERS = 24
MOST_WORDS = 50_000
#: Keys that are grouped at a time, and pairs whose texts move at a time: a pass leaves no shuffle files behind.
PASS_KEYS = 8_000_000
PASS_PAIRS = 100_000
#: Counters of the sketch that orders shingles, and how many go in a row.
SKETCH = 1 << 18
SEGMENT = 1 << 12
BLOOM = 1 << 24


class Shingler:
    """Sets of hashed word shingles of texts given as UTF-8 bytes."""

    def __init__(self, words: int):
        self.words = words
        self.table: dict[bytes, int] = {}
        rng = np.random.default_rng(20)
        self.mix = rng.integers(1, 2**63, words, dtype=np.uint64) | np.uint64(1)
        self.a = rng.integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)
        self.b = rng.integers(1, 2**63, HASHES, dtype=np.uint64)

    def _hash(self, word: bytes) -> int:
        h = self.table.get(word)
        if h is None:
            h = xxhash.xxh64_intdigest(word)
            if len(word) <= 64:
                self.table[word] = h
        return h

    def set_of(self, text: bytes) -> np.ndarray:
        """Sorted distinct shingles; of a text with fewer words than a shingle, its whole sequence as one.

        A-Z are lowered and words are what stands between ASCII white space: for bytes, ``lower`` and
        ``split`` do exactly that.
        """
        words = text.lower().split()
        if not words:
            return np.empty(0, np.uint64)
        if len(self.table) > MOST_WORDS:
            self.table = {}
        h = np.fromiter(map(self._hash, words), np.uint64, len(words))
        k, n = self.words, len(words)
        if n < k:
            return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=n)], np.uint64)
        out = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            x = (out ^ h[i : n - k + 1 + i]) * self.mix[i]
            out = x ^ (x >> np.uint64(29))
        return np.unique(out)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        low = np.full(HASHES, 2**64 - 1, np.uint64)
        for at in range(0, len(shingles), 16384):
            x = shingles[at : at + 16384, None] * self.a + self.b
            x ^= x >> np.uint64(31)
            x *= np.uint64(0xBF58476D1CE4E5B9)
            low = np.minimum(low, x.min(0))
        return (low >> np.uint64(32)).astype(np.uint32)


def _shingler(words: int) -> Shingler:
    """A worker's own shingler: its word table serves all its tasks."""
    return once_a_worker(f"shingler {words}", lambda: Shingler(words))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def signatures(rows: DataFrame, words: int) -> DataFrame:
    """(doc_id, tid, n, k1, k2, sig): hash of the text, set size, 128-bit hash of the set, and its minhashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = _shingler(words)
        for b in batches:
            n, k1, k2, sig = [], [], [], []
            for t in b["text"]:
                s = make.set_of(t.as_py())
                key = xxhash.xxh3_128_intdigest(s.tobytes())
                n.append(len(s))
                k1.append(_signed(key >> 64))
                k2.append(_signed(key & (1 << 64) - 1))
                sig.append(make.signature(s).tobytes())
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["tid"], pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(sig, pa.binary())], ["doc_id", "tid", "n", "k1", "k2", "sig"])

    return rows.select("doc_id", "tid", "text").mapInArrow(run, "doc_id long, tid long, n long, k1 long, k2 long, sig binary")


def keys_of(sig: np.ndarray) -> np.ndarray:
    """The keys in all tables of each row of minhashes: every pair of the first collection with every pair of the second."""
    sig = sig.astype(np.uint64)
    odd = np.arange(1, 2 * SIDE * SIDE, 2, dtype=np.uint64).reshape(SIDE, SIDE) * np.uint64(0x9E3779B97F4A7C15)
    pair = (sig[:, 0::2] << np.uint64(32)) | sig[:, 1::2]
    first, second = pair[:, :SIDE] * np.uint64(0xC2B2AE3D27D4EB4F), pair[:, SIDE:]
    x = (first[:, :, None] ^ (first[:, :, None] >> np.uint64(32))) + second[:, None, :] * np.uint64(0x165667B19E3779F9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + odd
    return (x ^ (x >> np.uint64(32))).reshape(len(sig), SIDE * SIDE)


def table_keys(nodes: DataFrame, turn: int = 0, passes: int = 1) -> DataFrame:
    """(key, node): a node's key in each of the tables, or in those of one of several passes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = keys_of(np.frombuffer(b"".join(b["sig"].to_pylist()), np.uint32).reshape(-1, HASHES))[:, turn::passes]
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(np.repeat(b["node"].to_numpy(), keys.shape[1]))], ["key", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "key long, node long")


def _members(keys: DataFrame, rows: int) -> DataFrame:
    """(key, node, many, head) of groups of two or more: their size and their least node; there are about ``rows`` keys.

    Sizes are counted map-side first, so a group of any size is as many rows as there are tasks; they
    are read back, so that the join can split a group that is too large for a task.
    """
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("many"), F.min("node").alias("head")).filter("many > 1")
    return keys.select("key", "node").join(saved(sizes, "near-sizes", few(rows, 250_000)), "key")


def _buckets(nodes: DataFrame, total: int) -> tuple[DataFrame, int]:
    """``_members`` of all tables, and how many rows: in passes over some of the tables each, so that only a pass's keys are shuffled at a time."""
    passes = min(SIDE, few(SIDE * SIDE * total, PASS_KEYS))
    each = SIDE * SIDE * total // passes
    parts = [counted(_members(table_keys(nodes, turn, passes), each), "near-buckets", few(each, 250_000)) for turn in range(passes)]
    return reduce(DataFrame.unionByName, (p for p, _ in parts)), sum(n for _, n in parts)


def _pairs_within(members: DataFrame, by: str, cols: list[str]) -> DataFrame:
    """Pairs (a, b), a.node < b.node, within groups whose size the caller has bounded."""
    group = members.groupBy(by).agg(F.array_sort(F.collect_set(F.struct(*cols))).alias("g")).filter("size(g) > 1")
    first = group.select("g", F.posexplode("g").alias("i", "a"))
    return first.select("a", F.explode(F.slice("g", F.col("i") + 2, F.size("g"))).alias("b"))


def _plausible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs whose sizes allow the similarity and whose minhashes agree often enough."""
    side = lambda x: nodes.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}"))
    both = pairs.select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b")
    both = both.filter(100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = (np.frombuffer(b"".join(b[c].to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("sa", "sb"))
            ok = pa.array((x == y).sum(1) >= AGREE)
            yield pa.RecordBatch.from_arrays([b["a"].filter(ok), b["b"].filter(ok)], ["a", "b"])

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _bloom(ids: DataFrame) -> np.ndarray:
    """A fixed-size bit table of the hashes of texts asked for; it only spares moving others."""
    words = ids.select(F.pmod("tid", F.lit(BLOOM)).alias("at")).selectExpr("int(at div 64) AS w", "shiftleft(1L, int(at % 64)) AS bit")
    got = words.groupBy("w").agg(F.expr("bit_or(bit)").alias("bits")).toPandas()
    out = np.zeros(BLOOM // 64, np.int64)
    out[got["w"].to_numpy()] = got["bits"].to_numpy()
    return out


def _texts_of(rows: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, z): the compressed text of each node, found by its hash and checked against its set's hash."""
    nodes, many = counted(nodes.select("tid", "node", "k1", "k2"), "near-asked")
    bits = rows.sparkSession.sparkContext.broadcast(_bloom(nodes).view(np.uint8))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        has = bits.value
        for b in batches:
            at = b["at"].to_numpy()
            ok = pa.array((has[at >> 3] >> (at & 7)) & 1 == 1)
            z = pa.array([zlib.compress(t.as_py(), 1) for t in b["text"].filter(ok)], pa.binary())
            yield pa.RecordBatch.from_arrays([b["tid"].filter(ok), b["crc"].filter(ok), z], ["tid", "crc", "z"])

    asked = rows.select("tid", F.crc32("text").alias("crc"), F.pmod("tid", F.lit(BLOOM)).cast("int").alias("at"), "text")
    # One text of each hash is enough, however many copies there are; a task sends no more.
    found = asked.mapInArrow(pick, "tid long, crc long, z binary").groupBy("tid", "crc").agg(F.first("z").alias("z")).join(nodes, "tid")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = _shingler(words)
        for b in batches:
            ok = []
            for z, k1, k2 in zip(b["z"], b["k1"].to_pylist(), b["k2"].to_pylist(), strict=True):
                key = xxhash.xxh3_128_intdigest(make.set_of(zlib.decompress(z.as_py())).tobytes())
                ok.append((_signed(key >> 64), _signed(key & (1 << 64) - 1)) == (k1, k2))
            yield pa.RecordBatch.from_arrays([b[c].filter(pa.array(ok, pa.bool_())) for c in ("node", "z")], ["node", "z"])

    return saved(found.select("node", "z", "k1", "k2").mapInArrow(check, "node long, z binary"), "near-texts", few(many, 5_000))


def _verified(pairs: DataFrame, texts: DataFrame, words: int, percent: int, files: int | None = None) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union.

    A text may be the ``a`` of very many pairs: it goes to as many salts as its pairs fill. Both texts of each pair
    meet in a task, so pairs go in passes of some two a text: what is shuffled at a time is in proportion to the texts.
    """
    pairs, many = counted(pairs, "near-pairs", files)
    passes = few(many, max(PASS_PAIRS, 2 * texts.count()))
    # The salt spreads an ``a`` over tasks; how many salts follows from how many pairs it has.
    salts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / 256).cast("int").alias("salts"))
    salts = saved(salts.filter("salts > 1"), "near-salts", few(many, 250_000))
    spread = pairs.join(salts, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"))
    left = texts.select(F.col("node").alias("a"), F.col("z").alias("za")).join(salts, "a", "left")
    left = left.select("a", "za", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1)).alias("salt"))
    right = texts.select(F.col("node").alias("b"), F.col("z").alias("zb"))

    def both(turn: int) -> DataFrame:
        mine = lambda df: df if passes == 1 else df.filter(F.pmod(F.xxhash64("a", "salt"), F.lit(passes)) == turn)
        return mine(spread).join(right, "b").join(mine(left), ["a", "salt"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, last, own = _shingler(words), None, None
        for b in batches:
            ok = []
            for a, za, zb in zip(b["a"].to_pylist(), b["za"], b["zb"], strict=True):
                if a != last:
                    last, own = a, make.set_of(zlib.decompress(za.as_py()))
                other = make.set_of(zlib.decompress(zb.as_py()))
                n = len(np.intersect1d(own, other, assume_unique=True))
                ok.append(100 * n >= percent * (len(own) + len(other) - n))
            keep = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([b["a"].filter(keep), b["b"].filter(keep)], ["a", "b"])

    links = [saved(both(turn).select("a", "za", "b", "zb").mapInArrow(run, "a long, b long"), "near-links", few(many // passes, 5_000)) for turn in range(passes)]
    return reduce(DataFrame.unionByName, links)


def _templates(voters: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(gid, t): the shingles that more than half of a group's few voters have, at most twice as many as a voter has."""

    def most(table: pa.Table) -> pa.Table:
        make = _shingler(words)
        sets = [make.set_of(zlib.decompress(z.as_py())) for z in table["z"]]
        token, n = np.unique(np.concatenate(sets), return_counts=True)
        return pa.table({"gid": table["gid"].slice(0, 1), "t": pa.array([token[2 * n > len(sets)].view(np.int64)], pa.list_(pa.int64()))})

    return voters.join(texts, "node").select("gid", "z").groupBy("gid").applyInArrow(most, "gid long, t array<long>")


def _votes(node, votes, gid):
    """Whether a text has a say in its group's template: about ``VOTERS`` of a group's ``votes`` do."""
    return F.pmod(F.xxhash64(node, gid), F.lit(1_000_000)) * votes < 1_000_000 * VOTERS


def _differences(groups: DataFrame, templates: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(gid, node, n, d): set size, and the shingles that only one of text and template has."""

    def differ(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, last, own = _shingler(words), None, np.empty(0, np.uint64)
        for b in batches:
            n, d = [], []
            for gid, z, t in zip(b["gid"].to_pylist(), b["z"], b["t"], strict=True):
                if gid != last:
                    last, own = gid, np.sort(t.values.to_numpy().view(np.uint64)) if t.is_valid else np.empty(0, np.uint64)
                x = make.set_of(zlib.decompress(z.as_py()))
                n.append(len(x))
                d.append(np.setxor1d(x, own, assume_unique=True).view(np.int64))
            at = np.cumsum([0, *map(len, d)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([np.empty(0, np.int64), *d])))
            yield pa.RecordBatch.from_arrays([b["gid"], b["node"], pa.array(n, pa.int64()), lists], ["gid", "node", "n", "d"])

    rows = groups.join(texts, "node").join(templates, "gid", "left")
    return rows.select("gid", "node", "z", "t").mapInArrow(differ, "gid long, node long, n long, d array<long>")


def _cell(gid: int, shingles: np.ndarray) -> np.ndarray:
    """The counter of the sketch that each shingle of a group has."""
    x = (shingles ^ np.uint64(gid & (1 << 64) - 1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(46)).astype(np.int64)


def _rarest(shown: DataFrame) -> DataFrame:
    """(gid, token, node, open, far, e, rest): of (gid, node, open, far, e, first, d) the ``first`` rarest shingles of each ``d``.

    ``rest`` is how many of ``d`` are not before the shingle in the order of rarity.

    They are ordered by a count sketch of a fixed size and then by hash: any common order gives the same links, rarer
    first gives shorter lists. A shingle counted once is nobody else's, and left out.
    """

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(SKETCH, np.int64)
        for b in batches:
            for gid, d in zip(b["gid"].to_pylist(), b["d"], strict=True):
                np.add.at(count, _cell(gid, d.values.to_numpy().view(np.uint64)), 1)
        rows = [(i, zlib.compress(x.tobytes(), 1)) for i, x in enumerate(count.reshape(-1, SEGMENT)) if x.any()]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["segment", "counts"])

    def total(table):
        # One group holds a row a task of one segment.
        count = np.zeros(SEGMENT, np.int64)
        for x in table["counts"]:
            count += np.frombuffer(zlib.decompress(x.as_py()), np.int64)
        return pa.table({"segment": table["segment"].slice(0, 1), "counts": pa.array([count.tobytes()], pa.binary())})

    kind = "segment int, counts binary"
    sketch = np.zeros(SKETCH, np.int32)
    for r in shown.select("gid", "d").mapInArrow(tally, kind).groupBy("segment").applyInArrow(total, kind).collect():
        sketch[r["segment"] * SEGMENT : (r["segment"] + 1) * SEGMENT] = np.minimum(np.frombuffer(r["counts"], np.int64), 2**31 - 1)
    common = shown.sparkSession.sparkContext.broadcast(sketch)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            token, rest, many = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], []
            for gid, first, d in zip(b["gid"].to_pylist(), b["first"].to_pylist(), b["d"], strict=True):
                d = d.values.to_numpy().view(np.uint64)
                count = common.value[_cell(gid, d)]
                order = np.lexsort((d, count))[:first]
                shared = count[order] > 1
                token.append(d[order[shared]])
                rest.append(len(d) - np.flatnonzero(shared))
                many.append(int(shared.sum()))
            again = pa.array(np.repeat(np.arange(len(many)), many))
            cols = [b["gid"].take(again), pa.array(np.concatenate(token).view(np.int64)), *(b[c].take(again) for c in ("node", "open", "far", "e")), pa.array(np.concatenate(rest))]
            yield pa.RecordBatch.from_arrays(cols, ["gid", "token", "node", "open", "far", "e", "rest"])

    return shown.select("gid", "node", "open", "far", "e", "first", "d").mapInArrow(pick, "gid long, token long, node long, open boolean, far boolean, e long, rest long")


def _settled(groups: DataFrame, voters: DataFrame, texts: DataFrame, words: int, percent: int, many: int, wait: bool):
    """(links, groups still to settle, nodes that wait): one round over ``many`` rows (gid, node) of families.

    With ``E(x) = (100 + percent) |d(x)| - (100 - percent) n(x)``, two texts are linked exactly if
    ``2 (100 + percent) |d(x) & d(y)| >= E(x) + E(y)``. The text of the least E, the nearest, links for certain to all
    whose E is no more than the negative of its own; two that are linked so without looking both are. So only the
    others, the open ones, ask: each needs a partner that shares at least as many shingles as the formula says, so the
    two share one among their rarest, in any common order. A list with few askers is gone through pair by
    pair; one with many is a group for the next round, whose template has what most of the list has. With ``wait``, an open text in over ``SPREAD`` long lists that
    no text near the template can be linked to is not an asker here, and comes back as one that waits.
    """
    whole, step = 2 * (100 + percent), (100 - percent) * 100
    templates = saved(_templates(voters, texts, words), "near-templates", few(many, 2_000))
    diffs = _differences(groups, templates, texts, words).withColumn("e", ((100 + percent) * F.size("d") - (100 - percent) * F.col("n")).cast("long"))
    diffs = saved(diffs, "near-differences", few(many, 5_000))
    low = saved(diffs.groupBy("gid").agg(F.min(F.struct("e", "node")).alias("low"), F.max("e").alias("high")), "near-nearest", few(many, 250_000))
    every = diffs.join(low, "gid").withColumn("open", F.col("e") + F.col("low.e") > 0)
    links = every.filter("not open and node <> low.node").select(F.col("low.node").alias("a"), F.col("node").alias("b"))

    # The least E that a partner can have: of an open text by size and distance, of any other that of an open one.
    reach = F.floor(F.lit(2 * step) * F.col("n") / percent) + 1
    partner = F.when(F.col("open"), F.greatest("low.e", F.col("e") - reach)).otherwise(-F.col("low.e"))
    need = F.greatest(F.lit(1), F.ceil((F.col("e") + partner) / whole))
    far = F.col("open") & (F.col("e") + F.col("low.e") > reach)
    shown = every.filter(F.col("high") + F.col("low.e") > 0).select("gid", "node", "open", far.alias("far"), "e", (F.size("d") - need + 1).cast("int").alias("first"), "d").filter("first > 0")
    shown, listed = counted(_rarest(shown), "near-lists", few(many, 5_000))
    if not listed:
        return links, None, None

    waiting = None
    if wait:
        long = shown.groupBy("gid", "token").agg(F.sum(F.col("open").cast("int")).alias("asking")).filter(F.col("asking") > LIST)
        waiting = shown.filter("far").join(long, ["gid", "token"]).groupBy("gid", "node").count().filter(F.col("count") > SPREAD).select("gid", "node")
        waiting, n = counted(waiting, "near-waiting", few(listed, 250_000))
        if n:
            shown = shown.join(waiting.withColumn("waits", F.lit(True)), ["gid", "node"], "left").withColumn("open", F.col("open") & F.col("waits").isNull())
        else:
            waiting = None
    lists = shown.groupBy("gid", "token").agg(F.count(F.lit(1)).alias("many"), F.sum(F.col("open").cast("int")).alias("asking"), F.expr("bit_xor(xxhash64(node))").alias("who"))
    lists = saved(lists.filter("many > 1 and asking > 0"), "near-listed", few(listed, 250_000))
    short = shown.join(lists.filter(F.col("asking") <= LIST).select("gid", "token"), ["gid", "token"])
    # What two differences share comes no earlier than the first shingle they share.
    x = short.filter("open").select("gid", "token", F.col("node").alias("x"), F.col("e").alias("ex"), F.col("rest").alias("rx"))
    y = short.select("gid", "token", F.col("node").alias("y"), F.col("e").alias("ey"), F.col("rest").alias("ry"))
    pairs = x.join(y, ["gid", "token"]).filter((F.col("x") != F.col("y")) & (whole * F.least("rx", "ry") >= F.col("ex") + F.col("ey")))
    pairs, n = counted(pairs.select("gid", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "near-asked-pairs", few(listed, 50_000))
    side = lambda x: diffs.select("gid", F.col("node").alias(x), F.col("d").alias(f"d{x}"), F.col("e").alias(f"e{x}"))
    both = pairs.join(side("a"), ["gid", "a"]).join(side("b"), ["gid", "b"])
    found = both.filter(whole * F.size(F.array_intersect("da", "db")) >= F.col("ea") + F.col("eb")).select("a", "b")
    links = links.unionByName(saved(found, "near-links", few(n, 20_000)))
    # Lists of the same texts are one group.
    long = lists.filter(F.col("asking") > LIST).groupBy("gid", "many", "who").agg(F.min("token").alias("token")).select("gid", "token")
    more, n = counted(shown.join(long, ["gid", "token"]).select(F.xxhash64("gid", "token").alias("gid"), "node"), "near-groups", few(listed, 50_000))
    return links, (more, n) if n else None, waiting


def _family_links(met: DataFrame, large: DataFrame, texts: DataFrame, groups: DataFrame, words: int, percent: int, met_rows: int) -> tuple[DataFrame, DataFrame | None]:
    """(links, pairs still to verify) of the texts in large buckets, all of which ``groups`` (gid, node) groups.

    Every pair of a group is settled unless both texts wait: those look for each other in the buckets that
    they share, small ones and large ones, in the next turn. Every other turn a template is one text's own set,
    so that turn by turn fewer wait.
    """
    links, pairs, turn = [], [], 0
    while True:
        many = groups.count()
        sizes = large.groupBy("key").agg(F.count(F.lit(1)).alias("votes"), F.min("head").alias("node"))
        best = sizes.join(groups, "node").groupBy("gid").agg(F.max_by(F.struct("key", "node", "votes"), F.struct("votes", "key")).alias("best"))
        best = saved(best.select("gid", "best.key", F.col("best.node").alias("head"), "best.votes"), "near-best", few(many, 50_000))
        if turn % 2:
            voters = best.select("gid", F.col("head").alias("node"))
        else:
            own, b = large.select("key", "node"), best.select("gid", F.col("key").alias("at"), "votes")
            voters = own.join(b, (F.col("key") == F.col("at")) & _votes(F.col("node"), F.col("votes"), F.col("gid"))).select("gid", "node")
        found, rest, waiting = _settled(groups, voters, texts, words, percent, many, True)
        links.append(found)
        while rest:
            sizes = rest[0].groupBy("gid").agg(F.count(F.lit(1)).alias("votes"))
            voters = rest[0].join(saved(sizes, "near-sizes", few(rest[1], 250_000)), "gid").filter(_votes(F.col("node"), F.col("votes"), F.col("gid"))).select("gid", "node")
            found, rest, _ = _settled(rest[0], voters, texts, words, percent, rest[1], False)
            links.append(found)
        if waiting is None:
            break
        met, met_rows = counted(met.select("key", "node").join(waiting.select("node"), "node", "left_semi").select("key", "node"), "near-waiting-buckets", few(met_rows, 250_000))
        met = saved(_members(met, met_rows), "near-buckets", few(met_rows, 250_000))
        pairs.append(_pairs_within(met.filter(F.col("many") <= BUCKET), "key", ["node"]).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")))
        large = met.filter(F.col("many") > BUCKET)
        if large.isEmpty():
            break
        groups, turn = _families(large, met_rows), turn + 1
    union = lambda xs: reduce(DataFrame.unionByName, xs)
    return union(links), union(pairs).distinct() if pairs else None


def _families(large: DataFrame, rows: int) -> DataFrame:
    """(gid, node): the texts of large buckets, those that buckets connect in one group."""
    edges = large.select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
    return saved(components(edges, few(rows, 250_000)).select(F.col("root").alias("gid"), "node"), "near-families", few(rows, 250_000))


def components(links: DataFrame, files: int | None = None) -> DataFrame:
    """(node, root): for each node of an undirected link, one node that stands for its component.

    Each round every node hooks to its least neighbour, chains are shortened, and the links are
    contracted to those between different roots; a round at least halves the roots that still have links.
    """
    edges = saved(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges", files)
    roots = None
    while not edges.isEmpty():
        hook = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root"))
        hook = saved(hook, "hooks", files)
        for _ in range(2):
            up = hook.select(F.col("node").alias("root"), F.col("root").alias("up"))
            hook = hook.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        hook = saved(hook, "hooks", files)
        step = hook.select(F.col("node").alias("old"), F.col("root").alias("new"))
        if roots is None:
            roots = hook
        else:
            roots = saved(roots.join(step, F.col("root") == F.col("old"), "left").select("node", F.coalesce("new", "root").alias("root")), "roots", files)
        edges = edges.join(step, F.col("a") == F.col("old")).select(F.col("new").alias("a"), "b")
        edges = edges.join(step, F.col("b") == F.col("old")).select("a", F.col("new").alias("b")).filter("a <> b").distinct()
        edges = saved(edges, "edges", files)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")) if roots is None else roots


def near_duplicates(
    spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, text_hash, stays.

    Two texts are linked when 100 * intersection >= ``percent`` * union of their sets of ``words``-word
    shingles (``percent`` from 80 on); ``component_id`` is the least id that links lead to and ``kept`` says that
    the row has it. Texts without words, null texts among them, are linked with nothing. Equal sets are one node, so
    copies are never paired. Rows with a null id are compared like all others; where only they are linked
    ``component_id`` is null, and they are kept if no id stands for them. Rows that repeat an id are each judged
    by their own text. ``stays`` holds for one (id, text) of each group, whatever the ids are: the least
    id's, null last, and among its texts the one of the least hash; ``text_hash`` is the xxhash64 of the text. An
    empty table gives no rows; other columns are not read.
    """
    if percent < 80:
        raise ValueError("the tables and the minhash filter are laid out for similarities of 0.8 or more")
    with scratch(spark, "near-signatures", "near-components"):
        return _near_duplicates(docs, words, percent, id_col, text_col)


def _near_duplicates(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    rows = spread(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("tid"), "text")
    seen, total = counted(signatures(rows, words), "near-signatures")
    files = few(total, 50_000)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tid")).alias("first")
    nodes = seen.filter("n > 0").groupBy("k1", "k2", "n").agg(first, F.max("sig").alias("sig"))
    nodes = saved(nodes.select(F.monotonically_increasing_id().alias("node"), "k1", "k2", "n", "first", F.col("first.tid").alias("tid"), "sig"), "near-nodes", files)

    met, met_rows = _buckets(nodes, total)
    close = _pairs_within(met.filter(F.col("many") <= BUCKET), "key", ["node"]).select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))
    close = _plausible(close, nodes, percent)
    large = saved(met.filter(F.col("many") > BUCKET), "near-large", few(met_rows, 250_000))
    crowd = None
    if not large.isEmpty():
        crowd = _families(large, met_rows)
        # Pairs of the same family are found there.
        mark = lambda x: crowd.select(F.col("node").alias(x), F.col("gid").alias(f"g{x}"))
        close = close.join(mark("a"), "a", "left").join(mark("b"), "b", "left").filter("ga is null or gb is null or ga <> gb").select("a", "b")
    close = saved(close, "near-close", files)
    asked = close.select(F.col("a").alias("node")).union(close.select("b"))
    asked = (asked if crowd is None else asked.union(crowd.select("node"))).distinct()
    texts = _texts_of(rows, nodes.join(asked, "node", "left_semi"), words)
    links = _verified(close, texts, words, percent, files)
    if crowd is not None:
        found, more = _family_links(met, large, texts, crowd, words, percent, met_rows)
        links = links.unionByName(found)
        if more is not None:
            links = links.unionByName(_verified(_plausible(more, nodes, percent), texts, words, percent, files))
    root = components(links, files)

    of = nodes.select("node", "k1", "k2", "first").join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    of = saved(of, "near-roots", files)
    least = of.groupBy("root").agg(F.min("first").alias("best"))
    of = saved(of.join(least, "root").select("k1", "k2", "best"), "near-components", files)
    out = seen.filter("n > 0").select("doc_id", "tid", "n", "k1", "k2").join(of, ["k1", "k2"], "left")
    stays = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("tid") == F.col("best.tid"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.col("best.doc_id").alias("component_id"), F.col("tid").alias("text_hash"), stays.alias("stays"))
    alone = seen.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("tid").alias("text_hash"), F.lit(True).alias("stays"))
    out = out.unionByName(alone)
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "text_hash", "stays")
