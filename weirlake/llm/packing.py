"""Best-fit packing by exact complements.

Documents become pieces of at most ``size`` tokens. Only the histogram of piece lengths, at most
``size`` numbers whatever the corpus, goes to the driver. There an index of the sums of one, two and three lengths
tells each length what exactly fills the rest of its sequence, as often as their counts allow; what is left is packed
best-fit decreasing. The resulting plan gives a piece its place from its length and its rank among
the pieces of that length, so pieces are placed where they lie.
"""

from __future__ import annotations

import itertools
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirlake.llm.common import once_a_worker, saved, spread
from weirlake.llm.tokens import Blocks, _byte_symbols, load_spec


class Ids(Blocks):
    """Ids as little-endian unsigned 32-bit bytes, by the tokenizers library."""

    def __init__(self, spec: dict):
        super().__init__(spec, self.encoded, lambda special: self.pieces.special[special].to_bytes(4, "little"), b"".join)
        # Pieces come normalised and split; a character a byte is what the model merges.
        self.model, self.shown = self.pieces.tokenizer.model, dict(enumerate(_byte_symbols()))

    def encoded(self, piece: str) -> bytes:
        ids = array("I", [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.shown))])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each text's begin, and the last one's end)."""
        values, which, at = self.batch(texts)
        pool = np.frombuffer(b"".join(values), "<u4")
        many = np.fromiter(map(len, values), np.int64, len(values)) // 4
        start, n = (np.cumsum(many) - many)[which], many[which]
        total = np.concatenate([[0], np.cumsum(n)])
        return pool[np.repeat(start - total[:-1], n) + np.arange(total[-1])], total[at]


def pieces_of(docs: DataFrame, vocabulary: str, size: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, nth): ``nth`` counts a part's pieces of that length from 0."""
    rows = spread(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = once_a_worker(f"ids {vocabulary}", lambda: Ids(load_spec(vocabulary)))
        end, step = np.array([end_id], "<u4").tobytes(), 4 * size
        part, seen = TaskContext.get().partitionId(), [0] * (size + 1)
        for b in batches:
            row, piece, length, crc, nth = [], [], [], [], []
            flat, at = ids.of(b["text"])
            for i, (first, last) in enumerate(itertools.pairwise(at.tolist())):
                every = flat[first:last].tobytes() + end
                for k in range(0, len(every), step):
                    own = every[k : k + step]
                    n = len(own) // 4
                    row.append(i)
                    piece.append(k // step)
                    length.append(n)
                    crc.append(zlib.crc32(own))
                    nth.append(seen[n])
                    seen[n] += 1
            piece_no = np.array(piece, "int64")
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"].take(pa.array(row, pa.int64())), pa.array(piece_no.astype("int32")), pa.array(piece_no * size), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([part] * len(row), pa.int32()), pa.array(nth, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"],
            )

    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long")


class Sums:
    """Hash index of the sums of one, two and three available lengths, for exact complements.

    ``two[s, a]`` says that ``a`` and ``s - a`` (no longer than ``a``) are available, ``three[s, a]`` that ``a`` is and some
    pair sums to ``s - a``. A length that runs out leaves the index in one sweep over its column and diagonal. Entries
    know lengths, not how many there are: a look-up checks that against the counts.
    """

    def __init__(self, count: np.ndarray):
        size = len(count) - 1
        have, at = count > 0, np.arange(size + 1)
        self.count, self.size, self.have = count, size, have
        rest = at[:, None] - at[None, :]
        ok = (rest >= 1) & (rest <= at[None, :])
        self.two = ok & have[None, :] & have[np.where(ok, rest, 0)]
        self.pairs = self.two.sum(1)
        # The longest of three comes first: what is left for the other two is at most twice as long.
        ok = (rest >= 2) & (rest <= 2 * at[None, :])
        self.three = ok & have[None, :] & (self.pairs > 0)[np.where(ok, rest, 0)]

    def gone(self, n: int) -> None:
        """Length ``n`` has run out."""
        self.have[n] = False
        before = self.pairs > 0
        self.pairs -= self.two[:, n]
        self.two[:, n] = False
        s = np.arange(n, self.size + 1)  # sums whose shorter part is n
        self.pairs[s] -= self.two[s, s - n]
        self.two[s, s - n] = False
        self.three[:, n] = False
        for p in np.flatnonzero(before & (self.pairs == 0)):
            s = np.arange(p, self.size + 1)
            self.three[s, s - p] = False

    def _enough(self, lengths: tuple[int, ...], taken: int) -> bool:
        """Whether there are as many of each, besides the one of length ``taken`` that waits to be completed."""
        return all(self.count[n] >= lengths.count(n) + (n == taken) for n in lengths)

    def pair(self, total: int, most: int, also: tuple[int, ...], taken: int) -> tuple[int, int] | None:
        for a in np.flatnonzero(self.two[total, : most + 1])[::-1]:
            found = (int(a), total - int(a))
            if self._enough((*also, *found), taken):
                return found
        return None

    def complement(self, gap: int, taken: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that add up to ``gap``, the fewest and largest first."""
        if gap <= 0:
            return None
        if self.have[gap] and self._enough((gap,), taken):
            return (gap,)
        if found := self.pair(gap, gap, (), taken):
            return found
        for a in np.flatnonzero(self.three[gap])[::-1]:
            if found := self.pair(gap - int(a), int(a), (int(a),), taken):
                return (int(a), *found)
        return None


def plan_sequences(histogram: dict[int, int], size: int) -> tuple[list[tuple[dict[int, int], int]], int]:
    """([(pieces of each length in a sequence, how many sequences alike)], sequences in all)."""
    count = np.zeros(size + 1, "int64")
    for n, c in histogram.items():
        count[n] = c
    sums = Sums(count)
    out: list[tuple[dict[int, int], int]] = []

    def take(lengths: tuple[int, ...]) -> None:
        need: dict[int, int] = {}
        for n in lengths:
            need[n] = need.get(n, 0) + 1
        times = min(int(count[n]) // k for n, k in need.items())
        for n, k in need.items():
            count[n] -= times * k
            if not count[n]:
                sums.gone(n)
        out.append((need, times))

    if count[size]:
        take((size,))
    for n in range(size - 1, 0, -1):
        while count[n] and (found := sums.complement(size - n, n)):
            take((n, *found))
    # Best fit decreasing over what is left; sequences with equal content are handled together.
    open_: dict[int, list[tuple[dict[int, int], int]]] = {}
    for n in range(size, 0, -1):
        left = int(count[n])
        while left:
            gap = min((g for g in open_ if g >= n), default=None)
            if gap is None:
                k = size // n
                times, rest = divmod(left, k)
                if times:
                    open_.setdefault(size - k * n, []).append(({n: k}, times))
                if rest:
                    open_.setdefault(size - rest * n, []).append(({n: rest}, 1))
                break
            has, times = open_[gap].pop()
            used = min(left, times)
            if used < times:
                open_[gap].append((has, times - used))
            if not open_[gap]:
                del open_[gap]
            open_.setdefault(gap - n, []).append((has | {n: has.get(n, 0) + 1}, used))
            left -= used
    out += [x for same in open_.values() for x in same]
    return out, sum(times for _, times in out)


def placements(plan: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, pieces a sequence, first sequence, first offset), by length and rank."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for has, times in plan:
        at = 0
        for n, k in sorted(has.items(), reverse=True):
            rows.append((n, rank.get(n, 0), k, sequence, at))
            rank[n] = rank.get(n, 0) + times * k
            at += n * k
        sequence += times
    return np.array(sorted(rows), "int64").reshape(-1, 5)


def pack(
    docs: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and then ``end_id``; only longer ones are cut, into pieces of ``size`` and a
    rest. Null text counts as empty (one piece of one id); repeated rows and null ids are packed as rows of
    their own; an empty table gives no pieces; other columns are not read. ``vocabulary`` is a path
    present on every worker.
    """
    spark = docs.sparkSession
    pieces = saved(pieces_of(docs, vocabulary, size, end_id, id_col, text_col), "pieces")
    by_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(placements(plan_sequences(histogram, size)[0]))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = table.value
        key = (rows[:, 0] << 48) + rows[:, 1]
        for b in batches:
            length = b["length"].to_numpy(zero_copy_only=False)
            rank = pc.add(b["earlier"], b["nth"]).to_numpy(zero_copy_only=False)
            own = rows[np.searchsorted(key, (length << 48) + rank, side="right") - 1] if len(length) else rows[:0]
            at = rank - own[:, 1]
            cols = [b[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(own[:, 3] + at // own[:, 2]), pa.array(own[:, 4] + at % own[:, 2] * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return pieces.join(offsets, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", "nth", "earlier").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
