"""Periodic runs of words: stretches that repeat a block of words four times or more.

Names of blocks of one, two, four, ... words are made by pairing (Karp, Miller and Rosenberg): the name of a block is
the rank of its halves' names, so blocks are equal exactly if their names are. How far two places agree is read off from
the names by descending levels. A run of period p is so long that one of its places on a grid, which is the
coarser the larger p, begins a named block that recurs p words later; such places are extended both ways by names
alone. All places of a text go through each level together, in NumPy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pyspark.sql import functions as F

from weirlake.llm.common import saved, spread

#: Places extended together; bounds the working memory of a long text beside its names.
TOGETHER = 1 << 18
RESULT = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, strongest struct<start:long,length:long,period:long>, collapsed string"


def names(ids: np.ndarray) -> list[np.ndarray]:
    """Names of all blocks of 1, 2, 4, ... words, by start, up to the last length at which two blocks are equal."""
    levels = []
    now = np.unique(ids, return_inverse=True)[1].astype("int32")
    while len(now):
        distinct = int(now.max()) + 1
        if distinct == len(now):
            break
        levels.append(now)
        half = 1 << (len(levels) - 1)
        if len(now) <= half:
            break
        pairs = now[:-half].astype("int64") * distinct + now[half:]
        now = np.unique(pairs, return_inverse=True)[1].astype("int32")
    return levels


def agree_after(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words from ``i`` on equal those from ``j`` on (i < j), pair by pair."""
    i, j = i.copy(), j.copy()
    begun = i.copy()
    for k in range(len(levels) - 1, -1, -1):
        own = levels[k]
        fits = j < len(own)
        same = np.zeros(len(i), bool)
        same[fits] = own[i[fits]] == own[j[fits]]
        i += same.astype("int64") << k
        j += same.astype("int64") << k
    return i - begun


def agree_before(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many words before ``i`` equal those before ``j`` (i < j), pair by pair."""
    i, j = i.copy(), j.copy()
    begun = i.copy()
    for k in range(len(levels) - 1, -1, -1):
        own, size = levels[k], 1 << k
        fits = i >= size
        same = np.zeros(len(i), bool)
        same[fits] = own[i[fits] - size] == own[j[fits] - size]
        i -= same.astype("int64") << k
        j -= same.astype("int64") << k
    return begun - i


def _grid(levels: list[np.ndarray], n: int, times: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, periods) that may lie in a run, in groups of bounded size.

    A run of period p has at least ``need`` places in a row that equal those p later. A block of 2^k of them begins
    on any grid of ``need - 2^k + 1``, and its name recurs p later.
    """
    i, p, held = [], [], 0
    for period in range(1, n // times + 1):
        need = max(least, times * period) - period
        k = ((need + 1) // 2).bit_length() - 1
        if k >= len(levels):
            break
        own, step = levels[k], need - (1 << k) + 1
        for begin in range(0, max(len(own) - period, 0), step * TOGETHER):
            at = np.arange(begin, min(len(own) - period, begin + step * TOGETHER), step)
            at = at[own[at] == own[at + period]]
            if not len(at):
                continue
            i.append(at)
            p.append(np.full(len(at), period, "int64"))
            held += len(at)
            if held >= TOGETHER:
                yield np.concatenate(i), np.concatenate(p)
                i, p, held = [], [], 0
    if held:
        yield np.concatenate(i), np.concatenate(p)


def find_runs(ids: np.ndarray, times: int = 4, least: int = 6) -> np.ndarray:
    """Rows (start, length, period) by start, then period, of all runs of a sequence of whole numbers.

    A run's period is the least of its stretch, its length at least ``times`` periods and ``least``, and no
    neighbour extends it. ``times`` is 2 or more: a stretch of that length with a period that is not its least has
    one that divides it, which is found as well and extends as far, so the least found for a stretch is its period.
    """
    n = len(ids)
    levels = names(ids) if n >= least else []
    found = [np.zeros((0, 3), "int64")]
    for i, p in _grid(levels, n, times, least):
        # A stretch met at an earlier place of the grid is not extended again from the next place in it.
        start = i - agree_before(levels, i, i + p)
        first = np.unique(np.stack([start, p], 1), axis=0)
        start, p = first[:, 0], first[:, 1]
        length = agree_after(levels, start, start + p) + p
        long = (length >= times * p) & (length >= least)
        found.append(np.stack([start, length, p], 1)[long])
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    same = np.r_[False, (rows[1:, :2] == rows[:-1, :2]).all(1)] if len(rows) else np.zeros(0, bool)
    rows = rows[~same]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def strongest(runs: np.ndarray) -> np.ndarray | None:
    """The run with the greatest length over period, compared exactly; ties go to the least start, then period."""
    best = None
    for run in runs.tolist():
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Whether each of ``n`` words stays when every run is cut to its first period."""
    change = np.zeros(n + 1, "int64")
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change)[:n] == 0


def periodic_runs(docs: DataFrame, times: int = 4, least: int = 6, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, runs, strongest (null without a run), collapsed.

    Words are what ASCII white space separates. ``collapsed`` joins by one space the words that no run repeats.
    Null and empty texts have no words, no runs and an empty ``collapsed``; rows that are repeated and null
    ids keep a row each; an empty table gives none; other columns are not read. A text is gone through whole in one
    task: its memory is a few bytes a word for each doubling of its longest repeat.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
        for b in batches:
            counts, every, best, left = [], [], [], []
            for value in b["text"]:
                # Bytes are split at space and \t to \r and nothing else.
                words = (value.as_py() or "").encode("utf-8").split()
                number: dict[bytes, int] = {}
                ids = np.fromiter((number.setdefault(w, len(number)) for w in words), "int64", len(words))
                runs = find_runs(ids, times, least)
                top = strongest(runs)
                counts.append(len(words))
                every.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.tolist()])
                best.append(top and dict(zip(("start", "length", "period"), top, strict=True)))
                if len(runs):
                    words = [w for w, stays in zip(words, kept_words(len(words), runs).tolist(), strict=True) if stays]
                left.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], pa.array(counts, pa.int64()), pa.array(every, pa.list_(run_type)), pa.array(best, run_type), pa.array(left, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "strongest", "collapsed"],
            )

    return spread(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, RESULT)


def saved_runs(docs: DataFrame, **options) -> DataFrame:
    """``periodic_runs`` written once, in small batches of whole texts, and read back."""
    return saved(periodic_runs(docs, **options), "runs")
