"""Quality scores by positive-unlabelled learning.

Trusted positives (label 1) and unlabelled rows give the non-negative unbiased risk: the positives'
risk weighted by the class prior, plus the unlabelled rows' risk as negatives less the share of it
that the positives among them account for, never below zero. The prior is estimated from the same two
samples: where a model that tells them apart is most sure, unlabelled rows are as dense as their positives are. A logistic model over text statistics is fitted to that risk on the driver from a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirlake.llm.common import bernoulli, saved, spread

#: Rows of the fitting sample: trusted positives, and unlabelled rows. The only bounds here; scoring reads every row.
POSITIVES = 6_000
UNLABELLED = 20_000
STATS = 16


def held_out(row_id: Column, folds: int = 5, fold: int = 0) -> Column:
    """Rows that labels are never learned from; a null id is never held out and never learned from."""
    return F.coalesce(F.pmod(F.crc32(row_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def statistics(text: str) -> list[float]:
    """What the model sees of a text; an empty text has zeros for all but the constant-like terms."""
    raw = text.encode("utf-8", "replace")
    byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) if raw else np.zeros(256)
    n = max(len(text), 1)
    words = text.split()
    m = max(len(words), 1)
    distinct = len(set(words)) / m
    letters = byte[65:91].sum() + byte[97:123].sum()
    symbols = byte[[33, 35, 36, 37, 38, 42, 64, 94, 95, 124, 126]]
    lines = text.split("\n")
    length = np.log1p(m)
    return [
        length, np.log1p(n / m), distinct, distinct * length, sum(map(eq, words, words[1:])) / m,
        sum(map(eq, words, words[2:])) / m, byte[65:91].sum() / max(letters, 1), symbols.sum() / n, byte[124] / n,
        symbols[[1, 2, 3, 4, 5]].sum() / m, byte[33] / m, byte[48:58].sum() / n, byte[46] / m, byte[44] / m,
        len(set(lines)) / len(lines), byte[123] / n + byte[60] / n,
    ]


def _design(x: np.ndarray, middle: np.ndarray, spread: np.ndarray) -> np.ndarray:
    z = np.clip((x - middle) / spread, -6, 6)
    return np.hstack([np.ones((len(z), 1)), z, z * z / 6])


def fit_nnpu(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 1500, rate: float = 0.05, ridge: float = 1e-3, clip: bool = True):
    """(weights, middle, spread) minimising the non-negative PU risk with the logistic loss by Adam.

    Without ``clip`` the unlabelled rows are taken for negatives as they are, which tells the two samples apart.
    """
    middle = np.median(p, 0)
    spread = np.maximum(np.percentile(p, 90, 0) - np.percentile(p, 10, 0), 1e-2)
    p, u = _design(p, middle, spread), _design(u, middle, spread)
    w = np.zeros(p.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    sigmoid = lambda g: 1 / (1 + np.exp(-np.clip(g, -30, 30)))
    for t in range(1, steps + 1):
        sp, su = sigmoid(p @ w), sigmoid(u @ w)
        taken = prior if clip else 0.0
        as_negative = np.logaddexp(0, np.clip(u @ w, -30, 30)).mean() - taken * np.logaddexp(0, np.clip(p @ w, -30, 30)).mean()
        positive = -prior * (p.T @ (1 - sp)) / len(p)
        negative = u.T @ su / len(u) - taken * (p.T @ sp) / len(p)
        # Below zero the negative part is overfitted: step back along it, as the estimator asks.
        grad = positive + negative if as_negative >= 0 else -negative
        grad = grad + ridge * np.r_[0, w[1:]]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w, middle, spread


def _with_statistics(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([statistics(t.as_py()) for t in b["text"]], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b["doc_id"], x], ["doc_id", "x"])

    return rows.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<double>")


def _sample(rows: DataFrame, most: int) -> np.ndarray:
    """Statistics of at most ``most`` rows, drawn by the hashes of their ids, so the same however they are dealt.

    Rows are thinned out where they lie and leave as a few numbers each.
    """
    total = rows.select("doc_id").count()
    some = rows.filter(bernoulli(F.col("doc_id"), min(1.0, 1.2 * most / max(total, 1))))
    drawn = _with_statistics(some).orderBy(F.xxhash64("doc_id", F.lit("drawn")), "x").limit(most)
    return np.array([r.x for r in drawn.select("x").collect()], dtype=float).reshape(-1, STATS)


def estimate_prior(p: np.ndarray, u: np.ndarray, sure: float = 0.1) -> float:
    """The share of positives among unlabelled rows, from positives and unlabelled rows alone.

    A model tells the two samples apart on one half; on the other, the share of unlabelled rows scored
    above a bound, over that of positives, is the prior wherever everything above the bound is positive, and more
    elsewhere. The bound is taken where that ratio's upper confidence limit is least. Both halves take turns.
    """
    found = []
    for turn in (0, 1):
        # A single row leaves one of the halves empty, which cannot be fitted to or scored.
        if not all(len(x[half::2]) for x in (p, u) for half in (turn, 1 - turn)):
            continue
        w, middle, spread = fit_nnpu(p[turn::2], u[turn::2], 0.5, steps=400, clip=False)
        sp, su = (np.sort(_design(x[1 - turn :: 2], middle, spread) @ w) for x in (p, u))
        bounds = np.unique(np.quantile(sp, np.linspace(0, 0.98, 99)))
        qp, qu = (1 - np.searchsorted(x, bounds) / len(x) for x in (sp, su))
        slack = np.sqrt(np.log(4 / sure) / (2 * len(sp))) + np.sqrt(np.log(4 / sure) / (2 * len(su)))
        at = int(np.argmin((qu + slack) / np.maximum(qp, 1e-9)))
        found.append(qu[at] / max(qp[at], 1e-9))
    return float(np.clip(np.mean(found), 0.01, 0.99)) if found else 0.5


def score_quality(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text",
    positives: int = POSITIVES, unlabelled: int = UNLABELLED,
) -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted.

    ``labels`` is (doc_id, quality); ids whose crc32 mod 5 is 0 are held out of learning. Null text
    counts as empty and is scored; null ids are scored and not learned from; repeated rows keep a row
    each. Labels other than 1 are not used. With no positives to learn from every score is 0.5. An
    empty table gives no rows; other columns are not read.
    """
    rows = spread(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality")).filter("quality is not null and doc_id is not null").filter(~held_out(F.col("doc_id")))
    trusted = known.filter("quality = 1").select("doc_id").distinct()
    web = rows.filter("doc_id is not null").filter(~held_out(F.col("doc_id")))
    # Ids are drawn first: a bounded list, so that no text has to move to meet it.
    share = min(1.0, 1.2 * positives / max(trusted.count(), 1))
    drawn = trusted.filter(bernoulli(F.col("doc_id"), share)).orderBy(F.xxhash64("doc_id", F.lit("drawn"))).limit(positives)
    trusted = saved(drawn, "trusted", 1)
    model = None
    p = _sample(web.join(F.broadcast(trusted), "doc_id", "left_semi"), positives)
    u = _sample(web, unlabelled) if len(p) else p
    if len(p) and len(u):
        model = fit_nnpu(p, u, estimate_prior(p, u))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if model is None:
                score = np.full(b.num_rows, 0.5)
            else:
                w, middle, spread = model
                x = np.array([statistics(t.as_py()) for t in b["text"]]).reshape(-1, STATS)
                score = 1 / (1 + np.exp(-np.clip(_design(x, middle, spread) @ w, -30, 30)))
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["held_out"], pa.array(score, pa.float64())], ["doc_id", "held_out", "score"])

    out = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double")
    out = saved(out, "quality")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
