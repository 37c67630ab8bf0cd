"""Language identification by a linear-chain conditional random field.

Each word of a text is labelled with a language: its affixes, character n-grams and its entry in the
lexicon weigh for each language, learned transitions tie neighbours together, and forward-backward
gives each word's posterior in code-switched text. A document's language has the largest share.
Long texts are chained whole: words are processed in blocks whose transfer matrices are multiplied,
which gives the same posteriors as going word by word.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirlake.llm.common import once_a_worker, saved, spread

#: Bounds of the fitting sample: documents of each language, and characters of one of them.
SAMPLE_DOCS = 300
#: Documents of all languages together in the fitting sample.
SAMPLE_TOTAL = 12_000
SAMPLE_CHARS = 20_000
FEATURES = 1 << 17
#: A table of so many language names at most is broadcast.
MOST_LANGS = 10_000
MOST_WORDS = 200_000
#: Texts looked at together: their new words are in memory with all their features.
TEXTS = 400
#: Words chained at once in a worker.
CHAIN = 400_000
BLOCK = 128
WORD = re.compile(r"[^\W\d_]+")
#: Longer runs of letters, such as texts written without spaces, are as many words of at most so many letters.
LONGEST = 40


def words_of(text: str) -> list[str]:
    """The runs of letters of a text, lower-cased; numerals that are no letters (``½``, ``²``, ``①``) part them."""
    words = WORD.findall(text.lower())
    if not all(map(str.isalpha, words)):
        words = [x for w in words for x in "".join(c if c.isalpha() else " " for c in w).split()]
    if max(map(len, words), default=0) > LONGEST:
        words = [w[at : at + LONGEST] for w in words for at in range(0, len(w), LONGEST)]
    return words


def features_of(words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Hashed features as (words that have it, hash) for each kind and place; a word is there once at most.

    Kinds are the word itself, prefixes up to 3, suffixes up to 4, character trigrams with the word's
    edges, and each character beyond ASCII. Words have ``LONGEST`` letters at most (``words_of``).
    """
    short = [f"^{w}$" for w in words]
    size = np.fromiter(map(len, short), np.int64, len(short))
    width = int(size.max(initial=0))
    code = np.array(short, dtype=f"U{max(width, 1)}").view(np.uint32).reshape(len(short), -1).astype(np.uint64)
    every = np.arange(len(short))

    def mixed(kind: int, *parts) -> np.ndarray:
        h = np.uint64((kind + 1) * 0x9E3779B97F4A7C15 % 2**64)
        for x in parts:
            h = (h ^ x) * np.uint64(0xC2B2AE3D27D4EB4F)
            h = h ^ (h >> np.uint64(29))
        return (h % np.uint64(FEATURES)).astype(np.int64)

    whole = np.zeros(len(short), np.uint64)
    for i in range(width):
        has = size > i
        whole[has] = whole[has] * np.uint64(0x100000001B3) ^ code[has, i]
    out = [(every, mixed(0, whole))]
    for k in (1, 2, 3):
        rows = every[size >= k + 2]
        if len(rows):
            out.append((rows, mixed(k, *(code[rows, 1 + i] for i in range(k)))))
    for k in (1, 2, 3, 4):
        rows = every[size >= k + 2]
        if len(rows):
            out.append((rows, mixed(10 + k, *(code[rows, size[rows] - 1 - k + i] for i in range(k)))))
    for i in range(width - 2):
        rows = every[size > i + 2]
        out.append((rows, mixed(20, code[rows, i], code[rows, i + 1], code[rows, i + 2])))
    for i in range(1, width):
        rows = every[(size > i) & (code[:, i] > 127)]
        if len(rows):
            out.append((rows, mixed(30, code[rows, i])))
    return out


def _sequences(texts: dict[str, list[list[str]]], langs: list[str], rng, count: int, length: int):
    """Code-switched training sequences: runs of words from random documents of random languages."""
    xs, ys = [], []
    for _ in range(count):
        x, y = [], []
        while len(x) < length:
            k = int(rng.integers(len(langs)))
            doc = texts[langs[k]][int(rng.integers(len(texts[langs[k]])))]
            run = int(rng.integers(4, 40))
            at = int(rng.integers(max(1, len(doc) - run + 1)))
            x += doc[at : at + run]
            y += [k] * len(doc[at : at + run])
        xs.append(x[:length])
        ys.append(y[:length])
    return xs, np.array(ys)


def fit_crf(texts: dict[str, list[str]], epochs: int = 4, count: int = 1200, length: int = 64, rate: float = 0.3, seed: int = 7):
    """(languages, feature weights, transitions, starts) by gradient ascent on the conditional likelihood."""
    docs = {k: [w for t in v if (w := words_of(t))] for k, v in texts.items()}
    docs = {k: v for k, v in docs.items() if v}
    langs, rng = sorted(docs), np.random.default_rng(seed)
    size = len(langs)
    if not size:
        return langs, np.zeros((FEATURES, 0)), np.zeros((0, 0)), np.zeros(0)
    xs, y = _sequences(docs, langs, rng, count, length)
    vocab = {w: i for i, w in enumerate(dict.fromkeys(w for x in xs for w in x))}
    feats = features_of(list(vocab))
    of, flat = np.concatenate([r for r, _ in feats]), np.concatenate([h for _, h in feats])
    order = np.argsort(of, kind="stable")
    flat, start = flat[order], np.r_[0, np.cumsum(np.bincount(of, minlength=len(vocab)))]
    ids = np.array([[vocab[w] for w in x] for x in xs])
    weight, trans, first = np.zeros((FEATURES, size)), np.zeros((size, size)), np.zeros(size)
    sq_w, sq_t, sq_f = np.full_like(weight, 1e-6), np.full_like(trans, 1e-6), np.full_like(first, 1e-6)
    batch = 60
    for _ in range(epochs):
        order = rng.permutation(count)
        for b in range(0, count, batch):
            own = order[b : b + batch]
            word, gold = ids[own], y[own]
            kinds, where = np.unique(word, return_inverse=True)
            rows = np.concatenate([flat[start[k] : start[k + 1]] for k in kinds])
            lens = start[kinds + 1] - start[kinds]
            emit = np.add.reduceat(weight[rows], np.r_[0, np.cumsum(lens)[:-1]], 0)
            e = emit[where.reshape(word.shape)]
            e = np.exp(e - e.max(2, keepdims=True))
            move, n = np.exp(trans), len(own)
            alpha, beta = np.empty((n, length, size)), np.ones((n, length, size))
            a = np.exp(first) * e[:, 0]
            alpha[:, 0] = a / a.sum(1, keepdims=True)
            for t in range(1, length):
                a = (alpha[:, t - 1] @ move) * e[:, t]
                alpha[:, t] = a / a.sum(1, keepdims=True)
            pair = np.zeros((size, size))
            for t in range(length - 2, -1, -1):
                after = e[:, t + 1] * beta[:, t + 1]
                both = alpha[:, t, :, None] * move * after[:, None, :]
                pair += (both / both.sum((1, 2), keepdims=True)).sum(0)
                g = after @ move.T
                beta[:, t] = g / g.sum(1, keepdims=True)
            post = alpha * beta
            post /= post.sum(2, keepdims=True)
            hot = np.eye(size)[gold]
            seen = np.zeros((size, size))
            np.add.at(seen, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
            diff = np.zeros((len(kinds), size))
            np.add.at(diff, where.ravel(), (hot - post).reshape(-1, size))
            grad = np.zeros_like(weight)
            np.add.at(grad, rows, np.repeat(diff, lens, 0))
            for x, sq, g in ((weight, sq_w, grad / n), (trans, sq_t, (seen - pair) / n), (first, sq_f, (hot[:, 0] - post[:, 0]).sum(0) / n)):
                sq += g * g
                x += rate * g / np.sqrt(sq)
    return langs, weight.astype("float32"), trans, first


def posteriors(emit: np.ndarray, opens: np.ndarray, trans: np.ndarray, first: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Forward-backward over many texts laid end to end.

    ``emit`` has each word's (positive) emission weights and ``opens`` marks the words that begin a
    text, where the chain starts anew. Returns each word's posterior.
    """
    n, size = emit.shape
    blocks = -(-n // block)
    pad = blocks * block - n
    e = np.vstack([emit, np.ones((pad, size))]).reshape(blocks, block, size)
    new = np.r_[opens, np.ones(pad, bool)].reshape(blocks, block)
    move, begin = np.exp(trans), np.exp(first)
    # Each block's transfer matrix: from the state before its first word to that of its last.
    through = np.broadcast_to(np.eye(size), (blocks, size, size)).copy()
    for t in range(block):
        went = through @ move
        opened = new[:, t]
        if opened.any():
            went[opened] = through[opened].sum(2, keepdims=True) * begin
        through = went * e[:, t, None, :]
        through /= through.sum((1, 2), keepdims=True)
    ahead, behind = np.empty((blocks, size)), np.empty((blocks, size))
    a = np.full(size, 1 / size)
    for c in range(blocks):
        ahead[c] = a
        a = a @ through[c]
        a = a / a.sum()
    b = np.full(size, 1 / size)
    for c in range(blocks - 1, -1, -1):
        behind[c] = b
        b = through[c] @ b
        b = b / b.sum()
    alpha = np.empty((blocks, block, size))
    a = ahead
    for t in range(block):
        a = np.where(new[:, t, None], begin, a @ move) * e[:, t]
        a = a / a.sum(1, keepdims=True)
        alpha[:, t] = a
    b = behind
    for t in range(block - 1, -1, -1):
        alpha[:, t] *= b
        b = np.where(new[:, t, None], (begin * e[:, t] * b).sum(1, keepdims=True), (e[:, t] * b) @ move.T)
        b = b / b.sum(1, keepdims=True)
    post = alpha.reshape(-1, size)[:n]
    return post / post.sum(1, keepdims=True)


class Labeller:
    """A fitted field with the emissions of the words met so far."""

    def __init__(self, model):
        self.langs, self.weight, self.trans, self.first = model
        self.table: dict[str, int] = {}
        self.emit = np.empty((0, len(self.langs)))

    def rows_of(self, words: list[str]) -> np.ndarray:
        if len(self.table) > MOST_WORDS:
            self.table, self.emit = {}, self.emit[:0]
        table = self.table
        fresh = [w for w in dict.fromkeys(words) if w not in table]
        if fresh:
            rows = np.zeros((len(fresh), len(self.langs)))
            for who, h in features_of(fresh):
                rows[who] += self.weight[h]
            rows = np.exp(np.maximum(rows - rows.max(1, keepdims=True), -30))
            for i, w in enumerate(fresh, len(table)):
                table[w] = i
            self.emit = np.vstack([self.emit, rows])
        return np.fromiter(map(table.__getitem__, words), np.int64, len(words))

    def label(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Each text's word posteriors."""
        flat = [w for t in texts for w in t]
        if not flat:
            return [np.empty((0, len(self.langs))) for _ in texts]
        opens = np.zeros(len(flat), bool)
        ends = np.cumsum([len(t) for t in texts])
        opens[[e - len(t) for e, t in zip(ends, texts, strict=True) if t]] = True
        at = self.rows_of(flat)
        post = posteriors(self.emit[at], opens, self.trans, self.first)
        return np.split(post, ends[:-1])

    def shares(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Each text's share of every language, texts chained together up to a bounded number of words."""
        out: list[np.ndarray] = []
        some: list[list[str]] = []
        held = 0
        for t in [*texts, None]:
            if some and (t is None or held + len(t) > CHAIN):
                out += [p.mean(0) if len(p) else np.zeros(len(self.langs)) for p in self.label(some)]
                some, held = [], 0
            if t is not None:
                some.append(t)
                held += len(t)
        return out


def held_out(row_id: Column, folds: int = 3, fold: int = 1) -> Column:
    """Rows never learned from; a null id is neither held out nor learned from."""
    return F.coalesce(F.pmod(F.crc32(row_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def fit_languages(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS):
    """A field fitted to (doc_id, text, lang) from a bounded sample of rows that are not held out.

    Up to about ``sample_docs`` documents of each language, of longer ones a window of ``sample_chars`` characters that begins at a
    place drawn by the id's hash, and no more than ``SAMPLE_TOTAL`` in all, shared equally where there are many languages.
    """
    rows = docs.filter("doc_id is not null and text is not null and lang is not null").filter(~held_out(F.col("doc_id")))
    begin = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("window")), F.char_length("text").cast("long") - sample_chars + 1).cast("int") + 1
    window = F.when(F.char_length("text") <= sample_chars, F.col("text")).otherwise(F.substr("text", begin, F.lit(sample_chars)))
    # One row a language: how many documents it has, and so what share of them to draw.
    counts = saved(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("total")), "languages")
    langs = counts.count()
    sample_docs = max(1, min(sample_docs, SAMPLE_TOTAL // max(1, langs)))
    share = F.least(F.lit(1.0), F.lit(1.2 * sample_docs) / F.col("total"))
    drawn = rows.join(F.broadcast(counts) if langs <= MOST_LANGS else counts, "lang").filter(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1_000_000)) < share * 1_000_000)
    texts: dict[str, list[str]] = {}
    for r in drawn.select("lang", window.alias("text")).limit(2 * SAMPLE_TOTAL).collect():
        texts.setdefault(r["lang"], []).append(r["text"])
    texts = {k: sorted(v)[:sample_docs] for k, v in sorted(texts.items())}
    return fit_crf(texts)


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", model=None, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, shares (one per language, in order of name).

    Texts that are null or have no letter are ``und`` with score 0, as are all where nothing could be
    learned. Only ``text`` is used to predict; ``lang`` only to learn. Null ids and null languages are not learned
    from; repeated rows keep a row each; ties go to the first name; other columns are not read, but for
    those of ``carry``, which come out unchanged as a struct ``carried``.
    """
    rows = spread(docs).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
        F.struct(F.lit(True).alias("_"), *(F.col(c) for c in carry)).alias("carried"),
    )
    model = model or fit_languages(rows)
    model, token = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = once_a_worker("labeller", dict)
        if held.get("id") != token:
            held.clear()
            held |= {"id": token, "labeller": Labeller(model.value)}
        labeller = held["labeller"]
        langs = labeller.langs
        for b in batches:
            pred, score, shares = [], [], []
            for at in range(0, b.num_rows, TEXTS):
                texts = [words_of(t) if (t := x.as_py()) and langs else [] for x in b["text"].slice(at, TEXTS)]
                for t, s in zip(texts, labeller.shares(texts), strict=True):
                    k = int(s.argmax()) if t else -1
                    pred.append(langs[k] if t else "und")
                    score.append(float(min(1.0, s[k])) if t else 0.0)
                    shares.append([float(x) for x in s] if t else [])
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], b["held_out"], pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(shares, pa.list_(pa.float64())), *kept(b)],
                ["doc_id", "held_out", "lang_pred", "score", "shares", *(["carried"] if carry else [])],
            )

    kept = lambda b: [b["carried"]] if carry else []
    asked = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text", *(["carried"] if carry else []))
    more = f", carried {rows.schema['carried'].dataType.simpleString()}" if carry else ""
    # Written here, so that texts go to the workers in small batches.
    return saved(asked.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, shares array<double>" + more), "languages-found")
