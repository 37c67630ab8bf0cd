"""Token counts by byte-pair merging with a heap and a linked list.

A text falls into blocks between ASCII white space, and a block into pieces as the vocabulary file's own
normaliser and pre-tokenizer say. Blocks and pieces met lately are remembered; any other piece is merged: adjacent pairs wait in a heap by
rank, the lowest-ranked pair is popped and merged in a linked list of symbols until no pair is left. A
piece has as many tokens as it had symbols less its merges, so no token identifier is ever looked up.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirlake.llm.common import once_a_worker, saved, spread

#: Blocks, and pieces, that a Python worker remembers are twice as many at most.
MOST_WORDS = 500_000
#: Longer blocks and pieces are looked at whenever they occur.
LONG_WORD = 64
#: Characters below this have no combining forms; for those the rules can be run by ``re``, where it gives what the library gives.
QUICK = 0x250
#: ASCII white space, where ``bytes.split`` cuts.
SPACE = " \t\n\r\x0b\x0c"


def load_spec(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def _steps(part: dict | None, name: str) -> list[dict]:
    if part is None:
        return []
    return [x for p in part[name] for x in _steps(p, name)] if part["type"] == "Sequence" else [part]


class Pieces:
    """Splits blocks of text into the pieces that the vocabulary's own rules give.

    Only files whose rules never look across ASCII white space are taken, so that a text's tokens are
    those of its blocks one after the other; others are refused with a ValueError.
    """

    def __init__(self, spec: dict):
        from tokenizers import Tokenizer

        self._check(spec)
        self.tokenizer = Tokenizer.from_str(json.dumps(spec | {"truncation": None, "padding": None}))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.byte = {x: b for b, x in enumerate(_byte_symbols())}
        for c in SPACE:
            if self.library(f"a{c}{c}'b1{c}.") != self.library("a") + self.library("'b1") + self.library("."):
                raise ValueError("the vocabulary's rules do not drop white space")
        self._learn_quick(_steps(spec["pre_tokenizer"], "pretokenizers")[:-1])

    def _learn_quick(self, splits: list[dict]) -> None:
        """The file's pattern for ``re``, and the characters for which it gives what the library does."""
        self.quick, self.known = None, re.compile(r"(?!)")
        if len(splits) != 1 or "Regex" not in splits[0]["pattern"]:
            return
        spoken = [chr(c) for c in range(QUICK)]
        members = lambda f: "".join(re.escape(c) for c in spoken if f(c))
        pattern = splits[0]["pattern"]["Regex"]
        for name, f in (("\\p{L}", str.isalpha), ("\\p{N}", lambda c: unicodedata.category(c)[0] == "N"), ("\\s", lambda c: not self.library(c))):
            pattern = pattern.replace(name, members(f))
        # Blocks may come many at a time, a line feed between them, which comes out as it is.
        self.quick = re.compile(pattern + "|\n").findall

        def same(text: str) -> bool:
            return self.quick(text.lower()) == self.library(text)

        good = [c for c in spoken if all(map(same, (f"ab{c}cd", f"1{c}2", f"{c}'s", f".{c}{c}.", f"A{c}1", f"'{c}")))]
        self.known = re.compile("[\\n" + "".join(map(re.escape, good)) + "]*")

    @staticmethod
    def _check(spec: dict) -> None:
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or odd:
            raise ValueError(f"not a plain byte-pair model: {model['type']} {odd}")
        for step in _steps(spec["normalizer"], "normalizers"):
            if step["type"] not in ("NFC", "Lowercase") and not (step["type"] == "Replace" and step["pattern"] == {"Regex": "\\s+"} and step["content"] == " "):
                raise ValueError(f"normaliser not supported: {step}")
        *splits, last = _steps(spec["pre_tokenizer"], "pretokenizers") or [{"type": "none"}]
        if last["type"] != "ByteLevel" or last["add_prefix_space"] or last.get("use_regex", True):
            raise ValueError("the last step of the pre-tokenizer must be bytes alone")
        if not splits or any(s["type"] != "Split" or s["behavior"] != "Removed" or not s["invert"] for s in splits):
            raise ValueError("the pre-tokenizer must keep what its patterns match and drop all else")
        for t in spec["added_tokens"]:
            if t["normalized"] or t["single_word"] or any(c.isspace() for c in t["content"]):
                raise ValueError(f"added token not supported: {t['content']!r}")
        symbols = _byte_symbols()
        end = model.get("end_of_word_suffix") or ""
        if not all(x in model["vocab"] and x + end in model["vocab"] for x in symbols):
            raise ValueError("the vocabulary lacks bytes")

    def library(self, text: str) -> list[str]:
        """Pieces of a text without special strings, by the library."""
        rules = self.tokenizer
        shaped = rules.normalizer.normalize_str(text) if rules.normalizer else text
        return [bytes(map(self.byte.__getitem__, p)).decode() for p, _ in rules.pre_tokenizer.pre_tokenize_str(shaped)]

    def flat(self, blocks: str) -> bool:
        """Whether ``quick`` gives the pieces of these blocks, once their letters are lowered."""
        return self.known.fullmatch(blocks) is not None and (self.cut is None or self.cut.search(blocks) is None)

    def __call__(self, block: str) -> list[tuple[bool, str]]:
        """(special, piece) of a block, in order."""
        if self.cut is None or not self.cut.search(block):
            return [(False, p) for p in self.library(block)]
        return [x for p in self.cut.split(block) if p for x in ([(True, p)] if p in self.special else [(False, q) for q in self.library(p)])]


class Blocks:
    """What ``combine`` makes of a text's blocks, and of a block's pieces, those met lately remembered.

    When a table is full it becomes the old one and a new one is begun, into which what is still in use moves.
    """

    def __init__(self, spec: dict, of_piece, of_special, combine):
        # White space at an end leaves an empty block there, which is nothing, as it should be.
        self.pieces, self.of_piece, self.of_special, self.combine = Pieces(spec), of_piece, of_special, combine
        self.blocks, self.old_blocks, self.known, self.old_known = {}, {}, {}, {}

    def _piece(self, piece: str):
        value = self.known.get(piece)
        if value is None:
            value = self.old_known.get(piece)
            if value is None:
                value = self.of_piece(piece)
            if len(piece) <= LONG_WORD:
                self.known[piece] = value
        return value

    def _learn(self, new: set[bytes]) -> None:
        old, ask = self.old_blocks, []
        for w in new:
            value = old.get(w)
            if value is None:
                ask.append(w)
            else:
                self.blocks[w] = value
        if not ask:
            return
        joined = b"\n".join(ask).decode()
        if self.pieces.quick is None or not self.pieces.flat(joined):
            easy = []
            for w in ask:
                if self.pieces.quick is not None and self.pieces.flat(w.decode()):
                    easy.append(w)
                else:
                    self.blocks[w] = self.combine(self.of_special(p) if special else self._piece(p) for special, p in self.pieces(w.decode()))
            if not easy:
                return
            ask, joined = easy, b"\n".join(easy).decode()
        at, got, known = iter(ask), [], self.known
        for p in self.pieces.quick(joined.lower() + "\n"):
            if p == "\n":
                self.blocks[next(at)] = self.combine(got)
                got = []
            else:
                value = known.get(p)
                got.append(self._piece(p) if value is None else value)

    def batch(self, texts: pa.Array) -> tuple[list, np.ndarray, np.ndarray]:
        """(value of each distinct block, which of them each block is, where each text's blocks begin, and the last one's end)."""
        parts = pc.ascii_split_whitespace(texts)
        coded = parts.flatten().dictionary_encode()
        blocks = coded.dictionary.cast(pa.binary()).to_pylist()
        new = set(blocks).difference(self.blocks)
        if new:
            self._learn(new)
        values = list(map(self.blocks.__getitem__, blocks))
        for w in new:
            if len(w) > LONG_WORD:
                del self.blocks[w]
        if len(self.blocks) > MOST_WORDS:
            self.old_blocks, self.blocks = self.blocks, {}
        if len(self.known) > MOST_WORDS:
            self.old_known, self.known = self.known, {}
        return values, coded.indices.to_numpy(), parts.offsets.to_numpy()


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, more = {b: chr(b) for b in shown}, 0
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + more)
            more += 1
    return [out[b] for b in range(256)]


class Counts(Blocks):
    """Numbers of tokens, by merging."""

    def __init__(self, spec: dict):
        model = spec["model"]
        pairs = (tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"])
        self.rank = {p: i for i, p in enumerate(pairs)}
        self.end, self.symbol = model.get("end_of_word_suffix") or "", _byte_symbols()
        super().__init__(spec, self.merged, lambda special: 1, sum)

    def of(self, texts: pa.Array) -> np.ndarray:
        """Each text's number of tokens."""
        values, which, at = self.batch(texts)
        total = np.concatenate([[0], np.cumsum(np.array(values, np.int64)[which])])
        return total[at[1:]] - total[at[:-1]]

    def merged(self, piece: str) -> int:
        """Tokens of a piece: its bytes less the merges."""
        sym: list[str | None] = [self.symbol[b] for b in piece.encode()]
        sym[-1] += self.end
        n = left = len(sym)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        rank = self.rank
        heap = [(r, i, sym[i], sym[i + 1]) for i in range(n - 1) if (r := rank.get((sym[i], sym[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j < 0 or sym[i] != a or sym[j] != b:
                continue  # one of the two has been merged since
            sym[i], sym[j] = a + b, None
            left -= 1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                if (r := rank.get((sym[i], sym[k]))) is not None:
                    heapq.heappush(heap, (r, i, sym[i], sym[k]))
            if (h := before[i]) >= 0 and (r := rank.get((sym[h], sym[i]))) is not None:
                heapq.heappush(heap, (r, h, sym[h], sym[i]))
        return left


def count_tokens(
    docs: DataFrame, vocabulary: str, limit: int = 2048, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more tokens than ``limit``).

    ``vocabulary`` is the path of a BPE file with word ends, present on every worker; a file whose rules
    are not supported raises ValueError. Special strings inside a text count as one token. Null text
    counts as empty (0 tokens); repeated rows and null ids keep a row each; an empty table gives none;
    other columns are not read. Whole texts are counted.
    """
    rows = spread(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = once_a_worker(f"counts {vocabulary}", lambda: Counts(load_spec(vocabulary)))
        for b in batches:
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["n_bytes"], pa.array(counts.of(b["text"]))], ["doc_id", "n_bytes", "n_tokens"])

    sized = rows.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    out = saved(sized.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long"), "token-counts")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
