"""Personal data by weak supervision.

Patterns propose spans. Several labelers vote on each, for, against or not at all: a strict check of the form, a
gazetteer, the words before it, and its surroundings; none of them is trusted outright. Expectation-maximisation over the
counts of vote patterns of a kind (a table whose size the labelers fix) estimates how reliable each is, and the
posteriors train a logistic span classifier on what a span looks like. All spans are voted on and
trained from: the base spans that the contract fixes, which always stay, near misses of theirs, which are
never given out and stand for what is surely not real, and the proposals of the method, on which the classifier's word is final.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirlake.llm.common import saved, spread

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("ssn", "iban", "local_phone", "hidden_email", "person")
#: Matches of a base pattern that fail its check; they only train.
MISSES = ("ip_miss", "card_miss", "phone_miss")
KINDS = (*BASE_KINDS, *MORE_KINDS, *MISSES)

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

#: Proposals beyond the base; a proposal that overlaps a base span is dropped.
SSN = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
IBAN = re.compile(r"(?<!\w)[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w)")
LOCAL_PHONE = re.compile(r"(?<![\w+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![\w-])")
#: Of a written-out address the part from the bracketed "at" on; what stands before is looked up from there.
HIDDEN_EMAIL = re.compile(r"[\[({]\x20?at\x20?[\])}]\x20?[A-Za-z0-9-]+\x20?(?:[\[({]\x20?dot\x20?[\])}]|\.)\x20?[A-Za-z]{2,}(?!\w)")
PERSON = re.compile(r"(?<!\w)(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra)\.?\x20[A-Z][a-z]+(?:\x20[A-Z][a-z]+)?(?!\w)")

#: Gazetteer: common given names, mail domains' endings and country codes of account numbers (fixed lists).
NAMES = frozenset("anna anne antonio carlos carmen charles claire daniel david elena emma franz hans jean john jose juan karl laura louis luis lukas maria marie mary michael paul pedro peter pierre robert sofia sophie thomas william".split())
ENDINGS = frozenset("com org net edu gov io de fr es uk it eu info".split())
COUNTRIES = frozenset("AT BE CH DE ES FR GB IE IT LU NL PT".split())
DIAL_CODES = ("1", "31", "32", "33", "34", "39", "41", "43", "44", "49", "351", "352", "353")
#: Words that announce each kind.
CUES = {
    "email": ("mail", "contact", "write", "@"), "ip": ("ip", "host", "server", "address", "login"), "card": ("card", "visa", "payment", "credit"), "phone": ("phone", "tel", "call", "mobile", "fax"),
    "ssn": ("ssn", "social security"), "iban": ("iban", "account", "konto", "compte", "cuenta"),
    "local_phone": ("phone", "tel", "call", "mobile", "fax"), "hidden_email": ("mail", "contact", "write"),
    "person": ("name", "contact", "signed", "dear"),
}
#: Words that announce figures of other sorts.
OTHER_CUES = ("order", "invoice", "version", "ref", "sku", "isbn", "page", "chapter", "total", "code")
CLEAR_LEFT = frozenset(["", *" \t\n([\"':;,"])
CLEAR_RIGHT = frozenset(["", *" \t\n)]\"':;,.!?"])
REACH = 40
LABELERS = ("form", "gazetteer", "context", "surroundings")
#: Where the rates of votes (+, -, 0) begin, for real spans and for others, and how many spans that counts as.
START = np.array([[0.6, 0.1, 0.3], [0.2, 0.5, 0.3]])
SMOOTH = 20


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def scan(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """((start, end, kind) of the contract's spans, and of near misses), each by start and then kind."""
    out, missed = [], []
    at, free = text.find("@"), 0
    while at >= 0:
        # The mailbox is the run before the sign, from where the last match ended at the earliest.
        box, d = LOCAL.search(text, _run_start(text, at, free), at), DOMAIN.match(text, at + 1)
        if box and d:
            out.append((box.start(), d.end(), "email"))
            free = d.end()
        at = text.find("@", max(at + 1, free))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            ok = all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split("."))
            (out if ok else missed).append((m.start(), m.end(), "ip" if ok else "ip_miss"))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m.group().replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19:
                    ok = luhn(digits)
                    (out if ok else missed).append((m.start(), m.end(), "card" if ok else "card_miss"))
        if "+" in text:
            for m in PHONE.finditer(text):
                ok = 10 <= len(DIGIT.findall(m.group())) <= 15
                (out if ok else missed).append((m.start(), m.end(), "phone" if ok else "phone_miss"))
    order = lambda x: (x[0], KINDS.index(x[2]))
    return sorted(out, key=order), sorted(missed, key=order)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """The contract's spans."""
    return scan(text)[0]


_BOX = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def _run_start(text: str, at: int, least: int) -> int:
    while at > least and text[at - 1] in _BOX:
        at -= 1
    return at


def _iban_ok(value: str) -> bool:
    v = value.replace(" ", "")
    return 15 <= len(v) <= 34 and int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def _form(kind: str, v: str, digits: str) -> bool:
    if kind.endswith("_miss"):
        return False
    return {
        "email": lambda: not v.startswith((".", "-")) and ".." not in v, "ip": lambda: all(p == "0" or not p.startswith("0") for p in v.split(".")), "card": lambda: len(digits) in (14, 15, 16, 19), "phone": lambda: v[1] != "0",
        "ssn": lambda: v[:3] not in ("000", "666") and v[0] != "9" and v[4:6] != "00" and v[7:] != "0000", "iban": lambda: _iban_ok(v),
        "local_phone": lambda: digits[0] not in "01" and digits[3] not in "01", "hidden_email": lambda: v.count(" ") <= 4, "person": lambda: len(v.split()) >= 2,
    }[kind]()


def _listed(kind: str, v: str, digits: str) -> bool | None:
    """What a gazetteer says of a span; null where none applies."""
    return {
        "email": lambda: v.rsplit(".", 1)[-1].lower() in ENDINGS, "ip": lambda: 1 <= int(v.split(".")[0][-4:]) <= 223, "card": lambda: digits[0] in "3456", "phone": lambda: digits.startswith(DIAL_CODES),
        "iban": lambda: v[:2] in COUNTRIES, "hidden_email": lambda: re.split(r"[^A-Za-z]", v)[-1].lower() in ENDINGS, "person": lambda: any(w.lower() in NAMES for w in v.split()[1:]),
    }.get(kind, lambda: None)()


def voted(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str, str, str]]:
    """(start, end, kind, votes, looks): votes of the labelers as one of ``+-0`` each."""
    low = text.lower() if spans else ""
    low = low if len(low) == len(text) else text
    sign = lambda x: "0" if x is None else "+" if x else "-"
    out = []
    for s, e, kind in spans:
        v = text[s:e]
        digits = "".join(DIGIT.findall(v))
        own = kind.removesuffix("_miss")
        before = low[max(0, s - REACH) : s]
        cue = any(c in before for c in CUES[own])
        other = not cue and (any(c in before for c in OTHER_CUES) or any(c in before for k, cs in CUES.items() if k != own for c in cs))
        # Among other figures or table cells a run of digits is most likely data; between spaces or marks it stands by itself.
        left, right = text[max(0, s - 3) : s], text[e : e + 3]
        crowded = bool(DIGIT.search(left + right)) or "|" in left + right
        clear = left[-1:] in CLEAR_LEFT and right[:1] in CLEAR_RIGHT
        votes = sign(_form(kind, v, digits)) + sign(_listed(kind, v, digits)) + ("+" if cue else "-" if other else "0") + ("-" if crowded else "+" if clear else "0")
        looks = f"{own} n{min(len(digits), 20) // 4} r{int(len(set(digits)) <= 2 and bool(digits))} c{int(cue)} d{int(crowded)} u{int(v.isupper())} f{votes[0]}"
        out.append((s, e, kind, votes, looks))
    return out


_LOCAL_BOX = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._-")
_PART_OF_WORD = re.compile(r"\w")


def _hidden_emails(text: str) -> list[tuple[int, int]]:
    """(start, end) of written-out addresses: the first place of the run before the bracket that is not inside a word."""
    out, free = [], 0
    for m in HIDDEN_EMAIL.finditer(text):
        end = m.start() - (m.start() > free and text[m.start() - 1] == " ")
        at = end
        while at > free and text[at - 1] in _LOCAL_BOX:
            at -= 1
        while at < end and at > 0 and _PART_OF_WORD.match(text[at - 1]):
            at += 1
        if at < end:
            out.append((at, m.end()))
            free = m.end()
    return out


def _apart(spans: list[tuple[int, int, str]], taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The spans that overlap none of ``taken``, which are by start: none begins before the span's end and ends after its start."""
    starts = [a for a, _, _ in taken]
    ends = [0, *accumulate((b for _, b, _ in taken), max)]
    return [x for x in spans if ends[bisect_left(starts, x[1])] <= x[0]]


def proposals(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the method's own patterns, by start; those that overlap a base span are left out."""
    found = []
    if DIGIT.search(text):
        found += [(*m.span(), kind) for kind, p in (("ssn", SSN), ("local_phone", LOCAL_PHONE), ("iban", IBAN)) for m in p.finditer(text)]
    if "at" in text and any(c in text for c in "[({"):
        found += [(s, e, "hidden_email") for s, e in _hidden_emails(text)]
    found += [(*m.span(), "person") for m in PERSON.finditer(text)]
    return sorted(_apart(found, taken), key=lambda x: (x[0], KINDS.index(x[2])))


def estimate_reliability(counts: dict[str, int], known: dict[str, int] | None = None, rounds: int = 50, prior: float = 0.5) -> tuple[dict[str, float], np.ndarray]:
    """({votes: posterior}, rates by labeler, class (real, not) and vote (+, -, 0)) by expectation-maximisation.

    An abstention is a vote like any other: how often a labeler abstains on either class is estimated too.
    ``known`` counts the votes on spans that are surely not real; they take part as such. Rates start above chance
    and are smoothed, so that a pattern seen once moves them little.
    """
    known = known or {}
    patterns = sorted(counts)
    tell = lambda ps: np.array([[[c == v for v in "+-0"] for c in p] for p in ps], float).reshape(len(ps), len(LABELERS), 3)
    rates = np.tile(START, (len(LABELERS), 1, 1))
    if not patterns:
        return {}, rates
    n, votes = np.array([counts[p] for p in patterns], float), tell(patterns)
    sure = np.einsum("p,plv->lv", np.array([known[p] for p in sorted(known)], float), tell(sorted(known)))
    share = prior
    for _ in range(rounds):
        a, b = (np.einsum("plv,lv->p", votes, np.log(rates[:, k])) for k in (0, 1))
        post = 1 / (1 + np.exp(np.clip(b - a + np.log(1 - share) - np.log(share), -30, 30)))
        share = float(np.clip((n @ post + 1) / (n.sum() + 2), 0.02, 0.98))
        for k, (w, more) in enumerate(((n * post, 0), (n * (1 - post), sure))):
            got = np.einsum("p,plv->lv", w, votes) + more + SMOOTH * START[k]
            rates[:, k] = got / got.sum(1, keepdims=True)
    return dict(zip(patterns, post.tolist(), strict=True)), rates


def train_classifier(rows: list[tuple[str, float, float]], steps: int = 400) -> dict[str, float]:
    """{token of a span's looks: weight}, with "" for the constant, from (looks, posterior, count)."""
    names = {"": 0}
    for looks, _, _ in rows:
        for t in looks.split():
            names.setdefault(t, len(names))
    if not rows:
        return {"": -1.0}
    x = np.zeros((len(rows), len(names)))
    for i, (looks, _, _) in enumerate(rows):
        x[i, [0, *(names[t] for t in looks.split())]] = 1
    y, n = np.array([r[1] for r in rows]), np.array([r[2] for r in rows], float)
    n, w = n / n.sum(), np.zeros(len(names))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w -= 2.0 * (x.T @ (n * (p - y)) + 1e-4 * w)
    return {t: float(w[i]) for t, i in names.items()}


def judge_spans(tally: list[tuple[str, str, str, int]]) -> dict[str, float]:
    """{looks: probability of being real} from (kind, votes, looks, count) of all spans.

    Reliabilities are estimated kind by kind, near misses taking part as spans that are surely not real; the
    posteriors of all kinds train one classifier.
    """
    rows = []
    for own in sorted({k.removesuffix("_miss") for k, *_ in tally}):
        mine, counts, known = [r for r in tally if r[0].removesuffix("_miss") == own], {}, {}
        for kind, votes, _, n in mine:
            into = known if kind in MISSES else counts
            into[votes] = into.get(votes, 0) + n
        posterior, _ = estimate_reliability(counts, known)
        rows += [(looks, 0.0 if kind in MISSES else posterior[votes], float(n)) for kind, votes, looks, n in mine]
    weight = train_classifier(sorted(rows))
    return {looks: float(1 / (1 + np.exp(-(weight[""] + sum(weight[t] for t in looks.split()))))) for _, _, looks, _ in tally}


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per input row: doc_id, base, found: arrays of (s, e, kind, p) by start, then kind.

    Offsets are code points, ends exclusive; ``p`` is the classifier's word, at least ``threshold`` but
    for base spans, which stay whatever it is. Null text counts as empty and has no spans; repeated rows and null
    ids keep a row each; an empty table gives none; without any span nothing is trained; other columns are not read.
    """
    rows = spread(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    span = pa.list_(pa.struct([("s", pa.int32()), ("e", pa.int32()), ("kind", pa.string()), ("votes", pa.string()), ("looks", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b["text"]:
                text = t.as_py()
                base, missed = scan(text)
                spans = voted(text, [*base, *missed, *proposals(text, base)])
                out.append([{"s": s, "e": e, "kind": k, "votes": v, "looks": x} for s, e, k, v, x in spans])
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(out, span)], ["doc_id", "spans"])

    kind = "array<struct<s:int,e:int,kind:string,votes:string,looks:string>>"
    seen = saved(rows.mapInArrow(run, f"doc_id long, spans {kind}"), "pii-spans")
    # Distinct (kind, votes, looks) are bounded by the kinds, the labelers and the looks, not by the texts.
    tally = seen.select(F.explode("spans").alias("x")).groupBy("x.kind", "x.votes", "x.looks").agg(F.count(F.lit(1)).alias("n")).collect()
    score = judge_spans([(r["kind"], r["votes"], r["looks"], r["n"]) for r in tally])
    table = F.create_map(*(x for k in sorted(score) for x in (F.lit(k), F.lit(score[k])))) if score else F.create_map().cast("map<string,double>")
    told = lambda x: F.try_element_at(table, x["looks"])
    order = F.create_map(*(x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))))
    judged = F.transform("spans", lambda x: F.struct(x["s"].alias("s"), order[x["kind"]].alias("o"), x["e"].alias("e"), x["kind"].alias("kind"), told(x).alias("p")))
    judged = F.filter(F.array_sort(judged), lambda x: x["kind"].isin(*BASE_KINDS) | (x["kind"].isin(*MORE_KINDS) & (x["p"] >= threshold)))
    found = F.transform(judged, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"), x["p"].alias("p")))
    return seen.select("doc_id", found.alias("found")).select("doc_id", F.filter("found", lambda x: x["kind"].isin(*BASE_KINDS)).alias("base"), "found")
