"""Text kernel: cleaning, quality, fingerprints, chunks, titles and names, as column expressions.

Only Unicode compatibility normalisation has no built-in; it runs in an Arrow UDF that receives the few
texts that may need it and null for all others.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from weirlake.functions.bind import let

#: Characters that compatibility normalisation surely leaves alone.
_STABLE = r"¡-§©«-®°±¶·»¿-ıĴ-ľŁ-ňŊ-ž"
#: Control characters that cleaning drops (fixed values).
_CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
#: White space other than line feeds that may be left at a line's ends.
_SPACE = "\t\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
LEAST_QUALITY = 0.35


@F.pandas_udf(StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


@F.pandas_udf(StringType())
def _casefold(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else t.casefold())


def _may_change(text: Column) -> Column:
    """Whether normalisation may change a text; only its characters beyond ASCII go through the long class."""
    beyond = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    return F.when(F.octet_length(text) == F.char_length(text), False).otherwise(beyond.rlike(f"[^{_STABLE}]"))


def normalized(text: Column) -> Column:
    """NFKC form; texts of stable characters never leave the JVM."""
    return F.coalesce(_nfkc(F.when(_may_change(text), text)), text)


def clean_native(text: Column) -> Column:
    """``clean_text`` without NFKC, all of it built-in."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), _CONTROL, "")
    t = F.regexp_replace(t, r"\r\n?", "\n")
    t = F.regexp_replace(t, r"[ \t]+", " ")
    t = F.array_join(F.transform(F.split(t, "\n"), lambda line: F.trim(line, F.lit(_SPACE))), "\n")
    t = F.regexp_replace(t, r"\n{3,}", "\n\n")
    return F.regexp_replace(t, r"^\n+|\n+\z", "")


def clean_text(text: Column) -> Column:
    """NFKC, no control characters, LF ends, single blanks, trimmed lines, at most one empty line, trimmed. Null: empty."""
    return clean_native(normalized(text))


def fold(text: Column) -> Column:
    """Caseless form by built-ins: lower case with ``ß`` as ``ss``; equals full folding for Latin text."""
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def fold_full(text: Column) -> Column:
    """Full Unicode case folding; ASCII texts never leave the JVM."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.coalesce(_casefold(F.when(~plain, text)), F.lower(text))


def fingerprint(cleaned: Column, full: bool = False) -> Column:
    """SHA-256 of the case-folded cleaned text."""
    return F.sha2(F.encode(fold_full(cleaned) if full else fold(cleaned), "UTF-8"), 256)


def score_text(cleaned: Column) -> Column:
    """0 to 1 from the share of letters, the share of distinct words and the length."""
    n = F.char_length(cleaned)
    words = F.filter(F.split(fold(cleaned), r"[^\p{L}\p{N}_]+"), lambda w: w != "")
    length = F.least(F.lit(1.0), F.log10(F.greatest(n, F.lit(10)).cast("double")) / 4.0)

    def score(w: Column) -> Column:
        alpha = (n - F.char_length(F.regexp_replace(cleaned, r"\p{L}+", ""))) / F.greatest(n, F.lit(1))
        unique = F.size(F.array_distinct(w)) / F.greatest(F.size(w), F.lit(1))
        value = 0.45 * alpha + 0.35 * F.least(F.lit(1.0), unique * 2.0) + 0.20 * length
        return F.when(F.size(w) < 12, 0.15).otherwise(F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)), 4))

    return F.when(F.coalesce(n, F.lit(0)) == 0, 0.0).when(n < 80, 0.15).otherwise(let(words, score))


def acceptable(score: Column, threshold: float = LEAST_QUALITY) -> Column:
    return score >= threshold


def chunks(cleaned: Column, size: int = 3500, overlap: int = 250) -> Column:
    """Array of overlapping windows; an empty text has none. ``size`` must exceed ``overlap``."""
    if size <= overlap:
        raise ValueError("size must exceed overlap")
    n, step = F.char_length(cleaned), size - overlap
    last = F.greatest(F.ceil((n - size) / step), F.lit(0)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.substr(cleaned, i * step + 1, F.lit(size)))
    return F.when(n > 0, cut).otherwise(F.array().cast("array<string>"))


def chunk_id(*parts: Column) -> Column:
    """SHA-256 of the parts joined by ``|``."""
    return F.sha2(F.concat_ws("|", *(p.cast("string") for p in parts)), 256)


def title(text: Column, longest: int = 300) -> Column:
    """First line of four or more characters after collapsing blanks and trimming `` -|`` and tabs."""
    lines = F.transform(
        F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"),
        lambda x: F.regexp_replace(F.regexp_replace(x, r"[\s\x1c-\x1f\x85  - 　]+", " "), r"^[ |\t-]+|[ |\t-]+$", ""),
    )
    return F.left(F.get(F.filter(lines, lambda x: F.char_length(x) >= 4), F.lit(0)), F.lit(longest))


def training_text(text: Column | None, fields: dict[str, Column]) -> Column:
    """``text`` if it is not blank, else ``name: value`` lines of the non-empty fields in order; cleaned.

    Names that begin with ``__`` or ``_dlt`` are left out; nested values belong in as JSON text.
    """
    pairs = [
        F.when(c.isNotNull() & (c.cast("string") != ""), F.concat(F.lit(f"{name}: "), c.cast("string")))
        for name, c in fields.items() if not name.startswith(("__", "_dlt"))
    ]
    lines = F.concat_ws("\n", *pairs)
    own = lines if text is None else F.when(F.regexp_replace(text, r"\s+", "") != "", text).otherwise(lines)
    return clean_text(own)


def safe_name(value: Column) -> Column:
    """ASCII-safe path component: runs of other characters become ``_``; never empty."""
    v = F.regexp_replace(F.trim(F.when(F.coalesce(value, F.lit("")) == "", "unknown").otherwise(value)), r"[^a-zA-Z0-9_.-]+", "_")
    v = F.regexp_replace(v, r"^[._]+|[._]+$", "")
    return F.when(v == "", "unknown").otherwise(v)


def table_name(value: Column, prefix: str, longest: int = 100) -> Column:
    """``prefix`` and the lower-cased value with runs of other than ASCII letters and digits as ``_``."""
    v = F.regexp_replace(F.regexp_replace(value, r"[^a-zA-Z0-9]+", "_"), r"^_+|_+$", "")
    return F.concat(F.lit(prefix), F.left(F.lower(v), F.lit(longest)))


def snapshot_name(stem: Column, sha256: Column, extension: Column) -> Column:
    """``stem--digest.ext`` with the stem cut to 120 and the extension to 16 characters, at most 240 bytes."""
    s, e = F.left(safe_name(stem), F.lit(120)), F.left(extension, F.lit(16))
    room = 240 - 2 - F.octet_length(sha256) - F.octet_length(e)
    return F.concat(F.left(s, room), F.lit("--"), sha256, e)


def source_slug(registry: Column, name: Column) -> Column:
    """A stable id from a registry and a package name: slugs and twelve digits of a digest."""
    slug = lambda c, n: F.left(F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit(n))
    own = slug(name, 48)
    digest = F.left(F.sha2(F.concat(registry, F.decode(F.unhex(F.lit("00")), "UTF-8"), name), 256), F.lit(12))
    return F.concat(F.lit("techdocs-"), slug(registry, 20), F.lit("-"), F.when(own == "", "package").otherwise(own), F.lit("-"), digest)


def keyword_scores(text: Column, taxonomy: dict[str, tuple[str, ...]]) -> Column:
    """Array of (score, name): how often each topic's keywords occur as substrings, best first, then by name.

    Counts do not overlap and word boundaries do not matter. Topics without a hit are left out.
    """

    def scores(low: Column) -> Column:
        count = lambda w: ((F.char_length(low) - F.char_length(F.replace(low, F.lit(w), F.lit("")))) / len(w)).cast("int")
        hits = []
        for name, words in taxonomy.items():
            total = count(words[0])
            for w in words[1:]:
                total = total + count(w)
            hits.append(F.struct((-total).alias("minus"), F.lit(name).alias("name")))
        found = F.filter(F.array_sort(F.array(*hits)), lambda x: x["minus"] < 0)
        return F.transform(found, lambda x: F.struct((-x["minus"]).alias("score"), x["name"].alias("name")))

    return let(keyword_text(text), scores)


def keyword_text(text: Column) -> Column:
    """A text as keywords are looked for in it: lower-cased, with single blanks, none at its ends; null is empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " "))


def infer_domains(source_domain: Column, text: Column, taxonomy: dict[str, tuple[str, ...]]) -> Column:
    """(primary, secondary, confidence). A fixed source domain stays, with confidence 1.

    Otherwise the best topic leads with 0.65 and 0.05 a hit, up to six; without any hit: multidomain, 0.5.
    """
    return let(keyword_scores(text, taxonomy), lambda scores: domains_of(source_domain, scores))


def domains_of(source_domain: Column, scores: Column) -> Column:
    """``infer_domains`` from ranked scores, an array of (score, name); ``scores`` is used more than once."""
    names = lambda xs: F.transform(xs, lambda x: x["name"])
    fixed = (F.coalesce(source_domain, F.lit("")) != "") & (source_domain != "multidomain")
    best = F.get(scores, F.lit(0))
    open_ = F.struct(best["name"].alias("primary"), names(F.slice(scores, 2, 3)).alias("secondary"), F.least(F.lit(0.98), 0.65 + F.least(best["score"], F.lit(6)) * 0.05).alias("confidence"))
    none = F.struct(F.lit("multidomain").alias("primary"), F.array().cast("array<string>").alias("secondary"), F.lit(0.5).alias("confidence"))
    own = F.struct(source_domain.alias("primary"), F.slice(F.filter(names(scores), lambda n: n != source_domain), 1, 3).alias("secondary"), F.lit(1.0).alias("confidence"))
    return F.when(fixed, own).when(F.size(scores) == 0, none).otherwise(open_)


#: Document types in order of precedence, with their keywords (fixed values).
DOCUMENT_RULES = (
    ("DECREE", ("décret", "decret")),
    ("ORDINANCE", ("ordonnance",)),
    ("REGULATION", ("arrêté", "arrete", "règlement", "reglement")),
    ("LAW", (" loi ", "loi n°", "loi no", "constitution")),
    ("BUDGET", ("budget", "loi de finances", "dpbep", "dppd", "pap")),
    ("STATISTICAL_REPORT", ("statistique", "annuaire", "tableau de bord", "chiffres clés", "chiffres cles")),
    ("REPORT", ("rapport", "bilan", "bulletin")),
    ("STRATEGY", ("stratégie", "strategie", "politique nationale")),
    ("PLAN", ("plan national", "pnd", "plan d'action", "plan action")),
    ("GUIDE", ("guide", "manuel")),
    ("PROCEDURE", ("procédure", "procedure", "démarche", "demarche")),
    ("FORM", ("formulaire", "fiche à remplir", "fiche a remplir")),
    ("PRESS_RELEASE", ("communiqué", "communique", "communiqué de presse")),
    ("DIRECTORY", ("annuaire", "répertoire", "repertoire", "liste des")),
    ("MAP", ("carte", "géospatial", "geospatial")),
    ("RESEARCH", ("recherche", "étude", "etude", "article scientifique")),
)
#: What a data set's address contains (fixed values).
DATASET_TOKENS = ("dataset", "data-fair", ".csv", ".xlsx", ".json")


def infer_document_type(url: Column, text: Column, default: str = "OTHER", rules=DOCUMENT_RULES) -> Column:
    """The first rule of which any keyword occurs in the url or the first 12,000 characters."""
    norm = lambda c: F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\s+", " "))
    hay = F.concat(F.lit(" "), norm(url), F.lit(" "), norm(F.left(text, F.lit(12000))), F.lit(" "))
    either = lambda c, words: F.greatest(*(c.contains(w) for w in words)) if len(words) > 1 else c.contains(words[0])

    def first(h: Column) -> Column:
        out = None
        for name, words in rules:
            out = F.when(either(h, words), name) if out is None else out.when(either(h, words), name)
        return out.when(either(norm(url), DATASET_TOKENS), "DATASET").otherwise(default)

    return let(hay, first)


def search_terms(query: str) -> list[str]:
    """The first eight terms of three or more characters."""
    return [t for t in query.lower().split() if len(t) > 2][:8]
