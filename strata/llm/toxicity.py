"""Toxicity: a weighted lexicon matched by an Aho-Corasick automaton.

Texts are folded first: lower case, accents and look-alike letters of other
alphabets to Latin ones, digits and signs that stand for letters to those
letters, zero-width characters dropped, l and i as one, letters spelt out with
dots joined. A term is a whole word or the beginning of words; a hit inside a
longer word does not count, nor one covered by an exception phrase. The score
is a logistic function of the summed weights and of their density (per 100
words), so length is taken into account.

The lexicon starts from ``SEED_TERMS`` and learns from a bounded sample of
labelled rows (``max_rows``, the smallest hashes of the ids): words and word
beginnings of 4 to 8 letters whose toxic share is beyond chance, where copies
of one text count once, as they show a word in one context only. Weights are
log odds; the two coefficients are fitted on the same sample.

Defined results: null and empty texts have no hit and score as such; a null id
is scored like any other; labels may be missing, empty or of one kind, the
seeds and default coefficients then stand; repeated rows score alike.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import carried, restored, written

SEED_TERMS = (
    "idiot moron stupid imbecile loser scum pathetic worthless disgusting trash clown dumbass asshole bastard bitch "
    "bullshit crap cunt dickhead fucker fucking motherfucker prick shithead slut whore wanker retard degenerate vermin subhuman"
).split()
#: harmless phrases that contain a term
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "trash collection", "clown fish", "circus clown", "sore loser rule",
    "scum line", "pond scum", "disgusting smell", "bastard file", "prick test", "pin prick",
)
#: prior weight of a seed, as if seen this often in toxic texts alone
SEED_SEEN = 6

_LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "ѕ": "s", "і": "i", "ї": "i", "ј": "j", "ԁ": "d", "ɡ": "g", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ß": "ss", "ł": "l", "ø": "o", "đ": "d", "ı": "i",
}
_DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b"}
_SIGNS = {"@": "a", "$": "s", "!": "i"}
_SPELT_OUT = re.compile(r"(?<![a-z])(?:[a-z][.\-_*]){2,}[a-z](?![a-z])")


def _folding() -> dict[int, str | None]:
    fold: dict[int, str | None] = {ord(k): v for k, v in (_LOOKALIKES | _DIGITS).items()}
    for c in [*range(0xC0, 0x250), *range(0xFF21, 0xFF5B), *range(0x1E00, 0x1F00)]:
        plain = "".join(x for x in unicodedata.normalize("NFKD", chr(c)) if not unicodedata.combining(x)).lower()
        if plain and plain != chr(c):
            fold.setdefault(c, plain)
    for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF, *range(0x300, 0x370)):
        fold[c] = None
    return {k: v and v.replace("l", "i") for k, v in fold.items()} | {ord("l"): "i"}


class Folder:
    def __init__(self) -> None:
        self.table = _folding()
        self.signs = re.compile(r"[@$!](?=\w)")

    def __call__(self, text: str) -> str:
        text = text.lower()
        if "@" in text or "$" in text or "!" in text:
            text = self.signs.sub(lambda m: _SIGNS[m[0]], text)
        text = text.translate(self.table)
        return _SPELT_OUT.sub(lambda m: re.sub(r"[^a-z]", "", m[0]), text)


@dataclass(frozen=True)
class Lexicon:
    """``terms``: folded term -> (weight, whether it is the beginning of a longer word)."""

    terms: dict[str, tuple[float, bool]]
    exceptions: tuple[str, ...] = EXCEPTIONS
    #: intercept, weight of log(1 + sum), weight of log(1 + density)
    coefficients: tuple[float, float, float] = (-4.0, 3.5, 0.3)
    seen: dict = field(default_factory=dict, compare=False)


class Matcher:
    """Hits of a lexicon in texts."""

    def __init__(self, lexicon: Lexicon) -> None:
        import ahocorasick

        self.fold = Folder()
        self.automaton = ahocorasick.Automaton()
        for term, (weight, open_end) in lexicon.terms.items():
            self.automaton.add_word(term, (term, weight, open_end))
        for phrase in lexicon.exceptions:
            self.automaton.add_word(self.fold(phrase), (self.fold(phrase), None, False))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, text: str | None) -> list[tuple[str, float]]:
        """(term, weight) of each hit, the longest of those that start together."""
        if not text or not len(self.automaton):
            return []
        folded = self.fold(text)
        found: dict[int, tuple[int, str, float]] = {}
        excepted: list[tuple[int, int]] = []
        for end, (term, weight, open_end) in self.automaton.iter(folded):
            start = end - len(term) + 1
            if start and folded[start - 1].isalnum():
                continue
            if open_end != (end + 1 < len(folded) and folded[end + 1].isalnum()):
                continue
            if weight is None:
                excepted.append((start, end))
            elif start not in found or found[start][0] < end:
                found[start] = (end, term, weight)
        return [(t, w) for s, (e, t, w) in sorted(found.items()) if not any(a <= s and e <= z for a, z in excepted)]


def features(total: float, words: int) -> tuple[float, float]:
    return math.log1p(total), math.log1p(100.0 * total / max(words, 1))


def probability(coefficients: tuple[float, float, float], total: float, words: int) -> float:
    a, b = features(total, words)
    z = coefficients[0] + coefficients[1] * a + coefficients[2] * b
    return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


# ---- learning


def _word_keys(text: str, fold: Folder) -> dict[str, set[int]]:
    """Candidate terms of a text and the contexts they show: the word before for
    whole words ("=word"), the word itself for beginnings."""
    out: dict[str, set[int]] = {}
    before = ""
    for w in re.findall(r"\w+", fold(text)):
        if not w.isdigit():
            out.setdefault("=" + w, set()).add(hash_of(before))
            for k in range(4, 9):
                if len(w) > k:
                    out.setdefault(w[:k], set()).add(hash_of(w))
        before = w
    return out


def hash_of(word: str) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(word.encode()) >> 1


def choose_terms(rows: list[tuple[str, int, int, int]], toxic: int, clean: int, least: int) -> dict[str, tuple[float, bool]]:
    """``rows``: (key, toxic texts, distinct contexts, clean texts). Terms whose
    toxic share is beyond chance, with log-odds weights."""
    good = []
    for key, texts, contexts, harmless in rows:
        n = min(texts, contexts)
        if n < least:
            continue
        share, base = n / (n + harmless), toxic / (toxic + clean)
        beyond = 2 * (n * math.log(share / base) + (harmless * math.log((1 - share) / (1 - base)) if harmless else 0.0))
        weight = math.log((n + 0.5) / (toxic + 1)) - math.log((harmless + 0.5) / (clean + 1))
        if beyond > 30 and weight >= 1.5:
            good.append((texts, len(key), key, min(8.0, weight)))
    # of beginnings that cover the same words the longest stands; what it covers needs no term of its own,
    # unless it is the surer sign
    chosen: dict[str, tuple[float, bool]] = {}
    counted: dict[str, int] = {}
    for texts, _, key, weight in sorted(good, key=lambda g: (-g[0], -g[1], g[2])):
        word = key.removeprefix("=")
        if any(chosen.get(word[:k], (0.0, False))[1] and chosen[word[:k]][0] > weight - 1 for k in range(4, len(word))):
            continue
        if not key.startswith("=") and any(t.startswith(word) and counted[t] >= 0.9 * texts for t in chosen):
            continue
        chosen[word], counted[word] = (weight, not key.startswith("=")), texts
    return chosen


def logistic_fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 40) -> np.ndarray:
    """Newton steps for an intercept and non-negative slopes."""
    used = np.ones(x.shape[1], bool)
    while True:
        a = np.column_stack([np.ones(len(x)), x[:, used]])
        b, penalty = np.zeros(a.shape[1]), ridge * np.eye(a.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(a @ b, -30, 30)))
            step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, a.T @ (y - p) - penalty @ b)
            b += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break
        full = np.zeros(x.shape[1] + 1)
        full[0], full[1:][used] = b[0], b[1:]
        if (full[1:] >= 0).all():
            return full
        used &= full[1:] > 0


def seeds() -> dict[str, tuple[float, bool]]:
    fold = Folder()
    return {fold(t): (3.0, False) for t in SEED_TERMS}


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    max_rows: int = 20_000, least_seen: int = 5,
) -> Lexicon:
    """Learn a lexicon from at most ``max_rows`` ids of ``labels``; ``docs`` holds their texts (of a repeated id the least)."""
    sample = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
        .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
        .groupBy("_id").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    )
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(F.col("_text").isNotNull())
    # the sample's size is bounded by max_rows, and an id has one text
    rows = written(rows.join(F.broadcast(sample), "_id").groupBy("_id", "_y").agg(F.min("_text").alias("_text")), "toxicity-rows")
    n = {r["_y"]: r["count"] for r in rows.groupBy("_y").count().collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    base = seeds()
    if not toxic or not clean:
        return Lexicon(base)

    def in_toxic(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fold = Folder()
        for pdf in batches:
            got = [(k, c, i == 0) for t in pdf["_text"] for k, cs in _word_keys(t, fold).items() for i, c in enumerate(cs)]
            yield pd.DataFrame(got, columns=["key", "context", "first"])

    found = (
        rows.where("_y = 1").mapInPandas(in_toxic, "key string, context long, first boolean")
        .groupBy("key").agg(F.sum(F.col("first").cast("long")).alias("texts"), F.count_distinct("context").alias("contexts"))
        .where((F.col("texts") >= least_seen) & (F.col("contexts") >= least_seen))
        .collect()
    )  # fmt: skip  # bounded by the sample
    fold = Folder()
    asked = {r["key"]: (r["texts"], r["contexts"]) for r in found}
    for t in SEED_TERMS:
        asked.setdefault("=" + fold(t), (0, 0))
    handed = rows.sparkSession.sparkContext.broadcast(frozenset(asked))

    def in_clean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, keys, counts = Folder(), handed.value, Counter()
        for pdf in batches:
            for t in pdf["_text"]:
                words = set(re.findall(r"\w+", own(t)))
                counts.update(({"=" + w for w in words} | {w[:k] for w in words for k in range(4, 9) if len(w) > k}) & keys)
        yield pd.DataFrame(list(counts.items()), columns=["key", "texts"])

    harmless = {
        r["key"]: r["n"]
        for r in rows.where("_y = 0").mapInPandas(in_clean, "key string, texts long").groupBy("key").agg(F.sum("texts").alias("n")).collect()
    }
    handed.unpersist()
    terms = {}
    for t in base:
        n_t, n_c = asked["=" + t][0], harmless.get("=" + t, 0)
        weight = math.log((n_t + SEED_SEEN) / (toxic + SEED_SEEN)) - math.log((n_c + 0.5) / (clean + 1))
        if weight > 0.5:
            terms[t] = (min(8.0, weight), False)
    learnt = choose_terms([(k, t, c, harmless.get(k, 0)) for k, (t, c) in asked.items()], toxic, clean, least_seen)
    lexicon = Lexicon(terms | learnt)
    totals = measured(rows, lexicon, "_text").select("_y", "_total", "_words").toPandas()  # bounded by the sample
    x = np.array([features(t, w) for t, w in zip(totals["_total"], totals["_words"])])
    b = logistic_fit(x, totals["_y"].to_numpy(float))
    if b[1] + b[2] <= 0:
        return lexicon
    return Lexicon(lexicon.terms, lexicon.exceptions, (float(b[0]), float(b[1]), float(b[2])), {"toxic": toxic, "clean": clean})


# ---- scoring


def measured(docs: DataFrame, lexicon: Lexicon, text_col: str) -> DataFrame:
    """``docs`` with ``_total`` (weights of the hits), ``_words`` and ``_terms`` (terms hit)."""

    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(lexicon)
        for texts in batches:
            out = []
            for t in texts:
                hits = matcher.hits(t)
                out.append((sum(w for _, w in hits), len(t.split()) if t else 0, sorted({x for x, _ in hits})))
            yield pd.DataFrame(out, columns=["total", "words", "terms"])

    scan_udf = F.pandas_udf(scan, "total double, words long, terms array<string>")
    return docs.withColumn("_hit", scan_udf(F.col(text_col))).withColumns(
        {"_total": F.col("_hit.total"), "_words": F.col("_hit.words"), "_terms": F.col("_hit.terms")}
    ).drop("_hit")


def score(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``_score`` (0 to 1), ``_toxic`` and ``_terms``; columns of these names are replaced."""
    columns = [c for c in docs.columns if c not in ("_score", "_toxic", "_terms")]
    docs = carried(docs, _text=F.col(f"`{text_col}`"))
    c0, c1, c2 = lexicon.coefficients
    z = F.lit(c0) + F.lit(c1) * F.log1p("_total") + F.lit(c2) * F.log1p(100.0 * F.col("_total") / F.greatest(F.col("_words"), F.lit(1)))
    return (
        measured(docs, lexicon, "_text")
        .withColumn("_score", 1.0 / (1.0 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z)))))
        .withColumn("_toxic", F.col("_score") >= threshold)
        .select(*restored(docs, columns), "_score", "_toxic", "_terms")
    )
