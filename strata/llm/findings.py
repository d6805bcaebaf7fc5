"""What the secret scan learns: words and letter pairs of the corpus, and labelled findings.

No table says which strings are secrets. Labelled findings are therefore made from
the documents: each of a bounded sample gives passages of its own words, into which
a string is put whose nature is known because it was chosen first: random keys of
several makes, or what is often taken for them (checksums, identifiers, links, encoded
text, placeholders, references, numbers), each under names that fit either. The label is
the choice, not a rule on the string, and no feature. Findings are parted by a hash of
their document: two fifths teach which words and paths stand near secrets, two
fifths the forest, one fifth is held out.

The dictionary is the most frequent words of all documents (counted over all of
them, ties by word); letter pairs are weighted by the documents of its words.

Defined results: null and empty texts give no finding and no word; repeated rows
give the findings of one; an empty table gives an empty dictionary and
no findings; columns other than the id, the text and the path are not read.
"""

from __future__ import annotations

import base64
import math
import random
import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import as_text, written

#: how many words the dictionary has, and labelled findings there are at most, a document's share of them
DICTIONARY_WORDS, MOST_FINDINGS, PER_DOCUMENT = 5_000, 16_000, 4
#: files that the labelled findings lie in, at most
FINDING_FILES = 12
#: a word near findings counts when it stood near so many of them
LEAST_NEAR = 5


@dataclass(frozen=True)
class Learnt:
    """``words``: the dictionary; ``pairs``: log2 P(second | first letter); ``near``, ``paths``: log odds of words
    next to a finding and of parts of its path."""

    words: frozenset[str] = frozenset()
    pairs: dict[str, float] = field(default_factory=dict)
    near: dict[str, float] = field(default_factory=dict)
    paths: dict[str, float] = field(default_factory=dict)

    def covered(self, low: str) -> int:
        """Characters of ``low`` that dictionary words cover, the longest first."""
        at = total = 0
        while at < len(low):
            step = next((k for k in range(12, 2, -1) if at + k <= len(low) and low[at : at + k] in self.words), 0)
            total += step
            at += step or 1
        return total

    def transitions(self, low: str) -> float:
        """Mean log2 probability of the letter pairs of ``low``; of a pair never seen, and without any, the least."""
        found = [self.pairs.get(low[i : i + 2], -12.0) for i in range(len(low) - 1) if low[i : i + 2].isalpha()]
        return sum(found) / len(found) if found else -12.0

    def near_score(self, before: str, after: str) -> float:
        return sum(self.near.get(w, 0.0) for w in near_words(before, after))

    def path_score(self, path: str) -> float:
        return sum(self.paths.get(p, 0.0) for p in path_parts(path))


def near_words(before: str, after: str) -> set[str]:
    line = before.rsplit("\n", 1)[-1]
    return set(re.findall(r"[^\W\d]{2,}", (line[-40:] + " | " + after[:20]).lower()))


def path_parts(path: str) -> set[str]:
    return set(re.findall(r"[A-Za-z]+", path.lower()))


def dictionary(docs: DataFrame, text_col: str = "text", size: int = DICTIONARY_WORDS) -> tuple[frozenset[str], dict[str, float]]:
    """The ``size`` words in most documents, and the letter pairs of these."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.col(f"`{text_col}`")), F.lit(r"\p{L}{3,12}"), F.lit(0)))
    counted = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    rows = counted.orderBy(F.col("n").desc(), "word").limit(size).collect()  # bounded by size
    pairs, firsts = Counter(), Counter()
    for r in rows:
        for a, b in zip(r["word"], r["word"][1:]):
            pairs[a + b] += r["n"]
            firsts[a] += r["n"]
    return frozenset(r["word"] for r in rows), {p: math.log2((n + 1) / (firsts[p[0]] + 64)) for p, n in pairs.items()}


# ---- strings of a known nature

_ALNUM = string.ascii_letters + string.digits
_KEYS = ["token", "api_key", "secret", "password", "auth", "access_key", "client_secret", "private_key", "credential", "pass", "key", "login", "bearer"]
_OTHERS = ["commit", "sha256", "md5", "etag", "checksum", "revision", "request", "trace", "order", "invoice", "session", "build", "version", "image", "link", "file"]


def _key_string(r: random.Random) -> str:
    n = r.randint(16, 44)
    return r.choice([
        lambda: "".join(r.choices("0123456789abcdef", k=r.choice([20, 24, 32, 40, 64]))),
        lambda: "".join(r.choices(_ALNUM, k=n)),
        lambda: base64.b64encode(r.randbytes(n)).decode(),
        lambda: "-".join("".join(r.choices(_ALNUM, k=8)) for _ in range(4)),
        lambda: "AKIA" + "".join(r.choices(string.ascii_uppercase + string.digits, k=16)),
        lambda: "ghp_" + "".join(r.choices(_ALNUM, k=36)),
        lambda: "xoxb-" + "".join(r.choices(string.digits, k=12)) + "-" + "".join(r.choices(_ALNUM, k=20)),
    ])()


def _harmless(r: random.Random, words: list[str]) -> str:
    w = [re.sub(r"\W", "", x) or "x" for x in r.sample(words, min(len(words), 4))]
    hexes = lambda k: "".join(r.choices("0123456789abcdef", k=k))
    return r.choice([
        lambda: "".join(r.choices(string.digits, k=r.randint(13, 24))),
        lambda: "-".join(w) + f"-{r.randint(1, 2030)}",
        lambda: "/".join(w) + f"/{r.randint(1, 9999)}",
        lambda: "_".join(w) + str(r.randint(1, 99)),
        lambda: "".join(x.capitalize() for x in w) + str(r.randint(1, 999)),
        lambda: hexes(r.choice([32, 40, 64])),
        lambda: "-".join(map(hexes, (8, 4, 4, 4, 12))),
        lambda: base64.b64encode(" ".join(words[:12]).encode()).decode(),
        lambda: f"20{r.randint(10, 30)}-0{r.randint(1, 9)}-1{r.randint(0, 9)}T10-{r.randint(10, 59)}-00",
    ])()


def finding(r: random.Random, words: list[str]) -> tuple[str, int, int, int]:
    """(text, start, end, label) of one labelled finding among ``words``."""
    at = r.randrange(max(1, len(words) - 24))
    left, right = " ".join(words[at : at + 12]), " ".join(words[at + 12 : at + 24])
    label = r.randint(0, 1)
    if label:
        short = r.random() < 0.25  # passwords: only a name tells them
        value = "".join(r.choices(_ALNUM + "!$%&*", k=r.randint(8, 14))) if short else _key_string(r)
        named = short or r.random() < 0.8
        lead = r.choice(_KEYS) if named else r.choice(words)
    elif r.random() < 0.3:  # under a name that says key, but none
        word = re.sub(r"\W", "", r.choice(words)) or "x"
        value = r.choice([word, "your_api_key_123", "xxxxxxxxxxxx1234", "${" + word.upper() + "_9}", "<token1>", f"example-{word}-1", "none", f"{word}-{word}-secret-1"])
        lead = r.choice(_KEYS)
    else:
        value, lead = _harmless(r, words), r.choice([*_OTHERS, *words[:4]])
    quote = r.choice(["", "", '"', "'"])
    sign = r.choice([" = ", "=", ": ", ": ", " "]) if quote == "" else r.choice([" = ", ": "])
    head = f"{left} {r.choice([lead, lead.upper()])}{sign}{quote}"
    return f"{head}{value}{quote} {right}", len(head), len(head) + len(value), label


def part_of() -> Column:
    """Column: 0, 1 teach words and paths, 2, 3 the forest, 4 is held out."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5))


def labelled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source", most: int = MOST_FINDINGS) -> DataFrame:
    """(doc_id, path, secret, before, after, rule, label, weak_label, part) of at most ``most`` labelled findings,
    ``PER_DOCUMENT`` from each of the documents of the smallest hashes; a string that the scan takes for no candidate gives none."""
    from strata.llm.secrets import places, weak_label

    base = docs.select(as_text(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(path_col).cast("string").alias("_path"))
    base = base.where("length(_text) > 0").withColumn("_h", F.xxhash64("_id", "_text"))
    # the least hashes first, then their texts: a row that is repeated very often counts once
    chosen = written(base.select("_h").distinct().orderBy("_h").limit(most // PER_DOCUMENT), "sampled")
    sample = base.join(F.broadcast(chosen), "_h").groupBy("_h").agg(F.min(F.struct("_id", "_text", "_path")).alias("x")).select("x.*")

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, text, path in zip(pdf["_id"], pdf["_text"], pdf["_path"]):
                words = text.split()
                if not words:
                    continue
                r = random.Random(zlib.crc32(f"{doc}/{text}".encode()))
                for _ in range(PER_DOCUMENT):
                    made, start, end, label = finding(r, words)
                    # the candidate that holds most of the string
                    held = max(places(made), key=lambda p: min(p[1], end) - max(p[0], start), default=None)
                    if held is None or min(held[1], end) <= max(held[0], start):
                        continue
                    a, z, rule = held
                    before, after = made[max(0, a - 80) : a], made[z : z + 40]
                    rows.append((doc, path or "", made[a:z], before, after, rule, label, weak_label(rule, made[a:z], before)))
            out = pd.DataFrame(rows, columns=["doc_id", "path", "secret", "before", "after", "rule", "label", "weak_label"])
            out["weak_label"] = out["weak_label"].astype("Int32")
            yield out

    made = sample.mapInPandas(make, "doc_id string, path string, secret string, before string, after string, rule string, label int, weak_label int")
    # few rows by their bound: a file for each shuffle partition would be hundreds of tiny ones; texts still come a partition at a time
    return written(made.withColumn("part", part_of()).coalesce(FINDING_FILES), "labelled-findings")


def _odds(rows: list, of, labels: Counter) -> dict[str, float]:
    seen: dict[str, Counter] = {}
    for r in rows:
        for w in of(r):
            seen.setdefault(w, Counter())[r["label"]] += 1
    rate = lambda c, k: (c[k] + 0.5) / (labels[k] + 1)
    return {w: math.log(rate(c, 1) / rate(c, 0)) for w, c in seen.items() if sum(c.values()) >= LEAST_NEAR}


def learn(docs: DataFrame, made: DataFrame, text_col: str = "text") -> Learnt:
    """The dictionary of ``docs``, and the words and paths near the findings ``made`` of the first parts."""
    words, pairs = dictionary(docs, text_col)
    rows = made.where("part < 2").select("label", "before", "after", "path").collect()  # bounded by the sample
    labels = Counter(r["label"] for r in rows)
    return Learnt(words, pairs, _odds(rows, lambda r: near_words(r["before"], r["after"]), labels), _odds(rows, lambda r: path_parts(r["path"]), labels))
