"""Secret scan: patterns find candidates, a random forest removes false positives.

Candidates are, in this order: known key formats, whatever signs stand around
them; values assigned to a name that says it is a key, of any length and with any
signs; and other long strings without spaces that hold a digit. Each is sought
beside those before it. The forest (Spark ML) sees each candidate's length, entropy, share
of digits, letters and signs, changes of character class, the share covered by the corpus's
frequent words, how usual its letter pairs are there, what the path it came from and
the words and signs next to it (80 characters before, 40 after) told of other findings.
It is trained on labelled findings (``findings.labelled``, at most ``MOST_FINDINGS``), which
no rule on the string labels. ``weak_label`` is such a rule, kept beside for comparison.

Defined results: null and empty texts have no finding; findings do not overlap; rows with equal ids give the same findings
once a row; with one kind of label only, that label stands; null paths are
empty ones; an empty table gives an empty one.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import as_text, written
from strata.llm.findings import Learnt, labelled, learn

#: public key formats, beside letters and digits only
FORMATS = {
    "aws_access_key": r"(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])",
    "github_token": r"gh[pousr]_[A-Za-z0-9]{36,}",
    "slack_token": r"xox[abpr]-[A-Za-z0-9-]{10,}",
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----",
    "jwt": r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{5,}",
}
_FORMAT = re.compile("|".join(f"(?P<{k}>{'' if k == 'private_key' else '(?<![A-Za-z0-9])'}{v})" for k, v in FORMATS.items()))
_KEY = r"(?:token|secret|passw(?:or)?d|passphrase|pwd|api[_-]?key|auth|credential|access[_-]?key|private[_-]?key|bearer)(?:[_-][A-Za-z0-9]{1,20}){0,3}"
_ASSIGNED = re.compile(
    rf"(?i:{_KEY})[\"']?[ \t]{{0,4}}(?:=>|:=|=(?!=)|:(?!//))[ \t]{{0,4}}"
    r"(?:\"(?P<double>[^\"\n]+)\"|'(?P<single>[^'\n]+)'|(?P<bare>[^\s\"'=:][^\s\"']*))"
)
_GENERIC = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])(?:[A-Za-z0-9+/_-]{16,}={0,2}|[A-Za-z0-9+/_-]{15}=|[A-Za-z0-9+/_-]{14}==)"
)
_KEY_NAME = re.compile(rf"(?i){_KEY}\W{{0,4}}$")
#: values that name a place to look in, or none
_REFERENCE = re.compile(r"(?i)[$<{%].*|.*[(\[{].*|none|null|nil|true|false|undefined")
_PLACEHOLDER = re.compile(r"(?i)example|sample|dummy|changeme|placeholder|your[_-]|xxxx|0000000|1234567")
NUMBERS = (
    "length", "entropy", "digits", "upper", "lower", "signs", "class_changes", "hex", "dictionary", "usual_pairs", "distinct",
    "placeholder", "path_code", "path_test", "path_depth", "key_before", "assigned", "quoted", "url_near", "words_near",
    "near_score", "path_score",
)


def numbers(candidate: str, before: str, after: str, path: str, learnt: Learnt) -> list[float]:
    """Features of one candidate, in the order of NUMBERS."""
    n = max(1, len(candidate))
    counts = Counter(candidate)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in candidate]
    low = candidate.lower()
    near = before.rsplit("\n", 1)[-1]
    return [
        float(len(candidate)), -sum(c / n * math.log2(c / n) for c in counts.values()), kinds.count("d") / n, kinds.count("u") / n,
        kinds.count("l") / n, kinds.count("s") / n, sum(a != b for a, b in zip(kinds, kinds[1:])) / n,
        sum(c in "0123456789abcdef" for c in low) / n, learnt.covered(low) / n, learnt.transitions(low), len(counts) / n,
        float(bool(_PLACEHOLDER.search(candidate))), float(bool(re.search(r"\.(py|js|java|go|rb|env|ya?ml|json|conf|ini|sh)\b", path))),
        float("test" in path.lower() or "example" in path.lower()), float(path.count("/")), float(bool(_KEY_NAME.search(near.rstrip("\"' =:>")))),
        float(bool(re.search(r"[=:]\s*[\"']?$", near))), float(near[-1:] in "\"'" and near[-1:] != "" and after[:1] == near[-1:]),
        float("://" in near[-40:] or "@" in near[-20:]), float(len(re.findall(r"[^\W\d_]{2,}", near[-40:] + " " + after[:40]))),
        learnt.near_score(before, after), learnt.path_score(path),
    ]


def weak_label(rule: str, candidate: str, before: str) -> int | None:
    """1 for a known format, or a string of many characters under a name that
    says what it is; 0 for plain numbers, placeholders and word-like strings;
    None where neither settles it."""
    if _PLACEHOLDER.search(candidate):
        return 0
    if rule == "assigned":
        if candidate.isdigit() or _REFERENCE.fullmatch(candidate):
            return 0
        return 1 if any(c.isalpha() for c in candidate) and not candidate.isalpha() and " " not in candidate else None
    if rule != "generic":
        return 1
    if candidate.isdigit() or len(set(candidate)) < 8:
        return 0
    if _KEY_NAME.search(before.rsplit("\n", 1)[-1].rstrip("\"' =:>")):
        return 1
    return 0 if sum(c.isdigit() for c in candidate) < 3 else None


def places(text: str) -> list[tuple[int, int, str]]:
    """(start, end, rule) of each candidate, in order; none overlap."""
    found = [(m.start(), m.end(), m.lastgroup) for m in _FORMAT.finditer(text)]
    free = _blanked(text, found)
    values = []
    for m in _ASSIGNED.finditer(free):
        a, z = m.span(m.lastgroup)
        if m.lastgroup == "bare":
            z = a + _bare_length(free[a:z], free[free.rfind("\n", 0, a) + 1 : a], free[z : z + 1])
        if "\0" not in free[a:z] and free[a:z].strip():
            values.append((a, z, "generic" if _GENERIC.fullmatch(free[a:z]) else "assigned"))
    found += values
    free = _blanked(free, values)
    return sorted(found + [(m.start(), m.end(), "generic") for m in _GENERIC.finditer(free)])


def _bare_length(value: str, before: str, after: str) -> int:
    """Characters of an unquoted value: all of a line of an env file; elsewhere
    without the signs that close a sentence or a bracket opened before it."""
    if after in ("", "\n", "\r") and re.fullmatch(r"(?:export[ \t]+)?\w+=", before):
        return len(value)
    kept = value
    while kept and (kept[-1] in ",;." or kept[-1] in ")]}>" and kept.count("([{<"[")]}>".index(kept[-1])]) < kept.count(kept[-1])):
        kept = kept[:-1]
    return len(kept) or len(value)


def _blanked(text: str, spans: list[tuple[int, int, str]]) -> str:
    """``text`` of the same length without what stands in ``spans``."""
    out, at = [], 0
    for a, z, _ in spans:
        out += [text[at:a], "\0" * (z - a)]
        at = z
    return "".join([*out, text[at:]])


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source", learnt: Learnt | None = None) -> DataFrame:
    """One row a candidate: (id, start, length, rule, secret, before, after, weak_label) and NUMBERS; places in code points."""

    known = learnt or Learnt()  # of a bounded number of words; goes with the function, by value

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, text, path in zip(pdf["_id"], pdf["_text"], pdf["_path"]):
                for a, z, rule in places(text or ""):
                    secret, before, after = text[a:z], text[max(0, a - 80) : a], text[z : z + 40]
                    label = weak_label(rule, secret, before)
                    rows.append((doc, a, z - a, rule, secret, before, after, label, *numbers(secret, before, after, path or "", known)))
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length_", "rule", "secret", "before", "after", "weak_label", *NUMBERS])
            out["weak_label"] = out["weak_label"].astype("Int32")
            yield out

    schema = "doc_id string, start long, length_ long, rule string, secret string, before string, after string, weak_label int, " + ", ".join(f"`{c}` double" for c in NUMBERS)
    return docs.select(
        as_text(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(path_col).cast("string").alias("_path")
    ).mapInPandas(scan, schema).withColumnRenamed("length_", "n_chars").withColumn("doc_id", F.col("doc_id").cast("long"))


def with_numbers(made: DataFrame, learnt: Learnt) -> DataFrame:
    """Labelled findings with the features of a candidate."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [numbers(*x, learnt) for x in zip(pdf["secret"], pdf["before"], pdf["after"], pdf["path"])]
            yield pd.concat([pdf.reset_index(drop=True), pd.DataFrame(rows, columns=list(NUMBERS))], axis=1)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema.fields)
    return made.mapInPandas(add, fields + ", " + ", ".join(f"`{c}` double" for c in NUMBERS))


def trained(docs: DataFrame, **columns) -> tuple[Learnt, object, DataFrame]:
    """What was learnt, the forest, and the labelled findings with their features (``part`` 4 is held out)."""
    made = labelled(docs, **columns)
    learnt = learn(docs, made, columns.get("text_col", "text"))
    made = written(with_numbers(made, learnt), "findings-numbers")
    return learnt, fit(made.where("part IN (2, 3)")), made


def fit(findings: DataFrame, label_col: str = "label", max_rows: int = 20_000, trees: int = 20, depth: int = 6, seed: int = 7):
    """A random forest over NUMBERS, or the one label there is (or None)."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    labelled = (
        findings.where(F.col(label_col).isin(0, 1)).select(F.col(label_col).cast("double").alias("y"), *NUMBERS)
        .orderBy(F.xxhash64(*NUMBERS), *NUMBERS).limit(max_rows)
    )
    labelled = written(VectorAssembler(inputCols=list(NUMBERS), outputCol="x").transform(labelled).select("y", "x"), "findings")
    kinds = {r["y"]: r["count"] for r in labelled.groupBy("y").count().collect()}
    if len(kinds) < 2:
        return next(iter(kinds), None)
    return RandomForestClassifier(
        featuresCol="x", labelCol="y", numTrees=trees, maxDepth=depth, seed=seed, probabilityCol="p", rawPredictionCol="raw", predictionCol="hard"
    ).fit(labelled)


def compiled(forest) -> Column:
    """The forest's probability of a secret as built-in column expressions: a nested CASE for each tree."""

    def share(node) -> Column:
        if node.getClass().getSimpleName() == "LeafNode":
            stats = list(node.impurityStats().stats())
            return F.lit(stats[1] / sum(stats) if sum(stats) else 0.5)
        split = node.split()
        left = F.col(f"`{NUMBERS[split.featureIndex()]}`") <= F.lit(split.threshold())
        return F.when(left, share(node.leftChild())).otherwise(share(node.rightChild()))

    trees = [share(t._java_obj.rootNode()) for t in forest.trees]
    return sum(trees[1:], trees[0]) / F.lit(float(len(trees)))


def judged(findings: DataFrame, forest, threshold: float = 0.5) -> DataFrame:
    """``findings`` with ``score`` and ``kept`` (no false positive). The fitted trees are compiled into
    the plan: nothing of the session travels with them."""
    known = forest is None or isinstance(forest, float)
    score = F.coalesce(F.lit(forest), F.lit(0.5)).cast("double") if known else compiled(forest)
    return findings.withColumn("score", score).withColumn("kept", F.col("score") >= threshold)
