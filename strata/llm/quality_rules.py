"""Quality rules: a threshold table compiled into one Spark projection.

Everything is a built-in column expression; no user function, no shuffle. A
rule bounds one metric from below, above or both; a document is kept when the
base thresholds hold and no rule is broken.

Defined results: a null or empty text has no words, fails the base threshold
and is not kept; repeated rows give repeated results; an empty table gives an
empty one; columns of the input that clash with metric names are replaced
unless listed in ``keep`` (see ``apply_rules``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SEPARATORS, carried, restored, words_of

#: frequent function words of English, French, Spanish and German
STOP_WORDS = (
    "the of and to in is that it was for on are as with be at by this from or an "
    "de la le et les des en un une du que est pour qui dans par pas au sur ne "
    "el los las se por con su para es lo como al del no una "
    "der die und den von das mit sich auf für ist im dem nicht ein eine zu als auch"
).split()
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """``metric`` must lie in [least, most]; a None bound is open."""

    name: str
    metric: str
    least: float | None = None
    most: float | None = None


#: the base threshold of the contract: fewer words, or a larger share of words in repeated windows, fail
BASE_MIN_WORDS = 50
BASE_MAX_REPEAT_PERCENT = 50

#: the production threshold table
RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 14.0),
    Rule("symbols", "symbols_per_word", None, 0.10),
    Rule("stop_words", "stop_word_ratio", 0.02, None),
    Rule("letters", "letter_word_ratio", 0.60, None),
    Rule("upper_case", "upper_word_ratio", None, 0.30),
    Rule("exclamations", "exclaimed_word_ratio", None, 0.30),
    Rule("repeated_lines", "dup_line_ratio", None, 0.50),
    Rule("bullets", "bullet_line_ratio", None, 0.90),
    Rule("ellipses", "ellipsis_line_ratio", None, 0.30),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part.cast("double") / whole).otherwise(F.lit(0.0))


def _share(words: Column, test, n: Column) -> Column:
    return _ratio(F.size(F.filter(words, test)), n)


def with_repeated_window_words(d: DataFrame, words: str, n: str) -> DataFrame:
    """``n_repeat_words``: words that lie in a run of three found at least twice among ``words``.

    Runs are first compared by hashes, as numbers: most texts have no equal ones
    and are done. Of the others, the runs whose hashes repeat are spelt out, sorted
    with their places, and equal neighbours mark repeats.
    """
    d = d.withColumn("_h", F.expr(
        f"CASE WHEN {n} < 4 THEN array() ELSE transform(sequence(0, {n} - 3), i -> xxhash64({words}[i], {words}[i + 1], {words}[i + 2])) END"))
    d = d.withColumn("_p", F.expr(
        "CASE WHEN size(array_distinct(_h)) = size(_h) THEN NULL ELSE sort_array(transform(_h, (h, i) -> struct(h, i))) END"))
    again = "filter(_p, (x, k) -> (k > 0 AND _p[k - 1].h = x.h) OR (k < size(_p) - 1 AND _p[k + 1].h = x.h))"
    d = d.withColumn("_s", F.expr(
        f"sort_array(transform({again}, x -> struct(concat_ws(' ', {words}[x.i], {words}[x.i + 1], {words}[x.i + 2]) AS g, x.i AS i)))"))
    d = d.withColumn("_at", F.expr(
        "transform(filter(_s, (x, k) -> (k > 0 AND _s[k - 1].g = x.g) OR (k < size(_s) - 1 AND _s[k + 1].g = x.g)), x -> x.i)"))
    d = d.withColumn("n_repeat_words", F.expr(
        "CASE WHEN _s IS NULL THEN 0 ELSE size(array_distinct(flatten(transform(_at, i -> array(i, i + 1, i + 2))))) END").cast("long"))
    return d.drop("_h", "_p", "_s", "_at")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every metric a rule may name."""
    t = F.coalesce(F.col(text), F.lit(""))
    d = docs.withColumn("_w", words_of(F.col(text))).withColumn("n_words", F.size("_w").cast("long"))
    d = with_repeated_window_words(d, "_w", "n_words")
    # a line counts when it holds a word
    d = d.withColumn("_l", F.filter(F.split(t, "\n"), lambda x: F.length(F.regexp_replace(x, SEPARATORS + "+", "")) > 0))
    n, lines = F.col("n_words"), F.size("_l")
    symbols = F.length(t) - F.length(F.translate(t, SYMBOLS, ""))
    d = d.select(
        *[c for c in d.columns if c not in ("_w", "_l")],
        F.length(F.regexp_replace(t, SEPARATORS + "+", "")).cast("long").alias("word_chars"),
        symbols.cast("long").alias("n_symbols"),
        (lines - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        lines.cast("long").alias("n_lines"),
        _share(F.col("_w"), lambda w: F.lower(w).isin(STOP_WORDS), n).alias("stop_word_ratio"),
        _share(F.col("_w"), lambda w: w.rlike(r"\p{L}"), n).alias("letter_word_ratio"),
        _share(F.col("_w"), lambda w: w.rlike(r"^\P{Ll}*\p{Lu}\P{Ll}*\p{Lu}\P{Ll}*$"), n).alias("upper_word_ratio"),
        _share(F.col("_w"), lambda w: w.endswith("!!"), n).alias("exclaimed_word_ratio"),
        _share(F.col("_l"), lambda x: x.rlike(r"^\s*[-*•]"), lines).alias("bullet_line_ratio"),
        _share(F.col("_l"), lambda x: x.rlike(r"(\.\.\.|…)\s*$"), lines).alias("ellipsis_line_ratio"),
    )
    return d.withColumns({
        "mean_word_chars": _ratio(F.col("word_chars"), n),
        "symbols_per_word": _ratio(F.col("n_symbols"), n),
        "dup_line_ratio": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
    })


METRICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "stop_word_ratio",
    "letter_word_ratio", "upper_word_ratio", "exclaimed_word_ratio", "bullet_line_ratio", "ellipsis_line_ratio",
    "mean_word_chars", "symbols_per_word", "dup_line_ratio",
)


def compiled(rules: tuple[Rule, ...] = RULES) -> Column:
    """The table as one column: the names of the broken rules."""
    broken = []
    for r in rules:
        m = F.col(r.metric)
        out = F.lit(False)
        if r.least is not None:
            out = out | (m < F.lit(r.least))
        if r.most is not None:
            out = out | (m > F.lit(r.most))
        broken.append(F.when(out, F.lit(r.name)))
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def apply_rules(
    docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, keep: tuple[str, ...] | None = None
) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all that don't clash by default), the
    metrics, ``base_failed``, ``broken`` (rule names) and ``kept``."""
    own = {*METRICS, "base_failed", "broken", "kept"}
    keep = tuple(c for c in docs.columns if c not in own and c != text) if keep is None else keep
    d = measured(carried(docs.select(*[f"`{c}`" for c in {text: 0} | dict.fromkeys(keep)]), _text=F.col(f"`{text}`")), "_text")
    n = F.col("n_words")
    d = d.withColumn(
        "base_failed", (n < BASE_MIN_WORDS) | (100 * F.col("n_repeat_words") > BASE_MAX_REPEAT_PERCENT * n)
    ).withColumn("broken", compiled(rules))
    d = d.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0))
    return d.select(*restored(d, list(keep)), *METRICS, "base_failed", "broken", "kept")
