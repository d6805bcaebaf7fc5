r"""Personal data by patterns, and terms that disclose it by information content.

Four kinds of personal data are found by patterns: e-mail and IP addresses, card
numbers (Luhn) and phone numbers. Each distinct value is a protected entity. The
corpus then says which other terms give an entity away: with N documents, df(c)
of them holding the entity c, df(t) the term t and df(c, t) both, t within a few
words of c,

    PMI(c; t) = log2(N df(c, t) / (df(c) df(t))),    IC(c) = -log2(df(c) / N),

and IC(c) - PMI(c; t) = -log2 P(c | t) bits are left to guess once t is known. A
term that leaves at most one bit (a chance of one half) is generalised to its kind
of word, one that leaves at most log2(10 / 9) bits (nine in ten) is removed,
wherever it stands, provided that it adds three bits or more. Copies of one text, exact
or nearly so, must not pass for evidence: a pair counts only when it was seen in three
different surroundings, and an entity only if a term of one of its surroundings recurs
in another with a chance of one half at most (among near copies most terms do).
All bounds are compared in whole numbers.

All of this is made of built-in functions. A pattern's matches and the pieces
between them come from ``regexp_extract_all`` and ``split``; places are running sums of
their lengths, in two levels, so that a text with very many matches stays cheap.
The patterns are written so that no match is tried twice from within one run of
characters: each is linear in the text.

Defined results: a null or empty text holds nothing; repeated rows give
repeated results and count as often in df; a null id is as good as any; an empty
table gives an empty result; no column of the input can clash, as all but the text
are carried in one struct; places are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import carried, restored, written

# ---- fixed values: the kinds in the order of the spans, and their patterns ------------
# Possessive quantifiers and the look-behinds change no match: what follows a run never
# stands in it, so a match from inside a run exists only if one from its beginning does.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){12,}+"  # a run of fewer digits fails in any case
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
IP_PARTS = rf"^{_PART}(?:\.{_PART}){{3}}$"
CARD_DIGITS, PHONE_DIGITS = (13, 19), (9, 15)
# ---------------------------------------------------------------------------------------
TERM = r"[\p{L}\p{N}]+"
NO_TERM = r"[^\p{L}\p{N}]+"
TERM_KIND = "term"
#: characters on each side of an entity in which terms count as near
NEAR = 120
#: distinct surroundings a pair needs; percent of a term's documents that hold the entity;
#: how many times likelier the term makes the entity; how often a term of one surrounding
#: of an entity may recur in another
LEAST_CONTEXTS, GENERALISE_PERCENT, REMOVE_PERCENT, LEAST_GAIN, MOST_RECURRING_PERCENT = 3, 50, 90, 8, 50
#: terms up to which a table of them is broadcast (each is a word)
MOST_BROADCAST = 200_000
#: how many lengths are summed one by one before a sum of whole blocks is taken
_BLOCK = 16


def _let(value: str, name: str, body: str) -> str:
    """SQL: ``body`` with ``name`` standing for ``value``, which is evaluated once (a column of an
    inner projection that is named once would be put back into the lambdas that use it)."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def placed(d: DataFrame, text: str, pattern: str, name: str, present: Column) -> DataFrame:
    """``d`` with the array ``name`` of the pattern's matches: start, value and the pieces of text before and after."""
    p, m = f"_{name}_pieces", f"_{name}_found"
    d = d.withColumn(m, F.when(present, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
    d = d.withColumn(p, F.when(F.size(m) > 0, F.split(text, pattern, -1)))
    lengths = f"transform({m}, (x, i) -> length(get({p}, i)) + IF(i > 0, length({m}[i - 1]), 0))"
    add = "0, (t, v) -> t + v"
    # the sums up to each block, then within a block up to each match
    sums = f"aggregate(sequence(0, (size(n) - 1) div {_BLOCK}), array(0), (s, b) -> concat(s, array(element_at(s, -1) + aggregate(slice(n, b * {_BLOCK} + 1, {_BLOCK}), {add}))))"
    start = f"o[i div {_BLOCK}] + aggregate(slice(n, i - i % {_BLOCK} + 1, i % {_BLOCK} + 1), {add})"
    matches = f"transform({m}, (x, i) -> struct({start} AS start, x AS value, get({p}, i) AS before, get({p}, i + 1) AS after))"
    empty = "CAST(array() AS array<struct<start:int,value:string,before:string,after:string>>)"
    d = d.withColumn(name, F.expr(f"CASE WHEN size({m}) = 0 THEN {empty} ELSE {_let(lengths, 'n', _let(sums, 'o', matches))} END"))
    return d.drop(p, m)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid check digit."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda x, i: F.when(i % 2 == 0, x.try_cast("int")).otherwise(
        F.get(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), x.try_cast("int"))))
    return F.aggregate(each, F.lit(0), lambda s, v: s + F.coalesce(v, F.lit(0))) % 10 == 0


def _between(digits: Column, bounds: tuple[int, int]) -> Column:
    return F.length(digits).between(*bounds)


_VALID = {
    "email": lambda x: F.lit(True),
    "ip": lambda x: x.rlike(IP_PARTS),
    "card": lambda x: _between(_digits(x), CARD_DIGITS) & luhn(_digits(x)),
    "phone": lambda x: _between(_digits(x), PHONE_DIGITS),
}
_PRESENT = {"email": "@", "ip": ".", "card": None, "phone": "+"}


def _valid(kind: str) -> Column:
    return F.filter(f"_{kind}", lambda x: _VALID[kind](x["value"]))


def with_base_spans(d: DataFrame, text: str = "_text") -> DataFrame:
    """``d`` with an array column ``_email``, ``_ip``, ``_card``, ``_phone`` of what is left of each kind's matches."""
    for kind, pattern in PATTERNS.items():
        sign = _PRESENT[kind]
        present = F.col(text).contains(sign) if sign else F.col(text).rlike("[0-9][0-9 -]{5}")
        d = placed(d, text, pattern, f"_{kind}", present)
        d = d.withColumn(f"_{kind}", _valid(kind))
    return d


# ---------------------------------------------------------------- what the corpus tells
def _entity(kind: str, value: Column) -> Column:
    same = {"email": F.lower(value), "ip": value, "card": _digits(value), "phone": _digits(value)}[kind]
    return F.concat(F.lit(kind + ":"), same)


def _near(x: Column) -> Column:
    """Whole terms within ``NEAR`` characters of an entity (up to its neighbours of the same kind)."""
    before = F.substring(x["before"], -NEAR, NEAR)
    before = F.when(F.length(x["before"]) > NEAR, F.regexp_replace(before, f"^{TERM}", "")).otherwise(before)
    after = F.substring(x["after"], 1, NEAR)
    after = F.when(F.length(x["after"]) > NEAR, F.regexp_replace(after, f"{TERM}$", "")).otherwise(after)
    return F.concat_ws("\n", before, after)


def _seen(kind: str) -> Column:
    return F.transform(f"_{kind}", lambda x: F.struct(_entity(kind, x["value"]).alias("entity"), _near(x).alias("context")))


def evidence(docs: DataFrame, text: str = "text") -> DataFrame:
    """(entity, context, at): every protected value with the text around it and the number of its row."""
    d = with_base_spans(docs.select(F.col(f"`{text}`").alias("_text")).where("_text IS NOT NULL"))
    d = d.where(" OR ".join(f"size(_{k}) > 0" for k in PATTERNS)).withColumn("at", F.monotonically_increasing_id())
    return written(d.select("at", F.explode(F.concat(*map(_seen, PATTERNS))).alias("x")).select("at", "x.*"), "evidence")


def distinct_terms(text: str) -> Column:
    return F.array_distinct(F.split(text, NO_TERM))


def term_documents(docs: DataFrame, terms: DataFrame, n_terms: int, text: str = "text", most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """(term, dt): in how many documents each of ``terms`` occurs. Few terms are broadcast to the
    documents; of many, all words are counted first (combined before the shuffle) and joined then."""
    words = docs.select(F.explode(distinct_terms(f"`{text}`")).alias("term"))
    if n_terms <= most_broadcast:
        words = words.join(F.broadcast(terms), "term", "left_semi")
    counted = words.groupBy("term").agg(F.count(F.lit(1)).alias("dt"))
    return counted if n_terms <= most_broadcast else counted.join(terms, "term", "left_semi")


def disclosing_terms(
    docs: DataFrame, text: str = "text", least_contexts: int = LEAST_CONTEXTS, generalise_percent: int = GENERALISE_PERCENT,
    remove_percent: int = REMOVE_PERCENT, least_gain: int = LEAST_GAIN, most_recurring_percent: int = MOST_RECURRING_PERCENT, most_broadcast: int = MOST_BROADCAST,
) -> DataFrame:
    """(term, removed, bits_left, gain, entity): terms beyond the thresholds, with the entity they disclose most."""
    found = evidence(docs, text)
    values = found.groupBy("entity").agg(F.count_distinct("at").alias("dc"), F.count_distinct("context").alias("places"))
    near = found.select("entity", "at", F.xxhash64("context").alias("context"), F.explode(distinct_terms("context")).alias("term")).where("term <> ''")
    pairs = near.groupBy("entity", "term").agg(F.count_distinct("context").alias("contexts"), F.count_distinct("at").alias("dct"))
    pairs = written(pairs, "pairs")
    again = pairs.groupBy("entity").agg(F.sum(F.expr("contexts * (contexts - 1)")).alias("recurring"), F.sum("contexts").alias("seen"))
    values = written(values.join(again, "entity").where(F.col("recurring") * 100 <= F.col("seen") * (F.col("places") - 1) * most_recurring_percent), "values")
    pairs = written(pairs.where(F.col("contexts") >= least_contexts).join(values, "entity"), "supported")
    terms = written(pairs.select("term").distinct(), "terms")
    n = docs.count()
    held = term_documents(docs, terms, terms.count(), text, most_broadcast)
    exact = lambda c: F.col(c).cast("decimal(18,0)")
    r = pairs.join(held, "term")
    r = r.where((F.lit(100) * F.col("dct") >= generalise_percent * F.col("dt"))
                & (F.lit(n).cast("decimal(18,0)") * exact("dct") >= F.lit(least_gain).cast("decimal(2,0)") * exact("dc") * exact("dt")))
    r = r.select(
        "term", (F.lit(100) * F.col("dct") >= remove_percent * F.col("dt")).alias("removed"), "entity",
        F.log2(F.col("dt") / F.col("dct")).alias("bits_left"), F.log2(F.lit(float(n)) * F.col("dct") / (F.col("dc") * F.col("dt").cast("double"))).alias("gain"),
    )
    worst = F.min_by(F.struct("removed", "bits_left", "gain", "entity"), F.struct("bits_left", F.negative("gain"), "entity"))
    return written(r.groupBy("term").agg(worst.alias("w")).select("term", "w.*"), "disclosing")


# ---------------------------------------------------------------- what is done about it
def _key(text: str) -> list[Column]:
    return [F.xxhash64(text).alias("_k1"), F.xxhash64(F.lit(1), text).alias("_k2")]


def _span(kind: str, shown: Column):
    return lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), (x["start"] + F.length(x["value"])).alias("end"), shown.alias("shown"))


def _general(word: Column) -> Column:
    """The kind of word that stands for a generalised term."""
    return F.when(word.rlike(r"\p{N}"), "[number]").when(word.rlike(r"^\p{Lu}"), "[name]").otherwise("[word]")


def sanitised(docs: DataFrame, text: str = "text", most_broadcast: int = MOST_BROADCAST, **thresholds) -> DataFrame:
    """``docs`` with ``_spans`` (kind, start, end, shown: what stands in the place), base kinds
    first, then the disclosing terms, each by start; and ``_sanitised``, the text with all
    spans replaced, where overlapping ones become one."""
    risky = disclosing_terms(docs, text, most_broadcast=most_broadcast, **thresholds)
    n_risky = risky.count()
    d = carried(docs, _text=F.col(f"`{text}`"))
    marks = d.select(*_key("_text"), F.explode(distinct_terms("_text")).alias("term"))
    marks = marks.join(F.broadcast(risky) if n_risky <= most_broadcast else risky, "term")
    # one row a text, of its own distinct words
    marks = written(marks.groupBy("_k1", "_k2").agg(F.collect_set(F.struct("term", "removed")).alias("_risky")), "marks")
    d = with_base_spans(d.select("*", *_key("_text"))).join(marks, ["_k1", "_k2"], "left")
    d = d.withColumn("_base", F.concat(*[F.transform(f"_{k}", _span(k, F.lit(f"[{k}]"))) for k in PATTERNS]))
    d = placed(d, "_text", TERM, "_words", F.col("_risky").isNotNull())
    d = d.withColumn("_risk", F.map_from_entries("_risky"))
    d = d.withColumn("_words", F.filter("_words", lambda x: F.map_contains_key("_risk", x["value"])))
    d = d.withColumn("_terms", F.transform("_words", lambda x: _span(TERM_KIND, F.when(F.element_at("_risk", x["value"]), "").otherwise(_general(x["value"])))(x)))
    apart = F.filter("_terms", lambda t: ~F.exists("_base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    d = d.withColumn("_spans", F.concat("_base", F.coalesce(apart, F.array().cast("array<struct<kind:string,start:int,end:int,shown:string>>"))))
    in_order = "array_sort(transform(_spans, s -> struct(s.start AS start, -s.end AS back, s.end AS end, s.shown AS shown)))"
    d = d.withColumn("_sanitised", F.expr(
        f"aggregate({in_order}, struct(0 AS at, '' AS out), (a, s) -> IF(s.start < a.at, struct(greatest(a.at, s.end) AS at, a.out AS out), "
        "struct(s.end AS at, concat(a.out, substring(_text, a.at + 1, s.start - a.at), s.shown) AS out)), "
        "a -> concat(a.out, substring(_text, a.at + 1)))"))
    return d.select(*restored(d, docs.columns), "_spans", "_sanitised")


def span_list(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined, in their order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(kind: str) -> Column:
    """How many of ``_spans`` are of a kind."""
    return F.size(F.filter("_spans", lambda s: s["kind"] == kind)).cast("long")
