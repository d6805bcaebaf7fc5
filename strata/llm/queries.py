"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from strata.llm import collocations, decontamination, disclosure, hard_negatives, line_dedup, ngram_join, packing, quality_classifier, quality_rules, secrets, suffix_dedup, toxicity, warc
from strata.llm.common import shared_path, table, written


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all ``documents``: every candidate with the forest's score."""
    docs = table(spark, sf_dir, "documents")
    learnt, forest, _ = secrets.trained(docs)
    found = written(secrets.candidates(docs, learnt=learnt), "candidates")
    return secrets.judged(found, forest).select("doc_id", "start", "n_chars", "rule", "score", "kept")


def graded(labels: DataFrame) -> DataFrame:
    """Grades of the labelled rows: 0 low quality, 1 good but toxic, 2 good."""
    quality, toxic = F.col("quality"), F.coalesce(F.col("toxic"), F.lit(0))
    return labels.select("doc_id", F.when(quality == 0, 0).when((quality == 1) & (toxic == 1), 1).when(quality == 1, 2).alias("grade"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade of all ``documents``; ``kept``: likelier than not above the lowest grade."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_classifier.fit(docs, graded(table(spark, sf_dir, "labels").where(~held_out_third())), n_grades=3)
    d = quality_classifier.score(docs, model, least_grade=1)
    return d.select(
        "doc_id", held_out_third().alias("held_out"), F.col("_expected_grade").alias("expected_grade"),
        F.col("_tail").alias("tail_probability"), F.col("_selected").alias("kept"),
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over every whole text of ``documents``."""
    d = quality_rules.apply_rules(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return d.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of ``documents`` covered by 200-byte strings that also start elsewhere."""
    d = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), span=200)
    return d.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all ``documents``: five-word shingles, Jaccard 0.8 or more."""
    d = ngram_join.jaccard_components(table(spark, sf_dir, "documents"))
    return d.select(F.col("_id").alias("doc_id"), "n_shingles", "component_id")


def held_out_third():
    """Column: rows whose labels are never learnt from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def toxicity_lexicon(spark: SparkSession, sf_dir: str) -> toxicity.Lexicon:
    """Learnt from the labels that are not held out."""
    labels = table(spark, sf_dir, "labels").where(~held_out_third())
    return toxicity.fit(table(spark, sf_dir, "documents"), labels)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text of ``documents``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    d = toxicity.score(docs, toxicity_lexicon(spark, sf_dir))
    return d.select(
        "doc_id", held_out_third().alias("held_out"), F.col("_score").alias("score"),
        F.col("_toxic").cast("int").alias("predicted"), F.size("_terms").alias("n_terms"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a ``benchmark`` item, also with other numbers, names or units."""
    d = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), verbatim=True)
    return d.groupBy(F.col("_id").alias("doc_id"), "item_id").agg(
        F.max("n_windows").alias("n_windows"), F.max("coverage").alias("coverage"), F.max("n_slots").alias("n_slots")
    )


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file; a parameter of the operators that need one."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens packed from all ``documents``."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(), window=2048)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` written as WARC records and read back."""
    path = shared_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), path)
    return warc.read_archive(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "complete")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated multi-line chunks, and passages of 50 words or more, removed from all ``documents``."""
    d = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), least_words=50)
    return d.select(
        "doc_id",
        F.col("_lines").alias("n_lines"),
        F.col("_removed_lines").alias("n_removed_lines"),
        F.col("_removed_chunks").alias("n_removed_chunks"),
        F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it in every whole text of ``documents``."""
    d = disclosure.sanitised(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("_spans", lambda s: s["kind"] != disclosure.TERM_KIND)
    return d.select(
        "doc_id", *[disclosure.count_of(k).alias(f"n_{k}") for k in disclosure.PATTERNS],
        F.sha2(disclosure.span_list(base), 256).alias("base_sha256"), disclosure.span_list(F.col("_spans")).alias("spans"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2000 collocations of each language of ``documents``."""
    return collocations.collocations(table(spark, sf_dir, "documents"), least=100, top=2000)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives in ``embeddings`` for every hundredth row against all rows."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_quality_rules": op3_quality_rules,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_ngram_join": op5_ngram_join,
    "op6_toxicity": op6_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_packing": op8_packing,
    "op9_warc": op9_warc,
    "op10_line_dedup": op10_line_dedup,
    "op11_pii": op11_pii,
    "op12_collocations": op12_collocations,
    "op13_hard_negatives": op13_hard_negatives,
}

_SEP = r"[\x20\x09-\x0D]+"
ORACLE: dict[str, str] = {}

ORACLE["op3_quality_rules"] = f"""
WITH t AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS s FROM documents),
w AS (
  SELECT *, list_filter(regexp_split_to_array(s, '{_SEP}'), lambda x: x <> '') AS ws,
         list_filter(string_split(s, chr(10)), lambda x: length(regexp_replace(x, '{_SEP}', '', 'g')) > 0) AS ls
  FROM t),
g AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
r AS (
  SELECT rid, count(DISTINCT p) AS n FROM (
    SELECT rid, unnest([i, i + 1, i + 2]) AS p
    FROM (SELECT *, count(*) OVER (PARTITION BY rid, gram) AS c FROM g) WHERE c >= 2)
  GROUP BY rid),
m AS (
  SELECT w.*, len(ws)::BIGINT AS n_words, length(regexp_replace(s, '{_SEP}', '', 'g'))::BIGINT AS word_chars,
         (length(s) - length(regexp_replace(s, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words, len(ls) AS n_lines
  FROM w LEFT JOIN r USING (rid)),
b AS (
  SELECT *, (n_words < {quality_rules.BASE_MIN_WORDS}
             OR 100 * n_repeat_words > {quality_rules.BASE_MAX_REPEAT_PERCENT} * n_words) AS base_failed,
         len(list_filter(ws, lambda x: lower(x) IN ({', '.join(f"'{x}'" for x in quality_rules.STOP_WORDS)}))) AS n_stop,
         len(list_filter(ws, lambda x: regexp_matches(x, '\\pL'))) AS n_letter,
         len(list_filter(ws, lambda x: regexp_matches(x, '^\\P{{Ll}}*\\p{{Lu}}\\P{{Ll}}*\\p{{Lu}}\\P{{Ll}}*$'))) AS n_upper,
         len(list_filter(ws, lambda x: suffix(x, '!!'))) AS n_exclaimed,
         len(list_filter(ls, lambda x: regexp_matches(x, '^\\s*[-*\\x{{2022}}]'))) AS n_bullet,
         len(list_filter(ls, lambda x: regexp_matches(x, '(\\.\\.\\.|\\x{{2026}})\\s*$'))) AS n_ellipsis
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars / n_words BETWEEN 2.0 AND 14.0 AND n_symbols / n_words <= 0.10
       AND n_stop / n_words >= 0.02 AND n_letter / n_words >= 0.60 AND n_upper / n_words <= 0.30
       AND n_exclaimed / n_words <= 0.30 AND n_dup_lines / n_lines <= 0.50
       AND n_bullet / n_lines <= 0.90 AND n_ellipsis / n_lines <= 0.30 AS kept
FROM b
"""

ORACLE["op9_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b, sha256(encode(coalesce(html, ''))) AS d FROM pages),
f AS (SELECT d, min(page_id) AS least FROM p WHERE octet_length(b) >= 100 GROUP BY d HAVING count(*) > 1)
SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, d AS payload_digest,
       CASE WHEN least IS NOT NULL AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> least THEN least END AS refers_to, true AS complete
FROM p LEFT JOIN f USING (d)
"""

ORACLE["op12_collocations"] = r"""
WITH p AS (
  SELECT lang, row_number() OVER () AS pid, ws FROM (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents))
  WHERE len(ws) > 0),
g AS (
  SELECT lang, ws[i:i + m - 1] AS g, count(*) AS f
  FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(ws) >= m)
  GROUP BY ALL),
t AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE len(g) = 1 GROUP BY lang),
c AS (SELECT * FROM g WHERE f >= 100),
s AS (
  SELECT lang, sub, max(f) AS longer FROM (
    SELECT lang, f, g[i:i + m - 1] AS sub
    FROM (SELECT lang, f, g, m, unnest(range(1, len(g) - m + 2)) AS i FROM c, (SELECT unnest([2, 3, 4]) AS m) WHERE len(g) > m))
  GROUP BY ALL),
k AS (
  SELECT c.lang, c.g, c.f, unnest(range(1, len(c.g))) AS k FROM c LEFT JOIN s ON s.lang = c.lang AND s.sub = c.g
  WHERE len(c.g) > 1 AND (longer IS NULL OR 100 * longer < 100 * c.f)),
x AS (
  SELECT k.lang, k.g, k.f AS a, k.k, l.f AS l, r.f AS r, t.n,
         (1000::HUGEINT * k.f * t.n // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM k JOIN t USING (lang) JOIN c l ON l.lang = k.lang AND l.g = k.g[1:k.k] JOIN c r ON r.lang = k.lang AND r.g = k.g[k.k + 1:]),
b AS (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, k) AS cut FROM x),
o AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM b WHERE cut = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM o)
WHERE rank <= 2000
"""

ORACLE["op13_hard_negatives"] = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM e a, e b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

ORACLE["op11_pii"] = r"""
WITH t AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS s FROM documents),
k(kind, ord, pat) AS (VALUES
  ('email', 1, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+'),
  ('ip', 2, '[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+'),
  ('card', 3, '[0-9](?:[\x20-]?[0-9])+'),
  ('phone', 4, '\+[0-9][\x20().0-9-]+[0-9]')),
m AS (SELECT rid, kind, ord, regexp_extract_all(s, pat) AS found, regexp_split_to_array(s, pat) AS pieces FROM t, k),
x AS (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM m WHERE len(found) > 0),
p AS (
  SELECT rid, kind, ord, found[i] AS value, pieces[i] AS before, pieces[i + 1] AS after,
         regexp_replace(found[i], '[^0-9]', '', 'g') AS digits,
         list_sum(list_transform(pieces[1:i], lambda z: length(z))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda z: length(z))), 0) AS start
  FROM x),
v AS (
  SELECT *, start + length(value) AS stop FROM p
  WHERE kind = 'email'
     OR kind = 'ip' AND len(list_filter(string_split(value, '.'), lambda z: length(ltrim(z, '0')) > 3 OR coalesce(try_cast(ltrim(z, '0') AS INTEGER), 0) > 255)) = 0
     OR kind = 'phone' AND length(digits) BETWEEN 9 AND 15
     OR kind = 'card' AND length(digits) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda j:
          CASE WHEN j % 2 = 1 THEN substr(reverse(digits), j, 1)::INTEGER
               ELSE 2 * substr(reverse(digits), j, 1)::INTEGER - CASE WHEN substr(reverse(digits), j, 1)::INTEGER > 4 THEN 9 ELSE 0 END END)) % 10 = 0),
e AS (
  SELECT rid, kind || ':' || CASE kind WHEN 'email' THEN lower(value) WHEN 'ip' THEN value ELSE digits END AS entity,
         CASE WHEN length(before) > 120 THEN regexp_replace(right(before, 120), '^[\p{L}\p{N}]+', '') ELSE before END || chr(10) ||
         CASE WHEN length(after) > 120 THEN regexp_replace(left(after, 120), '[\p{L}\p{N}]+$', '') ELSE after END AS context
  FROM v),
pairs AS (
  SELECT entity, term, count(DISTINCT context) AS contexts, count(DISTINCT rid) AS dct
  FROM (SELECT *, unnest(list_distinct(regexp_split_to_array(context, '[^\p{L}\p{N}]+'))) AS term FROM e) WHERE term <> '' GROUP BY ALL),
vals AS (
  SELECT entity, dc FROM (SELECT entity, count(DISTINCT rid) AS dc, count(DISTINCT context) AS places FROM e GROUP BY entity)
  JOIN (SELECT entity, sum(contexts * (contexts - 1)) AS recurring, sum(contexts) AS seen FROM pairs GROUP BY entity) USING (entity)
  WHERE recurring * 100 <= seen * (places - 1) * 50),
supported AS (SELECT * FROM pairs JOIN vals USING (entity) WHERE contexts >= 3),
held AS (
  SELECT term, count(*) AS dt FROM (SELECT rid, unnest(list_distinct(regexp_split_to_array(s, '[^\p{L}\p{N}]+'))) AS term FROM t)
  WHERE term IN (SELECT term FROM supported) GROUP BY term),
risky AS (
  SELECT DISTINCT term FROM supported JOIN held USING (term), (SELECT count(*) AS n FROM t)
  WHERE 100 * dct >= 50 * dt AND n * dct >= 8 * dc * dt),
w AS (
  SELECT rid, regexp_extract_all(s, '[\p{L}\p{N}]+') AS found, regexp_split_to_array(s, '[\p{L}\p{N}]+') AS pieces
  FROM t WHERE rid IN (
    SELECT rid FROM (SELECT rid, unnest(list_distinct(regexp_split_to_array(s, '[^\p{L}\p{N}]+'))) AS term FROM t) WHERE term IN (SELECT term FROM risky))),
y AS (
  SELECT rid, found[i] AS value,
         list_sum(list_transform(pieces[1:i], lambda z: length(z))) + coalesce(list_sum(list_transform(found[1:i - 1], lambda z: length(z))), 0) AS start
  FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i FROM w)),
terms AS (
  SELECT rid, 'term' AS kind, 5 AS ord, start, start + length(value) AS stop FROM y
  WHERE value IN (SELECT term FROM risky)
    AND NOT EXISTS (SELECT 1 FROM v WHERE v.rid = y.rid AND v.start < y.start + length(y.value) AND y.start < v.stop)),
spans AS (SELECT rid, kind, ord, start, stop FROM v UNION ALL SELECT * FROM terms),
o AS (
  SELECT rid, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY ord, start) AS spans,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY ord, start) FILTER (ord < 5) AS base,
         count(*) FILTER (ord = 1) AS n_email, count(*) FILTER (ord = 2) AS n_ip, count(*) FILTER (ord = 3) AS n_card, count(*) FILTER (ord = 4) AS n_phone
  FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip, coalesce(n_card, 0)::BIGINT AS n_card,
       coalesce(n_phone, 0)::BIGINT AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN o USING (rid)
"""
