"""Corpus pipeline: documents in, packed token sequences out.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before
kept; ``run`` writes every result as Parquet in the shared folder and reads it
back, so a lost executor costs at most a stage. All stages but the last return
the columns of ``documents``.

Null ids, null and empty texts and repeated rows go through with the results
the operators define; a text that is null or empty is neither toxic, nor a
duplicate, nor contaminated, and is packed as its closing id alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontamination, line_dedup, ngram_join, packing, toxicity
from strata.llm.common import carried, owned, restored, shared_path, table
from strata.llm.queries import held_out_third, tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    lexicon = toxicity.fit(docs, table(spark, sf_dir, "labels").where(~held_out_third()))
    scored = toxicity.score(carried(docs, text=F.col("text")), lexicon).where("NOT _toxic")
    return scored.select(*restored(scored, docs.columns))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without line chunks and passages that stand elsewhere; documents made of nothing else go."""
    own = carried(docs, doc_id=F.col("doc_id"), text=F.col("text"))
    left = line_dedup.dedup_lines(own, least_words=50).where("_removed_lines = 0 OR _removed_lines < _lines")
    cleaned = left.select(*restored(left, docs.columns, text=F.col("text")))
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return ngram_join.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontamination.contaminated(docs, table(spark, sf_dir, "benchmark"), verbatim=True).select("_id", "_fp").distinct()
    own = carried(docs, _own_id=F.col("doc_id").cast("long"), _own_fp=F.xxhash64("text"))
    same = F.col("_own_id").eqNullSafe(F.col("_id")) & (F.col("_own_fp") == F.col("_fp"))
    return own.join(found, same, "left_anti").select(*restored(own, docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents placed in sequences of at most 2048 tokens."""
    return packing.pack(docs, tokenizer_file(), window=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL cannot express the stages; tests/llm/test_packing_and_archives.py holds them against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, f"pipeline-{name}")
        with owned(spark):  # a stage's own tables go once its result is written
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
