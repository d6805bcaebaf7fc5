"""Line dedup on content-defined chunks of lines and on repeated passages.

A rolling hash over the hashes of the last ``window`` lines ends a chunk where
it is divisible by ``lines_per_chunk``, so an inserted or removed line moves
only the boundaries next to it. A chunk of at least ``least_lines`` lines that
occurs more than once in the corpus is kept at its first place (smallest id,
then place) and removed elsewhere.

With ``least_words``, every run of whole lines of at least so many words that
also stands at an earlier place is removed as a whole, wherever its chunk
boundaries fall: a window is cut from each line that is not blank to the first
line that completes the words, and one back from each such line. The windows
inside a repeated run start at its first line, end at its last one and leave no
gap, and each depends on nothing but its own lines. A line is in at most twice
``least_words`` windows. Where windows overlap, a line stays only if none of
its windows stands earlier; each line stays at some place.

Chunks are counted by two hashes, and the repeated ones compared by their bytes,
so equal hashes never stand for equal bytes unseen: a hash pair shared by
different bytes is left alone. Counting and choosing the first place are
aggregations with partial sums, the way back is a join; no chunk's occurrences
are gathered in one place.

Defined results: a null text stays null and has no lines; an empty text is one
empty line and stays; rows with equal id and text count as one place, so both
keep what either keeps; a null id orders before all others; an empty table
gives an empty one; every other column is returned as it was.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import as_text, carried, restored, written

_M = (1 << 64) - 1
#: what a Python worker gives out at once
_MOST_ROWS, _MOST_BYTES = 10_000, 4 << 20


def chunk_bounds(line_hashes: list[int], window: int, lines_per_chunk: int) -> list[tuple[int, int]]:
    """(first line, end) of each chunk of a text with these line hashes."""
    bounds, first = [], 0
    for i in range(len(line_hashes)):
        rolled = 0
        for h in line_hashes[max(0, i - window + 1) : i + 1]:
            rolled = (rolled * 0x9E3779B97F4A7C15 + h) & _M
        rolled = ((rolled ^ (rolled >> 29)) * 0xBF58476D1CE4E5B9) & _M
        if (rolled >> 32) % lines_per_chunk == 0:
            bounds.append((first, i + 1))
            first = i + 1
    if first < len(line_hashes):
        bounds.append((first, len(line_hashes)))
    return bounds


def passage_bounds(words: list[int], least_words: int) -> set[tuple[int, int]]:
    """(first line, end) of the least windows of ``least_words`` words that start or
    end at a line which is not blank, given the words of each line; two lines that
    have the words by themselves are also one window with the blank lines between."""
    full = [i for i, n in enumerate(words) if n]
    bounds, held, lo, begun = set(), 0, 0, 0
    for i in full:
        held += words[i]
        if held < least_words:
            continue
        while held - words[full[lo]] >= least_words:
            held -= words[full[lo]]
            lo += 1
        bounds.update((a, i + 1) for a in full[begun : lo + 1])  # line i is the first to complete these
        bounds.add((full[lo], i + 1))
        begun = lo + 1
    bounds.update((a, z + 1) for a, z in zip(full, full[1:]) if z > a + 1 and min(words[a], words[z]) >= least_words)
    return bounds


def _chunks(docs: DataFrame, window: int, lines_per_chunk: int, least_lines: int, least_words: int | None) -> DataFrame:
    """(_id, _fp, at, lines, h, g) of every chunk that may be removed."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh3_64_intdigest, xxh3_128_digest, xxh3_128_intdigest

        def signed(x: int) -> int:
            return x - (1 << 64) if x >> 63 else x

        for pdf in batches:
            out: list[tuple] = []
            for doc, fp, text in zip(pdf["_id"], pdf["_fp"], pdf["_text"]):
                if text is None:
                    continue
                lines = text.encode().split(b"\n")
                bounds = {b for b in chunk_bounds([xxh3_64_intdigest(x) for x in lines], window, lines_per_chunk) if b[1] - b[0] >= least_lines}
                if least_words is not None:
                    bounds |= passage_bounds([len(x.split()) for x in lines], least_words)
                digests = b"".join(map(xxh3_128_digest, lines))
                for a, z in sorted(bounds):
                    wide = xxh3_128_intdigest(digests[16 * a : 16 * z])
                    out.append((doc, fp, a, z - a, signed(wide >> 64), signed(wide & _M)))
                if len(out) >= _MOST_ROWS:
                    yield pd.DataFrame(out, columns=["_id", "_fp", "at", "lines", "h", "g"])
                    out = []
            yield pd.DataFrame(out, columns=["_id", "_fp", "at", "lines", "h", "g"])

    found = docs.select(as_text("_id").alias("_id"), "_fp", "_text").mapInPandas(cut, "_id string, _fp long, at int, lines int, h long, g long")
    return found.withColumn("_id", F.col("_id").cast("long"))


def _bodies(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(h, g, body) of the chunks in ``marks``; texts are shuffled deflated."""

    def deflated(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import zlib

        for texts in batches:
            yield pd.Series([None if t is None else zlib.compress(t.encode(), 1) for t in texts], dtype=object)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        for pdf in batches:
            out, held = [], 0
            for small, cuts in zip(pdf["_small"], pdf["_cut"]):
                lines = zlib.decompress(small).split(b"\n")
                for c in cuts:
                    out.append((c["h"], c["g"], b"\n".join(lines[c["at"] : c["at"] + c["lines"]])))
                    held += len(out[-1][2])
                    if held >= _MOST_BYTES:
                        yield pd.DataFrame(out, columns=["h", "g", "body"])
                        out, held = [], 0
            yield pd.DataFrame(out, columns=["h", "g", "body"])

    same = F.col("_id").eqNullSafe(F.col("_cut_id")) & (F.col("_fp") == F.col("_cut_fp"))
    small = docs.select("_id", "_fp", F.pandas_udf(deflated, "binary")("_text").alias("_small"))
    return small.join(marks, same).select("_small", "_cut").mapInPandas(cut, "h long, g long, body binary")


def _gathered(places: DataFrame, *columns: str) -> DataFrame:
    """(_cut_id, _cut_fp, _cut): the places of each text."""
    return (
        places.groupBy("_id", "_fp").agg(F.collect_set(F.struct(*columns)).alias("_cut"))
        .withColumnsRenamed({"_id": "_cut_id", "_fp": "_cut_fp"})
    )


def _merged(cuts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Overlapping places of each text made one; those that only touch stay two."""
    for batch in cuts:
        out = []
        for cut in batch:
            spans: list[dict] = []
            for c in sorted(cut, key=lambda c: c["at"]):
                if spans and c["at"] < spans[-1]["at"] + spans[-1]["lines"]:
                    spans[-1]["lines"] = max(spans[-1]["lines"], c["at"] + c["lines"] - spans[-1]["at"])
                else:
                    spans.append({"at": int(c["at"]), "lines": int(c["lines"])})
            out.append(spans)
        yield pd.Series(out, dtype=object)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 2, lines_per_chunk: int = 4, least_lines: int = 2,
    least_words: int | None = None,
) -> DataFrame:
    """``docs`` with ``text_col`` cleaned, plus ``_lines``, ``_removed_lines`` and
    ``_removed_chunks``; columns of these names are replaced. Without
    ``least_words`` only repeated chunks go."""
    columns = [c for c in docs.columns if c not in ("_lines", "_removed_lines", "_removed_chunks")]
    base = docs.select(
        F.col(id_col).cast("long").alias("_id"), F.xxhash64(F.col(text_col)).alias("_fp"), F.col(text_col).alias("_text")
    )
    places = written(_chunks(base, window, lines_per_chunk, least_lines, least_words), "line-chunks")
    first = (  # partial minima before the shuffle: a chunk in every document costs a row a task
        places.groupBy("h", "g").agg(F.min(F.struct("_id", "_fp", "at")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1").drop("n")
    )
    repeated = written(
        places.join(first, ["h", "g"])
        .select("_id", "_fp", "at", "lines", "h", "g", F.struct("_id", "_fp", "at").eqNullSafe(F.col("first")).alias("stays")),
        "line-repeats",
    )
    # byte comparison: hashes that stand for different strings of bytes are left alone
    differing = (
        _bodies(base, _gathered(repeated, "at", "lines", "h", "g")).groupBy("h", "g", "body").agg(F.lit(1).alias("one"))
        .groupBy("h", "g").agg(F.count(F.lit(1)).alias("bodies")).where("bodies > 1")
    )
    cuts = _gathered(repeated.join(differing, ["h", "g"], "left_anti").where("NOT stays"), "at", "lines")
    marks = cuts.withColumn("_cut", F.pandas_udf(_merged, "array<struct<at:int,lines:int>>")("_cut"))

    def without(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, cuts in batches:
            out = []
            for text, cut in zip(texts, cuts):
                if text is not None and cut is not None:
                    lines = text.split("\n")
                    for c in sorted(cut, key=lambda c: -c["at"]):
                        del lines[c["at"] : c["at"] + c["lines"]]
                    text = "\n".join(lines)
                out.append(text)
            yield pd.Series(out, dtype=object)

    cleaned = F.pandas_udf(without, "string")
    text = F.col("_text")
    own = carried(docs, _id=F.col(f"`{id_col}`").cast("long"), _fp=F.xxhash64(f"`{text_col}`"), _text=F.col(f"`{text_col}`"))
    joined = own.join(marks, F.col("_id").eqNullSafe(F.col("_cut_id")) & (F.col("_fp") == F.col("_cut_fp")), "left")
    return joined.select(
        *restored(own, columns, **{text_col: F.when(F.col("_cut").isNull(), text).otherwise(cleaned(text, F.col("_cut")))}),
        F.when(text.isNull(), 0).otherwise(F.size(F.split(text, "\n"))).cast("long").alias("_lines"),
        F.coalesce(F.expr("aggregate(_cut, 0, (s, c) -> s + c.lines)"), F.lit(0)).cast("long").alias("_removed_lines"),
        F.when(F.col("_cut").isNull(), 0).otherwise(F.size("_cut")).cast("long").alias("_removed_chunks"),
    )
