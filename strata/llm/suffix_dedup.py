"""Removal of repeated byte strings by column-wise suffix ordering.

Every byte covered by a string of ``span`` bytes that also starts anywhere else
in the collection (the same document included) is removed.

The orders of suffixes come from the column-wise multi-document construction
(insert one symbol of every document a round, from the last to the first; the
new order is a stable sort of the old one by the inserted symbols, the new
common prefixes are one more than range minima of the old ones). Run over whole
documents it needs as many rounds as the longest document has bytes and keeps
the whole collection's arrays, several times the input, so it is run over the
places where a repeat can be, which are found without loss:

1. Anchors. Of the ``gram``-byte strings in a window of ``span`` bytes the one
   with the least hash (the rightmost of equals) is the window's anchor; it
   depends on the window's bytes alone, so equal windows have equal anchors at
   equal offsets. Windows with one anchor are consecutive and make a segment.
2. Classes. Segments are shuffled by their anchor's hash and read in order.
   Segments equal as a whole repeat as a whole. An anchor with one class of
   segments is done; of the others one segment a class goes on.
3. Columns. Those segments are cut from the texts and laid under one another by
   their anchors, at most ``2 * span - gram`` columns. The rounds above, with
   all anchors of a batch at once, give each window's common prefix with its
   neighbours; ``span`` or more is a repeat. Batches stream from files sorted
   by anchor, so memory is bounded by ``batch`` segments. An anchor with over
   ``most_segments`` classes is dealt out again by its single windows.
4. Spans are gathered by document and cut.

Equal segments of one batch are joined before the shuffle, so a group of copies
costs a row a batch there. Hash pairs of 128 bits stand for whole segments.

Defined results: a null text is empty; a text shorter than ``span`` keeps all
its bytes; rows with equal id and text repeat one another; a null id is kept;
an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import BASE, WordHasher, as_text, mix64, written

#: bytes of text worked on together; places in a block take this many bits
_BLOCK_BITS = 19


# ---- anchors


def gram_hashes(b: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes from each place (a power of two), by doubling."""
    h = mix64(np.arange(256, dtype=np.uint64) + np.uint64(1))[b]
    size = 1
    while size < gram:
        h = h[:-size] * np.uint64(BASE) + h[size:] * np.uint64(0xD1342543DE82EF95)
        h ^= h >> np.uint64(29)
        size *= 2
    return h * np.uint64(0xBF58476D1CE4E5B9)


def window_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` consecutive values from each place."""
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def segments(b: np.ndarray, span: int, gram: int, usable: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first window, last window, anchor, anchor hash) of the segments of a
    block; ``usable``: windows (by their first byte) that lie in one document."""
    h = gram_hashes(b, gram)
    mask = np.uint64((1 << (_BLOCK_BITS + 1)) - 1)
    place = np.arange(len(h), dtype=np.uint64)
    key = (h & ~mask) | (mask - place)  # equal hashes: the rightmost
    owner = (mask - (window_least(key, span - gram + 1) & mask)).astype(np.int64)
    at = np.flatnonzero(usable[: len(owner)])
    if not len(at):
        e = np.empty(0, np.int64)
        return e, e, e, np.empty(0, np.uint64)
    own = owner[at]
    cut = np.flatnonzero((own[1:] != own[:-1]) | (at[1:] != at[:-1] + 1))
    lo, hi = at[np.concatenate(([0], cut + 1))], at[np.concatenate((cut, [len(at) - 1]))]
    return lo, hi, owner[lo], h[owner[lo]]


def _blocks(texts: list[bytes], span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, document of each byte run, place in it of each run's start, as run
    table) of blocks; a longer text is cut into pieces that share span - 1 bytes."""
    most = 1 << _BLOCK_BITS
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for d, t in enumerate(texts):
        if len(t) < span:
            continue
        for at in range(0, len(t) - span + 1, most - span + 1):
            piece = t[at : at + most]
            if held and size + len(piece) > most:
                yield _laid(held)
                held, size = [], 0
            held.append((d, at, piece))
            size += len(piece)
    if held:
        yield _laid(held)


def _laid(held: list[tuple[int, int, bytes]]):
    starts = np.concatenate(([0], np.cumsum([len(p) for _, _, p in held])))
    return np.frombuffer(b"".join(p for _, _, p in held), np.uint8), starts, np.array([(d, at) for d, at, _ in held], np.int64)


def anchored(docs: DataFrame, span: int, gram: int) -> DataFrame:
    """(h, s, ol, _key, nb, lo, many) of the segments of ``docs`` (_key, _text). Segments equal
    within a batch: all but one get a key of their own and ``many``, as has the one."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for pdf in batches:
            texts = [(t or "").encode() for t in pdf["_text"]]
            keys = pdf["_key"].to_numpy()
            lengths = np.array([len(t) for t in texts], np.int64)
            got: list[tuple[np.ndarray, ...]] = []
            for b, starts, run in _blocks(texts, span):
                usable = np.ones(len(b), bool)
                for z in starts[1:]:
                    usable[max(0, z - span + 1) : z] = False
                lo, hi, p, h = segments(b, span, gram, usable)
                s = hasher.spans(b, lo, hi + span)
                r = np.searchsorted(starts, lo, side="right") - 1
                got.append((h, s, ((p - lo) << 16) | (hi - lo), run[r, 0], run[r, 1] + lo - starts[r]))
            if not got:
                continue
            h, s, ol, d, lo = (np.concatenate(x) for x in zip(*got))
            key = keys[d].astype(np.uint64)
            order = np.lexsort((lo, key, ol, s, h))
            same = np.ones(max(0, len(order) - 1), bool)
            for x in (h, s, ol):  # the pair of hashes and the place of the anchor
                same &= x[order][1:] == x[order][:-1]
            many, later = np.zeros(len(h), bool), np.zeros(len(h), bool)
            many[order[1:]] |= same
            many[order[:-1]] |= same
            later[order[1:]] = same
            # a key of their own that a repeated task finds again, as it decides where they are shuffled to
            h[later] = mix64(key[later] ^ mix64(lo[later].astype(np.uint64) + np.uint64(1)))
            yield pd.DataFrame({
                "h": h.astype(np.int64), "s": s.astype(np.int64), "ol": ol.astype(np.int32), "_key": keys[d],
                "nb": lengths[d].astype(np.int32), "lo": lo.astype(np.int32), "many": many,
            })

    return docs.select("_key", "_text").mapInPandas(cut, "h long, s long, ol int, _key long, nb int, lo int, many boolean")


# ---- classes


def classed(rows: DataFrame) -> DataFrame:
    """Rows (h, ol, _key, nb, lo, open): segments that repeat as a whole (``open``
    false), and one segment a class of anchors with several classes (``open``)."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = None  # (h, s, ol) of the row before
        held = None  # the last row, whose next is not known yet
        first = None  # the first row of the anchor at hand, until it is given out as open

        def work(pdf: pd.DataFrame, final: bool) -> pd.DataFrame:
            nonlocal before, first
            h, s, ol = (pdf[c].to_numpy() for c in ("h", "s", "ol"))
            n = len(h)
            known = n if final else n - 1
            fresh, equal = np.ones(n, bool), np.zeros(n, bool)
            fresh[1:] = h[1:] != h[:-1]
            equal[1:] = ~fresh[1:] & (s[1:] == s[:-1]) & (ol[1:] == ol[:-1])
            if before is not None:
                fresh[0] = h[0] != before[0]
                equal[0] = (h[0], s[0], ol[0]) == before
            repeated = pdf["many"].to_numpy() | equal
            repeated[:-1] |= equal[1:]
            opens = ~equal & ~fresh
            run = np.maximum.accumulate(np.where(fresh, np.arange(n), -1))
            opens[known:] = False
            starts = np.unique(run[opens])
            given = opens.copy()
            given[starts[starts >= 0]] = True
            out = [pdf[:known][repeated[:known]].assign(open=False), pdf[given].assign(open=True)]
            if len(starts) and starts[0] < 0 and first is not None:
                out.append(first.assign(open=True))
                first = None
            if known:
                r = run[known - 1]
                if r >= 0:
                    first = None if given[r] else pdf.iloc[r : r + 1]
                before = (h[known - 1], s[known - 1], ol[known - 1])
            return pd.concat(out, ignore_index=True)[["h", "ol", "_key", "nb", "lo", "open"]]

        for pdf in batches:
            if not len(pdf):
                continue
            if held is not None:
                pdf = pd.concat([held, pdf], ignore_index=True)
            yield work(pdf, False)
            held = pdf.iloc[-1:].reset_index(drop=True)
        if held is not None:
            yield work(held, True)

    return rows.repartition(parts, "h").sortWithinPartitions("h", "s", "ol").mapInPandas(
        stream, "h long, ol int, _key long, nb int, lo int, open boolean"
    )


# ---- columns


def repeated_windows(bodies: list[bytes], offsets: np.ndarray, groups: np.ndarray, span: int, gram: int) -> np.ndarray:
    """For each body (a segment's bytes) and each of its ``span - gram + 1``
    possible windows, by offset before the anchor from the largest to 0:
    whether another body of its group has the same window at the same offset.

    Column-wise construction: ``order`` holds the bodies by the suffixes from
    the column at hand, ``common`` the prefix each shares with the one before.
    """
    m, reach = len(bodies), span - gram
    columns = reach + span
    cells = np.full((columns, m), -1, np.int16)
    for i, (body, off) in enumerate(zip(bodies, offsets)):
        cells[reach - off : reach - off + len(body), i] = np.frombuffer(body, np.uint8)
    groups = np.unique(groups, return_inverse=True)[1]
    order = np.argsort(groups, kind="stable")
    group = groups[order]
    neighbour = np.concatenate(([False], group[1:] == group[:-1]))
    common = np.zeros(m, np.int32)
    found = np.zeros((m, reach + 1), bool)
    narrow = group.astype(np.int16) if m and group[-1] < 32767 else group  # 16 bits sort by radix
    for c in range(columns - 1, -1, -1):
        symbol = cells[c][order]
        if (neighbour[1:] & (symbol[1:] != symbol[:-1])).any():
            place = np.argsort(symbol, kind="stable")
            place = place[np.argsort(narrow[place], kind="stable")]
            shared = _range_least(common, place)
            order, symbol = order[place], symbol[place]
        else:
            shared = common
        common = np.zeros(m, np.int32)
        met = neighbour.copy()
        met[1:] &= (symbol[1:] == symbol[:-1]) & (symbol[1:] >= 0)
        common[met] = shared[met] + 1
        if c <= reach:
            long = common >= span
            long[:-1] |= long[1:]
            found[order[long], c] = True
    return found


def _range_least(common: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each entry of the new order, the least old common prefix between the
    old places of the entry before it and its own (0 where they are not in order)."""
    a, z = place[:-1] + 1, place[1:]  # common[a..z]
    out = np.zeros(len(place), np.int32)
    ok = z >= a
    width = np.where(ok, z - a + 1, 1)
    level = np.frexp(width.astype(np.float64))[1] - 1
    table, size = common, 1
    for k in range(int(level.max(initial=0)) + 1):
        pick = ok & (level == k)
        if pick.any():
            out[1:][pick] = np.minimum(table[a[pick]], table[z[pick] - size + 1])
        if 2 * size > len(common):
            break
        table = np.minimum(table[:-size], table[size:])
        size *= 2
    return out


def column_spans(cut: DataFrame, span: int, gram: int, batch: int) -> DataFrame:
    """(_key, nb, a, z): repeated stretches found in the segments ``cut`` (h, ol, _key, nb, lo, body)."""
    parts = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def work(pdf: pd.DataFrame) -> pd.DataFrame:
            off = (pdf["ol"].to_numpy() >> 16).astype(np.int64)
            found = repeated_windows([bytes(x) for x in pdf["body"]], off, pdf["h"].to_numpy(), span, gram)
            reach = span - gram
            edge = np.diff(np.pad(found, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            i, a = np.nonzero(edge == 1)
            _, z = np.nonzero(edge == -1)
            base = pdf["lo"].to_numpy()[i].astype(np.int64) - (reach - off[i])
            return pd.DataFrame({"_key": pdf["_key"].to_numpy()[i], "nb": pdf["nb"].to_numpy()[i], "a": base + a, "z": base + z - 1 + span})

        for pdf in batches:
            if not len(pdf):
                continue
            held.append(pdf)
            if sum(map(len, held)) >= batch:
                pdf = pd.concat(held, ignore_index=True)
                last = pdf["h"].iloc[-1]  # its segments may go on
                ends = int(np.searchsorted(pdf["h"].to_numpy(), last))
                if ends:
                    yield work(pdf[:ends])
                held = [pdf[ends:]]
        if held:
            yield work(pd.concat(held, ignore_index=True))

    return cut.repartition(parts, "h").sortWithinPartitions("h").mapInPandas(stream, "_key long, nb int, a long, z long")


# ---- the operator


def _own_segments(base: DataFrame, rows: DataFrame, span: int, gram: int, single: bool) -> DataFrame:
    """The bytes of the segments ``rows``; with ``single``, the hashes of their windows as segments of their own."""
    listed = rows.groupBy("_key", "nb").agg(F.collect_list(F.struct("h", "ol", "lo")).alias("own"))
    joined = base.withColumn("nb", F.octet_length("_text")).join(listed, ["_key", "nb"]).select("_key", "nb", "_text", "own")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for key, nb, text, own in zip(pdf["_key"], pdf["nb"], pdf["_text"], pdf["own"]):
                data = text.encode()
                for x in own:
                    n = (x["ol"] & 0xFFFF) + span
                    body = data[x["lo"] : x["lo"] + n]
                    if not single:
                        out.append((x["h"], x["ol"], key, nb, x["lo"], body))
                        continue
                    for i in range(n - span + 1):
                        wide = hashlib.blake2b(body[i : i + span], digest_size=16).digest()
                        h, s = (int.from_bytes(w, "little", signed=True) for w in (wide[:8], wide[8:]))
                        out.append((h, s, ((x["ol"] >> 16) - i) << 16, key, nb, x["lo"] + i, False))
            names = ["h", "s", "ol", "_key", "nb", "lo", "many"] if single else ["h", "ol", "_key", "nb", "lo", "body"]
            yield pd.DataFrame(out, columns=names)

    return joined.mapInPandas(
        cut,
        "h long, s long, ol int, _key long, nb int, lo int, many boolean" if single else "h long, ol int, _key long, nb int, lo int, body binary",
    )


def repeated_spans(
    docs: DataFrame, span: int = 200, gram: int = 64, batch: int = 16_384, most_segments: int = 50_000,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(_key, nb, a, z): stretches of bytes covered by repeated strings; ``_key`` is
    xxhash64(id, text), ``nb`` the text's bytes. Stretches may overlap."""
    base = docs.select(F.xxhash64(id_col, text_col).alias("_key"), F.col(text_col).alias("_text")).where(F.col(text_col).isNotNull())
    rows = written(classed(anchored(base, span, gram)), "segments")
    whole = rows.where("NOT open")
    several = rows.where("open")
    hot = several.groupBy("h").count().where(F.col("count") > most_segments).select("h")
    some_hot = not hot.isEmpty()
    plain = several.join(hot, "h", "left_anti") if some_hot else several
    columns = column_spans(_own_segments(base, plain, span, gram, False), span, gram, batch)
    spans = [whole.select("_key", "nb", F.col("lo").cast("long").alias("a"), (F.col("lo") + F.expr("ol & 65535") + span).cast("long").alias("z")), columns]
    if some_hot:
        single = classed(_own_segments(base, several.join(hot, "h", "left_semi"), span, gram, True)).where("NOT open")
        spans.append(single.select("_key", "nb", F.col("lo").cast("long").alias("a"), (F.col("lo") + span).cast("long").alias("z")))
    out = spans[0]
    for x in spans[1:]:
        out = out.unionByName(x)
    return out


def remove_repeats(docs: DataFrame, span: int = 200, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept) of each row; ``kept``: the bytes left, concatenated."""
    spans = repeated_spans(docs, span, id_col=id_col, text_col=text_col, **settings)
    listed = (
        spans.groupBy("_key", "nb").agg(F.collect_set(F.struct("a", "z")).alias("cut")).withColumnsRenamed({"_key": "cut_key", "nb": "cut_nb"})
    )
    base = docs.select(
        as_text(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), F.xxhash64(id_col, text_col).alias("_key")
    )
    joined = base.join(listed, (base["_key"] == listed["cut_key"]) & (F.octet_length("_text") == listed["cut_nb"]), "left").select("doc_id", "_text", "cut")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for text, spans in zip(pdf["_text"], pdf["cut"]):
                data, kept, at, n, removed = text.encode(), [], 0, 0, 0
                end = -1  # of the removed run at hand
                for a, z in sorted((x["a"], x["z"]) for x in (spans if spans is not None else ())):
                    if a > end:
                        n += 1
                        kept.append(data[at:a])
                        removed += z - a
                    elif z > end:
                        removed += z - end
                    end = max(end, z)
                    at = end
                kept.append(data[at:])
                out.append((len(data), removed, n, b"".join(kept)))
            yield pd.concat([pdf[["doc_id"]].reset_index(drop=True), pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept"])], axis=1)

    found = joined.mapInPandas(cut, "doc_id string, n_bytes long, n_removed long, n_spans long, kept binary")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))
