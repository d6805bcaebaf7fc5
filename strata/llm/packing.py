"""Sequence packing: shallow length combinations chosen by non-negative least
squares against the histogram of piece lengths, residuals packed greedily.

A document's ids (with the closing id) are cut every ``window`` tokens; full
pieces fill a sequence alone. The last, shorter pieces go into length classes
of ``unit`` tokens (rounded up). Combinations of up to ``depth`` classes that
fill the window exactly are the columns of a least-squares problem whose right
side is the histogram of classes over all documents; the solution, at most one
number a class, is the mix of combinations. Pieces are then dealt at random
into blocks of about ``block_pieces``; each block takes its share of the mix,
rounded down to what it has, and packs the rest best-fit, longest first. So no
ranking over all pieces is needed and no task holds more than a block. Only
the histogram (``window / unit`` numbers) reaches the driver.

Defined results: a null or empty text is one piece holding the closing id
alone; a null id stays null; repeated rows are packed once each; an empty
table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import as_text, written
from strata.llm.token_ids import shared

CLOSING_ID = 1
SEED = 2048


def token_pieces(docs: DataFrame, tokenizer_path: str, window: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: id (as text), start, length, ids_crc32, doc_tokens and a random ``_deal``."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        ids = shared(tokenizer_path)
        closing = CLOSING_ID.to_bytes(4, "little")
        # by the task's number: a repeated task deals its rows as before, and copies are dealt apart
        rng = np.random.default_rng([SEED, TaskContext.get().partitionId()])
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["_id"], pdf["_text"]):
                packed = ids.packed(text) + closing
                n = len(packed) // 4
                for start in range(0, n, window):
                    piece = packed[4 * start : 4 * (start + window)]
                    rows.append((doc, start, len(piece) // 4, zlib.crc32(piece), n))
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            out["_deal"] = rng.integers(0, 1 << 31, len(out))
            yield out

    return docs.select(as_text(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInPandas(
        cut, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, _deal long"
    )


def combinations(classes: int, depth: int = 3) -> list[tuple[int, ...]]:
    """Non-decreasing tuples of 1..depth classes that add up to ``classes``."""
    found: list[tuple[int, ...]] = []

    def extend(head: tuple[int, ...], least: int, left: int) -> None:
        if left >= least:
            found.append((*head, left))
        if len(head) + 1 < depth:
            for x in range(least, left // 2 + 1):
                extend((*head, x), x, left - x)

    extend((), 1, classes)
    return found


def least_squares_mix(histogram: np.ndarray, columns: list[tuple[int, ...]], steps: int | None = None) -> np.ndarray:
    """Lawson-Hanson: x >= 0 with least ``|A x - histogram|``, A counting each column's classes."""
    m = len(histogram)
    a = np.zeros((m, len(columns)))
    for j, c in enumerate(columns):
        for x in c:
            a[x - 1, j] += 1
    b = histogram.astype(float)
    scale = b.sum() or 1.0
    b = b / scale
    x, active = np.zeros(len(columns)), np.zeros(len(columns), bool)
    for _ in range(steps or 3 * m):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        j = int(np.argmax(gradient))
        if gradient[j] <= 1e-9:
            break
        active[j] = True
        while True:
            on = np.flatnonzero(active)
            s = np.linalg.solve(a[:, on].T @ a[:, on] + 1e-10 * np.eye(len(on)), a[:, on].T @ b)
            if (s > 0).all():
                x[:] = 0
                x[on] = s
                break
            low = s <= 0
            share = np.min(x[on][low] / (x[on][low] - s[low]))
            x[on] += share * (s - x[on])
            active[on[x[on] <= 1e-12]] = False
            x[~active] = 0
    return x * scale


def pack_block(length: np.ndarray, window: int, unit: int, mix: list[tuple[tuple[int, ...], float]]) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) for each piece of one block. ``mix``: combinations
    and their count for each piece that is not full."""
    sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
    full = np.flatnonzero(length >= window)
    sequence[full] = np.arange(len(full))
    used = len(full)
    rest = np.flatnonzero(length < window)
    order = rest[np.argsort(length[rest], kind="stable")[::-1]]  # longest first
    classes = -(-length[order] // unit)
    waiting = {int(c): list(order[classes == c]) for c in np.unique(classes)}
    for combination, share in sorted(mix, key=lambda x: -x[1]):
        need = {c: combination.count(c) for c in combination}
        times = min([int(round(share * len(rest))), *(len(waiting.get(c, ())) // k for c, k in need.items())])
        for _ in range(times):
            at = 0
            for c in combination:
                i = waiting[c].pop()
                sequence[i], offset[i] = used, at
                at += length[i]
            used += 1
    # the rest: best fit, longest first; sequences by the room they have left
    room: list[list[tuple[int, int]]] = [[] for _ in range(window + 1)]
    left = np.array(sorted((i for w in waiting.values() for i in w), key=lambda i: (-length[i], i)), np.int64)
    has = np.zeros(window + 1, bool)
    for i in left:
        n = int(length[i])
        fits = int(np.argmax(has[n:])) + n
        if has[fits]:
            s, at = room[fits].pop()
            has[fits] = bool(room[fits])
        else:
            s, at, fits = used, 0, window
            used += 1
        sequence[i], offset[i] = s, at
        if fits > n:
            room[fits - n].append((s, at + n))
            has[fits - n] = True
    return sequence, offset


def pack(
    docs: DataFrame, tokenizer_path: str, window: int = 2048, unit: int = 8, depth: int = 3, block_pieces: int = 50_000,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces with their ``sequence_id`` and gapless ``offset`` in it."""
    pieces = written(token_pieces(docs, tokenizer_path, window, id_col, text_col), "pieces")
    classes = window // unit
    counts = pieces.groupBy(F.when(F.col("length") < window, F.ceil(F.col("length") / unit)).alias("c")).count().collect()
    histogram = np.zeros(classes)  # bounded: one number a class
    total = sum(r["count"] for r in counts)
    for r in counts:
        if r["c"] is not None:
            histogram[int(r["c"]) - 1] = r["count"]
    partial = histogram.sum()
    columns = combinations(classes, depth)
    solved = least_squares_mix(histogram, columns) if partial else np.zeros(len(columns))
    mix = [(columns[j], float(solved[j] / partial)) for j in np.flatnonzero(solved > 0)]
    blocks = max(1, -(-total // block_pieces))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        s, o = pack_block(pdf["length"].to_numpy(), window, unit, mix)
        block = int(pdf["_deal"].iloc[0]) % blocks
        return pd.DataFrame({
            "doc_id": pdf["doc_id"], "start": pdf["start"], "length": pdf["length"], "ids_crc32": pdf["ids_crc32"],
            "doc_tokens": pdf["doc_tokens"], "sequence_id": (block << 32) + s, "offset": o,
        })

    return pieces.groupBy((F.col("_deal") % blocks).alias("_block")).applyInPandas(
        place, "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    ).withColumn("doc_id", F.col("doc_id").cast("long"))
