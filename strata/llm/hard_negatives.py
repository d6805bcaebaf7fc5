"""Hard-negative mining by the threshold algorithm.

Vectors become integers, so scores are exact inner products. All rows are dealt by
a hash into blocks of bounded size; a block keeps, for each dimension, the list of
its rows sorted by that component. An anchor walks the lists of the dimensions in
which it is not zero: from the top where its component is positive, from the bottom
where it is negative, so that contributions fall along every list. Each row met is
scored at once by random access to its whole vector. The sum of the contributions at
the depth reached bounds every row not met yet; the walk ends when this threshold
is strictly below the k-th score of each window, or below the window's lower bound.
Blocks of anchors meet all blocks of rows in a join on the row block's number, and
the block's best are merged by anchor and window. Nothing depends on how labels
are spread, and no task holds more than one block of each kind.

First the best rows of an anchor's own label are found (its positives), then, for
each of these, the best rows of other labels with scores between two shares of the
positive's score.

Defined results: rows without a label or a vector, or with a null or non-finite
component, take no part. Rows equal in id, label and integer vector count once; a
row of the same id but other content is another row. A row without an id takes part
after all others of its score and is never an anchor. Components that a vector lacks
count as 0. A score or component that does not fit 64 bits is an error. A positive of a negative
score has no window; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import written

#: rows and anchors a block; fewer rows where vectors are so long that a block had more components than these
ROWS_A_BLOCK, ANCHORS_A_BLOCK, COMPONENTS_A_BLOCK = 8192, 256, 1 << 19
_LAST = (1 << 63) - 1  # orders rows without an id


def taking_part(rows: DataFrame, scale: int, vec_id: str, vector: str, label: Column, anchor: Column) -> DataFrame:
    """(id, named, label, q, anchor): distinct rows with integer vectors."""
    whole = F.forall(F.col(f"`{vector}`"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = lambda x: F.floor(F.lit(scale) * x.cast("double"))
    fits = lambda x: F.abs(F.lit(scale) * x.cast("double")) < 2.0**62
    q = F.transform(f"`{vector}`", lambda x: F.when(fits(x), scaled(x)).otherwise(F.raise_error(F.lit("component beyond 64 bits")).cast("long")))
    d = rows.where(label.isNotNull() & F.col(f"`{vector}`").isNotNull() & whole).select(
        F.coalesce(F.col(f"`{vec_id}`").cast("long"), F.lit(_LAST)).alias("id"), F.col(f"`{vec_id}`").isNotNull().alias("named"),
        label.cast("long").alias("label"), q.alias("q"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
    )
    return d.dropDuplicates()


# ---------------------------------------------------------------- blocks
def _matrix(vectors, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _packer(listed: bool):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(pdf["q"].tolist(), max((len(v) for v in pdf["q"]), default=0))
        kind = next(t for t in ("int16", "int32", "int64") if not x.size or np.abs(x).max() <= np.iinfo(t).max)
        row = {
            "block": [int(pdf["block"].iloc[0])], "n": [len(pdf)], "kind": [kind], "ids": [pdf["id"].to_numpy(np.int64).tobytes()],
            "named": [pdf["named"].to_numpy(bool).tobytes()], "labels": [pdf["label"].to_numpy(np.int64).tobytes()],
            "vectors": [x.astype(kind).tobytes()],
            "lists": [np.argsort(x.T, axis=1, kind="stable").astype(np.int32).tobytes() if listed else b""],
        }
        return pd.DataFrame(row)

    return run


_BLOCK = "block long, n long, kind string, ids binary, named binary, labels binary, vectors binary, lists binary"


def blocks(rows: DataFrame, size: int, name: str, listed: bool) -> tuple[DataFrame, int]:
    """``rows`` dealt by hash into blocks of about ``size`` rows, one packed row each, and how many there are."""
    n = max(1, -(-rows.count() // size))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "named", "label", "q"), F.lit(n)))
    return written(dealt.groupBy("block").applyInPandas(_packer(listed), _BLOCK), name), n


class Block:
    """A block's rows, and its rows by each component in ascending order."""

    def __init__(self, n: int, kind: str, ids: bytes, named: bytes, labels: bytes, vectors: bytes, lists: bytes = b"") -> None:
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.named = np.frombuffer(named, bool)
        self.x = np.frombuffer(vectors, kind).reshape(n, -1).astype(np.int64)
        self.lists = np.frombuffer(lists, np.int32).reshape(-1, n) if lists else None
        self.most = int(np.abs(self.x).max()) if self.x.size else 0
        self._as_float: np.ndarray | None = None

    def scores(self, at: np.ndarray, a: np.ndarray) -> np.ndarray:
        """Exact inner products of the rows ``at`` with ``a``."""
        d = min(len(a), self.x.shape[1])
        bound = d * self.most * (max(map(abs, a.tolist())) if len(a) else 0)
        if bound < 1 << 53:  # sums of doubles are exact
            if self._as_float is None:
                self._as_float = self.x.astype(np.float64)
            return (self._as_float[at, :d] @ a[:d].astype(np.float64)).astype(np.int64)
        if bound < 1 << 63:
            return self.x[at, :d] @ a[:d]
        exact = [sum(p * q for p, q in zip(row, a[:d].tolist(), strict=True)) for row in self.x[at, :d].tolist()]
        if any(abs(s) > _LAST for s in exact):
            raise OverflowError("a score does not fit 64 bits")
        return np.array(exact, np.int64)


def best_rows(block: Block, a: np.ndarray, wanted: np.ndarray, windows: list[tuple[int | None, int | None]], k: int, step: int = 64) -> list:
    """For each window (least, most score; None: open) the places of its first ``k`` rows of ``wanted``
    (a mask) with their scores, by score descending and id ascending."""
    n = len(block.ids)
    dims = np.flatnonzero(a[: block.x.shape[1]])
    # contributions fall along each list
    lists = np.stack([block.lists[d] if a[d] < 0 else block.lists[d][::-1] for d in dims]) if len(dims) else np.empty((0, n), np.int32)
    weight = a[dims].astype(object)
    met, depth = np.zeros(n, bool), 0
    held = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
    while depth < n:
        end = min(n, depth + step)
        if len(dims) == 0 or np.count_nonzero(met) > 0.8 * n:  # few are left: they are read without their lists
            end = n
        if end == n:
            new = np.flatnonzero(~met)
        else:
            fresh = np.zeros(n, bool)
            fresh[lists[:, depth:end].ravel()] = True
            new = np.flatnonzero(fresh & ~met)
        met[new] = True
        depth, step = end, 2 * step
        new = new[wanted[new]]
        got = block.scores(new, a)
        for w, (least, most) in enumerate(windows):
            fits = np.ones(len(got), bool)
            if least is not None:
                fits &= got >= least
            if most is not None:
                fits &= got <= most
            at, s = np.concatenate((held[w][0], new[fits])), np.concatenate((held[w][1], got[fits]))
            order = np.lexsort((~block.named[at], block.ids[at], -s))[:k]
            held[w] = (at[order], s[order])
        if depth < n:
            threshold = sum(weight * block.x[lists[:, depth - 1], dims].astype(object))
            if all(
                (least is not None and threshold < least) or (len(s) >= k and threshold < int(s[-1]))
                for (least, _), (_, s) in zip(windows, held, strict=True)
            ):
                break
    return held


# ---------------------------------------------------------------- meetings of anchors and rows
def _meetings(anchor_blocks: DataFrame, row_blocks: DataFrame, n_blocks: int) -> DataFrame:
    """Each block of anchors (columns ``a_*``) beside each block of rows: the anchors, which are few, are repeated."""
    given = anchor_blocks.select(*[F.col(c).alias(f"a_{c}") for c in anchor_blocks.columns if c != "lists"])
    given = given.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<long>")))
    return row_blocks.join(given, "block")


def _walk(pdf: pd.DataFrame, kept: dict) -> Iterator[tuple]:
    for row in pdf.to_dict("records"):
        if kept.get("block") != row["block"]:
            kept.clear()
            kept.update(block=row["block"], rows=Block(*[row[c] for c in ("n", "kind", "ids", "named", "labels", "vectors", "lists")]))
        anchors = Block(*[row[f"a_{c}"] for c in ("n", "kind", "ids", "named", "labels", "vectors")])
        yield row, kept["rows"], anchors


_FOUND = "a_block long, anchor int, anchor_id long, place int, score long, id long, named boolean"


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["a_block", "anchor", "anchor_id", "place", "score", "id", "named"])


def _positives(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict = {}
        for pdf in batches:
            for row, rows, anchors in _walk(pdf, kept):
                out = []
                for i, a in enumerate(anchors.x):
                    wanted = rows.labels == anchors.labels[i]
                    d = min(len(a), rows.x.shape[1])
                    for j in np.flatnonzero(wanted & rows.named & (rows.ids == anchors.ids[i])):
                        if np.array_equal(rows.x[j, :d], a[:d]) and not rows.x[j, d:].any() and not a[d:].any():
                            wanted[j] = False  # the anchor itself
                    at, s = best_rows(rows, a, wanted, [(None, None)], k)[0]
                    out += [(row["a_block"], i, int(anchors.ids[i]), 0, int(y), int(rows.ids[x]), bool(rows.named[x])) for x, y in zip(at, s, strict=True)]
                yield _frame(out)

    return run


def _negatives(k: int, least: int, most: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict = {}
        for pdf in batches:
            for row, rows, anchors in _walk(pdf, kept):
                out, of = [], {}
                for i, place, score in zip(row["w_anchor"], row["w_place"], row["w_score"], strict=True):
                    p = int(score)
                    low, high = -((-least * p) // 100), (most * p) // 100
                    if low <= high:
                        of.setdefault(int(i), []).append((int(place), (low, high)))
                for i, found in of.items():
                    wanted = rows.labels != anchors.labels[i]
                    for (place, _), (at, s) in zip(found, best_rows(rows, anchors.x[i], wanted, [w for _, w in found], k), strict=True):
                        out += [(row["a_block"], i, int(anchors.ids[i]), place, int(y), int(rows.ids[x]), bool(rows.named[x])) for x, y in zip(at, s, strict=True)]
                yield _frame(out)

    return run


def _first(found: DataFrame, by: list[str], k: int, rank: str) -> DataFrame:
    """The first ``k`` rows by score, then id, of what all blocks found."""
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("id").asc(), F.col("named").desc())
    return found.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= k)


def mine(
    rows: DataFrame, anchor: Column, *, vec_id: str = "vec_id", vector: str = "embedding", label: Column | None = None, scale: int = 256,
    positives: int = 5, negatives: int = 10, least_percent: int = 30, most_percent: int = 90,
    rows_a_block: int = ROWS_A_BLOCK, anchors_a_block: int = ANCHORS_A_BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (rows where
    ``anchor`` holds) and each of its first ``positives`` rows of its label, the first ``negatives`` rows of
    other labels whose score is between the two shares of the positive's score."""
    label = F.col("label") if label is None else label
    taken = written(taking_part(rows, scale, vec_id, vector, label, anchor & F.col(f"`{vec_id}`").isNotNull()), "vectors")
    longest = max(1, taken.agg(F.max(F.size("q"))).first()[0] or 1)
    fitting = max(1, COMPONENTS_A_BLOCK // longest)
    row_blocks, n_blocks = blocks(taken, min(rows_a_block, fitting), "row-blocks", listed=True)
    anchor_blocks, _ = blocks(taken.where("anchor"), min(anchors_a_block, fitting), "anchor-blocks", listed=False)
    found = _meetings(anchor_blocks, row_blocks, n_blocks).mapInPandas(_positives(positives), _FOUND)
    best = written(_first(found, ["a_block", "anchor"], positives, "at"), "positives")
    windows = best.groupBy(F.col("a_block").alias("block")).agg(F.collect_list(F.struct("anchor", "at", "score")).alias("w"))  # of one block's anchors
    windows = windows.select("block", *[F.col(f"w.{c}").alias(f"_{c}") for c in ("anchor", "at", "score")])
    asking = anchor_blocks.join(windows, "block")
    met = _meetings(asking, row_blocks, n_blocks).withColumnsRenamed({"a__anchor": "w_anchor", "a__at": "w_place", "a__score": "w_score"})
    found = met.mapInPandas(_negatives(negatives, least_percent, most_percent), _FOUND)
    hard = _first(found, ["a_block", "anchor", "place"], negatives, "rank")
    named = lambda t: F.when(F.col(f"{t}.named"), F.col(f"{t}.id"))
    same = [F.col(f"h.{x}") == F.col(f"p.{y}") for x, y in (("a_block", "a_block"), ("anchor", "anchor"), ("place", "at"))]
    return hard.alias("h").join(best.alias("p"), same).select(
        F.col("h.anchor_id").alias("anchor_id"), named("p").alias("positive_id"), "rank", named("h").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("h.score").alias("negative_score"),
    )
