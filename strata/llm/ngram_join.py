"""N-gram Jaccard self-join: size-banded tiles, bitmap bounds, exact intersection.

A document's set is its distinct shingles of ``words`` words (all of its words
as one, if fewer). Two documents link when the Jaccard similarity of their sets
is at least ``percent`` / 100. The result is one row a document with the
component it belongs to.

1. Signatures: set size, a hash of the set, ``bands`` keys of ``rows`` minimum
   hashes each, and a bitmap with one bit a shingle, at least four times as wide
   as the set is large. Documents with equal sets become one node.
2. Runs: nodes with an equal band key. Linked nodes miss every run with a
   probability of at most (1 - 0.8 ** rows) ** bands, 6e-15 at 2 and 32, which is
   below that of the hash collisions any such join accepts. In runs of more than
   ``large_run`` nodes a link needs two common keys (4.): at 2 and 32 it is missed
   with a probability of at most 3.6e-13 more, which depends on the run's size.
3. Stars: in each run every node of a fitting size is paired with the one that
   has most copies. Pairs whose bitmaps allow the similarity are compared exactly.
4. Tiles: what the stars left unconnected is compared in full. The nodes of a
   run that hold several components are ordered by size and cut into tiles; tile
   against tile of fitting sizes, shared bits bound the overlap from above, and
   the pairs left over, of different components, are compared exactly: first
   each node's best pair of a tile, then, with the components that gives, all.
   A pair is given out in the run of its first common key alone. Runs of more
   than ``large_run`` nodes are first dealt out again by every second key, so a
   pair whose only common key is that run's is not compared.

So a group of copies costs its number of members, not of its pairs, and no link
between components is lost but those of the bounds above. Tiles hold ``tile`` bitmaps at a time.

Defined results: null and empty texts, and texts without words, have no set and
link with nothing; equal sets are linked whatever the texts; rows with equal id
take part each; a null id never names a component unless all ids in it are
null; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WORD, WordHasher, as_text, carried, mix64, restored, shingle_hashes, written
from strata.llm.components import components

_LEAST_BITS, _MOST_BITS = 256, 1 << 20


def shingle_set(hasher: WordHasher, text: str | None, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return np.unique(shingle_hashes(hasher.words((text or "").encode())[0], words))


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """One bit a shingle (may coincide), packed; a power of two wide, so that
    folding a wider one gives the narrower."""
    width = min(_MOST_BITS, max(_LEAST_BITS, 1 << int(4 * len(shingles) - 1).bit_length()))
    bits = np.zeros(width, bool)
    bits[(shingles & np.uint64(width - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little")


def folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Packed bitmap(s) of ``size`` bytes: halves are laid over one another."""
    while bits.shape[-1] > size:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] | bits[..., half:]
    return bits


def overlap_bound(n_a, n_b, ones_a, ones_b, shared):
    """Upper bound of the overlap of two sets: every differing bit is an element
    of only one of them."""
    return (n_a + n_b - (ones_a + ones_b - 2 * shared)) // 2


def enough(overlap, n_a, n_b, percent: int):
    return 100 * overlap >= percent * (n_a + n_b - overlap)


_ONES = np.array([bin(i).count("1") for i in range(256)], np.int32)


def may_link(a: bytes, b: bytes, n_a: int, n_b: int, percent: int) -> bool:
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    size = min(len(x), len(y))
    x, y = folded(x, size), folded(y, size)
    return bool(enough(min(n_a, n_b, overlap_bound(n_a, n_b, _ONES[x].sum(), _ONES[y].sum(), _ONES[x & y].sum())), n_a, n_b, percent))


# ---- signatures


def signatures(docs: DataFrame, words: int, bands: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(_id, _fp, n, set_a, set_b, keys, bits) of each document; ``_fp`` hashes the text."""
    seeds = mix64(np.arange(1, bands * rows + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for pdf in batches:
            n, a, b, keys, bits = [], [], [], [], []
            for text in pdf["_text"]:
                s = shingle_set(hasher, text, words)
                n.append(len(s))
                if not len(s):
                    a.append(0), b.append(0), keys.append([]), bits.append(b"")
                    continue
                least = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
                for at in range(0, len(s), 2048):
                    np.minimum(least, mix64(s[None, at : at + 2048] * seeds[:, None]).min(axis=1), out=least)
                band = np.zeros(bands, np.uint64)
                for r in range(rows):
                    band = mix64(band * np.uint64(31) + least[r::rows])
                keys.append(mix64(band + np.arange(bands, dtype=np.uint64)).astype(np.int64))
                a.append(int(mix64(s).sum(dtype=np.uint64).astype(np.int64)))
                b.append(int(np.bitwise_xor.reduce(mix64(s * np.uint64(0xD1342543DE82EF95))).astype(np.int64)))
                bits.append(bitmap(s).tobytes())
            yield pd.DataFrame({"_id": pdf["_id"], "_fp": pdf["_fp"], "n": n, "set_a": a, "set_b": b, "keys": keys, "bits": bits})

    return docs.select(as_text(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_fp"), F.col(text_col).alias("_text")).mapInPandas(
        sign, "_id string, _fp long, n long, set_a long, set_b long, keys array<long>, bits binary"
    ).withColumn("_id", F.col("_id").cast("long"))


# ---- candidates


def runs_with_pivot(nodes: DataFrame) -> DataFrame:
    """(key, node, n, pivot, pivot_n) of the runs of two or more nodes."""
    rows = nodes.select(F.explode("keys").alias("key"), "node", "n", "copies")
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pivots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the last row, whose run may go on; the current run's first row
        head = (None, 0, 0)
        for pdf in batches:
            if held is not None:
                pdf = pd.concat([held, pdf], ignore_index=True)
            key, node, n = pdf["key"].to_numpy(), pdf["node"].to_numpy(), pdf["n"].to_numpy()
            opens = np.ones(len(key), bool)
            opens[1:] = key[1:] != key[:-1]
            if head[0] is not None and key[0] == head[0]:
                opens[0] = False
            first = np.maximum.accumulate(np.where(opens, np.arange(len(key)), -1))
            pivot = np.where(first >= 0, node[first], head[1])
            size = np.where(first >= 0, n[first], head[2])
            joined = ~opens
            joined[:-1] |= ~opens[1:]
            out = pd.DataFrame({"key": key, "node": node, "n": n, "pivot": pivot, "pivot_n": size})
            yield out[:-1][joined[:-1]]
            alone = bool(opens[-1])
            if alone:
                held, head = pdf.iloc[-1:], (None, 0, 0)
            else:
                held = None
                head = (key[-1], pivot[-1], size[-1])
                yield out[-1:]

    return rows.repartition(parts, "key").sortWithinPartitions("key", F.desc("copies"), "node").mapInPandas(
        pivots, "key long, node long, n long, pivot long, pivot_n long"
    )


def tile_pairs(rows: DataFrame, percent: int, tile: int, best: bool) -> DataFrame:
    """(a, b) of nodes in equal runs and different components whose bitmaps allow a link.

    ``rows``: (key, node, n, root, bits, keys, outer). A run streams in order of
    size; the tiles that can still meet a fitting size are kept. ``best``: of a
    node's pairs between two tiles only the one with the highest bound. ``outer``
    is the band key whose run was dealt out again, null for a run as it is.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def meet(x: dict, y: dict, same: bool) -> np.ndarray:
        width = min(x["bits"].shape[1], y["bits"].shape[1])
        p, q = np.unpackbits(folded(x["bits"], width), axis=1), np.unpackbits(folded(y["bits"], width), axis=1)
        shared = np.rint(p.astype(np.float32) @ q.astype(np.float32).T).astype(np.int64)
        na, nb = x["n"][:, None], y["n"][None, :]
        bound = overlap_bound(na, nb, p.sum(axis=1, dtype=np.int64)[:, None], q.sum(axis=1, dtype=np.int64)[None, :], shared)
        bound = np.minimum(bound, np.minimum(na, nb))
        ok = enough(bound, na, nb, percent) & (x["root"][:, None] != y["root"][None, :])
        if same:
            ok = np.triu(ok, 1)
        i, j = np.nonzero(ok)
        if len(i):
            own = _in_its_run(x["keys"][i] == y["keys"][j], x["keys"][i], x["key"], x["outer"])
            i, j = i[own], j[own]
        if best and len(i):
            likely = bound[i, j] / (x["n"][i] + y["n"][j] - bound[i, j])
            order = np.argsort(-likely, kind="stable")
            first = np.concatenate((order[np.unique(i[order], return_index=True)[1]], order[np.unique(j[order], return_index=True)[1]]))
            first = np.unique(first)
            i, j = i[first], j[first]
        return np.stack([x["node"][i], y["node"][j]], axis=1)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, kept, open_rows = None, [], []

        def close() -> Iterator[pd.DataFrame]:
            """Make the open rows a tile and let it meet itself and the kept ones."""
            nonlocal kept, open_rows
            if not open_rows:
                return
            width = max(len(r[3]) for r in open_rows)
            width = min(width, max(32, (1 << 24) // tile // 8))  # bounds a tile's memory; folded bitmaps still bound
            own = {
                "node": np.array([r[0] for r in open_rows]), "n": np.array([r[1] for r in open_rows]), "root": np.array([r[2] for r in open_rows]),
                "bits": np.stack([_widened(folded(np.frombuffer(r[3], np.uint8), width), width) for r in open_rows]),
                "narrow": min(len(r[3]) for r in open_rows), "keys": np.array([r[4] for r in open_rows]), "key": key, "outer": open_rows[0][5],
            }
            own["bits"] = folded(own["bits"], own["narrow"])
            kept = [t for t in kept if 100 * t["n"][-1] >= percent * own["n"][0]]
            for t in kept:
                got = meet(t, own, False)
                if len(got):
                    yield pd.DataFrame({"a": got.min(axis=1), "b": got.max(axis=1)})
            got = meet(own, own, True)
            if len(got):
                yield pd.DataFrame({"a": got.min(axis=1), "b": got.max(axis=1)})
            kept.append(own)
            open_rows = []

        for pdf in batches:
            for k, node, n, root, bits, keys, outer in zip(*(pdf[c] for c in ("key", "node", "n", "root", "bits", "keys", "outer"))):
                if k != key:
                    yield from close()
                    key, kept = k, []
                # a tile holds one band of sizes: powers of two share a bitmap width
                if open_rows and (len(open_rows) >= tile or len(open_rows[0][3]) != len(bits)):
                    yield from close()
                open_rows.append((node, n, root, bits, keys, None if outer is None else int(outer)))
        yield from close()

    return rows.select("key", "node", "n", "root", "bits", "keys", F.col("outer").cast("string").alias("outer")).repartition(parts, "key").sortWithinPartitions("key", "n", "node").mapInPandas(
        compare, "a long, b long"
    )


def _in_its_run(common: np.ndarray, keys: np.ndarray, key: int, outer: int | None) -> np.ndarray:
    """Whether the run at hand is that of the first key two nodes share (by pair:
    ``common`` marks the equal ones of their ``keys``); in a run dealt out again,
    that of the first with the next."""
    row = np.arange(len(common))
    first = common.argmax(axis=1)
    if outer is None:
        return keys[row, first] == key
    rest = common.copy()
    rest[row, first] = False
    second = rest.argmax(axis=1)
    return (keys[row, first] == outer) & rest.any(axis=1) & (_second_key(keys[row, first], keys[row, second]) == key)


def _second_key(outer: np.ndarray, inner: np.ndarray) -> np.ndarray:
    return mix64(mix64(outer.astype(np.uint64)) ^ inner.astype(np.uint64)).astype(np.int64)


def _widened(bits: np.ndarray, width: int) -> np.ndarray:
    return bits if len(bits) == width else np.tile(bits, width // len(bits))


def open_runs(runs: DataFrame, nodes: DataFrame, rooted: DataFrame, large_run: int) -> DataFrame:
    """Rows for ``tile_pairs`` of the runs that hold several components."""
    placed = runs.select("key", "node", "n").join(rooted, "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root"))
    several = (
        placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("members"))
        .where("lo <> hi").select("key", "members")
    )
    left = written(placed.join(several, "key"), "open-runs").join(nodes.select("node", "bits", "keys"), "node")
    plain = left.where(F.col("members") <= large_run).withColumn("outer", F.lit(None).cast("long"))

    def dealt(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row of a large run for each other key of its node."""
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                inner = np.array([k for k in row.keys if k != row.key], np.int64)
                yield pd.DataFrame({
                    "key": _second_key(np.full(len(inner), row.key), inner), "node": row.node, "n": row.n, "root": row.root,
                    "bits": [row.bits] * len(inner), "keys": [row.keys] * len(inner), "outer": row.key,
                })

    columns = "key long, node long, n long, root long, bits binary, keys array<long>, outer long"
    names = ["key", "node", "n", "root", "bits", "keys", "outer"]
    again = left.where(F.col("members") > large_run).select(*names[:-1]).mapInPandas(dealt, columns)
    return plain.select(*names).unionByName(again)


# ---- exact comparison


def linked(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, percent: int, bounded: bool) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity. ``bounded``: their bitmaps already allow it."""
    if not bounded:
        side = nodes.select("node", "n", "bits")
        bound = F.pandas_udf(
            lambda a, b, m, n: pd.Series([may_link(p, q, int(x), int(y), percent) for p, q, x, y in zip(a, b, m, n)], dtype=bool), "boolean"
        )
        pairs = (
            pairs.join(side.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a")), "a")
            .join(side.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b")), "b")
            .where(bound("bits_a", "bits_b", "n_a", "n_b")).select("a", "b")
        )
        pairs = written(pairs, "bounded-pairs")

    def exact(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        hasher, recent = WordHasher(), {}

        def shingles(text: str) -> np.ndarray:
            if text not in recent:
                if len(recent) >= 64:  # only spares work on texts that come again
                    recent.clear()
                recent[text] = shingle_set(hasher, text, words)
            return recent[text]

        for left, right in batches:
            out = []
            for p, q in zip(left, right):
                x, y = shingles(p), shingles(q)
                overlap = len(np.intersect1d(x, y, assume_unique=True))
                out.append(bool(enough(overlap, len(x), len(y), percent)))
            yield pd.Series(out, dtype=bool)

    compare = F.pandas_udf(exact, "boolean")
    return (
        pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
        .where(compare("text_a", "text_b")).select("a", "b").distinct()
    )


def jaccard_components(
    docs: DataFrame, words: int = 5, percent: int = 80, bands: int = 32, rows: int = 2, tile: int = 512, large_run: int = 2_000,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(_id, _fp, n_shingles, component_id, _component) of each document; ``_fp`` hashes
    the text, ``_component`` tells components apart whatever their ids (null: no set)."""
    signed = written(signatures(docs, words, bands, rows, id_col, text_col), "signatures")
    same_set = ["n", "set_a", "set_b"]
    nodes = written(
        signed.where("n > 0").groupBy(*same_set)
        .agg(
            F.count(F.lit(1)).alias("copies"), F.min("_id").alias("least_id"), F.min(F.struct("_id", "_fp")).alias("sample"),
            F.first("keys").alias("keys"), F.first("bits").alias("bits"),
        )
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    runs = written(runs_with_pivot(nodes), "runs")
    # texts of the nodes that met another one
    met = nodes.join(runs.select("node").distinct(), "node", "left_semi").select("node", "sample._id", "sample._fp")
    base = docs.select(F.col(id_col).cast("long").alias("d_id"), F.xxhash64(F.col(text_col)).alias("d_fp"), F.col(text_col).alias("text"))
    texts = written(
        base.join(met, base["d_id"].eqNullSafe(met["_id"]) & (base["d_fp"] == met["_fp"])).select("node", "text"), "texts"
    )
    fits = (100 * F.least("n", "pivot_n") >= percent * F.greatest("n", "pivot_n")) & (F.col("node") != F.col("pivot"))
    stars = runs.where(fits).select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    links = written(linked(stars, nodes, texts, words, percent, bounded=False), "star-links")
    for best in (True, False):
        rows_left = open_runs(runs, nodes, components(links), large_run)
        pairs = written(tile_pairs(rows_left, percent, tile, best).distinct(), "tile-pairs")
        links = written(links.unionByName(linked(pairs, nodes, texts, words, percent, bounded=True)), "links")
    rooted = components(links)
    placed = nodes.join(rooted, "node", "left").select(*same_set, "least_id", F.coalesce("root", "node").alias("root"))
    named = placed.join(placed.groupBy("root").agg(F.min("least_id").alias("component_id")), "root").select(*same_set, "component_id", F.col("root").alias("_component"))
    named = named.withColumnsRenamed({c: f"node_{c}" for c in same_set})
    return signed.join(named, [signed[c] == named[f"node_{c}"] for c in same_set], "left").select(
        "_id", "_fp", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"), "_component",
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """Rows of ``docs``: of each component the one with the smallest id (then text hash) stays,
    and every row without a set."""
    found = jaccard_components(docs, id_col=id_col, text_col=text_col, **settings)
    kept = (
        found.where(F.col("_component").isNotNull()).groupBy("_component").agg(F.min(F.struct("_id", "_fp")).alias("k"))
        .select(F.col("k._id").alias("_kept_id"), F.col("k._fp").alias("_kept_fp"))
    )
    text = F.col(f"`{text_col}`")
    keyed = carried(docs, _own_id=F.col(f"`{id_col}`").cast("long"), _own_fp=F.xxhash64(text), _some=F.coalesce(text, F.lit("")).rlike(WORD))
    with_set = (
        keyed.where("_some").join(kept, F.col("_own_id").eqNullSafe(F.col("_kept_id")) & (F.col("_own_fp") == F.col("_kept_fp")), "left_semi")
        .dropDuplicates(["_own_id", "_own_fp"])
    )
    return with_set.unionByName(keyed.where("NOT _some")).select(*restored(keyed, docs.columns))
