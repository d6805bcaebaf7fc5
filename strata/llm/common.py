"""Shared helpers of the operators: reading, lineage cuts, word splitting."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir

#: fixed values: the separators between words, as a Java / RE2 / Python character class
SEPARATORS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"
    made = getattr(_OWNED, "paths", None)
    if made is not None:
        made.append(path)
    return path


_OWNED = threading.local()


@contextmanager
def owned(spark: SparkSession) -> Iterator[None]:
    """Own the folders that operators make inside: they are deleted when the block ends, so
    results must be written elsewhere by then. Blocks of one thread nest."""
    outer = getattr(_OWNED, "paths", None)
    _OWNED.paths = []
    try:
        yield
    finally:
        made, _OWNED.paths = _OWNED.paths, outer
        for path in made:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: later
    stages survive lost executors without recomputing what came before."""
    path = shared_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def carried(df: DataFrame, without: tuple[str, ...] = (), **named) -> DataFrame:
    """The columns ``named`` beside ``_row``, which holds all of ``df`` but the
    columns ``without``: no name of the input can clash with one of an operator."""
    rest = [F.col(f"`{c}`") for c in df.columns if c not in without]
    return df.select((F.struct(*rest) if rest else F.struct(F.lit(None).alias("_none"))).alias("_row"), *[c.alias(k) for k, c in named.items()])


def restored(df: DataFrame, columns: list[str], **replaced) -> list:
    """Columns that bring ``columns`` back out of ``_row``, some replaced."""
    return [replaced[c].alias(c) if c in replaced else F.col("_row").getField(c).alias(c) for c in columns]


def as_text(name: str):
    """Column: an integer id on its way through pandas, where a null beside it
    would turn it into a float; the text is cast back after."""
    return F.col(f"`{name}`").cast("long").cast("string")


def words_of(text):
    """Column: the words of a text (runs without separators); null text: none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS + "+"), "")


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser, element-wise on unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: odd multiplier of the polynomial word hash and its inverse modulo 2**64
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


class WordHasher:
    """64-bit hashes of the words of UTF-8 texts, computed on whole byte arrays.

    Words are runs of bytes other than space and \\t..\\r. A word's hash is a
    polynomial in its bytes modulo 2**64, mixed; it does not depend on the
    word's place. The power tables grow to the longest text seen.
    """

    def __init__(self) -> None:
        self.power = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            size = max(n, 2 * len(self.power), 1 << 14)
            steps = np.full(size, BASE, np.uint64)
            steps[0] = 1
            self.power = np.cumprod(steps, dtype=np.uint64)
            steps = np.full(size, BASE_INVERSE, np.uint64)
            steps[0] = 1
            self.inverse = np.cumprod(steps, dtype=np.uint64)

    def words(self, data: bytes, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, start, end) of each word of ``data``; ``lower`` folds A-Z."""
        b = np.frombuffer(data, np.uint8)
        n = len(b)
        if n == 0:
            e = np.empty(0, np.int64)
            return np.empty(0, np.uint64), e, e
        inside = ~((b == 32) | ((b >= 9) & (b <= 13)))
        edge = np.diff(np.concatenate(([False], inside, [False])).astype(np.int8))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(start) == 0:
            return np.empty(0, np.uint64), start, end
        if lower:
            b = np.where((b >= 65) & (b <= 90), b + np.uint8(32), b)
        return self.spans(b, start, end), start, end

    def spans(self, b: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each span [start, end) of the byte array ``b``."""
        n = len(b)
        self._grow(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=total[1:])
        h = (total[end] - total[start]) * self.inverse[start]
        return mix64(h ^ ((end - start).astype(np.uint64) << np.uint64(40)))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words; with fewer words, of the whole sequence."""
    n = len(words)
    if n == 0:
        return words
    k = min(k, n)
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h = mix64(h * np.uint64(BASE) + words[i : n - k + 1 + i])
    return h
