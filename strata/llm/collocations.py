"""Phrase collocation mining with counting quotient filters.

A shard (what one task reads, up to a bounded number of distinct words) numbers its
own words; these go through one aggregation that counts every word of the corpus and
numbers the frequent ones, and each shard gets back the numbers of its own words by a
join. No dictionary of the corpus is broadcast or held anywhere.

A phrase occurs at most as often as each of its parts, so only runs of frequent words
are counted, and beyond two words only runs of frequent pairs, which loses nothing. A
phrase of m words is the m * b bits of its word ids. An invertible mixing network
permutes these bits; the leading ones of the result are the quotient, all others the
remainder. A filter (``to_filter``) holds sorted entries as a counting quotient filter
does: a bit for each quotient that occurs, a bit for the last entry of each quotient's
run, the full remainders, and counters of one byte that grow when needed. Quotient and
remainder give the phrase back, so counts are exact and no phrase is stored beside
them. Filters are cut by the leading quotient bits; the slices of one range from all
chunks are merged in one group, which sends back, for every slice of pairs, one bit an
entry: frequent or not. The permutation spreads phrases evenly over ranges, and a
phrase, however frequent, is one entry of a chunk's filter.

Scores are Spark joins of candidates with the counts of their parts, in exact
decimals.

Defined results: a null or empty text has no words; a null language is ``und``;
repeated rows count as often as they occur; a null id is as good as any; an empty
table gives an empty one; columns other than the language and the text are not
read, so none can clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import mix64, written

#: fixed values: what ends a piece, and the tab, which separates words as the space does
PIECE_ENDS, TAB = b".,;:!?\n\x0b\x0c\r", b"\t"
#: a piece's end is a token of its own, which no word can be
_BREAK = b"."
_FOLD = bytes.maketrans(PIECE_ENDS + TAB, _BREAK * len(PIECE_ENDS) + b" ")
UNKNOWN_LANG = "und"
LONGEST = 5
_ODD = np.uint64(0x9E3779B97F4A7C15)


# ---------------------------------------------------------------- texts to shards of word ids
def slices(data: bytes, most: int = 1 << 22) -> Iterator[bytes]:
    """``data`` in slices of about ``most`` bytes that cut no word."""
    start = 0
    while len(data) - start > most:
        end = max(data.rfind(b" ", start, start + most), data.rfind(_BREAK, start, start + most)) + 1
        if end <= start:  # a longer word is taken whole
            later = [x for x in (data.find(b" ", start + most), data.find(_BREAK, start + most)) if x >= 0]
            end = min(later) + 1 if later else len(data)
        yield data[start:end]
        start = end
    yield data[start:]


def tokens(text: str) -> Iterator[list[bytes]]:
    """Lower-cased words of ``text`` and piece ends, slice by slice."""
    data = text.encode("utf-8", "surrogatepass").lower().translate(_FOLD)
    for part in slices(data):
        yield part.replace(_BREAK, b" . ").split()


class _Numbers(dict):
    def __missing__(self, key: bytes) -> int:
        self[key] = n = len(self)
        return n


def _thin(ids: np.ndarray) -> bytes:
    """Numbers in 4 or 8 bytes each (the first byte says which), compressed."""
    kind = np.int64 if ids.size and ids.max() > 0x7FFFFFFF else np.int32
    return bytes([np.dtype(kind).itemsize]) + zlib.compress(np.ascontiguousarray(ids, kind).tobytes(), 1)


def _encoder(most_words: int, most_distinct: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        made = (TaskContext.get().partitionId() + 1) << 32
        shards: dict[str, dict] = {}  # a language's shard: its number, its words, their counts and the chunk in the making
        size = 0

        def chunks() -> Iterator[pd.DataFrame]:
            nonlocal size, made
            for lang, s in shards.items():
                if s["parts"]:
                    ids = np.concatenate(s["parts"])
                    counts = np.bincount(ids, minlength=len(s["words"]))
                    counts[: len(s["counts"])] += s["counts"]
                    s["counts"], s["parts"] = counts, []
                    made += 1
                    yield pd.DataFrame({"shard": [s["shard"]], "chunk": [made], "lang": [lang], "ids": [_thin(ids)], "words": [None], "counts": [None]})
            size = 0

        def dictionaries() -> Iterator[pd.DataFrame]:
            yield from chunks()
            for lang, s in shards.items():
                words = [w.decode("utf-8", "surrogatepass") for w in s["words"]]
                yield pd.DataFrame({"shard": [s["shard"]], "chunk": [None], "lang": [lang], "ids": [None], "words": [words], "counts": [s["counts"]]})
            shards.clear()

        for pdf in batches:
            for lang, text in zip(pdf["lang"], pdf["text"], strict=True):
                if lang not in shards:
                    made += 1
                    shards[lang] = {"shard": made, "words": _Numbers({_BREAK: 0}), "counts": np.zeros(0, np.int64), "parts": []}
                numbers, parts = shards[lang]["words"], shards[lang]["parts"]
                for found in tokens(text):
                    parts.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                    size += len(found)
                parts.append(np.zeros(1, np.int32))  # phrases never cross texts
                if size >= most_words:
                    yield from chunks()
                if sum(len(s["words"]) for s in shards.values()) > most_distinct:
                    yield from dictionaries()
        yield from dictionaries()

    return run


_SHARD = "shard long, chunk long, lang string, ids binary, words array<string>, counts array<long>"


def encoded(docs: DataFrame, lang: str = "lang", text: str = "text", most_words: int = 1 << 21, most_distinct: int = 1 << 20) -> DataFrame:
    """Chunks of at least one text and about ``most_words`` words at most (their numbers in the
    shard, in reading order, 0 for a piece's end), and a row a shard with its words and their counts."""
    d = docs.select(F.coalesce(F.col(f"`{lang}`"), F.lit(UNKNOWN_LANG)).alias("lang"), F.col(f"`{text}`").alias("text"))
    return d.where("text IS NOT NULL AND text <> ''").mapInPandas(_encoder(most_words, most_distinct), _SHARD)


def _numbering(least: int, most_rows: int = 1 << 21):
    """Over (lang, word, shard, pos, n) in order of words: the frequent words with their rank in the
    partition, and for each shard its words among them (place * 2**40 + rank)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, rank = TaskContext.get().partitionId(), 0
        kept: list[tuple] = []
        held: list[pd.DataFrame] = []  # rows of the last word, which may go on in the next batch

        def packed_rows() -> Iterator[pd.DataFrame]:
            if kept:
                shard, packed = (np.concatenate(x) for x in zip(*kept, strict=True))
                order = np.argsort(shard, kind="stable")
                shard, packed = shard[order], packed[order]
                first = np.flatnonzero(np.diff(shard, prepend=shard[0] - 1))
                rows = [(part, int(shard[a]), x.tolist(), None, None, None, None) for a, x in zip(first, np.split(packed, first[1:]), strict=True)]
                kept.clear()
                yield _numbered(rows)

        def counted(rows: pd.DataFrame, first: np.ndarray) -> Iterator[pd.DataFrame]:
            nonlocal rank
            sums = np.add.reduceat(rows["n"].to_numpy(np.int64), first)
            frequent = sums >= least
            if frequent.any():
                ranks = rank + np.cumsum(frequent)
                of = np.repeat(np.where(frequent, ranks, 0), np.diff(np.append(first, len(rows))))
                at = np.flatnonzero(of)
                kept.append((rows["shard"].to_numpy(np.int64)[at], (rows["pos"].to_numpy(np.int64)[at] << 40) + of[at]))
                rank = int(ranks[-1])
                spelt = rows.iloc[first[frequent]]
                yield _numbered([(part, None, None, int(r), x, y, int(f)) for r, x, y, f in zip(ranks[frequent], spelt["lang"], spelt["word"], sums[frequent], strict=True)])
                if sum(len(x) for x, _ in kept) > most_rows:
                    yield from packed_rows()

        for pdf in batches:
            rows = pd.concat([*held, pdf], ignore_index=True) if held else pdf.reset_index(drop=True)
            lang, word = rows["lang"].to_numpy(object), rows["word"].to_numpy(object)
            first = np.concatenate(([0], 1 + np.flatnonzero((word[1:] != word[:-1]) | (lang[1:] != lang[:-1]))))
            if len(first) > 1:
                yield from counted(rows.iloc[: first[-1]], first[:-1])
            held = [rows.iloc[first[-1] :]]
        if held:
            yield from counted(held[0].reset_index(drop=True), np.array([0]))
        yield from packed_rows()

    return run


def _numbered(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["part", "shard", "packed", "rank", "lang", "word", "f"], dtype=object)
    return out.astype({c: "Int64" for c in ("part", "shard", "rank", "f")})


_NUMBERED = "part long, shard long, packed array<long>, rank long, lang string, word string, f long"


def vocabulary(shards: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(lang, word, f, id) of the words that occur ``least`` times, with ids from 1 without gaps,
    and (shard, part, packed, before): the ranks of each shard's words, and what makes them ids.

    One shuffle brings the shards' counts of a word together (a row a shard at most)."""
    words = shards.where("words IS NOT NULL").select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts"))).select(
        "lang", F.col("col.words").alias("word"), "shard", F.col("pos").cast("long").alias("pos"), F.col("col.counts").alias("n")
    ).where("pos > 0")
    in_order = words.repartition("lang", "word").sortWithinPartitions("lang", "word")
    numbered = written(in_order.mapInPandas(_numbering(least), _NUMBERED), "numbered")
    frequent = numbered.where("word IS NOT NULL")
    sizes = frequent.groupBy("part").agg(F.max("rank").alias("_n"))  # one row a partition
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(sizes.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("before")), "offsets")
    known = frequent.join(offsets, "part").select("lang", "word", "f", (F.col("before") + F.col("rank")).alias("id"))
    return written(known, "vocabulary"), numbered.where("shard IS NOT NULL").join(offsets, "part").select("shard", "packed", "before")


# ---------------------------------------------------------------- packing and permuting
def widths(n_bits: int) -> list[int]:
    """How ``n_bits`` are laid out in lanes of at most 62 bits, two at least, highest first."""
    lanes = max(2, -(-n_bits // 62))
    return [n_bits // lanes + (i < n_bits % lanes) for i in range(lanes)]


def _mask(width: int) -> np.uint64:
    return np.uint64((1 << width) - 1)


def packed(ids: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Lanes of the bit string that holds one id of ``bits`` bits after the other."""
    n_bits, out, low = bits * len(ids), [], bits * len(ids)
    for w in widths(n_bits):
        low -= w  # the lane holds bits low .. low + w of the string
        lane = np.zeros(len(ids[0]), np.uint64)
        for j, x in enumerate(ids):
            at = n_bits - bits * (j + 1) - low  # the id's lowest bit, as seen from the lane's
            if -bits < at < w:
                x = x.astype(np.uint64)
                lane |= (x << np.uint64(at) if at >= 0 else x >> np.uint64(-at)) & _mask(w)
        out.append(lane)
    return out


def unpacked(lanes: list[np.ndarray], bits: int, m: int) -> list[np.ndarray]:
    """The ids that ``packed`` laid out."""
    n_bits, out = bits * m, []
    for j in range(m):
        x, low = np.zeros(len(lanes[0]), np.uint64), n_bits
        for w, lane in zip(widths(n_bits), lanes, strict=True):
            low -= w
            at = n_bits - bits * (j + 1) - low
            if -bits < at < w:
                x |= lane >> np.uint64(at) if at >= 0 else lane << np.uint64(-at)
        out.append((x & _mask(bits)).astype(np.int64))
    return out


def permuted(lanes: list[np.ndarray], n_bits: int, inverse: bool = False, rounds: int = 3) -> list[np.ndarray]:
    """An invertible mix of the bit strings: each step adds to one lane a hash of the others."""
    lanes, w = list(lanes), widths(n_bits)
    steps = range(rounds * len(lanes))
    for step in reversed(steps) if inverse else steps:
        i, h = step % len(lanes), np.full(len(lanes[0]), step + 1, np.uint64)
        for j, lane in enumerate(lanes):
            if j != i:
                h = mix64((h + lane) * _ODD)
        lanes[i] = lanes[i] ^ (h & _mask(w[i]))
    return lanes


def summed(lanes: list[np.ndarray], counts: np.ndarray | None, n_bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct entries in order, with the sums of their counts (None: one each)."""
    n = len(lanes[0])
    if n == 0:
        return lanes, np.empty(0, np.int64)
    w = widths(n_bits)
    if n_bits <= 64:  # the whole string fits one integer
        key = (lanes[0] << np.uint64(w[1])) | lanes[1]
        if counts is None:
            key.sort()
        else:
            order = np.argsort(key, kind="stable")
            key, counts = key[order], counts[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        key = key[first]
        lanes = [key >> np.uint64(w[1]), key & _mask(w[1])]
    else:
        order = np.lexsort(lanes[::-1])
        lanes = [x[order] for x in lanes]
        counts = None if counts is None else counts[order]
        differs = np.zeros(n, bool)
        differs[0] = True
        for x in lanes:
            differs[1:] |= x[1:] != x[:-1]
        first = np.flatnonzero(differs)
        lanes = [x[first] for x in lanes]
    sums = np.diff(np.append(first, n)) if counts is None else np.add.reduceat(counts, first)
    return lanes, sums.astype(np.int64)


# ---------------------------------------------------------------- the filter
def _bytes_of(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each integer, in whole bytes."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, : -(-width // 8)].tobytes()


def _from_bytes(data: bytes, at: int, n: int, width: int) -> tuple[np.ndarray, int]:
    k = -(-width // 8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :k] = np.frombuffer(data, np.uint8, n * k, at).reshape(n, k)
    return out.view(np.uint64).ravel(), at + n * k


def to_filter(lanes: list[np.ndarray], counts: np.ndarray, n_bits: int, range_bits: int) -> bytes:
    """A counting quotient filter of sorted, distinct entries that agree in their first ``range_bits`` bits."""
    w, n = widths(n_bits), len(counts)
    q = min(w[0] - range_bits, max(1, n.bit_length()))  # about one entry a quotient
    left = w[0] - range_bits - q
    quotient = (lanes[0] >> np.uint64(left)) & _mask(q)
    occupied = np.zeros(1 << q, bool)
    occupied[quotient.astype(np.int64)] = True
    run_ends = np.append(quotient[1:] != quotient[:-1], True)
    large = np.flatnonzero(counts >= 255)
    head = np.array([n, q, int(lanes[0][0]) >> (left + q), len(large)], np.int64)
    return b"".join((
        head.tobytes(), np.packbits(occupied).tobytes(), np.packbits(run_ends).tobytes(),
        _bytes_of(lanes[0] & _mask(left), left), *(_bytes_of(x, y) for x, y in zip(lanes[1:], w[1:], strict=True)),
        np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[large].astype(np.int64).tobytes(),
    ))


def from_filter(data: bytes, n_bits: int, range_bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The entries of a filter, in order, and their counts."""
    w = widths(n_bits)
    n, q, lead, n_large = (int(x) for x in np.frombuffer(data, np.int64, 4))
    at, left = 32, w[0] - range_bits - q
    size = -(-(1 << q) // 8)
    occupied = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=1 << q))
    at += size
    run_ends = np.unpackbits(np.frombuffer(data, np.uint8, -(-n // 8), at), count=n)
    at += -(-n // 8)
    run = np.cumsum(run_ends, dtype=np.int64) - run_ends
    rest, at = _from_bytes(data, at, n, left)
    lanes = [((np.uint64(lead) << np.uint64(q) | occupied.astype(np.uint64)[run]) << np.uint64(left)) | rest]
    for y in w[1:]:
        lane, at = _from_bytes(data, at, n, y)
        lanes.append(lane)
    counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, np.int64, n_large, at + n)
    return lanes, counts


def merged(filters: list[bytes], n_bits: int, range_bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The entries of all ``filters`` of one range with their counts added up."""
    read = [from_filter(x, n_bits, range_bits) for x in filters]
    lanes = [np.concatenate(x) for x in zip(*(r[0] for r in read), strict=True)]
    return summed(lanes, np.concatenate([r[1] for r in read]), n_bits)


# ---------------------------------------------------------------- counting
def phrase_lanes(seq: np.ndarray, m: int, bits: int, pairs: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """The permuted entries of all runs of ``m`` ids above zero (with ``pairs``, a mask of the places
    where a frequent pair begins: all of whose pairs are frequent), and where they begin."""
    n = len(seq) - m + 1
    if n <= 0:
        return [np.empty(0, np.uint64) for _ in widths(bits * m)], np.empty(0, np.int64)
    fits, length = (seq > 0, m) if pairs is None else (pairs, m - 1)
    whole = fits[:n].copy()
    for j in range(1, length):
        whole &= fits[j : n + j]
    at = np.flatnonzero(whole)
    return permuted(packed([seq[at + j] for j in range(m)], bits), bits * m), at


def _range_bits(m: int, bits: int, range_bits: int) -> int:
    return min(range_bits, widths(bits * m)[0] - 1)


def _sliced(m: int, chunk: int | None, lanes: list[np.ndarray], counts: np.ndarray, bits: int, range_bits: int) -> Iterator[pd.DataFrame]:
    n_bits, r = bits * m, _range_bits(m, bits, range_bits)
    of = (lanes[0] >> np.uint64(widths(n_bits)[0] - r)).astype(np.int64)
    cuts = [*np.flatnonzero(np.diff(of, prepend=-1)).tolist(), len(of)]
    rows = [(m, int(of[a]), chunk, to_filter([x[a:b] for x in lanes], counts[a:b], n_bits, r)) for a, b in zip(cuts, cuts[1:], strict=False)]
    for i in range(0, len(rows), 256):
        yield pd.DataFrame(rows[i : i + 256], columns=["m", "part", "chunk", "entries"])


_SLICE = "m int, part long, chunk long, entries binary"


def _sequence(data: bytes) -> np.ndarray:
    raw, n = zlib.decompress(data[1:]), data[0]
    return np.frombuffer(raw, np.int32 if n == 4 else np.int64).astype(np.int64)


def _renumber(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The ids of a chunk's words in place of their numbers in the shard; 0 for the rare ones."""
    for pdf in batches:
        for chunk, ids, known in zip(pdf["chunk"], pdf["ids"], pdf["known"], strict=True):
            local = _sequence(ids)
            known = np.concatenate([np.asarray(x["packed"], np.int64) + x["before"] for x in known])
            number = np.zeros(max(int(local.max()), int((known >> 40).max())) + 1, np.int64)
            number[known >> 40] = known & ((1 << 40) - 1)
            yield pd.DataFrame({"chunk": [chunk], "ids": [_thin(number[local])]})


def _pair_counter(bits: int, range_bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for chunk, ids in zip(pdf["chunk"], pdf["ids"], strict=True):
                lanes, _ = phrase_lanes(_sequence(ids), 2, bits)
                yield from _sliced(2, int(chunk), *summed(lanes, None, bits * 2), bits, range_bits)

    return run


def _frequent_pairs(seq: np.ndarray, bits: int, answers: list) -> np.ndarray:
    """Where a frequent pair begins, from the bits that came back for the chunk's slices."""
    lanes, at = phrase_lanes(seq, 2, bits)
    order = np.lexsort(lanes[::-1])
    differs = np.zeros(len(order), bool)
    for x in lanes:
        differs[1:] |= x[order][1:] != x[order][:-1]
    entry = np.empty(len(order), np.int64)
    entry[order] = np.cumsum(differs)
    flags = np.concatenate([np.unpackbits(np.frombuffer(x["kept"], np.uint8), count=x["n"]) for x in sorted(answers, key=lambda x: x["part"])])
    out = np.zeros(len(seq), bool)
    out[at] = flags[entry].astype(bool)
    return out


def _phrase_counter(bits: int, range_bits: int, most_entries: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {m: [] for m in range(3, LONGEST + 1)}

        def together(m: int) -> tuple[list[np.ndarray], np.ndarray]:
            lanes = [np.concatenate(x) for x in zip(*(h[0] for h in held[m]), strict=True)]
            return summed(lanes, np.concatenate([h[1] for h in held[m]]), bits * m)

        for pdf in batches:
            for ids, answers in zip(pdf["ids"], pdf["answers"], strict=True):
                seq = _sequence(ids)
                pairs = _frequent_pairs(seq, bits, list(answers))
                for m in held:
                    held[m].append(summed(phrase_lanes(seq, m, bits, pairs)[0], None, bits * m))
                    if sum(len(h[1]) for h in held[m]) > most_entries:
                        held[m] = [together(m)]  # one entry a phrase
                        if len(held[m][0][1]) > most_entries // 2:
                            yield from _sliced(m, None, *held[m][0], bits, range_bits)
                            held[m] = []
        for m in held:
            if held[m]:
                yield from _sliced(m, None, *together(m), bits, range_bits)

    return run


_MERGED = "ids array<long>, a long, chunk long, part long, n long, kept binary"


def _merger(bits: int, range_bits: int, least: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        m = int(pdf["m"].iloc[0])
        n_bits, r = bits * m, _range_bits(m, bits, range_bits)
        lanes, counts = merged(list(pdf["entries"]), n_bits, r)
        at = np.flatnonzero(counts >= least)
        frequent = [x[at] for x in lanes]
        ids = unpacked(permuted(frequent, n_bits, inverse=True), bits, m)
        rows = [(list(x), int(a), None, None, None, None) for x, a in zip(np.stack(ids, axis=1).tolist(), counts[at], strict=True)]
        if m == 2:  # one bit an entry of every slice goes back to its chunk
            key = frequent[0] << np.uint64(widths(n_bits)[1]) | frequent[1] if n_bits <= 64 else None
            for chunk, entries in zip(pdf["chunk"], pdf["entries"], strict=True):
                own, _ = from_filter(entries, n_bits, r)
                if key is not None:
                    kept = np.isin(own[0] << np.uint64(widths(n_bits)[1]) | own[1], key)
                else:
                    known = set(zip(*(x.tolist() for x in frequent), strict=True))
                    kept = np.array([x in known for x in zip(*(y.tolist() for y in own), strict=True)])
                rows.append((None, None, int(chunk), int(pdf["part"].iloc[0]), len(kept), np.packbits(kept).tobytes()))
        out = pd.DataFrame(rows, columns=["ids", "a", "chunk", "part", "n", "kept"], dtype=object)
        return out.astype({c: "Int64" for c in ("a", "chunk", "part", "n")})

    return run


def frequent_phrases(
    docs: DataFrame, least: int = 100, lang: str = "lang", text: str = "text", most_words: int = 1 << 21, most_entries: int = 1 << 21
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every phrase of one to ``LONGEST`` words that occurs ``least`` times in its language.

    Returns (ids, a) of the phrases, the vocabulary (lang, word, f, id) and the
    words of each language (lang, n). ``most_entries`` bounds what a task holds
    of phrases of one length before it gives filters out.
    """
    shards = written(encoded(docs, lang, text, most_words), "word-shards")
    # the first place of a shard's counts is that of the pieces' ends
    in_shard = F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y) - F.get("counts", F.lit(0))
    totals = written(shards.where("words IS NOT NULL").groupBy("lang").agg(F.sum(in_shard).alias("n")).where("n > 0"), "totals")
    known, ranks = vocabulary(shards, least)
    n_known, n_words = known.count(), totals.agg(F.sum("n")).first()[0] or 0
    bits = max(1, n_known.bit_length())
    # a range holds about a million entries at most, as a length has no more phrases than there are words
    range_bits = max(6, (n_words >> 20).bit_length())
    # of one shard's words
    number = ranks.groupBy("shard").agg(F.collect_list(F.struct("before", "packed")).alias("known"))
    chunks = shards.where("ids IS NOT NULL").select("shard", "chunk", "ids")
    chunks = written(chunks.join(number, "shard").mapInPandas(_renumber, "chunk long, ids binary"), "word-chunks")
    merge = _merger(bits, range_bits, least)
    pairs = chunks.mapInPandas(_pair_counter(bits, range_bits), _SLICE)
    pairs = written(pairs.groupBy("m", "part").applyInPandas(merge, _MERGED), "pairs")
    answers = pairs.where("chunk IS NOT NULL").groupBy("chunk").agg(F.collect_list(F.struct("part", "n", "kept")).alias("answers"))  # of one chunk's slices
    filters = chunks.join(answers, "chunk").mapInPandas(_phrase_counter(bits, range_bits, most_entries), _SLICE)
    longer = filters.groupBy("m", "part").applyInPandas(merge, _MERGED)
    both = pairs.where("ids IS NOT NULL").select("ids", "a").unionByName(longer.select("ids", "a"))
    return written(both.unionByName(known.select(F.array("id").alias("ids"), F.col("f").alias("a"))), "phrases"), known, totals


# ---------------------------------------------------------------- scores
def _decimal(name: str, digits: int):
    return F.col(name).cast(f"decimal({digits},0)")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000, lang: str = "lang", text: str = "text", **sizes) -> DataFrame:
    """The ``top`` phrases of two to ``LONGEST`` words of each language by their lowest cut's score
    (then count, then phrase): lang, rank, phrase, a, l, r, n, score."""
    phrases, known, totals = frequent_phrases(docs, least, lang, text, **sizes)
    candidates = phrases.where("size(ids) > 1")
    # contained in a longer candidate that occurs as often
    inside = candidates.where("size(ids) > 2").select("a", F.expr(
        "explode(flatten(transform(sequence(2, size(ids) - 1), m -> transform(sequence(1, size(ids) - m + 1), i -> slice(ids, i, m)))))"
    ).alias("ids")).groupBy("ids").agg(F.max("a").alias("longer"))
    left = candidates.join(inside, "ids", "left").where("longer IS NULL OR longer < a").select("ids", "a")
    # the words, the language and its size
    spelt = left.select("ids", F.posexplode("ids").alias("pos", "id")).join(known.select("id", "lang", "word"), "id")
    spelt = spelt.groupBy("ids").agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("_w"), F.first("lang").alias("lang"))
    spelt = spelt.select("ids", "lang", F.concat_ws(" ", F.transform("_w", lambda x: x["word"])).alias("phrase"))
    cuts = left.select("ids", "a", F.explode(F.expr("sequence(1, size(ids) - 1)")).alias("k"))
    cuts = cuts.withColumns({"first": F.expr("slice(ids, 1, k)"), "rest": F.expr("slice(ids, k + 1, size(ids) - k)")})
    cuts = cuts.join(phrases.select(F.col("ids").alias("first"), F.col("a").alias("l")), "first")
    cuts = cuts.join(phrases.select(F.col("ids").alias("rest"), F.col("a").alias("r")), "rest")
    # the language's size scales all cuts of a phrase alike, but rounds them: it goes in before the lowest is chosen
    cuts = cuts.select("ids", "a", "k", "l", "r").join(spelt, "ids").join(totals, "lang")
    product = F.lit(1000).cast("decimal(4,0)") * _decimal("a", 16) * _decimal("n", 18)
    cuts = cuts.withColumns({"_over": product, "_under": _decimal("l", 18) * _decimal("r", 18)}).withColumn("score", F.expr("_over div _under"))
    lowest = cuts.groupBy("lang", "ids", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("_c"))
    scored = lowest.select("lang", "phrase", "a", "_c.l", "_c.r", "n", "_c.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # a language may hold all candidates: its best are first chosen in parts
    part = scored.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(64)))
    part = part.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_r") <= top)
    best = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
