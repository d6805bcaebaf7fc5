"""Benchmark decontamination on templates.

Texts become templates: numbers (also in words), names (capital letter, at the
start of a sentence only if it is none of its common opening words) and units
turn into typed placeholders, other words lose case and outer punctuation. A run
of equal placeholders with nothing but space between is one, so names and numbers
of more words keep their place. Windows of ``window`` template words of the documents are
hash-joined with those of the benchmark. Along each alignment of a document
with an item, the values that fill the placeholders must map one to one, so a
question asked again with other numbers is caught, and a text that merely
shares a pattern is not. A document is contaminated by an item when the
aligned windows cover at least ``least_coverage`` of the item's.

With ``verbatim``, windows are also joined by their words themselves (numbers and
names included, case and outer punctuation aside). Such a window covers its place
like a template's, its values standing for themselves, so stretches that are
mostly placeholders count; and an item all of whose words' windows are in a
document is found whatever it is made of, however short. What templates alone
find is found as well.

The benchmark's window hashes are broadcast as a filter only when they are at
most ``most_broadcast`` (8 bytes each); beyond that every window of the
documents goes through the join. Both ways give the same rows.

Defined results: null texts and texts without words match nothing; an item of
fewer than ``least_words`` words is too short for a template (with ``verbatim``,
documents that hold just these words are found), one shorter than the window is a single window; windows with fewer than half literal words, or
fewer than half of ``least_words``, have no template; repeated rows and equal ids give one row a pair; a null id is
reported as null; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import BASE, WordHasher, as_text, mix64, written

NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion dozen half twice thrice"
).split()
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms pound pounds ounce ounces ton tons "
    "ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros usd eur percent degree degrees celsius fahrenheit meter meters metre metres kmh mph volt volts watt watts"
).split()
#: words that open a sentence with a capital and are no names; those that are also names (Will, May, Mark) are left out
OPENERS = (
    "a an the this that these those there here it its he she they we you his her their our your my me him them us "
    "who whom whose what when where which why how whether if unless until while although though because since as so then thus "
    "hence therefore however moreover otherwise instead also and or but nor yet for to of in on at by with from into onto over under "
    "after before during between among about above below across along around against through without within beyond behind near per "
    "is are was were be been being am do does did done has have had having can could shall should would might must let lets "
    "all any both each every either neither none no not some many much more most few fewer less least several other another such "
    "same only just even still again once now today yesterday tomorrow soon later next last first second third finally initially "
    "suppose assume given consider find compute calculate determine evaluate solve show prove write give explain describe choose "
    "select name state list use simplify express answer question problem solution note together altogether yes please "
    "one's it's he's she's that's there's what's who's let's they're we're you're i'm i've i'll don't doesn't isn't aren't "
    "according originally everyone someone anyone nobody everything something nothing"
).split()
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_ENDS_SENTENCE = np.zeros(256, bool)
_ENDS_SENTENCE[list(b'.!?:;"')] = True
NUMBER, NAME, UNIT = (np.uint64(x) for x in (0x1111111111111111, 0x2222222222222222, 0x3333333333333333))


class Templates:
    """Template words of UTF-8 texts laid end to end, on whole byte arrays."""

    def __init__(self) -> None:
        self.hasher = WordHasher()
        self.numbers = np.sort(self._hashes(NUMBER_WORDS))
        self.units = np.sort(self._hashes(UNITS))
        self.openers = np.sort(self._hashes(OPENERS))

    def _hashes(self, words: list[str]) -> np.ndarray:
        return self.hasher.words(" ".join(words).encode())[0]

    def of(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(template hash, value hash, start byte) of each template word; a placeholder's
        template hash is its type's, its value hash that of its word or words."""
        template, value, start, joined = self.single(data)
        if not joined.any():
            return template, value, start
        head = np.flatnonzero(~joined)
        place = np.arange(len(value)) - head[np.cumsum(~joined) - 1]
        runs = np.add.reduceat(mix64(value + place.astype(np.uint64) * np.uint64(BASE)), head)
        return template[head], np.where(np.diff(np.append(head, len(value))) > 1, runs, value[head]), start[head]

    def single(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(template hash, value hash, start byte, whether it goes on the placeholder before) of each word."""
        b = np.frombuffer(data, np.uint8)
        empty = np.empty(0, np.uint64)
        none = empty, empty, np.empty(0, np.int64), np.empty(0, bool)
        if not len(b):
            return none
        # lower case: ASCII, and the capitals of the Latin-1 block (0xC3 then 0x80-0x9E)
        after = np.concatenate(([False], b[:-1] == 0xC3))
        latin = after & (b >= 0x80) & (b <= 0x9E) & (b != 0x97)
        upper = (b >= 65) & (b <= 90)
        low = np.where(upper | latin, b + np.uint8(32), b)
        gap = (b == 32) | ((b >= 9) & (b <= 13))
        edge = np.diff(np.concatenate(([True], gap, [True])).astype(np.int8))
        start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if not len(start):
            return none
        lines = np.cumsum(b == 10)
        first = np.ones(len(start), bool)  # of its sentence
        first[1:] = _ENDS_SENTENCE[b[end[:-1] - 1]] | (lines[start[1:]] > lines[end[:-1] - 1])
        begun, ended = start, end
        while (outer := (start < end) & _PUNCTUATION[b[np.minimum(start, len(b) - 1)]]).any():
            start = start + outer
        while (outer := (start < end) & _PUNCTUATION[b[end - 1]]).any():
            end = end - outer
        keep = start < end
        bare = ~first  # nothing but space between this word and the one before
        bare[1:] &= (start[1:] == begun[1:]) & (end[:-1] == ended[:-1]) & keep[:-1]
        start, end, first, bare = start[keep], end[keep], first[keep], bare[keep]
        if not len(start):
            return none
        value = self.hasher.spans(low, start, end)
        lead = b[start]
        capital = upper[start] | ((lead == 0xC3) & latin[np.minimum(start + 1, len(b) - 1)])
        template = value.copy()
        # a second capital means a shouted word, not a name
        opens = first & _within(value, self.openers)
        template[capital & ~opens & (end - start > 1) & ~upper[np.minimum(start + 1, len(b) - 1)]] = NAME
        template[_within(value, self.units)] = UNIT
        template[((lead >= 48) & (lead <= 57)) | _within(value, self.numbers)] = NUMBER
        joined = bare & _slot(template)
        joined[0] = False
        joined[1:] &= template[1:] == template[:-1]
        return template, value, start, joined


def _within(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)
    return ordered[at] == x


#: kinds of windows: of template words; of what stands in the places of template words; of the text's words
TEMPLATE, FILLED, WORDS = 0, 1, 2


def literal_hashes(value: np.ndarray, k: int, kind: int) -> np.ndarray:
    """Hash of each window of ``k`` values."""
    n = len(value) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, k + 1000 * kind, np.uint64)
    for i in range(k):
        h = mix64(h * np.uint64(BASE) + value[i : i + n])
    return h


def _slot(template: np.ndarray) -> np.ndarray:
    return (template == NUMBER) | (template == NAME) | (template == UNIT)


def window_hashes(template: np.ndarray, k: int, least_words: int = 0) -> np.ndarray:
    """Hash of each window of ``k`` template words; 0 where under half of them, or of ``least_words``, are literal."""
    n = len(template) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.full(n, k, np.uint64)
    for i in range(k):
        h = mix64(h * np.uint64(BASE) + template[i : i + n])
    filled = np.concatenate(([0], np.cumsum(_slot(template))))
    h[2 * (k - filled[k:] + filled[:-k]) < max(k, least_words)] = 0
    return h


def _slots(template: np.ndarray, value: np.ndarray, at: int, k: int) -> list[int]:
    return value[at : at + k][_slot(template[at : at + k])].astype(np.int64).tolist()


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int, least_words: int, verbatim: bool = False) -> DataFrame:
    """(item_id, kind, size, item_at, h, item_slots, windows, places) of every compared window of the
    benchmark; ``windows`` of its kind, ``places`` with or without a template."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        templates = Templates()
        for pdf in batches:
            rows = []
            for item, text in zip(pdf["_id"], pdf["_text"]):
                data = (text or "").encode()
                template, value, _ = templates.of(data)
                words = templates.single(data)[1]
                if verbatim and len(words):
                    k = min(window, len(words))
                    h = literal_hashes(words, k, WORDS).astype(np.int64).tolist()
                    rows += [(item, WORDS, k, i, x, [], len(h), len(h)) for i, x in enumerate(h)]
                if len(words) < least_words:
                    continue
                k = min(window, len(template))
                h = window_hashes(template, k, least_words)
                at, n = np.flatnonzero(h), len(h)
                rows += [(item, TEMPLATE, k, int(i), int(h[i].astype(np.int64)), _slots(template, value, i, k), len(at), n) for i in at]
                if verbatim:
                    h = literal_hashes(value, k, FILLED).astype(np.int64).tolist()
                    rows += [(item, FILLED, k, i, x, _slots(template, value, i, k), n, n) for i, x in enumerate(h)]
            yield pd.DataFrame(rows, columns=["item_id", "kind", "size", "item_at", "h", "item_slots", "windows", "places"])

    return items.select(as_text(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInPandas(
        cut, "item_id string, kind int, size int, item_at int, h long, item_slots array<long>, windows long, places long"
    ).withColumn("item_id", F.col("item_id").cast("long"))


def document_windows(docs: DataFrame, sizes: list[tuple[int, int]], wanted: dict[tuple[int, int], np.ndarray] | None) -> DataFrame:
    """(_id, _fp, kind, size, at, h, slots) of the documents' windows of these kinds and sizes;
    with ``wanted`` (sorted hashes by kind and size), only of those whose hash it has.
    ``slots`` is null where the item's values stand for themselves."""
    handed = docs.sparkSession.sparkContext.broadcast(wanted)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        templates, asked = Templates(), handed.value
        sieve = {}
        for k, hashes in (asked or {}).items():  # one bit a hash's low bits: spares most searches
            sieve[k] = np.zeros(1 << 22, bool)
            sieve[k][hashes & np.uint64((1 << 22) - 1)] = True
        for pdf in batches:
            ids, fps = pdf["_id"], pdf["_fp"].to_numpy()
            for lo, hi, data, begins in _joined(pdf["_text"]):
                template, value, start = templates.of(data)
                words, begin = templates.single(data)[1:3] if any(kind == WORDS for kind, _ in sizes) else (value, start)
                for kind, k in sizes:
                    h = window_hashes(template, k) if kind == TEMPLATE else literal_hashes(value if kind == FILLED else words, k, kind)
                    if not len(h):
                        continue
                    doc = np.searchsorted(begins, begin if kind == WORDS else start, side="right") - 1
                    first = np.searchsorted(doc, np.arange(hi - lo))
                    ok = doc[: len(h)] == doc[k - 1 :]
                    if kind == TEMPLATE:
                        ok &= h != 0
                    if asked is not None:
                        ok &= sieve[kind, k][h & np.uint64((1 << 22) - 1)]
                    at = np.flatnonzero(ok)
                    if asked is not None:
                        at = at[_within(h[at], asked[kind, k])]
                    if len(at):
                        d = doc[at]
                        yield pd.DataFrame({
                            "_id": ids.iloc[lo + d].array, "_fp": fps[lo + d], "kind": np.int32(kind), "size": np.int32(k),
                            "at": (at - first[d]).astype(np.int32), "h": h[at].astype(np.int64),
                            "slots": [_slots(template, value, i, k) if kind == TEMPLATE else None for i in at],
                        })

    found = docs.select(as_text("_id").alias("_id"), "_fp", "_text").mapInPandas(cut, "_id string, _fp long, kind int, size int, at int, h long, slots array<long>")
    return found.withColumn("_id", F.col("_id").cast("long"))


def _joined(texts: pd.Series, most: int = 1 << 20) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """Runs of whole texts of about ``most`` bytes, each text on a line of its
    own: (first, end, bytes, start byte of each)."""
    held: list[bytes] = []
    size = lo = 0
    for i, t in enumerate(texts):
        held.append((t or "").encode())
        size += len(held[-1])
        if size >= most or i + 1 == len(texts):
            lengths = np.array([len(x) + 1 for x in held])
            yield lo, i + 1, b"\n".join(held), np.concatenate(([0], np.cumsum(lengths)[:-1]))
            held, size, lo = [], 0, i + 1


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
    window: int = 8, least_words: int = 5, least_coverage: float = 0.6, most_broadcast: int = 4_000_000,
    verbatim: bool = False,
) -> DataFrame:
    """(_id, _fp, item_id, n_windows, coverage, n_slots) of contaminated documents; ``_fp`` hashes the text."""
    known = written(item_windows(items, item_id_col, item_text_col, window, least_words, verbatim), "item-windows")
    sizes = sorted((r["kind"], r["size"]) for r in known.select("kind", "size").distinct().collect())  # at most 3 * `window`
    hashes = known.select("kind", "size", "h").distinct()
    wanted = None
    if hashes.count() <= most_broadcast:
        got = hashes.toPandas()
        wanted = {(a, k): np.sort(got["h"][(got["kind"] == a) & (got["size"] == k)].to_numpy().astype(np.uint64)) for a, k in sizes}
    base = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(F.col(text_col)).alias("_fp"), F.col(text_col).alias("_text"))
    # ways to cover an item: its templates; its places, by template or by value; all of its words
    ways = F.when(F.col("kind") == TEMPLATE, F.array(F.lit(TEMPLATE), F.lit(FILLED))).otherwise(F.array("kind"))
    met = (
        document_windows(base, sizes, wanted).join(known, ["h", "kind", "size"])
        .withColumns({"slots": F.coalesce("slots", "item_slots"), "way": F.explode(ways if verbatim else F.array("kind"))})
    )
    aligned = (
        met.groupBy("_id", "_fp", "item_id", "way", (F.col("at") - F.col("item_at")).alias("shift"))
        .agg(
            F.collect_set("item_at").alias("places"),
            F.array_distinct(F.flatten(F.collect_set(F.arrays_zip("item_slots", "slots")))).alias("pairs"),
            F.max(F.when(F.col("way") == FILLED, F.col("places")).otherwise(F.col("windows"))).alias("windows"),
        )
        .where(
            (F.size(F.array_distinct("pairs.item_slots")) == F.size("pairs")) & (F.size(F.array_distinct("pairs.slots")) == F.size("pairs"))
        )
    )
    return (
        aligned.groupBy("_id", "_fp", "item_id", "way")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_set("places")))).cast("long").alias("n_windows"),
            F.max("windows").alias("windows"), F.max(F.size("pairs")).cast("long").alias("n_slots"),
        )
        .withColumn("coverage", F.col("n_windows") / F.col("windows"))
        .where(F.col("coverage") >= F.when(F.col("way") == WORDS, 1.0).otherwise(least_coverage))
        .groupBy("_id", "_fp", "item_id").agg(F.max(F.struct("coverage", "n_windows")).alias("most"), F.max("n_slots").alias("n_slots"))
        .select("_id", "_fp", "item_id", "most.n_windows", "most.coverage", "n_slots")
    )
