"""Suffix, n-gram and line dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import components, line_dedup, ngram_join, queries, suffix_dedup

from .helpers import BIG, awkward, documents, prose, words

SF = "/root/testdata/sf0.001"


# ---- suffix dedup


def brute_repeats(rows, span):
    texts = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + span] for _, b in texts for i in range(len(b) - span + 1))
    out = []
    for d, b in texts:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - span + 1):
            if seen[b[i : i + span]] > 1:
                gone[i : i + span] = True
        kept = bytes(c for c, g in zip(b, gone) if not g)
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def removed(df, **settings):
    d = suffix_dedup.remove_repeats(df, **settings).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    return sorted(map(tuple, d.collect()), key=repr)


@pytest.mark.parametrize("most_segments", [50_000, 1])
def test_suffix_dedup_equals_brute_force(spark, most_segments):
    r = random.Random(3)
    passage = prose(60, 1)
    rows = [(i, prose(r.randint(0, 90), i + 10)) for i in range(30)]
    rows += [(100 + i, prose(20, 200 + i) + " " + passage[r.randint(0, 60) : r.randint(220, len(passage))] + " " + prose(20, 300 + i)) for i in range(12)]
    rows += [(200, "ab" * 400), (201, "é" * 150), (202, "ab" * 99), (203, rows[4][1]), (204, passage + passage), (205, passage[:199]), (206, passage[:200])]
    df = documents(spark, rows).repartition(5)
    assert removed(df, span=200, batch=7, most_segments=most_segments) == brute_repeats(rows, 200)


def test_suffix_dedup_on_the_table(spark):
    rows = [tuple(x) for x in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op4_suffix_dedup(spark, SF).collect()), key=repr) == brute_repeats(rows, 200)


def test_suffix_dedup_awkward_rows(spark):
    rows = [x for x in awkward() if len(x[1] or "") < 10_000] + [(BIG, "y" * 250)]
    assert removed(documents(spark, rows)) == brute_repeats(rows, 200)
    assert removed(documents(spark, rows).limit(0)) == []


def test_suffix_dedup_blocks_of_a_long_text(monkeypatch):
    """A text longer than a block gives the same windows as one block."""
    monkeypatch.setattr(suffix_dedup, "_BLOCK_BITS", 10)
    text = prose(2_000, 5).encode()
    starts = []
    for b, begin, run in suffix_dedup._blocks([b"short", text], 200):
        usable = np.ones(len(b), bool)
        for z in begin[1:]:
            usable[max(0, z - 199) : z] = False
        lo, hi, _, _ = suffix_dedup.segments(b, 200, 64, usable)
        r = np.searchsorted(begin, lo, side="right") - 1
        for a, z, k in zip(lo, hi, r):
            starts += range(run[k, 1] + a - begin[k], run[k, 1] + z - begin[k] + 1)
    assert sorted(starts) == list(range(len(text) - 199))


def test_repeated_windows_columns():
    """The column-wise order finds exactly the equal windows of equal groups."""
    r = random.Random(1)
    span, gram = 12, 4
    reach = span - gram
    bodies, offs, groups = [], [], []
    for i in range(300):
        off, tail = r.randint(0, reach), r.randint(span - reach, span)
        tail = max(tail, span - off)
        bodies.append(bytes(r.choice(b"ab") for _ in range(off)) + b"GRAM" + bytes(r.choice(b"ab") for _ in range(max(0, tail - gram))))
        offs.append(off)
        groups.append(r.randint(0, 3))
    found = suffix_dedup.repeated_windows(bodies, np.array(offs), np.array(groups), span, gram)
    windows = Counter()
    for b, o, g in zip(bodies, offs, groups):
        for s in range(len(b) - span + 1):
            windows[(g, s - o, b[s : s + span])] += 1
    for i, (b, o, g) in enumerate(zip(bodies, offs, groups)):
        for c in range(reach + 1):
            s = c - reach + o
            want = 0 <= s <= len(b) - span and windows[(g, s - o, b[s : s + span])] > 1
            assert found[i, c] == want


# ---- n-gram join


def brute_components(rows):
    fold = {i: i + 32 for i in range(65, 91)}
    sets = []
    for _, t in rows:
        w = words((t or "").translate(fold))
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j, k in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * k >= 80 * (len(s) + len(sets[j]) - k):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=repr)


def joined(df, **settings):
    d = ngram_join.jaccard_components(df, **settings).select("_id", "n_shingles", "component_id")
    return sorted(map(tuple, d.collect()), key=repr)


def near_copies(n, base, r, share=0.02):
    out = []
    for _ in range(n):
        w = base.split()
        for _ in range(max(1, int(share * len(w)))):
            w[r.randrange(len(w))] = "changed" + str(r.randrange(10**6))
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("tile,large_run", [(512, 2_000), (3, 4)])
def test_ngram_join_equals_brute_force(spark, tile, large_run):
    r = random.Random(5)
    texts = [prose(r.randint(1, 80), i) for i in range(60)]
    texts += near_copies(25, prose(200, 900), r) + near_copies(10, prose(40, 901), r, 0.05)
    common = prose(30, 902)
    texts += [common + " " + prose(10, 1000 + i) for i in range(25)]  # one passage, unlike otherwise
    texts += [texts[3].upper(), texts[3], "a b", "a b", "A  B\n"]
    rows = list(enumerate(texts))
    assert joined(documents(spark, rows).repartition(4), tile=tile, large_run=large_run) == brute_components(rows)


def test_ngram_join_awkward_rows(spark):
    rows = awkward()
    assert joined(documents(spark, rows)) == brute_components(rows)
    assert joined(documents(spark, rows).limit(0)) == []
    left = ngram_join.one_of_each(documents(spark, rows)).select("doc_id", "text").collect()
    assert Counter((x[0]) for x in left if words(x[1])) == Counter([None, 3, 4, BIG, 8])
    assert sum(not words(x[1]) for x in left) == sum(not words(t) for _, t in rows)


def test_bitmap_bound_never_under_the_overlap():
    r = np.random.default_rng(0)
    for _ in range(200):
        a = np.unique(r.integers(0, 1 << 40, r.integers(1, 400)).astype(np.uint64))
        b = np.unique(np.concatenate((r.choice(a, r.integers(0, len(a) + 1), replace=False), r.integers(0, 1 << 40, r.integers(0, 300)).astype(np.uint64))))
        if not len(b):
            continue
        k = len(np.intersect1d(a, b))
        if 100 * k >= 80 * (len(a) + len(b) - k):
            assert ngram_join.may_link(ngram_join.bitmap(a).tobytes(), ngram_join.bitmap(b).tobytes(), len(a), len(b), 80)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 140)] + [(7, 7)]
    got = {x["node"]: x["root"] for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 140))
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- line dedup


def brute_runs(lines, least_words):
    """The shortest runs of ``least_words`` words from each line that is not blank and to each such line,
    and neighbouring lines that have the words each with the blank ones between; by trying every run."""
    n = [len(words(x)) for x in lines]
    full = [i for i, k in enumerate(n) if k]
    runs = set()
    for i in full:
        runs |= {(i, z + 1) for z in full if z >= i and sum(n[i : z + 1]) >= least_words and sum(n[i:z]) < least_words}
        runs |= {(a, i + 1) for a in full if a <= i and sum(n[a : i + 1]) >= least_words and sum(n[a + 1 : i + 1]) < least_words}
    return runs | {(a, z + 1) for a, z in zip(full, full[1:]) if z - a > 1 and n[a] >= least_words and n[z] >= least_words}


def brute_lines(rows, window=2, lines_per_chunk=4, least=2, least_words=None):
    """(id, text) after removing every chunk, and with ``least_words`` every run, that stands at an earlier place."""
    from xxhash import xxh3_64_intdigest

    cut = []
    for d, t in rows:
        lines = (t or "").split("\n")
        bounds = {b for b in line_dedup.chunk_bounds([xxh3_64_intdigest(x.encode()) for x in lines], window, lines_per_chunk) if b[1] - b[0] >= least}
        if least_words is not None:
            bounds |= brute_runs(lines, least_words)
        cut.append([] if t is None else [(a, z, "\n".join(lines[a:z])) for a, z in bounds])
    # among equal ids the order of text hashes decides; the tests have no such pair with shared chunks
    first = {}
    for (d, _), pieces in zip(rows, cut):
        for a, _, body in pieces:
            first[body] = min(first.get(body, (True, float("inf"), 0)), (d is not None, d or 0, a))
    out = []
    for (d, t), pieces in zip(rows, cut):
        gone = {i for a, z, body in pieces if first[body] != (d is not None, d or 0, a) for i in range(a, z)}
        out.append((d, None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone)))
    return sorted(out, key=repr)


def test_line_dedup_equals_brute_force(spark):
    r = random.Random(2)
    passage = [prose(9, 70 + i) for i in range(14)]
    rows = []
    for i in range(40):
        lines = [prose(6, 1000 * i + k) for k in range(r.randint(1, 8))]
        if i % 2:
            lines[len(lines) // 2 : len(lines) // 2] = passage
        rows.append((i, "\n".join(lines)))
    rows += [(100, rows[1][1]), (101, rows[1][1]), (102, None), (103, ""), (104, "\n\n\n"), (None, "\n".join(passage))]
    got = line_dedup.dedup_lines(documents(spark, rows).repartition(3))
    want = brute_lines(rows)
    assert sorted(((x["doc_id"], x["text"]) for x in got.select("doc_id", "text").collect()), key=repr) == want
    assert sum(len(t or "") for _, t in want) < 0.8 * sum(len(t or "") for _, t in rows)


def test_line_chunks_move_only_near_an_insertion():
    r = random.Random(9)
    hashes = [r.getrandbits(64) for _ in range(400)]
    bodies = lambda h: {tuple(h[a:z]) for a, z in line_dedup.chunk_bounds(h, 2, 4)}
    a, b = bodies(hashes), bodies(hashes[:200] + [r.getrandbits(64)] + hashes[200:])
    assert len(a - b) <= 2 and len(b - a) <= 3


def test_line_dedup_awkward_rows(spark):
    df = documents(spark, awkward())
    got = line_dedup.dedup_lines(df)
    assert got.columns[: len(df.columns)] == df.columns
    assert Counter((x["doc_id"], x["text"]) for x in got.collect()) == Counter(awkward())
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_line_query_sums_up(spark):
    rows = queries.op10_line_dedup(spark, SF).collect()
    docs = {x["doc_id"]: x["text"] for x in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    want = dict(brute_lines(list(docs.items()), least_words=50))
    assert len(rows) == len(docs) and any(len(want[d]) < len(t) for d, t in docs.items())
    for x in rows:
        assert x["n_lines"] == len(re.split("\n", docs[x["doc_id"]]))
        assert x["kept_sha256"] == hashlib.sha256(want[x["doc_id"]].encode()).hexdigest()


def test_least_windows_cover_every_run_of_enough_words():
    r = random.Random(4)
    for _ in range(300):
        words = [r.choice([0, 1, 3, 8, 20]) for _ in range(r.randint(0, 12))]
        bounds = line_dedup.passage_bounds(words, 10)
        assert all(sum(words[a:z]) >= 10 for a, z in bounds)
        for a in range(len(words)):
            for z in range(a + 1, len(words) + 1):
                if words[a] and words[z - 1] and sum(words[a:z]) >= 10:
                    assert {i for b in bounds if a <= b[0] and b[1] <= z for i in range(*b)} == set(range(a, z))


def test_planted_passages_of_over_fifty_words_go_whole(spark):
    rows, want = [], {}
    for n in range(1, 9):
        passage = [prose(-(-52 // n) + n, 500 * n + k) for k in range(n)]
        for i in range(20):
            own = [prose(9, 100_000 * n + 50 * i + k) for k in range(6)]
            at = i % 7
            rows.append((100 * n + i, "\n".join(own[:at] + passage + own[at:])))
            want[100 * n + i] = rows[-1][1] if i == 0 else "\n".join(own)
    rows.append((5000, "\n".join(x for _, x in rows[:1]).split("\n")[-1]))  # a repeated line of 9 words stays
    want[5000] = rows[-1][1]
    got = line_dedup.dedup_lines(documents(spark, rows).repartition(3), least_words=50)
    assert {x["doc_id"]: x["text"] for x in got.collect()} == want
    again = line_dedup.dedup_lines(documents(spark, awkward()), least_words=50).collect()
    texts = [(x["doc_id"], x["text"]) for x in again]
    assert Counter(x for x in texts if x[0] != 5) == Counter(x for x in awkward() if x[0] != 5)


def test_line_query_removes_every_repeated_passage(spark):
    rows = {x["doc_id"]: x for x in queries.op10_line_dedup(spark, SF).collect()}
    docs = sorted((x["doc_id"], x["text"]) for x in spark.read.parquet(f"{SF}/documents.parquet").collect())
    seen, untouched = set(), 0
    for d, t in docs:
        lines = t.split("\n")
        for a in range(len(lines)):
            z = next((z for z in range(a + 1, len(lines) + 1) if len(" ".join(lines[a:z]).split()) >= 50), None)
            if z and lines[a].strip():
                untouched += tuple(lines[a:z]) in seen and not rows[d]["n_removed_lines"]
                seen.add(tuple(lines[a:z]))
    assert untouched == 0
