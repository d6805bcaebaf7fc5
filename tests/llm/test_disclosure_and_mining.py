"""Personal data and disclosure, collocations, hard negatives: against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import collocations as C
from strata.llm import disclosure as D
from strata.llm import hard_negatives as H
from strata.llm import queries
from tests.llm.helpers import BIG, awkward, documents, prose

SF = "/root/testdata/sf0.001"


# ---- personal data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def hard_texts():
    r = random.Random(5)
    alphabet = "0123456789" * 3 + "....--  @@@++()ab_%é𝛼Z\n\t"
    noise = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 160))) for _ in range(400)]
    ips = [" ".join(".".join(str(r.choice([0, 7, 25, 249, 255, 256, 300, "007", "0255"])) for _ in range(r.randint(3, 9))) for _ in range(6)) for _ in range(60)]
    cards = ["".join(str(r.randint(0, 9)) + r.choice(["", "", " ", "-", "  "]) for _ in range(r.randint(10, 45))) for _ in range(200)]
    return [
        *noise, *ips, *cards, "é𝛼 4111 1111-1111 1111 x", "a@b.c_d@e.f", "a@b.c%d@e-.f..g@h.i", "x@y @z.w", "+1 (377) 555-0271.", "+1-", "+12 34567890123456",
        "1." * 3000 + "1", "9" * 2000, "a" * 2000 + "@", "x@" + "y." * 3000 + "z", "1.2.3.4 " * 3000, "q@w.ee " * 700 + "é" + "+49 170 1234567 " * 500,
        "0000000000000000000255.1.1.1", "1 " * 5000, None, "",
    ]


def test_base_spans_equal_brute_force(spark):
    rows = list(enumerate(hard_texts()))
    got = D.sanitised(documents(spark, rows).select("doc_id", "text")).select("doc_id", D.span_list(F.col("_spans")).alias("s")).collect()
    assert {x["doc_id"]: x["s"] for x in got} == {d: base_spans(t) for d, t in rows}


def test_pii_query_against_brute_force(spark):
    docs = {x["doc_id"]: x["text"] for x in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op11_pii(spark, SF).collect()
    assert len(rows) == len(docs)
    for x in rows:
        want = base_spans(docs[x["doc_id"]])
        assert x["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert (x["n_email"], x["n_ip"], x["n_card"], x["n_phone"]) == tuple(len(re.findall(f"{k}:", want)) for k in BASE)
        assert x["spans"].startswith(want)


def leaking():
    """A name near an address in texts of their own; near copies of one text; clean texts."""
    rows = []
    for i in range(12):
        rows.append((i, f"{prose(30, 10 + i)} Zebediah Quorn zq@corp.example {prose(30, 90 + i)}"))
    rows += [(20 + i, f"{prose(40, 200 + i)} Zebediah Quorn {prose(5, 300 + i)}") for i in range(2)]  # without the address
    copied = prose(30, 999).split()
    for i in range(30):  # near copies: each changes a word
        w = list(copied)
        w[i % 20] = f"changed{i}"
        rows.append((100 + i, " ".join(w) + " Mirabel mm@copy.example " + prose(20, 998)))
    rows += [(500 + i, prose(60, 5000 + i)) for i in range(400)]
    return rows


def test_disclosing_terms_by_hand(spark):
    rows = leaking()
    got = {x["term"]: x for x in D.disclosing_terms(documents(spark, rows)).collect()}
    assert set(got) == {"Zebediah", "Quorn"}  # twelve of fourteen: one half, not nine in ten; the copies disclose nothing
    z = got["Zebediah"]
    assert not z["removed"] and z["entity"] == "email:zq@corp.example"
    assert z["bits_left"] == pytest.approx(np.log2(14 / 12)) and z["gain"] == pytest.approx(np.log2(len(rows) * 12 / (12 * 14)))
    out = {x["doc_id"]: x for x in D.sanitised(documents(spark, rows)).collect()}
    for d, t in rows:
        spans = [(s["kind"], t[s["start"] : s["end"]]) for s in out[d]["_spans"]]
        names = [("term", "Zebediah"), ("term", "Quorn")]
        assert spans == ([("email", "zq@corp.example"), *names] if d < 12 else names if d < 22 else [("email", "mm@copy.example")] if d < 200 else [])
        assert out[d]["_sanitised"] == (t.replace("zq@corp.example", "[email]").replace("Zebediah Quorn", "[name] [name]").replace("mm@copy.example", "[email]"))
    removed = D.sanitised(documents(spark, rows[:12] + rows[44:])).where("doc_id = 3").first()["_sanitised"]
    assert "Quorn" not in removed and "[name]" not in removed
    few = D.sanitised(documents(spark, rows), most_broadcast=0)  # the way for many terms gives the same
    assert {x["doc_id"]: (x["_spans"], x["_sanitised"]) for x in few.collect()} == {d: (x["_spans"], x["_sanitised"]) for d, x in out.items()}


def test_sql_states_the_same_on_texts_with_leaks(spark, tmp_path):
    """The query's SQL beside the query where terms do disclose."""
    import duckdb

    rows = leaking() + [(10_000 + i, t) for i, t in enumerate(hard_texts()[380:480])]
    documents(spark, rows).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    found = con.sql(queries.ORACLE["op11_pii"])
    want = sorted(found.fetchall(), key=repr)
    got = sorted((tuple(x) for x in queries.op11_pii(spark, str(tmp_path)).select(*found.columns).collect()), key=repr)
    assert got == want and sum("term" in x[-1] for x in got) == 14


def test_disclosure_awkward_rows_and_plan(spark):
    df = documents(spark, awkward())
    got = D.sanitised(df)
    assert got.columns == [*df.columns, "_spans", "_sanitised"]
    assert Counter((x["doc_id"], x["text"], x["_sanitised"]) for x in got.collect()) == Counter((d, t, t) for d, t in awkward())
    assert D.sanitised(df.limit(0)).count() == 0
    plan = queries.op11_pii(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_luhn(spark):
    rows = [("4111111111111111", True), ("4111111111111112", False), ("0", True), ("18", True), ("81", False)]
    got = spark.createDataFrame(rows, "d string, want boolean").select("want", D.luhn(F.col("d")).alias("got")).collect()
    assert all(x["want"] == x["got"] for x in got)


# ---- collocations


def brute_collocations(rows, least, top):
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for m in range(1, 6):
                counts[lang or "und"].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        longer = Counter()
        cands = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        for g, a in cands.items():
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    longer[g[i : i + m]] = max(longer[g[i : i + m]], a)
        found = []
        for g, a in cands.items():
            if longer[g] >= a:
                continue
            score, k = min((1000 * a * n[lang] // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def collocation_rows():
    r = random.Random(3)
    vocabulary = [*"the of Ä New new york city a b c d e f".split(), "w\x1cx", "é"]
    rows = [(r.choice(["en", "en", "de", None]), "".join(r.choice(vocabulary) + r.choice([" ", " ", "\t", ". ", "  ", "\n", ",", "!"]) for _ in range(r.randint(0, 80)))) for _ in range(120)]
    hot = "x y z. " * 300
    return [*rows, ("en", hot), ("en", hot), ("en", ""), ("en", None), (None, None), ("fr", "one two"), ("en", "long " * 3000), ("und", "new york")]


def spelt(df):
    return sorted(tuple(x) for x in df.collect())


@pytest.mark.parametrize("sizes", [{}, {"most_words": 50, "most_entries": 20}])
def test_collocations_equal_brute_force(spark, sizes):
    rows = collocation_rows()
    df = spark.createDataFrame([(i, lang, t, 7) for i, (lang, t) in enumerate(rows)], "doc_id long, lang string, text string, ids int").repartition(3)
    assert spelt(C.collocations(df, least=3, top=40, **sizes)) == brute_collocations(rows, 3, 40)
    assert C.collocations(df.limit(0), least=3).count() == 0
    assert C.collocations(df, least=10**9).count() == 0


def test_collocations_awkward_rows(spark):
    assert spelt(C.collocations(documents(spark, awkward()), least=2, top=30)) == brute_collocations([("en", t) for _, t in awkward()], 2, 30)


def test_long_texts_are_cut_between_words():
    data = b"ab cd. " * 50 + b"x" * 100 + b" tail"
    for most in (1, 7, 20, 64, 1000):
        parts = list(C.slices(data, most))
        assert b"".join(parts) == data and [w for p in parts for w in p.split()] == data.split()


@pytest.mark.parametrize("bits", [1, 5, 13, 25, 31, 40])
def test_phrases_survive_packing_permuting_and_the_filter(bits):
    r = np.random.default_rng(bits)
    for m in range(2, 6):
        ids = [r.integers(1, 1 << bits, 3000) for _ in range(m)]
        n_bits = bits * m
        lanes = C.permuted(C.packed(ids, bits), n_bits)
        back = C.unpacked(C.permuted(lanes, n_bits, inverse=True), bits, m)
        assert all(np.array_equal(x, y) for x, y in zip(ids, back, strict=True))
        counts = r.integers(1, 600, 3000)
        want = Counter()
        for key, n in zip(zip(*(x.tolist() for x in lanes), strict=True), counts.tolist(), strict=True):
            want[key] += n
        entries, sums = C.summed(lanes, counts, n_bits)
        keys = list(zip(*(x.tolist() for x in entries), strict=True))
        assert keys == sorted(want) and sums.tolist() == [want[k] for k in keys]
        half = len(keys) // 2
        filters = [C.to_filter([x[a:b] for x in entries], sums[a:b], n_bits, 0) for a, b in ((0, half), (half, None), (0, None)) if len(sums[a:b])]
        both, doubled = C.merged(filters, n_bits, 0)
        assert list(zip(*(x.tolist() for x in both), strict=True)) == keys and doubled.tolist() == [2 * want[k] for k in keys]


# ---- hard negatives


def brute_negatives(rows, k=5, top=10):
    seen, taken = set(), []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)
        while q and q[-1] == 0:
            q = q[:-1]
        label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
        if (i, label, q) not in seen:
            seen.add((i, label, q))
            taken.append((i, label, q))
    order = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for a in taken:
        if a[0] is None or a[0] % 100:
            continue
        scored = [(sum(p * q for p, q in zip(a[2], b[2])), b[0], b[1]) for b in taken if b != a]
        for s, p, _ in sorted((x for x in scored if x[2] == a[1]), key=order)[:k]:
            hard = sorted((x for x in scored if x[2] != a[1] and 30 * s <= 100 * x[0] <= 90 * s), key=order)[:top]
            out += [(a[0], p, r, n, s, t) for r, (t, n, _) in enumerate(hard, 1)]
    return sorted(out, key=repr)


def vectors(seed=1, n=700, dims=6):
    r = random.Random(seed)
    rows = [(i * r.choice([1, 1, 1, 5]), [round(r.gauss(0.05, 0.2), 2) for _ in range(dims)], r.choice([0, 0, 0, 0, 1, 2, 9])) for i in range(n)]
    rows += [(i, [0.25] * dims, i % 2) for i in range(900, 960)]  # ties
    rows += [rows[0], rows[0], (100, None, 1), (200, [0.1, None] * 3, 1), (300, [float("nan")] * dims, 1), (400, [float("inf")] * dims, 1), (500, [0.5] * dims, None)]
    return [*rows, (None, [0.3] * dims, 1), (600, [0.0] * dims, 0), (700, [], 0), (800, [0.5] * (dims + 2), 1), (1000, [-0.5] * dims, 2)]


def mined(spark, rows, **sizes):
    df = spark.createDataFrame([(i, v, label, 3) for i, v, label in rows], "vec_id long, embedding array<float>, label int, block int").repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = H.mine(df, F.col("vec_id") % 100 == 0, label=label, **sizes)
    return sorted((tuple(x) for x in found.collect()), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"rows_a_block": 40, "anchors_a_block": 2}])
def test_hard_negatives_equal_brute_force(spark, sizes):
    rows = vectors()
    want = brute_negatives(rows)
    assert len(want) > 100 and mined(spark, rows, **sizes) == want


def test_hard_negatives_few_rows_and_large_components(spark):
    assert mined(spark, []) == [] and mined(spark, [(100, [1.0], 1)]) == []
    big = [(100, [3.0e6, 2.0e6], 1), (1, [3.0e6, 1.0e6], 1), (2, [2.0e6, 1.0e6], 2), (3, [1.0e6, 2.0e6], 3)]
    assert mined(spark, big) == brute_negatives(big) != []
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, [(100, [3.0e30], 1), (1, [3.0e30], 1)])


def test_threshold_walk_stops_early_and_is_exact():
    r = np.random.default_rng(4)
    x = np.sort(r.integers(-50, 50, (3000, 2)), axis=0)
    block = H.Block(3000, "int64", np.arange(3000).tobytes(), np.ones(3000, bool).tobytes(), np.zeros(3000, np.int64).tobytes(),
                    x.tobytes(), np.argsort(x.T, axis=1, kind="stable").astype(np.int32).tobytes())
    asked = []
    scores = block.scores
    block.scores = lambda at, a: asked.append(len(at)) or scores(at, a)
    at, got = H.best_rows(block, np.array([3, -2]), np.ones(3000, bool), [(None, None)], 7)[0]
    every = x @ np.array([3, -2])
    order = np.lexsort((np.arange(3000), -every))[:7]
    assert np.array_equal(at, order) and np.array_equal(got, every[order])
    at, got = H.best_rows(block, np.array([1, 1]), np.ones(3000, bool), [(None, None)], 7)[0]
    assert sum(asked[-3:]) < 3000 and np.array_equal(got, np.sort(x.sum(1))[::-1][:7])


def test_query_rows_are_null_safe(spark):
    assert BIG > 0 and queries.op13_hard_negatives(spark, SF).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
