"""Packing, archives and the pipeline: round trips."""

from __future__ import annotations

import gzip
import hashlib
import random
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import packing, queries, token_ids, warc
from strata.llm.common import shared_path

from .helpers import BIG, awkward, documents, prose
from .test_dedup_operators import brute_components, brute_lines

SF = "/root/testdata/sf0.001"


# ---- packing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_file())


@pytest.mark.parametrize("text", [
    "", " ", "It's DON'T we'll i've 12ab_c--'s ''s 'll x", "a <|endoftext|> b", "ΣΑΣ ﬁ é é ² ½", "\x1c a\x85b\xa0c d", "Ünïcödé ÀÉ×÷ ªº€…“q”",
    "İstanbul İ", "日本語 テキスト", "x" * 3000, "!!! ??? ***&&&", "tab\tnew\nline\r\nend", "퟿", "ǅ ǆ ŉ ſ ẞ ß",
])
def test_token_ids_equal_the_library(tokenizer, text):
    ids = token_ids.TokenIds(queries.tokenizer_file(), remembered=3)
    for _ in range(2):
        assert array("I", ids.packed(text)).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_every_plain_character_inside_words_equals_the_library(tokenizer):
    ids = token_ids.TokenIds(queries.tokenizer_file())
    assert ids.split_here
    plain = [c for c in map(chr, range(0x3000)) if token_ids.PLAIN.fullmatch(c)]
    for c in [*plain, *"ƏƁƊ"]:
        for text in (f"ab{c}cd {c}ef gh{c} {c}", f"{c}{c}1'{c}s"):
            assert array("I", ids.packed(text)).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, (c, text)


def test_a_vocabulary_with_other_rules_goes_through_the_library():
    from tokenizers import Tokenizer

    path = queries.tokenizer_file("byte_bpe_50k.json")
    text = "It's DON'T 1234 we'll  i've ab_c"
    assert array("I", token_ids.TokenIds(path).packed(text)).tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def check_packed(rows, texts, tokenizer, window=2048):
    """Every id of every text once, sequences gapless and within the window; returns the padding share."""
    want = Counter()
    for d, t in texts:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for a in range(0, len(ids), window):
            piece = array("I", ids[a : a + window]).tobytes()
            want[(d, a, len(piece) // 4, zlib.crc32(piece), len(ids))] += 1
    assert Counter((x["doc_id"], x["start"], x["length"], x["ids_crc32"], x["doc_tokens"]) for x in rows) == want
    ends = defaultdict(list)
    for x in rows:
        ends[x["sequence_id"]].append((x["offset"], x["length"]))
    for places in ends.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= window
    return 1 - sum(x["length"] for x in rows) / (window * max(1, len(ends)))


def test_packing_round_trip(spark, tokenizer):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    assert check_packed(queries.op8_packing(spark, "/root/testdata/sf0.01").collect(), map(tuple, rows), tokenizer) < 0.02


def test_packing_awkward_rows_and_small_blocks(spark, tokenizer):
    rows = [*awkward(), (BIG + 1, None), (None, "x y")]
    df = documents(spark, rows)
    check_packed(packing.pack(df, queries.tokenizer_file(), block_pieces=5).collect(), rows, tokenizer)
    assert packing.pack(df.limit(0), queries.tokenizer_file()).count() == 0


def test_least_squares_mix_solves_what_can_be_solved():
    columns = packing.combinations(8)
    assert all(sum(c) == 8 for c in columns) and len(set(columns)) == len(columns) == 10
    want = np.zeros(len(columns))
    want[columns.index((3, 5))], want[columns.index((1, 2, 5))], want[columns.index((4, 4))] = 30, 10, 5
    histogram = np.zeros(8)
    for c, n in zip(columns, want):
        for x in c:
            histogram[x - 1] += n
    got = packing.least_squares_mix(histogram, columns)
    back = np.zeros(8)
    for c, n in zip(columns, got):
        for x in c:
            back[x - 1] += n
    assert (got >= 0).all() and np.allclose(back, histogram, atol=1e-5)


# ---- archives


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, _id int, _payload int, _digest string")


def test_archive_round_trip_with_segments(spark):
    big = prose(3_000, 1) + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n0\r\n\r\n" + "é" * 5_000
    rows = [(1, "http://a/ b\r\nX: y", big), (2, None, big), (3, "u", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (None, "u", "z" * 150),
            (7, "u", "z" * 150), (8, "u", prose(2_000, 2)), (8, "u", prose(2_000, 2)), (BIG, "u", "q" * 100), (BIG + 1, "u", "q" * 100), (9, "u", "p" * 99), (10, "u", "p" * 99)]
    path = shared_path(spark, "warc-test")
    warc.write_archive(pages(spark, [(*r, 7, 7, "x") for r in rows]), path, segment_bytes=700, chunk_bytes=130, records_per_file=9)
    got = [tuple(x) for x in warc.read_archive(spark, path).collect()]
    payload = lambda t: (t or "").encode()
    first = {}
    for i, _, t in rows:
        if i is not None and len(payload(t)) >= 100:
            first[t] = min(i, first.get(t, i))
    many = Counter(t for _, _, t in rows)
    want = []
    for i, _, t in rows:
        ref = first.get(t) if many[t] > 1 and first.get(t) != i else None
        want.append((i, len(payload(t)), hashlib.sha256(payload(t)).hexdigest(), "revisit" if ref is not None else "response", ref, True))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    files = [r.path for r in spark.read.format("binaryFile").load(path).select("path").collect()]
    assert len(files) > 1


def test_empty_archive(spark):
    path = shared_path(spark, "warc-empty")
    warc.write_archive(pages(spark, []), path)
    assert warc.read_archive(spark, path).count() == 0


def test_broken_segments_are_reported():
    recs = warc.page_records(5, "u", b"x" * 3_000, hashlib.sha256(b"x" * 3_000).hexdigest(), None, 500, 100)
    data = warc.END.encode().join(recs) + warc.END.encode()
    parsed = list(warc.walk(gzip.compress(data)))
    assert len(parsed) == len(recs) > 3

    class Segment:
        def __init__(self, f, b):
            self.number, self.block = int(f["warc-segment-number"]), b
            self.total = int(f.get("warc-segment-total-length", -1))
            self.fields = "\n".join(f"{k}:{v}" for k, v in f.items())

    segments = [Segment(f, b) for f, b in parsed]
    assert warc.reassembled(segments)[0][1:] == (3_000, hashlib.sha256(b"x" * 3_000).hexdigest(), "response", None, True)
    assert warc.reassembled(segments[:-1])[0] == ("5", None, None, "response", None, False)
    assert warc.reassembled(segments[:1] + segments[2:])[0][5] is False
    twice = [s for s in segments for _ in range(2)]
    assert len(warc.reassembled(twice)) == 2
    with pytest.raises(ValueError):
        warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n")


def record(kind, body, extra="", length=None, page=7):
    head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:x:{page}>\r\nX-Page-Id: {page}\r\n{extra}Content-Length: {len(body) if length is None else length}\r\n\r\n"
    return head.encode("latin-1") + body + b"\r\n\r\n"


def test_archives_of_other_writers_and_broken_ones(spark, tmp_path):
    http = "HTTP/1.1 200 OK\r\nX-Odd: caf\xe9\r\n\r\nbody one".encode("latin-1")
    good = record("response", http, "WARC-Odd: \xe9\r\nWARC-Payload-Digest: sha1:ABC\r\n")
    info = record("warcinfo", b"software: x") + record("request", b"GET / HTTP/1.1\r\n\r\n")
    bad_length = record("response", http, length=len(http) + 500, page=8)
    revisit = record("revisit", b"HTTP/1.1 304\r\n\r\n", page=9)  # says nothing of what it refers to
    text = {
        "a.warc": info + good + b"noise\r\n\r\n" + good,
        "b.warc.gz": b"".join(gzip.compress(x) for x in (info, good, good)),
        "c.warc.gz": gzip.compress(good) + gzip.compress(record("response", random.Random(1).randbytes(5000)))[:900],
        "d.warc": bad_length + good,
        "e.warc": good + b"WARC/1.0\r\nWARC-Type: respon",
        "f.warc": revisit + record("continuation", b"x", "WARC-Segment-Number: 2\r\n"),
        "g.warc": b"",
        "h.warc": record("response", http, "WARC-Segment-Number: one\r\n", page="none"),
    }
    for name, data in text.items():
        d = tmp_path / name
        d.mkdir()
        (d / name).write_bytes(data)
    read = {name: [tuple(x) for x in warc.read_archive(spark, str(tmp_path / name), "*").collect()] for name in text}
    whole = (7, 8, hashlib.sha256(b"body one").hexdigest(), "response", None, True)
    assert sorted(read["a.warc"], key=str) == sorted([whole, (None, None, None, None, None, False), whole], key=str)
    assert read["b.warc.gz"] == [whole, whole]
    assert read["c.warc.gz"][0] == whole and [x[1:] for x in read["c.warc.gz"][1:]] == [(None, None, "response", None, False)]
    assert sorted(read["d.warc"], key=str) == sorted([whole, (8, None, None, "response", None, False)], key=str)
    assert read["e.warc"][0] == whole and len(read["e.warc"]) == 2 and not read["e.warc"][1][5]
    assert [x[5] for x in read["f.warc"]] == [False, False] and read["g.warc"] == []
    assert read["h.warc"] == [(None, *whole[1:])]


def test_packing_is_the_same_in_every_run(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    one, two = ({tuple(x) for x in packing.pack(df, queries.tokenizer_file(), block_pieces=300).collect()} for _ in range(2))
    assert one == two


# ---- pipeline


def test_pipeline_stages_against_brute_force(spark):
    """Each stage judged on its own input: planted rows go, clean ones stay."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    plant = [(9001, "You are an idiot and a worthless scum, a pathetic moron. " + prose(40, 1)), (9002, prose(40, 2) + ".\n" + bench + "\n" + prose(40, 3)),
             (9003, prose(90, 4)), (9004, prose(90, 4) + " end"), (9005, None), (9006, "")]
    docs = docs.unionByName(spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in plant], docs.schema))
    for name, stage in corpus_pipeline.STAGES:
        before = {x["doc_id"]: x["text"] for x in docs.collect()}
        path = shared_path(spark, f"test-{name}")
        stage(spark, docs, SF).write.parquet(path)
        after_df = spark.read.parquet(path)
        if name == "packing":
            assert {x["doc_id"] for x in after_df.collect()} == set(before)
            break
        assert after_df.columns == docs.columns
        after = {x["doc_id"]: x["text"] for x in after_df.collect()}
        if name == "toxicity":
            labels = {x["doc_id"]: x["toxic"] for x in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            assert 9001 not in after and all(d in after for d, t in labels.items() if not t)
        if name == "line_dedup":
            want = dict(brute_lines(list(before.items()), least_words=50))
            assert after == {d: t for d, t in want.items() if t or not before[d]}
            assert after_df.where("n_chars <> length(text)").count() == 0
        if name == "ngram_join":
            want = {c if n else d for d, n, c in brute_components(list(before.items()))}
            assert set(after) == want and 9003 in after and 9004 not in after
        if name == "decontamination":
            assert 9002 not in after and 9003 in after and len(after) > 0.7 * len(before)
        docs = after_df


def test_pipeline_runs_on_awkward_and_empty_documents(spark):
    df = documents(spark, awkward())
    for docs in (df, df.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            path = shared_path(spark, f"awkward-{name}")
            stage(spark, docs, SF).write.parquet(path)
            out = spark.read.parquet(path)
            assert name == "packing" or out.columns == df.columns
            docs = out
        assert docs.where(F.col("length") < 1).count() == 0


def test_a_run_leaves_the_results_of_its_stages_alone(spark):
    import os

    from strata.session import ensure_checkpoint_dir

    folder = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "llm")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    packed = corpus_pipeline.run(spark, SF)
    left = {x for x in os.listdir(folder) if x not in before}
    assert {x.rsplit("-", 1)[0] for x in left} == {f"pipeline-{name}" for name, _ in corpus_pipeline.STAGES}
    assert packed.count() > 100
