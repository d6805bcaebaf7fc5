"""Inputs shared by the operator tests."""

from __future__ import annotations

import re

#: names that operators use inside
CLASHING = ("_row", "_id", "_fp", "_text", "_cut", "_total", "_own_id", "_w", "h", "key", "node", "_key", "nb", "cut", "_hit", "_rated")
BIG = (1 << 62) + 1


def documents(spark, rows):
    """A documents table of (doc_id, text) with extra columns of clashing names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in CLASHING)
    return spark.createDataFrame([(d, t, "en", "s", len(t or ""), *[7] * len(CLASHING)) for d, t in rows], schema)


def awkward():
    """Nulls in any column, empty and very long texts, ties, repeated rows, large ids."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    return [
        (None, None), (None, "a b c"), (None, "a b c"), (1, ""), (1, ""), (2, None), (3, "x " * 300), (3, "x " * 300),
        (4, long), (5, long + " z"), (6, "  \n\t "), (BIG, "one two three four five six seven"), (8, "The idiot said\nso many\nthings to us"),
    ]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(n, seed=0):
    """``n`` distinct-looking words."""
    import random

    r = random.Random(seed)
    parts = "an er th on re he in ed nd ha at en es of or nt ea ti to io le is ou ar as de rt ve".split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(2, 4))) for _ in range(n))
