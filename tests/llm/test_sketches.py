"""Sketches: edited texts and likeness against plain sets, and awkward rows."""
import hashlib
import random
import re
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from reelkit.llm import sketches

SCHEMA = "doc_id long, text string, id string, tie string, n_chars int"


def pieces(text):
    out = re.findall(r"(?s).{1,8}", text[:64]) + re.findall(r"(?s).{1,32}", text[64:512]) + re.findall(r"[^\n]{1,128}", text[512:])
    return {xxhash.xxh64_intdigest(p.encode(), 42) & 0xFFFFFFFF for p in out}


def near(a, b):
    a, b = pieces(a), pieces(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    signed = lambda t: (h := xxhash.xxh64_intdigest(t.encode(), 42)) - (1 << 64 if h >> 63 else 0)
    own = sorted({(i if i is not None else -(1 << 63), signed(t or ""), t or "") for i, t in rows}, reverse=True)
    out, many = [], Counter((i, t or "") for i, t in rows)
    for k, (i, _, t) in enumerate(own):
        i = i if i != -(1 << 63) else None
        nxt = own[(k + 1) % len(own)][2]
        need = len(t) // 3
        edited = t[:len(t) - need] + nxt[:need]
        out += [(i, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(near(t, edited), 9), round(near(t, nxt), 9))] * many[(i, t)]
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "x", "y", 0) for i, t in rows], SCHEMA)
    got = sketches.sketches(df).collect()
    prints = {}
    for r in got:
        prints.setdefault((r.n_chars, r.doc_id), set()).add(r.fingerprint)
    return sorted([(r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got], key=str), got


def test_against_sets(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    rows = [(i * 3, " ".join(word() + ("\n" if rng.random() < .1 else "") for _ in range(rng.choice([1, 4, 30, 300, 3000])))) for i in range(60)]
    rows += [(1, None), (2, ""), (4, "é"), (5, "ab"), (7, rows[5][1]), (8, rows[5][1]), (None, "no id"), (9, "x"), (9, "x"), (9, "yy")]
    got, raw = run(spark, rows)
    assert got == brute(rows)
    by_text = {}
    for (i, t) in rows:
        by_text.setdefault(t or "", set()).update(r.fingerprint for r in raw if r.doc_id == i and r.n_chars == len(t or "") and len(t or "") > 2)
    assert all(len(v) <= 1 for t, v in by_text.items() if rows.count((9, t)) == 0)


def test_few(spark):
    assert run(spark, [(3, "one line of text")])[0] == brute([(3, "one line of text")])
    assert run(spark, [])[0] == []


def test_enlarged_on_failure(spark, monkeypatch):
    monkeypatch.setattr(sketches, "LEAST", 1)
    monkeypatch.setattr(sketches, "LOAD", 0.1)  # far too small at first: each comparison must be made again
    rows = [(i, " ".join(f"{i}w{k}" for k in range(60))) for i in range(12)]
    assert run(spark, rows)[0] == brute(rows)


def test_peeling_recovers_the_difference(spark):
    e = spark.createDataFrame([(1, 16, 1, d) for d in range(40)] + [(1, 16, -1, d) for d in range(5, 44)], "k int, size int, sign int, digest int")
    r = sketches.peel(e.repartition(4, "k"), ["k"]).first()
    assert (r.found, r.left) == (9, 0)
    assert sketches.peel(e.repartition(4, "k").filter(F.col("digest") < 0), ["k"]).count() == 0
