"""Repeats: the sort against sorted(), removals against a scan of all strings."""
import hashlib
import random

import numpy as np
import xxhash

from reelkit.llm import suffixes
from reelkit.llm.anchors import Prefixes

SCHEMA = "doc_id long, text string, tag string, g string, n_bytes int"


def brute(rows, length=100):
    seen, out = set(), []
    for i, t in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        data = (t or "").encode()
        gone = np.zeros(len(data), bool)
        for x in range(len(data) - length + 1):
            w = data[x:x + length]
            if w in seen:
                gone[x:x + length] = True
            seen.add(w)
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(data) else 0
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out += [(i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] * rows.count((i, t))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, t, "x", "y", 0) for i, t in rows], SCHEMA)
    return sorted([tuple(r) for r in suffixes.remove_repeats(df, **kw).collect()], key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 6)))
    prose = lambda n: " ".join(word() for _ in range(n))
    shared = [prose(n) for n in (20, 25, 30, 60, 120)]
    rows = []
    for i in range(60):
        bits = [prose(rng.randint(0, 30)) for _ in range(3)]
        for s in rng.sample(shared, rng.randint(0, 3)):
            a = rng.randint(0, 40)
            bits.insert(rng.randint(0, len(bits)), s[a:] if rng.random() < .5 else s[:len(s) - a])
        rows.append((i * 2, " ".join(bits)))
    rows += [(200 + i, rows[i][1]) for i in range(6)]
    rows += [(300 + i, rows[i][1][:150] + "X" + rows[i][1][151:]) for i in range(10, 20)]
    return rows


def test_against_scan(spark):
    rows = corpus(1)
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, large=1) == brute(rows)  # every group by the aggregate


def test_contexts_whose_hashes_all_collide(spark):
    rows = corpus(2)
    assert run(spark, rows, bits=0) == brute(rows)  # a collision for every two contexts of a string
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")  # no two texts meet in a batch
    try:
        assert run(spark, rows, bits=0) == run(spark, rows) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_one_anchor_a_context_leaves_a_batch():
    import pyarrow as pa
    shared = "".join(random.Random(5).choices("abcdefgh ", k=600)).encode()
    texts = [shared] * 50 + [b"other " + shared]
    batch = pa.RecordBatch.from_pydict({"doc": list(range(51)), "tag": [0] * 51, "text": texts})
    rows = [r for b in suffixes._anchors(24, 100)([batch]) for r in b.to_pylist()]
    sent = [r for r in rows if not r["end"]]
    assert len({(r["g"], r["c"], r["v"]) for r in sent}) == len(sent) and sum(r["doc"] > 0 for r in sent) <= 8
    assert {(r["doc"], r["loc"], r["end"]) for r in rows if r["end"] and r["doc"] < 50} == {(i, 0, 600) for i in range(1, 50)}


def test_periodic_and_awkward_rows(spark):
    rows = [(1, None), (2, ""), (3, "x" * 99), (4, "x" * 100), (5, "x" * 5000), (6, "ab" * 900), (7, "Erti " * 400 + "end"),
            (8, "é" * 300), (None, "q" * 120 + "z"), (9, "q" * 120), (10, "Erti " * 30), (11, "t" * 50 + "Erti " * 40)]
    assert run(spark, rows) == brute(rows)


def test_equal_rows_are_one_document(spark):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdef ") for _ in range(400))
    rows = [(5, text), (5, text), (6, text[50:300] + "end")]
    got = run(spark, rows)
    assert got == brute(rows) and [r[2] for r in got if r[0] == 5] == [0, 0]


def test_empty_and_full(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([(1, "ab" * 80, "", "", 0)], SCHEMA)
    r = suffixes.remove_repeats(df, full=True).first()
    assert bytes(r.kept) == b"ab" and [tuple(x) for x in r.removed] == [(2, 160)]


def test_sort_of_suffixes():
    rng = random.Random(2)
    groups = [[bytes(rng.choices(b"ab", k=rng.randint(0, 12))) for _ in range(rng.choice([1, 2, 7, 40]))] for _ in range(50)]
    flat = [x for g in groups for x in g]
    size = np.array([len(x) for x in flat])
    group = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    px = Prefixes(np.frombuffer(b"".join(flat) + b"\0", np.uint8))
    order, lcp = suffixes.sort_suffixes(px, np.cumsum(size) - size, size, group)
    at = 0
    for g in groups:
        got = [flat[i] for i in order[at:at + len(g)]]
        assert got == sorted(g) and lcp[at] == -1
        for k in range(1, len(g)):
            x, y = got[k - 1], got[k]
            assert lcp[at + k] == next((i for i, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))
        at += len(g)


def test_collisions_fall_back_on_bytes(monkeypatch):
    px = Prefixes(np.frombuffer(b"abacabad\0", np.uint8))
    px.prefix = np.zeros_like(px.prefix)  # every hash collides
    start, size = np.array([0, 4, 2]), np.array([4, 4, 2])
    order, lcp = suffixes.sort_suffixes(px, start, size, np.zeros(3, int))
    assert order.tolist() == [0, 1, 2] and lcp.tolist() == [-1, 3, 1]


def brute_without_ids(texts, length=100):
    """As ``brute``, for rows without an id: in the order of their texts' hashes, a document each."""
    seen, out = set(), []
    for t in sorted(texts, key=lambda t: np.uint64(xxhash.xxh64_intdigest(t.encode(), 42)).astype(np.int64)):
        data = t.encode()
        gone = np.zeros(len(data), bool)
        for x in range(len(data) - length + 1):
            w = data[x:x + length]
            if w in seen:
                gone[x:x + length] = True
            seen.add(w)
        spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(data) else 0
        out.append((None, len(data), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(data, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def test_thousands_of_rows_without_id(spark):
    rng = random.Random(11)
    prose = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    shared = [prose(150) for _ in range(400)]
    texts = [prose(rng.randint(0, 60)) + rng.choice(shared)[rng.randint(0, 30):] + prose(rng.randint(0, 60)) for _ in range(3000)]
    texts += texts[:40] * 2 + ["short"] * 3 + [""] * 2
    got = run(spark, [(None, t) for t in texts])
    want = brute_without_ids(texts)
    assert got == want
    assert sum(r[1] == r[2] for r in want if r[1]) >= 80  # later copies lose all
    few = texts[:150] + texts[:20]
    assert run(spark, [(None, t) for t in few], large=1) == brute_without_ids(few)
    once = sorted(set(texts))[:600]
    assert run(spark, [(7, t) for t in once]) == sorted([(7, *r[1:]) for r in brute_without_ids(once)], key=str)


def test_full_rows_without_id(spark):
    text = "".join(random.Random(4).choices("abcdefgh ", k=300))
    df = spark.createDataFrame([(None, text, str(i), "", 0) for i in range(3)] + [(1, text + "end", "3", "", 0)], SCHEMA)
    got = sorted(((r.kept_text, [tuple(x) for x in r.removed], r.others.tag == "3") for r in suffixes.remove_repeats(df, full=True).collect()), key=str)
    assert got == sorted([(text, [], False), ("", [(0, 300)], False), ("", [(0, 300)], False), ("end", [(0, 300)], True)], key=str)
