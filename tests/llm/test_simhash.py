"""SimHash: fingerprints against a plain count, links and components against all pairs."""
import random

import xxhash
from pyspark.sql import functions as F

from reelkit.llm import simhash

SCHEMA = "doc_id long, text string, fp string, key string"


def plain(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(
        {c: " " for c in (9, 10, 11, 12, 13)}).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(fps):
    """Components of (id, fp) by all pairs."""
    root = {i: i for i, _ in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in fps:
        for j, b in fps:
            if i < j and bin(a ^ b).count("1") <= 3:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i, _ in fps}


def test_rows_as_asked(spark):
    rng = random.Random(5)
    words = ["Ab", "cé", "dÉ", "x,", "the", "of", "Q"]
    texts = [None, "", " \t\n", "one", "One  two", "a\x0bb c", "word " * 70_000]
    texts += [" ".join(rng.choice(words) for _ in range(rng.randint(1, 9))) for _ in range(120)]
    texts += texts[20:30]
    rows = [(i * 3, t, "x", None) for i, t in enumerate(texts)] + [(0, None, "x", None)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute([(i, plain(t)) for i, t, *_ in rows[:-1]])
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(
        (i, f"{plain(t):016x}", want[i]) for i, t, *_ in rows)


def test_links_find_every_pair_within_three_bits(spark):
    rng = random.Random(7)
    fps = set()
    for _ in range(60):
        base = rng.getrandbits(64)
        for n in (0, 1, 2, 3, 3, 3, 4, 6):
            x = base
            for b in rng.sample(range(64), n):
                x ^= 1 << b
            fps.add(x)
    fps |= {0, 1, 7, 15, (1 << 64) - 1, ((1 << 64) - 1) ^ 0xE000000000000000}
    fps = sorted(fps)
    df = spark.createDataFrame([(simhash._signed(x),) for x in fps], "fp long")
    maybe = simhash.candidates(df)
    pairs = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if bin(a ^ b).count("1") <= 3]
    assert {simhash._signed(x) for p in pairs for x in p} <= {r.fp for r in maybe.collect()}
    found = simhash.components(simhash.links(maybe)).collect()
    got = {r.node: r.root for r in found}
    ids = [(simhash._signed(x), x) for x in fps]
    want = brute(sorted(ids))
    assert {i: got.get(i, i) for i, _ in ids} == want


def test_empty_table(spark):
    out = simhash.near_duplicates(spark.createDataFrame([], SCHEMA))
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0


def test_null_ids(spark):
    out = simhash.near_duplicates(spark.createDataFrame([(None, "a b", "", ""), (None, "z y x", "", ""), (4, "a b", "", "")], SCHEMA))
    assert sorted(out.select(F.coalesce("component_id", F.lit(-1))).collect()) == [(-1,), (4,), (4,)]
