"""Vector codes: rounds against a full rescan, the whole operator against a plain loop, and awkward rows."""
import hashlib
import math

import numpy as np

from reelkit.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label string, code string, v int, dist string"


def plain(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error) sorted, and the digest, by comparing every entry in every round."""
    rows = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    rows = [r for r in rows if len(r[1]) == len(rows[0][1])]
    d = len(rows[0][1])
    width = -(-d // parts)
    limit = int(2 ** 30 / math.sqrt(d))
    v = [[math.floor(min(limit, max(-limit, 4096 * x))) for x in r[1]] + [0] * (width * parts - d) for r in rows]
    cut = [[tuple(x[p * width:(p + 1) * width]) for p in range(parts)] for x in v]
    book = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(part, p):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), i) for i, e in enumerate(book[p]))

    for _ in range(rounds):
        at = [[near(c[p], p)[1] for p in range(parts)] for c in cut]
        for p in range(parts):
            for e in range(len(book[p])):
                own = [c[p] for c, a in zip(cut, at, strict=True) if a[p] == e]
                if own:
                    book[p][e] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    found = [[near(c[p], p) for p in range(parts)] for c in cut]
    errors = [sum(f[0] for f in x) for x in found]
    by_label = {}
    for r, e in zip(rows, errors, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    keep = [width] * (parts - 1) + [width - (width * parts - d)]
    digest = hashlib.sha256(",".join(str(x) for p in range(parts) for e in book[p] for x in e[:keep[p]]).encode()).hexdigest()
    out = [(r[0], "".join(f"{f[1]:02x}" for f in x), e, by_label[r[2]]) for r, x, e in zip(rows, found, errors, strict=True)]
    return sorted(out, key=str), digest


def check(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, label, "x", 1, "y") for i, v, label in rows], SCHEMA).repartition(3)
    got = codes.codes(df, **kw).collect()
    rows = [(i, v and [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    want, digest = plain(rows, **kw)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=str) == want
    assert {r.codebooks_sha256 for r in got} == {digest}


def test_only_moved_entries_are_compared():
    rng = np.random.default_rng(3)
    v = rng.integers(-6, 7, (400, 4, 2))  # few values, so that ties are many
    book = v[:9].transpose(1, 0, 2).copy()
    code, dist = np.zeros((400, 4), np.int64), np.zeros((400, 4), np.int64)
    few, full = codes.assign(v, None, book, code, dist)
    assert few == 0 and full == 400 * 4 * 9
    for step in range(6):
        new = book.copy()
        for p in range(4):
            for e in rng.choice(9, 2, replace=False):
                new[p, e] += rng.integers(-2, 3, 2)
        few, full = codes.assign(v, book, new, code, dist)
        d = ((v[:, :, None, :] - new[None]) ** 2).sum(axis=3)
        assert (code == d.argmin(axis=2)).all() and (dist == d.min(axis=2)).all()
        assert few + full < 400 * 4 * 9 * 3 // 4, step
        book = new


def test_against_plain_loop(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 0.3, 16).tolist(), str(i % 4) if i % 9 else None) for i in range(120)]
    check(spark, rows, parts=8)
    check(spark, rows, parts=4, entries=5, rounds=2)


def test_ties_repeats_nulls(spark):
    grid = [[float(i // 4 % 2) / 4096, float(i % 3) / 4096] * 4 for i in range(40)]
    rows = [(i % 30, grid[i], "a") for i in range(40)] + [(None, [0.0] * 8, None), (-5, None, "a"), (-4, [], "a"),
            (-3, [math.nan] + [0.0] * 7, "b"), (-2, [math.inf] * 8, None), (-1, [None] + [1.0] * 7, "b"), (50, [1.0] * 4, "b")]
    check(spark, rows, parts=8)


def test_few_rows_lengths_and_large_components(spark):
    check(spark, [(3, [0.25, -0.5, 1e30, -1e30, 2.5], "a"), (1, [0.1, 0.2, 0.3, 0.4, 0.5], "b")], parts=2)
    assert codes.codes(spark.createDataFrame([], SCHEMA)).count() == 0
    none = spark.createDataFrame([(1, None, "a", "", 0, "")], SCHEMA)
    assert codes.codes(none).collect() == []


def test_one_vector_many_times(spark):
    same = [0.5, -0.25] * 4
    check(spark, [(i, same if i % 3 else [i / 100] * 8, "l") for i in range(90)], parts=8)
