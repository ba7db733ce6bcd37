"""Personal data: base spans against Python's patterns, places in code points, what the trees add, and awkward rows."""
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from reelkit.llm import pii

SCHEMA = "doc_id long, text string, kind string, spans int, base string"
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(s):
    d = [int(x) for x in s][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def base(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) < 256 for x in m[0].split(".")) if kind == "ip" else 0,
                  "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA).repartition(3)


def check(spark, rows):
    got = pii.personal_data(frame(spark, rows)).collect()
    want = {}
    for i, t in rows:
        b = base(t)
        want.setdefault(i, []).append((*[sum(k == x[0] for x in b) for k in PATTERNS],
                                       hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in b).encode()).hexdigest()))
    assert len(got) == len(rows)
    for i in want:
        assert sorted((r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got if r.doc_id == i) == sorted(want[i])
    order = list(PATTERNS)
    for r in got:
        spans = [x.split(":") for x in r.spans.split(",") if x]
        assert spans == sorted(spans, key=lambda x: (order.index(x[0]), int(x[1]), int(x[2])))
        assert r.n_added == len(spans) - (r.n_email + r.n_ip + r.n_card + r.n_phone)
    return {r.doc_id: r for r in got}


def number(rng, ok=True):
    while True:
        s = "".join(rng.choice("0123456789") for _ in range(16))
        if luhn(s) == ok:
            return s


def test_base_against_python(spark):
    rng = random.Random(4)
    alphabet = ["a", "b", "@", ".", "-", "+", "_", " ", "(", ")", "1", "2", "25", "6", "0", "\n", "é", "\U0001f600", ","]
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(160)))) for i in range(600)]
    rows += [(2000, "a@b.c_d@e.f.g. x@y z@-.-"), (2001, "1.2.3.4.5.6.7.8 256.1.1.1 001.2.3.0255"), (2002, "+1 (2) 3-4.5 6 7 8) +12345678+1"),
             (2003, "\U0001f600é " + number(rng) + " x@y.z\U0001f600 4-" + number(rng)), (2004, None), (2005, ""), (None, "q@r.st"),
             (2006, "x" * 3000 + "@" + "7" * 900 + ".a" * 900), (2007, "9" * 3000 + " 1.1.1." + "2" * 2000),
             (2008, "10.0.0.1 " * 2000), (2009, "a@b.cd"), (2009, "a@b.cd"), (2010, "+" * 5000 + "1" + "(" * 9000)]
    check(spark, rows)


def test_trees_add_cards_that_stand_together_and_no_decoys(spark):
    rng = random.Random(9)
    rows, extra = [], {}
    for i in range(240):
        kind = i % 6
        text = f"Some plain words of text, number {i % 7}. "
        if kind == 0:
            text += f"pay by {number(rng)} today. "
        elif kind == 1:
            text += f"order {number(rng, False)} was sent. "
        elif kind == 2:
            text += f"call +1 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)} now. "
        elif kind == 3:
            text += f"see {rng.randrange(256)}.{rng.randrange(256)}.{rng.randrange(256)}.9 or n{i}@mail.example.org "
        elif kind == 4 and i % 4 == 0:
            a, b = number(rng), number(rng)
            start = len(text)
            text += f"{a} {b} end"
            extra[i] = {f"card:{start}:{start + 16}", f"card:{start + 17}:{start + 33}"}
        rows.append((i, text))
    got = check(spark, rows)
    for i, r in got.items():
        added = set(r.spans.split(",")) - {f"{k}:{s}:{e}" for k, s, e in base(dict(rows)[i])} - {""}
        assert added == extra.get(i, set()), i
    assert check(spark, rows[:1] * 3 + [(7, None)])[7].spans == ""


def test_very_long_runs(spark):
    n = 300_000
    rows = [(1, "x" * n + "@" + "7" * n + ".a" * n), (2, "9" * n + " 1.1.1." + "2" * n), (3, "+" * n + "1" + "(" * n), (4, "1 " * n), (5, "a.b" * n)]
    got = {r.doc_id: r.spans for r in pii.personal_data(frame(spark, rows)).collect()}
    assert got == {1: f"email:0:{4 * n + 1}", 2: "", 3: "", 4: "", 5: ""}


def test_many_matches_in_one_text(spark):
    n = 6000
    text = "ü 1.2.3.4 " * n
    got = frame(spark, [(1, text)]).select(pii.occurrences(F.col("text"), pii.BASE[1]).alias("o")).first().o
    assert [(s.start, s.end) for s in got] == [(10 * i + 2, 10 * i + 9) for i in range(n)]
    assert got[1].left.endswith("1.2.3.4 ü ") and got[1].right.startswith(" ü 1.2.3.4")


def test_sums_before_and_search(spark):
    df = spark.createDataFrame([(i, list(range(i))) for i in (0, 1, 2, 3, 5, 17, 100)], "i int, x array<int>")
    for r in df.select("x", pii.sums_before(F.col("x")).alias("s")).collect():
        assert r.s == [sum(r.x[:k]) for k in range(len(r.x))]
    spans = [(3, 5), (5, 9), (20, 21)]
    df = spark.createDataFrame([(a, spans) for a in range(25)] + [(0, [])], "at int, s array<struct<start:int,end:int>>")
    for r in df.select("at", "s", pii.first_ending_after(F.col("s"), F.col("at")).alias("k")).collect():
        assert r.k == next((k for k, (_, e) in enumerate(r.s) if e > r.at), len(r.s))


def test_empty(spark):
    assert pii.personal_data(frame(spark, [])).count() == 0
    r = check(spark, [(1, "clean text"), (2, None)])
    assert all(x.spans == "" and x.n_added == 0 for x in r.values())


@pytest.mark.parametrize("good", [True, False])
def test_luhn(spark, good):
    rng = random.Random(good)
    numbers = [number(rng, good)[k:] + "" for k in (0,) for _ in range(20)] + (["79927398713"] if good else ["79927398710"])
    df = spark.createDataFrame([(x,) for x in numbers], "n string")
    assert {r[0] for r in df.select(pii.luhn(F.col("n"))).collect()} == {good}
