"""Importance resampling: features against zlib over single documents, the whole operator against a plain version."""
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

from reelkit.llm import resampling

SCHEMA = "doc_id long, text string, bucket long, n string, score double"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def grams(text):
    w = WORD.findall((text or "").translate(LOWER))
    return w, [" ".join(w[i:i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def bucket(g):
    return zlib.crc32(g.encode()) % 10_000


def plain(docs, target):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(map(bucket, grams(x)[1]))
    for x in target:
        t.update(map(bucket, grams(x)[1]))
    ns, nt = sum(s.values()), sum(t.values())
    rows = []
    for i, x in docs:
        w, g = grams(x)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (ns + 10_000) / ((s[b] + 1) * (nt + 10_000)))) for b in map(bucket, g))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(w), len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    ok = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2]))
    drawn = ok[:5 * len(ok) // 100]
    out = Counter((r[0], r[2], r[3], r[4], None) for r in rows)
    for k, r in enumerate(drawn, 1):
        out[(r[0], r[2], r[3], r[4], None)] -= 1
        out[(r[0], r[2], r[3], r[4], k)] += 1
    return +out


def check(spark, docs, target):
    df = spark.createDataFrame([(i, t, 1, "x", 0.5) for i, t in docs], SCHEMA).repartition(3)
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(df, bench).collect()
    assert Counter(tuple(r) for r in got) == plain(docs, target)


TEXTS = ["", "Ab ab AB", "é É ÀB\x7fà", "a\x00b\x00c d", "one", "x" * 70_000 + " " + "y z " * 500, "日本 語x9 ß" * 9, "퟿\U0001f600 k",
         "a b c d e f g h i j k l m n o p q r s t", "The quick BROWN fox-jumps over_the lazy dog 12.5 " * 6]


def test_features_cross_no_document_and_no_block_edge(monkeypatch):
    for words in (1, 2, 3, 7, 1 << 18):
        monkeypatch.setattr(resampling, "WORDS", words)
        got, own = [Counter() for _ in TEXTS], Counter()
        for doc, b, of in resampling.features([t.encode() for t in TEXTS if words > 2 or len(t) < 5000]):
            own.update(of.tolist())
            for d, x in zip(doc.tolist(), b.tolist(), strict=True):
                got[d][x] += 1
        some = [t for t in TEXTS if words > 2 or len(t) < 5000]
        assert got[:len(some)] == [Counter(map(bucket, grams(t)[1])) for t in some]
        assert [own[i] for i in range(len(some))] == [len(grams(t)[0]) for t in some]
    assert list(resampling.features([])) == [] and list(resampling.features([b"", b" "])) == []


def test_joined_crc():
    a, b = [b"", b"x", b"word" * 300], [b"yy", b"z" * 5000, b"q"]
    got = resampling.joined_crc(np.array([zlib.crc32(x) for x in a], np.uint32), np.array([zlib.crc32(x) for x in b], np.uint32),
                                np.array([len(x) for x in b]))
    assert got.tolist() == [zlib.crc32(x + b" " + y) for x, y in zip(a, b, strict=True)]


def test_against_plain(spark):
    words = [f"w{i % 13}{'é' if i % 5 == 0 else ''}" for i in range(4000)]
    docs = [(i, " ".join(words[i * 7:i * 7 + i % 90])) for i in range(400)] + list(enumerate(TEXTS, 500))
    docs += [(None, " ".join(words[:40])), (None, None), (-1, None), (7, " ".join(words[5:80])), (7, " ".join(words[5:80]))]
    check(spark, docs, [" ".join(words[:60]), None, "", "w1 w2 w3 w4"])


def test_copies_and_ties(spark):
    check(spark, [(i // 2, "same twenty words " * 10) for i in range(200)], ["same words"])


def test_empty(spark):
    check(spark, [], ["a b"])
    check(spark, [(1, "a b c " * 20)] * 3 + [(2, None)], [])
