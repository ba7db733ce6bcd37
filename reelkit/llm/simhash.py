"""Operator 2, near duplicates by SimHash fingerprints and meet-in-the-middle ball hashing."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelkit.llm.common import pieces, stored, text_or_empty, texts
from reelkit.llm.graph import components

BITS = 64
#: Fixed value: only A to Z are lowered.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16


def fingerprint(text: str, shingle: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit fingerprint of a text: each bit by majority over its shingles' XXH64."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()  # bytes split at exactly the six blanks
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:max(1, len(words) - shingle + 1)].tolist()
    ends = ends[min(shingle, len(words)) - 1:].tolist()
    total, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), CHUNK):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[at:at + CHUNK], ends[at:at + CHUNK], strict=True)], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(starts), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int, seed: int):
    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text", 4 << 20):
                fps = np.array([fingerprint(t, shingle, seed) for t in texts(part)], np.uint64).view(np.int64)
                names = [c for c in part.schema.names if c != "text"]
                yield pa.RecordBatch.from_arrays([*map(part.column, names), pa.array(fps)], names=[*names, "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp (the fingerprint's bits as a signed long) of every row, in the scan's tasks."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(_fingerprints(shingle, seed), "doc_id long, fp long")


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _ball(fp, masks: list[tuple[int, int]], *more):
    """``fp`` with the first mask kept and the second one flipped, a row for each pair of masks."""
    each = F.array(*[F.struct(F.lit(_signed(a)).alias("a"), F.lit(_signed(x)).alias("x"), *[F.lit(v) for v in m])
                     for (a, x), *m in zip(masks, *more)])
    return F.explode(F.transform(each, lambda s: F.struct(
        fp.bitwiseAND(s["a"]).bitwiseXOR(s["x"]).alias("key"), *([s["col3"].alias("near")] if more else []))))


def candidates(fps: DataFrame, radius: int = 3, blocks: int = 3) -> DataFrame:
    """Fingerprints that may have another within ``radius`` = 3 bits; every one that has is among them.

    Of three differing bits, one lies in some block; with that block wiped out
    two remain, and both sides meet after a flip each.  So each fingerprint
    emits, for each block, itself without the block and every one-bit variant
    outside it (132 for three blocks), and stays if another fingerprint emits
    the same.  Sorted neighbours tell that: no group is gathered.
    """
    if radius != 3:
        raise ValueError("the half-radius balls here are those of radius 3")
    full, cuts, masks = (1 << BITS) - 1, [BITS * j // blocks for j in range(blocks + 1)], []
    for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
        wiped = ((1 << hi - lo) - 1) << lo
        tag = 1 << lo  # in the wiped block: variants of different blocks rarely meet
        masks += [(full ^ wiped, tag)] + [(full ^ wiped, tag | 1 << b) for b in range(BITS) if not lo <= b < hi]
    w = Window.partitionBy("key").orderBy("fp")
    v = fps.select("fp", _ball(F.col("fp"), masks).alias("v")).select("fp", "v.key")
    met = v.withColumn("p", F.lag("fp").over(w)).withColumn("n", F.lead("fp").over(w))
    return met.filter("p != fp or n != fp").select("fp").distinct()


def links(fps: DataFrame) -> DataFrame:
    """u, v: links that join exactly the fingerprints (distinct, column fp) that 3 or fewer bits apart join.

    Meeting in the middle of three bits: one side flips one bit, the other two,
    which can always be chosen in the same half of the word (of three bits two
    share a half).  Each fingerprint emits its 65 variants within one flip and
    the 992 with two flips in one half.  In a bucket, those within one flip are
    within two bits of each other and within three of all others, so links to
    the least of them say all; without one the bucket says nothing.  A bucket
    holds distinct fingerprints within two flips of its key, 2,081 at most.
    """
    full, half = (1 << BITS) - 1, BITS // 2
    near = [0] + [1 << b for b in range(BITS)]
    far = [1 << a | 1 << b for h in (0, half) for a, b in combinations(range(h, h + half), 2)]
    masks = [(full, x) for x in near + far]
    v = fps.select("fp", _ball(F.col("fp"), masks, [True] * len(near) + [False] * len(far)).alias("v")).select("fp", "v.key", "v.near")
    hub = F.min(F.when(F.col("near"), F.col("fp"))).over(Window.partitionBy("key"))
    met = v.withColumn("hub", hub).filter("hub is not null and hub != fp")
    met = met.select(F.least("fp", "hub").alias("u"), F.greatest("fp", "hub").alias("v")).distinct()
    return met.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= 3)  # verified on the fingerprints themselves


def _roots(fps: DataFrame) -> DataFrame:
    """node, root of the (distinct) fingerprints that are linked to others."""
    return components(links(stored(candidates(fps), "candidates")))


def one_of_each(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """alone, id, text_hash of the first row of each component among the rows with an id (``alone`` false), and of the
    first among those without (true; id 0): the smallest id, and of that the least XXH64 of the text.

    Components are told by their least fingerprint, so an id with two texts may
    be in two.  Equal fingerprints are combined before the shuffle, as above.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), text_or_empty().alias("text"))
    own = rows.mapInArrow(_fingerprints(shingle, seed), "doc_id long, text_hash long, fp long")
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(0)).alias("id"), "text_hash")).alias("first")
    least = stored(own.groupBy("fp", F.col("doc_id").isNull().alias("alone")).agg(first), "distinct")
    roots = _roots(least.select("fp").distinct())
    placed = least.join(roots, least.fp == roots.node, "left").select("alone", "first", F.coalesce("root", "fp").alias("root"))
    return placed.groupBy("root", "alone").agg(F.min("first").alias("first")).select("alone", "first.id", "first.text_hash")


def near_duplicates(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint, component_id of every row of ``docs`` (doc_id, text).

    Fingerprints are made in the scan; equal ones are combined to their
    smallest doc_id before the shuffle, so copies cost a row a task.  Links
    between distinct fingerprints 3 or fewer bits apart, and equal ones, form
    the components.

    Null, empty and blank texts: fingerprint zero, linked like any other.
    Texts of fewer words than a shingle: one shingle of all.  Repeated ids: a
    row each; a component's id is the smallest id that is not null, and null if
    there is none.  Empty table: no rows.
    """
    own = stored(fingerprints(docs, shingle, seed), "fingerprints")
    distinct = stored(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = _roots(distinct.select("fp"))
    placed = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    of = placed.join(ids, "root").select("fp", "component_id")
    return own.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
