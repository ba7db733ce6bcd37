"""Operator 1, removal of repeated strings by a hash-compared sort of suffixes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelkit.llm.anchors import Prefixes, sliding_argmin, spread
from reelkit.llm.common import partitions_of, pieces, stored, text_or_empty

#: Bytes of an anchor's own string; any repeated string of LENGTH bytes holds one, at the same place in each copy.
GRAM = 24
LENGTH = 100
#: Contexts sorted at once, but for a larger group, and the size above which a group is not sorted in one task.
CHUNK, LARGE = 20_000, 200_000
#: Stands for a null id, and sorts before all others.
NO_ID = -(1 << 63)


# ------------------------------------------------------------------ the sort


def common(px: Prefixes, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common extension of the substrings at ``a`` and ``b``, up to ``most``: binary search on hashes."""
    lo, hi = np.zeros_like(most), most.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi + 1) >> 1
        same = px.prefix[a + mid] - px.prefix[a] == (px.prefix[b + mid] - px.prefix[b]) * _shift(px, a, b)
        lo = np.where(open_ & same, mid, lo)
        hi = np.where(open_ & ~same, mid - 1, hi)


def _shift(px: Prefixes, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The power that brings a substring's hash sum at ``b`` to place ``a``: base^(b - a)."""
    d = b - a
    return np.where(d >= 0, px.pow[np.maximum(d, 0)], px.neg[np.maximum(-d, 0)])


def less(px: Prefixes, start: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray, or_equal: bool) -> np.ndarray:
    """Whether suffix i stands before suffix j (or is equal), by their first different byte; a prefix stands first."""
    a, b, most = start[i], start[j], np.minimum(size[i], size[j])
    n = common(px, a, b, most)
    ended = n >= most
    last = len(px.data) - 1
    x, y = px.data[np.minimum(a + n, last)], px.data[np.minimum(b + n, last)]
    return np.where(ended, size[i] <= size[j] if or_equal else size[i] < size[j], x < y)


def sort_suffixes(px: Prefixes, start: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes within each group (groups in their order, each contiguous), and each one's common length
    with the one before it in its group (-1 for a group's first).

    Bottom-up mergesort of all groups at once: at each level, every suffix finds
    its place in its neighbour run by binary search, each comparison by a binary
    search over prefix hashes.  The common lengths on which classes depend are
    then verified on the bytes; a group with a collision is sorted on its bytes.
    """
    n = len(start)
    order = np.arange(n)
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.zeros(0, np.int64)
    counts = np.diff(np.concatenate([heads, [n]]))
    first, count = np.repeat(heads, counts), np.repeat(counts, counts)
    width = 1
    while n and width < counts.max():
        at = np.flatnonzero(count > width)  # smaller groups are done
        place = at - first[at]
        run = place // width
        mine, odd = first[at] + run * width, run % 2 == 1
        other = np.where(odd, mine - width, mine + width)
        lo = np.minimum(other, first[at] + count[at])
        hi = np.minimum(other + width, first[at] + count[at])
        begin = lo.copy()
        own = order[at]
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) >> 1
            there, here, right = order[mid], own[open_], odd[open_]
            # a suffix of the right run goes after equal ones of the left, and one of the left before equal ones
            after = np.empty(len(open_), bool)
            for side in (False, True):
                s = np.flatnonzero(right == side)
                after[s] = less(px, start, size, there[s], here[s], or_equal=side)
            lo[open_] = np.where(after, mid + 1, lo[open_])
            hi[open_] = np.where(after, hi[open_], mid)
        to = np.minimum(mine, other) + (at - mine) + (lo - begin)
        order[to] = own
        width *= 2
    lcp = np.full(n, -1, np.int64)
    rest = np.ones(n, bool)
    rest[heads] = False
    i = np.flatnonzero(rest)
    a, b = order[i - 1], order[i]
    lcp[i] = common(px, start[a], start[b], np.minimum(size[a], size[b]))
    wrong = _unequal(px.data, start[a], start[b], lcp[i])
    for h in np.unique(first[i[wrong]]):  # a collision: this group by its bytes
        members = order[h:h + count[h]]
        text = [px.data[start[m]:start[m] + size[m]].tobytes() for m in members]
        by = sorted(range(len(members)), key=text.__getitem__)
        order[h:h + count[h]] = members[by]
        for k in range(1, len(by)):
            x, y = text[by[k - 1]], text[by[k]]
            lcp[h + k] = next((q for q, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))
    return order, lcp


def _unequal(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray, block: int = 20_000) -> np.ndarray:
    """Where two substrings that hashes call equal differ on their bytes."""
    out = np.zeros(len(a), bool)
    for at in range(0, len(a), block):
        n = length[at:at + block]
        cols = np.arange(int(n.max(initial=0)))
        inside = cols[None, :] < n[:, None]
        x = a[at:at + block, None] + np.where(inside, cols[None, :], 0)
        y = b[at:at + block, None] + np.where(inside, cols[None, :], 0)
        out[at:at + block] = ((data[x] != data[y]) & inside).any(axis=1) if len(cols) else False
    return out


def repeated(group: np.ndarray, left: list[bytes], right: list[bytes], length: int = LENGTH) -> list[tuple[int, int, int]]:
    """(context, least, most): offsets l for which a context's string of l bytes before its anchor and length - l from
    it on is also that of an earlier context of its group.  Contexts come by group, and in a group from the earliest."""
    n = len(group)
    sides = []
    for strings in ([x[::-1] for x in left], right):
        size = np.fromiter(map(len, strings), np.int64, n)
        px = Prefixes(np.frombuffer(b"".join(strings) + b"\0", np.uint8))
        order, lcp = sort_suffixes(px, np.cumsum(size) - size, size, group)
        sides.append((size, order, lcp))
    (nl, ol, cl), (nr, o_r, cr) = sides
    out, runs = [], np.full(n, -1, np.int64)  # offset at which a context's present run of repeated strings began
    known = np.zeros(n, np.int64)
    widest = int(nl.max(initial=0))
    for off in range(widest + 2):
        again = np.zeros(n, bool)
        valid = np.flatnonzero((nl >= off) & (nr >= length - off)) if off <= widest else np.zeros(0, np.int64)
        if len(valid):
            known[o_r] = np.cumsum(cr < length - off)
            key = known[valid] * (n + 1)
            known[ol] = np.cumsum(cl < off)
            key += known[valid]
            by = np.argsort(key, kind="stable")
            same = key[by[1:]] == key[by[:-1]]
            again[valid[by[1:][same]]] = True
        ended = np.flatnonzero(~again & (runs >= 0))
        out += zip(ended.tolist(), runs[ended].tolist(), [off - 1] * len(ended))
        runs[ended] = -1
        runs[again & (runs < 0)] = off
    return out


# ------------------------------------------------------------------ anchors and contexts in tasks

ANCHORS = "g long, c long, v long, doc long, tag long, loc long, end long"


def _of_text(data: bytes, gram: int, length: int, bits: int = 64):
    """Anchor positions of a text, the hashes of their strings and of their contexts, and the contexts' bounds."""
    n, width = len(data), length - gram + 1
    px = Prefixes(np.frombuffer(data, np.uint8))
    own = spread(px.hash(np.arange(n - gram + 1), gram))
    at = sliding_argmin(own, width)
    at = np.unique(at[np.concatenate([[True], at[1:] != at[:-1]])])
    lo, hi = np.maximum(0, at - width + 1), np.minimum(n, at + length)
    context = spread(px.hash(lo, hi - lo) + ((at - lo) << 20 | hi - lo).astype(np.uint64))
    return at, own[at], context & np.uint64((1 << bits) - 1), lo, hi


def _anchors(gram: int, length: int, bits: int = 64):
    """The anchors of some texts at a time: of those with equal contexts the earliest, and the ranges of the others.

    So a passage that many documents share sends one row a batch to its string's
    task.  Contexts are equal in a batch if their bytes are; each anchor sent on
    carries a digest of its context's bytes, made apart from the hash.
    """
    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text", 8 << 20):
                docs, tags, texts = (part.column(c).to_pylist() for c in ("doc", "tag", "text"))
                found = [(r, *_of_text(t, gram, length, bits)) for r, t in enumerate(texts) if len(t) >= length]
                if not found:
                    continue
                row = np.concatenate([np.full(len(f[1]), f[0]) for f in found])
                at, g, c, lo, hi = (np.concatenate([f[i] for f in found]) for i in range(1, 6))
                doc, tag = np.array(docs, np.int64)[row], np.array(tags, np.int64)[row]
                order = np.lexsort((at, tag, doc, c, g))
                again = np.zeros(len(at), bool)
                again[order[1:]] = (g[order[1:]] == g[order[:-1]]) & (c[order[1:]] == c[order[:-1]])
                same, itself = _verified(texts, order, again, row, lo, hi, np.stack([doc, tag, at]))
                new = np.flatnonzero(~same)
                digest = np.fromiter((xxhash.xxh3_64_intdigest(texts[row[i]][lo[i]:hi[i]]) for i in new), np.uint64, len(new))
                gone = np.flatnonzero(same & ~itself)
                gone = gone[np.argsort(row[gone], kind="stable")]
                heads = np.flatnonzero(np.diff(row[gone], prepend=-1))
                ranges = [(int(row[x[0]]), *r) for x in np.split(gone, heads[1:]) if len(x) for r in _merged(lo[x], hi[x]).tolist()]
                owner, start, end = (np.array(x, np.int64) for x in (zip(*ranges, strict=True) if ranges else ([], [], [])))
                k = len(ranges)
                of, by = np.array(docs, np.int64)[owner], np.array(tags, np.int64)[owner]
                alone = of.view(np.uint64) * np.uint64(3) + by.view(np.uint64) * np.uint64(5) + start.astype(np.uint64)
                cols = [(g[new], spread(alone)), (c[new], np.zeros(k, np.uint64)), (digest, np.zeros(k, np.uint64)), (doc[new], of),
                        (tag[new], by), (at[new], start), (np.zeros(len(new), np.int64), end)]  # a range says all itself
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in cols],
                                                 names=["g", "c", "v", "doc", "tag", "loc", "end"])
    return run


def _verified(texts: list[bytes], order, again, row, lo, hi, place) -> tuple[np.ndarray, np.ndarray]:
    """Of anchors whose context's hashes stood in the batch before: where the bytes are the same as at the first, and
    where the place (document, tag, position) is too, as it is in equal rows."""
    same, itself, first = np.zeros(len(order), bool), np.zeros(len(order), bool), -1
    for i in order:
        if not again[i]:
            first = i
        elif texts[row[i]][lo[i]:hi[i]] == texts[row[first]][lo[first]:hi[first]]:
            same[i], itself[i] = True, bool((place[:, i] == place[:, first]).all())
    return same, itself


def _merged(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Union of ranges, as rows (start, end) in order; ranges that touch are one."""
    if not len(lo):
        return np.zeros((0, 2), np.int64)
    by = np.argsort(lo, kind="stable")
    lo, hi = lo[by], np.maximum.accumulate(hi[by])
    new = np.concatenate([[True], lo[1:] > hi[:-1]])
    ends = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(lo) - 1]])
    return np.stack([lo[new], hi[ends]], axis=1).astype(np.int64)


CONTEXTS = "g long, classes long, doc long, tag long, loc long, lead binary, follow binary"


def _contexts(gram: int, length: int):
    def run(batches):
        width = length - gram + 1
        for batch in batches:
            for part in pieces(batch, "text", 8 << 20):
                rows = [[] for _ in range(7)]
                for doc, tag, text, marks in zip(*(part.column(c).to_pylist() for c in ("doc", "tag", "text", "unsettled")), strict=True):
                    for m in marks:
                        p = m["loc"]
                        for col, v in zip(rows, (m["g"], m["classes"], doc, tag, p, text[max(0, p - width + 1):p], text[p:p + length]), strict=True):
                            col.append(v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(rows, [pa.int64()] * 5 + [pa.binary()] * 2, strict=True)],
                    names=["g", "classes", "doc", "tag", "loc", "lead", "follow"])
    return run


SPANS = "doc long, tag long, start long, end long"


def _sorted_groups(length: int):
    """Sorts the contexts of a partition that comes in the order of g, doc, tag and loc, some groups at a time."""
    def solve(rows: list[tuple]) -> pa.RecordBatch:
        rows = [r for i, r in enumerate(rows) if not i or r[:4] != rows[i - 1][:4]]  # equal rows are one document
        found = repeated(np.array([r[0] for r in rows]), [r[4] for r in rows], [r[5] for r in rows], length)
        out = [(rows[i][1], rows[i][2], rows[i][3] - most, rows[i][3] - least + length) for i, least, most in found]
        cols = zip(*out, strict=True) if out else ([], [], [], [])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc", "tag", "start", "end"])

    def run(batches):
        held: list[tuple] = []
        for batch in batches:
            held += zip(*(batch.column(c).to_pylist() for c in ("g", "doc", "tag", "loc", "lead", "follow")), strict=True)
            while len(held) > CHUNK and held[0][0] != held[-1][0]:
                cut = len(held) - 1
                while held[cut - 1][0] == held[-1][0]:  # the last group may go on in the next batch
                    cut -= 1
                yield solve(held[:cut])
                held = held[cut:]
        if held:
            yield solve(held)
    return run


def _windows(gram: int, length: int):
    """Every string of ``length`` bytes of the contexts of a large group, by 128 bits of hash and its own bytes' digest."""
    def run(batches):
        for batch in batches:
            rows = [[] for _ in range(4)]
            for doc, tag, loc, lead, follow in zip(*(batch.column(c).to_pylist() for c in ("doc", "tag", "loc", "lead", "follow")), strict=True):
                text = lead + follow
                for x in range(len(text) - length + 1):
                    if x <= len(lead):
                        h = hashlib.blake2b(text[x:x + length], digest_size=16).digest()
                        for col, v in zip(rows, (h, doc, tag, loc - len(lead) + x), strict=True):
                            col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.binary()), *[pa.array(r, pa.int64()) for r in rows[1:]]],
                                             names=["h", "doc", "tag", "start"])
    return run


def _spans_of(text: bytes, settled, ranges, more, gram: int, length: int) -> np.ndarray:
    """Maximal removed runs of a text: contexts of settled anchors, ranges that repeat its own, sorted groups' spans."""
    at = np.array(settled or (), np.int64)
    lo, hi = [np.maximum(0, at - (length - gram))], [np.minimum(len(text), at + length)]
    for found in (ranges, more):
        lo.append(np.array([x["start"] for x in found or ()], np.int64))
        hi.append(np.array([x["end"] for x in found or ()], np.int64))
    return _merged(np.concatenate(lo), np.concatenate(hi))


RESULT = ("doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, kept_text string, "
          "removed array<struct<start: long, end: long>>")
NAMES = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "kept_text", "removed"]
WAITING = "tag long, text binary, settled array<long>, ranges array<struct<start: long, end: long>>, unsettled array<struct<g: long, loc: long, classes: long>>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_TYPES = [pa.int64()] * 4 + [pa.string(), pa.binary(), pa.string(), _SPAN]


def _judged(gram: int, length: int, full: bool, last: bool):
    """Results of rows whose spans are all known; the others wait, with their text (none does in the last pass)."""
    def result(doc, text, spans):
        kept, at = [], 0
        for a, b in spans:
            kept.append(text[at:a])
            at = b
        kept = b"".join([*kept, text[at:]])
        return (doc, len(text), int((spans[:, 1] - spans[:, 0]).sum()), len(spans), hashlib.sha256(kept).hexdigest(),
                kept if full else None, kept.decode("utf-8", "ignore") if full else None, [{"start": int(a), "end": int(b)} for a, b in spans] if full else None)

    def run(batches):
        for batch in batches:
            for part in pieces(batch, "text", 8 << 20):
                docs, texts, settled, ranges = (part.column(c).to_pylist() for c in ("doc", "text", "settled", "ranges"))
                if last:
                    more, waits = part.column("spans").to_pylist(), [False] * len(docs)
                else:
                    more, waits = [None] * len(docs), [bool(x) for x in part.column("unsettled").to_pylist()]
                rows = [(d, *[None] * 7) if w else result(d, t, _spans_of(t, s, r, m, gram, length))
                        for d, t, s, r, m, w in zip(docs, texts, settled, ranges, more, waits, strict=True)]
                cols = [pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)]
                cols.append(part.column("others"))
                if last:
                    yield pa.RecordBatch.from_arrays(cols, names=[*NAMES, "others"])
                    continue
                rest = ["text", "settled", "ranges", "unsettled"]
                held = [pa.array([t if w else None for t, w in zip(texts, waits, strict=True)], part.column("text").type)]
                held += [pa.array([x if w else None for x, w in zip(part.column(c).to_pylist(), waits, strict=True)],
                                  part.column(c).type) for c in rest[1:]]
                yield pa.RecordBatch.from_arrays([*cols, part.column("tag"), *held], names=[*NAMES, "others", "tag", *rest])
    return run


# ------------------------------------------------------------------ the Spark jobs


def _rows(docs: DataFrame, others: bool = False) -> DataFrame:
    text = text_or_empty()
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]) if others else F.lit(None).cast("int")
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), text.cast("binary").alias("text"),
                       F.xxhash64(text).alias("tag"), rest.alias("others"))


def marks(docs: DataFrame, gram: int = GRAM, length: int = LENGTH, bits: int = 64) -> DataFrame:
    """doc, tag, g, loc, end, kind, classes of the anchors that have a say, stored.

    kind 0: a range that repeats an earlier one of the same row (loc to end);
    1: an anchor whose whole context stands earlier too; 2: the earliest anchor
    with its context, where others share its string but not its context.  Two
    contexts are one if their hash (``bits`` of it) and the digest of their bytes are equal.
    """
    rows = _rows(docs)
    found = rows.select("doc", "tag", "text").mapInArrow(_anchors(gram, length, bits), ANCHORS)
    dealt = found.repartition(max(partitions_of(rows), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "g") \
                 .sortWithinPartitions("g", "c", "v", "doc", "tag", "loc")
    by_string, by_context = Window.partitionBy("g"), Window.partitionBy("g", "c", "v").orderBy("doc", "tag", "loc")
    nth = (dealt.withColumn("n", F.count(F.lit(1)).over(by_string)).filter("n > 1 or end > 0")
                .withColumn("nth", F.rank().over(by_context)))  # equal rows of the table are one document
    nth = nth.withColumn("classes", F.sum(F.when(F.col("nth") == 1, 1).otherwise(0)).over(by_string))
    kind = F.when(F.col("end") > 0, 0).when(F.col("nth") > 1, 1).when(F.col("classes") > 1, 2)
    return stored(nth.withColumn("kind", kind).filter("kind is not null")
                  .select("doc", "tag", F.when(F.col("kind") == 2, F.col("g")).alias("g"),
                          "loc", "end", "kind", F.when(F.col("kind") == 2, F.col("classes")).alias("classes")), "marks")


def _without_later_copies(judged: DataFrame, length: int, full: bool) -> DataFrame:
    """``judged`` (stored, with a number ``row``), where of rows without an id and of equal text all but one lose all:
    a text of ``length`` bytes or more that stands earlier as a whole.  Rows meet by their number, never by group."""
    size = F.coalesce("n_bytes", F.octet_length("text").cast("long"))
    rest, alone = judged.filter(F.col("doc") != NO_ID), judged.filter(F.col("doc") == NO_ID).withColumn("size", size)
    long = alone.filter(F.col("size") >= length)
    firsts = long.groupBy("tag", "size").agg(F.min("row").alias("row")).select("row")
    new = {"doc": F.col("doc"), "tag": F.col("tag"), "others": F.col("others"), "n_bytes": F.col("size"), "n_removed": F.col("size"),
           "n_spans": F.lit(1), "kept_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
    if full:
        new |= {"kept": F.lit(b""), "kept_text": F.lit(""),
                "removed": F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("size").alias("end")))}
    gone = [new.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in judged.schema.fields]
    parts = [alone.filter(F.col("size") < length), long.join(firsts, "row", "left_semi"), long.join(firsts, "row", "left_anti").select(*gone)]
    for part in parts:
        rest = rest.unionByName(part.select(judged.columns))
    return rest.drop("row")


def remove_repeats(docs: DataFrame, gram: int = GRAM, length: int = LENGTH, full: bool = False,
                   large: int = LARGE, bits: int = 64) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row (and, if ``full``, the kept bytes, the text
    that they make without characters cut in two, the removed spans, and all other columns as one, ``others``).

    A byte goes if a string of ``length`` bytes over it also starts earlier: in
    a document of smaller id, or further up in its own.  Judged on the input.

    Only suffixes at anchors are sorted: of each run of ``length`` bytes the
    position whose ``gram``-byte hash is least, which every copy of the string
    has too.  Anchors are dealt by that hash; an anchor alone with its string
    says nothing, and one whose whole context (all strings that it can stand
    for) was seen before is settled: by its bytes within a batch of texts, of
    which one anchor a context goes on, then by ``bits`` bits of prefix hash and
    64 of a digest that has nothing in common with it.  For the rest the contexts' bytes are dealt
    by string and, in each group, the suffixes on both sides of the anchor are
    sorted (``sort_suffixes``); their common lengths tell for every string of a
    context whether an earlier one has it.  Groups of more than ``large``
    distinct contexts are not sorted in one task: their strings go through an
    aggregate, combined before its shuffle.

    Null text: empty.  Texts shorter than ``length``: nothing goes.  Null ids
    come first.  Rows that share an id are told apart, and ordered, by the 64
    bits of their text's XXH64; rows that are equal, id included, are one
    document, and get the same result each.  Rows without an id are a document
    each: of those with equal text one stays (any, as they are equal), and the
    others repeat it.  Empty table: no rows.
    """
    rows = _rows(docs, others=full)
    said = marks(docs, gram, length, bits)
    by_doc = said.groupBy("doc", "tag").agg(
        F.collect_list(F.when(F.col("kind") == 1, F.col("loc"))).alias("settled"),
        F.collect_list(F.when(F.col("kind") == 0, F.struct(F.col("loc").alias("start"), "end"))).alias("ranges"),
        F.collect_list(F.when(F.col("kind") == 2, F.struct("g", "loc", "classes"))).alias("unsettled"))
    first = rows.join(by_doc, ["doc", "tag"], "left").select("doc", "tag", "text", "others", "settled", "ranges", "unsettled")
    schema = T.StructType([*T.StructType.fromDDL(RESULT).fields, T.StructField("others", rows.schema["others"].dataType)])
    both = T.StructType([*schema.fields, *T.StructType.fromDDL(WAITING).fields])
    judged = first.mapInArrow(_judged(gram, length, full, last=False), both)
    judged = _without_later_copies(stored(judged.withColumn("row", F.monotonically_increasing_id()), "judged"), length, full)
    waiting = judged.filter("text is not null").select("doc", "tag", "text", "others", "settled", "ranges", "unsettled")

    contexts = waiting.select("doc", "tag", "text", "unsettled").mapInArrow(_contexts(gram, length), CONTEXTS)
    small = contexts.filter(F.col("classes") <= large).repartition(partitions_of(rows), "g").sortWithinPartitions("g", "doc", "tag", "loc")
    spans = small.mapInArrow(_sorted_groups(length), SPANS)
    if said.filter((F.col("kind") == 2) & (F.col("classes") > large)).limit(1).count():
        windows = stored(contexts.filter(F.col("classes") > large).mapInArrow(
            _windows(gram, length), "h binary, doc long, tag long, start long"), "windows")
        earliest = windows.groupBy("h").agg(F.min(F.struct("doc", "tag", "start")).alias("f")).withColumnRenamed("h", "fh")
        again = windows.join(earliest, F.col("h") == F.col("fh")).filter(F.struct("doc", "tag", "start") > F.col("f"))
        spans = spans.unionByName(again.select("doc", "tag", "start", (F.col("start") + length).alias("end")))
    by_doc = spans.groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    late = (waiting.join(by_doc, ["doc", "tag"], "left").select("doc", "text", "others", "settled", "ranges", "spans")
            .mapInArrow(_judged(gram, length, full, last=True), schema))
    out = judged.filter("text is null").select(late.columns).unionByName(late)
    more = ["kept", "kept_text", "removed", "others"] if full else []
    return out.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"),
                      "n_bytes", "n_removed", "n_spans", "kept_sha256", *more)
