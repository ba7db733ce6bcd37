"""Operator 10, document fingerprints by invertible Bloom lookup sketches, in DataFrame operations only."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelkit.llm.common import positions, shared_path, stored, text_or_empty

#: A paragraph is a line or, of a longer one, a run of PARAGRAPH characters of it; the opening of a text is cut finer,
#: by (characters of the text, characters of a piece), so that short texts have several pieces too.
OPENING, PARAGRAPH = ((64, 8), (512, 32)), 128
#: Each of a digest's three cells lies in a subtable of its own; cells of a subtable in the fingerprint that is shown.
TABLES, SHOWN = 3, 4
#: Cells of a subtable for comparison at least, and for each digest of both sides.
LEAST, LOAD = 16, 2.0
#: Rounds in which each subtable is peeled once, and enlargements before a comparison counts what is left.
ROUNDS, RETRIES = 2, 6
#: Stands for a null id.
NO_ID = -(1 << 63)


def _low32(h: Column) -> Column:
    """The lower half of a 64-bit hash, as an int."""
    return F.shiftright(F.shiftleft(h, 32), 32).cast("int")


def paragraphs(text: Column) -> Column:
    """The distinct 32-bit digests of a text's pieces."""
    parts, at = [], 1
    for upto, size in OPENING:
        parts.append(F.regexp_extract_all(F.substring(text, at, upto - at + 1), F.lit(r"(?s).{1,%d}" % size), F.lit(0)))
        at = upto + 1
    parts.append(F.regexp_extract_all(F.substring(text, at, 2147483647), F.lit(r"[^\n]{1,%d}" % PARAGRAPH), F.lit(0)))
    return F.array_distinct(F.transform(F.concat(*parts), lambda p: _low32(F.xxhash64(p))))


def check(digest: Column) -> Column:
    """What tells a cell that holds one digest from one whose digests only look like it."""
    return _low32(F.xxhash64(digest, F.lit(7)))


def cell(digest: Column, table: Column | int, size: Column | int, seed: int) -> Column:
    """The digest's cell in a subtable of ``size`` cells; cells of all subtables are numbered on."""
    t = F.lit(table) if isinstance(table, int) else table
    s = F.lit(size) if isinstance(size, int) else size
    return (F.pmod(F.xxhash64(digest, t, F.lit(seed)), s.cast("long")) + t * s).cast("int")


def shown(digests: Column, size: int = SHOWN) -> Column:
    """A sketch of few cells as text: count, exclusive or of digests and of checks of every cell, in hexadecimal."""
    def of(c: int) -> Column:
        own = F.filter(digests, lambda d: cell(d, c // size, size, 0) == c)
        xor = lambda f: F.aggregate(own, F.lit(0), lambda a, d: a.bitwiseXOR(f(d)))
        return F.concat_ws(".", F.hex(F.size(own)), F.hex(xor(lambda d: d)), F.hex(xor(check)))
    return F.concat_ws("-", F.hex(F.size(digests)), *[of(c) for c in range(TABLES * size)])


def peel(entries: DataFrame, key: list[str], rounds: int = ROUNDS, seed: int = 0) -> DataFrame:
    """key, found, left: digests recovered from the difference of two sketches a key, and cells that could not be read.

    ``entries`` (key, size, sign, digest) are both sides' digests, with sign 1
    and -1.  Their sketches subtract cell by cell, so that what both hold
    cancels out, and a cell with one digest gives it away: count 1 or -1 and the
    digest's own check.  Such a digest is taken out of its other cells too.
    Subtables take turns: in one, a digest has one cell, so none is read twice.
    Rows of a key must stand in one partition of ``entries`` (by their plan);
    then no step shuffles.  Empty cells fall away, so work shrinks as it goes.
    """
    each = F.explode(F.array(*[F.lit(t) for t in range(TABLES)])).alias("t")
    cells = entries.select(*key, "size", "sign", "digest", each)
    cells = cells.select(*key, "size", cell(F.col("digest"), F.col("t"), F.col("size"), seed).alias("cell"),
                         F.col("sign").alias("n"), F.col("digest").alias("x"), check(F.col("digest")).alias("c"))

    def summed(rows: DataFrame) -> DataFrame:
        return (rows.groupBy(*key, "size", "cell").agg(F.sum("n").cast("int").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("c").alias("c"))
                    .filter("n != 0 or x != 0 or c != 0"))

    state = summed(cells)
    for r in range(rounds * TABLES):
        t = r % TABLES
        pure = ((F.floor(F.col("cell") / F.col("size")) == t) & (F.col("cell") >= 0) & (F.abs("n") == 1)
                & (check(F.col("x")) == F.col("c")))
        # a readable cell goes: one row to count its digest, one for each other cell that holds it
        step = state.withColumn("pure", pure).select("*", each).filter("pure or t = 0")
        other, taken = (F.col("t") + t) % TABLES, F.col("pure") & (F.col("t") > 0)
        state = summed(step.select(
            *key, "size",
            F.when(~F.col("pure"), F.col("cell")).when(F.col("t") == 0, F.lit(-1))
             .otherwise(cell(F.col("x"), other, F.col("size"), seed)).alias("cell"),
            F.when(taken, -F.col("n")).when(F.col("pure"), F.lit(1)).otherwise(F.col("n")).alias("n"),
            F.when(F.col("pure") & (F.col("t") == 0), F.lit(0)).otherwise(F.col("x")).alias("x"),
            F.when(F.col("pure") & (F.col("t") == 0), F.lit(0)).otherwise(F.col("c")).alias("c")))
    return state.groupBy(*key).agg(F.coalesce(F.sum(F.when(F.col("cell") < 0, F.col("n"))), F.lit(0)).alias("found"),
                                   F.sum(F.when(F.col("cell") >= 0, 1).otherwise(0)).alias("left"))


def likeness(found: Column, one: Column, other: Column) -> Column:
    """Shared among all digests of two sets, by their sizes and the size of their difference; 1 for two empty sets."""
    return F.when(one + other == 0, 1.0).otherwise(F.greatest(F.lit(0.0), (one + other - found) / (one + other + found)))


def _bucketed(df: DataFrame, by: list[str]) -> DataFrame:
    """``df`` stored in buckets of ``by``, by which it is dealt already: later steps by that key need no exchange."""
    spark = df.sparkSession
    n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"reelkit_sketches_{uuid.uuid4().hex}"
    df.write.bucketBy(n, *by).option("path", shared_path(spark, "sketches")).format("parquet").saveAsTable(name)
    return spark.table(name)


KEY = ["id", "tie"]


def _compared(pairs: DataFrame, factor: int, seed: int) -> DataFrame:
    """KEY, kind (0: own edited text, 1: next document), found, left."""
    def side(kind: int, sign: int, digests: str):
        return F.transform(digests, lambda d: F.struct(F.lit(kind).alias("kind"), F.lit(sign).alias("sign"), d.alias("digest")))
    size = lambda a, b: F.greatest(F.lit(LEAST), F.ceil((F.size(a) + F.size(b)) * LOAD).cast("int")) * factor
    sides = F.concat(side(0, 1, "own"), side(0, -1, "edited"), side(1, 1, "own"), side(1, -1, "next"))
    rows = pairs.select(*KEY, size("own", "edited").alias("s0"), size("own", "next").alias("s1"), F.explode(sides).alias("e"))
    rows = rows.select(*KEY, F.col("e.kind").alias("kind"), F.when(F.col("e.kind") == 0, F.col("s0")).otherwise(F.col("s1")).alias("size"),
                       F.col("e.sign").alias("sign"), F.col("e.digest").alias("digest"))
    return peel(rows, [*KEY, "kind"], seed=seed)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    A document's next one, by descending id, gives it the characters that its
    edited text ends with.  The texts are dealt once, by row; what a document
    needs of the next one's text, a third of its own length at most, and the
    next one's digests go to its row; the digests of the three texts are stored
    in buckets of the row, so that sketches are made, subtracted and peeled
    without a further shuffle.  A comparison that leaves cells is made again
    with four times the cells and other hashes; what is left after RETRIES is
    counted as a digest for every three cells.  A fingerprint shows the sketch
    of twelve cells, from which larger ones differ in size only.

    Null text: empty; two empty sets are alike (1).  A single document is its
    own next.  Null ids come last, as the smallest.  Rows that share an id are
    ordered by a hash of their text; rows that are equal are one document, and
    each gets its result.  Empty table: no rows.
    """
    text = text_or_empty()
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    narrow = rows.select("id", "tie", F.char_length("text").alias("n_chars")).groupBy(*KEY, "n_chars").count()
    placed = stored(positions(narrow, [F.desc("id"), F.desc("tie")], "order"), "placed")
    total = placed.count()
    before = F.pmod(F.col("pos") - 1, F.lit(max(1, total)))
    one = placed.select("id", "tie", "n_chars", "count", before.alias("to"))
    other = placed.select(F.col("id").alias("to_id"), F.col("tie").alias("to_tie"),
                          F.floor(F.col("n_chars") / 3).cast("int").alias("to_need"), F.col("pos").alias("at"))
    links = one.join(other, one["to"] == other["at"]).select(*KEY, "n_chars", "count", "to_id", "to_tie", "to_need")

    dealt = rows.groupBy(*KEY).agg(F.first("text").alias("text")).join(links, KEY)
    own = dealt.withColumn("own", paragraphs(F.col("text")))
    gift = own.select(F.col("to_id").alias("id"), F.col("to_tie").alias("tie"),
                      F.col("text").substr(F.lit(1), F.col("to_need")).alias("end"), F.col("own").alias("next"))
    need = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.col("n_chars") - need), "end")
    both = (own.join(gift, KEY).withColumn("edited_text", edited)
            .select(*KEY, "n_chars", "count", "own", "next", paragraphs(F.col("edited_text")).alias("edited"),
                    F.sha2("edited_text", 256).alias("edited_sha256")))
    base = _bucketed(both, KEY)

    result = stored(_compared(base, 1, 0), "peeled")
    for k in range(1, RETRIES + 1):
        open_ = result.filter("left > 0")
        if open_.isEmpty():
            break
        wanted = base.join(open_.select(*KEY).distinct(), KEY, "left_semi")
        again = _compared(wanted, 4 ** k, k).withColumn("again", F.lit(1))
        again = again.join(open_.select(*KEY, "kind"), [*KEY, "kind"], "left_semi")
        best = Window.partitionBy(*KEY, "kind").orderBy(F.desc("again"))
        result = stored(result.withColumn("again", F.lit(0)).unionByName(again)
                        .withColumn("nth", F.row_number().over(best)).filter("nth = 1").drop("nth", "again"), "peeled")
    found = F.col("found") + F.ceil(F.col("left") / 3)
    by_kind = result.groupBy(*KEY).agg(*[F.coalesce(F.max(F.when(F.col("kind") == k, found)), F.lit(0)).alias(f"found{k}") for k in (0, 1)])
    out = base.join(by_kind, KEY, "left").fillna(0, ["found0", "found1"])
    near = lambda k, x: likeness(F.col(f"found{k}"), F.size("own"), F.size(x)).cast("double")
    return (out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("count").cast("int"))))
               .select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"),
                       "edited_sha256", shown(F.col("own")).alias("fingerprint"), shown(F.col("edited")).alias("edited_fingerprint"),
                       near(0, "edited").alias("near_edited"), near(1, "next").alias("near_next")))
