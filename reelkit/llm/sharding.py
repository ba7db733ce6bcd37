"""Operator 3, balanced shards by label propagation, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelkit.llm.common import positions, stored, text_or_empty, utf8_bytes

#: Slices of the order by group hash: running sums are made in a slice, then over the slices' sums.
SLICES_BITS = 12
ROUNDS = 12
#: While documents move, a shard may exceed its share by one part in so many; it is brought back to it at the end.
SLACK = 20


def _literal(values: list[int], index: Column) -> Column:
    """The value at a shard's number; the list has a value a shard."""
    return F.element_at(F.array(*[F.lit(int(v)).cast("long") for v in values]), index.cast("int") + 1)


def _running(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over the rows before it, in the order of group hash ``g`` within ``key``."""
    d = df.withColumn("__slice", F.shiftrightunsigned(F.col("g"), 64 - SLICES_BITS))
    sums = d.groupBy(key, "__slice").agg(F.sum(value).alias("__sum"))
    over = Window.partitionBy(key).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col(key).alias("__k"), F.col("__slice").alias("__s"), F.coalesce(F.sum("__sum").over(over), F.lit(0)).alias("__before"))
    inside = Window.partitionBy(key, "__slice").orderBy("g").rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumn("__in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (d.join(sums, (d[key] == sums["__k"]) & (d["__slice"] == sums["__s"]))
             .withColumn(name, F.col("__before") + F.col("__in")).drop("__slice", "__s", "__k", "__before", "__in"))


def _held(state: DataFrame) -> dict[int, int]:
    """Documents in each shard: the one value a shard that the driver sees."""
    return {r.shard: r.n for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect()}


def propagate(state: DataFrame, quotas: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Move documents towards the shard that holds most of their neighbours, while no shard exceeds its quota.

    ``state`` (g, shard, n) counts the documents of each group of linked
    documents in each shard; documents of a group are each other's neighbours.
    In each round the documents of a group that are not in its fullest shard
    with room (by the round's start) ask to move there; a shard takes requests
    in a fixed order while it has room, the last one in part.  A group larger
    than a shard goes on to its next shard, once the first is full.  Ends when
    nothing moves, or after ``rounds``.
    """
    state = stored(state, "labels")
    for _ in range(rounds):
        held = _held(state)
        room = [q - held.get(s, 0) for s, q in enumerate(quotas)]
        best = (state.filter(_literal(room, F.col("shard")) > 0).groupBy("g")
                .agg(F.max(F.struct("n", (-F.col("shard")).alias("s"))).alias("b"))
                .select("g", (-F.col("b.s")).alias("to"), F.col("b.n").alias("most")))
        asks = (state.join(best, "g").filter("shard != to")
                .filter("n < most or (n = most and shard > to)")
                .select("g", "shard", "to", "n"))
        many = asks.groupBy("g", "to").agg(F.sum("n").alias("n"))
        took = (_running(many, "to", "n", "before")
                .withColumn("take", F.greatest(F.lit(0), F.least(F.col("n"), _literal(room, F.col("to")) - F.col("before"))))
                .filter("take > 0").select("g", "to", "take"))
        # the group's requests are served from its shards in order
        order = Window.partitionBy("g").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        moves = (asks.withColumn("earlier", F.coalesce(F.sum("n").over(order), F.lit(0))).join(took, ["g", "to"])
                 .withColumn("moved", F.greatest(F.lit(0), F.least(F.col("n"), F.col("take") - F.col("earlier")))).filter("moved > 0"))
        moves = stored(moves.select("g", "shard", "to", "moved"), "moves")
        if moves.isEmpty():
            break
        change = moves.select("g", F.explode(F.array(
            F.struct(F.col("shard").alias("shard"), (-F.col("moved")).alias("n")),
            F.struct(F.col("to").alias("shard"), F.col("moved").alias("n")))).alias("c")).select("g", "c.shard", "c.n")
        state = stored(state.unionByName(change).groupBy("g", "shard").agg(F.sum("n").alias("n")).filter("n > 0"), "labels")
    return state


def settle(state: DataFrame, quotas: list[int]) -> DataFrame:
    """Bring every shard to its quota at most: what exceeds one goes, group after group, to the shards with room in turn."""
    held = _held(state)
    over = [max(0, held.get(s, 0) - q) for s, q in enumerate(quotas)]
    if not any(over):
        return state
    ends, at = [], 0
    for s, q in enumerate(quotas):
        at += max(0, q - held.get(s, 0))
        ends.append(at)
    out = (_running(state.filter(_literal(over, F.col("shard")) > 0), "shard", "n", "before")
           .withColumn("out", F.greatest(F.lit(0), F.least(F.col("n"), _literal(over, F.col("shard")) - F.col("before"))))
           .filter("out > 0").groupBy("g").agg(F.sum("out").alias("out"), F.collect_list(F.struct("shard", "out")).alias("parts")))
    out = stored(_running(out.withColumn("all", F.lit(0)), "all", "out", "from"), "settled")
    lo, hi = _literal([0, *ends[:-1]], F.col("to")), _literal(ends, F.col("to"))
    put = (out.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(len(quotas) - 1))))
           .withColumn("n", F.least(hi, F.col("from") + F.col("out")) - F.greatest(lo, F.col("from"))).filter("n > 0"))
    gone = out.select("g", F.explode("parts").alias("p")).select("g", F.col("p.shard").alias("shard"), (-F.col("p.out")).alias("n"))
    come = put.select("g", F.col("to").alias("shard"), "n")
    return stored(state.unionByName(gone).unionByName(come).groupBy("g", "shard").agg(F.sum("n").alias("n")).filter("n > 0"), "labels")


def shards(docs: DataFrame, count: int = 16) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document; law ``rows``.

    Documents of equal text are linked.  They start in a shard by a hash of
    their id and propagate their labels (``propagate``) under quotas a little
    above a shard's even share of all rows, to which shards are then brought
    back (``settle``); documents without links fill every shard to its share, so that counts differ by one at most, whatever the
    groups.  Only a group that a shard's room can't hold is cut.  State and
    moves are counts a group and shard; a document meets its group once, in a
    join that Spark can split, and gets its place by its rank in the group.

    Size: UTF-8 bytes plus 1.  Null text: as empty, linked with empty ones.
    Null or repeated ids, repeated rows: a place each.  Empty table: no rows.
    Fewer documents than shards: one each in the first ones.
    """
    text = text_or_empty()
    base = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), (utf8_bytes(text) + 1).alias("size"),
                              F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("g")), "sizes")
    start = F.pmod(F.xxhash64("doc_id"), F.lit(count)).cast("int")
    counts = stored(base.groupBy("g", start.alias("shard")).agg(F.count(F.lit(1)).alias("n")), "counts")
    groups = counts.groupBy("g").agg(F.sum("n").alias("many"))
    total = groups.agg(F.sum("many")).first()
    rows = total[0] or 0
    quotas = [rows // count + (s < rows % count) for s in range(count)]

    # stored, so that Spark may split the joins with documents where a group is large
    linked = stored(groups.filter("many > 1").select("g"), "linked")
    loose = [q + q // SLACK + 1 for q in quotas]
    state = settle(propagate(counts.join(linked, "g"), loose), quotas)
    held = _held(state)
    free = [q - held.get(s, 0) for s, q in enumerate(quotas)]
    # documents without links come first in the order, then group by group
    flags = linked.select(F.col("g").alias("lg"))
    ordered = base.join(flags, base.g == flags.lg, "left")
    placed = positions(ordered, [F.asc_nulls_first("lg"), F.asc("doc_id"), F.asc("g")], "order")

    # where a group's documents go: its shards in turn, each from a rank and a slot on
    in_shard = _running(state, "shard", "n", "earlier").withColumn("slot0", _literal(free, F.col("shard")) + F.col("earlier"))
    order = Window.partitionBy("g").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    in_shard = in_shard.withColumn("rank0", F.coalesce(F.sum("n").over(order), F.lit(0)))
    plan = in_shard.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("rank0", "shard", "slot0"))).alias("runs"))
    firsts = placed.filter("lg is not null").groupBy("lg").agg(F.min("pos").alias("first")).select(F.col("lg").alias("g"), "first")
    plan = stored(plan.join(firsts, "g").select(F.col("g").alias("pg"), "runs", "first"), "plan")

    ends, at = [], 0
    for f in free:
        at += f
        ends.append(at)
    own = F.coalesce(*[F.when(F.col("pos") < e, F.lit(s)) for s, e in enumerate(ends)], F.lit(count - 1))
    begins = _literal([0, *ends[:-1]], own)
    rank = F.col("pos") - F.col("first")
    run = F.element_at(F.filter("runs", lambda r: r["rank0"] <= rank), -1)
    single = placed.filter("lg is null").select("doc_id", "size", "text_crc32", own.alias("shard"), (F.col("pos") - begins).alias("slot"))
    member = (placed.join(plan, placed.lg == plan.pg).withColumn("run", run)  # only these meet a plan: no null keys in the join
              .select("doc_id", "size", "text_crc32", F.col("run.shard").alias("shard"),
                      (F.col("run.slot0") + rank - F.col("run.rank0")).alias("slot")))
    return single.unionByName(member).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
