"""Operator 8, approximate nearest neighbours on robust-pruned directed graphs, one per shard."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelkit.llm.common import stored

DEGREE, BEAM, ALPHA, BATCH = 32, 64, 1.2, 256


class Graph:
    """A directed graph over points, searched greedily by squared Euclidean distance from its medoid.

    Points are put in one batch after another, in a seeded order: a greedy
    search proposes what a point may link to, and relaxed pruning keeps a
    candidate only if no kept one is nearer to it, by the factor ALPHA, than
    the point is.  Links are made both ways and pruned again where too many.
    """

    def __init__(self, points: np.ndarray, links: np.ndarray | None = None, start: int | None = None):
        self.x = np.ascontiguousarray(points, dtype=np.float32)
        self.sq = np.einsum("ij,ij->i", self.x, self.x)
        n = len(self.x)
        if links is not None:
            self.links, self.start = links, int(start)
            return
        mean = self.x.mean(axis=0)
        self.start = int(np.argmin(self.sq - 2 * self.x @ mean))
        self.links = np.full((n, DEGREE), -1, np.int32)
        order = np.random.default_rng(n).permutation(n)
        order = np.concatenate([[self.start], order[order != self.start]])
        done = 1
        while done < n:  # as many at once as are in, so that a batch finds a graph of its kind
            size = min(BATCH, done, n - done)
            self._insert(order[done:done + size])
            done += size
        for at in range(0, n, BATCH):  # once more, now that all are in
            self._insert(order[at:at + BATCH])

    def distances(self, q: np.ndarray, qsq: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Of each row of ``q`` to the points of its row of ``ids``."""
        return qsq[:, None] + self.sq[ids] - 2 * np.matmul(self.x[ids], q[:, :, None])[:, :, 0]

    def search(self, q: np.ndarray, beam: int = BEAM, wide: int = 4):
        """Ids and distances of the ``beam`` nearest that a greedy search meets, nearest first (id -1 where fewer)."""
        q = np.ascontiguousarray(q, dtype=np.float32)
        m, n = len(q), len(self.x)
        qsq = np.einsum("ij,ij->i", q, q)
        ids = np.full((m, beam), n, np.int64)
        dist = np.full((m, beam), np.inf, np.float32)
        open_ = np.zeros((m, beam), bool)
        ids[:, 0], open_[:, 0] = self.start, True
        dist[:, 0] = self.distances(q, qsq, np.full((m, 1), self.start))[:, 0]
        seen = np.zeros((m, n + 1), bool)
        seen[:, n] = seen[:, self.start] = True
        live = np.arange(m)
        while len(live):
            # the nearest few unexpanded places of each live row
            place = np.argsort(~open_[live], axis=1, kind="stable")[:, :wide]
            r = live[:, None]
            usable = open_[r, place]
            open_[r, place] = False
            nxt = np.where(usable[:, :, None], self.links[np.minimum(ids[r, place], n - 1)], -1).reshape(len(live), -1).astype(np.int64)
            nxt[nxt < 0] = n
            nxt.sort(axis=1)
            fresh = ~seen[r, nxt]
            fresh[:, 1:] &= nxt[:, 1:] != nxt[:, :-1]
            seen[r, nxt] = True
            nxt = np.where(fresh, nxt, n)
            width = int(fresh.sum(axis=1).max(initial=0))
            if width:
                nxt = np.take_along_axis(nxt, np.argsort(~fresh, axis=1, kind="stable")[:, :width], axis=1)
                new = np.where(nxt < n, self.distances(q[live], qsq[live], np.minimum(nxt, n - 1)), np.inf).astype(np.float32)
                all_d = np.concatenate([dist[live], new], axis=1)
                keep = np.argsort(all_d, axis=1, kind="stable")[:, :beam]
                dist[live] = np.take_along_axis(all_d, keep, axis=1)
                ids[live] = np.take_along_axis(np.concatenate([ids[live], nxt], axis=1), keep, axis=1)
                open_[live] = np.take_along_axis(np.concatenate([open_[live], nxt < n], axis=1), keep, axis=1)
            live = live[open_[live].any(axis=1)]
        ids[ids == n] = -1
        return ids, dist

    def _prune(self, points: np.ndarray, cand: np.ndarray) -> np.ndarray:
        """Up to DEGREE of each point's candidates (-1: none), diverse ones, nearest first."""
        n, width = len(self.x), 2 * BEAM
        cand = np.where((cand == points[:, None]) | (cand < 0), n, cand)
        cand.sort(axis=1)
        cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = n
        safe = np.minimum(cand, n - 1)
        dist = np.where(cand < n, self.distances(self.x[points], self.sq[points], safe), np.inf)
        order = np.argsort(dist, axis=1, kind="stable")[:, :width]
        safe, dist = np.take_along_axis(safe, order, axis=1), np.take_along_axis(dist, order, axis=1)
        alive = np.isfinite(dist)
        y, s = self.x[safe], self.sq[safe]
        between = s[:, :, None] + s[:, None, :] - 2 * np.matmul(y, y.transpose(0, 2, 1))
        shaded = ALPHA * ALPHA * between <= dist[:, None, :]
        out, rows = np.full((len(points), DEGREE), -1, np.int32), np.arange(len(points))
        for k in range(DEGREE):
            first = alive.argmax(axis=1)
            some = alive[rows, first]
            if not some.any():
                break
            out[:, k] = np.where(some, safe[rows, first], -1)
            alive &= ~(shaded[rows, first] & some[:, None])
            alive[rows, first] = False
        return out

    def _insert(self, points: np.ndarray) -> None:
        found, _ = self.search(self.x[points])
        self.links[points] = self._prune(points, np.concatenate([found, self.links[points].astype(np.int64)], axis=1))
        # the other way: each new link's end gets the point, and is pruned if that is too many
        ends, froms = self.links[points].ravel(), np.repeat(points, DEGREE)
        order = np.argsort(ends, kind="stable")
        order = order[np.searchsorted(ends[order], 0):]
        ends, froms = ends[order], froms[order]
        heads, at, counts = np.unique(ends, return_index=True, return_counts=True)
        by_count = np.argsort(counts, kind="stable")
        for lo in range(0, len(heads), BATCH):
            h = by_count[lo:lo + BATCH]
            more = np.full((len(h), int(counts[h].max())), -1, np.int64)
            place = np.arange(more.shape[1])[None, :] < counts[h][:, None]
            more[place] = froms[np.concatenate([np.arange(at[i], at[i] + counts[i]) for i in h])]
            both = np.concatenate([self.links[heads[h]].astype(np.int64), more], axis=1)
            uniq = both.copy()
            uniq.sort(axis=1)
            uniq[:, 1:][uniq[:, 1:] == uniq[:, :-1]] = -1
            few = (uniq >= 0).sum(axis=1) <= DEGREE
            if few.any():
                u = -np.sort(-uniq[few], axis=1)[:, :DEGREE]
                self.links[heads[h][few], :u.shape[1]] = u
                self.links[heads[h][few], u.shape[1]:] = -1
            if (~few).any():
                self.links[heads[h][~few]] = self._prune(heads[h][~few].astype(np.int64), both[~few])


def lifted(x: np.ndarray) -> np.ndarray:
    """Points whose nearness to (query, 0) is the largest inner product: one more coordinate evens out all norms."""
    sq = np.einsum("ij,ij->i", x, x)
    return np.concatenate([x, np.sqrt(np.maximum(sq.max(initial=0) - sq, 0))[:, None]], axis=1)


INDEX = "shard int, dim int, start int, members array<array<long>>, vectors binary, links binary"


def _build(key, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("class_id", kind="stable")
    x = np.stack(pdf["vec"].to_numpy()).astype(np.float64)
    g = Graph(lifted(x))
    return pd.DataFrame({"shard": [key[0]], "dim": [x.shape[1]], "start": [g.start], "members": [list(pdf["members"])],
                         "vectors": [x.astype("<f8").tobytes()], "links": [g.links.astype("<i4").tobytes()]})


def _search(k: int, beam: int):
    def run(key, index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        for row in index.itertuples() if len(queries) else ():
            x = np.frombuffer(row.vectors, "<f8").reshape(-1, row.dim)
            g = Graph(lifted(x), np.frombuffer(row.links, "<i4").reshape(len(x), DEGREE), row.start)
            for at in range(0, len(queries), BATCH):
                part = queries.iloc[at:at + BATCH]
                q = np.stack(part["vec"].to_numpy()).astype(np.float64)
                found, _ = g.search(np.concatenate([q, np.zeros((len(q), 1))], axis=1), beam)
                for qid, v, ids in zip(part["query_id"].to_numpy(), q, found, strict=True):
                    ids = ids[ids >= 0]
                    score = np.array([np.dot(v, y) for y in x[ids]])  # on the original vectors, in double precision
                    # of equal scores all are looked at, as the smaller ids may stand in any of their classes
                    least = np.sort(score)[-(k + 1)] if len(score) > k else -np.inf
                    answers = [(-score[i], m) for i in np.flatnonzero(score >= least) for m in row.members[ids[i]] if m != qid]
                    for minus, m in sorted(answers)[:k]:
                        out["query_id"].append(qid)
                        out["vec_id"].append(m)
                        out["score"].append(-minus)
        return pd.DataFrame({"query_id": np.array(out["query_id"], np.int64), "vec_id": np.array(out["vec_id"], np.int64),
                             "score": np.array(out["score"], np.float64)})
    return run


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, vec of the rows that take part: an id, and a vector that is not null, empty or zero and all finite.  Of
    several for an id the least by value."""
    v = F.col("vec")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    return rows.filter(F.col("id").isNotNull() & v.isNotNull()
                       & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
                       & F.exists(v, lambda x: x != 0)).groupBy("id").agg(F.min("vec").alias("vec"))


def build_index(vectors: DataFrame, k: int, shard_rows: int) -> DataFrame:
    """The stored index of (id, vec): a row a shard, with the graph over its distinct vectors.

    Equal vectors are one point, with its k + 1 smallest ids, all that any
    answer can hold of them: a top-k limit that Spark applies before the
    shuffle, so a vector that a third of all rows share fills no task.
    Shards hold distinct vectors of one length, dealt by a hash.
    """
    w = Window.partitionBy("vec").orderBy("id")
    classes = (vectors.withColumn("n", F.row_number().over(w)).filter(F.col("n") <= k + 1)
               .groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("members"))
               .withColumn("class_id", F.element_at("members", 1)).withColumn("dim", F.size("vec")))
    classes = stored(classes, "classes")
    shards = max(1, -(-classes.count() // shard_rows))
    shard = F.pmod(F.xxhash64("class_id"), F.lit(shards)).cast("int")
    dealt = classes.withColumn("shard", shard).repartitionByRange(shards, "shard")
    return stored(dealt.groupBy("shard", "dim").applyInPandas(_build, INDEX), "index")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
            shard_rows: int = 4096, query_rows: int = 2048, beam: int = 96) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of largest inner product that beam searches of all shards find.

    ``queries`` are rows of the same kind; a query's own id is no answer.  They
    go in blocks of about ``query_rows`` to every shard, whose graph a task
    searches; each shard answers with its best k, and these are merged.  Memory
    a task: a shard and a block.

    Nearest first, ties to the smaller id.  Null, zero or non-finite vectors
    and null ids take no part; vectors of another length than the query's are
    no candidates.  Of rows that repeat an id the one of least vector counts.  Fewer candidates than k:
    all that are found.  Empty tables: no rows.
    """
    rows = stored(usable(vectors, id_col, vec_col), "vectors")
    asked = usable(queries, id_col, vec_col).select(F.col("id").alias("query_id"), "vec")
    index = build_index(rows, k, shard_rows)
    blocks = max(1, -(-asked.count() // query_rows))
    parts = index.select(F.col("shard").alias("shard"), F.col("dim").alias("dim"))  # a row a shard
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")
    sent = (asked.withColumn("block", block).withColumn("dim", F.size("vec"))
                 .join(parts, "dim").select("shard", "dim", "block", "query_id", "vec"))
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = (held.groupBy("shard", "dim", "block").cogroup(sent.groupBy("shard", "dim", "block"))
             .applyInPandas(_search(k, beam), "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
                 .select("query_id", "rank", "vec_id", "score"))
