"""A neighbour graph (M4): stored blocks of points meet in tasks, exactly."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelkit.operators.relational import top_n_per_group
from reelkit.session import cut_lineage

#: A block of points as one row: the bytes of its ids, ascending, and of their vectors.
_PACKED = "blk int, ids binary, vecs binary"
_LINKS = "src long, dst long, dist double"
#: Pairs of points whose distances a task holds at once, and whose vectors it holds besides.
PAIRS, SIDE_BY_SIDE = 1 << 22, 1 << 16


def _packed(key, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("id")
    return pd.DataFrame({"blk": [key[0]], "ids": [pdf["id"].to_numpy(np.int64).tobytes()],
                         "vecs": [np.vstack(pdf["vec"].to_list()).astype(np.float64).tobytes()]})


class _Nearest:
    """The n nearest other points of every point of a block among those met so far (ties: smaller id)."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, n: int):
        self.ids, self.x, self.n = ids, x, n
        self.size, self.worst = (x * x).sum(axis=1), np.full(ids.size, np.inf)  # a point's n-th distance, once it has n
        self.row, self.dst, self.dist = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)

    def meet(self, ids: np.ndarray, y: np.ndarray) -> None:
        """Products of the vectors tell, to rounding, which pairs are near enough; differences give their distances."""
        size, high = (y * y).sum(axis=1), max(1, PAIRS // ids.size)
        right = np.column_stack([y, size / -2]).T
        for top in range(0, self.ids.size, high):
            at = slice(top, top + high)
            mine = self.size[at]
            g = np.column_stack([self.x[at], np.ones(mine.size)]) @ right  # (|x|^2 - distance) / 2
            slack = 1e-11 * (mine + size.max())
            least = (mine - self.worst[at] - slack) / 2
            if np.isinf(least).any() and ids.size > self.n + 1:  # the point itself may be one
                least = np.maximum(least, np.partition(g, ids.size - 1 - self.n, axis=1)[:, ids.size - 1 - self.n] - slack)
            r, c = np.nonzero(g >= least[:, None])
            other = self.ids[r + top] != ids[c]
            self._keep(r[other] + top, c[other], ids, y)

    def _keep(self, r: np.ndarray, c: np.ndarray, ids: np.ndarray, y: np.ndarray) -> None:
        for at in range(0, r.size, SIDE_BY_SIDE):
            p, q = r[at:at + SIDE_BY_SIDE], c[at:at + SIDE_BY_SIDE]
            d = ((self.x[p] - y[q]) ** 2).sum(axis=1)
            some = d <= self.worst[p]
            row, dst, dist = (np.concatenate(z) for z in ((self.row, p[some]), (self.dst, ids[q[some]]), (self.dist, d[some])))
            order = np.lexsort((dst, dist, row))
            row = row[order]
            place = np.arange(row.size) - np.searchsorted(row, row)
            order, full = order[place < self.n], order[place == self.n - 1]
            last = row[place == self.n - 1]
            self.worst[last] = dist[full]
            self.row, self.dst, self.dist = row[place < self.n], dst[order], dist[order]


def _nearest_of_blocks(n: int):
    """Pairs of packed blocks -> the n nearest of each point of the left block among the right blocks that a task meets."""
    def points(r, side):
        ids = np.frombuffer(getattr(r, side + "ids"), np.int64)
        return ids, np.frombuffer(getattr(r, side + "vecs"), np.float64).reshape(ids.size, -1)

    def run(batches):
        best: dict[int, _Nearest] = {}
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                if r.a_blk not in best:
                    ids, x = points(r, "a_")
                    best[r.a_blk] = _Nearest(ids.copy(), x.copy(), n)
                best[r.a_blk].meet(*points(r, "b_"))
        for found in best.values():
            yield pd.DataFrame({"src": found.ids[found.row], "dst": found.dst, "dist": found.dist})
    return run


def neighbour_graph(vectors: DataFrame, n: int = 10, block_rows: int = 4096) -> DataFrame:
    """(src, dst, dist): the ``n`` nearest other points of each point of ``vectors`` (id, features), squared distances.

    Points are hashed into blocks of about ``block_rows``, each stored as one
    packed row.  Every block meets every block in a cross join, which reads the
    stored rows again; a task holds n links a point of its left blocks, and the
    distances of ``PAIRS`` pairs.  So what is shuffled grows with the points:
    the vectors once, and n links a point and task that met it.  The work grows
    with their square, as matrix products.  Repeated ids are one point; points
    without a vector, or with a component that is null or not finite, have no links.  Ties go to the smaller id.
    """
    points = (vectors.select(F.col("id").cast("long").alias("id"), F.col("features").cast("array<double>").alias("vec"))
                     .filter("id is not null and vec is not null and forall(vec, x -> x is not null and abs(x) < double('inf'))").groupBy("id").agg(F.min("vec").alias("vec")))
    points = cut_lineage(points)
    blocks = max(1, -(-points.count() // block_rows))
    placed = points.withColumn("blk", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    packed = cut_lineage(placed.repartition(min(blocks, 4000), "blk").groupBy("blk").applyInPandas(_packed, _PACKED))
    left, right = (packed.select(*[F.col(c).alias(side + c) for c in packed.columns]) for side in ("a_", "b_"))
    # a left partition's pairs lie side by side; wherever they are cut, the last step below is exact
    pairs = left.crossJoin(right).coalesce(max(1, left.rdd.getNumPartitions()))
    links = pairs.mapInPandas(_nearest_of_blocks(n), _LINKS)
    return top_n_per_group(links, "src", [F.asc("dist"), F.asc("dst")], n, "r").select("src", "dst", "dist")
