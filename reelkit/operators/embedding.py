"""Spectral embedding (M4): leading eigenvectors of a normalised neighbour graph, by filtered subspace iteration."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelkit.session import cut_lineage, emptied, stored_at

#: Vectors that the iteration carries besides those asked for; they set how fast the others settle.
SPARE = 4
#: Terms of a block's sums that a task holds before it adds them up.
TERMS = 1 << 18

#: A block of points as one row: the bytes of its ids, ascending, of their scales, and of rows of p, x and y (or none).
_STATE = "blk int, ids binary, scale binary, p binary, x binary, y binary"
#: The links from one block to another as one row.
_CELL = "a_blk int, b_blk int, src binary, dst binary, weight binary"
_SUMS = "blk int, ids binary, sums binary"

#: (p, x, y = A x) of a block -> the p, x and y to store (None: not needed).
_Step = Callable[[np.ndarray, np.ndarray, np.ndarray], tuple]


def _bytes(a: np.ndarray | None) -> bytes:
    return b"" if a is None else np.ascontiguousarray(a, np.float64).tobytes()


def _rows(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.float64).reshape(n, -1)


def _block(blk: int, ids: np.ndarray, scale: bytes, p, x, y) -> pd.DataFrame:
    return pd.DataFrame({"blk": [blk], "ids": [ids.tobytes()], "scale": [scale], "p": [_bytes(p)], "x": [_bytes(x)], "y": [_bytes(y)]})


def _blk(col: str, blocks: int):
    return F.pmod(F.xxhash64(col), F.lit(blocks)).cast("int")


def _cells(links: DataFrame, blocks: int) -> DataFrame:
    """``links`` packed by the blocks of both ends."""
    def pack(key, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"a_blk": [key[0]], "b_blk": [key[1]], "src": [pdf["src"].to_numpy(np.int64).tobytes()],
                             "dst": [pdf["dst"].to_numpy(np.int64).tobytes()], "weight": [_bytes(pdf["weight"].to_numpy())]})

    placed = links.withColumn("a_blk", _blk("src", blocks)).withColumn("b_blk", _blk("dst", blocks))
    return cut_lineage(placed.repartition(min(blocks, 4000), "a_blk").groupBy("a_blk", "b_blk").applyInPandas(pack, _CELL))


def _start(points: DataFrame, blocks: int, b: int) -> DataFrame:
    """``points`` (id, scale, x0..) packed by block."""
    def pack(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        x = pdf[[f"x{j}" for j in range(b)]].to_numpy(np.float64)
        return _block(key[0], pdf["id"].to_numpy(np.int64), _bytes(pdf["scale"].to_numpy()), None, x, None)
    return points.withColumn("blk", _blk("id", blocks)).groupBy("blk").applyInPandas(pack, _STATE)


def _added(ids: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(ids, return_inverse=True)
    sums = np.empty((found.size, terms.shape[1]))
    for j in range(terms.shape[1]):
        sums[:, j] = np.bincount(place, terms[:, j], found.size)
    return found, sums


def _sums(batches):
    """Cells, each beside the block of its far ends -> weight * scale * x summed by near end, a row a block of these."""
    held: dict[int, list] = {}
    for pdf in batches:
        for r in pdf.itertuples(index=False):
            ids, src, dst = (np.frombuffer(a, np.int64) for a in (r.ids, r.src, r.dst))
            at = np.minimum(np.searchsorted(ids, dst), ids.size - 1)
            there = ids[at] == dst
            at, src, weight = at[there], src[there], np.frombuffer(r.weight, np.float64)[there]
            terms = (weight * np.frombuffer(r.scale, np.float64)[at])[:, None] * _rows(r.x, ids.size)[at]
            parts = held.setdefault(r.a_blk, [])
            parts.append((src, terms))
            if sum(s.size for s, _ in parts[1:]) > TERMS:
                held[r.a_blk] = [_added(*map(np.concatenate, zip(*parts, strict=True)))]
    for blk, parts in held.items():
        found, sums = _added(*map(np.concatenate, zip(*parts, strict=True)))
        yield pd.DataFrame({"blk": [blk], "ids": [found.tobytes()], "sums": [_bytes(sums)]})


def _times(cells: DataFrame, state: DataFrame, step: _Step) -> DataFrame:
    """``state`` after ``step``, which is given y, the normalised adjacency times x.

    Cells read the stored blocks of their far ends again (a nested loop of the
    two tables' partitions), so that no link and no term is shuffled: only the
    state and its sums are, once.
    """
    far = state.select(F.col("blk").alias("far"), "ids", "scale", "x").hint("shuffle_replicate_nl")
    pairs = cells.join(far, F.col("b_blk") == F.col("far")).select("a_blk", "src", "dst", "weight", "ids", "scale", "x")
    # the pairs of a partition of cells lie side by side; wherever they are cut, the sums are added below
    sums = pairs.coalesce(max(1, cells.rdd.getNumPartitions())).mapInPandas(_sums, _SUMS)

    def run(key, mine: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        r = mine.iloc[0]
        ids, scale = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["scale"], np.float64)
        x = _rows(r["x"], ids.size)
        y = np.zeros(x.shape)
        for some, add in zip(parts["ids"], parts["sums"], strict=True):
            some = np.frombuffer(some, np.int64)
            y[np.searchsorted(ids, some)] += _rows(add, some.size)
        return _block(key[0], ids, r["scale"], *step(_rows(r["p"], ids.size), x, scale[:, None] * y))
    return state.drop("y").groupBy("blk").cogroup(sums.groupBy("blk")).applyInPandas(run, _STATE)


def _turned(state: DataFrame, step: _Step) -> DataFrame:
    """``state`` after a ``step`` that needs no product: block by block."""
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                ids = np.frombuffer(r.ids, np.int64)
                yield _block(r.blk, ids, r.scale, *step(*(_rows(a, ids.size) for a in (r.p, r.x, r.y))))
    return state.mapInPandas(run, _STATE)


def _gram(state: DataFrame, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """x'x, x'y and y'y: 3 b^2 sums, whatever the number of points."""
    def run(batches):
        total = np.zeros((3, b, b))
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                x, y = (np.frombuffer(a, np.float64).reshape(-1, b) for a in (r.x, r.y))
                total += [x.T @ x, x.T @ y, y.T @ y]
        yield pd.DataFrame({"cell": np.arange(total.size), "v": total.ravel()})

    rows = state.select("x", "y").mapInPandas(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(3 * b * b)
    for r in rows:
        out[r["cell"]] = r["v"]
    xx, xy, yy = out.reshape(3, b, b)
    return xx, (xy + xy.T) / 2, yy


def _ritz(xx: np.ndarray, xy: np.ndarray, yy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, combinations of x that are orthonormal, residual norms), greatest value first; directions that x has
    lost are left out."""
    size, dirs = np.linalg.eigh(xx)
    held = size > max(size.max(), 0.0) * 1e-12
    white = dirs[:, held] / np.sqrt(size[held])
    values, turn = np.linalg.eigh(white.T @ xy @ white)
    order = np.argsort(-values)
    values, mix = values[order], white @ turn[:, order]
    left = np.einsum("ij,ij->j", mix, yy @ mix) - values ** 2
    return values, mix, np.sqrt(np.maximum(left, 0.0))


def _unpacked(state: DataFrame, mix: np.ndarray, k: int) -> DataFrame:
    """(id, e0..): the first ``k`` combinations ``mix`` of x, a row a point."""
    names = [f"e{j}" for j in range(min(k, mix.shape[1]))]

    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                ids = np.frombuffer(r.ids, np.int64)
                e = _rows(r.x, ids.size) @ mix[:, :len(names)]
                yield pd.DataFrame({"id": ids, **{n: e[:, j] for j, n in enumerate(names)}})
    return state.select("ids", "x").mapInPandas(run, ", ".join(["id long", *[f"{n} double" for n in names]]))


def spectral_embedding(links: DataFrame, k: int, degree: int = 10, rounds: int = 6, tolerance: float = 1e-3,
                       seed: int = 42, block_rows: int = 8192) -> tuple[DataFrame, np.ndarray]:
    """((id, e0.. of the points that have a link), eigenvalues): the ``k`` leading eigenvectors of D^-1/2 W D^-1/2, i.e. the
    last ones of the normalised Laplacian.

    ``links`` (src, dst, weight) holds every link both ways.  A round applies a
    Chebyshev polynomial of ``degree`` that is small on the part of the
    spectrum not wanted, then takes the best combinations of the ``k`` and
    ``SPARE`` vectors by their small Gram matrices, all that the driver sees.
    Points are hashed into blocks of about ``block_rows``; links are stored once
    by the blocks of their ends, and each factor of the polynomial meets them
    with the stored blocks of vectors (``_times``).  So what is moved grows with
    the points, some 300 bytes a point and factor for k = 2; what is read again
    grows with their square, 64 bytes a point and block.
    Ends when the ``k`` residuals are below ``tolerance``.  Vectors have unit
    length and are in the order of their eigenvalues; those of equal ones may
    be turned.  Fewer points than ``k``: as many vectors as there are.
    """
    spark = links.sparkSession
    links = cut_lineage(links.groupBy("src", "dst").agg(F.sum(F.col("weight").cast("double")).alias("weight")).dropna())
    points = cut_lineage(links.groupBy(F.col("src").alias("id")).agg((1 / F.sqrt(F.sum("weight"))).alias("scale")))
    n, b = points.count(), k + SPARE
    if not n:
        return spark.createDataFrame([], ", ".join(["id long", *[f"e{j} double" for j in range(k)]])), np.zeros(0)
    blocks = -(-n // block_rows)
    noise = [(F.pmod(F.xxhash64("id", F.lit(j), F.lit(seed)), F.lit(1 << 20)) / float(1 << 19) - 1.0).alias(f"x{j}") for j in range(b)]
    cells = _cells(links, blocks)
    state, path = stored_at(_start(points.select("id", "scale", *noise), blocks, b))

    def on(to: DataFrame) -> None:
        nonlocal state, path
        old = path
        state, path = stored_at(to)
        emptied(spark, old)

    on(_times(cells, state, lambda p, x, y: (None, x, y)))
    for step in range(rounds + 1):
        values, mix, residuals = _ritz(*_gram(state, b))
        b = mix.shape[1]
        if step == rounds or residuals[:k].max() < tolerance or b <= k:
            break
        centre, half = (values[-1] - 1) / 2, (values[-1] + 1) / 2  # not wanted: -1 to the least value carried
        half = max(half, 1e-6)
        # p: the polynomial before, x: the present one; y = A x is at hand after the first look
        on(_turned(state, lambda p, x, y: (x @ mix, (y @ mix - centre * (x @ mix)) / half, None)))
        for _ in range(degree - 1):
            on(_times(cells, state, lambda p, x, y: (x, 2 * (y - centre * x) / half - p, None)))
        on(_times(cells, state, lambda p, x, y: (None, x, y)))
    return _unpacked(state, mix, k), values[:k]
