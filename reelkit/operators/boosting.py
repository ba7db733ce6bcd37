"""Gradient boosting of decision trees from histograms (M9), in DataFrame operations only.

Every round grows one tree a class (one for two classes) against the softmax
loss.  A level of all trees of a round is one aggregate: gradient and Hessian
sums by class, node, feature and bin, combined before the shuffle, whose size
depends on the model and not on the rows.  The best split of a node is found
in the same job; the driver sees one row a class and node.

Gradients are whole multiples of 1 / SCALE, so that their sums are exact, and
a fit is the same whatever the partitions, the order of tasks or the executors
that were lost on the way.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelkit.session import emptied, stored_at

SCALE = 1 << 20


@dataclass(frozen=True)
class Split:
    """Rows whose ``feature`` is ``threshold`` at most (bin ``bin`` or lower) go to the left child."""

    feature: int
    bin: int
    threshold: float
    gain: float


#: Node number (the root is 1, the children of n are 2n and 2n + 1) -> its split, or a leaf's value.
Tree = dict[int, "Split | float"]


def _walk(tree: Tree, left: Callable[[Split], Column], leaf: Callable[[int], Column], node: int = 1) -> Column:
    at = tree.get(node)
    if not isinstance(at, Split):
        return leaf(node)
    return F.when(left(at), _walk(tree, left, leaf, 2 * node)).otherwise(_walk(tree, left, leaf, 2 * node + 1))


def _sum_of_trees(trees: list[Tree], prior: float, features: Column) -> Column:
    width = max((max(t) for t in trees), default=1) + 1
    nodes = [t.get(n) for t in trees for n in range(width)]
    split = [n if isinstance(n, Split) else None for n in nodes]
    at = F.array(*[F.lit(n.feature if n else -1) for n in split]).cast("array<int>")
    threshold = F.array(*[F.lit(n.threshold if n else 0.0) for n in split]).cast("array<double>")
    value = F.array(*[F.lit(float(n) if isinstance(n, float) else 0.0) for n in nodes]).cast("array<double>")

    def step(n: Column, base: Column) -> Column:
        here = F.get(at, base + n)
        right = F.coalesce(F.get(features, here) > F.get(threshold, base + n), F.lit(False))
        return F.when(here < 0, n).otherwise(2 * n + right.cast("int"))

    def leaf(base: Column) -> Column:
        n = F.lit(1)
        for _ in range(width.bit_length() - 1):
            n = F.aggregate(F.array(n), F.lit(0), lambda _, m: step(m, base))  # binds n, so that it is made once
        return F.get(value, base + n)

    starts = F.array(*[F.lit(r * width) for r in range(len(trees))]).cast("array<int>")
    return F.aggregate(starts, F.lit(prior), lambda s, base: s + leaf(base))


@dataclass
class Booster:
    """A fitted model: per class a prior and, for each round, a tree that adds to its raw score.

    With two classes there is one raw score, that of the second class against
    the first.
    """

    classes: list[str]
    prior: list[float]
    rounds: list[list[Tree]] = field(default_factory=list)

    def raw(self, features: Column) -> list[Column]:
        """Raw scores of a row (or of a lambda's variable) with this array of features; a null goes to the left.

        Trees are literals that an expression of fixed size walks, whatever
        the number of rounds: each node's feature (none: -1), threshold and value.
        """
        return [_sum_of_trees([r[k] for r in self.rounds], prior, features) for k, prior in enumerate(self.prior)]

    def probabilities(self, features: Column) -> list[Column]:
        """Of each class, by its raw scores."""
        raw = self.raw(features)
        if len(self.classes) == 1:
            return [F.lit(1.0)]
        if len(raw) == 1:
            p = 1 / (1 + F.exp(-raw[0]))
            return [1 - p, p]
        top = F.greatest(*raw)
        total = sum((F.exp(r - top) for r in raw[1:]), F.exp(raw[0] - top))
        return [F.exp(r - top) / total for r in raw]

    def prediction(self, raw: list[Column]) -> Column:
        """The class of the highest raw score, the first of equal ones."""
        if not self.classes:
            return F.lit(None).cast("string")
        if len(self.classes) == 1:
            return F.lit(self.classes[0])
        if len(raw) == 1:
            return F.when(raw[0] > 0, F.lit(self.classes[1])).otherwise(F.lit(self.classes[0]))
        top = F.greatest(*raw)
        return F.coalesce(*[F.when(r == top, F.lit(c)) for r, c in zip(raw, self.classes, strict=True)])

    def importance(self, n_features: int) -> list[float]:
        """Each feature's share of the gain of all splits (zeros where nothing was split)."""
        total = [0.0] * n_features
        for trees in self.rounds:
            for tree in trees:
                for at in tree.values():
                    if isinstance(at, Split):
                        total[at.feature] += at.gain
        whole = sum(total)
        return [t / whole if whole else 0.0 for t in total]


def bin_edges(rows: DataFrame, bins: int, sample: int) -> list[list[float]]:
    """Per feature the quantiles that part its bins, of at most ``sample`` rows, those of least md5 of their id."""
    some = rows.orderBy(F.md5(F.col("id").cast("string")), "id").select("features").limit(sample)
    got = (some.select(F.posexplode("features").alias("feature", "x")).groupBy("feature")
               .agg(F.percentile_approx("x", [i / bins for i in range(1, bins)], max(sample, 100)).alias("q")).collect())
    found = {r["feature"]: r["q"] or [] for r in got}
    return [sorted(set(found[i])) for i in range(len(found))]


def _gradients(y: Column, f: Column, outputs: int) -> tuple[Column, Column]:
    """g and h arrays of the softmax (or logistic) loss, as whole multiples of 1 / SCALE."""
    whole = lambda v: F.floor(v * SCALE + 0.5).cast("long")
    if outputs == 1:
        p = [1 / (1 + F.exp(-f[0]))]
        hit = [(y == 1)]
    else:
        top = F.array_max(f)
        total = F.aggregate(f, F.lit(0.0), lambda s, v: s + F.exp(v - top))
        p = [F.exp(f[k] - top) / total for k in range(outputs)]
        hit = [y == k for k in range(outputs)]
    return (F.array(*[whole(q - t.cast("double")) for q, t in zip(p, hit, strict=True)]),
            F.array(*[whole(q * (1 - q)) for q in p]))


def _best_splits(state: DataFrame, trees: list[Tree], edges: list[list[float]], ridge: float, least_rows: int) -> list:
    """One row (k, node, g, h, n, best) for each open node of each tree: its sums and its best split, if it has one."""
    goes = lambda s: F.col("bins")[s.feature] <= s.bin
    open_ = [_walk(t, goes, lambda n, t=t: F.lit(None).cast("int") if n in t else F.lit(n)) for t in trees]
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), o.alias("node"), F.col("g")[k].alias("g"), F.col("h")[k].alias("h"))
                               for k, o in enumerate(open_)])).alias("o")
    rows = (state.select("bins", each).filter("o.node is not null")
                 .select("o.k", "o.node", "o.g", "o.h", F.posexplode("bins").alias("feature", "bin")))
    sums = rows.groupBy("k", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("k", "node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    x = sums.select("k", "node", "feature", "bin", *[F.sum(c).over(upto).alias(f"{c}l") for c in "ghn"],
                    *[F.sum(c).over(whole).alias(c) for c in "ghn"])
    real = lambda c: c / F.lit(float(SCALE))
    part = lambda g, h: real(g) * real(g) / (real(h) + ridge)
    gain = (part(F.col("gl"), F.col("hl")) + part(F.col("g") - F.col("gl"), F.col("h") - F.col("hl")) - part(F.col("g"), F.col("h")))
    usable = (F.col("nl") >= least_rows) & (F.col("n") - F.col("nl") >= least_rows)
    best = F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), "gl", "hl")
    return (x.groupBy("k", "node").agg(F.max("g").alias("g"), F.max("h").alias("h"), F.max("n").alias("n"),
                                       F.max(F.when(usable, best)).alias("best")).collect())


def fit(rows: DataFrame, rounds: int = 10, depth: int = 3, rate: float = 0.3, bins: int = 16, ridge: float = 1.0,
        least_rows: int = 1, sample: int = 10_000) -> Booster:
    """Boosted trees for ``rows`` (id, label, features array of numbers).

    Raw scores start at the classes' log shares.  Leaves are Newton steps
    -G / (H + ridge), shortened by ``rate``; a split is the one of most gain
    over all features and bins, the first feature and lowest bin of equal
    ones, and a node that none improves is a leaf.  Bins are parted by
    quantiles of a bounded sample (``bin_edges``); all else is of all rows.

    Between rounds the rows' raw scores and gradients are a Parquet table in
    the shared folder; the one before is emptied.  Null labels take no part.
    Labels are compared as text.  One class only, or no rows: no trees.
    """
    spark = rows.sparkSession
    known = rows.filter(F.col("label").isNotNull()).select("id", F.col("label").cast("string").alias("label"),
                                                           F.col("features").cast("array<double>").alias("features"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    classes, total = sorted(counts, key=lambda c: c.encode()), sum(counts.values())
    if len(classes) < 2:
        return Booster(classes, [])
    share = [math.log(counts[c] / total) for c in classes]
    prior = share if len(classes) > 2 else [share[1] - share[0]]
    model, outputs = Booster(classes, prior), len(prior)
    edges = bin_edges(known, bins, sample)
    table = F.array(*[F.array(*[F.lit(float(e)) for e in es]).cast("array<double>") for es in edges])
    binned = F.transform("features", lambda x, i: F.size(F.filter(F.element_at(table, i + 1), lambda e: e < x)))
    y = F.coalesce(*[F.when(F.col("label") == c, F.lit(k)) for k, c in enumerate(classes)])
    start = known.select(y.alias("y"), binned.alias("bins"), F.array(*[F.lit(p) for p in prior]).alias("f"))

    def with_gradients(df: DataFrame) -> tuple[DataFrame, str]:
        g, h = _gradients(F.col("y"), F.col("f"), outputs)
        return stored_at(df.select("y", "bins", "f", g.alias("g"), h.alias("h")))

    state, path = with_gradients(start)
    for r in range(rounds):
        trees, sums = [{} for _ in range(outputs)], [{} for _ in range(outputs)]
        leaf = lambda g, h: -(g / SCALE) / (h / SCALE + ridge) * rate
        for _ in range(depth):
            found = _best_splits(state, trees, edges, ridge, least_rows)
            for row in found:
                tree, node, best = trees[row["k"]], row["node"], row["best"]
                feature, at = (-best["f"], -best["b"]) if best else (0, 0)
                if best and best["gain"] > 0 and at < len(edges[feature]):
                    tree[node] = Split(feature, at, edges[feature][at], best["gain"])
                    sums[row["k"]][2 * node] = best["gl"], best["hl"]
                    sums[row["k"]][2 * node + 1] = row["g"] - best["gl"], row["h"] - best["hl"]
                else:
                    tree[node] = leaf(row["g"], row["h"])
            if not any(isinstance(trees[row["k"]][row["node"]], Split) for row in found):
                break
        for tree, own in zip(trees, sums, strict=True):
            for node, (g, h) in own.items():
                tree.setdefault(node, leaf(g, h))
        model.rounds.append(trees)
        if r < rounds - 1:
            goes = lambda s: F.col("bins")[s.feature] <= s.bin
            f = [F.col("f")[k] + _walk(t, goes, lambda n, t=t: F.lit(float(t[n]))) for k, t in enumerate(trees)]
            old = path
            state, path = with_gradients(state.select("y", "bins", F.array(*f).alias("f")))
            emptied(spark, old)
    emptied(spark, path)
    return model
