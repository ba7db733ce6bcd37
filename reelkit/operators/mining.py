"""Data mining on feature vectors (X9-X11 applied, M1-M11).

Vectors are ``array<double>`` columns.  Per-dimension statistics use the long
form ``(id, pos, x)`` so they are ordinary grouped aggregates whose result
size is bounded by the dimension d (and the number of classes), never by the
number of rows.  Only d-sized or d x d results reach the driver (a PCA /
discriminant eigen-solve), and the projection goes back as literal arrays.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from reelkit.functions.scores import cosine, euclidean, pearson
from reelkit.operators import boosting
from reelkit.operators.embedding import spectral_embedding
from reelkit.operators.neighbours import neighbour_graph
from reelkit.operators.relational import global_position
from reelkit.session import cut_lineage


def long_form(vectors: DataFrame, id_col: str = "id", feat: str = "features") -> DataFrame:
    return vectors.select(id_col, "label", F.posexplode(feat).alias("pos", "x"))


def class_centroids(vectors: DataFrame, feat: str = "features") -> DataFrame:
    """(label, centroid array) from per-(label, dim) means; d values per class."""
    lf = long_form(vectors, feat=feat)
    means = lf.groupBy("label", "pos").agg(F.avg("x").alias("c"))
    return (means.groupBy("label")
                 .agg(F.array_sort(F.collect_list(F.struct("pos", "c"))).alias("_e"))
                 .select("label", F.col("_e.c").alias("centroid")))


def centroid_similarity(vectors: DataFrame) -> DataFrame:
    """Distance, cosine and Pearson of every vector to its class centroid."""
    j = vectors.join(class_centroids(vectors), "label")
    return j.select("id", "label",
                    euclidean("features", "centroid").alias("euclidean"),
                    cosine("features", "centroid").alias("cosine"),
                    pearson("features", "centroid").alias("pearson"))


# --------------------------------------------------------------------------
# M6 standardise
# --------------------------------------------------------------------------

def standardize(vectors: DataFrame, feat: str = "features") -> DataFrame:
    """M6: zero mean, unit *population* variance per dimension (constant dims -> 0)."""
    lf = long_form(vectors, feat=feat)
    st = lf.groupBy("pos").agg(F.avg("x").alias("mu"), F.stddev_pop("x").alias("sd"))
    z = (lf.join(F.broadcast(st), "pos")  # d rows: bounded by the dimension
           .select("id", "label", "pos",
                   F.when(F.col("sd") > 0, (F.col("x") - F.col("mu")) / F.col("sd")).otherwise(F.lit(0.0))
                   .alias("z")))
    return (z.groupBy("id", "label")
             .agg(F.array_sort(F.collect_list(F.struct("pos", "z"))).alias("_e"))
             .select("id", "label", F.col("_e.z").alias("features")))


def _project(vectors: DataFrame, basis: np.ndarray, prefix: str) -> DataFrame:
    """Rows times a small d x k basis, as array dot products (no Python worker)."""
    cols = []
    for j in range(basis.shape[1]):
        w = F.array(*[F.lit(float(v)) for v in basis[:, j]])
        dot = F.aggregate(F.zip_with("features", w, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
        cols.append(dot.alias(f"{prefix}{j + 1}"))
    return vectors.select("id", "label", *cols)


def _scatter_sums(z: DataFrame, d: int) -> pd.DataFrame:
    """Per class: n, sum x (d), sum x x^T (d x d), computed per partition with numpy
    (mapInPandas) and reduced by a grouped sum; result size classes x d^2."""
    schema = StructType([StructField("label", LongType()), StructField("i", LongType()),
                         StructField("j", LongType()), StructField("v", DoubleType())])

    def partial(batches):
        acc: dict = {}
        for pdf in batches:
            for label, g in pdf.groupby("label"):
                x = np.vstack(g["features"].to_numpy()).astype(float)
                n, s, ss = acc.get(label, (0, np.zeros(d), np.zeros((d, d))))
                acc[label] = (n + len(x), s + x.sum(0), ss + x.T @ x)
        rows = []
        for label, (n, s, ss) in acc.items():
            rows.append((label, -1, -1, float(n)))
            rows.extend((label, -1, i, float(s[i])) for i in range(d))
            ii, jj = np.meshgrid(range(d), range(d), indexing="ij")
            rows.extend(zip([label] * d * d, ii.ravel().tolist(), jj.ravel().tolist(), ss.ravel().tolist()))
        yield pd.DataFrame(rows, columns=["label", "i", "j", "v"])

    parts = z.select(F.col("label").cast("long"), "features").mapInPandas(partial, schema)
    return parts.groupBy("label", "i", "j").agg(F.sum("v").alias("v")).toPandas()


def pca(vectors: DataFrame, k: int = 2) -> tuple[DataFrame, DataFrame]:
    """M7: standardise, project on the top-k principal axes.

    Returns (projection(id, label, PC1..PCk), explained(component, ratio)).
    The covariance is reduced distributedly to d x d; the sign of each axis is
    fixed so its largest-magnitude loading is positive.
    """
    z = standardize(vectors)
    d = len(z.select("features").first()[0])
    sums = _scatter_sums(z.withColumn("label", F.lit(0)), d)
    n = sums[(sums.i == -1) & (sums.j == -1)].v.sum()
    mean = np.zeros(d)
    cov = np.zeros((d, d))
    for r in sums.itertuples():
        if r.i == -1 and r.j >= 0:
            mean[r.j] += r.v
        elif r.i >= 0:
            cov[r.i, r.j] += r.v
    mean /= n
    cov = cov / n - np.outer(mean, mean)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1][:k]
    basis = vecs[:, order]
    basis *= np.sign(basis[np.abs(basis).argmax(0), range(k)])
    ratio = vals[order] / vals.sum()
    spark = vectors.sparkSession
    explained = spark.createDataFrame([(f"PC{i + 1}", float(r)) for i, r in enumerate(ratio)],
                                      "component string, ratio double")
    centred = z.select("id", "label", F.zip_with("features", F.array(*[F.lit(float(m)) for m in mean]),
                                                 lambda a, b: a - b).alias("features"))
    return _project(centred, basis, "PC"), explained


def linear_discriminant(vectors: DataFrame, k: int = 2) -> DataFrame:
    """M8: Fisher discriminant projection to k axes (not topic LDA).

    Within- and between-class scatter come from per-class sums (d x d per
    class); the generalized eigenproblem S_w^-1 S_b is solved on the driver.
    """
    z = standardize(vectors)
    d = len(z.select("features").first()[0])
    sums = _scatter_sums(z, d)
    labels = sorted(sums.label.unique())
    total_n, total_s = 0.0, np.zeros(d)
    sw = np.zeros((d, d))
    per = {}
    for lab in labels:
        g = sums[sums.label == lab]
        n = g[(g.i == -1) & (g.j == -1)].v.sum()
        s = np.zeros(d)
        ss = np.zeros((d, d))
        for r in g.itertuples():
            if r.i == -1 and r.j >= 0:
                s[r.j] = r.v
            elif r.i >= 0:
                ss[r.i, r.j] = r.v
        mu = s / n
        sw += ss - n * np.outer(mu, mu)
        per[lab] = (n, mu)
        total_n += n
        total_s += s
    mu_all = total_s / total_n
    sb = sum(n * np.outer(mu - mu_all, mu - mu_all) for n, mu in per.values())
    vals, vecs = np.linalg.eig(np.linalg.pinv(sw) @ sb)
    order = np.argsort(vals.real)[::-1][:k]
    basis = vecs[:, order].real
    basis /= np.linalg.norm(basis, axis=0)
    basis *= np.sign(basis[np.abs(basis).argmax(0), range(k)])
    return _project(z, basis, "C")


# --------------------------------------------------------------------------
# clustering (M1-M5)
# --------------------------------------------------------------------------

def _vec(df: DataFrame, feat: str = "features") -> DataFrame:
    return df.withColumn("_v", array_to_vector(feat))


def kmeans(vectors: DataFrame, k: int = 3, seed: int = 0, max_iter: int = 20,
           init_mode: str = "k-means||"):
    """M1/M2: fit; returns (assignments(id, label, cluster), centres(cluster, centre), cost)."""
    model = KMeans(k=k, seed=seed, maxIter=max_iter, initMode=init_mode, featuresCol="_v",
                   predictionCol="cluster").fit(_vec(vectors))
    assigned = model.transform(_vec(vectors)).select("id", "label", "cluster")
    spark = vectors.sparkSession
    centres = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())],
                                    "cluster int, centre array<double>")
    return assigned, centres, model.summary.trainingCost


def _lloyd_sums(books: list[np.ndarray]):
    """Per partition and for every codebook of ``books``: each centre's count and sum of its rows, and the cost of all."""
    def run(batches):
        d = books[0].shape[1]
        sums = [np.zeros((len(b), d + 1)) for b in books]
        costs = np.zeros(len(books))
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.vstack(pdf["features"].to_numpy()).astype(float)
            for b, (book, acc) in enumerate(zip(books, sums, strict=True)):
                near = (np.einsum("ij,ij->i", book, book) - 2 * x @ book.T).argmin(axis=1)
                np.add.at(acc[:, d], near, 1)
                np.add.at(acc[:, :d], near, x)
                costs[b] += ((x - book[near]) ** 2).sum()
        flat = [(b, j, p, float(v)) for b, acc in enumerate(sums) for j in range(len(acc)) if acc[j, d] for p, v in enumerate(acc[j])]
        flat += [(b, -1, -1, float(c)) for b, c in enumerate(costs)]
        yield pd.DataFrame(flat, columns=["book", "centre", "pos", "v"])
    return run


def elbow(vectors: DataFrame, max_k: int = 8, starts: int = 4, rounds: int = 10) -> DataFrame:
    """M3: (k, inertia) for k = 1..max_k, the best of several starts after ``rounds`` of Lloyd's steps.

    All k and all starts step together: a round is one pass over the vectors
    and one aggregate of at most starts x max_k^2 / 2 x d sums, which is what
    the driver sees.  Start number s of k takes the rows s * max_k to s * max_k
    + k - 1 in the order of the md5 of their ids, so that it is the same in
    every run.  A centre without rows stays.  A clustering of k - 1 centres is
    one of k with a centre unused, so inertia never rises with k.  Fewer rows
    than centres: as many centres as there are.  No rows: no result rows.
    """
    spark = vectors.sparkSession
    v = vectors.select("id", "features")
    some = v.orderBy(F.md5(F.col("id").cast("string")), "id").limit(max_k * starts).collect()  # a bounded few
    first = [np.array(r["features"], float) for r in some]
    keys = [(k, s) for k in range(1, max_k + 1) for s in range(starts) if first[s * max_k:s * max_k + k]]
    books = [np.stack(first[s * max_k:s * max_k + k]) for k, s in keys]
    if not books:
        return spark.createDataFrame([], "k int, inertia double")
    d = books[0].shape[1]
    for step in range(rounds + 1):
        got = (v.select("features").mapInPandas(_lloyd_sums(books), "book int, centre int, pos int, v double")
                .groupBy("book", "centre", "pos").agg(F.sum("v").alias("v")).toPandas())
        if step == rounds:
            break
        sums = got[got.centre >= 0]
        totals = [np.zeros((len(b), d + 1)) for b in books]
        for book, centre, pos, value in sums.itertuples(index=False):
            totals[book][centre, pos] = value
        for b, t in zip(books, totals, strict=True):
            used = t[:, d] > 0
            b[used] = t[used, :d] / t[used, d:]
    best, rows = float("inf"), []
    costs = dict(zip(got[got.centre < 0].book, got[got.centre < 0].v, strict=True))
    for k in range(1, max_k + 1):
        best = min([best, *(costs[b] for b, key in enumerate(keys) if key[0] == k)])
        rows.append((k, float(best)))
    return spark.createDataFrame(rows, "k int, inertia double")


def knn_graph(vectors: DataFrame, n_neighbors: int = 10) -> DataFrame:
    """Symmetric kNN graph (src, dst, weight), exact by blocks (M4 input; ``neighbours.neighbour_graph``)."""
    near = neighbour_graph(vectors.select(F.col("id").cast("long").alias("id"), "features"), n_neighbors)
    both = near.select("src", "dst").unionByName(near.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return both.distinct().withColumn("weight", F.lit(1.0))


def spectral(vectors: DataFrame, k: int = 2, n_neighbors: int = 10, seed: int = 42, starts: int = 3) -> DataFrame:
    """M4: spectral clustering on the kNN graph; (id, cluster).

    The ``k`` leading eigenvectors of the normalised graph (``spectral_embedding``),
    divided by the root of a point's degree, are clustered by k-means, the best
    of several starts.  A point without another one has no edge: it is a
    cluster of its own, numbered from k on by id.
    """
    g = cut_lineage(knn_graph(vectors, n_neighbors))  # read again and again
    e, values = spectral_embedding(g, k, rounds=3, tolerance=1e-2, seed=seed)  # finer than k-means needs
    degrees = g.groupBy(F.col("src").alias("id")).agg(F.sqrt(F.sum("weight")).alias("root"))
    rows = e.join(degrees, "id").select("id", F.lit(None).cast("string").alias("label"),
                                        F.array(*[F.col(f"e{j}") / F.col("root") for j in range(max(1, len(values)))]).alias("features"))
    rows = cut_lineage(rows)
    if len(values):
        found = min((kmeans(rows, k, seed + s, init_mode="random") for s in range(starts)), key=lambda fit: fit[2])[0].select("id", "cluster")
    else:
        found = rows.select("id", F.lit(0).alias("cluster"))
    alone = vectors.select(F.col("id").cast("long").alias("id")).join(found, "id", "left_anti")
    numbered = global_position(alone, [F.asc("id")], "_n").select("id", (F.lit(k - 1) + F.col("_n")).cast("int").alias("cluster"))
    return found.unionByName(numbered)


def contingency(a: DataFrame, b: DataFrame, a_col: str = "kmeans", b_col: str = "spectral") -> DataFrame:
    """M5: counts of (clustering A, clustering B) label pairs."""
    return (a.select("id", F.col("cluster").alias(a_col)).join(b.select("id", F.col("cluster").alias(b_col)), "id")
             .groupBy(a_col, b_col).agg(F.count(F.lit(1)).alias("n")))


# --------------------------------------------------------------------------
# boosting (M9, M10, E8)
# --------------------------------------------------------------------------

def boosted_classifier(vectors: DataFrame, test_size: float = 0.25, seed: int = 0, max_iter: int = 20,
                       depth: int = 3, rate: float = 0.3) -> tuple[DataFrame, boosting.Booster]:
    """M9: multinomial boosted trees on a 75/25 split; (predictions(id, label, prediction), the fitted model)."""
    from reelkit.operators.cf import random_split
    split = random_split(vectors, "id", test_size, seed)
    model = boosting.fit(split.filter(~F.col("is_test")), max_iter, depth, rate)
    return boosted_predictions(split.filter(F.col("is_test")), model), model


def boosted_predictions(vectors: DataFrame, model: boosting.Booster) -> DataFrame:
    """(id, label, prediction) of every row, in the scan's own stage.  Raw scores are columns of their own, so that the
    trees are walked once."""
    raw = model.raw(F.col("features"))
    scored = vectors.select("id", F.col("label").cast("string").alias("label"), F.array(*raw).alias("raw"))
    return scored.select("id", "label", model.prediction([F.col("raw")[k] for k in range(len(raw))]).alias("prediction"))


def feature_importance(model: boosting.Booster, n_features: int, names: list[str] | None = None) -> pd.DataFrame:
    """Each feature's share of all splits' gain, sorted (d rows)."""
    names = names or [f"f{i}" for i in range(n_features)]
    return pd.DataFrame({"feature": names, "importance": model.importance(n_features)}).sort_values(
        ["importance", "feature"], ascending=[False, True])


__all__ = ["centroid_similarity", "standardize", "pca", "linear_discriminant", "kmeans", "elbow",
           "spectral", "contingency", "boosted_classifier", "boosted_predictions", "feature_importance", "vector_to_array"]
