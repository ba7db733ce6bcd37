"""Catalogue entries: vector functions (X9-X11), standardisation (M6), boosting
(M9, M10, E8) and the model-based mining operators (M1-M5, M7, M8; rows-only)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelkit.operators import boosting, cf, evaluate, mining
from reelkit.plans.catalog import r6, register
from reelkit.sources import proxy

VEC_SQL = """
WITH v AS (SELECT vec_id AS id, CAST(label AS INTEGER) AS label, CAST(embedding AS DOUBLE[]) AS f
           FROM embeddings)
, lf AS (SELECT id, label, unnest(f) AS x, unnest(range(len(f))) AS pos FROM v)
, cent AS (SELECT label, list(c ORDER BY pos) AS c
           FROM (SELECT label, pos, avg(x) AS c FROM lf GROUP BY label, pos) GROUP BY label)
, j AS (SELECT v.id, v.label, v.f, cent.c, list_avg(v.f) AS ma, list_avg(cent.c) AS mb
        FROM v JOIN cent USING (label))
"""


def _centroid(spark, sf_dir):
    return mining.centroid_similarity(proxy.vectors(spark, sf_dir))


@register("X9_euclidean_to_centroid", VEC_SQL + """
SELECT id, round(sqrt(list_sum(list_transform(range(1, len(f) + 1), lambda i: (f[i] - c[i]) * (f[i] - c[i])))), 6)
           AS euclidean
FROM j""")
def x9_euclidean(spark, sf_dir):
    return _centroid(spark, sf_dir).select("id", r6("euclidean").alias("euclidean"))


@register("X10_pearson_to_centroid", VEC_SQL + """
, p AS (SELECT id,
               list_sum(list_transform(range(1, len(f) + 1), lambda i: (f[i] - ma) * (c[i] - mb))) AS num,
               sqrt(list_sum(list_transform(f, lambda x: (x - ma) * (x - ma))))
                 * sqrt(list_sum(list_transform(c, lambda x: (x - mb) * (x - mb)))) AS den
        FROM j)
SELECT id, round(CASE WHEN den > 0 THEN num / den END, 6) AS pearson FROM p""")
def x10_pearson(spark, sf_dir):
    return _centroid(spark, sf_dir).select("id", r6("pearson").alias("pearson"))


@register("X11_cosine_to_centroid", VEC_SQL + """
, p AS (SELECT id, list_sum(list_transform(range(1, len(f) + 1), lambda i: f[i] * c[i])) AS dot,
               sqrt(list_sum(list_transform(f, lambda x: x * x))) * sqrt(list_sum(list_transform(c, lambda x: x * x)))
                   AS den
        FROM j)
SELECT id, round(CASE WHEN den <> 0 THEN dot / den END, 6) AS cosine FROM p""")
def x11_cosine(spark, sf_dir):
    return _centroid(spark, sf_dir).select("id", r6("cosine").alias("cosine"))


@register("M6_standardize", VEC_SQL + """
, st AS (SELECT pos, avg(x) AS mu, stddev_pop(x) AS sd FROM lf GROUP BY pos)
SELECT id, pos, round(CASE WHEN sd > 0 THEN (x - mu) / sd ELSE 0.0 END, 6) AS z
FROM lf JOIN st USING (pos)""")
def m6_standardize(spark, sf_dir):
    z = mining.standardize(proxy.vectors(spark, sf_dir))
    return z.select("id", F.posexplode("features").alias("pos", "z")).select(
        "id", F.col("pos").cast("bigint").alias("pos"), r6("z").alias("z"))


# ------------------------------------------------------------------ rows-only model fits

@register("M1_kmeans", None)
def m1_kmeans(spark, sf_dir):
    assigned, _, _ = mining.kmeans(proxy.vectors(spark, sf_dir), k=3, seed=0)
    return assigned


@register("M2_kmeans_centres", None)
def m2_centres(spark, sf_dir):
    _, centres, _ = mining.kmeans(proxy.vectors(spark, sf_dir), k=3, seed=0)
    return centres


def _elbow_sql(max_k: int = 8, starts: int = 4, rounds: int = 10) -> str:
    """Lloyd's steps for every k and start, a table a round."""
    out = [f"""
WITH v AS MATERIALIZED (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)
, picked AS (SELECT x, row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR)), id) - 1 AS i FROM v)
, c0 AS MATERIALIZED (
  SELECT k, i // {max_k} AS s, i % {max_k} AS j, x AS c
  FROM picked JOIN (SELECT unnest(range(1, {max_k + 1})) AS k) ON i < {max_k * starts} AND i % {max_k} < k)"""]
    for r in range(rounds + 1):
        out.append(f"""
, a{r} AS MATERIALIZED (
  SELECT id, k, s, arg_min(j, dist) AS j, min(dist) AS dist
  FROM (SELECT id, k, s, j, list_distance(x, c) AS dist FROM v CROSS JOIN c{r}) GROUP BY id, k, s)""")
        if r < rounds:
            out.append(f"""
, c{r + 1} AS MATERIALIZED (
  SELECT k, s, j, coalesce(n.c, c.c) AS c
  FROM c{r} c LEFT JOIN (
    SELECT k, s, j, list(m ORDER BY p) AS c
    FROM (SELECT k, s, j, p, avg(e) AS m FROM (SELECT k, s, j, unnest(x) AS e, unnest(range(len(x))) AS p FROM a{r} JOIN v USING (id)) GROUP BY k, s, j, p)
    GROUP BY k, s, j) n USING (k, s, j))""")
    return "".join(out) + f"""
SELECT k, round(min(inertia) OVER (ORDER BY k), 4) AS inertia
FROM (SELECT k, min(cost) AS inertia FROM (SELECT k, s, sum(dist * dist) AS cost FROM a{rounds} GROUP BY k, s) GROUP BY k)"""


@register("M3_elbow", _elbow_sql())
def m3_elbow(spark, sf_dir):
    return mining.elbow(proxy.vectors(spark, sf_dir), max_k=8).select("k", F.round("inertia", 4).alias("inertia"))


@register("M4_spectral", None)
def m4_spectral(spark, sf_dir):
    return mining.spectral(proxy.vectors(spark, sf_dir), k=2)


@register("M5_cluster_contingency", None)
def m5_contingency(spark, sf_dir):
    v = proxy.vectors(spark, sf_dir)
    km, _, _ = mining.kmeans(v, k=2, seed=0)
    return mining.contingency(km, mining.spectral(v, k=2))


@register("M7_pca", None)
def m7_pca(spark, sf_dir):
    proj, _ = mining.pca(proxy.vectors(spark, sf_dir), k=2)
    return proj


@register("M7_explained_variance", None)
def m7_explained(spark, sf_dir):
    _, explained = mining.pca(proxy.vectors(spark, sf_dir), k=2)
    return explained


@register("M8_linear_discriminant", None)
def m8_lda(spark, sf_dir):
    return mining.linear_discriminant(proxy.vectors(spark, sf_dir), k=2)


# ------------------------------------------------------------------ boosting: one fit for M9, E8 and M10

ROUNDS, DEPTH, RATE, BINS = 10, 3, 0.3, 16
_FITTED: dict[tuple[str, str], boosting.Booster] = {}


def _booster(spark, sf_dir) -> tuple[boosting.Booster, DataFrame]:
    """The model of a session and table, fitted by the first query that asks, and the test rows."""
    split = cf.random_split(proxy.vectors(spark, sf_dir), "id", 0.25, 0)
    key = spark.sparkContext.applicationId, sf_dir
    if key not in _FITTED:
        _FITTED[key] = boosting.fit(split.filter(~F.col("is_test")), ROUNDS, DEPTH, RATE, BINS)
    return _FITTED[key], split.filter(F.col("is_test"))


def _boosting_sql() -> str:
    """The same booster in SQL: every round and level a table of its own."""
    one = float(boosting.SCALE)
    whole = lambda v: f"CAST(floor({v} * {one} + 0.5) AS BIGINT)"
    out = [f"""
WITH v AS (
  SELECT vec_id AS id, CAST(label AS VARCHAR) AS label, CAST(embedding AS DOUBLE[]) AS x,
         CAST('0x' || substr(md5(concat_ws('-', CAST(vec_id AS VARCHAR), '0')), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE < 0.25 AS is_test
  FROM embeddings)
, train AS (SELECT * FROM v WHERE NOT is_test AND label IS NOT NULL)
, class AS MATERIALIZED (SELECT label, row_number() OVER (ORDER BY label) - 1 AS y, ln(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM train)) AS prior
                         FROM train GROUP BY label)
, picked AS (SELECT unnest(x) AS x, unnest(range(len(x))) AS j FROM (SELECT x FROM train ORDER BY md5(CAST(id AS VARCHAR)), id LIMIT 10000))
, ranked AS (SELECT j, x, row_number() OVER (PARTITION BY j ORDER BY x) AS r, count(*) OVER (PARTITION BY j) AS n FROM picked)
, edge AS MATERIALIZED (
  SELECT j, list(DISTINCT x) AS es FROM ranked JOIN (SELECT unnest(range(1, {BINS})) AS i) ON r = greatest(1, ceil(i / {BINS}.0::DOUBLE * n)) GROUP BY j)
, s0 AS MATERIALIZED (
  SELECT id, v.label, is_test, y, b, (SELECT list(prior ORDER BY y) FROM class) AS f
  FROM v JOIN (SELECT id, list(len(list_filter(es, lambda e: e < x)) ORDER BY j) AS b
               FROM (SELECT id, unnest(x) AS x, unnest(range(len(x))) AS j FROM v) JOIN edge USING (j) GROUP BY id) USING (id)
  LEFT JOIN class ON v.label = class.label)"""]
    for r in range(ROUNDS):
        out.append(f"""
, n{r}_0 AS MATERIALIZED (
  SELECT id, is_test, b, k, {whole("(p - CASE WHEN y = k THEN 1 ELSE 0 END)")} AS g, {whole("p * (1 - p)")} AS h, 1 AS node, TRUE AS open,
         CAST(0 AS BIGINT) AS ng, CAST(0 AS BIGINT) AS nh
  FROM (SELECT id, is_test, y, b, unnest(range(len(f))) AS k,
               exp(unnest(f) - list_max(f)) / list_sum(list_transform(f, lambda z: exp(z - list_max(f)))) AS p FROM s{r}))""")
        for lv in range(DEPTH):
            out.append(f"""
, t{r}_{lv} AS MATERIALIZED (
  SELECT k, node, g, h, CASE WHEN best.gain > 0 THEN best.j END AS j, best.bin AS bin, best.gl AS gl, best.hl AS hl, best.gain AS gain
  FROM (SELECT k, node, max(g) AS g, max(h) AS h,
               (list({{'gain': gain, 'j': j, 'bin': bin, 'gl': gl, 'hl': hl}} ORDER BY gain DESC, j, bin) FILTER (nl < n AND nl >= 1))[1] AS best
        FROM (SELECT *, (gl / {one}) * (gl / {one}) / (hl / {one} + 1.0::DOUBLE) + ((g - gl) / {one}) * ((g - gl) / {one}) / ((h - hl) / {one} + 1.0::DOUBLE)
                        - (g / {one}) * (g / {one}) / (h / {one} + 1.0::DOUBLE) AS gain
              FROM (SELECT k, node, j, bin,
                           CAST(sum(g) OVER upto AS BIGINT) AS gl, CAST(sum(h) OVER upto AS BIGINT) AS hl, sum(n) OVER upto AS nl,
                           CAST(sum(g) OVER whole AS BIGINT) AS g, CAST(sum(h) OVER whole AS BIGINT) AS h, sum(n) OVER whole AS n
                    FROM (SELECT k, node, j, bin, sum(g) AS g, sum(h) AS h, count(*) AS n
                          FROM (SELECT k, node, g, h, unnest(b) AS bin, unnest(range(len(b))) AS j FROM n{r}_{lv} WHERE open AND NOT is_test)
                          GROUP BY k, node, j, bin)
                    WINDOW whole AS (PARTITION BY k, node, j), upto AS (PARTITION BY k, node, j ORDER BY bin)))
        GROUP BY k, node))
, n{r}_{lv + 1} AS MATERIALIZED (
  SELECT id, is_test, b, k, n.g, n.h, CASE WHEN j IS NULL THEN node WHEN b[j + 1] <= bin THEN 2 * node ELSE 2 * node + 1 END AS node,
         open AND j IS NOT NULL AS open,
         CASE WHEN NOT open THEN ng WHEN j IS NULL THEN t.g WHEN b[j + 1] <= bin THEN gl ELSE t.g - gl END AS ng,
         CASE WHEN NOT open THEN nh WHEN j IS NULL THEN t.h WHEN b[j + 1] <= bin THEN hl ELSE t.h - hl END AS nh
  FROM n{r}_{lv} n LEFT JOIN t{r}_{lv} t USING (k, node))""")
        out.append(f"""
, s{r + 1} AS MATERIALIZED (
  SELECT id, any_value(label) AS label, is_test, any_value(y) AS y, any_value(s.b) AS b,
         list(f[k + 1] + (-(ng / {one}) / (nh / {one} + 1.0::DOUBLE) * {RATE}::DOUBLE) ORDER BY k) AS f
  FROM s{r} s JOIN n{r}_{DEPTH} n USING (id, is_test) GROUP BY id, is_test)""")
    return "".join(out) + f"""
, predicted AS (SELECT id, label, (SELECT label FROM class WHERE y = list_position(f, list_max(f)) - 1) AS prediction FROM s{ROUNDS} WHERE is_test)
, gained AS (SELECT j, gain FROM ({" UNION ALL ".join(f"SELECT j, gain FROM t{r}_{lv}" for r in range(ROUNDS) for lv in range(DEPTH))}) WHERE j IS NOT NULL)
"""


BOOST_SQL = _boosting_sql()


@register("M9_boosted_classifier", BOOST_SQL + "SELECT id, label, prediction FROM predicted")
def m9_boosting(spark, sf_dir):
    model, test = _booster(spark, sf_dir)
    return mining.boosted_predictions(test, model)


@register("E8_accuracy", BOOST_SQL + """
SELECT round(avg(CASE WHEN label = prediction THEN 1.0::DOUBLE WHEN label IS NOT NULL THEN 0.0::DOUBLE END), 6) AS accuracy, count(*) AS n FROM predicted""")
def e8_accuracy(spark, sf_dir):
    model, test = _booster(spark, sf_dir)
    return evaluate.accuracy(mining.boosted_predictions(test, model), "label", "prediction").select(r6("accuracy").alias("accuracy"), "n")


@register("M10_feature_importance", BOOST_SQL + """
SELECT 'f' || CAST(j AS VARCHAR) AS feature, round(coalesce(sum(gain), 0) / (SELECT sum(gain) FROM gained), 6) AS importance
FROM (SELECT DISTINCT j FROM edge) LEFT JOIN gained USING (j) GROUP BY j""")
def m10_importance(spark, sf_dir):
    model, test = _booster(spark, sf_dir)
    width = test.select(F.max(F.size("features"))).first()[0]
    return spark.createDataFrame(mining.feature_importance(model, width)).select("feature", r6("importance").alias("importance"))
