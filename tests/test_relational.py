from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelkit.operators.cf import salted_self_join
from reelkit.operators.relational import hash_slice, position_in_group, surrogate_id, top_n_per_group


def test_position_in_group_matches_row_number_with_forced_slices(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.md5(F.col("id").cast("string")).alias("h"),
                                  "id")
    cnt = df.groupBy("g").count()
    d = df.join(cnt, "g")
    got = position_in_group(d, "g", ["h", "id"], hash_slice(F.col("h"), F.col("count"), target=100), "pos")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("h", "id")))
    diff = got.join(want, ["g", "id"]).filter(F.col("pos") != F.col("rn")).count()
    assert diff == 0 and got.count() == 5000


def test_surrogate_ids_dense(spark):
    df = spark.range(0, 30000, 7).withColumnRenamed("id", "k")
    ids = surrogate_id(df, "k", "sid")
    r = ids.agg(F.min("sid"), F.max("sid"), F.countDistinct("sid")).first()
    assert (r[0], r[1], r[2]) == (1, df.count(), df.count())
    assert ids.filter(F.col("k") == 14).first().sid == 3


def test_salted_self_join_equals_plain(spark):
    rows = [(k, m, float(m % 5)) for k in range(3) for m in range(k * 40 + 3)]  # key 2 is hot
    df = spark.createDataFrame(rows, "key long, member long, v double")
    plain = df.alias("a").join(df.alias("b"), "key").select(
        "key", F.col("a.member").alias("a_member"), F.col("b.member").alias("b_member"))
    salted = salted_self_join(df, "key", "member", target=10).select("key", "a_member", "b_member")
    assert salted.count() == plain.count()
    assert salted.exceptAll(plain).count() == 0
    upper = salted_self_join(df, "key", "member", target=10, upper_only=True)
    assert upper.count() == plain.filter(F.col("a_member") < F.col("b_member")).count()
    assert upper.filter(F.col("a_member") >= F.col("b_member")).count() == 0


def test_top_n_per_group_ties(spark):
    df = spark.createDataFrame([(1, 10, 0.5), (1, 11, 0.5), (1, 12, 0.9), (2, 10, 0.1)], "g int, d int, s double")
    out = top_n_per_group(df, "g", [F.desc("s"), F.asc("d")], 2).orderBy("g", "rank").collect()
    assert [(r.g, r.d) for r in out] == [(1, 12), (1, 10), (2, 10)]


def test_cap_catalogue_default_keeps_all(spark):
    from reelkit.operators.relational import cap_catalogue
    df = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 9.0), (4, None)], "id long, vote_count double")
    assert cap_catalogue(df).count() == 4
    assert [r.id for r in cap_catalogue(df, 2).collect()] == [2, 3]


def test_exact_quantile_is_numpys(spark):
    import numpy as np

    from reelkit.operators.relational import exact_quantile
    rng = np.random.default_rng(5)
    for values in ([3.0], [1.0, 2.0], [5.0] * 40 + [7.0], rng.normal(size=999).round(2).tolist(), rng.integers(0, 9, 500).astype(float).tolist()):
        df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
        for p in (0.0, 0.25, 0.5, 0.8, 0.9, 1.0):
            got = spark.range(1).select(exact_quantile(df, "x", p, accuracy=100)).first()[0]
            assert abs(got - np.quantile(values, p)) < 1e-9
    assert spark.range(1).select(exact_quantile(df.filter("x > 100"), "x", 0.5)).first()[0] is None


def test_global_position(spark):
    from reelkit.operators.relational import global_position
    keys = [i * i * 1_000_003 for i in range(300)]
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(7)
    assert sorted((r.k, r.pos) for r in global_position(df, [F.asc("k")]).collect()) == [(k, i + 1) for i, k in enumerate(keys)]


def test_exact_quantiles_narrow_down(spark):
    import numpy as np

    from reelkit.operators.relational import exact_quantiles
    rng = np.random.default_rng(8)
    for values in (rng.normal(size=4000), np.concatenate([[5.0] * 2500, rng.normal(5, 1, 1500)]), rng.integers(0, 6, 3000).astype(float),
                   np.concatenate([[-1e300] * 900, rng.normal(size=200), [1e300] * 900])):
        df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(6)
        ps = [0.0, 0.1, 0.25, 0.5, 0.8, 0.999, 1.0]
        got = exact_quantiles(df, "x", ps, accuracy=100, ordered=30)
        for a, p in zip(got, ps, strict=True):
            want = np.quantile(values, p)
            assert abs(a - want) <= 1e-9 * max(1, abs(want)), p
