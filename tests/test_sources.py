import os

from pyspark.sql import functions as F

from reelkit.sources import files, generators


def test_users_pipe_latin1(spark, tmp_path):
    p = tmp_path / "u.user"
    p.write_bytes("1|24|M|technician|85711\n2|53|F|other|T8H1N\n3|30|F|caf\xe9|V3N4P\n".encode("latin-1"))
    df = files.read_users(spark, str(p))
    rows = df.orderBy("user_id").collect()
    assert [r.zip_code for r in rows] == ["85711", "T8H1N", "V3N4P"]
    assert rows[2].occupation == "caf\xe9"


def test_items_and_ratings(spark, tmp_path):
    items = tmp_path / "u.item"
    flags = "|".join(["0"] * 22)
    items.write_text(f"1|Toy Story (1995)|{flags}\nx|Bad id|{flags}\n")
    it = files.read_items(spark, str(items)).collect()
    assert [(r.movie_id, r.title) for r in it] == [(1, "Toy Story (1995)")]
    tab = tmp_path / "u.data"
    tab.write_text("1\t10\t4\t881250949\n2\t10\t3\t881250950\n")
    r = files.read_ratings_tab(spark, str(tab))
    assert r.columns == ["user_id", "movie_id", "rating"] and r.count() == 2


def test_metadata_multiline_quotes(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text('id,title,overview,genres,release_date,budget,revenue,runtime,vote_average,vote_count\n'
                 '862,Toy Story,"A story\nwith ""quotes""","[{\'id\': 16, \'name\': \'Animation\'}]",'
                 '1995-10-30,30000000,373554033.0,81.0,7.7,5415.0\n')
    df = files.read_metadata(spark, str(p))
    r = df.first()
    assert r.overview == 'A story\nwith "quotes"' and r.budget == "30000000" and r.vote_count == 5415.0


def test_csv_and_parquet_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", ["x", "y"]), (2, "b", [])], "id long, title string, genres array<string>")
    out = str(tmp_path / "csv")
    files.write_table(df, out, fmt="csv")
    back = (spark.read.option("header", True).option("escape", '"')       # RFC 4180, as written
                 .schema("id long, title string, genres string").csv(out))
    got = back.select("id", F.from_json("genres", "array<string>").alias("g")).orderBy("id").collect()
    assert [r.g for r in got] == [["x", "y"], []]
    edges = spark.createDataFrame([(1, 2, 0.5, 1)], "src_id long, dst_id long, similarity double, rank int")
    ep = str(tmp_path / "edges")
    files.write_edges(edges, ep)
    assert files.read_edges(spark, [str(tmp_path / "missing"), ep]).first().similar_idx == 2
    assert files.read_edges(spark, str(tmp_path / "nope"), empty_if_missing=True).count() == 0
    tp = str(tmp_path / "titles")
    files.write_title_map(spark.createDataFrame([(3, "t"), (1, "t")], "id long, title string"), tp)
    assert files.read_title_map(spark, tp).first().id == 1


def test_fallback_only_when_empty(spark):
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(9,)], "x int")
    assert [r.x for r in files.with_fallback(a, b).collect()] == [1]
    assert [r.x for r in files.with_fallback(a.filter("x > 5"), b).collect()] == [9]


def test_generators(spark):
    u = generators.sample_users(spark, 100)
    r = u.agg(F.min("age"), F.max("age"), F.countDistinct("user_id")).first()
    assert r[0] >= 18 and r[1] <= 70 and r[2] == 100
    assert set(x.occupation for x in u.collect()) <= set(generators.OCCUPATIONS)
    rt = generators.sample_ratings(spark, 100, 50)
    per = rt.groupBy("user_id").agg(F.count("*").alias("n"), F.countDistinct("movie_id").alias("d"))
    assert per.filter((F.col("n") < 5) | (F.col("n") > 15) | (F.col("n") != F.col("d"))).count() == 0
    assert rt.agg(F.min("rating"), F.max("rating")).first() == (1, 5)
    assert generators.blobs(spark, 200).count() == 200
    m = generators.moons(spark, 200, noise=0.0).collect()
    assert all(abs(p.x) < 2.1 and -0.6 < p.y < 1.1 for p in m)
    assert os.path.basename(__file__)


def test_edges_from_csv_folder_parquet_or_nothing(spark, tmp_path):
    import pytest

    from reelkit.sources import files
    rows = [(1, 2, 0.5), (2, 1, 0.25)]
    df = spark.createDataFrame(rows, "movie_idx int, similar_idx int, similarity double")
    files.write_table(df, f"{tmp_path}/c", fmt="csv")
    files.write_table(df, f"{tmp_path}/p")
    for name in ("c", "p"):
        assert sorted(tuple(r) for r in files.read_edges(spark, [f"{tmp_path}/none", f"{tmp_path}/{name}"]).collect()) == rows
    assert files.first_existing(spark, [f"{tmp_path}/none"]) is None
    assert files.read_edges(spark, f"{tmp_path}/none", empty_if_missing=True).count() == 0
    with pytest.raises(FileNotFoundError):
        files.read_edges(spark, f"{tmp_path}/none")
