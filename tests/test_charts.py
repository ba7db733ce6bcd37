from pyspark.sql import functions as F

from reelkit.plans.charts import (chart_defaults, explode_genres, knowledge_chart, popularity_chart,
                                  runtime_range, year_range)

SCHEMA = "id long, title string, genres array<string>, runtime double, year int, vote_count double, vote_average double"


def _movies(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_popularity_chart_ties_and_bounds(spark):
    rows = [(1, "a", ["x"], 45.0, 2000, 100.0, 7.0),   # runtime exactly on the lower bound
            (2, "b", ["x"], 300.0, 2000, 100.0, 7.0),  # upper bound, same score as 1 -> tie by id
            (3, "c", ["x"], 301.0, 2000, 500.0, 9.0),  # outside the window
            (4, "d", ["x"], None, 2000, 500.0, 9.0),   # null runtime
            (5, "e", ["x"], 100.0, 2000, 1.0, 10.0)]   # below the vote threshold
    out = popularity_chart(_movies(spark, rows), 45, 300, 0.5, top_n=25).collect()
    assert [r.id for r in out] == [1, 2]
    assert out[0].score == out[1].score


def test_zero_votes_threshold_zero(spark):
    rows = [(1, "a", [], 60.0, 2000, 0.0, 5.0), (2, "b", [], 60.0, 2000, 0.0, 6.0)]
    out = popularity_chart(_movies(spark, rows), 45, 300, 0.8).collect()
    assert {r.id for r in out} == {1, 2}
    assert all(r.score is None for r in out)   # 0/0 -> NULL, not an ANSI error


def test_explode_keeps_movies_without_genres(spark):
    rows = [(1, "a", [], 60.0, 2000, 1.0, 5.0), (2, "b", None, 60.0, 2000, 1.0, 5.0),
            (3, "c", ["g1", "g2", "g3", "g4"], 60.0, 2000, 1.0, 5.0)]
    g = explode_genres(_movies(spark, rows))
    assert g.filter(F.col("genre").isNull()).count() == 2
    assert g.filter(F.col("id") == 3).count() == 4


def test_knowledge_chart_and_fallback(spark):
    rows = [(i, f"m{i}", ["drama"], 90.0, 2000, float(i), 5.0 + i / 10) for i in range(1, 11)]
    g = explode_genres(_movies(spark, rows))
    chart = knowledge_chart(g, "drama", 60, 120, 1990, 2010, 0.8).collect()
    assert {r.id for r in chart} == {9, 10}
    assert all(r.score is not None for r in chart)
    assert knowledge_chart(g, "comedy", 60, 120, 1990, 2010).count() == 0
    nan_votes = spark.createDataFrame([(1, "a", "drama", 90.0, 2000, None, 5.0)],
                                      "id long, title string, genre string, runtime double, year int, "
                                      "vote_count double, vote_average double")
    fb = knowledge_chart(nan_votes, "drama", 60, 120, 1990, 2010).collect()
    assert len(fb) == 1 and fb[0].score is None   # nothing reaches m -> matches with NULL score


def test_defaults_and_ranges(spark):
    rows = [(1, "a", ["drama"], 100.0, 0, 1.0, 5.0), (2, "b", ["drama", "animation"], 0.0, 2010, 1.0, 5.0),
            (3, "c", ["comedy"], 120.0, 2015, 1.0, 5.0)]
    g = explode_genres(_movies(spark, rows))
    d = chart_defaults(g).first()
    assert d.genre == "animation"
    assert d.low_year == 1985 and d.high_year == 2015
    assert year_range(g).first().asDict() == {"min_year": 1900, "max_year": 2015}
    assert runtime_range(g).first().asDict() == {"min_runtime": 100, "max_runtime": 120}
    d2 = chart_defaults(g.filter(F.col("genre") != "animation")).first()
    assert d2.genre == "drama"       # most frequent
