from pyspark.sql import functions as F

from reelkit.functions.nested import (director, first_names, names_lower, parse_literal_list, soup,
                                      with_parsed_literals)


def test_literal_cases(spark):
    rows = [
        (1, "[]"),
        (2, None),
        (3, "[{'id': 16, 'name': 'Animation'}]"),
        (4, "[{'name': \"O'Brien\", 'p': None}]"),
        (5, "[{'name': 'a', 'p': True}]"),
        (6, "[{'name': 'caf\\xa0e'}]"),
        (7, "['animation', 'comedy']"),
        (8, "[{'name': 'broken'"),
    ]
    df = spark.createDataFrame(rows, "id int, g string")
    out = {r.id: r.n for r in with_parsed_literals(df, "g").select(
        "id", F.transform("g", lambda x: x["name"]).alias("n")).collect()}
    assert out[1] == []
    assert out[2] is None
    assert out[3] == ["Animation"]
    assert out[4] == ["O'Brien"]
    assert out[5] == ["a"]
    assert out[6] == ["caf\xa0e"]          # decoded by the python fallback
    assert out[8] is None                  # malformed -> NULL (D22)
    assert df.count() == 8


def test_genre_names_lower_and_empty(spark):
    df = spark.createDataFrame([("[{'name': 'Drama'}, {'name': 'Crime'}]",), (None,)], "g string")
    out = [r[0] for r in df.select(names_lower(parse_literal_list("g"))).collect()]
    assert out == [["drama", "crime"], []]


def test_director_rules(spark):
    df = spark.createDataFrame([
        ("[{'job': 'Producer', 'name': 'P'}]",),
        ("[{'job': 'Director', 'name': 'First'}, {'job': 'Director', 'name': 'Second'}]",),
        ("[]",)], "crew string")
    out = [r[0] for r in df.select(director(parse_literal_list("crew"))).collect()]
    assert out == [None, "First", None]


def test_first_names_and_soup(spark):
    df = spark.createDataFrame([("[{'name': 'A B'}, {'name': 'C'}, {'name': 'D'}, {'name': 'E'}]",)], "c string")
    r = df.select(first_names(parse_literal_list("c"), 3).alias("f")).first()
    assert r.f == ["A B", "C", "D"]
    s = spark.createDataFrame([(["k1"], ["c1", "c2"], None, ["g"])],
                              "k array<string>, c array<string>, d string, g array<string>")
    assert s.select(soup("k", "c", "d", "g")).first()[0].split() == ["k1", "c1", "c2", "g"]


def test_text_is_kept_whole(spark):
    from reelkit.functions.nested import count_unreadable, names
    rows = [(1, "[{'name': 'Part 2: None, of us'}]", ["Part 2: None, of us"]), (2, r"[{'name': 'caf\xe9'}]", ["café"]),
            (3, "['animation', 'comedy']", ["animation", "comedy"]), (4, "[{'name': None, 'job': 'x'}]", [None]),
            (5, "[{'id': 1, 'name': \"O'Neil: True, story\", 'adult': False}]", ["O'Neil: True, story"]),
            (6, "not a list", None), (7, None, None), (8, "[]", [])]
    raw = spark.createDataFrame([r[:2] for r in rows], "id int, g string")
    parsed = with_parsed_literals(raw, "g")
    got = {r.id: r.n for r in parsed.select("id", names("g").alias("n")).collect()}
    assert got == {i: n for i, _, n in rows}
    assert count_unreadable(parsed, raw, "g").first()[0] == 1


def test_catalogue_keeps_escaped_genres(spark):
    from reelkit.plans.charts import clean_catalogue
    raw = spark.createDataFrame([("1", "t", r"[{'name': 'Caf\xe9'}]", "1", 1.0, 90.0, 5.0, 10.0, "2000-01-01"),
                                 ("2", "u", "['Drama']", "1", 1.0, 90.0, 5.0, 10.0, "2000-01-01"),
                                 ("3", "v", None, "1", 1.0, 90.0, 5.0, 10.0, None)],
                                "id string, title string, genres string, budget string, revenue double, runtime double, "
                                "vote_average double, vote_count double, release_date string")
    assert {r.id: r.genres for r in clean_catalogue(raw).collect()} == {1: ["café"], 2: ["drama"], 3: []}
