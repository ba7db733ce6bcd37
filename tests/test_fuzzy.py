import difflib

from reelkit.functions.fuzzy import close_matches

TITLES = ["Toy Story (1995)", "Toy Story", "Toy Story", "Toy Stories", "Story Toys", None, "", "Heat",
          "Toy Soldiers", "Jumanji", "Toy Story 2", "Toy Story 3", "Tory Story", "Toy Sorty"]


def test_close_matches_equal_difflib(spark):
    titles = spark.createDataFrame([(t,) for t in TITLES], "title string")
    queries = ["Toy Stroy", "Heet", "zzz"]
    q = spark.createDataFrame([(x,) for x in queries], "query string")
    got = {}
    for r in close_matches(q, titles, n=5, cutoff=0.6).orderBy("query", "rank").collect():
        got.setdefault(r.query, []).append(r.title)
    distinct = sorted({t for t in TITLES if t is not None})
    for x in queries:
        assert got.get(x, []) == difflib.get_close_matches(x, distinct, n=5, cutoff=0.6)
