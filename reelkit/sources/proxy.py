"""Domain views over the driver's TPC-H-like tables.

The driver ships no movie, rating or credit files, so the recommenders run on
views derived from its tables (SURVEY §7.2).  Each view exists twice: as a
Spark DataFrame builder (the thing the operators consume) and as a DuckDB SQL
CTE used only by the oracle queries in ``plans.catalog``.  Both are written
independently from the same definition:

ratings(rating_id, user_id, movie_id, rating)
    orders join lineitem; user = o_custkey, movie = l_partkey,
    rating = 1 + (floor(l_quantity) - 1) % 5, rating_id = text key of the lineitem row
    (order, line, part, supplier, quantity, cents); (order, line) alone repeats
users(user_id, age, sex, occupation)
    customer; sex by parity of the nation key, occupation = market segment
movies_raw(id, title, overview_id, genres, release_date, budget, revenue,
           runtime, vote_average, vote_count)
    part + sales aggregate, with the *text* columns a metadata CSV would have
    (python-literal genre list, dirty budget strings, date as text)
credits(id, cast, crew) / keywords(id, keywords)
    python-literal strings built from the suppliers and names of each part
overviews(id, title, overview)
    documents(doc_id, text) with a title of their own
vectors(id, features, label)
    embeddings
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------
# Spark builders
# --------------------------------------------------------------------------

def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rating_id = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                            F.floor("l_quantity").cast("bigint"),
                            F.round(F.col("l_extendedprice") * 100).cast("bigint"))
    return (li.join(od, li.l_orderkey == od.o_orderkey)
              .select(rating_id.alias("rating_id"),
                      F.col("o_custkey").alias("user_id"),
                      F.col("l_partkey").alias("movie_id"),
                      (F.lit(1) + (F.floor("l_quantity").cast("int") - 1) % 5).cast("int")
                      .alias("rating")))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        (F.lit(18) + F.col("c_custkey") % 53).cast("int").alias("age"),
        F.when(F.col("c_nationkey") % 2 == 0, "M").otherwise("F").alias("sex"),
        F.col("c_mktsegment").alias("occupation"))


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    rating = F.lit(1) + (F.floor("l_quantity").cast("int") - 1) % 5
    return (li.join(od, li.l_orderkey == od.o_orderkey)
              .groupBy("l_partkey")
              .agg(F.count(F.lit(1)).alias("n_sales"),
                   F.sum("l_extendedprice").alias("revenue"),
                   F.avg(rating).alias("vote_average"),
                   F.min("o_orderdate").alias("first_date")))


def movies_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata as a CSV would deliver it: ids and numbers as dirty text."""
    p = table(spark, sf_dir, "part")
    s = _sales(spark, sf_dir)
    k = F.col("p_partkey")
    genre_lit = F.when(
        F.col("p_size") % 10 == 0, F.lit("[]")
    ).otherwise(F.concat(
        F.lit("[{'id': "), F.col("p_size").cast("string"), F.lit(", 'name': '"),
        F.initcap(F.col("p_type")), F.lit("'}, {'id': "),
        F.regexp_extract("p_brand", r"(\d+)", 1), F.lit(", 'name': '"),
        F.replace(F.col("p_brand"), F.lit("#"), F.lit(" ")), F.lit("'}]")))
    budget = (F.when(k % 13 == 0, F.lit(""))
               .when(k % 17 == 0, F.lit("/poster.jpg"))
               .when(k % 19 == 0, F.lit(" 1e3 "))
               .otherwise(F.format_string("%.2f", F.col("p_retailprice"))))
    ident = F.when(k % 29 == 0, F.concat(F.lit("tt"), k.cast("string"))).otherwise(k.cast("string"))
    return (p.join(s, p.p_partkey == s.l_partkey, "left")
             .select(ident.alias("id"),
                     F.col("p_name").alias("title"),
                     genre_lit.alias("genres"),
                     F.date_format("first_date", "yyyy-MM-dd").alias("release_date"),
                     budget.alias("budget"),
                     F.col("revenue"),
                     F.col("p_size").cast("double").alias("runtime"),
                     F.col("vote_average"),
                     F.coalesce(F.col("n_sales"), F.lit(0)).cast("double").alias("vote_count")))


def credits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, cast, crew as python-literal text; cast = the suppliers by key."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    su = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    na = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    sp = (li.distinct()
            .withColumn("rk", F.row_number().over(
                Window.partitionBy("l_partkey").orderBy("l_suppkey")))
            # supplier grows with the scale factor: Catalyst decides by size;
            # nation is a fixed 25-row dimension
            .join(su, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(F.broadcast(na), F.col("s_nationkey") == F.col("n_nationkey")))
    member = F.concat(F.lit("{'cast_id': "), F.col("rk").cast("string"),
                      F.lit(", 'name': '"), F.initcap("n_name"), F.lit(" "),
                      F.col("s_suppkey").cast("string"), F.lit("'}"))
    first_nation = F.min_by(F.initcap("n_name"), F.col("rk"))
    cast_df = (sp.groupBy("l_partkey")
                 .agg(F.array_join(F.transform(
                          F.array_sort(F.collect_list(F.struct("rk", member.alias("m")))),
                          lambda x: x["m"]), ", ").alias("members"),
                      first_nation.alias("first_nation")))
    director = F.concat(F.lit("{'job': 'Director', 'name': '"), F.col("first_nation"), F.lit("'}"))
    producer = F.concat(F.lit("{'job': 'Producer', 'name': 'Studio "), (F.col("p_partkey") % 7).cast("string"), F.lit("'}"))
    second_dir = F.lit("{'job': 'Director', 'name': 'Second Unit'}")
    crew = (F.when(F.col("first_nation").isNull(), F.lit("[]"))
             .when(F.col("p_size") % 5 == 0, F.concat(F.lit("["), producer, F.lit("]")))
             .when(F.col("p_size") % 7 == 0, F.concat(F.lit("["), producer, F.lit(", "), director,
                                                      F.lit(", "), second_dir, F.lit("]")))
             .otherwise(F.concat(F.lit("["), producer, F.lit(", "), director, F.lit("]"))))
    return (p.join(cast_df, p.p_partkey == cast_df.l_partkey, "left")
             .select(F.col("p_partkey").alias("id"),
                     F.concat(F.lit("["), F.coalesce(F.col("members"), F.lit("")), F.lit("]")).alias("cast"),
                     crew.alias("crew")))


def keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    words = F.split(F.col("p_name"), " ")
    lit = F.concat(F.lit("[{'id': 1, 'name': '"), F.element_at(words, 1),
                   F.lit("'}, {'id': 2, 'name': '"), F.element_at(words, -1),
                   F.lit("'}, {'id': 3, 'name': '"), F.lower("p_type"), F.lit(" style'}]"))
    return p.select(F.col("p_partkey").alias("id"), lit.alias("keywords"))


def overviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select(F.col("doc_id").alias("id"),
                    F.concat(F.lit("Doc "), F.col("doc_id").cast("string")).alias("title"),
                    F.col("text").alias("overview"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("id"),
                    F.col("embedding").cast("array<double>").alias("features"),
                    F.col("label").cast("int").alias("label"))


# --------------------------------------------------------------------------
# DuckDB CTEs for the oracle (independent text; same definitions)
# --------------------------------------------------------------------------

SQL_VIEWS = {
    "ratings": """
        SELECT concat_ws('-', l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey,
                         CAST(floor(l.l_quantity) AS BIGINT),
                         CAST(round(l.l_extendedprice * 100) AS BIGINT)) AS rating_id,
               o.o_custkey AS user_id, l.l_partkey AS movie_id,
               CAST(1 + (CAST(floor(l.l_quantity) AS INTEGER) - 1) % 5 AS INTEGER) AS rating
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "users": """
        SELECT c_custkey AS user_id, CAST(18 + c_custkey % 53 AS INTEGER) AS age,
               CASE WHEN c_nationkey % 2 = 0 THEN 'M' ELSE 'F' END AS sex,
               c_mktsegment AS occupation
        FROM customer""",
    "sales": """
        SELECT l.l_partkey, count(*) AS n_sales, sum(l.l_extendedprice) AS revenue,
               avg(1 + (CAST(floor(l.l_quantity) AS INTEGER) - 1) % 5) AS vote_average,
               min(o.o_orderdate) AS first_date
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        GROUP BY l.l_partkey""",
    "movies_raw": """
        SELECT CASE WHEN p.p_partkey % 29 = 0 THEN 'tt' || CAST(p.p_partkey AS VARCHAR)
                    ELSE CAST(p.p_partkey AS VARCHAR) END AS id,
               p.p_name AS title,
               CASE WHEN p.p_size % 10 = 0 THEN '[]'
                    ELSE '[{''id'': ' || CAST(p.p_size AS VARCHAR) || ', ''name'': '''
                         || upper(p.p_type[1]) || lower(p.p_type[2:]) || '''}, {''id'': '
                         || regexp_extract(p.p_brand, '(\\d+)', 1) || ', ''name'': '''
                         || replace(p.p_brand, '#', ' ') || '''}]' END AS genres,
               strftime(s.first_date, '%Y-%m-%d') AS release_date,
               CASE WHEN p.p_partkey % 13 = 0 THEN ''
                    WHEN p.p_partkey % 17 = 0 THEN '/poster.jpg'
                    WHEN p.p_partkey % 19 = 0 THEN ' 1e3 '
                    ELSE printf('%.2f', p.p_retailprice) END AS budget,
               s.revenue,
               CAST(p.p_size AS DOUBLE) AS runtime,
               s.vote_average,
               CAST(coalesce(s.n_sales, 0) AS DOUBLE) AS vote_count
        FROM part p LEFT JOIN sales s ON p.p_partkey = s.l_partkey""",
    # Clean catalogue: the parse rules of P4/P5/P10/P12/X1/X2 written in DuckDB.
    "movies": """
        SELECT CAST(id AS BIGINT) AS id, title,
               list_transform(regexp_extract_all(genres, '''name'': ''([^'']*)''', 1),
                              lambda x: lower(x)) AS genres,
               CASE WHEN regexp_full_match(trim(budget), '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?')
                    THEN CAST(trim(budget) AS DOUBLE) END AS budget,
               revenue, runtime, vote_average, vote_count,
               coalesce(year(try_strptime(release_date, '%Y-%m-%d')), 0) AS year
        FROM movies_raw
        WHERE regexp_full_match(trim(id), '[+-]?\\d+')""",
    "cast_members": """
        SELECT l_partkey,
               string_agg('{''cast_id'': ' || CAST(rk AS VARCHAR) || ', ''name'': '''
                          || upper(n_name[1]) || lower(n_name[2:]) || ' ' || CAST(s_suppkey AS VARCHAR)
                          || '''}', ', ' ORDER BY rk) AS members,
               arg_min(upper(n_name[1]) || lower(n_name[2:]), rk) AS first_nation
        FROM (SELECT d.l_partkey, d.l_suppkey,
                     row_number() OVER (PARTITION BY d.l_partkey ORDER BY d.l_suppkey) AS rk
              FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) d) sp
        JOIN supplier s ON s.s_suppkey = sp.l_suppkey
        JOIN nation n ON n.n_nationkey = s.s_nationkey
        GROUP BY l_partkey""",
    "credits": """
        SELECT p.p_partkey AS id, '[' || coalesce(c.members, '') || ']' AS "cast",
               CASE WHEN c.first_nation IS NULL THEN '[]'
                    WHEN p.p_size % 5 = 0 THEN '[' || pr.producer || ']'
                    WHEN p.p_size % 7 = 0 THEN '[' || pr.producer || ', {''job'': ''Director'', ''name'': '''
                         || c.first_nation || '''}, {''job'': ''Director'', ''name'': ''Second Unit''}]'
                    ELSE '[' || pr.producer || ', {''job'': ''Director'', ''name'': '''
                         || c.first_nation || '''}]' END AS crew
        FROM part p
        LEFT JOIN cast_members c ON c.l_partkey = p.p_partkey
        CROSS JOIN LATERAL (SELECT '{''job'': ''Producer'', ''name'': ''Studio '
                                   || CAST(p.p_partkey % 7 AS VARCHAR) || '''}' AS producer) pr""",
    "keywords": """
        SELECT p_partkey AS id,
               '[{''id'': 1, ''name'': ''' || string_split(p_name, ' ')[1]
               || '''}, {''id'': 2, ''name'': ''' || string_split(p_name, ' ')[-1]
               || '''}, {''id'': 3, ''name'': ''' || lower(p_type) || ' style''}]' AS keywords
        FROM part""",
    "overviews": """
        SELECT doc_id AS id, 'Doc ' || CAST(doc_id AS VARCHAR) AS title, text AS overview
        FROM documents""",
}

# Which views each view needs (for assembling WITH clauses in order).
_SQL_DEPS = {"movies_raw": ["sales"], "movies": ["movies_raw"], "credits": ["cast_members"]}


def sql_with(*views: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the named views and their dependencies."""
    order: list[str] = []

    def visit(v: str) -> None:
        for d in _SQL_DEPS.get(v, []):
            visit(d)
        if v not in order:
            order.append(v)

    for v in views:
        visit(v)
    return "WITH " + ",\n".join(f"{v} AS ({SQL_VIEWS[v]})" for v in order) + "\n"
