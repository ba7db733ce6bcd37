"""Catalogue entries: text features (V1-V4), content similarity (R4, R5, R6, R16),
nested-literal functions (X1-X6) on the credits/keywords views."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelkit.functions.clean import sanitize, sanitize_array
from reelkit.functions.nested import director, first_names, names, neighbour_map, with_parsed_literals
from reelkit.operators import text
from reelkit.plans import content
from reelkit.plans.catalog import W, r6, register
from reelkit.sources import proxy

TOKEN_SQL = "'" + text.TOKEN_PATTERN + "'"


def _stop_sql() -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in text.english_stop_words()) + "]"


STOP_SQL = _stop_sql()

# -------------------------------------------------------------------- R4 (plot)

PLOT_SQL = """
WITH docs AS (SELECT doc_id AS id, coalesce(text, '') AS t FROM documents)
, toks AS (SELECT id, unnest(regexp_extract_all(lower(t), """ + TOKEN_SQL + """)) AS term FROM docs)
, tf AS (SELECT id, term, count(*) AS tf FROM toks
         WHERE NOT list_contains(""" + STOP_SQL + """, term) GROUP BY id, term)
, nd AS (SELECT count(*) AS n FROM docs)
, dfreq AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
, w0 AS (SELECT tf.id, tf.term, tf.tf * (ln((nd.n + 1.0) / (dfreq.df + 1.0)) + 1.0) AS w
         FROM tf JOIN dfreq USING (term) CROSS JOIN nd)
, nrm AS (SELECT id, sqrt(sum(w * w)) AS nrm FROM w0 GROUP BY id)
, w AS (SELECT w0.id, w0.term, w0.w / nrm.nrm AS w FROM w0 JOIN nrm USING (id))
"""

PAIRS_SQL = """
, pairs AS (SELECT a.id AS src_id, b.id AS dst_id, sum(a.w * b.w) AS similarity
            FROM w a JOIN w b ON a.term = b.term AND a.id <> b.id GROUP BY 1, 2)
, ranked AS (SELECT *, row_number() OVER (PARTITION BY src_id
                 ORDER BY round(similarity, 9) DESC, dst_id) AS rank FROM pairs)
"""


def _overviews(spark, sf_dir):
    return proxy.overviews(spark, sf_dir)


@register("R4_plot_similarity", PLOT_SQL + PAIRS_SQL + """
SELECT src_id, dst_id, round(similarity, 6) AS similarity, rank FROM ranked WHERE rank <= 100""")
def r4_plot_similarity(spark, sf_dir):
    edges = content.plot_similarity(_overviews(spark, sf_dir), "id", "overview", top=100)
    return edges.select("src_id", "dst_id", r6("similarity").alias("similarity"),
                        F.col("rank").cast("bigint").alias("rank"))


@register("V1_tokenize", """
SELECT doc_id AS id, len(regexp_extract_all(lower(coalesce(text, '')), """ + TOKEN_SQL + """)) AS n_tokens
FROM documents""")
def v1_tokenize(spark, sf_dir):
    d = _overviews(spark, sf_dir)
    return d.select("id", F.size(text.tokenize("overview")).cast("bigint").alias("n_tokens"))


@register("V2_stop_words", """
SELECT doc_id AS id,
       len(list_filter(regexp_extract_all(lower(coalesce(text, '')), """ + TOKEN_SQL + """),
                       lambda x: NOT list_contains(""" + STOP_SQL + """, x))) AS n_tokens
FROM documents""")
def v2_stop_words(spark, sf_dir):
    d = _overviews(spark, sf_dir)
    return d.select("id", F.size(text.remove_stop_words(text.tokenize("overview"))).cast("bigint")
                    .alias("n_tokens"))


@register("V3_tfidf", PLOT_SQL + """
SELECT id, term, round(w, 6) AS w FROM w""")
def v3_tfidf(spark, sf_dir):
    d = _overviews(spark, sf_dir)
    w = text.tfidf(d.select("id", F.coalesce("overview", F.lit("")).alias("t")), "id", "t")
    return w.select("id", "term", r6("w").alias("w"))


# -------------------------------------------------------------------- R5 (metadata)

NAME_RE = "'''name'': ''([^'']*)'''"
DIRECTOR_RE = "'''job'': ''Director'', ''name'': ''([^'']*)'''"

SOUP_BODY = """
, m AS (SELECT CAST(trim(id) AS BIGINT) AS id, title, genres FROM movies_raw
        WHERE regexp_full_match(trim(id), '[+-]?\\d+'))
, j AS (SELECT m.id, m.title, m.genres, c."cast", c.crew, k.keywords
        FROM m JOIN credits c USING (id) JOIN keywords k USING (id))
, parsed AS (
    SELECT id, title,
           list_transform(regexp_extract_all("cast", """ + NAME_RE + """, 1)[1:3],
                          lambda x: lower(replace(x, ' ', ''))) AS cast_l,
           coalesce(lower(replace(nullif(regexp_extract(crew, """ + DIRECTOR_RE + """, 1), ''), ' ', '')), '')
               AS director,
           list_transform(regexp_extract_all(keywords, """ + NAME_RE + """, 1)[1:3],
                          lambda x: lower(replace(x, ' ', ''))) AS kw,
           list_transform(list_transform(regexp_extract_all(coalesce(genres, '[]'), """ + NAME_RE + """, 1),
                                         lambda x: lower(x))[1:3],
                          lambda x: lower(replace(x, ' ', ''))) AS gl
    FROM j)
, soups AS (SELECT id, title,
                   concat_ws(' ', array_to_string(kw, ' '), array_to_string(cast_l, ' '), director,
                             array_to_string(gl, ' ')) AS soup
            FROM parsed)
, toks AS (SELECT id, unnest(regexp_extract_all(lower(soup), """ + TOKEN_SQL + """)) AS term FROM soups)
, tf AS (SELECT id, term, count(*) AS tf FROM toks
         WHERE NOT list_contains(""" + STOP_SQL + """, term) GROUP BY id, term)
, nrm AS (SELECT id, sqrt(sum(tf * tf)) AS nrm FROM tf GROUP BY id)
, w AS (SELECT tf.id, tf.term, tf.tf / nrm.nrm AS w FROM tf JOIN nrm USING (id))
"""
SOUP_VIEWS = ("movies_raw", "credits", "keywords")
SOUP_SQL = W(*SOUP_VIEWS) + SOUP_BODY


def _soups(spark, sf_dir):
    return content.metadata_soup(proxy.movies_raw(spark, sf_dir), proxy.credits(spark, sf_dir),
                                 proxy.keywords(spark, sf_dir))


@register("R5_metadata_similarity", SOUP_SQL + PAIRS_SQL + """
SELECT src_id, dst_id, round(similarity, 6) AS similarity, rank FROM ranked WHERE rank <= 100""")
def r5_metadata_similarity(spark, sf_dir):
    edges = content.metadata_similarity(_soups(spark, sf_dir), top=100)
    return edges.select("src_id", "dst_id", r6("similarity").alias("similarity"),
                        F.col("rank").cast("bigint").alias("rank"))


@register("V4_term_counts", SOUP_SQL + """
SELECT id, term, tf FROM tf""")
def v4_term_counts(spark, sf_dir):
    return text.term_counts(_soups(spark, sf_dir), "id", "soup")


@register("X6_metadata_soup", SOUP_SQL + """
SELECT id, regexp_replace(trim(soup), ' +', ' ', 'g') AS soup FROM soups""")
def x6_soup(spark, sf_dir):
    s = _soups(spark, sf_dir)
    return s.select("id", F.regexp_replace(F.trim("soup"), " +", " ").alias("soup"))


def _titles_sql(n: int) -> str:
    return SOUP_SQL + PAIRS_SQL + """
, firsts AS (SELECT title, min(id) AS id FROM soups WHERE title IS NOT NULL GROUP BY title)
SELECT f.title, r.rank, r.dst_id, s.title AS dst_title, round(r.similarity, 6) AS similarity
FROM firsts f JOIN ranked r ON r.src_id = f.id AND r.rank <= """ + str(n) + """
JOIN soups s ON s.id = r.dst_id"""


def _titles_spark(spark, sf_dir, n):
    soups = _soups(spark, sf_dir)
    edges = content.metadata_similarity(soups, top=n)
    out = content.recommend_for_titles(soups.select("title"), soups.select("id", "title"), edges, n)
    return out.select("title", F.col("rank").cast("bigint").alias("rank"), "dst_id", "dst_title",
                      r6("similarity").alias("similarity"))


@register("R6_recommend_by_title", _titles_sql(10))
def r6_recommend(spark, sf_dir):
    return _titles_spark(spark, sf_dir, 10)


@register("R16_similar_movies_top25", _titles_sql(25))
def r16_similar(spark, sf_dir):
    return _titles_spark(spark, sf_dir, 25)


@register("X12_neighbour_map", SOUP_SQL + PAIRS_SQL + """
SELECT src_id, dst_id, round(similarity, 6) AS similarity FROM ranked WHERE rank <= 10""")
def x12_neighbour_map(spark, sf_dir):
    """A row an item with the map of its ten neighbours, opened again for comparison."""
    maps = neighbour_map(content.metadata_similarity(_soups(spark, sf_dir), top=10))
    return (maps.select("src_id", F.explode("neighbours").alias("dst_id", "similarity"))
                .select("src_id", "dst_id", r6("similarity").alias("similarity")))


# -------------------------------------------------------------------- X1-X5 on the credits

@register("X1_parse_literals", W("credits", "keywords") + """
SELECT c.id, len(regexp_extract_all(c."cast", """ + NAME_RE + """, 1)) AS n_cast,
       len(regexp_extract_all(c.crew, """ + NAME_RE + """, 1)) AS n_crew,
       len(regexp_extract_all(k.keywords, """ + NAME_RE + """, 1)) AS n_keywords
FROM credits c JOIN keywords k USING (id)""")
def x1_parse(spark, sf_dir):
    c = with_parsed_literals(proxy.credits(spark, sf_dir).join(proxy.keywords(spark, sf_dir), "id"),
                             ["cast", "crew", "keywords"])
    return c.select("id", F.size("cast").cast("bigint").alias("n_cast"),
                    F.size("crew").cast("bigint").alias("n_crew"),
                    F.size("keywords").cast("bigint").alias("n_keywords"))


@register("X3_director", W("credits") + """
SELECT id, nullif(regexp_extract(crew, """ + DIRECTOR_RE + """, 1), '') AS director FROM credits""")
def x3_director(spark, sf_dir):
    c = with_parsed_literals(proxy.credits(spark, sf_dir), ["cast", "crew"])
    return c.select("id", director("crew").alias("director"))


@register("X4_first_three_names", W("credits") + """
SELECT id, array_to_string(regexp_extract_all("cast", """ + NAME_RE + """, 1)[1:3], '|') AS top_cast
FROM credits""")
def x4_first_names(spark, sf_dir):
    c = with_parsed_literals(proxy.credits(spark, sf_dir), ["cast", "crew"])
    return c.select("id", F.array_join(first_names("cast", 3), "|").alias("top_cast"))


@register("X5_sanitize", W("credits") + """
SELECT id, array_to_string(list_transform(regexp_extract_all("cast", """ + NAME_RE + """, 1),
                                          lambda x: lower(replace(x, ' ', ''))), '|') AS cast_tokens,
       lower(replace(nullif(regexp_extract(crew, """ + DIRECTOR_RE + """, 1), ''), ' ', '')) AS director
FROM credits""")
def x5_sanitize(spark, sf_dir):
    c = with_parsed_literals(proxy.credits(spark, sf_dir), ["cast", "crew"])
    return c.select("id", F.array_join(sanitize_array(names("cast")), "|")
                    .alias("cast_tokens"),
                    sanitize(director("crew")).alias("director"))


# -------------------------------------------------------------------- X14 (rows-only)

@register("X14_close_matches", None)
def x14_close_matches(spark, sf_dir):
    """Near-miss queries derived from the catalogue: each distinct title minus its
    last character, matched back against all titles."""
    from reelkit.functions.fuzzy import close_matches
    titles = proxy.movies_raw(spark, sf_dir).select("title")
    queries = titles.select(F.expr("substring(title, 1, length(title) - 1)").alias("query"))
    return close_matches(queries, titles, n=5, cutoff=0.6).select(
        "query", "title", r6("ratio").alias("ratio"), F.col("rank").cast("bigint").alias("rank"))


# -------------------------------------------------------------------- V8 (rows-only)

@register("V8_lsh_similar_pairs", None)
def v8_lsh_pairs(spark, sf_dir):
    """All pairs with TF-IDF cosine >= 0.8 over all overviews (opt-in V8 path)."""
    d = _overviews(spark, sf_dir)
    w = text.tfidf(d.select("id", F.coalesce("overview", F.lit("")).alias("t")), "id", "t", placed=True)
    pairs = text.lsh_similar_pairs(w, threshold=0.8)
    return pairs.select("src_id", "dst_id", r6("similarity").alias("similarity"))
