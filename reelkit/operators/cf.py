"""Rating predictors and their building blocks.

Every predictor has the same shape: ``predict(train, pairs, ...) -> pairs``
with an added ``pred`` column, where ``pairs`` carries at least
``(rating_id, user_id, movie_id)``.  Predictions are joins against small
model tables, never a Python call per pair.

Scale notes
-----------
* The utility matrix stays long: ``cells(user_id, movie_id, r)`` with
  duplicates averaged (A9).  Zero-filling changes neither dot products nor
  norms, so cosine needs only the observed cells.
* R9's sums are taken over pairs of movies or of users, whichever are fewer.
* User-user statistics come from a self-join of the cells on the movie.  A
  movie rated by a third of all users would put a quadratic number of pairs
  into one task, so hot movies are salted on both sides
  (``salted_self_join``): a movie with k raters is cut into b = ceil(k/target)
  slices per side and its b*b slice pairs become separate join keys.  Pair
  statistics are partially aggregated before the shuffle on (u, v).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelkit.operators.relational import (hash_slice, keep_groups_with_at_least, position_in_group,
                                         scalar)
from reelkit.session import cut_lineage

DEFAULT_RATING = 3.0


# --------------------------------------------------------------------------
# preparation
# --------------------------------------------------------------------------

def drop_single_rating_users(ratings: DataFrame) -> DataFrame:
    """keep users with >= 2 ratings; everything if none qualifies."""
    return keep_groups_with_at_least(ratings, "user_id", 2, fallback_all=True)


def split_key(seed: int = 42):
    return F.md5(F.concat_ws("-", F.col("user_id").cast("string"), F.col("movie_id").cast("string"),
                             F.col("rating_id").cast("string"), F.lit(str(seed))))


def stratified_split(ratings: DataFrame, test_size: float = 0.25, seed: int = 42) -> DataFrame:
    """Per user, the first round(test_size * n) rows by a seeded hash go to test.

    Adds ``is_test``.  Positions come from ``position_in_group`` sliced by
    hash prefix, so a user with a huge history is not ranked inside one task
    and the split is a deterministic function of the data.
    """
    counts = ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("_cnt"))
    keyed = ratings.withColumn("_h", split_key(seed)).join(counts, "user_id")
    pos = position_in_group(keyed, "user_id", ["_h", "rating_id"],
                            hash_slice(F.col("_h"), F.col("_cnt")), pos_col="_pos")
    return (pos.withColumn("is_test", F.col("_pos") <= F.floor(F.col("_cnt") * test_size + 0.5))
               .drop("_h", "_pos", "_cnt"))


def random_split(df: DataFrame, key: str, test_size: float = 0.25, seed: int = 42) -> DataFrame:
    """Plain seeded split: a row is test when its hash falls in the first test_size."""
    h = F.conv(F.substring(F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed)))), 1, 8),
               16, 10).cast("double") / float(16 ** 8)
    return df.withColumn("is_test", h < test_size)


def cell_means(ratings: DataFrame) -> DataFrame:
    """User x movie utility matrix in long form, duplicates averaged."""
    return ratings.groupBy("user_id", "movie_id").agg(F.avg("rating").alias("r"))


# --------------------------------------------------------------------------
# user-user statistics (V7, MSD)
# --------------------------------------------------------------------------

def salted_self_join(cells: DataFrame, key: str, member: str, target: int = 2000,
                     left_prefix: str = "a_", right_prefix: str = "b_",
                     upper_only: bool = False, left_if: str | None = None, right_if: str | None = None) -> DataFrame:
    """All (a, b) member pairs sharing ``key``, with hot keys split across tasks.

    b = ceil(count(key) / target) slices per side; cold keys (b = 1) are not
    replicated, so their pairs come from one plain equi-join.  A hot key's
    b x b slice pairs are separate join keys, so no task holds its whole
    k x k block.  With ``upper_only`` each unordered pair {a, b} (a != b) is
    produced once, as a < b (only slice pairs with left <= right are built),
    halving the work for symmetric measures.  ``left_if`` and ``right_if`` are
    conditions on the rows that stand on either side.
    Output columns: key, a_<col>, b_<col> for every other column.
    """
    sizes = cells.groupBy(key).agg(F.count(F.lit(1)).alias("_k"))
    sized = cells.join(sizes, key).withColumn(
        "_b", F.greatest(F.lit(1), F.ceil(F.col("_k") / F.lit(target))).cast("int"))
    slice_of = (F.pmod(F.xxhash64(F.col(member)), F.col("_b"))).cast("int")
    others = [c for c in cells.columns if c != key]
    last = F.col("_b") - 1
    # left rows of slice s meet right slices s..b-1 (upper) or 0..b-1 (all)
    left_partners = F.sequence(slice_of if upper_only else F.lit(0), last)
    right_partners = F.sequence(F.lit(0), slice_of if upper_only else last)
    lefts, rights = (sized.filter(c) if c else sized for c in (left_if, right_if))
    left = lefts.select(key, slice_of.alias("_sa"), F.explode(left_partners).alias("_sb"),
                        *[F.col(c).alias(left_prefix + c) for c in others])
    right = rights.select(key, slice_of.alias("_sb"), F.explode(right_partners).alias("_sa"),
                          *[F.col(c).alias(right_prefix + c) for c in others])
    out = left.join(right, [key, "_sa", "_sb"])
    if upper_only:
        a, b = F.col(left_prefix + member), F.col(right_prefix + member)
        out = out.filter((F.col("_sa") < F.col("_sb")) | (a < b))
        out = out.select(key, F.least(a, b).alias(left_prefix + member), F.greatest(a, b).alias(right_prefix + member),
                         *[F.when(a < b, F.col(left_prefix + c)).otherwise(F.col(right_prefix + c))
                           .alias(left_prefix + c) for c in others if c != member],
                         *[F.when(a < b, F.col(right_prefix + c)).otherwise(F.col(left_prefix + c))
                           .alias(right_prefix + c) for c in others if c != member])
        return out
    return out.drop("_sa", "_sb")


def _co_ratings(cells: DataFrame, target: int = 2000, asking: DataFrame | None = None) -> DataFrame:
    """A row a movie and unordered pair of its raters a < b, with every other column of ``cells`` as a_<col> and b_<col>.

    With ``asking`` (distinct user_id), only pairs in which one user asks are
    built, so that a few users' requests don't meet everyone's pairs; their
    columns may stand the other way round, so only symmetric measures follow.
    """
    if asking is None:
        return salted_self_join(cells, "movie_id", "user_id", target, upper_only=True)
    values = [side + c for side in ("a_", "b_") for c in cells.columns if c not in ("movie_id", "user_id")]
    flagged = cells.join(asking.select("user_id", F.lit(True).alias("asks")), "user_id", "left")
    among = salted_self_join(flagged.filter("asks").drop("asks"), "movie_id", "user_id", target, upper_only=True)
    others = salted_self_join(flagged, "movie_id", "user_id", target, left_if="asks", right_if="asks is null")
    a, b = F.col("a_user_id"), F.col("b_user_id")
    return among.select("a_user_id", "b_user_id", *values).unionByName(
        others.select(F.least(a, b).alias("a_user_id"), F.greatest(a, b).alias("b_user_id"), *values))


def _both_ways(once: DataFrame) -> DataFrame:
    """Pairs (a, b) as (u, v) and (v, u), with their other columns."""
    rest = [c for c in once.columns if c not in ("a", "b")]
    ways = F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))
    return once.select(F.explode(ways).alias("w"), *rest).select("w.u", "w.v", *rest)


def user_pair_stats(cells: DataFrame, target: int = 2000, asking: DataFrame | None = None) -> DataFrame:
    """(u, v) -> n_common, dot = sum r_u*r_v, sqd = sum (r_u-r_v)^2 over co-rated movies.

    Includes u = v.  Pairs without a common movie are absent (their dot is 0).
    ``asking``: see ``_co_ratings``.
    """
    pairs = _co_ratings(cells.select("movie_id", "user_id", "r"), target, asking)
    once = (pairs.groupBy(F.col("a_user_id").alias("a"), F.col("b_user_id").alias("b"))
                 .agg(F.count(F.lit(1)).alias("n_common"),
                      F.sum(F.col("a_r") * F.col("b_r")).alias("dot"),
                      F.sum((F.col("a_r") - F.col("b_r")) ** 2).alias("sqd")))
    # symmetric: aggregated once, then emitted in both directions
    own = (cells.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_common"), F.sum(F.col("r") * F.col("r")).alias("dot"))
                .select(F.col("user_id").alias("u"), F.col("user_id").alias("v"), "n_common", "dot", F.lit(0.0).alias("sqd")))
    return _both_ways(once).unionByName(own)


def user_norms(cells: DataFrame) -> DataFrame:
    return cells.groupBy("user_id").agg(F.sqrt(F.sum(F.col("r") * F.col("r"))).alias("norm"))


def unit_cells(cells: DataFrame) -> DataFrame:
    """The cells with ``w`` = r / the user's norm (null for norm zero), stored: every table of pairs reads them several times.

    With them a cosine is a sum of products, so that no table of pairs has to
    meet the norms.
    """
    cells = cut_lineage(cells)
    return cut_lineage(cells.join(user_norms(cells), "user_id")
                            .select("user_id", "movie_id", "r", F.try_divide("r", "norm").alias("w")))


def _cosines(units: DataFrame, target: int = 2000) -> DataFrame:
    """(a, b, sim) of unordered pairs of users with a common movie."""
    pairs = _co_ratings(units.select("movie_id", "user_id", "w"), target)
    return (pairs.groupBy(F.col("a_user_id").alias("a"), F.col("b_user_id").alias("b"))
                 .agg(F.sum(F.col("a_w") * F.col("b_w")).alias("sim")))


def user_cosine(cells: DataFrame) -> DataFrame:
    """V7: cosine between users on the zero-filled matrix, positive pairs only; also u = v.

    What is shuffled is a sum a pair, each pair once.
    """
    units = unit_cells(cells)
    own = units.groupBy("user_id").agg(F.sum(F.col("w") * F.col("w")).alias("sim"))
    return _both_ways(_cosines(units)).unionByName(own.select(F.col("user_id").alias("u"), F.col("user_id").alias("v"), "sim"))


def co_rated(cells: DataFrame, pairs: DataFrame, target: int = 2000, few_users: bool = False) -> DataFrame:
    """(user_id, movie_id, v, r_v, n_common, sqd, sim): for every distinct user and movie of ``pairs`` the raters v of the
    movie that have a rated movie in common with the user, v = the user included.

    ``sqd`` is as in ``user_pair_stats``, ``sim`` the cosine.  Pairs of users are
    aggregated once, a < b; a user and a movie's rater look their pair up in that
    order, on the key that the aggregate is dealt by, so that the table of pairs
    is neither mirrored nor stored nor shuffled again.  ``few_users``: see ``predict_knn``.
    """
    units = unit_cells(cells)
    asked = pairs.select("user_id", "movie_id").distinct()
    met = _co_ratings(units, target, asked.select("user_id").distinct() if few_users else None)
    once = (met.groupBy(F.col("a_user_id").alias("a"), F.col("b_user_id").alias("b"))
               .agg(F.count(F.lit(1)).alias("n_common"), F.sum((F.col("a_r") - F.col("b_r")) ** 2).alias("sqd"),
                    F.sum(F.col("a_w") * F.col("b_w")).alias("sim")))
    raters = units.select("movie_id", F.col("user_id").alias("v"), F.col("r").alias("r_v"))
    cand = (sliced_join(asked, raters, "movie_id", "v", target).filter("user_id <> v")
            .withColumns({"a": F.least("user_id", "v"), "b": F.greatest("user_id", "v")}))
    own = units.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_common"), F.lit(0.0).alias("sqd"),
                                       F.sum(F.col("w") * F.col("w")).alias("sim"))
    themselves = (asked.join(units, ["user_id", "movie_id"]).join(own, "user_id")
                       .select("user_id", "movie_id", F.col("user_id").alias("v"), F.col("r").alias("r_v"), "n_common", "sqd", "sim"))
    return cand.join(once, ["a", "b"]).drop("a", "b").unionByName(themselves)


def _weighted_sums(met: DataFrame, pairs: DataFrame) -> DataFrame:
    """(rating_id, _num, _den): sums of sim * r_v and of sim, over what ``co_rated`` met."""
    of = met.groupBy("user_id", "movie_id").agg(F.sum(F.col("sim") * F.col("r_v")).alias("num"), F.sum("sim").alias("den"))
    return (pairs.select("rating_id", "user_id", "movie_id").join(of, ["user_id", "movie_id"])
                 .groupBy("rating_id").agg(F.sum("num").alias("_num"), F.sum("den").alias("_den")))


# --------------------------------------------------------------------------
# predictors (R7-R12); pairs must carry rating_id, user_id, movie_id
# --------------------------------------------------------------------------

def predict_constant(train: DataFrame, pairs: DataFrame, value: float = DEFAULT_RATING) -> DataFrame:
    """Constant prediction."""
    return pairs.withColumn("pred", F.lit(float(value)))


def movie_means(cells: DataFrame) -> DataFrame:
    """Mean rating per movie over user-averaged cells."""
    return cells.groupBy("movie_id").agg(F.avg("r").alias("movie_mean"))


def predict_movie_mean(train: DataFrame, pairs: DataFrame) -> DataFrame:
    """The movie's mean rating; unseen movie -> 3.0."""
    mm = movie_means(cell_means(train))
    return (pairs.join(mm, "movie_id", "left")
                 .withColumn("pred", F.coalesce(F.col("movie_mean"), F.lit(DEFAULT_RATING)))
                 .drop("movie_mean"))


def sliced_join(pairs: DataFrame, members: DataFrame, key: str, member: str, target: int = 2000) -> DataFrame:
    """Equi-join on ``key``, with the members of a hot key in slices of about ``target``.

    A pair meets every slice of its key, each under a join key of its own, so
    that no task holds all of a hot key's pairs and members at once; keys with
    one slice are joined plainly.
    """
    slices = (members.groupBy(key).agg(F.count(F.lit(1)).alias("_k"))
                     .select(key, F.greatest(F.lit(1), F.ceil(F.col("_k") / F.lit(target))).cast("int").alias("_b")))
    left = pairs.join(slices, key).withColumn("_s", F.explode(F.sequence(F.lit(0), F.col("_b") - 1))).drop("_b")
    right = members.join(slices, key).withColumn("_s", F.pmod(F.xxhash64(member), F.col("_b")).cast("int")).drop("_b")
    return left.join(right, [key, "_s"]).drop("_s")


def _raters(cells: DataFrame, pairs: DataFrame, target: int = 2000) -> DataFrame:
    """(pair, rater v, r_vm) for every rater of the pair's movie in training."""
    raters = cells.select("movie_id", F.col("user_id").alias("v"), F.col("r").alias("r_v"))
    return sliced_join(pairs.select("rating_id", "user_id", "movie_id"), raters, "movie_id", "v", target)


def item_pair_products(cells: DataFrame, target: int = 2000) -> DataFrame:
    """(movie_id, i) -> num = sum r_vi * r_vm / |v|, den = sum r_vi / |v| over the raters v of both movies.

    Both ways round, and movie_id = i.  Each user's pairs of movies are made
    once, a hot user's in slices, and aggregated before the shuffle.  Raters of
    norm zero say nothing.
    """
    scaled = cells.join(user_norms(cells), "user_id").select(
        "user_id", "movie_id", "r", F.try_divide("r", "norm").alias("w")).filter("w is not null")
    pairs = salted_self_join(scaled, "user_id", "movie_id", target, upper_only=True)
    once = (pairs.groupBy(F.col("a_movie_id").alias("a"), F.col("b_movie_id").alias("b"))
                 .agg(F.sum(F.col("a_w") * F.col("b_r")).alias("num"), F.sum("a_w").alias("den_b"), F.sum("b_w").alias("den_a")))
    ways = F.array(F.struct(F.col("a").alias("movie_id"), F.col("b").alias("i"), F.col("den_a").alias("den")),
                   F.struct(F.col("b").alias("movie_id"), F.col("a").alias("i"), F.col("den_b").alias("den")))
    both = once.select(F.explode(ways).alias("p"), "num").select("p.movie_id", "p.i", "num", "p.den")
    own = scaled.groupBy("movie_id").agg(F.sum(F.col("w") * F.col("r")).alias("num"), F.sum("w").alias("den"))
    return both.unionByName(own.select("movie_id", F.col("movie_id").alias("i"), "num", "den"))


def _wmean_sums_by_movies(cells: DataFrame, pairs: DataFrame, target: int) -> DataFrame:
    """(rating_id, _num, _den) from pairs of movies: see ``predict_user_wmean``."""
    own = cells.select("user_id", F.col("movie_id").alias("i"), "r")
    cand = (sliced_join(pairs.select("rating_id", "user_id", "movie_id"), own, "user_id", "i", target)
            .join(item_pair_products(cells, target), ["movie_id", "i"]))
    return cand.groupBy("rating_id").agg(F.sum(F.col("r") * F.col("num")).alias("_num"), F.sum(F.col("r") * F.col("den")).alias("_den"))


def predict_user_wmean(train: DataFrame, pairs: DataFrame, met: DataFrame | None = None, target: int = 2000,
                       by: str | None = None, few_users: bool = False) -> DataFrame:
    """Cosine-weighted mean of everyone's rating of the movie; 0 weight or unseen -> 3.0.

    With sim(u, v) = sum_i r_ui r_vi / (|u| |v|), the sums over the raters v of
    a movie m turn into sums over u's own movies i:

        sum_v sim(u, v) r_vm = 1/|u| * sum_i r_ui * (sum_v r_vi r_vm / |v|)

    and the same without r_vm for the weights; |u| cancels.  What stands in the
    brackets belongs to a pair of movies (``item_pair_products``), so that no
    pair of users is built.  Pairs of movies grow with the square of a user's
    movies, pairs of users with that of a movie's raters: the side with fewer
    is taken (``by`` = "movies" or "users" names it; ``met``, as ``co_rated``
    returns it, implies users).
    ``few_users``: see ``predict_knn``.
    """
    if met is None:
        cells = cut_lineage(cell_means(train))
        if by is None:
            of_users, of_movies = (cells.groupBy(k).count().agg(F.sum(F.col("count").cast("double") ** 2)).first()[0] or 0
                                   for k in ("movie_id", "user_id"))
            by = "movies" if of_movies < of_users else "users"
        if by == "users":
            met = co_rated(cells, pairs, target, few_users)
    if met is None:
        rated = pairs.withColumn("_zero", F.lit(None).cast("double"))
        agg = _wmean_sums_by_movies(cells, pairs, target)
    else:
        # raters who have nothing in common with the user weigh zero: their ratings make a sum of zero where the others' are null
        known = train.filter("rating is not null").select("movie_id", F.lit(0.0).alias("_zero")).distinct()
        rated, agg = pairs.join(known, "movie_id", "left"), _weighted_sums(met, pairs)
    pred = F.when(F.col("_den") != 0, F.coalesce("_num", "_zero") / F.col("_den"))
    return (rated.join(agg, "rating_id", "left")
                 .withColumn("pred", F.coalesce(pred, F.lit(DEFAULT_RATING)))
                 .drop("_num", "_den", "_zero"))


def _with_profile(train: DataFrame, users: DataFrame) -> DataFrame:
    return train.join(users.select("user_id", "sex", "occupation"), "user_id")


def predict_gender(train: DataFrame, pairs: DataFrame, users: DataFrame) -> DataFrame:
    """Mean rating of the movie by users of the same sex; else 3.0."""
    gm = _with_profile(train, users).groupBy("movie_id", "sex").agg(F.avg("rating").alias("g_mean"))
    prof = users.select("user_id", "sex")
    return (pairs.join(prof, "user_id", "left").join(gm, ["movie_id", "sex"], "left")
                 .withColumn("pred", F.coalesce(F.col("g_mean"), F.lit(DEFAULT_RATING)))
                 .drop("g_mean", "sex"))


def predict_gender_occupation(train: DataFrame, pairs: DataFrame, users: DataFrame) -> DataFrame:
    """Mean by (sex, occupation) for the movie, else R10, else 3.0."""
    prof_train = _with_profile(train, users)
    gom = prof_train.groupBy("movie_id", "sex", "occupation").agg(F.avg("rating").alias("go_mean"))
    gm = prof_train.groupBy("movie_id", "sex").agg(F.avg("rating").alias("g_mean"))
    prof = users.select("user_id", "sex", "occupation")
    return (pairs.join(prof, "user_id", "left")
                 .join(gom, ["movie_id", "sex", "occupation"], "left")
                 .join(gm, ["movie_id", "sex"], "left")
                 .withColumn("pred", F.coalesce("go_mean", "g_mean", F.lit(DEFAULT_RATING)))
                 .drop("go_mean", "g_mean", "sex", "occupation"))


def predict_knn(train: DataFrame, pairs: DataFrame, k: int = 40, min_k: int = 1,
                scale=(1.0, 5.0), stats: DataFrame | None = None, few_users: bool = False,
                met: DataFrame | None = None) -> DataFrame:
    """User-based kNN with MSD similarity 1/(msd+1).

    For each pair: the k most similar raters of the movie (ties by user id)
    with positive similarity; weighted mean of their ratings; fewer than
    min_k neighbours (or unknown user/movie) -> global mean of training
    ratings; clipped to the rating scale.  ``few_users``: the pairs are those of
    a few users, as when requests are served, not of nearly everyone, as in a
    test set; only co-ratings with them are built then.  ``met``: what ``co_rated``
    returns for these pairs, where several models share it; ``stats``: what
    ``user_pair_stats`` returns, instead.
    """
    if stats is not None:
        near = stats.select(F.col("u").alias("user_id"), "v", "sqd", "n_common")
        cand = _raters(cell_means(train), pairs).join(near, ["user_id", "v"])
    else:
        met = co_rated(cell_means(train), pairs, few_users=few_users) if met is None else met
        cand = pairs.select("rating_id", "user_id", "movie_id").join(met.drop("sim"), ["user_id", "movie_id"])
    cand = cand.withColumn("sim", 1.0 / (F.col("sqd") / F.col("n_common") + 1.0)).filter(F.col("sim") > 0)
    w = Window.partitionBy("rating_id").orderBy(F.desc("sim"), F.asc("v"))
    top = cand.withColumn("_rk", F.row_number().over(w)).filter(F.col("_rk") <= k)
    agg = top.groupBy("rating_id").agg(F.sum(F.col("sim") * F.col("r_v")).alias("_num"),
                                       F.sum("sim").alias("_den"), F.count(F.lit(1)).alias("_k"))
    mu = scalar(train, F.avg("rating"))
    lo, hi = scale
    est = F.when(F.col("_k") >= min_k, F.col("_num") / F.col("_den")).otherwise(mu)
    return (pairs.join(agg, "rating_id", "left")
                 .withColumn("pred", F.least(F.lit(hi), F.greatest(F.lit(lo), F.coalesce(est, mu))))
                 .drop("_num", "_den", "_k"))


def cell_fold(folds: int, seed: int = 42):
    """A user-item cell's fold, by a seeded hash, so that repeated ratings of an item by a user stay together."""
    key = F.concat_ws("-", F.col("user_id").cast("string"), F.col("movie_id").cast("string"), F.lit(str(seed)))
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") % folds).cast("int")


def fold_co_rated(cells: DataFrame, folds: int, target: int = 2000) -> DataFrame:
    """``co_rated`` (without sim) of every cell (user_id, movie_id, r, fold) as a test cell of its fold, with that fold.

    A pair's co-ratings hold both what the models trained without a fold need of
    the pair and its test cells: a movie that u rated in fold f and v in another
    is one of u's test cells with v among the raters.  So the co-ratings meet by
    pair once, and nothing else does.
    """
    long = cells.filter("user_id is not null").select("movie_id", "user_id", "r", "fold")
    pairs = salted_self_join(long, "movie_id", "user_id", target, upper_only=True)
    pair = Window.partitionBy("a_user_id", "b_user_id")
    square = (F.col("a_r") - F.col("b_r")) ** 2
    within = {}
    for f in range(folds):
        outside = (F.col("a_fold") != f) & (F.col("b_fold") != f)
        within |= {f"n{f}": F.count(F.when(outside, 1)).over(pair), f"s{f}": F.sum(F.when(outside, square)).over(pair)}
    counted = pairs.filter("a_user_id <> b_user_id").withColumns(within)
    n, s = (F.array(*[F.col(f"{x}{f}") for f in range(folds)]) for x in "ns")

    def tested(u: str, v: str):
        f = F.col(f"{u}_fold")
        return F.struct(F.col(f"{u}_user_id").alias("user_id"), "movie_id", f.alias("fold"), F.col(f"{v}_user_id").alias("v"),
                        F.col(f"{v}_r").alias("r_v"), F.get(n, f).alias("n_common"), F.get(s, f).alias("sqd"))

    ways = counted.filter("a_fold <> b_fold").select(F.explode(F.array(tested("a", "b"), tested("b", "a"))).alias("w"))
    return ways.select("w.*").filter("n_common > 0")


def cross_validate_knn(ratings: DataFrame, folds: int = 3, seed: int = 42, k: int = 40) -> DataFrame:
    """E5 for the neighbourhood model: (fold, rmse, n) of each fold, from one co-rating join (``fold_co_rated``).

    A test cell's own user is no rater of its movie in training, as cells are
    in one fold.  Folds without ratings give no row.
    """
    from reelkit.operators.evaluate import rmse
    keyed = cut_lineage(ratings.withColumn("fold", cell_fold(folds, seed)))
    cells = keyed.groupBy("user_id", "movie_id", "fold").agg(F.avg("rating").alias("r"))
    met = cut_lineage(fold_co_rated(cut_lineage(cells), folds))
    parts = []
    for f in range(folds):
        pred = predict_knn(keyed.filter(F.col("fold") != f), keyed.filter(F.col("fold") == f).drop("fold"), k=k,
                           met=met.filter(F.col("fold") == f).drop("fold"))
        parts.append(rmse(pred).filter("n > 0").select(F.lit(f).alias("fold"), "rmse", "n"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def predict_item_knn(train: DataFrame, pairs: DataFrame, target: int = 2000) -> DataFrame:
    """R21 (claimed, no code in the reference): item-based CF.

    Cosine between movies over their raters (V7 with roles swapped), then the
    similarity-weighted mean of the user's own ratings; 0 weight -> 3.0.
    """
    swapped = {"user_id": F.col("movie_id"), "movie_id": F.col("user_id")}
    met = co_rated(cell_means(train).withColumns(swapped), pairs.select("user_id", "movie_id").withColumns(swapped), target)
    agg = _weighted_sums(met.withColumns(swapped), pairs)
    pred = F.when(F.col("_den") != 0, F.col("_num") / F.col("_den"))
    return (pairs.join(agg, "rating_id", "left")
                 .withColumn("pred", F.coalesce(pred, F.lit(DEFAULT_RATING)))
                 .drop("_num", "_den"))
