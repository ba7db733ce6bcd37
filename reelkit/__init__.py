"""reelkit: Spark-native recommendation and data-mining operators.

Every public operator is a function from DataFrames (plus plain Python
parameters) to a DataFrame.  Nothing is collected to the driver except
bounded scalars (a handful of model coefficients, a d x d scatter matrix).

Sub-packages
------------
sources     readers / writers with explicit schemas, generators, and the
            domain views (ratings, users, movies, ...) over the driver tables
functions   column expressions: cleaning, nested literals, scores, vectors
operators   relational building blocks: skew-safe ranking, percentile
            filters, text features, pair similarity, predictors, metrics
plans       composite recommenders (charts, content, ratings, hybrid,
            mining) and the query catalogue checked against DuckDB
streaming   micro-batch adapter for the batch operators
"""

from reelkit.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
