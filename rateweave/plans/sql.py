"""SQL spellings over temporary views.

``register_views`` publishes the relations under stable names for a user's
own SQL.  The SQL spellings built here register views under names of their
own, analyse their statement and drop the views again: the DataFrame that
``spark.sql`` returns holds the resolved plan, so it keeps working, and two
calls in one session can neither race nor leave views behind.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from rateweave.sources.tables import Tables

VIEW_PREFIX = "rw_"
RELATIONS = ("ratings", "users", "movies", "occupations")

DEMOGRAPHICS_SQL = """
SELECT u.Gender, u.Age, count(*) AS cnt
FROM {users} u JOIN {ratings} AS r ON u.UserID = r.UserID
WHERE r.MovieID = :movie
GROUP BY u.Gender, u.Age
"""


def register_views(
    spark: SparkSession, t: Tables, scope: str = "local", suffix: str = "", replace: bool = True
) -> dict[str, str]:
    """Register the four relations; returns the name to use for each in SQL.

    ``local`` views live in this session only; ``global`` views live in the
    global temporary database and are visible to every session of the
    application.  By default a registration may run twice; without
    ``replace`` the second one fails with Spark's own error, and the views of
    the first stay as they are: all four names are taken, or none.
    """
    if scope not in ("local", "global"):
        raise ValueError(f"unknown scope {scope!r}")
    names: dict[str, str] = {}
    global_db = spark.conf.get("spark.sql.globalTempDatabase", "global_temp")
    try:
        for relation in RELATIONS:
            frame = getattr(t, relation)
            view = f"{VIEW_PREFIX}{relation}{suffix}"
            if scope == "local":
                (frame.createOrReplaceTempView if replace else frame.createTempView)(view)
                names[relation] = view
            else:
                (frame.createOrReplaceGlobalTempView if replace else frame.createGlobalTempView)(view)
                names[relation] = f"{global_db}.{view}"
    except AnalysisException:
        if not replace:  # the ones this call has registered, never those it found
            drop_views(spark, names, scope)
        raise
    return names


def drop_views(spark: SparkSession, names: dict[str, str], scope: str) -> None:
    for name in names.values():
        if scope == "local":
            spark.catalog.dropTempView(name)
        else:
            spark.catalog.dropGlobalTempView(name.split(".", 1)[1])


def run_sql(spark: SparkSession, t: Tables, text: str, scope: str = "local", args: dict | None = None) -> DataFrame:
    """``text`` (with ``{ratings}``-style placeholders) over fresh views of ``t``."""
    suffix = "_" + uuid.uuid4().hex[:12]
    names = register_views(spark, t, scope, suffix)
    try:
        return spark.sql(text.format(**names), args=args)
    finally:
        drop_views(spark, names, scope)


def demographics_sql(spark: SparkSession, t: Tables, movie, scope: str = "local") -> DataFrame:
    """Head-count by gender and age band of the raters of ``movie``, in SQL.

    The movie id is a bound parameter of the column's own type, so a text
    id column is never cast to a number.
    """
    text_ids = t.ratings.schema["MovieID"].dataType.typeName() == "string"
    value = str(movie) if text_ids else int(movie)
    return run_sql(spark, t, DEMOGRAPHICS_SQL, scope, args={"movie": value})
