"""Storage that answers the rating-user join without moving the ratings.

``store_colocated`` writes ratings and users bucketed alike by UserID, so that
joining them shuffles neither side however large both are.  A rater with more
ratings than a bucket's fair share would make one bucket, and so one task, as
large as the data: the ratings of such raters (there are fewer of them than
buckets) and those without a rater are kept apart, unbucketed, beside the
profiles of these few raters, which Spark then broadcasts by their size.

``store_denormalised`` goes further and writes every rating with its rater's
profile, partitioned by age band and clustered by movie, so that the analyses
by profile need no join at all.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateweave.operators.aggregates import count_by
from rateweave.operators.joins import join_dimension
from rateweave.sources.tables import Tables

KEY = "UserID"
_BUCKETED = ("ratings", "users")
_APART = ("ratings_apart", "users_apart")


@dataclass(frozen=True)
class Colocated:
    """``ratings`` and ``users`` are bucketed by UserID; ``ratings_apart`` holds
    the ratings of hot raters and of none, ``users_apart`` the hot raters."""

    ratings: DataFrame
    users: DataFrame
    ratings_apart: DataFrame
    users_apart: DataFrame
    buckets: int


def hot_raters(ratings: DataFrame, buckets: int) -> DataFrame:
    """``UserID`` of every rater with more than a ``buckets``-th of all ratings: fewer than ``buckets`` of them."""
    total = ratings.count()
    counts = count_by(ratings.where(F.col(KEY).isNotNull()), KEY)
    return counts.where(F.col("cnt") * F.lit(buckets) > F.lit(total)).select(KEY)


def store_colocated(spark: SparkSession, t: Tables, path: str, buckets: int | None = None) -> Colocated:
    """Write ratings and users to the new folder ``path`` and open them.

    ``buckets`` (the session's shuffle partitions, if not given) should make
    buckets that fit a task; each is one file, sorted by UserID.  Users who
    have rated nothing, and users listed twice, are kept as they are.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = path.rstrip("/")
    # Fewer rows than buckets, so broadcast: the ratings are split without a shuffle.
    hot = F.broadcast(hot_raters(t.ratings, buckets))
    apart = t.ratings.join(hot, KEY, "left_semi").unionByName(t.ratings.where(F.col(KEY).isNull()))
    evenly = t.ratings.where(F.col(KEY).isNotNull()).join(hot, KEY, "left_anti")
    for name, frame in (("ratings", evenly), ("users", t.users)):
        table = _unused()
        placed = frame.repartition(buckets, KEY)  # a bucket's rows meet in one task: one file a bucket
        placed.write.bucketBy(buckets, KEY).sortBy(KEY).option("path", f"{base}/{name}").format("parquet").saveAsTable(table)
        spark.sql(f"DROP TABLE {table}")
    apart.write.parquet(f"{base}/ratings_apart")
    t.users.join(hot, KEY, "left_semi").write.parquet(f"{base}/users_apart")
    layout = [(name, _columns(frame), buckets) for name, frame in (("ratings", t.ratings), ("users", t.users))]
    spark.createDataFrame(layout, "relation string, columns string, buckets int").coalesce(1).write.parquet(f"{base}/layout")
    return open_colocated(spark, base)


def open_colocated(spark: SparkSession, path: str) -> Colocated:
    """What ``store_colocated`` wrote.  The catalog forgets the tables at once: their plans know the buckets."""
    base = path.rstrip("/")
    layout = {r["relation"]: r for r in spark.read.parquet(f"{base}/layout").collect()}  # a row a relation
    frames = {}
    for name in _BUCKETED:
        table, buckets = _unused(), layout[name]["buckets"]
        spark.sql(
            f"CREATE TABLE {table} ({layout[name]['columns']}) USING parquet "
            f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{base}/{name}'"
        )
        frames[name] = spark.table(table).select("*")
        spark.sql(f"DROP TABLE {table}")
    for name, of in zip(_APART, _BUCKETED):
        frames[name] = spark.read.schema(layout[of]["columns"]).parquet(f"{base}/{name}")
    return Colocated(**frames, buckets=layout["ratings"]["buckets"])


def ratings_with_users(c: Colocated, hint: str | None = None) -> DataFrame:
    """Every rating with its rater's gender and age band, as ``analyses.ratings_with_users`` has it.

    The bucketed sides meet bucket by bucket; the ratings kept apart meet the few profiles they need.
    """
    columns = ["UserID", "MovieID", "Rating", "Gender", "Age"]
    profile = ["UserID", "Gender", "Age"]
    even = join_dimension(c.ratings, c.users.select(profile), KEY, hint=hint).select(columns)
    apart = join_dimension(c.ratings_apart, c.users_apart.select(profile), KEY).select(columns)
    return even.unionByName(apart)


def store_denormalised(spark: SparkSession, t: Tables, path: str) -> DataFrame:
    """Write every rating of a known rater with gender, occupation and age band to the new folder ``path``.

    One folder an age band (a NULL band has its own), clustered by MovieID
    inside each file.  The write needs one join and no other shuffle.
    """
    rated = join_dimension(t.ratings, t.users.select("UserID", "Gender", "Age", "OccupationID"), KEY)
    rated.sortWithinPartitions("Age", "MovieID").write.partitionBy("Age").parquet(path)
    # The folder's names are text: without the schema the band codes would be read as numbers.
    return spark.read.schema(rated.schema).parquet(path)


def demographics(denormalised: DataFrame, movie) -> DataFrame:
    """Head-count of a movie's raters by gender and age band, without a join."""
    return count_by(denormalised.where(F.col("MovieID") == F.lit(movie)), ["Gender", "Age"])


def cohort_counts(denormalised: DataFrame, age: str) -> DataFrame:
    """Ratings of each movie by one age band: one folder is read, and no join made."""
    return count_by(denormalised.where(F.col("Age") == F.lit(age)), "MovieID")


def _unused() -> str:
    return f"rw_colocated_{uuid.uuid4().hex}"


def _columns(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
