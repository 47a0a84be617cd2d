"""Stored, mergeable averages: (sum, count) of each movie and day, added to day by day.

An average can't be merged, its sum and count can.  A batch of ratings becomes
one row for each movie and day in a folder of its own; an average over any
period is the sum of the stored rows in it, and the ratings that were added
before are never read again.  Adding a batch anew replaces what it had added,
so a failed or repeated run counts nothing twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rateweave.functions.ordering import time_sort_key

STATE = "month string, day date, MovieID {movie}, total double, n bigint"


def day_of(ratings: DataFrame, time_col: str = "Timestamp") -> Column:
    """The UTC day of a review time in epoch seconds; NULL where it is no number."""
    seconds = F.floor(time_sort_key(ratings, time_col)).cast("bigint")
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86_400).cast("int"))


def daily_state(ratings: DataFrame) -> DataFrame:
    """``(month, day, MovieID, total, n)``: the sum and number of the ratings that have a value.

    A movie that only has ratings without a value on a day is listed with n 0,
    so that its average is NULL, as ``AVG`` has it.
    """
    rated = ratings.select(day_of(ratings).alias("day"), "MovieID", "Rating")
    state = rated.groupBy("day", "MovieID").agg(F.coalesce(F.sum("Rating"), F.lit(0.0)).alias("total"), F.count("Rating").alias("n"))
    return state.select(F.date_format("day", "yyyy-MM").alias("month"), "day", "MovieID", "total", "n")


def add_batch(path: str, batch: str, ratings: DataFrame) -> None:
    """Store a batch's state under ``path``; the same ``batch`` again replaces it.

    One folder a month, so that a period reads its months only; late ratings
    of old days are rows of this batch, and nothing of others is rewritten.
    """
    if not batch or any(c in batch for c in "/=\\"):
        raise ValueError(f"{batch!r} can't name a folder")
    state = daily_state(ratings).repartition("month")
    state.write.mode("overwrite").partitionBy("month").parquet(f"{path.rstrip('/')}/batch={batch}")


def state(spark: SparkSession, path: str, movie_type: str = "bigint") -> DataFrame:
    """All batches' rows, with ``batch`` and ``month`` as partition columns."""
    schema = STATE.format(movie=movie_type) + ", batch string"
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def averages(rows: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """``(MovieID, avg_rating)`` over the days ``first`` to ``last`` (all) of stored state."""
    if first is not None:
        rows = rows.where((F.col("month") >= first[:7]) & (F.col("day") >= F.lit(first).cast("date")))
    if last is not None:
        rows = rows.where((F.col("month") <= last[:7]) & (F.col("day") <= F.lit(last).cast("date")))
    merged = rows.groupBy("MovieID").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    return merged.select("MovieID", F.try_divide("total", "n").alias("avg_rating"))


def compacted(spark: SparkSession, path: str, new_path: str, movie_type: str = "bigint") -> None:
    """All batches of ``path`` as one batch ``merged`` in the new folder ``new_path``; the old one stays as it is."""
    rows = state(spark, path, movie_type).groupBy("month", "day", "MovieID").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    rows.repartition("month").write.partitionBy("month").parquet(f"{new_path.rstrip('/')}/batch=merged")
