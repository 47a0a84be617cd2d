"""Projections and the unordered sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def project(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols)


def sample_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """Any ``n`` rows, order unspecified (a peek at the data, not a ranking)."""
    return df.limit(n)


def rating_pairs(ratings: DataFrame) -> DataFrame:
    """(MovieID, Rating, one): the keyed form the averages are built from."""
    return ratings.select("MovieID", "Rating", F.lit(1).alias("one"))
