"""Rankings.  Every ranking takes a total order, so results are repeatable.

``top_k`` plans as ``TakeOrderedAndProject``: each task keeps its own k best
rows and a single task merges k rows per task, instead of a full range sort.
``top_k_per_group`` filters a ``row_number`` window, which Spark plans with a
partial ``WindowGroupLimit`` in every task before the shuffle, so a group
ships at most k rows per task however large it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rateweave.functions.ordering import time_sort_key


def top_k(df: DataFrame, order: list[Column], k: int = 10) -> DataFrame:
    """The first ``k`` rows under ``order`` (give a total order for repeatable cuts)."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(
    df: DataFrame,
    group: str | list[str],
    order: list[Column],
    k: int = 10,
    rank_col: str = "rank",
) -> DataFrame:
    """The first ``k`` rows of every group under ``order``, numbered 1..k in ``rank_col``."""
    keys = [group] if isinstance(group, str) else list(group)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(window)).where(F.col(rank_col) <= k)


def latest(
    ratings: DataFrame,
    k: int = 10,
    time_col: str = "Timestamp",
    value_col: str = "Rating",
    ties: tuple[str, ...] = ("UserID", "MovieID"),
) -> DataFrame:
    """The k most recent reviews: time descending, then value descending,
    then the ids ascending so that equal (time, value) pairs cut the same
    way every run."""
    order = [time_sort_key(ratings, time_col).desc(), F.col(value_col).desc()]
    order += [F.col(c).asc() for c in ties]
    return top_k(ratings, order, k)
