"""One intermediate result for several analyses of a session.

Queries of this library never cache by themselves.  A caller who asks several
questions of the same join can hold it for as long as the block runs: it is
computed once, kept in memory and on disk, and always let go.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from rateweave.operators.aggregates import avg_by
from rateweave.operators.filters import where_equals
from rateweave.operators.joins import join_dimension
from rateweave.operators.topk import top_k
from rateweave.plans import analyses
from rateweave.sources.tables import Tables


@contextmanager
def shared(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """``df``, computed at its first use and let go when the block ends, also by an error.

    A frame that the caller has persisted already is left to the caller.  A
    lost executor's blocks are computed again from the plan.
    """
    level_before = df.storageLevel
    if level_before.useMemory or level_before.useDisk:
        yield df
        return
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist(blocking=True)


def top_rated_by_genders(t: Tables, genders: list[str], k: int = analyses.DEFAULT_K) -> dict[str, list[Row]]:
    """The ``k`` best rated movies of each gender, as rows, from one shared join of ratings and users.

    The same as ``analyses.top_rated_by_gender`` one by one, which would join once for each.
    """
    people = t.users.select("UserID", "Gender").where(F.col("Gender").isin(genders))
    rated = join_dimension(t.ratings, people, "UserID").select("Gender", "MovieID", "Rating")
    order = [F.col("avg_rating").desc(), F.col("MovieID").asc()]
    with shared(rated) as held:
        return {g: top_k(avg_by(where_equals(held, "Gender", g), "MovieID"), order, k).collect() for g in genders}
