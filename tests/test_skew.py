"""One user holding a third of all ratings: the join is split, the answer unchanged."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rateweave.operators import count_by, join_dimension
from rateweave.plans import analyses as A
from rateweave.plans import plan_text
from rateweave.sources.tables import Tables
from tests.conftest import rows
from tests.test_plans import conf


def _skewed(spark, n=240_000, users=4_000):
    ratings = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % users).alias("UserID"),
        (F.col("id") % 500).alias("MovieID"),
        ((F.col("id") * 7) % 5 + 1).cast("double").alias("Rating"),
        F.col("id").alias("Timestamp"),
    )
    people = spark.range(users).select(
        F.col("id").alias("UserID"),
        F.when(F.col("id") % 2 == 0, "M").otherwise("F").alias("Gender"),
        F.when(F.col("id") % 3 == 0, "18").otherwise("25").alias("Age"),
        F.lit(1).alias("OccupationID"),
    )
    movies = spark.range(500).select(F.col("id").alias("MovieID"), F.lit("t").alias("Title"))
    occupations = spark.range(1).select(F.lit(1).alias("OccupationID"), F.lit("o").alias("OccupationName"))
    return Tables(ratings, people, movies, occupations)


# Every side shuffled, and partitions called skewed at a size that small data reaches.
SHUFFLED = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "256k",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "64k",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
}


def test_hot_user_partition_is_split_and_results_match(spark):
    t = _skewed(spark)
    expected = rows(A.top_rated_by_gender(t, "M"))  # broadcast path
    with conf(spark, **SHUFFLED):
        df = A.top_rated_by_gender(t, "M")
        got = rows(df)
        text = plan_text(df)
    assert got == expected
    assert "SortMergeJoin(skew=true)" in text


def test_hot_movie_counts_combine_before_the_shuffle(spark):
    t = _skewed(spark)
    hot = t.ratings.withColumn("MovieID", F.when(F.col("UserID") == 0, F.lit(7)).otherwise(F.col("MovieID")))
    skewed = Tables(hot, t.users, t.movies, t.occupations)
    top = A.most_popular(skewed, 1).collect()
    assert (top[0]["MovieID"], top[0]["cnt"]) == (7, hot.where("MovieID = 7").count())
    assert "partial_count" in plan_text(A.most_popular(skewed, 1))


def test_hot_user_semi_join_is_split_too(spark):
    t = _skewed(spark)
    expected = rows(count_by(A.cohort_ratings(t, "18"), "MovieID"))
    with conf(spark, **SHUFFLED):
        df = count_by(A.cohort_ratings(t, "18"), "MovieID")
        got = rows(df)
        text = plan_text(df)
    assert got == expected
    assert sum(cnt for _, cnt in got) == t.ratings.where(F.col("UserID") % 3 == 0).count()
    assert "SortMergeJoin(skew=true) LeftSemi" in text


def test_hot_cohort_ranking_is_split(spark):
    t = _skewed(spark)
    expected = rows(A.cohort_top_titles(t, "18"))
    with conf(spark, **SHUFFLED):
        df = A.cohort_top_titles(t, "18")
        assert rows(df) == expected
        assert "SortMergeJoin(skew=true)" in plan_text(df)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_rows_survive_changing_row_order_without_exchange_reuse(spark, how):
    """Rows arrive in another order at every evaluation and no exchange is shared."""
    fact = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(F.col("id") % 900).alias("k")
    )
    fact = fact.orderBy(F.rand())
    dim = spark.range(900).select(F.col("id").alias("k"), F.lit("d").alias("d"))
    null, matched = 100_000, 200_000
    want = {"inner": matched, "left": matched + null, "left_semi": matched, "left_anti": null}[how]
    with conf(spark, **SHUFFLED, spark__sql__exchange__reuse="false"):
        for _ in range(2):
            assert join_dimension(fact, dim, "k", how).count() == want
