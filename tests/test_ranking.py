"""Every row's place, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rateweave.operators.ranking import ranked, with_ties
from rateweave.plans import analyses as A
from rateweave.plans import plan_text
from rateweave.sources.tables import load_tables
from tests.conftest import SF001, rows


def test_places_equal_row_number(spark):
    averages = A.avg_rating_by_movie(load_tables(spark, SF001))
    order = [F.col("avg_rating").desc(), F.col("MovieID").asc()]
    want = averages.withColumn("position", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    for ranges in (1, 5, 64):
        assert rows(ranked(averages, order, ranges=ranges)) == rows(want)


def test_no_exchange_into_one_partition(spark):
    averages = A.avg_rating_by_movie(load_tables(spark, SF001))
    text = plan_text(ranked(averages, [F.col("avg_rating").desc(), F.col("MovieID").asc()]))
    assert "SinglePartition" not in text and "Window" not in text


def test_hot_value_spreads_by_the_second_key(spark):
    """A third of the rows share one value: the next key of the order deals them out."""
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 1.0).otherwise(F.col("id") % 97).alias("value"), "id")
    found = ranked(df, [F.col("value").desc(), F.col("id").asc()], ranges=12)
    want = df.withColumn("position", F.row_number().over(Window.orderBy(F.col("value").desc(), "id")).cast("bigint"))
    assert rows(found) == rows(want)


def test_nulls_empty_tables_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, 1), (2.0, 2), (None, 3), (5.0, 4), (5.0, 4)], "value double, id long")
    order = [F.col("value").desc_nulls_last(), F.col("id").asc()]
    assert rows(ranked(df, order), "position", "id") == [(1, 4), (2, 4), (3, 2), (4, 1), (5, 3)]
    assert ranked(df.limit(0), order).count() == 0


def test_ties_share_the_first_place(spark):
    df = spark.createDataFrame([(3.0, 1), (3.0, 2), (2.0, 3), (None, 4), (None, 5)], "value double, id long")
    found = with_ties(ranked(df, [F.col("value").desc_nulls_last(), F.col("id").asc()]), "value")
    assert rows(found, "id", "position", "rank") == [(1, 1, 1), (2, 2, 1), (3, 3, 3), (4, 4, 4), (5, 5, 4)]
