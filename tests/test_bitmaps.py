"""Sets of ids as bitmaps: counts, members and membership equal to the plain ones, and mergeable."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rateweave.operators import bitmaps as B
from rateweave.plans import analyses as A
from rateweave.sources.tables import load_tables
from tests.conftest import SF001, rows

EDGES = [0, 1, -1, 2, 7, 8, 32_767, 32_768, 32_769, -32_767, -32_768, -32_769, 65_536, 65_537, 10**12, -(10**12), None, 8, 8]


def test_members_of_edge_ids(spark):
    df = spark.createDataFrame([(i,) for i in EDGES], "id long")
    sets = B.bitmaps(df, "id")
    assert rows(B.members(sets, "id")) == sorted({(i,) for i in EDGES if i is not None})
    assert rows(B.distinct_counts(sets)) == [(len(set(EDGES)) - 1,)]
    wanted = spark.createDataFrame([(i, n) for n, i in enumerate(EDGES + [3, 9, 32_770])], "id long, n int")
    found = B.where_member(wanted, "id", sets)
    assert rows(found) == rows(wanted.where(F.col("id").isNotNull() & ~F.col("id").isin(3, 9, 32_770)))


def test_sets_of_days_are_united(spark):
    """Distinct ids of both days, which the days' own counts don't tell."""
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2), ("b", 40_000), ("b", 40_000), ("c", None)], "day string, id int")
    sets = B.bitmaps(df, "id", ["day"])
    assert rows(B.distinct_counts(sets, ["day"])) == [("a", 2), ("b", 2)]
    assert rows(B.distinct_counts(sets)) == [(3,)]
    later = B.bitmaps(spark.createDataFrame([("c", 2), ("c", 5)], "day string, id int"), "id", ["day"])
    assert rows(B.distinct_counts(sets.unionByName(later))) == [(4,)]


def test_cohort_equals_distinct_and_semi_join(spark):
    t = load_tables(spark, SF001)
    sets = B.bitmaps(A.cohort_ratings(t, "18"), "UserID")
    assert rows(B.members(sets, "UserID")) == rows(A.cohort_raters(t, "18"))
    cohort = B.bitmaps(t.users.where("Age = '18'"), "UserID")
    assert rows(B.where_member(t.ratings, "UserID", cohort)) == rows(A.cohort_ratings(t, "18"))


def test_hot_id_is_one_bit(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("id"))
    assert rows(B.distinct_counts(B.bitmaps(df, "id"))) == [(df.distinct().count(),)]


def test_empty_tables_and_text_ids(spark):
    df = spark.createDataFrame([], "id long, day string")
    assert B.bitmaps(df, "id").count() == 0 and rows(B.distinct_counts(B.bitmaps(df, "id"))) == [(0,)]
    assert B.where_member(df, "id", B.bitmaps(df, "id")).count() == 0
    with pytest.raises(TypeError, match="whole numbers"):
        B.bitmaps(df, "day")
