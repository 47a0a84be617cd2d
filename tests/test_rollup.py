"""Averages merged from stored sums and counts."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from rateweave.plans import analyses as A
from rateweave.plans import plan_text
from rateweave.sources import rollup
from rateweave.sources.tables import load_tables
from tests.conftest import SF001, rows


def _files(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


@pytest.fixture()
def added(spark, tmp_path):
    t = load_tables(spark, SF001)
    cut = 800_000_000
    path = str(tmp_path / "state")
    rollup.add_batch(path, "old", t.ratings.where(F.col("Timestamp") < cut))
    rollup.add_batch(path, "new", t.ratings.where(F.col("Timestamp") >= cut))
    return t, path


def test_merged_equals_recomputed(spark, added):
    t, path = added
    assert rows(rollup.averages(rollup.state(spark, path))) == rows(A.avg_rating_by_movie(t))


def test_a_new_batch_rewrites_nothing_and_a_repeated_one_counts_once(spark, added):
    t, path = added
    before = _files(os.path.join(path, "batch=old"))
    late = t.ratings.limit(50).withColumn("Rating", F.lit(1.0))
    rollup.add_batch(path, "late", late)
    rollup.add_batch(path, "late", late)
    assert _files(os.path.join(path, "batch=old")) == before
    want = A.avg_by(t.ratings.unionByName(late), "MovieID")
    assert rows(rollup.averages(rollup.state(spark, path))) == rows(want)


def test_a_period_reads_its_months_only(spark, added):
    t, path = added
    found = rollup.averages(rollup.state(spark, path), "1994-03-05", "1994-05-17")
    days = F.timestamp_seconds("Timestamp").cast("date").between("1994-03-05", "1994-05-17")
    assert rows(found) == rows(A.avg_by(t.ratings.where(days), "MovieID"))
    assert "PartitionFilters: [isnotnull(month" in plan_text(found)


def test_compacted_state_gives_the_same(spark, added, tmp_path):
    t, path = added
    rollup.compacted(spark, path, str(tmp_path / "merged"))
    merged = rollup.state(spark, str(tmp_path / "merged"))
    assert rows(rollup.averages(merged)) == rows(A.avg_rating_by_movie(t))
    assert merged.groupBy("day", "MovieID").count().where("count > 1").isEmpty()


def test_missing_values_and_times(spark, tmp_path):
    ratings = spark.createDataFrame(
        [(1, "10", 5.0, "0"), (2, "10", None, "90000"), (3, "20", None, "1"), (4, "30", 2.0, "no time"), (5, None, 3.0, "-1"), (6, "10", 2.0, "86399")],
        "UserID long, MovieID string, Rating double, Timestamp string",
    )
    path = str(tmp_path / "state")
    rollup.add_batch(path, "all", ratings)
    stored = rollup.state(spark, path, "string")
    assert rows(rollup.averages(stored)) == rows(A.avg_by(ratings, "MovieID"))
    assert rows(stored.select(F.col("day").cast("string"), "MovieID", "total", "n")) == [
        ("1969-12-31", None, 3.0, 1), ("1970-01-01", "10", 7.0, 2), ("1970-01-01", "20", 0.0, 0), ("1970-01-02", "10", 0.0, 0), (None, "30", 2.0, 1),
    ]
    rollup.add_batch(path, "none", ratings.limit(0))
    assert rows(rollup.averages(rollup.state(spark, path, "string"))) == rows(A.avg_by(ratings, "MovieID"))
    with pytest.raises(ValueError):
        rollup.add_batch(path, "a/b", ratings)
