"""Newer listings merged into stored ones: the last wins, and a dead run does no harm."""

from __future__ import annotations

import os

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from rateweave.sources.upsert import Listing
from tests.conftest import rows

SCHEMA = StructType(
    [StructField("MovieID", LongType()), StructField("Title", StringType()), StructField("Genres", StringType()), StructField("seq", LongType())]
)


def listing(spark, path, slots=8):
    return Listing(spark, str(path), SCHEMA, "MovieID", "seq", slots)


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def _slots(path):
    return {name: sorted(os.listdir(os.path.join(path, "slots", name))) for name in os.listdir(os.path.join(path, "slots")) if "=" in name}


def test_last_listing_wins_whatever_the_order(spark, tmp_path):
    batches = [
        [(1, "a", "x", 0), (2, "b", "x", 0), (None, "n", None, 0)],
        [(2, "B", None, 2), (3, "c", "x", 2)],
        [(2, "late", "x", 1), (1, "A", "x", 3), (None, "N", None, 1)],
    ]
    want = [(1, "A", "x", 3), (2, "B", None, 2), (3, "c", "x", 2), (None, "N", None, 1)]
    for n, order in enumerate(([0, 1, 2], [2, 1, 0], [1, 0, 2, 1])):
        stored = listing(spark, tmp_path / str(n))
        assert stored.rows().count() == 0
        for k in order:
            stored.merge(frame(spark, batches[k]))
        assert rows(stored.rows()) == want


def test_only_touched_slots_are_rewritten(spark, tmp_path):
    stored = listing(spark, tmp_path)
    stored.merge(frame(spark, [(i, f"t{i}", "g", 0) for i in range(200)]))
    before = _slots(tmp_path)
    stored.merge(frame(spark, [(5, "five", "g", 1)]))
    after = _slots(tmp_path)
    assert len(before) == 8 and sum(before[s] != after[s] for s in before) == 1
    assert stored.rows().count() == 200 and stored.rows().where("MovieID = 5").first()["Title"] == "five"


def test_a_run_that_dies_before_its_mark_changes_nothing(spark, tmp_path):
    stored = listing(spark, tmp_path)
    stored.merge(frame(spark, [(1, "a", "x", 0)]))
    frame(spark, [(1, "half", "x", 9)]).selectExpr("*", "0 AS slot").write.partitionBy("slot").parquet(f"{tmp_path}/staging/dead/slots")
    assert rows(listing(spark, tmp_path).rows()) == [(1, "a", "x", 0)]
    assert os.listdir(tmp_path / "staging") == []


@pytest.mark.parametrize("replaced", [False, True])
def test_a_run_that_dies_after_its_mark_is_finished(spark, tmp_path, monkeypatch, replaced):
    stored = listing(spark, tmp_path)
    stored.merge(frame(spark, [(i, f"t{i}", "g", 0) for i in range(50)]))
    whole = Listing.apply

    def dies(self, staging):
        if replaced:  # in the middle: the slots are replaced, the staging folder is still there
            self._read(f"{staging}/slots").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slot").parquet(
                f"{self.path}/slots"
            )
        raise RuntimeError("lost driver")

    monkeypatch.setattr(Listing, "apply", dies)
    newer = [(i, f"T{i}", "g", 1) for i in range(0, 50, 2)]
    with pytest.raises(RuntimeError):
        stored.merge(frame(spark, newer))
    monkeypatch.setattr(Listing, "apply", whole)
    again = listing(spark, tmp_path)
    want = sorted(newer + [(i, f"t{i}", "g", 0) for i in range(1, 50, 2)])
    assert rows(again.rows()) == want
    again.merge(frame(spark, newer))  # the same run once more
    assert rows(again.rows()) == want


def test_empty_listing_and_ties(spark, tmp_path):
    stored = listing(spark, tmp_path)
    stored.merge(frame(spark, []))
    assert stored.rows().count() == 0
    for data in ([(1, "a", "x", 0)], [(1, "b", "x", 0)], [(1, "a", "y", 0)]):
        stored.merge(frame(spark, data))
    assert rows(stored.rows()) == [(1, "b", "x", 0)]
