"""A result shared by several analyses is computed once and let go."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rateweave.plans import analyses as A
from rateweave.plans import plan_text
from rateweave.plans.shared import shared, top_rated_by_genders
from rateweave.sources.tables import load_tables
from tests.conftest import SF001


def _kept(spark) -> int:
    return spark.sparkContext._jsc.sc().getPersistentRDDs().size()


def test_computed_once_and_let_go(spark):
    before, ran = _kept(spark), spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            ran.add(b.num_rows)
            yield b

    base = spark.range(500).mapInArrow(counted, "id long")
    with shared(base) as held:
        assert "InMemoryTableScan" in plan_text(held.where("id > 3"))
        assert [held.where(F.col("id") % 2 == n).count() for n in (0, 1)] == [250, 250]
        assert _kept(spark) == before + 1
    assert ran.value == 500 and _kept(spark) == before
    assert "InMemoryTableScan" not in plan_text(base.where("id > 3"))


def test_let_go_by_an_error_too(spark):
    before = _kept(spark)
    with pytest.raises(ZeroDivisionError), shared(spark.range(10)) as held:
        held.count()
        raise ZeroDivisionError
    assert _kept(spark) == before


def test_what_the_caller_has_persisted_stays(spark):
    own = spark.range(11).persist()
    try:
        with shared(own) as held:
            assert held.count() == 11
        assert own.storageLevel.useMemory
    finally:
        own.unpersist(blocking=True)


def test_genders_from_one_join(spark):
    t = load_tables(spark, SF001)
    before = _kept(spark)
    found = top_rated_by_genders(t, ["BUILDING", "MACHINERY"], 5)
    assert found == {g: A.top_rated_by_gender(t, g, 5).collect() for g in ("BUILDING", "MACHINERY")}
    assert _kept(spark) == before
