"""The physical operators the design relies on actually appear in the plans."""

from __future__ import annotations

import contextlib

import pytest

import __spark_entry__ as E
from rateweave.operators import semi_join
from rateweave.plans import analyses as A
from rateweave.plans import plan_text
from rateweave.sources.tables import load_tables
from tests.conftest import SF01


@contextlib.contextmanager
def conf(spark, **settings):
    keys = {k.replace("__", "."): v for k, v in settings.items()}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def no_auto_broadcast(spark):
    """Plan as if every table were too large for the size-based broadcast."""
    return conf(spark, **{"spark__sql__autoBroadcastJoinThreshold": "-1"})


@pytest.fixture(scope="module")
def t(spark):
    return load_tables(spark, SF01)


def test_top_k_is_take_ordered_after_partial_aggregate(spark, t):
    with no_auto_broadcast(spark):
        text = plan_text(A.top_rated(t))
    assert "TakeOrderedAndProject" in text
    assert "Sort " not in text.split("TakeOrderedAndProject")[0]
    partial = text.index("partial_avg")
    assert partial > text.index("Exchange")  # listed after: runs before the shuffle
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double>" in text


def test_filters_reach_the_scan(spark, t):
    text = plan_text(A.movie_viewers(t, 1193))
    assert "PushedFilters: [IsNotNull(l_partkey), EqualTo(l_partkey,1193)" in text
    text = plan_text(A.top_rated_by_gender(t, "BUILDING"))
    assert "EqualTo(c_mktsegment,BUILDING)" in text


def test_sides_are_broadcast_by_their_measured_size(spark, t):
    assert "BroadcastHashJoin" in plan_text(A.users_with_occupations(t))
    with no_auto_broadcast(spark):
        text = plan_text(semi_join(t.ratings, t.users, "UserID"))
    assert "SortMergeJoin LeftSemi" in text
    assert "BroadcastHashJoin" not in text


def test_cohort_ranking_reads_two_columns_of_the_ratings(spark, t):
    """No helper column keeps more of the fact alive than the answer needs."""
    with no_auto_broadcast(spark):
        text = plan_text(A.cohort_top_titles(t, "18"))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in text
    assert text.split("\n\n")[0].count("SortMergeJoin") == 3  # orders (adapter), cohort, titles


def test_merge_hint_forces_the_shuffle_form(spark, t):
    text = plan_text(A.ratings_with_users(t, hint="merge"))
    assert "SortMergeJoin Inner" in text.split("\n\n")[0]


def test_title_lookup_broadcasts_only_the_top_ids(spark, t):
    with no_auto_broadcast(spark):
        text = plan_text(A.cohort_top_movies_semi(t, "18"))
    tree = text.split("\n\n")[0]
    assert tree.count("BroadcastHashJoin LeftSemi") == 1  # the top ids; the cohort is shuffled
    first_join = next(line for line in tree.splitlines() if "Join" in line)
    assert "BroadcastHashJoin LeftOuter BuildRight" in first_join  # titles back to the top rows


def test_per_group_top_k_limits_before_the_shuffle(spark, t):
    text = plan_text(A.top_rated_per_gender(t))
    assert text.count("WindowGroupLimit") >= 2
    lines = text.split("\n\n")[0].splitlines()
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    # final limit above the window's shuffle, partial limit below it
    assert any("Exchange" in line for line in lines[limits[0] : limits[1]])


def test_no_python_no_cartesian_in_any_registered_query(spark):
    for name, fn in E.queries().items():
        if name in E.LLM_QUERIES:
            continue
        text = plan_text(fn(spark, SF01))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in text, (name, bad)


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", SF01, "/root/testdata/sf0.1"])
def test_declared_source_columns_match_the_files(spark, sf_dir):
    from pyspark.sql.types import StructType

    from rateweave.sources.tables import SOURCE_COLUMNS

    for name, ddl in SOURCE_COLUMNS.items():
        actual = {f.name: f.dataType for f in spark.read.parquet(f"{sf_dir}/{name}.parquet").schema.fields}
        for field in StructType.fromDDL(ddl).fields:
            assert actual[field.name] == field.dataType, (sf_dir, name, field.name)


def test_large_cohort_prefilters_ratings_before_the_shuffle(spark, tmp_path):
    """Beyond the broadcast threshold, a runtime bloom filter built from the cohort
    cuts the ratings scan before its shuffle (Spark applies it to scans of
    10 GB and more; the threshold is lowered here to see it on a fixture)."""
    from rateweave.sources.parquet import convert_to_parquet
    from tests.conftest import CLEAN, write_dat

    tables = convert_to_parquet(spark, write_dat(tmp_path / "dat", CLEAN), str(tmp_path / "pq"))
    settings = {
        "spark__sql__autoBroadcastJoinThreshold": "-1",
        "spark__sql__optimizer__runtime__bloomFilter__enabled": "true",
        "spark__sql__optimizer__runtime__bloomFilter__applicationSideScanSizeThreshold": "1",
    }
    with conf(spark, **settings):
        inner = plan_text(A.cohort_top_titles(tables, "18"))
        semi = plan_text(A.cohort_ratings(tables, "18"))
        assert "might_contain" in inner and "might_contain" in semi
        assert A.cohort_ratings(tables, "18").count() == 4

