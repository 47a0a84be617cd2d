"""The conversion that stores ages as bands, one folder each."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from rateweave.plans import analyses as A
from rateweave.plans import plan_text
from rateweave.sources.parquet import convert_to_parquet, load_by_band, load_converted
from tests.conftest import CLEAN, rows, write_dat

USERS = ["1::F::17::4::1", "2::M::18::7::2", "3::M::24::4::3", "4::F::56::9::4", "5::F::::9::5", "6::M::old::9::6", "7::M::34.5::9::7"]
RATINGS = ["1::10::5::1", "2::10::4::2", "2::20::4::2", "3::10::3::3", "3::20::1::3", "3::30::2::3", "4::30::2::4", "5::10::1::5", "6::10::1::6", "9::10::1::9"]


def _converted(spark, tmp_path):
    base = write_dat(tmp_path / "dat", {**CLEAN, "users.dat": USERS, "ratings.dat": RATINGS})
    out = str(tmp_path / "pq")
    return convert_to_parquet(spark, base, out, raw_ages=True, by_band=True), out


def test_years_are_stored_as_bands(spark, tmp_path):
    tables, out = _converted(spark, tmp_path)
    want = [("1", "1"), ("2", "18"), ("3", "18"), ("4", "56"), ("5", None), ("6", None), ("7", "25")]
    assert rows(tables.users, "UserID", "Age") == want
    assert tables.users.columns == ["UserID", "Gender", "Age", "OccupationID", "Zip_Code"]
    folders = sorted(x for x in os.listdir(f"{out}/users") if "=" in x)
    assert folders == ["Age=1", "Age=18", "Age=25", "Age=56", "Age=__HIVE_DEFAULT_PARTITION__"]
    assert rows(load_converted(spark, out).users) == rows(tables.users)


def test_a_cohort_reads_its_folder_only(spark, tmp_path):
    tables, _ = _converted(spark, tmp_path)
    cohort = A.cohort_top_titles(tables, "18")
    text = plan_text(cohort)
    assert "PartitionFilters: [isnotnull(Age" in text and "= 18)]" in text
    assert [tuple(r) for r in cohort.collect()] == [("Alpha (1990)", 2), ("Beta (1991)", 2), ("Gamma (1992)", 1)]


def test_ratings_by_band(spark, tmp_path):
    tables, out = _converted(spark, tmp_path)
    banded, bands = load_by_band(spark, out)
    want = A.ratings_with_users(tables)
    assert rows(banded, "UserID", "MovieID", "Rating", "Age") == rows(want, "UserID", "MovieID", "Rating", "Age")
    assert bands.count() == 7
    found = A.cohort_top_titles_by_label(banded, bands, tables.movies, "18-24")
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in A.cohort_top_titles(tables, "18").collect()]
    assert "dynamicpruning" in plan_text(found)


def test_the_label_chooses_the_folder_at_run_time(spark, tmp_path):
    """Only the label's ratings leave the scan."""
    _, out = _converted(spark, tmp_path)
    banded, bands = load_by_band(spark, out)
    wanted = F.broadcast(bands.where(F.col("AgeLabel") == "18-24").select("Age"))
    joined = banded.join(wanted, "Age")
    assert joined.count() == 5
    joined.write.format("noop").mode("overwrite").save()
    scan = plan_text(joined)
    assert "dynamicpruningexpression" in scan and "PartitionFilters" in scan


def test_without_bands_nothing_changes(spark, tmp_path):
    base = write_dat(tmp_path / "dat", CLEAN)
    tables = convert_to_parquet(spark, base, str(tmp_path / "pq"))
    assert not os.path.exists(tmp_path / "pq" / "ratings_by_band")
    assert rows(tables.users, "Age") == [("18",), ("18",), ("25",), ("25",)]
