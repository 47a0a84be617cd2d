"""Where two spellings of one question differ on dirty data."""

from __future__ import annotations

from pyspark.sql import functions as F

from rateweave.operators import avg_by, top_k, where_equals, where_suffix
from rateweave.plans import analyses as A
from rateweave.schemas import MOVIES
from rateweave.sources.delimited import read_delimited
from tests.conftest import CLEAN, dat_tables, rows, write_dat


def test_duplicate_user_counts_once_in_semi_form_twice_in_inner(spark, tmp_path):
    users = CLEAN["users.dat"] + ["1::F::18::4::10001"]
    t = dat_tables(spark, tmp_path / "dup", {"users.dat": users})
    inner = dict(rows(A.cohort_top_titles(t, "18")))
    semi = dict(rows(A.cohort_top_movies_semi(t, "18").select("Title", "cnt")))
    assert inner["Alpha (1990)"] == 3  # users 1 (twice) and 2
    assert semi["Alpha (1990)"] == 2


def test_orphan_rating_kept_with_null_title_only_in_lookup_form(spark, tmp_path):
    ratings = CLEAN["ratings.dat"] + ["1::99::4::1005", "2::99::4::1006", "1::99::1::1007"]
    t = dat_tables(spark, tmp_path / "orphan", {"ratings.dat": ratings})
    lookup = rows(A.cohort_top_movies_semi(t, "18"), "MovieID", "cnt", "Title")
    assert ("99", 3, None) in lookup
    inner = rows(A.cohort_top_titles(t, "18"))
    assert all(title is not None for title, _ in inner)
    assert sum(cnt for _, cnt in inner) == 4  # movie 99 dropped before the cut


def test_duplicate_movie_two_rows_inner_last_title_in_lookup(spark, tmp_path):
    movies = CLEAN["movies.dat"] + ["10::Alpha copy (1990)::Drama"]
    folder = tmp_path / "dupmovie"
    t = dat_tables(spark, folder, {"movies.dat": movies}, movie_seq="seq")
    inner = rows(A.cohort_top_titles(t, "18"))
    assert ("Alpha (1990)", 2) in inner and ("Alpha copy (1990)", 2) in inner
    looked = rows(A.cohort_top_movies_semi(t, "18", seq="seq"), "MovieID", "Title")
    assert ("10", "Alpha copy (1990)") in looked
    last = rows(A.titles_last_wins(t.movies, "seq"), "MovieID", "Title")
    assert last == [("10", "Alpha copy (1990)"), ("20", "Beta (1991)"), ("30", "Gamma (1992)")]


def test_last_wins_follows_file_order_not_title_order(spark, tmp_path):
    folder = write_dat(tmp_path / "order", {"movies.dat": ["10::Zeta::D", "10::Alpha::D"]})
    movies = read_delimited(spark, f"{folder}/movies.dat", MOVIES, seq_col="seq")
    assert rows(A.titles_last_wins(movies, "seq"), "Title") == [("Alpha",)]


def test_odd_gender_equality_versus_suffix(spark, tmp_path):
    users = CLEAN["users.dat"] + ["8::XF::18::4::1"]
    t = dat_tables(spark, tmp_path / "odd", {"users.dat": users})
    assert rows(where_equals(t.users, "Gender", "F"), "UserID") == [("1",), ("4",)]
    assert rows(where_suffix(t.users, "Gender", "F"), "UserID") == [("1",), ("4",), ("8",)]


def test_text_id_versus_numeric_id_tie_break(spark, tmp_path):
    ratings = ["1::999::5::1000", "1::1000::5::1001"]
    movies = ["999::Nine::D", "1000::Thousand::D"]
    t = dat_tables(spark, tmp_path / "ids", {"ratings.dat": ratings, "movies.dat": movies})
    text_desc = [r["MovieID"] for r in A.top_rated_deterministic(t).collect()]
    assert text_desc == ["999", "1000"]
    numeric = avg_by(t.ratings.withColumn("MovieID", F.col("MovieID").cast("bigint")), "MovieID")
    by_number = top_k(numeric, [F.col("avg_rating").desc(), F.col("MovieID").desc()])
    assert [r["MovieID"] for r in by_number.collect()] == [1000, 999]


def test_fractional_times_order_by_time(spark, tmp_path):
    ratings = ["1::10::1::1000.2", "2::10::5::1000.7", "3::10::3::999"]
    t = dat_tables(spark, tmp_path / "frac", {"ratings.dat": ratings})
    got = [r["UserID"] for r in A.latest_reviews(t).collect()]
    assert got == ["2", "1", "3"]


def test_one_vote_movie_can_rank_first(spark, tmp_path):
    ratings = CLEAN["ratings.dat"] + ["4::40::5::1009"]
    movies = CLEAN["movies.dat"] + ["40::Delta (1993)::Drama"]
    t = dat_tables(spark, tmp_path / "one", {"ratings.dat": ratings, "movies.dat": movies})
    assert A.top_rated(t).first()["MovieID"] == "40"
