"""Hand-computed results on the clean fixture (FIXTURES.md section 2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rateweave.plans import analyses as A
from rateweave.plans import sql
from tests.conftest import rows


def test_average_by_movie(clean_tables):
    got = rows(A.avg_rating_by_movie(clean_tables))
    assert got == [("10", 4.0), ("20", 4.0), ("30", 3.5)]


def test_count_by_movie(clean_tables):
    assert rows(A.count_by_movie(clean_tables)) == [("10", 3), ("20", 2), ("30", 2)]


def test_top_rated_tie_break_both_ways(clean_tables):
    asc = [r["MovieID"] for r in A.top_rated(clean_tables).collect()]
    desc = [r["MovieID"] for r in A.top_rated_deterministic(clean_tables).collect()]
    assert asc == ["10", "20", "30"]
    assert desc == ["20", "10", "30"]


def test_most_popular(clean_tables):
    got = [(r["MovieID"], r["cnt"]) for r in A.most_popular(clean_tables).collect()]
    assert got == [("10", 3), ("20", 2), ("30", 2)]


def test_gender_averages(clean_tables):
    male = {r["MovieID"]: r["avg_rating"] for r in A.top_rated_by_gender(clean_tables, "M").collect()}
    female = {r["MovieID"]: r["avg_rating"] for r in A.top_rated_by_gender(clean_tables, "F").collect()}
    assert male == {"10": 3.5, "20": 5.0, "30": 2.0}
    assert female == {"10": 5.0, "20": 3.0, "30": 5.0}


def test_female_ranking_orders_ties_by_text_id_descending(clean_tables):
    got = [r["MovieID"] for r in A.top_rated_by_gender(clean_tables, "F", string_id_desc=True).collect()]
    assert got == ["30", "10", "20"]


def test_cohort_counts_with_titles(clean_tables):
    young = [("Alpha (1990)", 2), ("Beta (1991)", 1), ("Gamma (1992)", 1)]
    older = [("Alpha (1990)", 1), ("Beta (1991)", 1), ("Gamma (1992)", 1)]
    assert rows(A.cohort_top_titles(clean_tables, "18")) == young
    assert rows(A.cohort_top_titles(clean_tables, "25")) == older


def test_cohort_semi_form_agrees_on_clean_data(clean_tables):
    inner = rows(A.cohort_top_titles(clean_tables, "18"))
    semi = rows(A.cohort_top_movies_semi(clean_tables, "18").select("Title", "cnt"))
    assert inner == semi


def test_viewers_of_a_movie(clean_tables):
    got = rows(A.movie_viewers(clean_tables, 10), "UserID", "Gender", "Age", "OccupationName")
    assert got == [("1", "F", "18", "student"), ("2", "M", "18", "manager"), ("3", "M", "25", "student")]


def test_demographics_three_spellings(spark, clean_tables):
    want = [("F", "18", 1), ("M", "18", 1), ("M", "25", 1)]
    assert rows(A.demographics(clean_tables, 10), "Gender", "Age", "cnt") == want
    assert rows(sql.demographics_sql(spark, clean_tables, 10, scope="local"), "Gender", "Age", "cnt") == want
    assert rows(sql.demographics_sql(spark, clean_tables, 10, scope="global"), "Gender", "Age", "cnt") == want


def test_latest_reviews(clean_tables):
    got = [(r["UserID"], r["MovieID"], r["Rating"]) for r in A.latest_reviews(clean_tables).collect()]
    assert got == [
        ("4", "30", 5.0),
        ("3", "20", 5.0),
        ("3", "10", 3.0),
        ("2", "10", 4.0),
        ("2", "30", 2.0),
        ("1", "20", 3.0),
        ("1", "10", 5.0),
    ]


def test_age_band_counts_with_labels(clean_tables):
    got = rows(A.age_band_counts(clean_tables), "Age", "AgeLabel", "cnt")
    assert got == [("18", "18-24", 2), ("25", "25-34", 2)]


def test_distinct_cohort_raters(clean_tables):
    assert rows(A.cohort_raters(clean_tables, "18")) == [("1",), ("2",)]


def test_per_gender_window_equals_two_filters(clean_tables):
    per_gender = A.top_rated_per_gender(clean_tables)
    for gender in ("M", "F"):
        window = rows(per_gender.where(F.col("Gender") == gender), "MovieID", "avg_rating")
        filtered = rows(A.top_rated_by_gender(clean_tables, gender), "MovieID", "avg_rating")
        assert window == filtered
    ranks = rows(per_gender.where(F.col("Gender") == "M"), "rank", "MovieID")
    assert ranks == [(1, "20"), (2, "10"), (3, "30")]


def test_sql_spellings_leave_no_views_and_global_views_cross_sessions(spark, clean_tables):
    def views():
        return {v.name for v in spark.catalog.listTables()} | {v.name for v in spark.catalog.listTables("global_temp")}

    before = views()
    df = sql.demographics_sql(spark, clean_tables, 10, scope="global")
    local = sql.demographics_sql(spark, clean_tables, 10, scope="local")
    assert views() == before
    assert df.count() == 3 and local.count() == 3
    names = sql.register_views(spark, clean_tables, scope="global")
    other = spark.newSession()
    assert other.sql(f"SELECT count(*) AS n FROM {names['ratings']}").first()["n"] == 7
    mine = sql.register_views(spark, clean_tables, scope="local", suffix="_mine")
    assert "rw_ratings_mine" not in {v.name for v in other.catalog.listTables()}
    sql.drop_views(spark, names, "global")
    sql.drop_views(spark, mine, "local")
    assert views() == before


def test_sql_text_predicate_equals_column_predicate(clean_tables):
    from rateweave.operators import where_between_exclusive, where_equals, where_sql

    by_text = rows(where_sql(clean_tables.users, "Age = '18'"))
    assert by_text == rows(where_equals(clean_tables.users, "Age", "18"))
    assert [r[0] for r in by_text] == ["1", "2"]
    assert rows(where_between_exclusive(clean_tables.ratings, "Rating", 2, 5), "Rating") == [(3.0,), (3.0,), (4.0,)]
