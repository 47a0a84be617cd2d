"""

Every query reads the Parquet test tables under ``sf_dir`` through the
adapter in ``rateweave.sources.tables`` and returns a DataFrame; only the
round trips through files write theirs, under the shared folder, when they
are built.  Each oracle is the same question in DuckDB SQL over the same tables, starting
from ``PRELUDE``, which spells the adapter in SQL.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rateweave import schemas  # noqa: E402
from rateweave.operators import (  # noqa: E402
    project,
    rating_pairs,
    sample_rows,
    where_between_exclusive,
    where_equals,
    where_sql,
    where_suffix,
)
from rateweave.plans import analyses as A  # noqa: E402
from rateweave.plans import roundtrips, shared, sql  # noqa: E402
from rateweave.session import fresh_path  # noqa: E402
from rateweave.sources import colocated, rollup  # noqa: E402
from rateweave.sources.parquet import load_by_band, load_converted  # noqa: E402
from rateweave.sources.tables import Tables, load_tables  # noqa: E402
from rateweave.sources.upsert import Listing  # noqa: E402

try:
    import corpus_pipeline
    from rateweave.llm.queries import ORACLES as LLM_ORACLES
    from rateweave.llm.queries import QUERIES

    LLM_QUERIES = {**QUERIES, "pipeline": corpus_pipeline.run}
except ModuleNotFoundError as missing:  # the library works without its llm subpackage
    if not (missing.name or "").startswith(("rateweave.llm", "corpus_pipeline")):
        raise
    LLM_ORACLES, LLM_QUERIES = {}, {}

SMOKE_DIR = "/root/testdata/sf0.001"

# Parameters of the questions, in the test tables' terms: the market segment
# plays gender (BUILDING for M, MACHINERY for F) and the account-balance band
# plays the age band.
MOVIE = 1193
MALE, FEMALE = "BUILDING", "MACHINERY"
GENDER_SUFFIX = "Y"
COHORT_A, COHORT_B = "18", "25"
RATING_RANGE = (13, 18)
TITLED_GENRES = "S"
LABEL = "25-34"
NEW_DAYS = "1995-06-17"
PERIOD = ("1994-03-05", "1996-11-20")


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the ten most-rated titles among age band 18 (sf0.001)."""
    return A.cohort_top_titles(load_tables(spark, SMOKE_DIR), COHORT_A)


def _t(fn: Callable) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(spark, load_tables(spark, sf_dir))


def _second_listing(t) -> DataFrame:
    """Every movie again, its title re-entered in capitals."""
    return t.movies.withColumn("Title", F.upper("Title"))


def _doubled_movies(t) -> DataFrame:
    """Every movie listed twice, the second listing last (seq 1)."""
    first, second = t.movies, _second_listing(t)
    return first.withColumn("seq", F.lit(0)).unionByName(second.withColumn("seq", F.lit(1)))


def _listed_in_files(spark: SparkSession, t) -> DataFrame:
    """The same as two folders of text files, in file order."""
    return roundtrips.text_roundtrip(spark, [t.movies, _second_listing(t)], schemas.MOVIES, "listings", seq_col="seq")


def _titled(t) -> Tables:
    """The relations with titles of some genres only."""
    return replace(t, movies=t.movies.where(F.col("Genres").startswith(TITLED_GENRES)))


def _sampled_and_found(t) -> DataFrame:
    """How many rows an unordered sample returns, of those that are ratings."""
    sample = sample_rows(rating_pairs(t.ratings))
    keys = ["MovieID", "Rating"]
    return sample.join(t.ratings.select(*keys), keys, "left_semi").agg(F.count(F.lit(1)).alias("n"))


def _ages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers that play ages in years: the parts' sizes (1 to 50)."""
    return spark.read.schema("p_size int").parquet(f"{sf_dir.rstrip('/')}/part.parquet")


def _colocated_join(spark: SparkSession, t) -> DataFrame:
    """Ratings and users stored in buckets, then joined bucket by bucket."""
    return colocated.ratings_with_users(colocated.store_colocated(spark, t, fresh_path(spark, "colocated")), hint="merge")


def _denormalised(spark: SparkSession, t) -> DataFrame:
    return colocated.store_denormalised(spark, t, fresh_path(spark, "denormalised"))


def _denormalised_top_titles(spark: SparkSession, t) -> DataFrame:
    counted = colocated.cohort_counts(_denormalised(spark, t), COHORT_A).join(t.movies, "MovieID")
    return A.top_k(counted, [F.col("cnt").desc(), F.col("MovieID").asc()], A.DEFAULT_K).select("Title", "cnt")


def _converted(spark: SparkSession, sf_dir: str) -> str:
    """The four relations as text files, ages in years (from the account balance), converted by age band."""
    t = load_tables(spark, sf_dir)
    customers = spark.read.schema("c_custkey bigint, c_acctbal double").parquet(f"{sf_dir.rstrip('/')}/customer.parquet")
    years = customers.select(F.col("c_custkey").alias("UserID"), (F.floor(F.col("c_acctbal") / 150) + 10).alias("Age"))
    relations = {"ratings": t.ratings, "users": t.users.drop("Age").join(years, "UserID")}
    return roundtrips.converted_by_band(spark, relations | {"movies": t.movies, "occupations": t.occupations})


def _from_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.cohort_top_titles(load_converted(spark, _converted(spark, sf_dir)), COHORT_A)


def _by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _converted(spark, sf_dir)
    return A.cohort_top_titles_by_label(*load_by_band(spark, folder), load_converted(spark, folder).movies, LABEL)


def _rollup(spark: SparkSession, t) -> DataFrame:
    """State of two batches of days, and of one that comes late, added twice."""
    path, day = fresh_path(spark, "rollup"), rollup.day_of(t.ratings)
    late, old = F.col("MovieID") % 10 == 0, day < F.lit(NEW_DAYS).cast("date")
    rollup.add_batch(path, "old", t.ratings.where(old & ~late))
    rollup.add_batch(path, "new", t.ratings.where(~old & ~late))
    for _ in range(2):
        rollup.add_batch(path, "late", t.ratings.where(late))
    return rollup.state(spark, path, t.ratings.schema["MovieID"].dataType.simpleString())


def _upserted(spark: SparkSession, t) -> DataFrame:
    """The movies' titles after two newer listings, of which the older one comes last."""
    base = t.movies.select("MovieID", "Title", "Genres", F.lit(0).cast("bigint").alias("seq"))
    capitals = base.where("MovieID % 3 = 0").withColumns({"Title": F.upper("Title"), "seq": F.lit(2)})
    turned = base.where("MovieID % 5 = 0").withColumns({"Title": F.reverse("Title"), "seq": F.lit(1)})
    added = base.where("MovieID % 7 = 0").withColumn("MovieID", F.col("MovieID") + 10_000_000)
    stored = Listing(spark, fresh_path(spark, "listing"), base.schema, "MovieID", "seq")
    for newer in (base, capitals, turned.unionByName(added)):
        stored.merge(newer)
    return stored.rows().select("MovieID", "Title", "Genres")


def _two_genders(spark: SparkSession, t) -> DataFrame:
    """Both genders' top lists from one shared join (ten rows each)."""
    lists = shared.top_rated_by_genders(t, [MALE, FEMALE])
    found = [(g, r["MovieID"], r["avg_rating"]) for g, top in lists.items() for r in top]
    return spark.createDataFrame(found, "Gender string, MovieID bigint, avg_rating double")


def _null_keys(t) -> DataFrame:
    """The rating-user join where some ratings have no rater and some users no id."""
    ratings = t.ratings.withColumn("UserID", F.expr("if(MovieID % 7 = 0, NULL, UserID)"))
    users = t.users.withColumn("UserID", F.expr("if(UserID % 5 = 0, NULL, UserID)"))
    return A.ratings_with_users(replace(t, ratings=ratings, users=users))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        # sources
        "scan_delimited_movies": _t(lambda s, t: roundtrips.delimited_roundtrip(t.movies, schemas.MOVIES)),
        "scan_delimited_ratings": _t(lambda s, t: roundtrips.delimited_roundtrip(t.ratings, schemas.RATINGS)),
        "trim_cast_ratings": _t(
            lambda s, t: roundtrips.delimited_roundtrip(t.ratings, schemas.RATINGS, padding=" \t")
        ),
        "scan_text_movies": _t(lambda s, t: roundtrips.text_roundtrip(s, [t.movies], schemas.MOVIES, "movies")),
        "write_parquet_roundtrip": _t(lambda s, t: roundtrips.parquet_roundtrip(s, t.movies, "movies")),
        "typed_ratings": _t(lambda s, t: roundtrips.declared_view(t.ratings, schemas.RATINGS)),
        # projections and filters
        "project_ratings": _t(lambda s, t: project(t.ratings, "UserID", "MovieID", "Rating")),
        "filter_movie_equals": _t(lambda s, t: where_equals(t.ratings, "MovieID", MOVIE)),
        "filter_age_equals": _t(lambda s, t: where_equals(t.users, "Age", COHORT_A)),
        "filter_age_sql": _t(lambda s, t: where_sql(t.users, f"Age = '{COHORT_B}' AND OccupationID >= 10")),
        "filter_gender_suffix": _t(lambda s, t: where_suffix(t.users, "Gender", GENDER_SUFFIX)),
        "filter_range_exclusive": _t(lambda s, t: where_between_exclusive(t.ratings, "Rating", *RATING_RANGE)),
        "age_band_counts": _t(lambda s, t: A.age_band_counts(t)),
        "raw_age_bands": lambda s, d: A.raw_age_bands(_ages(s, d), "p_size"),
        # joins
        "join_users_occupations": _t(lambda s, t: A.users_with_occupations(t)),
        "join_ratings_users": _t(lambda s, t: A.ratings_with_users(t)),
        "join_ratings_users_shuffled": _t(lambda s, t: A.ratings_with_users(t, hint="merge")),
        "movie_viewers": _t(lambda s, t: A.movie_viewers(t, MOVIE)),
        # gender x age of one movie's raters: DSL, local-view SQL, global-view SQL
        "demographics_dsl": _t(lambda s, t: A.demographics(t, MOVIE)),
        "demographics_sql_local": _t(lambda s, t: sql.demographics_sql(s, t, MOVIE, scope="local")),
        "demographics_sql_global": _t(lambda s, t: sql.demographics_sql(s, t, MOVIE, scope="global")),
        # averages, counts, rankings
        "avg_rating_by_movie": _t(lambda s, t: A.avg_rating_by_movie(t)),
        "count_by_movie": _t(lambda s, t: A.count_by_movie(t)),
        "top_rated": _t(lambda s, t: A.top_rated(t)),
        "most_popular": _t(lambda s, t: A.most_popular(t)),
        "top_rated_male": _t(lambda s, t: A.top_rated_by_gender(t, MALE)),
        "top_rated_female": _t(lambda s, t: A.top_rated_by_gender(t, FEMALE, string_id_desc=True)),
        "top_rated_deterministic": _t(lambda s, t: A.top_rated_deterministic(t)),
        "top_rated_per_gender": _t(lambda s, t: A.top_rated_per_gender(t)),
        # age cohorts
        "cohort_top_titles_18": _t(lambda s, t: A.cohort_top_titles(t, COHORT_A)),
        "cohort_top_titles_25": _t(lambda s, t: A.cohort_top_titles(t, COHORT_B)),
        "cohort_top_titles_18_semi": _t(lambda s, t: A.cohort_top_movies_semi(t, COHORT_A).select("Title", "cnt")),
        "cohort_semi_join": _t(lambda s, t: A.cohort_ratings(t, COHORT_A)),
        # titles are known for some genres only, so ranked movies lack one
        "title_lookup_left": _t(lambda s, t: A.cohort_top_movies_semi(_titled(t), COHORT_B)),
        "distinct_cohort_users": _t(lambda s, t: A.cohort_raters(t, COHORT_A)),
        # dimensions, recency, sampling
        "title_last_wins": _t(lambda s, t: A.titles_last_wins(_doubled_movies(t), "seq")),
        "title_last_wins_files": _t(lambda s, t: A.titles_last_wins(_listed_in_files(s, t), "seq")),
        "latest_reviews": _t(lambda s, t: A.latest_reviews(t)),
        "sample_ratings": _t(lambda s, t: _sampled_and_found(t)),
        # stored forms: co-located, denormalised, by age band, mergeable sums, merged listings
        "join_ratings_users_colocated": _t(_colocated_join),
        "demographics_denormalised": _t(lambda s, t: colocated.demographics(_denormalised(s, t), MOVIE)),
        "cohort_top_titles_denormalised": _t(_denormalised_top_titles),
        "cohort_top_titles_from_years": _from_years,
        "cohort_top_titles_by_label": _by_label,
        "avg_rating_merged": _t(lambda s, t: rollup.averages(_rollup(s, t))),
        "avg_rating_in_period": _t(lambda s, t: rollup.averages(_rollup(s, t), *PERIOD)),
        "titles_upserted": _t(_upserted),
        # complete rankings, sets of ids, a shared join, NULL keys
        "rank_all_by_average": _t(lambda s, t: A.ranked_by_average(t)),
        "rank_all_by_count": _t(lambda s, t: A.ranked_by_count(t)),
        "distinct_cohort_users_bitmap": _t(lambda s, t: A.cohort_raters_bitmap(t, COHORT_A)),
        "cohort_semi_join_bitmap": _t(lambda s, t: A.cohort_ratings_bitmap(t, COHORT_A)),
        "raters_by_month_bitmap": _t(lambda s, t: A.raters_by_month(t.ratings)),
        "top_rated_two_genders_shared": _t(_two_genders),
        "join_null_keys": _t(lambda s, t: _null_keys(t)),
        **LLM_QUERIES,
    }


PRELUDE = """
WITH ratings AS (
  SELECT o_custkey AS UserID, l_partkey AS MovieID, l_quantity AS Rating,
         date_diff('second', TIMESTAMP '1970-01-01 00:00:00', l_shipdate) AS "Timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
users AS (
  SELECT c_custkey AS UserID, c_mktsegment AS Gender,
         CASE WHEN c_acctbal IS NULL THEN NULL WHEN c_acctbal < 0 THEN '1' WHEN c_acctbal < 1500 THEN '18' WHEN c_acctbal < 3000 THEN '25'
              WHEN c_acctbal < 4500 THEN '35' WHEN c_acctbal < 6000 THEN '45' WHEN c_acctbal < 7500 THEN '50'
              ELSE '56' END AS Age,
         c_nationkey AS OccupationID
  FROM customer),
movies AS (SELECT p_partkey AS MovieID, p_name AS Title, p_type AS Genres FROM part),
occupations AS (SELECT n_nationkey AS OccupationID, n_name AS OccupationName FROM nation)
"""

_TYPED_RATINGS = """
SELECT CAST(UserID AS VARCHAR) AS UserID, CAST(MovieID AS VARCHAR) AS MovieID, Rating,
       CAST("Timestamp" AS VARCHAR) AS "Timestamp"
FROM ratings"""

_COHORT_TOP_INNER = """
SELECT Title, cnt FROM (
  SELECT c.MovieID, m.Title, c.cnt
  FROM (SELECT r.MovieID, count(*) AS cnt FROM ratings r JOIN users u ON r.UserID = u.UserID
        WHERE u.Age = '{age}' GROUP BY r.MovieID) c
  JOIN movies m ON c.MovieID = m.MovieID
  ORDER BY c.cnt DESC, c.MovieID LIMIT 10)"""

_COHORT_TOP_SEMI = """
, top AS (
  SELECT MovieID, count(*) AS cnt FROM ratings r
  WHERE EXISTS (SELECT 1 FROM users u WHERE u.UserID = r.UserID AND u.Age = '{age}')
  GROUP BY MovieID ORDER BY cnt DESC, MovieID LIMIT 10)
SELECT {cols} FROM top LEFT JOIN movies m ON top.MovieID = m.MovieID"""

_DEMOGRAPHICS = f"""
SELECT u.Gender, u.Age, count(*) AS cnt
FROM ratings r JOIN users u ON r.UserID = u.UserID
WHERE r.MovieID = {MOVIE}
GROUP BY u.Gender, u.Age"""

_TOP_BY_GENDER = """
SELECT r.MovieID, avg(r.Rating) AS avg_rating
FROM ratings r JOIN users u ON r.UserID = u.UserID
WHERE u.Gender = '{gender}'
GROUP BY r.MovieID
ORDER BY avg_rating DESC, {tie} LIMIT 10"""

_AGE_LABEL = """CASE Age WHEN '1' THEN 'Under 18' WHEN '18' THEN '18-24' WHEN '25' THEN '25-34'
                WHEN '35' THEN '35-44' WHEN '45' THEN '45-49' WHEN '50' THEN '50-55' WHEN '56' THEN '56+' END"""

_JOINED = """
SELECT r.UserID, r.MovieID, r.Rating, u.Gender, u.Age
FROM ratings r JOIN users u ON r.UserID = u.UserID"""

_LAST_WINS = """
, listed AS (
  SELECT {id} AS MovieID, Title, 0 AS seq FROM movies
  UNION ALL
  SELECT {id} AS MovieID, upper(Title) AS Title, 1 AS seq FROM movies)
SELECT MovieID, arg_max(Title, seq) AS Title FROM listed GROUP BY MovieID"""

_BANDED_YEARS = """
, aged AS (SELECT c_custkey AS UserID, floor(c_acctbal / 150) + 10 AS years FROM customer),
banded AS (
  SELECT UserID, CASE WHEN years IS NULL THEN NULL WHEN years < 18 THEN '1' WHEN years < 25 THEN '18' WHEN years < 35 THEN '25'
              WHEN years < 45 THEN '35' WHEN years < 50 THEN '45' WHEN years < 56 THEN '50' ELSE '56' END AS Age
  FROM aged),
counted AS (
  SELECT r.MovieID, m.Title, count(*) AS cnt
  FROM ratings r JOIN banded b ON r.UserID = b.UserID JOIN movies m ON r.MovieID = m.MovieID
  WHERE b.Age = '{age}' GROUP BY r.MovieID, m.Title)
SELECT Title, cnt FROM counted ORDER BY cnt DESC, CAST(MovieID AS VARCHAR) LIMIT 10"""

_DAY = """(DATE '1970-01-01' + CAST(floor("Timestamp" / 86400) AS INTEGER))"""

_BODIES = {
    "scan_delimited_movies": "SELECT CAST(MovieID AS VARCHAR) AS MovieID, Title, Genres FROM movies",
    "scan_delimited_ratings": _TYPED_RATINGS,
    "trim_cast_ratings": _TYPED_RATINGS,
    "write_parquet_roundtrip": "SELECT MovieID, Title, Genres FROM movies",
    "scan_text_movies": "SELECT CAST(MovieID AS VARCHAR) AS MovieID, Title, Genres FROM movies",
    "typed_ratings": _TYPED_RATINGS,
    "project_ratings": "SELECT UserID, MovieID, Rating FROM ratings",
    "filter_movie_equals": f"SELECT * FROM ratings WHERE MovieID = {MOVIE}",
    "filter_age_equals": f"SELECT * FROM users WHERE Age = '{COHORT_A}'",
    "filter_age_sql": f"SELECT * FROM users WHERE Age = '{COHORT_B}' AND OccupationID >= 10",
    "filter_gender_suffix": f"SELECT * FROM users WHERE Gender LIKE '%{GENDER_SUFFIX}'",
    "filter_range_exclusive": (
        f"SELECT * FROM ratings WHERE Rating > {RATING_RANGE[0]} AND Rating < {RATING_RANGE[1]}"
    ),
    "age_band_counts": f"SELECT Age, {_AGE_LABEL} AS AgeLabel, count(*) AS cnt FROM users GROUP BY Age",
    "raw_age_bands": f"""
, banded AS (
  SELECT CASE WHEN p_size IS NULL THEN NULL WHEN p_size < 18 THEN '1' WHEN p_size < 25 THEN '18' WHEN p_size < 35 THEN '25'
              WHEN p_size < 45 THEN '35' WHEN p_size < 50 THEN '45' WHEN p_size < 56 THEN '50' ELSE '56' END AS Age
  FROM part)
SELECT Age, {_AGE_LABEL} AS AgeLabel, count(*) AS cnt FROM banded GROUP BY Age""",
    "join_users_occupations": """
SELECT u.UserID, u.Gender, u.Age, u.OccupationID, o.OccupationName
FROM users u JOIN occupations o ON u.OccupationID = o.OccupationID""",
    "join_ratings_users": _JOINED,
    "join_ratings_users_shuffled": _JOINED,
    "movie_viewers": f"""
SELECT u.UserID, u.Gender, u.Age, o.OccupationName
FROM ratings r JOIN users u ON r.UserID = u.UserID
JOIN occupations o ON u.OccupationID = o.OccupationID
WHERE r.MovieID = {MOVIE}""",
    "demographics_dsl": _DEMOGRAPHICS,
    "demographics_sql_local": _DEMOGRAPHICS,
    "demographics_sql_global": _DEMOGRAPHICS,
    "avg_rating_by_movie": "SELECT MovieID, avg(Rating) AS avg_rating FROM ratings GROUP BY MovieID",
    "count_by_movie": "SELECT MovieID, count(*) AS cnt FROM ratings GROUP BY MovieID",
    "top_rated": """
SELECT MovieID, avg(Rating) AS avg_rating FROM ratings GROUP BY MovieID
ORDER BY avg_rating DESC, MovieID LIMIT 10""",
    "most_popular": """
SELECT MovieID, count(*) AS cnt FROM ratings GROUP BY MovieID
ORDER BY cnt DESC, MovieID LIMIT 10""",
    "top_rated_male": _TOP_BY_GENDER.format(gender=MALE, tie="r.MovieID"),
    "top_rated_female": _TOP_BY_GENDER.format(gender=FEMALE, tie="CAST(r.MovieID AS VARCHAR) DESC"),
    "top_rated_deterministic": """
SELECT MovieID, avg(Rating) AS avg_rating FROM ratings GROUP BY MovieID
ORDER BY avg_rating DESC, CAST(MovieID AS VARCHAR) DESC LIMIT 10""",
    "top_rated_per_gender": """
, averages AS (
  SELECT u.Gender, r.MovieID, avg(r.Rating) AS avg_rating
  FROM ratings r JOIN users u ON r.UserID = u.UserID
  GROUP BY u.Gender, r.MovieID)
SELECT Gender, MovieID, avg_rating, "rank" FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY Gender ORDER BY avg_rating DESC, MovieID) AS INTEGER) AS "rank"
  FROM averages)
WHERE "rank" <= 10""",
    "cohort_top_titles_18": _COHORT_TOP_INNER.format(age=COHORT_A),
    "cohort_top_titles_25": _COHORT_TOP_INNER.format(age=COHORT_B),
    "cohort_top_titles_18_semi": _COHORT_TOP_SEMI.format(age=COHORT_A, cols="m.Title, top.cnt"),
    "cohort_semi_join": f"SELECT * FROM ratings WHERE UserID IN (SELECT UserID FROM users WHERE Age = '{COHORT_A}')",
    "title_lookup_left": _COHORT_TOP_SEMI.format(age=COHORT_B, cols="top.MovieID, top.cnt, m.Title").replace(
        "LEFT JOIN movies m", f"LEFT JOIN (SELECT * FROM movies WHERE Genres LIKE '{TITLED_GENRES}%') m"
    ),
    "distinct_cohort_users": (
        f"SELECT DISTINCT r.UserID FROM ratings r JOIN users u ON r.UserID = u.UserID WHERE u.Age = '{COHORT_A}'"
    ),
    "title_last_wins": _LAST_WINS.format(id="MovieID"),
    "title_last_wins_files": _LAST_WINS.format(id="CAST(MovieID AS VARCHAR)"),
    "latest_reviews": """
SELECT UserID, MovieID, Rating, "Timestamp" FROM ratings
ORDER BY "Timestamp" DESC, Rating DESC, UserID, MovieID LIMIT 10""",
    "sample_ratings": "SELECT least(10, count(*)) AS n FROM ratings",
    "join_ratings_users_colocated": _JOINED,
    "demographics_denormalised": _DEMOGRAPHICS,
    "cohort_top_titles_denormalised": _COHORT_TOP_INNER.format(age=COHORT_A),
    "cohort_top_titles_from_years": _BANDED_YEARS.format(age=COHORT_A),
    "cohort_top_titles_by_label": _BANDED_YEARS.format(age="25"),
    "avg_rating_merged": "SELECT MovieID, avg(Rating) AS avg_rating FROM ratings GROUP BY MovieID",
    "avg_rating_in_period": f"""
SELECT MovieID, avg(Rating) AS avg_rating FROM ratings
WHERE {_DAY} BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}' GROUP BY MovieID""",
    "titles_upserted": """
, listed AS (
  SELECT MovieID, Title, Genres, 0 AS seq FROM movies
  UNION ALL SELECT MovieID, upper(Title), Genres, 2 FROM movies WHERE MovieID % 3 = 0
  UNION ALL SELECT MovieID, reverse(Title), Genres, 1 FROM movies WHERE MovieID % 5 = 0
  UNION ALL SELECT MovieID + 10000000, Title, Genres, 0 FROM movies WHERE MovieID % 7 = 0)
SELECT MovieID, arg_max(Title, seq) AS Title, arg_max(Genres, seq) AS Genres FROM listed GROUP BY MovieID""",
    "rank_all_by_average": """
, averages AS (SELECT MovieID, avg(Rating) AS avg_rating FROM ratings GROUP BY MovieID)
SELECT MovieID, avg_rating, row_number() OVER (ORDER BY avg_rating DESC NULLS LAST, MovieID) AS position FROM averages""",
    "rank_all_by_count": """
, counts AS (SELECT MovieID, count(*) AS cnt FROM ratings GROUP BY MovieID)
SELECT MovieID, cnt, row_number() OVER (ORDER BY cnt DESC, MovieID) AS position, rank() OVER (ORDER BY cnt DESC) AS "rank" FROM counts""",
    "distinct_cohort_users_bitmap": (
        f"SELECT DISTINCT r.UserID FROM ratings r JOIN users u ON r.UserID = u.UserID WHERE u.Age = '{COHORT_A}'"
    ),
    "cohort_semi_join_bitmap": f"SELECT * FROM ratings WHERE UserID IN (SELECT UserID FROM users WHERE Age = '{COHORT_A}')",
    "raters_by_month_bitmap": f"""
SELECT strftime({_DAY}, '%Y-%m') AS month, count(DISTINCT UserID) AS raters FROM ratings GROUP BY 1
UNION ALL SELECT 'all', count(DISTINCT UserID) FROM ratings""",
    "top_rated_two_genders_shared": f"""
, averages AS (
  SELECT u.Gender, r.MovieID, avg(r.Rating) AS avg_rating
  FROM ratings r JOIN users u ON r.UserID = u.UserID WHERE u.Gender IN ('{MALE}', '{FEMALE}')
  GROUP BY u.Gender, r.MovieID)
SELECT Gender, MovieID, avg_rating FROM averages
QUALIFY row_number() OVER (PARTITION BY Gender ORDER BY avg_rating DESC, MovieID) <= 10""",
    "join_null_keys": """
SELECT r.UserID, r.MovieID, r.Rating, u.Gender, u.Age
FROM ratings r JOIN users u ON r.UserID = u.UserID
WHERE r.MovieID % 7 <> 0 AND u.UserID % 5 <> 0""",
}


def oracle_sql() -> dict[str, str]:
    # A body that starts with "," continues the prelude's WITH list.
    return {key: PRELUDE.strip() + "\n" + body.strip() for key, body in _BODIES.items()} | LLM_ORACLES
