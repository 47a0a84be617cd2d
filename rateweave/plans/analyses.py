"""The analyses a user of the rating data asks for, as lazy DataFrame plans.

Each function takes the four relations (``Tables``) and parameters and
returns an unexecuted DataFrame.  Every ranking carries an explicit
tie-break; every aggregate is aliased.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.functions.bands import age_band, age_label
from rateweave.functions.ordering import as_string_id
from rateweave.operators.aggregates import avg_by, count_by, distinct_values, last_wins
from rateweave.operators.bitmaps import bitmaps, distinct_counts, members, where_member
from rateweave.operators.filters import where_equals, where_suffix
from rateweave.operators.joins import join_dimension, lookup_after_top, semi_join
from rateweave.operators.ranking import ranked, with_ties
from rateweave.operators.topk import latest, top_k, top_k_per_group
from rateweave.sources.rollup import day_of
from rateweave.sources.tables import Tables

DEFAULT_MOVIE = 1193
DEFAULT_K = 10


def _gender_users(users: DataFrame, gender: str, suffix: bool) -> DataFrame:
    picked = where_suffix(users, "Gender", gender) if suffix else where_equals(users, "Gender", gender)
    return picked.select("UserID")


def _cohort_users(users: DataFrame, age: str) -> DataFrame:
    return where_equals(users, "Age", age).select("UserID")


# --- joins -----------------------------------------------------------------


def ratings_with_users(t: Tables, hint: str | None = None) -> DataFrame:
    """Every rating with its rater's gender and age band (inner join).

    ``hint`` forces a join strategy, such as ``merge`` for the shuffle form
    that a users table beyond any broadcast takes.
    """
    profiles = t.users.select("UserID", "Gender", "Age")
    rated = join_dimension(t.ratings, profiles, "UserID", hint=hint)
    return rated.select("UserID", "MovieID", "Rating", "Gender", "Age")


def users_with_occupations(t: Tables) -> DataFrame:
    """Every user with the name of their occupation."""
    return join_dimension(t.users, t.occupations, "OccupationID")


def movie_viewers(t: Tables, movie=DEFAULT_MOVIE) -> DataFrame:
    """Profile (gender, age band, occupation) of everyone who rated ``movie``.

    The movie filter reaches the ratings scan, and only the columns of the
    answer are read.  One movie may hold a large share of all ratings, so
    its raters are never assumed small.
    """
    raters = where_equals(t.ratings, "MovieID", movie).select("UserID")
    people = t.users.select("UserID", "Gender", "Age", "OccupationID")
    profiles = join_dimension(raters, people, "UserID")
    named = join_dimension(profiles, t.occupations, "OccupationID")
    return named.select("UserID", "Gender", "Age", "OccupationName")


def demographics(t: Tables, movie=DEFAULT_MOVIE) -> DataFrame:
    """Head-count of the raters of ``movie`` by gender and age band."""
    raters = where_equals(t.ratings, "MovieID", movie).select("UserID")
    profiles = t.users.select("UserID", "Gender", "Age")
    rated = join_dimension(raters, profiles, "UserID")
    return count_by(rated, ["Gender", "Age"])


# --- averages and counts ---------------------------------------------------


def avg_rating_by_movie(t: Tables) -> DataFrame:
    return avg_by(t.ratings, "MovieID")


def count_by_movie(t: Tables) -> DataFrame:
    return count_by(t.ratings, "MovieID")


def top_rated(t: Tables, k: int = DEFAULT_K) -> DataFrame:
    """Best average rating, ties by MovieID ascending."""
    return top_k(avg_rating_by_movie(t), [F.col("avg_rating").desc(), F.col("MovieID").asc()], k)


def top_rated_deterministic(t: Tables, k: int = DEFAULT_K) -> DataFrame:
    """Best average rating, ties by MovieID as text, descending ("999" before "1000")."""
    return top_k(avg_rating_by_movie(t), [F.col("avg_rating").desc(), as_string_id("MovieID").desc()], k)


def most_popular(t: Tables, k: int = DEFAULT_K) -> DataFrame:
    """Most ratings, ties by MovieID ascending."""
    return top_k(count_by_movie(t), [F.col("cnt").desc(), F.col("MovieID").asc()], k)


def top_rated_by_gender(
    t: Tables,
    gender: str,
    k: int = DEFAULT_K,
    *,
    suffix: bool = False,
    string_id_desc: bool = False,
) -> DataFrame:
    """Best average among ratings by one gender.

    ``suffix`` matches the gender code as a suffix instead of exactly;
    ``string_id_desc`` breaks ties by MovieID as text descending instead of
    by MovieID ascending.
    """
    raters = _gender_users(t.users, gender, suffix)
    rated = join_dimension(t.ratings, raters, "UserID")
    tie = as_string_id("MovieID").desc() if string_id_desc else F.col("MovieID").asc()
    return top_k(avg_by(rated, "MovieID"), [F.col("avg_rating").desc(), tie], k)


def top_rated_per_gender(t: Tables, k: int = DEFAULT_K) -> DataFrame:
    """The same ranking for every gender at once: one pass, one top-k per group."""
    genders = t.users.select("UserID", "Gender")
    rated = join_dimension(t.ratings, genders, "UserID")
    averages = avg_by(rated, ["Gender", "MovieID"])
    ranked = top_k_per_group(averages, "Gender", [F.col("avg_rating").desc(), F.col("MovieID").asc()], k)
    return ranked.select("Gender", "MovieID", "avg_rating", F.col("rank").cast("int").alias("rank"))


# --- age cohorts -----------------------------------------------------------


def cohort_top_titles(
    t: Tables, age: str, k: int = DEFAULT_K
) -> DataFrame:
    """Most-rated titles in an age band: count per movie, then the titles.

    Inner joins throughout, so a user listed twice counts twice and a movie
    without a title drops out before the cut.  Counting first means the
    title join sees one row per movie, not one per rating.
    """
    cohort = _cohort_users(t.users, age)
    rated = join_dimension(t.ratings, cohort, "UserID")
    counted = count_by(rated, "MovieID").join(t.movies, "MovieID")
    return top_k(counted, [F.col("cnt").desc(), F.col("MovieID").asc()], k).select("Title", "cnt")


def cohort_top_movies_semi(
    t: Tables,
    age: str,
    k: int = DEFAULT_K,
    *,
    seq: str | None = None,
) -> DataFrame:
    """Most-rated movies in an age band by set membership, titles looked up last.

    A user listed twice counts once; a movie without a title keeps its rank
    with a NULL title; a movie listed twice shows one title, the last one in
    file order when ``seq`` is given.  Returns MovieID, cnt, Title.
    """
    rated = semi_join(t.ratings, _cohort_users(t.users, age), "UserID")
    top = top_k(count_by(rated, "MovieID"), [F.col("cnt").desc(), F.col("MovieID").asc()], k)
    return lookup_after_top(top, t.movies, "MovieID", "Title", seq=seq).select("MovieID", "cnt", "Title")


def cohort_top_titles_by_label(
    banded: DataFrame, bands: DataFrame, movies: DataFrame, label: str, k: int = DEFAULT_K
) -> DataFrame:
    """Most-rated titles in the age band of a label, from ratings stored by band.

    The label chooses the band's code at run time, and only that folder of
    the ratings is scanned (dynamic partition pruning); nobody is joined.
    ``bands`` has one row a band, seven of them.
    """
    wanted = F.broadcast(bands.where(F.col("AgeLabel") == F.lit(label)).select("Age"))
    counted = count_by(banded.join(wanted, "Age"), "MovieID").join(movies, "MovieID")
    return top_k(counted, [F.col("cnt").desc(), F.col("MovieID").asc()], k).select("Title", "cnt")


def cohort_ratings(t: Tables, age: str) -> DataFrame:
    """Ratings given by the users of one age band."""
    return semi_join(t.ratings, _cohort_users(t.users, age), "UserID")


def cohort_raters(t: Tables, age: str) -> DataFrame:
    """The set of user ids of one age band that have rated anything."""
    return distinct_values(cohort_ratings(t, age), "UserID")


def age_band_counts(t: Tables) -> DataFrame:
    """Users per age band, with the band's label."""
    return count_by(t.users, "Age").select("Age", age_label(F.col("Age")).alias("AgeLabel"), "cnt")


def raw_age_bands(people: DataFrame, years: str) -> DataFrame:
    """Rows per age band, from ages in whole years (NULL ages are a band of their own: NULL)."""
    banded = people.select(age_band(F.col(years)).alias("Age"))
    return count_by(banded, "Age").select("Age", age_label(F.col("Age")).alias("AgeLabel"), "cnt")


# --- complete rankings and sets of ids ---------------------------------------


def ranked_by_average(t: Tables) -> DataFrame:
    """Every movie with its place by average rating, ties by MovieID ascending."""
    return ranked(avg_rating_by_movie(t), [F.col("avg_rating").desc_nulls_last(), F.col("MovieID").asc()])


def ranked_by_count(t: Tables) -> DataFrame:
    """Every movie with its place by number of ratings, and the place that equal numbers share."""
    return with_ties(ranked(count_by_movie(t), [F.col("cnt").desc(), F.col("MovieID").asc()]), "cnt")


def cohort_raters_bitmap(t: Tables, age: str) -> DataFrame:
    """The set of user ids of one age band that have rated anything, through bitmaps."""
    return members(bitmaps(cohort_ratings(t, age), "UserID"), "UserID")


def cohort_ratings_bitmap(t: Tables, age: str) -> DataFrame:
    """Ratings given by the users of one age band, by a bitmap of the cohort."""
    return where_member(t.ratings, "UserID", bitmaps(_cohort_users(t.users, age), "UserID"))


def raters_by_month(ratings: DataFrame) -> DataFrame:
    """Distinct raters of each month and, from the same sets, of the whole time (month ``all``)."""
    sets = bitmaps(ratings.select(F.date_format(day_of(ratings), "yyyy-MM").alias("month"), "UserID"), "UserID", ["month"])
    whole = distinct_counts(sets, alias="raters").select(F.lit("all").alias("month"), "raters")
    return distinct_counts(sets, ["month"], alias="raters").unionByName(whole)


# --- dimensions and recency ------------------------------------------------


def titles_last_wins(movies: DataFrame, seq: str) -> DataFrame:
    """One title per MovieID: the one listed last."""
    return last_wins(movies, "MovieID", "Title", seq)


def latest_reviews(t: Tables, k: int = DEFAULT_K) -> DataFrame:
    """The ``k`` most recent ratings, newest first, higher rating first at equal times."""
    return latest(t.ratings, k).select("UserID", "MovieID", "Rating", "Timestamp")
