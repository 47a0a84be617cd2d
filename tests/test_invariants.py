"""Properties over generated ratings (hypothesis)."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rateweave import schemas
from rateweave.plans import analyses as A
from rateweave.sources.tables import Tables

rating_rows = st.lists(
    st.tuples(st.integers(1, 12), st.integers(1, 9), st.integers(1, 5), st.integers(0, 50)),
    min_size=1,
    max_size=60,
)
COMMON = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _tables(spark, data):
    ratings = spark.createDataFrame(
        [(str(u), str(m), float(r), str(ts)) for u, m, r, ts in data], schema=schemas.RATINGS
    )
    users = spark.createDataFrame(
        [(str(u), "M" if u % 2 else "F", "18" if u % 3 else "25", "1", "") for u in range(1, 13)],
        schema=schemas.USERS,
    )
    movies = spark.createDataFrame([(str(m), f"m{m}", "") for m in range(1, 10)], schema=schemas.MOVIES)
    occupations = spark.createDataFrame([("1", "x")], schema=schemas.OCCUPATIONS)
    return Tables(ratings, users, movies, occupations)


@COMMON
@given(rating_rows)
def test_counts_sum_to_rows_and_averages_stay_in_range(spark, data):
    t = _tables(spark, data)
    counts = A.count_by_movie(t).agg(F.sum("cnt")).first()[0]
    assert counts == len(data)
    bounds = t.ratings.groupBy("MovieID").agg(F.min("Rating").alias("lo"), F.max("Rating").alias("hi"))
    joined = A.avg_rating_by_movie(t).join(bounds, "MovieID")
    assert joined.where("avg_rating < lo OR avg_rating > hi").count() == 0


@COMMON
@given(rating_rows)
def test_gender_counts_add_up(spark, data):
    t = _tables(spark, data)
    by_gender = A.ratings_with_users(t).groupBy("Gender").count().collect()
    assert sum(r["count"] for r in by_gender) == len(data)


@COMMON
@given(rating_rows, st.randoms(use_true_random=False))
def test_rankings_ignore_input_order(spark, data, rnd):
    shuffled = list(data)
    rnd.shuffle(shuffled)
    a, b = _tables(spark, data), _tables(spark, shuffled)
    for query in (A.top_rated, A.most_popular, A.latest_reviews):
        assert [tuple(r) for r in query(a).collect()] == [tuple(r) for r in query(b).collect()]
    spread = Tables(b.ratings.repartition(3), b.users, b.movies, b.occupations)
    a_top = [tuple(r) for r in A.cohort_top_movies_semi(a, "18").collect()]
    assert a_top == [tuple(r) for r in A.cohort_top_movies_semi(spread, "18").collect()]


# Field texts the format can carry: no separator inside, no line breaks,
# no ':' at either end (":::" splits left to right), no JVM whitespace at
# the ends when trimming.
_field = st.text(
    alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\n\r"), max_size=12
).filter(lambda s: "::" not in s and not s.startswith(":") and not s.endswith(":"))


@COMMON
@given(st.lists(st.tuples(_field, _field, _field), min_size=1, max_size=20), st.booleans())
def test_lines_parse_back_to_their_fields(spark, records, trim):
    from rateweave.sources.delimited import parse_lines, to_lines

    if trim:
        records = [tuple(f.strip("".join(chr(c) for c in range(0x21))) for f in r) for r in records]
    frame = spark.createDataFrame(records, schema=schemas.MOVIES)
    parsed = parse_lines(to_lines(frame), schemas.MOVIES, trim=trim)
    assert sorted(tuple(r) for r in parsed.collect()) == sorted(records)
