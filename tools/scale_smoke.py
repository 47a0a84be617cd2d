"""Run the analyses on a generated skewed dataset larger than the test tables.

    python tools/scale_smoke.py [n_ratings] [n_users] [n_movies]

One user holds a third of all ratings and one movie a tenth.  Size-based
broadcast is off, so user joins take the shuffle path, as with a users table
far above the threshold.  Prints seconds per analysis and whether the
hot-user join was split by adaptive execution.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from rateweave.functions.bands import AGE_BAND_CODES  # noqa: E402
from rateweave.plans import analyses as A  # noqa: E402
from rateweave.plans import plan_text  # noqa: E402
from rateweave.session import build_session  # noqa: E402
from rateweave.sources.tables import Tables  # noqa: E402


def generate(spark, n: int, users: int, movies: int) -> Tables:
    rid = F.col("id")
    ratings = spark.range(n).select(
        F.when(rid % 3 == 0, F.lit(0)).otherwise(F.pmod(F.xxhash64(rid, F.lit(1)), F.lit(users))).alias("UserID"),
        F.when(rid % 10 == 1, F.lit(1193)).otherwise(F.pmod(F.xxhash64(rid, F.lit(2)), F.lit(movies))).alias("MovieID"),
        (F.pmod(F.xxhash64(rid, F.lit(3)), F.lit(5)) + 1).cast("double").alias("Rating"),
        (F.lit(956_703_932) + F.pmod(F.xxhash64(rid, F.lit(4)), F.lit(90_000_000))).alias("Timestamp"),
    )
    codes = F.array(*[F.lit(c) for c in AGE_BAND_CODES])
    people = spark.range(users).select(
        F.col("id").alias("UserID"),
        F.when(F.col("id") % 2 == 0, "M").otherwise("F").alias("Gender"),
        F.element_at(codes, (F.col("id") % len(AGE_BAND_CODES) + 1).cast("int")).alias("Age"),
        (F.col("id") % 21).cast("int").alias("OccupationID"),
    )
    titles = spark.range(movies).select(F.col("id").alias("MovieID"), F.concat(F.lit("movie "), F.col("id")).alias("Title"))
    occupations = spark.range(21).select(F.col("id").cast("int").alias("OccupationID"), F.lit("job").alias("OccupationName"))
    return Tables(ratings, people, titles, occupations)


def main(argv: list[str]) -> int:
    n = int(argv[0]) if argv else 30_000_000
    users = int(argv[1]) if len(argv) > 1 else 1_000_000
    movies = int(argv[2]) if len(argv) > 2 else 100_000
    spark = build_session(
        "local[8]",
        shuffle_partitions=64,
        extra={
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.driver.memory": "8g",
        },
    )
    t = generate(spark, n, users, movies)
    analyses = {
        "top_rated": lambda: A.top_rated(t),
        "most_popular": lambda: A.most_popular(t),
        "top_rated_male": lambda: A.top_rated_by_gender(t, "M"),
        "top_rated_per_gender": lambda: A.top_rated_per_gender(t),
        "cohort_top_titles_18": lambda: A.cohort_top_titles(t, "18"),
        "cohort_top_movies_semi_18": lambda: A.cohort_top_movies_semi(t, "18"),
        "demographics_1193": lambda: A.demographics(t, 1193),
        "latest_reviews": lambda: A.latest_reviews(t),
    }
    for name, build in analyses.items():
        start = time.perf_counter()
        df = build()
        rows = df.collect()
        took = time.perf_counter() - start
        split = "adaptive skew split" if "skew=true" in plan_text(df) else ""
        print(f"{name:28s} {took:7.2f}s rows={len(rows):3d} {split}")
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
