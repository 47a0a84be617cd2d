"""The four relations, from delimited files or from the Parquet test tables.

``load_tables`` adapts the TPC-H-shaped test tables:

=============  ==============================================================
ratings        lineitem join orders: o_custkey UserID, l_partkey MovieID,
               l_quantity Rating, l_shipdate as epoch seconds Timestamp
users          customer: c_custkey UserID, c_mktsegment Gender, band of
               c_acctbal Age, c_nationkey OccupationID
movies         part: p_partkey MovieID, p_name Title, p_type Genres
occupations    nation: n_nationkey OccupationID, n_name OccupationName
=============  ==============================================================

Every relation is a lazy projection over a Parquet scan, so each query
reads only the columns it uses and its filters reach the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rateweave import schemas
from rateweave.functions.bands import acctbal_band
from rateweave.sources.delimited import accepted, read_delimited


@dataclass(frozen=True)
class Tables:
    ratings: DataFrame
    users: DataFrame
    movies: DataFrame
    occupations: DataFrame


# The columns the adapter reads, with their Parquet types.  Declaring them
# skips schema inference (a footer read on the driver per table) and makes a
# changed type fail loudly at the scan instead of deep inside a query.
SOURCE_COLUMNS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_type string",
    "nation": "n_nationkey int, n_name string",
}


def epoch_seconds(ts):
    """Whole seconds since 1970 of a zone-less timestamp (review times are
    epoch seconds in the rating data); independent of the session time zone."""
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts)


def load_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The four relations over the Parquet test tables in ``sf_dir`` (lazy)."""
    base = sf_dir.rstrip("/")

    def read(name: str) -> DataFrame:
        return spark.read.schema(StructType.fromDDL(SOURCE_COLUMNS[name])).parquet(f"{base}/{name}.parquet")

    lineitem, orders = read("lineitem"), read("orders")
    # An inner equi-join on the order key, planned by size: broadcast while
    # orders is measured small, else a sort-merge join whose hot keys, if
    # any, adaptive execution splits.
    ratings = lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("UserID"),
        F.col("l_partkey").alias("MovieID"),
        F.col("l_quantity").alias("Rating"),
        epoch_seconds(F.col("l_shipdate")).alias("Timestamp"),
    )
    users = read("customer").select(
        F.col("c_custkey").alias("UserID"),
        F.col("c_mktsegment").alias("Gender"),
        acctbal_band(F.col("c_acctbal")).alias("Age"),
        F.col("c_nationkey").alias("OccupationID"),
    )
    movies = read("part").select(
        F.col("p_partkey").alias("MovieID"),
        F.col("p_name").alias("Title"),
        F.col("p_type").alias("Genres"),
    )
    occupations = read("nation").select(
        F.col("n_nationkey").alias("OccupationID"),
        F.col("n_name").alias("OccupationName"),
    )
    return Tables(ratings, users, movies, occupations)


# --- fixed values: the dataset's file names.
DAT_FILES = {
    "ratings": "ratings.dat",
    "users": "users.dat",
    "movies": "movies.dat",
    "occupations": "occupations.dat",
}
# --- end of fixed values.


def load_dat_tables(
    spark: SparkSession,
    base_dir: str,
    *,
    mode: str = "strict",
    trim: bool = True,
    encoding: str = "utf-8",
    movie_seq: str | None = None,
) -> Tables:
    """The four ``::`` files under ``base_dir`` (any Hadoop file system URI).

    In permissive mode the frames carry ``_reject`` and ``_line``; pass them through
    ``delimited.accepted`` before querying.  ``movie_seq`` names a file-order
    column on movies, for last-one-wins title lookups.
    """
    base = base_dir.rstrip("/")
    frames = {}
    for name, file_name in DAT_FILES.items():
        frames[name] = read_delimited(
            spark,
            f"{base}/{file_name}",
            schemas.DECLARED[name],
            mode=mode,
            trim=trim,
            encoding=encoding,
            seq_col=movie_seq if name == "movies" else None,
        )
    return Tables(**frames)


def accepted_tables(t: Tables) -> Tables:
    """The good rows of permissively loaded tables (``_reject`` and ``_line`` removed)."""
    return Tables(*(accepted(getattr(t, name)) for name in DAT_FILES))
