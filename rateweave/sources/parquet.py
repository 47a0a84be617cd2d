"""Parquet sink and source, and the one-off ``::`` to Parquet conversion.

Converting once pays the parse a single time and gives every later query a
columnar, pruned, predicate-pushed scan with size statistics the planner
can use for its join choice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from rateweave.functions.bands import AGE_LABELS, age_band
from rateweave.operators.joins import join_dimension
from rateweave.schemas import DECLARED
from rateweave.session import fresh_path
from rateweave.sources.delimited import accepted, rejected
from rateweave.sources.tables import Tables, load_dat_tables

RELATIONS = ("ratings", "users", "movies", "occupations")
# A movie's place in file order, as ``delimited.read_lines`` gives it.
MOVIE_SEQ = "seq"
SEQ_TYPE = StructType(
    [StructField("file", StringType()), StructField("block", LongType()), StructField("row", LongType())]
)


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    mode: str = "errorifexists",
    partition_by: list[str] | None = None,
    sort_within: list[str] | None = None,
) -> str:
    """Write ``df`` as Parquet; ``sort_within`` clusters rows inside each file
    (a local sort, no shuffle) so min/max statistics let later filters skip
    row groups.  An existing folder is an error unless ``mode`` says otherwise."""
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def convert_to_parquet(
    spark: SparkSession,
    base_dir: str,
    out_dir: str,
    *,
    mode: str = "strict",
    trim: bool = True,
    encoding: str = "utf-8",
    overwrite: bool = False,
    raw_ages: bool = False,
    by_band: bool = False,
) -> Tables:
    """Parse the four ``::`` files once and store them as Parquet under ``out_dir``.

    Ratings are clustered by MovieID inside each file, the key of the most
    selective lookups.  Movies keep their place in the file (``MOVIE_SEQ``),
    so that of a movie listed twice the last title wins here too.  In
    permissive mode the parsed rows go to the shared folder first and the
    rejected lines, with their reason and raw text, to ``_rejects/<relation>``
    beside the tables.  An existing ``out_dir`` is an error unless
    ``overwrite``.  Returns the tables read back from Parquet.

    With ``raw_ages`` the users file holds ages in years, which are stored as
    the band they fall in (a text that is no number: as NULL), so that no
    query needs a range of ages again.  With ``by_band`` users have a folder
    for each band, and ``ratings_by_band`` holds every rating of a known
    rater with the rater's band, a folder for each (``load_by_band``); a
    cohort then reads its own folders only.

    ``.dat`` files compressed with a non-splittable codec (gzip) are read one
    task per file; keep large inputs uncompressed or splittable.
    """
    tables = load_dat_tables(spark, base_dir, mode=mode, trim=trim, encoding=encoding, movie_seq=MOVIE_SEQ)
    out = out_dir.rstrip("/")
    written = "overwrite" if overwrite else "errorifexists"
    layout = {"ratings": ["MovieID"]}
    folders = {"users": ["Age"]} if by_band else {}
    for name in RELATIONS:
        frame = getattr(tables, name)
        if mode == "permissive":
            frame = spark.read.parquet(write_parquet(frame, fresh_path(spark, f"parsed-{name}")))
            write_parquet(rejected(frame), f"{out}/_rejects/{name}", mode=written)
            frame = accepted(frame)
        if name == "users" and raw_ages:
            frame = frame.withColumn("Age", age_band(F.col("Age").try_cast("double")))
        write_parquet(frame, f"{out}/{name}", mode=written, sort_within=layout.get(name), partition_by=folders.get(name))
    stored = load_converted(spark, out)
    if by_band:
        banded = join_dimension(stored.ratings, stored.users.select("UserID", "Age"), "UserID")
        write_parquet(banded, f"{out}/ratings_by_band", mode=written, partition_by=["Age"], sort_within=["Age", "MovieID"])
        bands = spark.createDataFrame(list(AGE_LABELS.items()), "Age string, AgeLabel string")
        write_parquet(bands.coalesce(1), f"{out}/bands", mode=written)
    return stored


def load_by_band(spark: SparkSession, out_dir: str) -> tuple[DataFrame, DataFrame]:
    """``(ratings with the rater's Age, one folder a band; the bands' codes and labels)``, as ``convert_to_parquet``
    stored them with ``by_band``."""
    out = out_dir.rstrip("/")
    ratings = StructType(DECLARED["ratings"].fields + [StructField("Age", StringType())])
    bands = spark.read.schema("Age string, AgeLabel string").parquet(f"{out}/bands")
    return spark.read.schema(ratings).parquet(f"{out}/ratings_by_band"), bands


def load_converted(spark: SparkSession, out_dir: str) -> Tables:
    """The four relations as ``convert_to_parquet`` stored them, under their
    declared schemas, movies with their ``MOVIE_SEQ``."""
    out = out_dir.rstrip("/")
    stored = {**DECLARED, "movies": StructType(DECLARED["movies"].fields + [StructField(MOVIE_SEQ, SEQ_TYPE)])}
    # A folder's column is read last; the declared order is kept.
    return Tables(*(spark.read.schema(stored[name]).parquet(f"{out}/{name}").select(stored[name].names) for name in RELATIONS))
