"""A complete ranking: every row's place, not only the first k.

A ``row_number`` over the whole table would move all rows into one task.  Here
the rows are dealt by ranges of the order and sorted in each; a row's place is
its place in the range plus the rows of the ranges before it, of which there is
one number a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateweave.session import fresh_path

_ROW_BITS = 33  # of monotonically_increasing_id: the row's number inside its partition


def ranked(df: DataFrame, order: list[Column], position: str = "position", ranges: int | None = None) -> DataFrame:
    """``df`` with every row's place (1, 2, ...) under ``order``, which must be total.

    The sorted ranges are written once to the shared folder, so that a lost
    executor can't change the bounds between two reads; an empty table has no
    places.
    """
    spark = df.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    part, row = f"_{position}_range", f"_{position}_row"
    dealt = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    numbered = dealt.select(
        "*",
        F.spark_partition_id().alias(part),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(row),
    )
    path = fresh_path(spark, "ranked")
    numbered.write.parquet(path)
    stored = spark.read.schema(numbered.schema).parquet(path)
    # One row a range.
    sizes = {r[part]: r["n"] for r in stored.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = [], 0
    for at in sorted(sizes):
        before.append((at, total))
        total += sizes[at]
    offsets = spark.createDataFrame(before, f"{part} int, _before bigint")
    placed = stored.join(F.broadcast(offsets), part)
    return placed.select(*df.columns, (F.col("_before") + F.col(row) + 1).alias(position))


def with_ties(df: DataFrame, value: str, position: str = "position", rank: str = "rank") -> DataFrame:
    """A ranking by ``value`` first: rows of equal value share the first place among them, as ``RANK()`` has it.

    One shuffle of the distinct values, each with its first place.
    """
    first = df.groupBy(F.col(value).alias("_value")).agg(F.min(position).alias(rank))
    return df.join(first, F.col(value).eqNullSafe(F.col("_value"))).select(*df.columns, rank)
