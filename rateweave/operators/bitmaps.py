"""Sets of numeric ids as bitmaps: exact distinct counts and membership that merge.

A bitmap holds 32,768 neighbouring ids in 4 KB, so a set is a few rows for each
group, however often its ids occur.  Sets of two days are united by OR, which
counting distinct ids of each day could not give.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ids of one bitmap, as Spark's functions have it.
IDS = 32_768


def _ids(df: DataFrame, col: str) -> Column:
    kind = df.schema[col].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{col} is {kind}; a bitmap needs whole numbers")
    return F.col(col).cast("bigint")


def bitmaps(df: DataFrame, id_col: str, keys: list[str] | None = None) -> DataFrame:
    """``(*keys, bucket, bits)``: for each group of ``keys`` (none: the whole table) the set of its ids; NULL is in no set."""
    own = df.where(F.col(id_col).isNotNull()).select(*(keys or []), _ids(df, id_col).alias("_id"))
    bucket = F.bitmap_bucket_number("_id").alias("bucket")
    return own.groupBy(*(keys or []), bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("bits"))


def united(sets: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The sets of coarser groups: by ``keys`` only, or one."""
    return sets.groupBy(*(keys or []), "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(sets: DataFrame, keys: list[str] | None = None, alias: str = "n") -> DataFrame:
    """Distinct ids of each group of ``keys``, from sets of these or of finer groups."""
    counted = united(sets, keys).select(*(keys or []), F.bitmap_count("bits").alias("_n"))
    return counted.groupBy(*(keys or [])).agg(F.coalesce(F.sum("_n"), F.lit(0)).alias(alias))


def _bit(bits: Column, position: Column) -> Column:
    """Whether the bit at ``position`` (0 to 32,767) is set; positions beyond the stored bytes are not."""
    byte = F.conv(F.hex(F.substr(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    power = F.pow(F.lit(2), F.pmod(position, F.lit(8))).cast("int")
    return F.coalesce(byte.bitwiseAND(power) != 0, F.lit(False))


def members(sets: DataFrame, id_col: str) -> DataFrame:
    """The ids of united sets, one row each."""
    at = F.explode(F.filter(F.sequence(F.lit(0), F.lit(IDS - 1)), lambda p: _bit(F.col("bits"), p))).alias("_at")
    found = sets.select("bucket", at)
    # Positive ids count from 1 in their bucket, the others downwards from 0.
    own = F.when(F.col("bucket") > 0, (F.col("bucket") - 1) * IDS + F.col("_at") + 1).otherwise(F.col("bucket") * IDS - F.col("_at"))
    return found.select(own.cast("bigint").alias(id_col))


def where_member(df: DataFrame, id_col: str, sets: DataFrame) -> DataFrame:
    """Rows of ``df`` whose id is in the united ``sets``: a join on the bucket, then one bit.

    A set is 4 KB for 32,768 ids, so it is broadcast (by its measured size)
    long after the list of its ids would be too large.
    """
    own = _ids(df, id_col)
    named = sets.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    found = df.join(named, F.bitmap_bucket_number(own) == F.col("_bucket"))
    return found.where(_bit(F.col("_bits"), F.bitmap_bit_position(own))).select(*df.columns)
