"""Row filters.  Written as Column predicates so they reach the Parquet scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateweave.functions.strings import literal_like


def where_equals(df: DataFrame, col: str, value) -> DataFrame:
    """``col = value`` with the literal cast to the column's type."""
    return df.where(F.col(col) == literal_like(value, df.schema[col].dataType))


def where_suffix(df: DataFrame, col: str, suffix: str) -> DataFrame:
    """``col`` ends with ``suffix`` (``XF`` passes a suffix test for ``F``)."""
    return df.where(F.col(col).endswith(F.lit(suffix)))


def where_between_exclusive(df: DataFrame, col: str, low, high) -> DataFrame:
    """``low < col < high``, both ends excluded."""
    return df.where((F.col(col) > F.lit(low)) & (F.col(col) < F.lit(high)))


def where_sql(df: DataFrame, predicate: str) -> DataFrame:
    """A predicate in SQL text, e.g. ``"Age = '18'"``."""
    return df.where(predicate)
