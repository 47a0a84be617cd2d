"""Grouped aggregates.

All of them are declarative aggregates, so Spark runs them in two phases: a
partial aggregate inside each map task (the ``reduceByKey`` combine), then
the final one after the shuffle.  A hot key therefore ships one partial row
per task, not its raw rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _as_list(cols: str | list[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def avg_by(df: DataFrame, keys: str | list[str], value: str = "Rating", alias: str = "avg_rating") -> DataFrame:
    """Mean of ``value`` per key, as sum over count (no minimum-vote rule)."""
    return df.groupBy(*_as_list(keys)).agg(F.avg(F.col(value)).alias(alias))


def count_by(df: DataFrame, keys: str | list[str], alias: str = "cnt") -> DataFrame:
    """Rows per key, as a bigint."""
    return df.groupBy(*_as_list(keys)).agg(F.count(F.lit(1)).alias(alias))


def distinct_values(df: DataFrame, cols: str | list[str]) -> DataFrame:
    """The set of values (de-duplicated in each task before the shuffle)."""
    return df.select(*_as_list(cols)).distinct()


def last_wins(df: DataFrame, key: str, values: str | list[str], seq: str) -> DataFrame:
    """One row per ``key``: the values of its row with the highest ``seq``."""
    values = _as_list(values)
    picked = F.max_by(F.struct(*[F.col(v) for v in values]), F.col(seq)).alias("_picked")
    return df.groupBy(key).agg(picked).select(key, *[F.col(f"_picked.{v}").alias(v) for v in values])
