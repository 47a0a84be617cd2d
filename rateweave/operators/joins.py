"""Joins: dimension joins, semi-joins and late title lookups.

Every join is one plain equi-join.  Its physical form is Spark's choice: a
side is broadcast when its measured bytes are under the session's threshold
(at planning, or at run time once adaptive execution knows the filtered
size); otherwise both sides are shuffled, and a partition that a hot key has
blown up, a hot NULL key of an outer join included, is split by the adaptive
skew join.  Only a side that is small by construction (the ids of a top-k) is
hinted for broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_dimension(fact: DataFrame, dim: DataFrame, on: str, how: str = "inner", *, hint: str | None = None) -> DataFrame:
    """``fact`` joined with a dimension on a shared key column (one key column out).

    ``hint`` names a join strategy for ``dim`` (such as ``merge``) where a
    caller must not leave the choice to Spark.
    """
    return fact.join(dim.hint(hint) if hint else dim, on, how)


def semi_join(fact: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``fact`` whose ``key`` occurs in ``keys`` (set membership).

    A key listed twice still lets its rows through once, unlike an inner
    join, which would repeat them.
    """
    return fact.join(keys.select(key), key, "left_semi")


def lookup_after_top(top: DataFrame, dim: DataFrame, key: str, value: str, *, seq: str | None = None) -> DataFrame:
    """Attach ``value`` from ``dim`` to the rows of a top-k, NULL when absent.

    ``top`` is a top-k, a report of a few rows, so its ids are broadcast to
    cut ``dim`` down to the rows wanted (the dimension is scanned but never
    shuffled), and the chosen values, one per id, are broadcast back.  Among
    duplicate keys in ``dim`` the row with the highest ``seq`` wins (file
    order: the last one), else the greatest value.
    """
    candidates = dim.join(F.broadcast(top.select(key)), key, "left_semi")
    order: Column = F.struct(F.col(seq), F.col(value)) if seq else F.col(value)
    chosen = candidates.groupBy(key).agg(F.max_by(F.col(value), order).alias(value))
    return top.join(F.broadcast(chosen), key, "left")
