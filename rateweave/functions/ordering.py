"""Sort keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_string_id(name: str) -> Column:
    """An id compared as text, as the declared string ids compare."""
    return F.col(name).cast("string")


def time_sort_key(df: DataFrame, name: str) -> Column:
    """Order key for a review time.

    Delimited input carries epoch seconds as text, which must sort as a
    number ("999" < "1000"), and a text that is no number as no time at all
    (last in a descending order); typed input sorts as it is.
    """
    if df.schema[name].dataType.typeName() == "string":
        return F.col(name).try_cast("double")
    return F.col(name)
