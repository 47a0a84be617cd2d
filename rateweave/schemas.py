"""Schema contracts of the four relations.

``DECLARED`` holds the types the delimited files are declared with: every
field a nullable string except ``Rating``, a double.  Ids stay strings there,
so an id ordering on them is lexicographic ("999" sorts after "1000").
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, StringType, StructField, StructType


def _strings(*names: str) -> list[StructField]:
    return [StructField(n, StringType(), True) for n in names]


RATINGS = StructType(
    _strings("UserID", "MovieID")
    + [StructField("Rating", DoubleType(), True)]
    + _strings("Timestamp")
)
USERS = StructType(_strings("UserID", "Gender", "Age", "OccupationID", "Zip_Code"))
MOVIES = StructType(_strings("MovieID", "Title", "Genres"))
OCCUPATIONS = StructType(_strings("OccupationID", "OccupationName"))

DECLARED = {
    "ratings": RATINGS,
    "users": USERS,
    "movies": MOVIES,
    "occupations": OCCUPATIONS,
}


class SchemaMismatch(ValueError):
    """A frame lacks a column its contract requires."""


def conform(df: DataFrame, contract: StructType) -> DataFrame:
    """Typed view of ``df``: exactly the contract's columns, cast to its types.

    Missing columns raise; extra columns are dropped.  The casts are Spark
    casts, so under ANSI mode a value that does not fit fails the query.
    """
    present = set(df.columns)
    missing = [f.name for f in contract.fields if f.name not in present]
    if missing:
        raise SchemaMismatch(f"missing columns {missing}; have {df.columns}")
    return df.select(*[_cast(df, f.name, f.dataType) for f in contract.fields])


def _cast(df: DataFrame, name: str, dtype: DataType):
    column = F.col(name)
    if df.schema[name].dataType == dtype:
        return column
    return column.cast(dtype).alias(name)
