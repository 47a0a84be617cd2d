"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# The JVM's String.trim strips every character up to U+0020 (space, tab, CR,
# LF, other controls); Spark's one-argument trim strips spaces only.
JVM_WHITESPACE = "".join(chr(code) for code in range(0x21))
COMMON_WHITESPACE = " \t\r\n"


def _trimmed_where_needed(column: Column, characters: str) -> Column:
    """``column`` without ``characters`` at its edges; a field that neither
    starts nor ends with a character up to U+0020 is left alone, which is
    cheaper to see than a trim over the set."""
    edge = F.least(F.ascii(column), F.ascii(F.substring(column, -1, 1)))
    return F.when(edge > F.lit(0x20), column).otherwise(F.btrim(column, F.lit(characters)))


def trim_common(column: Column) -> Column:
    """The first step of a JVM trim: the usual white space, by a short set."""
    return _trimmed_where_needed(column, COMMON_WHITESPACE)


def trim_rest(column: Column) -> Column:
    """The second step: what is left of the whole set, for the rare field that still has some."""
    return _trimmed_where_needed(column, JVM_WHITESPACE)


def jvm_trim(column: Column) -> Column:
    """JVM trim in one expression (the parser runs its two steps one after the other)."""
    return _trimmed_where_needed(column, JVM_WHITESPACE)


def literal_like(value, dtype: DataType) -> Column:
    """``value`` as a literal of the column's own type.

    Comparing a string id column with an int literal makes Spark cast the
    column, which fails the whole query on one non-numeric id under ANSI.
    Casting the literal instead keeps the comparison in the column's type.
    """
    return F.lit(str(value) if dtype.typeName() == "string" else value).cast(dtype)
