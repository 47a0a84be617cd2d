"""Age bands: derive the band code once in ETL instead of range filters later.

The users file already carries a band code.  ``age_band`` turns raw ages in
years into that code; ``acctbal_band`` is the same rule over the account
balance that stands in for age in the test tables.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: band codes and their labels, as the dataset defines them.
AGE_BAND_CODES = ["1", "18", "25", "35", "45", "50", "56"]
AGE_LABELS = {
    "1": "Under 18",
    "18": "18-24",
    "25": "25-34",
    "35": "35-44",
    "45": "45-49",
    "50": "50-55",
    "56": "56+",
}
# Exclusive upper bound of every band but the last, in years.
AGE_BAND_UPPERS_YEARS = [18, 25, 35, 45, 50, 56]
# Exclusive upper bound of every band but the last, over c_acctbal (test data).
ACCTBAL_BAND_UPPERS = [0, 1500, 3000, 4500, 6000, 7500]
# --- end of fixed values.


def bucketize(value: Column, uppers: list[float], codes: list[str]) -> Column:
    """Code of the first band whose exclusive upper bound exceeds ``value``.

    ``codes`` has one more entry than ``uppers``: the open top band.  A NULL
    value is in no band: its code is NULL.
    """
    if len(codes) != len(uppers) + 1:
        raise ValueError("codes must have one entry more than uppers")
    expr = F.when(value.isNull(), F.lit(None))
    for upper, code in zip(uppers, codes):
        expr = expr.when(value < F.lit(upper), F.lit(code))
    return expr.otherwise(F.lit(codes[-1]))


def age_band(years: Column) -> Column:
    return bucketize(years, AGE_BAND_UPPERS_YEARS, AGE_BAND_CODES)


def acctbal_band(balance: Column) -> Column:
    return bucketize(balance, ACCTBAL_BAND_UPPERS, AGE_BAND_CODES)


def age_label(code: Column) -> Column:
    """Label of a band code through a literal map: no join, no Python."""
    mapping = F.create_map(*[F.lit(x) for x in chain.from_iterable(AGE_LABELS.items())])
    return F.element_at(mapping, code)
