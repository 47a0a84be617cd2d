"""Column expressions shared by the operators; all JVM-side built-ins."""

from rateweave.functions.bands import (
    ACCTBAL_BAND_UPPERS,
    AGE_BAND_CODES,
    AGE_BAND_UPPERS_YEARS,
    AGE_LABELS,
    acctbal_band,
    age_band,
    age_label,
    bucketize,
)
from rateweave.functions.ordering import as_string_id, time_sort_key
from rateweave.functions.strings import jvm_trim, literal_like

__all__ = [
    "ACCTBAL_BAND_UPPERS",
    "AGE_BAND_CODES",
    "AGE_BAND_UPPERS_YEARS",
    "AGE_LABELS",
    "acctbal_band",
    "age_band",
    "age_label",
    "as_string_id",
    "bucketize",
    "jvm_trim",
    "literal_like",
    "time_sort_key",
]
