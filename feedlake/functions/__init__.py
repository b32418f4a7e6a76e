"""Column expressions shared by the operators. All run inside the JVM; none is a Python UDF."""

from feedlake.functions.fingerprints import PARTS, fingerprint
from feedlake.functions.measures import (
    guarded_pct,
    mean_of_pct,
    real_or_null,
    whole_or_null,
)
from feedlake.functions.parsing import coded, day_of, first_date, lenient_int, tidy

__all__ = [
    "PARTS",
    "coded",
    "day_of",
    "fingerprint",
    "first_date",
    "guarded_pct",
    "lenient_int",
    "mean_of_pct",
    "real_or_null",
    "tidy",
    "whole_or_null",
]
