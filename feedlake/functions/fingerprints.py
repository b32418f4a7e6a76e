"""Fingerprints of rows and of sets of rows, whatever their order and partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = ("fingerprint_low", "fingerprint_high")


def row_hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row; a NULL counts, as the hash alone would pass over it."""
    cells = [part for c in columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(1), *cells), F.xxhash64(F.lit(2), *cells)


def fingerprint(columns: Sequence[str], where: Column | None = None) -> list[Column]:
    """Aggregates that stand for the rows of a group, equal for equal rows in any order.

    Hashes are added up as decimals: a sum neither overflows nor, unlike an exclusive or, loses
    rows that occur twice. Sums of parts add up to the sum of the whole.
    """
    out = []
    for value, name in zip(row_hashes(columns), PARTS, strict=True):
        counted = value.cast("decimal(20,0)")
        counted = counted if where is None else F.when(where, counted)
        out.append(F.coalesce(F.sum(counted), F.lit(0).cast("decimal(30,0)")).alias(name))
    return out
