"""Row cap of a source, by refinement.

The row that ends the cap is closed in on: a bounded sample of keys gives ranges around it, one
aggregation counts the rows of each range, and the range that holds it is looked into next. What is
returned is a filter over the source, so the table itself is neither sorted, shuffled nor written.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEW = 10_000  # rows that a plain top-n may hold in a task, and keys that reach the driver
SAMPLE = 4096  # keys drawn per round
REPEATS = 1 << 20  # copies of one row made by one task at a time


class _Key:
    """Comparisons of rows with a value of the key, NULL first, in terms of plain columns.

    A single column gives a plain comparison, which reaches the scan.
    """

    def __init__(self, schema: T.StructType, names: Sequence[str]):
        self.names = list(names)
        self.kinds = {name: schema[name].dataType for name in names}

    def _literal(self, name: str, value: Row) -> Column:
        return F.lit(value[name]).cast(self.kinds[name])

    def same(self, value: Row) -> Column:
        tests = [F.col(f"`{c}`").eqNullSafe(self._literal(c, value)) for c in self.names]
        return reduce(lambda a, b: a & b, tests)

    def before(self, value: Row) -> Column:
        """True for rows whose key comes strictly before ``value``; never NULL, as each comparison
        of a NULL stands beside a test that is true for it."""
        out = F.lit(False)
        for name in reversed(self.names):
            own, literal = F.col(f"`{name}`"), self._literal(name, value)
            if value[name] is None:
                out = own.isNull() & out
            else:
                out = own.isNull() | (own < literal) | ((own == literal) & out)
        return out

    def order(self) -> list[Column]:
        return [F.col(f"`{c}`").asc_nulls_first() for c in self.names]


def _sample(window: DataFrame, key: _Key, turn: int) -> list[Row]:
    """Keys of rows drawn evenly, in order; each task keeps no more than it may send.

    A key occurs as often as its rows were drawn. The draw only decides where ranges end, never what
    the cap returns.
    """
    drawn = window.select(*[F.col(f"`{c}`") for c in key.names]).orderBy(F.rand(turn))
    return drawn.limit(SAMPLE).coalesce(1).sortWithinPartitions(*key.order()).collect()


def _edges(sample: list[Row], share: float) -> list[Row]:
    """Sampled keys close around the wanted place, and ever fewer farther away, each once."""
    at = min(int(share * len(sample)), len(sample) - 1)
    steps = [0, *(1 << k for k in range(SAMPLE.bit_length()))]
    places = sorted({at + step for step in steps} | {at - step for step in steps})
    keys = {repr(sample[k]): sample[k] for k in places if 0 <= k < len(sample)}
    return list(keys.values())


def _last_key(
    df: DataFrame, key: _Key, n: int, few: int
) -> tuple[Row | None, int, int]:
    """Key of the ``n``-th row, how many rows of it are wanted, and how many there are.

    None if there are no more than ``n`` rows.
    """
    window, need, rows = df, n, df.count()
    if rows <= n:
        return None, 0, 0
    turn = 0
    while rows > few:
        sample = _sample(window, key, turn)
        edges = _edges(sample, need / rows)
        # Range k holds the keys up to edge k, each edge a range of its own: 2k below, 2k + 1 equal.
        place = F.lit(2 * len(edges))
        for k in reversed(range(len(edges))):
            equal = F.when(key.same(edges[k]), 2 * k + 1).otherwise(place)
            place = F.when(key.before(edges[k]), 2 * k).otherwise(equal)
        found = window.groupBy(place.alias("place")).agg(F.count("*").alias("n")).collect()
        counts = {r["place"]: r["n"] for r in found}
        for k in sorted(counts):
            if need <= counts[k]:
                break
            need -= counts[k]
        if k % 2:
            return edges[k // 2], need, counts[k]
        if k // 2 < len(edges):
            window = window.where(key.before(edges[k // 2]))
        if k:
            below = edges[k // 2 - 1]
            window = window.where(~key.before(below) & ~key.same(below))
        rows, turn = counts[k], turn + 1
    columns = [F.col(f"`{c}`") for c in key.names]
    keys = window.select(*columns).orderBy(*key.order()).limit(few).collect()
    last = keys[need - 1]
    equal = [k for k, value in enumerate(keys) if repr(value) == repr(last)]
    return last, need - equal[0], len(equal)


def _repeated(df: DataFrame, times: int) -> DataFrame:
    """The first row of a table of equal rows, ``times`` times, in parts of bounded size."""
    parts = -(-times // REPEATS)
    part = "_repeats_part"
    spread = df.limit(1).withColumn(part, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    if parts > 1:
        spread = spread.repartition(part)
    left = F.lit(times) - F.col(part) * REPEATS
    own = F.sequence(F.lit(1), F.least(left, F.lit(REPEATS)).cast("int"))
    return spread.withColumn(part, F.explode(own)).drop(part)


def capped(
    df: DataFrame, n: int, order_by: Sequence[str], few: int = FEW
) -> DataFrame:
    """The first ``n`` rows by a key, NULL first; what is cut off is the caller's wish.

    Rows that tie on the key at the end of the cap are taken in the order of their other columns, so
    the result is the same whatever the partitioning; rows equal in all columns are interchangeable.
    All columns must be of types that can be ordered. With fewer rows all are returned, and with
    ``n`` below 1 none.

    Up to ``few`` rows are a plain top-n, of which every task keeps no more. Beyond that the source
    is scanned a few times for its key columns, and the answer is a filter.
    """
    others = [c for c in df.columns if c not in order_by]
    if n < 1:
        return df.limit(0)
    if n <= few:
        return df.orderBy(*_Key(df.schema, [*order_by, *others]).order()).limit(n)
    return _capped(df, n, [list(order_by), others], few)


def _capped(df: DataFrame, n: int, levels: list[list[str]], few: int) -> DataFrame:
    """The first ``n`` rows by the first level of columns, ties by the next one."""
    level, *lower = [names for names in levels if names]
    key = _Key(df.schema, level)
    last, wanted, there = _last_key(df, key, n, few)
    if last is None:
        return df
    if wanted == there:
        return df.where(key.before(last) | key.same(last))
    tied = df.where(key.same(last))
    # Rows that tie on the last level are equal in every column.
    ends = _capped(tied, wanted, lower, few) if lower else _repeated(tied, wanted)
    return df.where(key.before(last)).unionByName(ends)
