"""Mixing sources to target weights by the cube method.

Each source gets a target number of words, hence a rate at which its documents are taken. The whole
part of the rate is taken of every document; the fractional rest is an inclusion probability. The
flight phase moves these probabilities along the null space of two constraints, the source's total
of words and its number of documents, until they are 0 or 1. It runs in blocks of bounded size; what
a block cannot decide, two or three small documents, goes on to the next round, so each round is
some hundred times smaller. The last few documents of a source are landed, the word total first.

Rows that are equal in every column are one unit with a number of rows, however many they are. They
take the whole part of the rate times that number, and draw for what is left of it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import free_names, row_key, text_key
from feedlake.plans.shared import discard, settle

WEIGHTS = (5, 2, 1)  # of the sources by code point, repeating
MOST_REPEATS = 3  # a target stops at so many times its source's size
BLOCK = 1024  # documents of one flight
STRAIN = 0.25
PIECE = 1 << 12  # repeats of one row that a task makes at a time
_EDGE = 1e-9


def word_count(text: Column) -> Column:
    """Number of words, runs of anything but blanks and ASCII control spaces; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def source_targets(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS
) -> DataFrame:
    """One row per source: ``source``, ``documents``, ``source_size``, ``target``.

    ``sized`` has ``source``, ``size`` and ``rows``, for how many rows a row stands. Sources share the size of all by weight; a target stops at ``most`` times its source's size and
    the excess goes to the others by weight. That is one water level for all: the target is the
    lesser of ``most`` times the size and level times weight. With the sources in the order in
    which they stop, running sums give the level. One row per source passes one task.
    """
    sources = sized.groupBy("source").agg(
        F.count("*").alias("documents"), F.sum(F.col("size") * F.col("rows")).alias("source_size")
    )
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("weight", weight.cast("double"))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_stop = Window.orderBy(most * F.col("source_size") / F.col("weight"), "source")
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    full = most * F.col("source_size")
    levels = ranked.select(
        "*",
        (
            (
                F.sum("source_size").over(every)
                - F.coalesce(F.sum(full).over(before), F.lit(0))
            )
            / (
                F.sum("weight").over(every)
                - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
            )
        ).alias("level"),
    )
    # The level holds from the first source on that does not stop below it.
    held = F.when(F.col("level") * F.col("weight") <= full, F.col("level"))
    return levels.withColumn("held", F.first(held, ignorenulls=True).over(
        by_stop.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )).select(
        "source",
        "documents",
        "source_size",
        F.least(full.cast("double"), F.coalesce(F.col("held") * F.col("weight"), full.cast("double")))
        .alias("target"),
    )


def _direction(size: float, others: np.ndarray, land: bool) -> tuple[float, np.ndarray] | None:
    """A move of one document and of ``others`` that keeps the document and word totals.

    Among all such moves the one that moves the others least. If it would still move one of them by
    more than ``STRAIN``, as for a document far longer than all others, the word total alone is
    kept, lest the others be used up for the sake of the document total. When landing, any move will
    do at last.
    """
    count = len(others)
    if count:
        mean = others.mean()
        spread = float(((others - mean) ** 2).sum())
        if spread > 0:
            moves = -(1 / count + (size - mean) / spread * (others - mean))
            if np.abs(moves).max() <= STRAIN:
                return 1.0, moves
        elif size == mean:
            return 1.0, np.full(count, -1 / count)
        if mean > 0:
            return 1.0, -size * others / float((others**2).sum())
    return (1.0, np.zeros(count)) if land else None


def flight(chances: np.ndarray, sizes: np.ndarray, draw: np.random.Generator, land: bool) -> None:
    """Moves ``chances`` in place to 0 or 1, keeping their sum and their sum by size.

    Each move starts from the largest open document and is spread over all smaller ones, so that
    large documents are decided first and few, small ones stay open; with ``land`` those are decided
    as well.
    """
    order = np.argsort(-sizes, kind="stable")
    open_ = order[(chances[order] > 0) & (chances[order] < 1)]
    while len(open_):
        first, others = open_[0], open_[1:]
        found = _direction(float(sizes[first]), sizes[others].astype(float), land)
        if found is None:
            open_ = others  # stays as it is for the next round
            continue
        move = np.r_[found[0], found[1]]
        values = chances[open_]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(move > 0, (1 - values) / move, np.where(move < 0, values / -move, np.inf))
            down = np.where(move > 0, values / move, np.where(move < 0, (values - 1) / move, np.inf))
        ahead, behind = up.min(), down.min()
        forward = draw.random() * (ahead + behind) < behind
        step, nearest = (ahead, up.argmin()) if forward else (-behind, down.argmin())
        values = values + step * move
        values[nearest] = round(values[nearest])  # reached its edge, but for rounding
        values[values < _EDGE], values[values > 1 - _EDGE] = 0, 1
        chances[open_] = values
        open_ = open_[(values > 0) & (values < 1)]


def _fly(rows: pd.DataFrame, seed: int, land: bool) -> pd.DataFrame:
    rows = rows.sort_values(["order", "text_key", "row_key"], kind="stable")
    chances = rows["chance"].to_numpy(copy=True)
    draw = np.random.default_rng([seed, int(rows["order"].iloc[0]) % (1 << 62), len(rows)])
    flight(chances, rows["size"].to_numpy(), draw, land)
    return rows.assign(chance=chances)


def _repeated(df: DataFrame, times: str, place: str, keys: tuple[str, ...]) -> DataFrame:
    """Each row ``times`` times, numbered from 0 in ``place``, in pieces that tasks share."""
    last = F.col(times) - 1
    starts = F.transform(F.sequence(F.lit(0).cast("bigint"), F.floor(last / PIECE)), lambda k: k * PIECE)
    pieces = df.where(F.col(times) > 0).withColumn(place, F.explode(starts))
    pieces = pieces.repartition(*keys, place)
    top = F.least(last, F.col(place) + (PIECE - 1))
    return pieces.withColumn(place, F.explode(F.sequence(F.col(place), top)))


def plan_units(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_REPEATS,
    block: int = BLOCK,
    seed: int = 0,
    text: str = "text",
) -> DataFrame:
    """How often each unit of equal rows is taken, all its rows together.

    Text key, row key, doc_id, source, size, ``rows``, source_size, target, ``copies``.
    """
    id_type = docs.schema["doc_id"].dataType
    units = docs.select(
        # As text, for ids that are null would make numbers of the others floating ones.
        F.col("doc_id").cast("string").alias("doc_id"),
        text_key(F.col(text)).alias("text_key"),
        row_key(docs).alias("row_key"),
        "source",
        word_count(F.col(text)).alias("size"),
    )
    units = units.groupBy(*units.columns).agg(F.count("*").alias("rows"))
    sized = settle(units, "mix_sizes")
    targets = source_targets(sized, weights, most).withColumnRenamed("source", "from_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    amount = rate * F.col("rows")
    near = F.round(amount)
    amount = F.least(
        (most * F.col("rows")).cast("double"),
        F.when(F.abs(amount - near) < _EDGE * F.col("rows"), near).otherwise(amount),
    )
    order = F.pmod(F.xxhash64("text_key", "row_key", F.lit(seed)), F.lit(1 << 62))
    drawn = sized.join(targets, sized["source"].eqNullSafe(targets["from_source"])).select(
        "text_key", "row_key", "doc_id", "source", "size", "rows",
        "documents", "source_size", "target",
        F.floor(amount).cast("bigint").alias("base"),
        (amount - F.floor(amount)).alias("chance"),
        order.alias("order"),
    )
    decided, unused = None, sized
    while True:
        # A group is one block of one source; the number of blocks follows the units left.
        blocks = F.ceil(F.col("documents") / F.lit(block))
        land = F.col("documents") <= block
        groups = drawn.withColumns(
            {"part": F.pmod(F.xxhash64("order"), blocks).cast("bigint"), "land": land}
        )
        schema = groups.drop("part", "documents").schema
        columns = schema.names

        def fly(rows: pd.DataFrame) -> pd.DataFrame:
            return _fly(rows, seed, bool(rows["land"].iloc[0]))[columns]  # noqa: B023

        flown = groups.groupBy("source", "part").applyInPandas(fly, schema)
        flown = settle(flown, "mix_flight")
        if unused is not None:
            discard(unused)
            unused = None
        done = flown.where("chance in (0.0, 1.0)").withColumn(
            "copies", F.col("base") + F.col("chance").cast("bigint")
        )
        decided = done if decided is None else decided.unionByName(done)
        rest = flown.where("chance not in (0.0, 1.0)").drop("land")
        left = rest.groupBy("source").agg(F.count("*").alias("documents"))
        if left.isEmpty():
            break
        left = left.withColumnRenamed("source", "of_source")
        drawn = rest.join(left, rest["source"].eqNullSafe(left["of_source"])).drop("of_source")
    return decided.select(
        "text_key", "row_key", F.col("doc_id").cast(id_type).alias("doc_id"), "source", "size",
        "rows", "source_size", "target", "copies",
    )


def plan_mix(docs: DataFrame, **options) -> DataFrame:
    """How often each document is taken: doc_id, text key, source, size, target, ``copies``.

    One row per row of ``docs``; ``copies`` is 0 to ``most``. A null or empty text has size 0.
    Documents of a null source form a source of their own. Rows that are equal in every column
    share their copies evenly, so that they differ by one at most. The draw depends on the rows and
    ``seed`` only, so reruns and other partitionings agree. A source without words has target 0 and
    no copies. An empty table gives an empty plan. Options as of :func:`plan_units`.
    """
    units = plan_units(docs, **options)
    columns = ("doc_id", "text_key", "source", "size", "source_size", "target", "copies")
    single = units.where("rows = 1").select(*columns)
    place = _repeated(units.where("rows > 1"), "rows", "place", ("text_key", "row_key"))
    share = F.floor(F.col("copies") / F.col("rows")) + (
        F.col("place") < F.col("copies") % F.col("rows")
    ).cast("bigint")
    return single.unionByName(place.withColumn("copies", share).select(*columns))


def mix(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with every document repeated as often as the plan takes it; all columns stay.

    Rows that differ in any column are taken each for itself, equal ones as often as they are taken
    together.
    """
    key, row, copies, place, whole = free_names(docs, "key", "row", "copies", "place", "whole")
    units = plan_units(docs, text=text, **options).where("copies > 0")
    units = units.select(
        F.col("text_key").alias(key), F.col("row_key").alias(row), F.col("copies").alias(copies), "rows"
    )
    keyed = docs.withColumns({key: text_key(F.col(text)), row: row_key(docs)})
    once = units.where("rows = 1").drop("rows")
    taken = keyed.join(once, [key, row]).withColumn(
        place, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies)))
    )
    taken = taken.select(*docs.columns)
    several = units.where("rows > 1").drop("rows")
    if several.isEmpty():
        return taken
    # One of the equal rows stands for all, and is repeated as often as they are taken.
    one = keyed.join(several, [key, row]).groupBy(key, row).agg(
        F.first(F.struct(*docs.columns)).alias(whole), F.first(copies).alias(copies)
    )
    repeated = _repeated(one, copies, place, (key, row))
    return taken.unionAll(repeated.select(f"{whole}.*"))
