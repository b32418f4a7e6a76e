"""Exact top-k search by inner product with two cover trees.

Vectors are dealt to cells by their nearest pivot, cells are cut into blocks, and a cover tree is
built over each block; a round of queries gets a tree of its own. Both are descended together. For a
pair of nodes, the centres' inner product and the covering radii bound every score between them; a
pair goes when its bound is under the worst k-th score that any query of its group has so far.
Queries meet the cell they would be dealt to first, so the others are met with good scores to beat.
Scores are whole numbers and exact.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.llm.vectors import packed, scaled, unpacked
from feedlake.plans.shared import discard, settle

SCALE = 1024
TOP = 10
BLOCK = 4096  # vectors of one tree
QUERIES = 4096  # queries that are searched, and sent to tasks, at a time
PIVOTS = 1024  # vectors that cells are dealt by, and that are sent to tasks, at most
LEAF = 32
APART = 8  # points per child, on average, that a split must leave
_NONE = np.iinfo(np.int64).min
_EXACT = 2.0**52  # products of doubles below it are whole numbers without loss
_WHOLE = 2.0**62  # products below it fit 64-bit integers
_BITS = 60  # of a long vector's components that its approximation keeps
RESULT = "query_id bigint, rank int, vec_id bigint, score bigint"


class CoverTree:
    """Nested balls: every node has a centre, a level, a covering radius and a range of its points.

    A node of level ``i`` covers its points within ``2**i``. Its children's centres are chosen
    farthest first until all points are within ``2**(i - 1)`` of one, so they are further apart than
    that, and their levels are lower. A node whose points are few, all the same, or so far apart
    that children would hold hardly more than one each, is a leaf. Long vectors are one leaf.
    """

    def __init__(self, points: np.ndarray, leaf: int = LEAF):
        self.order = np.arange(len(points))
        self.long = points.dtype == object
        self.ranges = [(0, len(points))]
        self.children = [np.zeros(0, np.int64)]
        self.centers, self.radius, self.level = np.zeros(1, np.int64), np.full(1, np.inf), [0]
        if self.long or not len(points):
            return
        values = points.astype(np.float64)
        centers, radii, ranges, children, levels = [], [], [], [], []
        todo = [(0, len(points), -1)]
        while todo:
            low, high, parent = todo.pop()
            own = self.order[low:high]
            apart = _distances(values[own], values[own[0]])
            node, radius = len(centers), float(apart.max())
            level = int(np.ceil(np.log2(radius))) if radius else 0
            centers.append(low)  # centres stay first in their range
            radii.append(radius)
            ranges.append((low, high))
            levels.append(level)
            children.append([])
            if parent >= 0:
                children[parent].append(node)
            if high - low <= leaf or radius == 0:
                continue
            nearest, owner, chosen = apart, np.zeros(len(own), np.int64), [0]
            most = (high - low) // APART
            while nearest.max() > 2.0 ** (level - 1) and len(chosen) <= most:
                far = int(nearest.argmax())
                distance = _distances(values[own], values[own[far]])
                closer = distance < nearest
                owner[closer], nearest = len(chosen), np.minimum(nearest, distance)
                chosen.append(far)
            if len(chosen) > most:
                continue
            rest = np.ones(len(own), bool)
            rest[chosen] = False
            by_owner = np.lexsort((rest, owner))
            self.order[low:high] = own[by_owner]
            edges = np.searchsorted(owner[by_owner], np.arange(len(chosen) + 1)) + low
            todo += [(int(a), int(b), node) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        self.centers = np.array(centers, np.int64)  # places in order
        self.radius, self.level, self.ranges = np.array(radii), levels, ranges
        self.children = [np.array(own, np.int64) for own in children]


def _distances(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    apart = points - center
    return np.sqrt(np.einsum("ij,ij->i", apart, apart))


class Points:
    """Ids and vectors in the order of their tree, with what bounds and products need."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, tree: CoverTree):
        self.ids, self.points, self.tree = ids, points, tree
        if tree.long:
            self._approximate()
            return
        self.values = points.astype(np.float64)
        self.norms = np.sqrt((self.values**2).sum(1))
        self.longest = float(self.norms.max(initial=0.0))
        if len(points):
            self.center = self.values[tree.centers]
            self.center_norm = self.norms[tree.centers]

    def _approximate(self) -> None:
        """Doubles times a power of two for each vector."""
        bits = [max(abs(x).bit_length() for x in row) for row in self.points.tolist()]
        self.shift = np.maximum(np.array(bits, np.int64) - _BITS, 0)
        rows = [
            [x >> shift for x in row]
            for row, shift in zip(self.points.tolist(), self.shift.tolist(), strict=True)
        ]
        self.rough = np.array(rows, np.float64).reshape(len(rows), -1)
        self.norms = np.sqrt((self.rough**2).sum(1))

    def as_rough(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.tree.long:
            return self.rough, self.shift, self.norms
        return self.values, np.zeros(len(self.ids), np.int64), self.norms


class Search:
    """The best scores of a set of queries so far, and the descent that improves them.

    ``least`` is a score that each query is known to have ``top`` rows at or above.
    """

    def __init__(self, places, ids, points, top: int, least: np.ndarray | None = None):
        tree = CoverTree(points)
        order = tree.order
        self.own = Points(ids[order], points[order], tree)
        self.places = places[order]
        self.worst = np.full(len(ids), _NONE, np.int64) if least is None else least[order].copy()
        self.scores = np.full((len(ids), top), _NONE, np.int64)
        self.names = np.zeros((len(ids), top), np.int64)
        self.top = top
        self.compared = 0

    def _bounds(self, nodes: np.ndarray, block: Points, others: np.ndarray) -> np.ndarray:
        """The most that a point below a node here and a point below a node there can score."""
        own, tree = self.own, block.tree
        radius, norm = own.tree.radius[nodes], own.center_norm[nodes]
        middle = np.einsum("ij,ij->i", block.center[others], own.center[nodes])
        bound = middle + radius * block.center_norm[others] + tree.radius[others] * (norm + radius)
        slack = 1e-9 * (norm + radius) * (block.center_norm[others] + tree.radius[others])
        return bound + 1 + slack  # never under, in spite of rounding

    def add(self, block: Points) -> None:
        if not len(self.own.ids) or not len(block.ids):
            return
        if self.own.tree.long or block.tree.long:
            self._compare_long(block)
            return
        own, tree = self.own.tree, block.tree
        self.product = self.own.longest * block.longest
        root = np.zeros(1, np.int64)
        todo = [(float(self._bounds(root, block, root)[0]), 0, 0)]
        while todo:
            bound, node, other = todo.pop()
            low, high = own.ranges[node]
            if bound < self.worst[low:high].min():
                continue
            mine, theirs = own.children[node], tree.children[other]
            if not len(mine) and not len(theirs):
                self._compare(low, high, block, other)
                continue
            if not len(mine) or (len(theirs) and tree.radius[other] >= own.radius[node]):
                mine = np.full(len(theirs), node)
            else:
                theirs = np.full(len(mine), other)
            bounds = self._bounds(mine, block, theirs)
            todo += [
                (float(bounds[k]), int(mine[k]), int(theirs[k])) for k in np.argsort(bounds)
            ]

    def _compare(self, low: int, high: int, block: Points, other: int) -> None:
        """A leaf against a leaf; a query takes part if its own bound says so."""
        own, tree = self.own, block.tree
        bound = own.values[low:high] @ block.center[other]
        bound += own.norms[low:high] * (tree.radius[other] * (1 + 1e-9) + 1e-9 * block.longest)
        rows = low + np.flatnonzero(bound + 1 >= self.worst[low:high])
        if not len(rows):
            return
        first, last = tree.ranges[other]
        self.compared += len(rows) * (last - first)
        if self.product < _EXACT:
            scores = (own.values[rows] @ block.values[first:last].T).astype(np.int64)
        elif self.product < _WHOLE:
            scores = own.points[rows] @ block.points[first:last].T
        else:
            whole = own.points[rows].astype(object) @ block.points[first:last].astype(object).T
            scores = np.where((whole > _NONE) & (whole < -_NONE), whole, _NONE).astype(np.int64)
        ids = block.ids[first:last]
        scores[own.ids[rows, None] == ids[None]] = _NONE
        better = np.flatnonzero(scores.max(1) >= self.worst[rows])
        self._merge(rows[better], scores[better], ids)

    def _compare_long(self, block: Points) -> None:
        """Queries against a block in doubles of known error; what may count again in integers."""
        mine, my_shift, my_norms = self.own.as_rough()
        theirs, shift, norms = block.as_rough()
        wide = mine.shape[1]
        for row in range(len(mine)):
            # In units of 2**power: the score is within the error of the rough one.
            power = my_shift[row] + shift
            rough = theirs @ mine[row]
            error = (wide + 8) * (2.0**-50 * my_norms[row] * norms + 2.0**-50) + np.where(
                power > 0, np.sqrt(wide) * 2 * (my_norms[row] + norms + wide), 0
            )
            edge = np.ldexp(1.0, np.maximum(63 - power, -1000))
            allowed = block.ids != self.own.ids[row]
            may_fit = allowed & (rough - error < edge) & (rough + error > -edge)
            fits = allowed & (rough + error < edge) & (rough - error > -edge)
            least = float(self.worst[row])
            if fits.sum() >= self.top:
                sure = np.ldexp((rough - error)[fits], power[fits])
                least = max(least, float(np.partition(sure, -self.top)[-self.top]))
            # Where a power does not fit a double, whatever may fit is looked at.
            reach = np.where(power > 900, np.inf, np.ldexp(rough + error, np.minimum(power, 900)))
            places = np.flatnonzero(may_fit & (reach >= least - 1 - abs(least) * 2.0**-50))
            query = list(map(int, self.own.points[row]))
            found = [
                (sum(a * int(b) for a, b in zip(query, block.points[k], strict=True)), k)
                for k in places.tolist()
            ]
            self.compared += len(places)
            found = [(score, k) for score, k in found if _NONE < score < -_NONE]
            if found:
                scores = np.array([[score for score, _ in found]], np.int64)
                self._merge(np.array([row]), scores, block.ids[[k for _, k in found]])

    def _merge(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(rows):
            return
        scores = np.concatenate((self.scores[rows], scores), axis=1)
        names = np.concatenate(
            (self.names[rows], np.broadcast_to(ids, (len(rows), len(ids)))), axis=1
        )
        # ~x falls as x rises, also at the least number, which marks no score.
        order = np.lexsort((names, ~scores), axis=-1)[:, : self.top]
        self.scores[rows] = np.take_along_axis(scores, order, 1)
        self.names[rows] = np.take_along_axis(names, order, 1)
        self.worst[rows] = np.maximum(self.worst[rows], self.scores[rows, -1])

    def found(self) -> pa.RecordBatch:
        row, place = np.nonzero(self.scores != _NONE)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.places[row]),
                pa.array(self.own.ids[row]),
                pa.array(self.names[row, place]),
                pa.array(self.scores[row, place]),
            ],
            ["query", "query_id", "vec_id", "score"],
        )


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """Rows that take part as vec_id, vector."""
    named = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    return named.where("vec_id is not null and size(vector) > 0").where(
        "not exists(vector, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    )


def _choose_pivots(rows: DataFrame, count: int) -> dict[int, np.ndarray]:
    """Pivots of each length, from ``count`` rows drawn by a hash of their ids."""
    drawn = rows.orderBy(F.xxhash64("vec_id", "vector")).limit(count).collect()
    column = pa.array([r["vector"] for r in drawn], pa.list_(pa.float64()))
    return {
        matrix.shape[1]: np.unique(matrix, axis=0).astype(np.float64)
        for _, matrix in scaled(column, SCALE)
        if matrix.dtype != object
    }


def _nearest(matrix: np.ndarray, pivots: dict[int, np.ndarray]) -> np.ndarray:
    """Number of the nearest pivot; 0 where there is none to compare with."""
    own = pivots.get(matrix.shape[1])
    if own is None or matrix.dtype == object:
        return np.zeros(len(matrix), np.int64)
    # Rounding may choose another of two pivots about as near, which only changes the cell.
    return ((own**2).sum(1) - 2 * (matrix.astype(np.float64) @ own.T)).argmin(1)


def build_index(rows: DataFrame, pivots: dict[int, np.ndarray], block: int = BLOCK) -> DataFrame:
    """Blocks of vectors of one length and cell with their trees, settled: size, cell, tree.

    A cell of any size is dealt to as many parts as make its blocks, so no task holds more than one
    block at a time, and equal vectors do not meet in one task.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, matrix in scaled(batch.column("vector"), SCALE):
                count = len(places)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(count, matrix.shape[1]), pa.int32()),
                        pa.array(np.full(count, matrix.dtype == object)),
                        pa.array(_nearest(matrix, pivots), pa.int32()),
                        pa.array(places, pa.int32()),
                        batch.column("vec_id").take(pa.array(places)),
                        packed(matrix),
                    ],
                    ["size", "long", "cell", "salt", "vec_id", "vector"],
                )

    key = ["size", "long", "cell"]
    dealt = settle(
        rows.mapInArrow(
            deal, "size int, long boolean, cell int, salt int, vec_id bigint, vector binary"
        ),
        "cover_dealt",
    )
    parts = dealt.groupBy(*key).agg(F.ceil(F.count("*") / block).alias("parts"))
    placed = dealt.join(parts, key).withColumn(
        "part", F.pmod(F.xxhash64("vec_id", "salt"), "parts")
    )
    whole_key = [*key, "part"]
    ordered = placed.drop("parts", "salt").repartition(*whole_key).sortWithinPartitions(*whole_key)

    def emit(size: int, long: bool, cell: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        ids = np.concatenate([b.column("vec_id").to_numpy() for b in held])
        points = np.concatenate([
            matrix for b in held for _, matrix in unpacked(b.column("vector"), np.full(len(b), long))
        ])
        tree = CoverTree(points)
        points = points[tree.order]
        stored = points if long else points.astype("<i4")
        cell_bytes = pickle.dumps((ids[tree.order], stored, vars(tree)), 5)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([size], pa.int32()), pa.array([cell], pa.int32()),
                pa.array([cell_bytes], pa.binary()),
            ],
            ["size", "cell", "tree"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, held, count = None, [], 0
        for batch in batches:
            table = np.stack([
                batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in whole_key
            ])
            changes = np.flatnonzero((table[:, 1:] != table[:, :-1]).any(0)) + 1
            edges = [0, *changes.tolist(), batch.num_rows] if batch.num_rows else []
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                own = tuple(table[:, low].tolist())
                while low < high:
                    if count and (own != kind or count >= block):
                        yield emit(kind[0], bool(kind[1]), kind[2], held)
                        held, count = [], 0
                    kind = own
                    take = min(high - low, block - count)
                    held.append(batch.slice(low, take))
                    low, count = low + take, count + take
        if count:
            yield emit(kind[0], bool(kind[1]), kind[2], held)

    index = settle(ordered.mapInArrow(run, "size int, cell int, tree binary"), "cover_trees")
    discard(dealt)
    return index


def load(cell: bytes) -> Points:
    """A block of the index as it was built."""
    ids, stored, parts = pickle.loads(cell)
    tree = CoverTree.__new__(CoverTree)
    vars(tree).update(parts)
    return Points(ids, stored if tree.long else stored.astype(np.int64), tree)


def _scan(index: DataFrame, asked: dict[tuple, list[tuple]], top: int, home: bool) -> DataFrame:
    """Best rows per query over the blocks a task reads: query, query_id, vec_id, score.

    ``asked`` has the queries by length, or with ``home`` by length and cell.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches: dict[tuple, list[Search]] = {}
        for batch in batches:
            for size, number, cell in zip(
                batch.column("size").to_pylist(), batch.column("cell").to_pylist(),
                batch.column("tree"), strict=True,
            ):
                key = (size, number) if home else (size,)
                if key not in asked:
                    continue
                if key not in searches:
                    searches[key] = [Search(*own[:3], top, own[3]) for own in asked[key]]
                block = load(cell.as_buffer())
                for search in searches[key]:
                    search.add(block)
        for own in searches.values():
            for search in own:
                yield search.found()

    found = index.mapInArrow(run, "query bigint, query_id bigint, vec_id bigint, score bigint")
    ranked = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top)


def top_k(
    vectors: DataFrame,
    every: int = 100,
    top: int = TOP,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    block: int = BLOCK,
    queries: int = QUERIES,
    pivots: int = PIVOTS,
) -> DataFrame:
    """The ``top`` highest scores of each query: query_id, rank (from 1), vec_id, score.

    Queries are the rows whose id is divisible by ``every``; all rows of another id are candidates.
    A score is the inner product of the components times 1024, rounded down; ties go to the smaller
    id. Rows without id, and vectors that are null, empty or hold null or non-finite components,
    take no part; vectors of different lengths are not compared. A finite vector takes part however
    long; only a pair whose score does not fit 64 bits is left out. A repeated row is a candidate
    each time, and one query. With fewer candidates there are fewer ranks; an empty table gives no
    rows. Columns other than the two named are not read.

    The index is settled once. Queries come in rounds of about ``queries``, each settled before the
    next is made, so what reaches the driver and the tasks is bounded whatever the table holds.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, vector)
    asked = settle(rows.where(F.col("vec_id") % every == 0).distinct(), "cover_queries")
    count = rows.count()
    chosen = _choose_pivots(rows, min(pivots, -(-count // block)))
    index = build_index(rows, chosen, block)
    rounds = max(1, -(-asked.count() // queries))
    results = []
    for turn in range(rounds):
        mine = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(rounds)) == turn
        held = asked.where(mine).orderBy("vec_id", F.to_json("vector")).collect()
        found = _search_round(index, held, chosen, top)
        results.append(
            settle(found.select("query_id", "rank", "vec_id", "score"), "cover_found")
        )
    discard(index, asked)
    paths = [table._settled_at for table in results]
    return spark.read.schema(T._parse_datatype_string(RESULT)).parquet(*paths)


def _search_round(
    index: DataFrame, held: list, pivots: dict[int, np.ndarray], top: int
) -> DataFrame:
    """All blocks for one round of queries, after the cells that they would be dealt to."""
    ids = np.array([r["vec_id"] for r in held], np.int64)
    column = pa.array([r["vector"] for r in held], pa.list_(pa.float64()))
    kinds = list(scaled(column, SCALE)) if held else []
    least = np.full(len(ids), _NONE, np.int64)
    if any(len(own) > 1 for own in pivots.values()):
        homes: dict[tuple, list[tuple]] = {}
        for places, matrix in kinds:
            cells = _nearest(matrix, pivots)
            for cell in np.unique(cells).tolist():
                own = places[cells == cell]
                entry = own, ids[own], matrix[cells == cell], None
                homes.setdefault((matrix.shape[1], cell), []).append(entry)
        known = _scan(index, homes, top, home=True).where(F.col("rank") == top)
        for row in known.select("query", "score").collect():  # one row a query of the round
            least[row["query"]] = row["score"]
    asked: dict[tuple, list[tuple]] = {}
    for places, matrix in kinds:
        entry = places, ids[places], matrix, least[places]
        asked.setdefault((matrix.shape[1],), []).append(entry)
    return _scan(index, asked, top, home=False)
