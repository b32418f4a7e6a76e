"""Hard negatives by a multiway hyperplane tree with distance ranges (a GNAT).

Vectors are cut into blocks, each with a tree of its own. A node has a few split points, every
vector belongs to the split point nearest to it, and for every pair of split point and subtree the
node stores the range of distances between them. A vector gets one further component that gives all
vectors of a block the same length; then a window of inner products with an anchor is a window of
distances from it, an annulus. At a node the anchor's distance from every split point shifts the
annulus into a window of distances from that point, and a subtree goes as soon as one of its ranges
lies outside. Leaves compare whole numbers exactly.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake.llm.vectors import scaled
from feedlake.plans.shared import discard, settle

SCALE = 256
BLOCK = 2048  # vectors of one tree
SPLITS = 12
LEAF = 24
ANCHORS = 4096  # anchors that are searched, and sent to tasks, at a time
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100  # a negative's score in percent of the positive's
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
_EXACT = 2.0**52  # products of doubles below it are whole numbers without loss


class Gnat:
    """The tree over one block of vectors, in the lifted space where all have one length."""

    def __init__(self, points: np.ndarray, splits: int = SPLITS, leaf: int = LEAF):
        values = points.astype(np.float64)
        squares = (values**2).sum(1)
        self.square = float(squares.max(initial=0.0))  # of the common length
        lifted = np.concatenate((values, np.sqrt(self.square - squares)[:, None]), axis=1)
        self.order = np.arange(len(points))
        self.bounds: list[tuple[int, int]] = []
        self.split: list[np.ndarray | None] = []  # lifted split points of inner nodes
        self.ranges: list[np.ndarray | None] = []  # [2, split, child]: least and greatest distance
        self.children: list[list[int]] = []
        todo = [(0, len(points), -1)]
        while todo:
            low, high, parent = todo.pop()
            node = len(self.bounds)
            if parent >= 0:
                self.children[parent].append(node)
            self.bounds.append((low, high))
            self.children.append([])
            own = self.order[low:high]
            chosen, apart = _spread(lifted[own], splits) if high - low > leaf else (None, None)
            if chosen is None or len(chosen) < 2:  # few vectors, or all the same
                self.split.append(None)
                self.ranges.append(None)
                continue
            owner = apart.argmin(1)
            by_owner = np.argsort(owner, kind="stable")
            edges = np.searchsorted(owner[by_owner], np.arange(len(chosen) + 1))
            pairs = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
            sorted_apart = apart[by_owner]
            self.split.append(lifted[own[chosen]])
            self.ranges.append(
                np.stack([
                    np.stack([sorted_apart[a:b].min(0) for a, b in pairs], axis=1),
                    np.stack([sorted_apart[a:b].max(0) for a, b in pairs], axis=1),
                ])
            )
            self.order[low:high] = own[by_owner]
            # Popped from the end: the children of a node are numbered in the order of its splits.
            todo += [(low + a, low + b, node) for a, b in reversed(pairs)]


def _spread(lifted: np.ndarray, splits: int) -> tuple[np.ndarray, np.ndarray]:
    """Split points, each the farthest from those before, and all distances from them."""
    chosen, columns = [0], [_distances(lifted, lifted[0])]
    nearest = columns[0]
    while len(chosen) < splits and nearest.max() > 0:
        far = int(nearest.argmax())
        chosen.append(far)
        columns.append(_distances(lifted, lifted[far]))
        nearest = np.minimum(nearest, columns[-1])
    return np.array(chosen), np.stack(columns, axis=1)


def _distances(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    apart = points - center
    return np.sqrt(np.einsum("ij,ij->i", apart, apart))


class Windows:
    """Open windows of scores, several to an anchor, and the best rows found in each so far.

    ``high`` and ``low`` are inclusive. A window keeps its ``top`` highest scores, ties by smaller
    id; once it has as many, ``low`` follows the worst of them. With ``same`` only rows of the
    anchor's label count, else only rows of another label; never the anchor's own id.
    """

    def __init__(self, anchors, own, low, high, top: int, same: bool):
        self.ids, self.labels, self.points = anchors
        self.own, self.low, self.high = own, low, high
        self.top, self.same = top, same
        self.values = self.points.astype(np.float64)
        self.squares = (self.values**2).sum(1)
        self.scores = np.full((len(own), top), _LEAST, np.int64)
        self.names = np.zeros((len(own), top), np.int64)
        self.filled = np.zeros((len(own), top), bool)
        self.compared = 0

    def search(self, ids, labels, points, tree: Gnat) -> None:
        longest = np.sqrt(tree.square * self.squares.max(initial=0.0))
        self.exact = longest < _EXACT and points.dtype != object and self.points.dtype != object
        self.block = ids, labels, points, points.astype(np.float64) if self.exact else None
        self.tree = tree
        #: Least and greatest distance of the anchor from a row whose score is in the window.
        if len(self.own) and len(ids):
            self._visit(0, np.arange(len(self.own)))

    def _annulus(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        base = self.squares[self.own[rows]] + self.tree.square
        near = np.sqrt(np.maximum(base - 2.0 * self.high[rows].astype(np.float64), 0))
        far = np.sqrt(np.maximum(base - 2.0 * self.low[rows].astype(np.float64), 0))
        # Square roots of rounded differences: a slack that covers cancellation near zero.
        slack = 1e-6 * (1 + np.sqrt(base))
        return near - slack, far + slack

    def _survivors(self, node: int, rows: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """[row, child]: subtrees none of whose ranges lies outside the shifted annulus."""
        near, far = self._annulus(rows)
        low, high = self.tree.ranges[node]
        keeps = np.ones((len(rows), low.shape[1]), bool)
        for split in range(low.shape[0]):
            distance = apart[:, split, None]
            # A row within distance t of the split point is between |distance - t| and distance + t
            # of the anchor.
            most = distance + high[split]
            least = np.maximum(low[split] - distance, distance - high[split])
            keeps &= (most >= near[:, None]) & (least <= far[:, None])
        return keeps

    def _visit(self, node: int, rows: np.ndarray) -> None:
        split = self.tree.split[node]
        if split is None:
            self._compare(rows, *self.tree.bounds[node])
            return
        anchors, back = np.unique(self.own[rows], return_inverse=True)
        lifted = np.concatenate((self.values[anchors], np.zeros((len(anchors), 1))), axis=1)
        apart = np.stack([_distances(lifted, center) for center in split], axis=1)[back]
        keeps = self._survivors(node, rows, apart)
        first = np.where(keeps, apart, np.inf).argmin(1)
        children = self.tree.children[node]
        for k, child in enumerate(children):  # each window's nearest subtree raises its bound
            here = keeps[:, k] & (first == k)
            if here.any():
                self._visit(child, rows[here])
        keeps &= first[:, None] != np.arange(len(children))
        left = np.flatnonzero(keeps.any(1))
        if not len(left):
            return
        rows, apart = rows[left], apart[left]
        keeps = keeps[left] & self._survivors(node, rows, apart)
        for k, child in enumerate(children):
            if keeps[:, k].any():
                self._visit(child, rows[keeps[:, k]])

    def _compare(self, rows: np.ndarray, first: int, last: int) -> None:
        ids, labels, points, values = (x if x is None else x[first:last] for x in self.block)
        anchors, back = np.unique(self.own[rows], return_inverse=True)
        self.compared += len(anchors) * (last - first)
        if self.exact:
            scores = (self.values[anchors] @ values.T).astype(np.int64)
            fits = True
        else:
            whole = self.points[anchors].astype(object) @ points.astype(object).T
            fits = ((whole <= _MOST) & (whole >= _LEAST)).astype(bool)
            scores = np.where(fits, whole, 0).astype(np.int64)
        allowed = (self.labels[anchors, None] == labels) == self.same
        allowed &= (self.ids[anchors, None] != ids) & fits
        scores = scores[back]
        inside = allowed[back] & (scores >= self.low[rows, None]) & (scores <= self.high[rows, None])
        better = np.flatnonzero(inside.any(1))
        if not len(better):
            return
        rows, inside = rows[better], inside[better]
        all_scores = np.concatenate((self.scores[rows], scores[better]), axis=1)
        all_names = np.concatenate(
            (self.names[rows], np.broadcast_to(ids, (len(rows), len(ids)))), axis=1
        )
        all_filled = np.concatenate((self.filled[rows], inside), axis=1)
        # ~x falls as x rises, also at the least 64-bit number.
        order = np.lexsort((all_names, ~all_scores, ~all_filled), axis=-1)[:, : self.top]
        self.scores[rows] = np.take_along_axis(all_scores, order, 1)
        self.names[rows] = np.take_along_axis(all_names, order, 1)
        self.filled[rows] = np.take_along_axis(all_filled, order, 1)
        full = self.filled[rows, -1]
        self.low[rows[full]] = np.maximum(self.low[rows[full]], self.scores[rows[full], -1])


def build_index(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of vectors of one length with their trees, one row each: size, long, tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, bool], list] = {}

        def emit(kind: tuple[int, bool], parts: list) -> pa.RecordBatch:
            ids, labels, points = (np.concatenate(own) for own in zip(*parts, strict=True))
            tree = Gnat(points)
            own = (ids[tree.order], labels[tree.order], points[tree.order], vars(tree))
            return pa.RecordBatch.from_arrays(
                [pa.array([kind[0]], pa.int32()), pa.array([pickle.dumps(own, 5)], pa.binary())],
                ["size", "tree"],
            )

        for batch in batches:
            ids, labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
            for places, matrix in scaled(batch.column("vector"), SCALE):
                kind = matrix.shape[1], matrix.dtype == object
                for first in range(0, len(places), block):
                    own = places[first : first + block]
                    parts = held.setdefault(kind, [])
                    parts.append((ids[own], labels[own], matrix[first : first + block]))
                    if sum(len(p[0]) for p in parts) >= block:
                        yield emit(kind, held.pop(kind))
        for kind in list(held):
            yield emit(kind, held.pop(kind))

    return rows.mapInArrow(run, "size int, tree binary")


def _search(index: DataFrame, asked: dict[int, tuple], top: int, same: bool) -> DataFrame:
    """Best rows per window over all blocks a task reads: window, vec_id, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches: dict[int, tuple] = {}
        for batch in batches:
            for size, cell in zip(
                batch.column("size").to_pylist(), batch.column("tree"), strict=True
            ):
                if size not in asked:
                    continue
                if size not in searches:
                    names, anchors, own, low, high = asked[size]
                    windows = Windows(anchors, own, low.copy(), high, top, same)
                    searches[size] = names, windows
                ids, labels, points, parts = pickle.loads(cell.as_buffer())
                tree = Gnat.__new__(Gnat)
                vars(tree).update(parts)
                searches[size][1].search(ids, labels, points, tree)
        for names, windows in searches.values():
            row, place = np.nonzero(windows.filled)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names[row]),
                    pa.array(windows.names[row, place]),
                    pa.array(windows.scores[row, place]),
                ],
                ["window", "vec_id", "score"],
            )

    found = index.mapInArrow(run, "window bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("window").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def _anchors_of(rows: list, scale: int) -> dict[int, tuple]:
    """Collected anchors by length: their place in ``rows``, ids, labels and points."""
    out: dict[int, tuple] = {}
    if not rows:
        return out
    column = pa.array([r["vector"] for r in rows], pa.list_(pa.float64()))
    ids = np.array([r["vec_id"] for r in rows], np.int64)
    labels = np.array([r["label"] for r in rows], np.int64)
    for places, matrix in scaled(column, scale):
        size = matrix.shape[1]
        if size in out:  # ordinary and long vectors of one length
            held = out[size]
            both = np.concatenate((held[0], places))
            out[size] = both, ids[both], labels[both], np.concatenate(
                (held[3].astype(object), matrix.astype(object))
            )
        else:
            out[size] = places, ids[places], labels[places], matrix
    return out


def usable(vectors: DataFrame, vec_id: str, vector: str, label: str, relabel: bool) -> DataFrame:
    """Rows that take part as vec_id, label, vector."""
    named = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(label).cast("bigint").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    ).where("vec_id is not null and label is not null and size(vector) > 0")
    finite = named.where(
        "not exists(vector, x -> x is null or isnan(x) or abs(x) = double('infinity'))"
    )
    if not relabel:
        return finite
    shifted = F.pmod(F.col("label") + 1, F.lit(10))
    return finite.withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, shifted).otherwise(F.col("label"))
    )


def mine(
    vectors: DataFrame,
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    relabel: bool = True,
    block: int = BLOCK,
    anchors: int = ANCHORS,
) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``. An anchor's positives are its
    ``positives`` best other rows of its label, and for each of them the best ``negatives`` rows of
    another label are returned whose score is between 80 and 100 percent of the positive's. Scores
    are inner products of the components times 256, rounded down; ties go to the smaller id. With
    ``relabel`` the label of every id divisible by 7 first becomes (label + 1) % 10.

    Rows without id or label, and vectors that are null, empty or hold a null or non-finite
    component, take no part. Vectors of different lengths are not compared, and a pair whose score
    does not fit 64 bits is left out. A repeated row is a candidate each time, and one anchor; rows
    of the anchor's own id are no candidates. A positive of negative score has no negatives, as its
    window is empty. An anchor without positives or negatives gives no rows, nor does an empty
    table. Columns other than the three named are not read.

    The index is settled once. Anchors come in rounds of about ``anchors``, each settled before the
    next is made, so what reaches the driver and the tasks is bounded whatever the table holds.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, vector, label, relabel)
    index = settle(build_index(rows, block), "gnat_index")
    asked = settle(rows.where(F.col("vec_id") % every == 0).distinct(), "gnat_anchors")
    rounds = max(1, -(-asked.count() // anchors))
    results = []
    for turn in range(rounds):
        # Repeats of an id with other vectors or labels are anchors of their own.
        mine_now = F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(rounds)) == turn
        held = asked.where(mine_now).orderBy("vec_id", "label", F.to_json("vector")).collect()
        own = _anchors_of(held, SCALE)
        good = settle(_positives(index, own, positives), "gnat_positives")
        results.append(settle(_negatives(index, own, held, good, negatives), "gnat_negatives"))
        discard(good)
    discard(index, asked)
    if not results:
        return spark.createDataFrame([], RESULT)
    paths = [table._settled_at for table in results]
    return spark.read.schema(T._parse_datatype_string(RESULT)).parquet(*paths)


def _positives(index: DataFrame, own: dict[int, tuple], top: int) -> DataFrame:
    asked = {}
    for size, (places, ids, labels, points) in own.items():
        count = len(places)
        low, high = np.full(count, _LEAST, np.int64), np.full(count, _MOST, np.int64)
        asked[size] = places, (ids, labels, points), np.arange(count), low, high
    return _search(index, asked, top, same=True)


def _negatives(index, own: dict[int, tuple], held: list, good: DataFrame, top: int) -> DataFrame:
    """A window for each positive, numbered by anchor and rank; at most a handful per anchor."""
    spark = index.sparkSession
    pairs = good.where("score >= 0").orderBy("window", "rank").collect()
    windows = np.array([(r["window"], r["score"]) for r in pairs], np.int64).reshape(-1, 2)
    asked = {}
    for size, (places, ids, labels, points) in own.items():
        at = {place: k for k, place in enumerate(places.tolist())}
        names = np.array([k for k, w in enumerate(windows[:, 0].tolist()) if w in at], np.int64)
        if not len(names):
            continue
        anchor = np.array([at[w] for w in windows[names, 0].tolist()], np.int64)
        high = windows[names, 1]
        low = np.array([-(-LOW * s // HIGH) for s in high.tolist()], np.int64)
        asked[size] = names, (ids, labels, points), anchor, low, high
    found = _search(index, asked, top, same=False)
    told = spark.createDataFrame(
        [
            (k, held[r["window"]]["vec_id"], r["vec_id"], r["score"], r["rank"])
            for k, r in enumerate(pairs)
        ],
        "window bigint, anchor_id bigint, positive_id bigint, positive_score bigint, "
        "positive_rank int",
    )
    # One row per window of this round's anchors.
    return found.join(F.broadcast(told), "window").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"), "positive_rank",
    )


RESULT = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
    "negative_score bigint, positive_rank int"
)
