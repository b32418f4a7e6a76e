"""Quality classifier on learned subword embeddings.

Words, pairs of words and byte n-grams are hashed into buckets; every bucket has a learned vector,
a document is the mean of its features' vectors, and a softmax layer gives the class. Both layers
are trained by stochastic gradient descent. As the mean and the output layer are linear, scoring
needs one number for each bucket, their product, so a document is scored by one pass of lookups.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import bucket_of, chunks, map_rows, strings, text_key
from feedlake.llm.wordhash import IDENTITY, NOT_BLANK, hash_words

SAMPLE = 4000  # labelled rows that training sees, at most about
LONGEST_SAMPLE = 100_000  # characters; longer texts are left out of the sample, never of scoring
BITS = 17
DIMENSIONS = 8
STEPS = 1000  # gradient steps, whatever the size of the sample
BATCH = 32
RATE = 4.0
FOLDS, HELD_OUT = 3, 1
_SHIFT = np.uint64(64 - BITS)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_TURN = np.uint64(0xD6E8FEB86659FD93)


def _byte_grams(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs of three and of five bytes."""
    wide = data.astype(np.uint64)
    if len(wide) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    three = wide[:-2] | (wide[1:-1] << np.uint64(8)) | (wide[2:] << np.uint64(16))
    five = three[:-2] | (wide[3:-1] << np.uint64(24)) | (wide[4:] << np.uint64(32))
    five = five + np.uint64(1 << 40)
    return tuple(((x * _ODD) >> _SHIFT).astype(np.int64) for x in (three, five))


def _features(data: np.ndarray, bounds: np.ndarray):
    """For each kind of feature its buckets and, for each text, the range that is its own."""
    words, _, _, first = hash_words(data, bounds, NOT_BLANK, IDENTITY)
    yield (words >> _SHIFT).astype(np.int64), first[:-1], first[1:]
    if len(words) > 1:
        pairs = (words[:-1] * _TURN + words[1:]) * _ODD >> _SHIFT
        pairs[words[:-1] == words[1:]] = 0  # any word said twice in a row is one feature
        yield pairs.astype(np.int64), first[:-1], np.maximum(first[1:] - 1, first[:-1])
    for grams, width in zip(_byte_grams(data), (3, 5), strict=True):
        if len(grams):
            yield grams, bounds[:-1], np.maximum(bounds[1:] - width + 1, bounds[:-1])


def bags(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets of each text with their shares of its features."""
    data, bounds = strings(texts)
    out = []
    for row in range(len(bounds) - 1):
        own = data[bounds[row] : bounds[row + 1]]
        parts = [
            buckets[lows[0] : highs[0]]
            for buckets, lows, highs in _features(own, np.array([0, len(own)]))
        ]
        buckets, counts = np.unique(np.concatenate(parts), return_counts=True)
        out.append((buckets, (counts / max(counts.sum(), 1)).astype(np.float32)))
    return out


@dataclass
class QualityModel:
    margin: np.ndarray  # of each bucket: output for class 1 less that for class 0
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        data, bounds = strings(texts)
        out = np.empty(len(bounds) - 1)
        for first, last in chunks(bounds):
            part = data[bounds[first] : bounds[last]]
            total, count = np.zeros(last - first), np.zeros(last - first)
            for buckets, lows, highs in _features(part, bounds[first : last + 1] - bounds[first]):
                values = self.margin[buckets]
                for row, (low, high) in enumerate(zip(lows, highs, strict=True)):
                    total[row] += values[low:high].sum(dtype=np.float64)
                count += highs - lows
            out[first:last] = total / np.maximum(count, 1)
        return 1 / (1 + np.exp(-np.clip(out + self.bias, -500, 500)))


def fit(texts: pa.Array, labels: np.ndarray, seed: int = 7) -> QualityModel:
    """Gradient descent over shuffled batches with a falling rate; rows come in a fixed order."""
    draw = np.random.default_rng(seed)
    vectors = ((draw.random((1 << BITS, DIMENSIONS)) - 0.5) / DIMENSIONS).astype(np.float32)
    output = ((draw.random((DIMENSIONS, 2)) - 0.5) / DIMENSIONS).astype(np.float32)
    bias = np.zeros(2, np.float32)
    if len(labels):
        share = np.clip(np.array([1 - labels.mean(), labels.mean()]), 1e-3, 1)
        bias = np.log(share).astype(np.float32)
    rows = bags(texts)
    truth = np.eye(2, dtype=np.float32)[labels.astype(int)] if len(labels) else np.zeros((0, 2))
    order, done = np.zeros(0, np.int64), 0
    while done < STEPS and rows:
        if not len(order):
            order = draw.permutation(len(rows))
        batch, order = order[:BATCH], order[BATCH:]
        rate = RATE * (1 - done / STEPS)
        hidden = np.stack([rows[k][1] @ vectors[rows[k][0]] for k in batch])
        logits = hidden @ output + bias
        odds = np.exp(logits - logits.max(1, keepdims=True))
        error = odds / odds.sum(1, keepdims=True) - truth[batch]
        back = error @ output.T
        output -= rate / len(batch) * (hidden.T @ error)
        bias -= 0.1 * rate / len(batch) * error.sum(0)
        for k, pull in zip(batch, back, strict=True):
            buckets, shares = rows[k]
            vectors[buckets] -= rate * shares[:, None] * pull
        done += 1
    margin = vectors @ (output[:, 1] - output[:, 0])
    return QualityModel(margin.astype(np.float32), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> QualityModel:
    """Fits on about ``sample`` labelled rows outside the held-out fold.

    The ids of the smallest hashes are taken, so the sample does not depend on the order of rows
    and its size not on the tables'. Rows without id, text or label are not learned from; an id
    labelled twice has the label most of its rows give, 1 in a tie; of texts of one id each counts.
    """
    known = (
        labels.where("quality in (0, 1)")
        .where(bucket_of(F.col("doc_id"), FOLDS) != HELD_OUT)
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("quality"))
    )
    total = known.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    ids = known.where(draw * total < sample)
    learnable = docs.where(f"text is not null and length(text) <= {LONGEST_SAMPLE}").select(
        "doc_id", text_key(F.col("text")).alias("key"), "text"
    )
    # Narrow keys first: copies of a row, however many, are one, and many texts under one id end at
    # twice the sample. Only texts of the keys chosen move.
    labelled = F.broadcast(ids)  # about `sample` ids, whatever the tables hold
    chosen = (
        learnable.select("doc_id", "key").join(labelled, "doc_id").distinct()
        .orderBy("doc_id", "key").limit(2 * sample)
    )
    rows = (
        learnable.join(F.broadcast(chosen), ["doc_id", "key"])
        .dropDuplicates(["doc_id", "key"])
        .toPandas()
        .sort_values(["doc_id", "text"])
    )
    texts = pa.array(rows["text"].tolist(), pa.string())
    return fit(texts, rows["quality"].to_numpy(dtype=np.int64))


def score(docs: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """Adds ``score`` (0 to 1, likelihood of label 1) and ``predicted`` (1 from 0.5 on).

    Null and empty texts have no features and get the score of the bias alone. Columns of these
    two names in the input give way.
    """

    def run(batches):
        for batch in batches:
            scores = model.scores(batch.column(text))
            yield batch, (pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)))

    return map_rows(docs, "score double, predicted int", run)
