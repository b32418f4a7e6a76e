"""Language identification with a string kernel.

Texts are compared by which character n-grams they hold (blended spectrum of one, two and three
characters, presence only, normalised by the numbers of n-grams). A Nyström approximation on
landmark texts turns that kernel into short vectors, on which a one-versus-rest kernel ridge
regression is solved in closed form. Scoring multiplies whole batches of presence rows with the
landmarks, then with the regression weights.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.common import map_rows, text_key

PER_LANGUAGE = 300  # rows of each language that the fit sees, at most about
LONGEST_SAMPLE = 100_000  # characters; longer texts are left out of the sample, never of scoring
LANDMARKS = 192
VOCABULARY = 8192
RIDGE = 1e-3
UNKNOWN = "und"
ROWS = 256  # texts scored by one matrix product
_BITS = 18
_LETTER = re.compile(r"[^\W\d_]")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_GROUND: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Which code points below 2**16 are letters; those above count as letters."""
    if "letters" not in _GROUND:
        flags = np.fromiter((chr(code).isalpha() for code in range(1 << 16)), bool, 1 << 16)
        _GROUND["letters"] = flags
    return _GROUND["letters"]


def ngram_buckets(text: str) -> np.ndarray:
    """Buckets of all n-grams of one to three characters; what is no letter counts as a blank."""
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    codes = codes.astype(np.uint64)
    low = codes < (1 << 16)
    codes[low & ~_letters()[np.where(low, codes, 0)]] = 32
    codes = codes[~((codes == 32) & np.r_[False, codes[:-1] == 32])]
    singles = codes
    pairs = codes[:-1] | (codes[1:] << np.uint64(21))
    triples = pairs[:-1] | (codes[2:] << np.uint64(42))
    return (np.concatenate((singles, pairs, triples)) * _ODD) >> np.uint64(64 - _BITS)


@dataclass
class LanguageModel:
    languages: list[str]
    column_of: np.ndarray  # bucket to column of the presence matrix, or to the last, unused one
    landmarks: np.ndarray  # columns by landmarks, 0 or 1
    weights: np.ndarray  # landmarks by languages

    def presence(self, texts: list[str]) -> np.ndarray:
        width = self.landmarks.shape[0]
        rows = np.zeros((len(texts), width + 1), np.float32)
        for row, text in zip(rows, texts, strict=True):
            row[self.column_of[ngram_buckets(text)]] = 1
        return rows[:, :width]

    def kernel(self, rows: np.ndarray) -> np.ndarray:
        sizes = np.sqrt(np.maximum(rows.sum(1), 1))
        marks = self.landmarks.astype(np.float32)
        return (rows @ marks) / sizes[:, None] / np.sqrt(np.maximum(marks.sum(0), 1))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text; ``und`` and 0 where it is null or has no letter."""
        names = [UNKNOWN] * len(texts)
        scores = np.zeros(len(texts))
        told = [k for k, text in enumerate(texts) if text and _LETTER.search(text)]
        if not told or not self.languages:
            return names, scores
        values = self.kernel(self.presence([texts[k] for k in told])) @ self.weights
        # Short texts have small kernel values; only how the languages compare matters.
        scale = np.abs(values).max(1, keepdims=True)
        odds = np.exp(4 * values / np.where(scale > 0, scale, 1))
        shares = odds / odds.sum(1, keepdims=True)
        best = shares.argmax(1)
        for k, language, share in zip(told, best, shares.max(1), strict=True):
            names[k], scores[k] = self.languages[language], share
        return names, scores


def fit(texts: list[str], languages: list[str]) -> LanguageModel:
    """The closed-form fit on sampled rows, which must be in a fixed order."""
    names = sorted(set(languages))
    seen = np.zeros(1 << _BITS, np.int64)
    for text in texts:  # made again below: all at once they would fill the driver
        seen[np.unique(ngram_buckets(text)).astype(np.int64)] += 1
    chosen = np.argsort(-seen, kind="stable")[: min(VOCABULARY, int((seen > 0).sum()))]
    width = max(len(chosen), 1)
    column_of = np.full(1 << _BITS, width, np.int32)
    column_of[chosen] = np.arange(len(chosen))
    if not texts:
        return LanguageModel([], column_of, np.zeros((width, 1), np.uint8), np.zeros((1, 0)))
    presence = np.zeros((len(texts), width + 1), np.float32)
    for row, text in zip(presence, texts, strict=True):
        row[column_of[ngram_buckets(text)]] = 1
    presence = presence[:, :width]
    picks = np.linspace(0, len(texts) - 1, min(LANDMARKS, len(texts))).astype(int)
    model = LanguageModel(names, column_of, presence[picks].T.astype(np.uint8), np.zeros((1, 1)))
    kernel = model.kernel(presence).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel[picks])
    useful = values > max(values.max(), 0) * 1e-6
    root = vectors[:, useful] / np.sqrt(values[useful])
    features = kernel @ root
    targets = np.where(np.array(languages)[:, None] == np.array(names)[None, :], 1.0, -1.0)
    gram = features.T @ features + RIDGE * len(texts) * np.eye(features.shape[1])
    model.weights = (root @ np.linalg.solve(gram, features.T @ targets)).astype(np.float32)
    return model


def train(rows: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Fits on a bounded sample of ``rows`` (text, lang).

    Every language gives about ``per_language`` different texts, those of the smallest hash, and
    never more than twice as many; so languages weigh alike, and neither copies nor the order of
    rows change the sample. Rows without a text, a language or a letter, and texts beyond
    ``LONGEST_SAMPLE`` characters, are not learned from.

    The draw is made on narrow keys of language and text. Only the texts drawn are moved, and copies
    of one collapse before that. What is broadcast is a count per language, then the keys drawn.
    """
    usable = (
        rows.select("text", "lang")
        .where(
            "lang is not null and text rlike '\\\\p{L}' and length(text) <= "
            + str(LONGEST_SAMPLE)
        )
        .withColumn("k", text_key(F.col("text")))
    )
    keys = usable.select("lang", "k").distinct()
    sizes = keys.groupBy("lang").agg(F.count("*").alias("n"))
    draw = F.pmod(F.col("k"), F.lit(1 << 30)) / float(1 << 30)
    drawn = keys.join(F.broadcast(sizes), "lang").where(draw * F.col("n") < per_language)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(draw, "k"))
    chosen = drawn.withColumn("rank", rank).where(F.col("rank") <= 2 * per_language)
    sample = (
        usable.join(F.broadcast(chosen.select("lang", "k")), ["lang", "k"])
        .groupBy("lang", "k")
        .agg(F.min("text").alias("text"))
        .toPandas()
        .sort_values(["lang", "k"])
    )
    return fit(sample["text"].tolist(), sample["lang"].tolist())


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (0 to 1) to every row, whatever else the row holds.

    Null texts, empty texts and texts without a letter give ``und`` and 0. Equal texts give equal
    results. Columns of these two names in the input give way.
    """

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                names, scores = model.predict(part.column(text).to_pylist())
                yield part, (pa.array(names, pa.string()), pa.array(scores, pa.float64()))

    return map_rows(docs, "lang_pred string, score double", run)
