"""Benchmark decontamination with an FM-index of every shard of the training texts.

A task cuts its documents into shards of bounded size. Each shard is indexed once: its words
become symbols, a suffix array gives the Burrows-Wheeler transform, and a wavelet matrix over that
answers ranks. All test phrases are searched backwards at once, the occurrences found are located
by walking to sampled suffix positions, and their word ranges are merged per document.

Only the alphabet of the phrases is indexed: other words, and stretches of known words too short
to hold any phrase, stand as one separator, because no occurrence can touch them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import chunks, free_names, map_rows, strings, text_key
from feedlake.llm.wordhash import ALPHANUMERIC, hash_words

WINDOW = 13  # words of a test phrase
SHARD_BYTES = 4 << 20  # text of one index; a longer text is a shard of its own
SAMPLED = 32  # every 32nd text position is kept for locating
BLOCK_CHARS = 16 << 20  # benchmark text that is searched, and sent to tasks, at a time
SHARE = 20  # contaminated from one hit word in 20 on
RESULT = (
    "n_words bigint, n_hit bigint, spans array<struct<first:bigint,last:bigint>>, "
    "item_ids array<bigint>, other_items bigint"
)


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    fresh = np.r_[False, np.diff(keys[order]) != 0]
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(fresh)
    return order, ranks


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """By prefix doubling; the text must end with a symbol found nowhere else and less than all."""
    order, ranks = _ranks(symbols.astype(np.int64))
    step, size = 1, len(symbols)
    while ranks[order[-1]] < size - 1:
        keys = ranks * (size + 1)
        keys[:-step] += ranks[step:] + 1
        order, ranks = _ranks(keys)
        step *= 2
    return order


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit of the symbol at a time."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels = []
        for bit in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = ((symbols >> bit) & 1).astype(bool)
            before = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(ones, out=before[1:])
            self.levels.append((bit, before, len(symbols) - int(before[-1])))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its position in the sequence."""
        low = np.zeros(len(symbols), np.int64)
        high = ends.astype(np.int64)
        for bit, before, zeros in self.levels:
            one = ((symbols >> bit) & 1).astype(bool)
            low = np.where(one, zeros + before[low], low - before[low])
            high = np.where(one, zeros + before[high], high - before[high])
        return high - low


class FMIndex:
    """Finds phrases of symbols in a text of symbols; 0 parts stretches and is in no phrase."""

    def __init__(self, text: np.ndarray):
        symbols = np.append(text.astype(np.int64) + 1, 0)
        self.size = len(symbols)
        order = suffix_array(symbols)
        self.last = symbols[order - 1]  # position 0 takes the end symbol, as it should
        self.below = np.zeros(int(symbols.max()) + 2, np.int64)
        np.cumsum(np.bincount(symbols), out=self.below[1:])
        self.wavelet = WaveletMatrix(self.last, int(symbols.max()))
        kept = order % SAMPLED == 0
        self.sampled = kept
        self.kept_before = np.r_[0, np.cumsum(kept)]
        self.positions = order[kept]

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each phrase; phrases are rows, aligned right."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        width = phrases.shape[1]
        for back in range(width):
            live = np.flatnonzero((lengths > back) & (low < high))
            if not len(live):
                break
            symbols = phrases[live, width - 1 - back] + 1
            known = symbols < len(self.below) - 1
            high[live[~known]] = low[live[~known]]
            live, symbols = live[known], symbols[known]
            start = self.below[symbols]
            low[live] = start + self.wavelet.rank(symbols, low[live])
            high[live] = start + self.wavelet.rank(symbols, high[live])
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, by steps back to the next sampled one."""
        rows = rows.copy()
        found = np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        steps = 0
        while len(open_):
            done = self.sampled[rows[open_]]
            ready = open_[done]
            found[ready] = self.positions[self.kept_before[rows[ready]]] + steps
            open_ = open_[~done]
            symbols = self.last[rows[open_]]
            rows[open_] = self.below[symbols] + self.wavelet.rank(symbols, rows[open_])
            steps += 1
        return found


@dataclass
class Phrases:
    """Distinct windows of benchmark items over the sorted vocabulary of their words."""

    vocabulary: np.ndarray  # sorted word hashes; a symbol is a place in it, from 1
    windows: np.ndarray  # rows of symbols, aligned right
    lengths: np.ndarray
    owner_first: np.ndarray  # owners[owner_first[w] : owner_first[w + 1]] have window w
    owners: np.ndarray
    ids: list  # item id of each owner


def phrases_of(ids: list, texts: pa.Array, window: int = WINDOW) -> Phrases:
    """All runs of ``window`` words of each item, or the whole item if it has fewer."""
    data, bounds = strings(texts)
    words, _, _, first = hash_words(data, bounds, ALPHANUMERIC)
    vocabulary = np.unique(words)
    symbols = np.searchsorted(vocabulary, words) + 1
    rows: dict[tuple, set] = {}
    for item in range(len(ids)):
        own = symbols[first[item] : first[item + 1]].tolist()
        width = min(window, len(own))
        for start in range(len(own) - width + 1 if own else 0):
            rows.setdefault(tuple(own[start : start + width]), set()).add(item)
    windows = np.zeros((len(rows), window), np.int64)
    for place, row in enumerate(rows):
        windows[place, window - len(row) :] = row
    lengths = np.array([len(row) for row in rows], np.int64)
    owners = [sorted(own) for own in rows.values()]
    owner_first = np.r_[0, np.cumsum([len(own) for own in owners])].astype(np.int64)
    flat = np.array([item for own in owners for item in own], np.int64)
    return Phrases(vocabulary, windows, lengths, owner_first, flat, list(ids))


def _indexed_text(symbols: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """The text to index and, for each of its places, the place in ``symbols``."""
    known = np.r_[False, symbols > 0, False]
    edges = np.flatnonzero(known[1:] != known[:-1])
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= shortest
    keep = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(keep, starts[long], 1)
    np.add.at(keep, ends[long], -1)
    inside = np.cumsum(keep[:-1]) > 0
    inside[ends[long][ends[long] < len(symbols)]] = True  # one separator after each stretch
    places = np.flatnonzero(inside)
    return np.where(symbols[places] > 0, symbols[places], 0), places


def occurrences(symbols: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``symbols`` where windows begin, and which windows."""
    none = np.zeros(0, np.int64)
    if not len(phrases.lengths):
        return none, none
    text, places = _indexed_text(symbols, int(phrases.lengths.min()))
    if not len(text):
        return none, none
    index = FMIndex(text)
    low, high = index.search(phrases.windows, phrases.lengths)
    counts = high - low
    which = np.repeat(np.arange(len(counts)), counts)
    rows = np.repeat(low - np.r_[0, np.cumsum(counts)[:-1]], counts) + np.arange(counts.sum())
    return places[index.locate(rows)], which


def _shard(data: np.ndarray, bounds: np.ndarray, phrases: Phrases):
    """For each document of a shard: words, hit words, merged spans, items."""
    symbols, first = [], [0]
    for low, high in chunks(bounds):
        part = data[bounds[low] : bounds[high]]
        words, _, _, begins = hash_words(part, bounds[low : high + 1] - bounds[low], ALPHANUMERIC)
        if len(phrases.vocabulary):
            near = np.searchsorted(phrases.vocabulary, words)
            near[near == len(phrases.vocabulary)] = 0
            own = np.where(phrases.vocabulary[near] == words, near + 1, 0)
        else:
            own = np.zeros(len(words), np.int64)
        for row in range(high - low):  # a separator ends each document
            symbols.append(np.append(own[begins[row] : begins[row + 1]], 0))
            first.append(first[-1] + len(symbols[-1]))
    first = np.array(first, np.int64)
    flat = np.concatenate(symbols) if symbols else np.zeros(0, np.int64)
    starts, which = occurrences(flat, phrases)
    change = np.zeros(len(flat) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + phrases.lengths[which], -1)
    hit = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
    span_first, span_last = edges[::2], edges[1::2]
    of_span = np.searchsorted(first, span_first, side="right") - 1
    of_hit = np.searchsorted(first, starts, side="right") - 1
    pairs = np.unique(np.stack((of_hit, which)), axis=1)
    spans: list[list] = [[] for _ in range(len(first) - 1)]
    items: list[set] = [set() for _ in range(len(first) - 1)]
    for document, begin, end in zip(of_span, span_first, span_last, strict=True):
        base = first[document]
        spans[document].append({"first": int(begin - base), "last": int(end - base)})
    for document, window in zip(*pairs, strict=True):
        items[document].update(
            phrases.owners[phrases.owner_first[window] : phrases.owner_first[window + 1]].tolist()
        )
    for document in range(len(first) - 1):
        hits = sum(span["last"] - span["first"] for span in spans[document])
        known = {phrases.ids[item] for item in items[document]}
        yield (
            int(first[document + 1] - first[document] - 1),
            hits,
            spans[document],
            sorted(item for item in known if item is not None),
            int(None in known),
        )


def _search_block(docs: DataFrame, phrases: Phrases, text: str) -> DataFrame:
    kinds = [
        pa.int64(),
        pa.int64(),
        pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])),
        pa.list_(pa.int64()),
        pa.int64(),
    ]

    def run(batches):
        for batch in batches:
            data, bounds = strings(batch.column(text))
            for low, high in chunks(bounds, SHARD_BYTES):
                part = data[bounds[low] : bounds[high]]
                rows = list(_shard(part, bounds[low : high + 1] - bounds[low], phrases))
                columns = zip(*rows, strict=True)
                arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
                yield batch.slice(low, high - low), arrays

    return map_rows(docs, RESULT, run)


def _merged(spans):
    """Spans of several blocks in order, those that touch or overlap made one."""
    empty = F.array().cast("array<struct<first:bigint,last:bigint>>")

    def add(done, span):
        top = F.try_element_at(done, F.lit(-1))
        joined = F.struct(top["first"], F.greatest(top["last"], span["last"]).alias("last"))
        touching = top["last"] >= span["first"]
        grown = F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(joined))
        return F.when(F.size(done) == 0, F.array(span)).when(touching, grown).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(F.array_sort(spans), empty, add)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """Adds to every document what it shares with the benchmark.

    ``n_words``; ``n_hit`` words inside any occurrence of a test phrase; ``spans``, the merged word
    ranges (end exclusive) to remove; ``item_ids`` in order, each once; ``other_items``, 1 if an
    item without id occurs; ``contaminated``, from one hit word in 20 on.

    A null or empty text has no words. Items without words are skipped; an item given twice counts
    once. The benchmark is searched in blocks of at most about ``block_chars``, each sent to the
    tasks whole; there is one block unless the benchmark is larger. In the case of several, rows
    of equal id and text are one document while results are put together, and all get it.
    """
    items = benchmark.select(
        F.col("item_id").cast("bigint").alias("item_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_chars))
    found = []
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = own.distinct().toPandas().sort_values(["item_id", "text"])
        ids = [None if id_ != id_ else int(id_) for id_ in rows["item_id"].tolist()]
        phrases = phrases_of(ids, pa.array(rows["text"].tolist(), pa.string()))
        found.append(_search_block(docs, phrases, text))
    out = found[0]
    if blocks > 1:
        doc, own = free_names(docs, "doc", "own")
        parts = [
            df.select(F.col("doc_id").alias(doc), text_key(F.col(text)).alias(own), "n_words", "spans",
                      "item_ids", "other_items")
            for df in found
        ]
        together = parts[0]
        for part in parts[1:]:
            together = together.unionByName(part)
        # Repeated rows give the same in every block, however many they are.
        together = together.distinct().groupBy(doc, own).agg(
            F.max("n_words").alias("n_words"),
            _merged(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("item_ids")))).alias("item_ids"),
            F.max("other_items").alias("other_items"),
        )
        clash = [c for c in docs.columns if c.lower() in {n.lower() for n in together.columns[2:]}]
        left = docs.drop(*clash)
        out = left.join(
            together,
            left["doc_id"].eqNullSafe(together[doc]) & (text_key(left[text]) == together[own]),
        ).drop(doc, own)
        total = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"])
        out = out.withColumn("n_hit", total)
    return out.withColumn(
        "contaminated", (F.col("n_hit") > 0) & (SHARE * F.col("n_hit") >= F.col("n_words"))
    )


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns of ``find_contamination``."""
    listed = F.array_join(F.array_sort(F.transform("item_ids", lambda i: i.cast("string"))), ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        (F.size("item_ids") + F.col("other_items")).cast("bigint").alias("n_items"),
        F.sha2(listed, 256).alias("items_sha256"),
        "contaminated",
    )
