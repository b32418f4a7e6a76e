"""Byte-level BPE in two tiers: a minimal perfect hash for whole words, a heap for the rest.

Text is split into pre-tokens by the vocabulary's pattern. All pre-tokens of a chunk are looked up
at once in a minimal perfect hash over the vocabulary; the hash gives one place to look at, and
the bytes there are compared. Those that are no entry are merged pair by pair: their bytes form a
linked list, and a heap holds the neighbours that can be merged, least rank first, leftmost first.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import chunks, map_rows, strings

# Fixed value: the pattern that splits text for these vocabularies.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
CHUNK = 1 << 18  # pre-tokens that are looked up at once
BATCH = 1 << 22  # bytes of text that are encoded before their ids are handed on
REMEMBERED = 500_000  # words whose merges a process keeps, and as many of those before
REMEMBERED_BYTES = 64  # a longer word is merged each time
_BUCKET = 4  # keys of a bucket of the hash, on average


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file of lines ``<base64 bytes> <rank>``; every single byte must be an entry."""
    with open(path, "rb") as file:
        lines = [line.split() for line in file if line.strip()]
    ranks = {base64.b64decode(word): int(rank) for word, rank in lines}
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"{path} has no entry for {len(missing)} of the 256 single bytes")
    return ranks


def _mixed(value: np.ndarray) -> np.ndarray:
    value = value ^ (value >> np.uint64(31))
    value = value * np.uint64(0x9E3779B97F4A7C15)
    value = value ^ (value >> np.uint64(29))
    value = value * np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(32))


class Words:
    """Byte strings in one buffer, read eight bytes at a time; the last read of each is cut off."""

    def __init__(self, buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        padded = np.concatenate((buffer, np.zeros(8, np.uint8)))
        self._at = np.ndarray((len(buffer) + 1,), "<u8", padded, strides=(1,))
        self._buffer = padded  # keeps the memory of the view
        self.starts, self.sizes = starts, ends - starts

    def parts(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per step the strings that reach it and their next eight bytes, zeros beyond the end."""
        rows, step = np.arange(len(self.starts)), 0
        rows = rows[self.sizes > 0]
        while len(rows):
            left = np.minimum(self.sizes[rows] - 8 * step, 8).astype(np.uint64)
            # A shift by all 64 bits is no shift, so it is made in two.
            half = (np.uint64(8) - left) * np.uint64(4)
            value = self._at[self.starts[rows] + 8 * step]
            yield step, rows, ((value << half) << half) >> half >> half
            step += 1
            rows = rows[self.sizes[rows] > 8 * step]

    def of(self, rows: np.ndarray) -> Words:
        """Some of the words, over the same buffer."""
        out = Words.__new__(Words)
        out._at, out._buffer = self._at, self._buffer
        out.starts, out.sizes = self.starts[rows], self.sizes[rows]
        return out

    def distinct(self, rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One of ``rows`` for each different word, and the place there of each row's word."""
        _, first, same = np.unique(hashes, return_index=True, return_inverse=True)
        chosen = rows[first]
        apart = ~self.of(rows).equal(self.of(chosen[same]))
        if apart.any():  # other words of the same hash stand for themselves
            others = np.flatnonzero(apart)
            same[others] = len(chosen) + np.arange(len(others))
            chosen = np.concatenate((chosen, rows[others]))
        return chosen, same

    def equal(self, other: Words) -> np.ndarray:
        """Which words are the same as the other's at the same place."""
        out = self.sizes == other.sizes
        rows = np.flatnonzero(out)
        for (_, at, a), (_, _, b) in zip(
            self.of(rows).parts(), other.of(rows).parts(), strict=True
        ):
            out[rows[at]] &= a == b
        return out

    def hashes(self, seed: int) -> np.ndarray:
        out = _mixed(self.sizes.astype(np.uint64) + np.uint64(seed))
        for _, rows, value in self.parts():
            out[rows] = _mixed(out[rows] ^ value)
        return out


class PerfectHash:
    """A minimal perfect hash over the vocabulary: n keys, n places, none left empty.

    Keys fall into buckets; per bucket one number is stored that moves its keys to places still
    free. Large buckets are placed first, by trying numbers in order; a bucket of one key just names
    its place. Places hold the key's bytes and rank, so that a string that is no key is told apart.
    """

    def __init__(self, ranks: dict[bytes, int]):
        keys = list(ranks)
        sizes = np.fromiter(map(len, keys), np.int64, len(keys))
        ends = np.cumsum(sizes)
        buffer = np.frombuffer(b"".join(keys), np.uint8)
        words = Words(buffer, ends - sizes, ends)
        self.count = len(keys)
        self.buckets = -(-self.count // _BUCKET)
        for seed in range(1, 100):
            hashes = words.hashes(seed)
            if len(np.unique(hashes)) == self.count:
                self.seed = seed
                break
        else:
            raise ValueError("keys are not told apart by any seed")
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        by_bucket = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[by_bucket], np.arange(self.buckets + 1))
        self.moves = np.zeros(self.buckets, np.int64)
        place = np.full(self.count, -1)
        free = np.ones(self.count, bool)
        sized = np.diff(edges)
        for b in np.argsort(-sized, kind="stable"):
            own = by_bucket[edges[b] : edges[b + 1]]
            if len(own) < 2:
                break
            first = 0
            while True:
                tried = np.arange(first, first + 64, dtype=np.uint64)
                at = self._moved(hashes[own][None, :], tried[:, None])
                ordered = np.sort(at, axis=1)
                good = free[at].all(1) & (ordered[:, 1:] != ordered[:, :-1]).all(1)
                if good.any():
                    move = int(good.argmax())
                    break
                first += 64
            self.moves[b] = first + move
            place[own], free[at[move]] = at[move], False
        alone = np.flatnonzero(sized == 1)
        left = np.flatnonzero(free)
        place[by_bucket[edges[alone]]] = left
        self.moves[alone] = -1 - left
        # The entries in the order of their places.
        order = np.argsort(place)
        self.ranks = np.fromiter(ranks.values(), np.int64, self.count)[order]
        self.sizes = sizes[order]
        self.starts = (ends - sizes)[order]
        self.buffer = buffer

    def _moved(self, hashes: np.ndarray, moves: np.ndarray) -> np.ndarray:
        odd = moves * np.uint64(2) + np.uint64(1)
        return (_mixed(hashes * odd + odd) % np.uint64(self.count)).astype(np.int64)

    def find(self, words: Words, hashes: np.ndarray) -> np.ndarray:
        """Rank of each word, -1 for those that are no key."""
        move = self.moves[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        moved = self._moved(hashes, np.maximum(move, 0).astype(np.uint64))
        place = np.where(move < 0, -1 - move, moved)
        starts = self.starts[place]
        entries = Words(self.buffer, starts, starts + self.sizes[place])
        return np.where(words.equal(entries), self.ranks[place], -1)


def merge(word: bytes, pair: list[int], ranks: dict[bytes, int]) -> list[int]:
    """Ranks of a word's parts once no neighbours can be merged any more.

    ``pair`` has the rank that each byte would have together with the next one, -1 for none and at
    the end; it is used up. ``ends`` and ``before`` link the parts that are left by their first
    bytes. An entry of the heap is a rank and a first byte in one number, and out of date where the
    pair there has another rank by now.
    """
    size, get, push, pop = len(word), ranks.get, heapq.heappush, heapq.heappop
    bits = size.bit_length()
    mask = (1 << bits) - 1
    own = [-1] * size
    ends = list(range(1, size + 1))
    before = list(range(-1, size))
    heap = [rank << bits | first for first, rank in enumerate(pair) if rank >= 0]
    heapq.heapify(heap)
    while heap:
        entry = pop(heap)
        first, rank = entry & mask, entry >> bits
        if pair[first] != rank:
            continue
        second = ends[first]
        end = ends[first] = ends[second]
        own[first] = rank
        pair[second] = pair[first] = -1
        before[end] = first
        if end < size:
            after = get(word[first : ends[end]])
            if after is not None:
                pair[first] = after
                push(heap, after << bits | first)
        if first:
            left = before[first]
            after = get(word[left:end])
            if after is None:
                pair[left] = -1
            else:
                pair[left] = after
                push(heap, after << bits | left)
    out, first = [], 0
    while first < size:
        rank = own[first]
        out.append(rank if rank >= 0 else ranks[word[first : first + 1]])
        first = ends[first]
    return out


class _Remembered:
    """Merges of the words met last, in two generations, so that their number is bounded."""

    def __init__(self):
        self.newer: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def add(self, word: bytes, ids: bytes) -> None:
        if len(self.newer) >= REMEMBERED:
            self.older, self.newer = self.newer, {}
        self.newer[word] = ids


_REMEMBERED: dict[str, _Remembered] = {}  # by vocabulary, for all tasks of a process


class Codec:
    """Encoder and decoder of one vocabulary; a task makes it from what the driver sends along."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks, self.pattern = ranks, pattern
        self.table = PerfectHash(ranks)
        named = repr(sorted(ranks.items())).encode()
        self.name = hashlib.sha256(named).hexdigest()

    def open(self) -> Codec:
        """Makes what only a task needs; nothing of it is sent."""
        self._split = regex.compile(self.pattern)
        #: Ranks of all pairs of bytes, -1 for those that are no entry.
        self._pairs = np.full(1 << 16, -1, np.int32)
        for word, rank in self.ranks.items():
            if len(word) == 2:
                self._pairs[word[0] << 8 | word[1]] = rank
        self._remembered = _REMEMBERED.setdefault(self.name, _Remembered())
        return self

    def __getstate__(self) -> dict:
        return {name: value for name, value in vars(self).items() if name[0] != "_"}

    def _merged(self, data: np.ndarray, starts: list[int], ends: list[int]) -> list[bytes]:
        """Packed ids of words that are no entries."""
        content, held, out = data.tobytes(), self._remembered, []
        wide = data.astype(np.int64)
        pairs = self._pairs[wide[:-1] << 8 | wide[1:]]
        for first, end in zip(starts, ends, strict=True):
            word = content[first:end]
            found = held.newer.get(word)
            if found is None:
                found = held.older.get(word)
                if found is None:
                    pair = pairs[first : end - 1].tolist()
                    pair.append(-1)
                    found = np.array(merge(word, pair, self.ranks), np.int32).tobytes()
                if end - first <= REMEMBERED_BYTES:
                    held.add(word, found)
            out.append(found)
        return out

    def ids(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of consecutive pre-tokens that end at ``ends``, and how many each has."""
        starts = np.concatenate(([0], ends[:-1]))
        words = Words(data, starts, ends)
        hashes = words.hashes(self.table.seed)
        found = self.table.find(words, hashes)
        missed = np.flatnonzero(found < 0)
        if not len(missed):
            return found.astype(np.int32), np.ones(len(ends), np.int64)
        # Equal words are merged once per chunk.
        first, same = words.distinct(missed, hashes[missed])
        parts = self._merged(data, starts[first].tolist(), ends[first].tolist())
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) >> 2
        merged, begin = np.frombuffer(b"".join(parts), np.int32), np.cumsum(sizes) - sizes
        counts = np.ones(len(ends), np.int64)
        counts[missed] = sizes[same]
        begins = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), np.int32)
        hit = found >= 0
        out[begins[hit]] = found[hit]
        sizes = sizes[same]
        inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[np.repeat(begins[missed], sizes) + inner] = merged[np.repeat(begin[same], sizes) + inner]
        return out, counts

    def pieces(self, text: str) -> Iterator[list[int]]:
        """Lengths in characters of the pre-tokens of a text, at most ``CHUNK`` at a time."""
        if len(text) <= 1 << 20:
            yield list(map(len, self._split.findall(text)))
            return
        spans = (m.end() - m.start() for m in self._split.finditer(text))
        while part := list(islice(spans, CHUNK)):
            yield part

    def encode_column(self, column: pa.Array) -> pa.Array:
        """Ids of every text; a null text is encoded like an empty one."""
        data, bounds = strings(column)
        lead = (data & 0xC0) != 0x80
        sizes: list[int] = []  # pre-token lengths waiting to be looked up
        out: list[np.ndarray] = []
        per_row = np.zeros(len(column), np.int64)
        owners: list[tuple[int, int]] = []  # rows of the waiting pre-tokens and how many each
        at = 0  # first byte of what waits

        def look_up() -> int:
            nonlocal sizes, owners
            chars = np.cumsum(np.array(sizes, np.int64))
            # Byte at which each character of the waiting range begins, found by lead bytes.
            stop = at
            window = CHUNK * 4
            begins: list[np.ndarray] = []
            seen = 0
            while seen <= int(chars[-1]) and stop < len(data):
                here = np.flatnonzero(lead[stop : stop + window]) + (stop - at)
                begins.append(here)
                seen += len(here)
                stop += window
            places = np.concatenate([*begins, [len(data) - at]])
            ends = places[chars]
            ids, counts = self.ids(data[at : at + int(ends[-1])], ends)
            totals = np.concatenate(([0], np.cumsum(counts)))
            first = 0
            for row, count in owners:
                per_row[row] += totals[first + count] - totals[first]
                first += count
            out.append(ids)
            end = at + int(ends[-1])
            sizes, owners = [], []
            return end

        for row in range(len(column)):
            text = column[row].as_py()
            if not text:
                continue
            for part in self.pieces(text):
                sizes += part
                owners.append((row, len(part)))
                if len(sizes) >= CHUNK:
                    at = look_up()
        if sizes:
            look_up()
        values = np.concatenate(out) if out else np.zeros(0, np.int32)
        offsets = np.concatenate(([0], np.cumsum(per_row))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))

    def decode_column(self, column: pa.Array) -> pa.Array:
        """Bytes of every list of ids; null for a null list or one that holds an unknown id."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        table = self.table
        at = np.full(int(table.ranks.max()) + 1, -1)
        at[table.ranks] = np.arange(table.count)
        sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ids = column.flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        known = (ids >= 0) & (ids < len(at))
        place = np.where(known, at[np.where(known, ids, 0)], -1)
        ends = np.cumsum(sizes, dtype=np.int64)
        unknown = np.concatenate(([0], np.cumsum(place < 0)))
        bad = (unknown[ends] - unknown[ends - sizes] > 0) | column.is_null().to_numpy(
            zero_copy_only=False
        )
        words = table.buffer.tobytes()
        entries = [words[s : s + n] for s, n in zip(table.starts, table.sizes, strict=True)]
        cells = [
            None if bad[row] else b"".join([entries[k] for k in place[end - size : end].tolist()])
            for row, (end, size) in enumerate(zip(ends.tolist(), sizes.tolist(), strict=True))
        ]
        return pa.array(cells, pa.binary())


def load(path: str, pattern: str = PATTERN) -> Codec:
    """The codec of a vocabulary file, read at the driver; tasks get it with their code (2 MB)."""
    return Codec(read_ranks(path), pattern)


def _slices(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch, a bounded amount of text at a time; a longer text is alone."""
    _, bounds = strings(batch.column(text))
    for first, last in chunks(bounds, BATCH):
        yield batch.slice(first, last - first)


def encode(
    docs: DataFrame,
    codec: Codec,
    text: str = "text",
    keep: Sequence[str] | None = None,
    decoded: bool = False,
) -> DataFrame:
    """Adds ``ids``, the token ids of the whole text, to the columns of ``keep`` (all by default).

    With ``decoded`` the ids are decoded again in the same pass, into a column of that name. A null
    or empty text has no ids and decodes to no bytes. Other columns stay as they are, but those
    named like a result give way. Repeated rows are encoded each. Text that looks like a special
    token is ordinary text. A very long text is looked up part by part. An empty table gives no
    rows.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        own = codec.open()
        for batch in batches:
            for part in _slices(batch, batch.schema.get_field_index(held)):
                ids = own.encode_column(part.column(held))
                yield part, [ids, own.decode_column(ids)] if decoded else [ids]

    kept = list(docs.columns if keep is None else keep)
    held = "_text_to_encode"
    while held in docs.columns:
        held += "_"
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).cast("string").alias(held))
    results = "ids array<int>, decoded binary" if decoded else "ids array<int>"
    return map_rows(rows, results, run, kept)


def decode(docs: DataFrame, codec: Codec, ids: str = "ids") -> DataFrame:
    """Adds ``decoded``, the bytes that the ids stand for; null where an id is unknown or null."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            yield batch, [codec.decode_column(batch.column("_bpe_ids"))]

    held = docs.withColumn("_bpe_ids", F.col(ids).cast("array<int>"))
    return map_rows(held, "decoded binary", run).drop("_bpe_ids")


def digest(encoded: DataFrame) -> DataFrame:
    """Counts and hashes of encoded and decoded rows."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
