"""Token sequences in training order, written as fixed-stride shards.

Documents are encoded with a public tokenizer and cut into sequences of fixed length. A sequence's
index is its place in the order of ids and texts, whatever the partitioning; a keyed Feistel
network with cycle walking permutes the indexes and so gives every sequence its global slot. Ranges
of slots become shards: the record of slot ``s`` is in shard ``s // per_shard`` at byte
``(s % per_shard) * stride``. A reader needs no index, and resumes at any slot.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedlake.llm.common import text_key
from feedlake.plans.shared import settle

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"  # of byte-level BPE; a parameter everywhere
# The vocabulary's splitting pattern and its free id, used as end of document.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
END = 50256
LENGTH = 512  # tokens of a sequence
PER_SHARD = 1024  # sequences of a shard
RANGE = 128  # shards of a range that a task writes, about, where there are many
ROUNDS = 6
ROWS = 512  # documents that are encoded or cut before they are handed on
# One record: doc_id, part and number of tokens as little-endian integers, then the tokens.
HEAD = np.dtype([("doc_id", "<i8"), ("part", "<i4"), ("n_tokens", "<i4")])
NO_ID = -(1 << 63)  # stands for a null id in records
SHARD = (
    "shard_id bigint, first_slot bigint, n_sequences bigint, n_tokens bigint, stride int, "
    "sha256 string, doc_ids array<bigint>, payload binary"
)


def record_type(length: int = LENGTH) -> np.dtype:
    return np.dtype(HEAD.descr + [("tokens", "<u2", (length,))])


_ENCODERS: dict[str, object] = {}


def encoder(ranks: str = RANKS):
    """The tokenizer of a ranks file, made once per process."""
    if ranks not in _ENCODERS:
        import tiktoken

        lines = Path(ranks).read_bytes().splitlines()
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _ENCODERS[ranks] = tiktoken.Encoding(
            "ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}
        )
    return _ENCODERS[ranks]


PIECE = 1 << 20  # characters of a text that are encoded at once
_CUT = re.compile(r"(?<=\S) (?=\S)")  # no token spans a cut before such a blank


def encode(text: str, ranks: str = RANKS) -> np.ndarray:
    """Token ids of one text with the end token; a very long text is encoded piece by piece."""
    own, pieces, first = encoder(ranks), [], 0
    while first < len(text):
        cut = _CUT.search(text, first + PIECE) if len(text) - first > PIECE else None
        last = cut.start() if cut else len(text)
        pieces.append(np.array(own.encode_ordinary(text[first:last]), "<u2"))
        first = last
    pieces.append(np.array([END], "<u2"))
    return np.concatenate(pieces)


def feistel(indexes: np.ndarray, count: int, key: int) -> np.ndarray:
    """A keyed permutation of ``range(count)``, applied to ``indexes``.

    The network permutes the next power of four; a result that is no index is permuted again,
    fewer than four times on average, until it is one.
    """
    half = max(1, -(-max(count - 1, 1).bit_length() // 2))
    shift, mask = np.uint64(half), np.uint64((1 << half) - 1)
    digest = hashlib.sha256(key.to_bytes(16, "little", signed=True)).digest() * 2
    keys = np.frombuffer(digest, "<u8")[:ROUNDS]
    out = indexes.astype(np.uint64)
    walking = np.arange(len(out))
    while len(walking):
        value = out[walking]
        left, right = value >> shift, value & mask
        for round_key in keys:
            noise = (right + round_key) * np.uint64(0x9E3779B97F4A7C15)
            noise ^= noise >> np.uint64(29)
            noise *= np.uint64(0xBF58476D1CE4E5B9)
            noise ^= noise >> np.uint64(32)
            left, right = right, left ^ (noise & mask)
        out[walking] = (left << shift) | right
        walking = walking[out[walking] >= count]
    return out.astype(np.int64)


def encoded(docs: DataFrame, text: str, length: int, ranks: str) -> DataFrame:
    """One row per document: doc_id, text_key, parts (its sequences) and its packed tokens."""
    keyed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text_key(F.col(text)).alias("text_key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                whole = [encode(value.as_py(), ranks) for value in part.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_key"),
                        pa.array([-(-len(own) // length) for own in whole], pa.int32()),
                        pa.array([pack(own.tobytes()) for own in whole], pa.binary()),
                    ],
                    ["doc_id", "text_key", "parts", "tokens"],
                )

    return keyed.mapInArrow(run, "doc_id bigint, text_key bigint, parts int, tokens binary")


def first_indexes(rows: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """The index of each document's first sequence, as ``begin`` of its range plus ``first``.

    Narrow keys are range-sorted, sequences are counted up within each range, and the result is
    settled: row, range, first. Only one total per range reaches the driver. Rows equal in id and
    text have equal tokens, so which of them comes first makes no difference.
    """
    keys = ["doc_id", "text_key", "row"]
    narrow = rows.select(*keys, "parts")
    ordered = narrow.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            parts = batch.column("parts").to_numpy().astype(np.int64)
            ends = seen + np.cumsum(parts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(np.full(len(parts), own), pa.int32()),
                    pa.array(ends - parts, pa.int64()),
                    pa.array(ends, pa.int64()),
                ],
                ["row", "range", "first", "end"],
            )
            seen = int(ends[-1]) if len(ends) else seen

    counted = settle(
        ordered.mapInArrow(run, "row bigint, range int, first bigint, end bigint"), "token_order"
    )
    totals = counted.groupBy("range").agg(F.max("end").alias("n")).collect()
    total, begin = 0, {}
    for r in sorted(totals, key=lambda r: r["range"]):
        begin[r["range"]] = total
        total += r["n"]
    begin[-1] = total
    return counted.drop("end"), begin


def slotted(rows: DataFrame, key: int, length: int) -> tuple[DataFrame, int]:
    """One row per sequence with its global slot, from settled documents with a ``row`` number.

    The number of sequences comes along.

    Whole documents meet their first index; they are cut into sequences behind that join.
    """
    firsts, begin = first_indexes(rows)
    count = begin.pop(-1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = batch.slice(at, ROWS)
                parts = rows.column("parts").to_numpy().astype(np.int64)
                begins = np.array([begin[r] for r in rows.column("range").to_pylist()], np.int64)
                first = begins + rows.column("first").to_numpy()
                within = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
                slots = feistel(np.repeat(first, parts) + within, count, key)
                sizes, cells = [], []
                for cell in rows.column("tokens"):
                    own = np.frombuffer(unpack(cell.as_py()), "<u2")
                    cut = [own[k : k + length] for k in range(0, len(own), length)]
                    sizes += map(len, cut)
                    cells += [pack(c.tobytes()) for c in cut]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id").take(pa.array(np.repeat(np.arange(len(parts)), parts))),
                        pa.array(within, pa.int32()),
                        pa.array(sizes, pa.int32()),
                        pa.array(slots, pa.int64()),
                        pa.array(cells, pa.binary()),
                    ],
                    ["doc_id", "part", "n_tokens", "slot", "tokens"],
                )

    found = rows.join(firsts, "row").mapInArrow(
        run, "doc_id bigint, part int, n_tokens int, slot bigint, tokens binary"
    )
    return found, count


def write_order(
    docs: DataFrame,
    key: int = 0,
    length: int = LENGTH,
    per_shard: int = PER_SHARD,
    ranks: str = RANKS,
    text: str = "text",
) -> DataFrame:
    """The shards of all ``docs``: one row each with its payload of fixed-stride records.

    Each partition of the result is a range of slots, in order: written as Parquet, a file holds
    neighbouring shards, and a reader of a range of slots skips the others by their statistics.

    ``doc_ids`` has the distinct ids in a shard, in order, without those that are null.

    Every document ends with the end token, so a null or empty text is one sequence of that token
    alone. Repeated rows give repeated sequences. A null id is ``NO_ID`` in records. The unused rest
    of a record is filled with the end token. An empty table gives no shard.
    """
    numbered = encoded(docs, text, length, ranks).withColumn(
        "row", F.monotonically_increasing_id()
    )
    rows = settle(numbered, "token_documents")
    placed, count = slotted(rows, key, length)
    shards = -(-count // per_shard)
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), shards // RANGE)
    wide = max(1, -(-shards // tasks))  # shards of a range
    ranges = max(1, -(-shards // wide))
    ordered = (
        placed.withColumn("shard_id", F.floor(F.col("slot") / per_shard).cast("bigint"))
        .repartitionById(ranges, F.floor(F.col("shard_id") / wide).cast("int"))
        .sortWithinPartitions("slot")
    )
    kind = record_type(length)

    def shard(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        records = np.zeros(len(table), kind)
        records["tokens"] = END
        records["doc_id"] = table.column("doc_id").fill_null(NO_ID).to_numpy()
        records["part"] = table.column("part").to_numpy()
        records["n_tokens"] = table.column("n_tokens").to_numpy()
        unpack = zstandard.ZstdDecompressor().decompress
        for row, cell in enumerate(table.column("tokens")):
            own = np.frombuffer(unpack(cell.as_py()), "<u2")
            records["tokens"][row, : len(own)] = own
        payload = records.tobytes()
        ids = records["doc_id"][records["doc_id"] != NO_ID]
        cells = {
            "shard_id": table.column("shard_id")[0].as_py(),
            "first_slot": table.column("slot")[0].as_py(),
            "n_sequences": len(table),
            "n_tokens": int(records["n_tokens"].sum()),
            "stride": kind.itemsize,
            "sha256": hashlib.sha256(payload).hexdigest(),
            "doc_ids": np.unique(ids).tolist(),
            "payload": payload,
        }
        return pa.RecordBatch.from_pylist([cells], schema=schema)

    schema = to_arrow_schema(T._parse_datatype_string(SHARD))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of one shard
        for batch in batches:
            own = batch.column("shard_id").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
            for low, high in zip(edges[:-1], edges[1:], strict=True):
                if low == high:
                    continue
                if held and held[0].column("shard_id")[0].as_py() != own[low]:
                    yield shard(held)
                    held = []
                held.append(batch.slice(low, high - low))
        if held:
            yield shard(held)

    return ordered.mapInArrow(run, SHARD)


def read_slots(shards: DataFrame, first: int, last: int, length: int = LENGTH) -> Iterator[tuple]:
    """Records of the slots ``first`` to ``last`` (exclusive) in order, from shards as written.

    Each record is (slot, doc_id, part, tokens). Only shards that hold such slots are read, one at
    a time, so reading resumes anywhere.
    """
    wanted = shards.where(
        (F.col("first_slot") < last) & (F.col("first_slot") + F.col("n_sequences") > first)
    )
    kind = record_type(length)
    for shard in wanted.orderBy("first_slot").toLocalIterator():
        records = np.frombuffer(bytes(shard["payload"]), kind)
        for place, record in enumerate(records):
            slot = shard["first_slot"] + place
            if first <= slot < last:
                doc_id = None if record["doc_id"] == NO_ID else int(record["doc_id"])
                yield slot, doc_id, int(record["part"]), record["tokens"][: record["n_tokens"]]


def decode(tokens: np.ndarray, ranks: str = RANKS) -> str:
    """Text of one document's tokens, without the end token."""
    return encoder(ranks).decode([int(t) for t in tokens if t != END])
