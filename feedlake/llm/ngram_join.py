"""Similarity join of documents on word n-grams, as groups of linked documents.

Documents of equal n-gram sets are one class; classes are joined by prefix filtering. The n-grams of
a class are ordered rare first, and only a prefix is indexed or probed: two sets that are similar
enough share an n-gram there. Shared prefix n-grams make candidates, which length, positional and
suffix filters thin out; each pair left is verified once, on the whole sets.

All pairs within a group of near copies are never made. The members of an n-gram's bucket are first
compared with its hub, the one that has the fewest rarer n-grams; those found similar become one
component. Only then are the pairs that may join different components taken, so that no link
between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import chunks, free_names, row_key, strings, text_key
from feedlake.llm.components import components
from feedlake.llm.wordhash import NOT_BLANK, hash_words, mix, shingle_hashes
from feedlake.plans.shared import discard, settle

WIDTH = 4  # words of an n-gram
PERCENT = 85  # least similarity
FREQUENT = 1 << 21  # n-grams whose frequency is known when ordering, at most
SEEN = 2  # times that a task must meet an n-gram to report it
GATHERED = 4_000_000  # n-grams that a task counts at once
SENT = 1_000_000  # documents whose keys are broadcast to the texts, at most (about 80 MB)
SUFFIX_PARTS = 64  # ranges of the suffix filter
BLOCK_GRAMS = 1 << 19  # n-grams of a block of a component's sets, about; a pair of blocks is a group
BLOCK_SETS = 512  # sets of a block, about
DENSE = 2048  # n-grams that are columns of a matrix at once


def _sets(batch: pa.RecordBatch, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-grams of each row's text."""
    data, bounds = strings(batch.column("text"))
    for low, high in chunks(bounds):
        part = data[bounds[low] : bounds[high]]
        words, _, _, first = hash_words(part, bounds[low : high + 1] - bounds[low], NOT_BLANK)
        for row in range(high - low):
            grams = np.sort(shingle_hashes(words[first[row] : first[row + 1]], width))
            if len(grams):
                yield grams[np.r_[True, grams[1:] != grams[:-1]]]
            else:
                yield grams


def _class_key(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    one = mix(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    two = mix(grams + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def frequent_ngrams(docs: DataFrame, width: int, limit: int = FREQUENT) -> np.ndarray:
    """The n-grams met most often, rising in frequency; at most ``limit`` of them.

    They only order n-grams, so any estimate gives right results: a task reports those it meets
    several times among some millions, and the reports are added up. How many are kept is decided
    from a count by powers of two, so the driver gets no more than the limit.
    """

    def run(batches):
        held: list[np.ndarray] = []

        def flush():
            grams, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= SEEN
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[often].astype(np.int64)), pa.array(counts[often].astype(np.int64))],
                ["gram", "seen"],
            )

        size = 0
        for batch in batches:
            for grams in _sets(batch, width):
                held.append(grams)
                size += len(grams)
                if size >= GATHERED:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    counts = settle(
        docs.select("text").mapInArrow(run, "gram bigint, seen bigint")
        .groupBy("gram").agg(F.sum("seen").alias("seen")),
        "ngram_counts",
    )
    tier = F.floor(F.log2("seen")).cast("int")
    sizes = counts.groupBy(tier.alias("tier")).count().collect()
    least, total = 64, 0
    for row in sorted(sizes, key=lambda row: -row["tier"]):
        total += row["count"]
        if total > limit:
            break
        least = row["tier"]
    top = counts.where(tier >= least).toArrow()
    discard(counts)
    grams, seen = (top.column(c).to_numpy() for c in ("gram", "seen"))
    return grams[np.lexsort((grams, seen))].astype(np.uint64)


def index_prefix(size: Column | np.ndarray, percent: int):
    """Prefix in which a set shares an n-gram with any similar set that is not smaller."""
    return size - _ceil(2 * percent * size, 100 + percent) + 1


def probe_prefix(size, percent: int):
    """Prefix in which a set shares an n-gram with any similar set that is not larger."""
    return size - _ceil(percent * size, 100) + 1


def _ceil(value, by: int):
    if isinstance(value, Column):
        return ((value + (by - 1)) / by).cast("bigint")
    return -(-value // by)


def needed_overlap(one: Column, other: Column, percent: int) -> Column:
    return _ceil(percent * (one + other), 100 + percent)


def classify(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """One row per document: doc_id, text_key, size, class key, its prefix and suffix profile."""
    frequent = frequent_ngrams(docs, width)
    # Sorted n-grams and their rank by frequency, sent to the tasks once.
    by_value = np.argsort(frequent)
    table = docs.sparkSession.sparkContext.broadcast(
        (frequent[by_value], by_value.astype(np.int32))
    )
    step = np.uint64(64 - int(SUFFIX_PARTS).bit_length() + 1)

    def prefix(grams: np.ndarray) -> np.ndarray:
        known, place = table.value
        length = probe_prefix(len(grams), percent)
        if not len(known):
            return grams[:length]
        near = np.searchsorted(known, grams)
        near[near == len(known)] = 0
        common = known[near] == grams
        ordered = grams[~common][:length]
        if len(ordered) < length:
            rest = grams[common][np.argsort(place[near[common]], kind="stable")]
            ordered = np.concatenate((ordered, rest[: length - len(ordered)]))
        return ordered

    def run(batches):
        for batch in batches:
            sizes, ones, twos, prefixes, profiles = [], [], [], [], []
            for grams in _sets(batch, width):
                one, two = _class_key(grams)
                sizes.append(len(grams))
                ones.append(one)
                twos.append(two)
                prefixes.append(prefix(grams).astype("<u8").tobytes())
                parts = np.bincount((grams >> step).astype(np.int64), minlength=SUFFIX_PARTS)
                profiles.append(np.minimum(parts, 255).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_key"),
                    pa.array(sizes, pa.int64()),
                    pa.array(ones, pa.int64()),
                    pa.array(twos, pa.int64()),
                    pa.array(prefixes, pa.binary()),
                    pa.array(profiles, pa.binary()),
                ],
                ["doc_id", "text_key", "size", "one", "two", "prefix", "profile"],
            )

    return docs.select("doc_id", "text_key", "text").mapInArrow(
        run,
        "doc_id bigint, text_key bigint, size bigint, one bigint, two bigint, prefix binary, "
        "profile binary",
    )


def prefix_entries(classes: DataFrame, percent: int) -> DataFrame:
    """Prefix n-grams: gram, cid, size, pos, and whether the place is within the index prefix."""

    def run(batches):
        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                part = batch.slice(low, 2000)
                lists = [np.frombuffer(p, "<i8") for p in part.column("prefix").to_pylist()]
                counts = np.array([len(x) for x in lists], np.int64)
                sizes = np.repeat(part.column("size").to_numpy(), counts)
                cids = np.repeat(part.column("cid").to_numpy(), counts)
                begins = np.repeat(np.r_[0, np.cumsum(counts)[:-1]], counts)
                pos = np.arange(counts.sum()) - begins
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(lists)),
                        pa.array(cids),
                        pa.array(sizes.astype(np.int32)),
                        pa.array(pos.astype(np.int32)),
                        pa.array(pos < index_prefix(sizes, percent)),
                    ],
                    ["gram", "cid", "size", "pos", "indexed"],
                )

    narrow = classes.where("size > 1").select("cid", "size", "prefix")
    return narrow.mapInArrow(run, "gram bigint, cid bigint, size int, pos int, indexed boolean")


def _long_enough(one: Column, other: Column, percent: int) -> Column:
    return 100 * F.least(one, other) >= percent * F.greatest(one, other)


def _may_overlap(one: Column, one_pos: Column, other: Column, other_pos: Column, percent: int):
    """Positional filter: what follows a shared n-gram on both sides must be enough."""
    most = F.least(one - one_pos, other - other_pos)
    return most >= needed_overlap(one.cast("bigint"), other.cast("bigint"), percent)


def hub_pairs(entries: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Entries of buckets with several members, and each such member paired with its hub."""
    indexed = F.when(F.col("indexed"), F.col("pos").cast("bigint") * (1 << 32) + F.col("size"))
    hubs = entries.groupBy("gram").agg(
        F.count("*").alias("members"),
        F.min(indexed).alias("hub_order"),
        F.min_by("cid", indexed).alias("hub"),
    ).where("members > 1 and hub is not null")
    shared = settle(
        entries.join(hubs.drop("members"), "gram").select(
            "gram", "cid", "size", "pos", "indexed", "hub",
            F.shiftright("hub_order", 32).cast("int").alias("hub_pos"),
            F.col("hub_order").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("hub_size"),
        ),
        "ngram_shared",
    )
    pairs = shared.where(
        (F.col("cid") != F.col("hub"))
        & _long_enough(F.col("size"), F.col("hub_size"), percent)
        & _may_overlap(
            F.col("size"), F.col("pos"), F.col("hub_size"), F.col("hub_pos"), percent
        )
    ).select(F.least("cid", "hub").alias("a"), F.greatest("cid", "hub").alias("b"))
    return shared, pairs.distinct()


def open_pairs(shared: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs that share a prefix n-gram and are not in the same component yet.

    The smaller of the two (the lower number, if equal) has the n-gram in its index prefix. Buckets
    of a single component are left out whole, and so is a member too short after the n-gram for any
    index entry of its bucket.
    """
    entries = shared.select("gram", "cid", "size", "pos", "indexed")
    labelled = entries.join(labels.select(F.col("node").alias("cid"), "label"), "cid", "left")
    labelled = labelled.withColumn("label", F.coalesce("label", "cid"))
    labelled = settle(labelled, "ngram_labelled")
    mixed = labelled.groupBy("gram").agg(
        F.min("label").alias("low"),
        F.max("label").alias("high"),
        F.min(F.when(F.col("indexed"), F.col("size"))).alias("least"),
    ).where("low <> high and least is not null").drop("low", "high")
    # With a partner of size n, at least percent/(100+percent) of n + size must follow the n-gram.
    floor = needed_overlap(
        F.col("size").cast("bigint"),
        F.greatest(F.col("least").cast("bigint"), _ceil(percent * F.col("size").cast("bigint"), 100)),
        percent,
    )
    members = labelled.join(mixed, "gram").where(F.col("size") - F.col("pos") >= floor)
    members = settle(members.drop("least"), "ngram_open")
    discard(labelled)
    small = members.where("indexed").select(
        "gram", *[F.col(c).alias(f"{c}_s") for c in ("cid", "size", "pos", "label")]
    )
    first = F.struct("size_s", "cid_s") < F.struct(
        F.col("size").alias("size_s"), F.col("cid").alias("cid_s")
    )
    found = (
        small.join(members, "gram")
        .where(
            first
            & (F.col("label_s") != F.col("label"))
            & (100 * F.col("size_s") >= percent * F.col("size"))
            & _may_overlap(
                F.col("size_s"), F.col("pos_s"), F.col("size"), F.col("pos"), percent
            )
        )
        .select(F.least("cid_s", "cid").alias("a"), F.greatest("cid_s", "cid").alias("b"))
        .distinct()
    )
    found = settle(found, "ngram_open_pairs")
    discard(members)
    return found


def _profile_filter(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Suffix filter: the n-grams by ranges of their hash bound how many can be shared.

    What two sets differ by in a range, they cannot share; the sum over all ranges is the least
    that they differ by.
    """
    ends = classes.select("cid", "size", "profile", "of_id", "of_key")

    def side(mark: str, end: str) -> DataFrame:
        return ends.select(
            F.col("cid").alias(end),
            *[F.col(c).alias(f"{c}_{mark}") for c in ("size", "profile", "of_id", "of_key")],
        )

    joined = pairs.join(side("a", "a"), "a").join(side("b", "b"), "b")

    def run(batches):
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            tables = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8)
                .reshape(rows, -1).astype(np.int32)
                for c in ("profile_a", "profile_b")
            ]
            apart = np.abs(tables[0] - tables[1]).sum(1)
            total = batch.column("size_a").to_numpy() + batch.column("size_b").to_numpy()
            # apart <= total - 2 * overlap
            keep = total - apart >= 2 * _ceil(percent * total, 100 + percent)
            yield batch.filter(pa.array(keep)).drop_columns(["profile_a", "profile_b"])

    kept = [f for f in joined.schema.fields if not f.name.startswith("profile")]
    return joined.mapInArrow(run, type(joined.schema)(kept))


def _class_texts(asked: DataFrame, docs: DataFrame) -> DataFrame:
    """cid and text of the documents that show the sets of the classes asked for."""
    few = F.broadcast(asked) if asked.count() <= SENT else asked
    return docs.join(
        few, docs["doc_id"].eqNullSafe(F.col("of_id")) & (docs["text_key"] == F.col("of_key"))
    ).select("cid", "text")


def _class_sets(texts: DataFrame, width: int) -> DataFrame:
    """cid and n-grams, one row a class."""

    def run(batches):
        sent: set[int] = set()  # repeated rows give a set once a task
        for batch in batches:
            rows = []
            for cid, grams in zip(batch.column("cid").to_pylist(), _sets(batch, width), strict=True):
                if cid in sent:
                    continue
                sent.add(cid)
                rows.append((cid, grams.astype("<u8").tobytes()))
                if len(rows) >= 1000:
                    yield _set_batch(rows)
                    rows = []
            if rows:
                yield _set_batch(rows)

    return texts.mapInArrow(run, "cid bigint, grams binary").dropDuplicates(["cid"])


def verify(
    pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int
) -> DataFrame:
    """The pairs of classes whose whole sets are similar enough, each compared once.

    Sets are made again from the texts, for one document of each class in question. Their keys are
    broadcast to the texts if they are counted to be few enough, else the planner chooses the join.
    """
    close = settle(_profile_filter(pairs, classes, percent), "ngram_candidates")
    ends = [
        close.select(
            F.col(end).alias("cid"), F.col(f"of_id_{end}").alias("of_id"),
            F.col(f"of_key_{end}").alias("of_key"),
        )
        for end in ("a", "b")
    ]
    asked = settle(ends[0].unionByName(ends[1]).distinct(), "ngram_asked")
    sets = settle(_class_sets(_class_texts(asked, docs), width), "ngram_sets")
    both = close.select("a", "b").join(
        sets.select(F.col("cid").alias("b"), F.col("grams").alias("grams_b")), "b"
    ).join(sets.select(F.col("cid").alias("a"), F.col("grams").alias("grams_a")), "a")

    def similar(batches):
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("grams_a"), batch.column("grams_b"), strict=True):
                one = np.frombuffer(left.as_buffer(), "<u8")
                two = np.frombuffer(right.as_buffer(), "<u8")
                places = np.searchsorted(one, two)
                places[places == len(one)] = 0
                shared = int((one[places] == two).sum())
                keep.append(100 * shared >= percent * (len(one) + len(two) - shared))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")], ["a", "b"]
            )

    links = both.select("a", "b", "grams_a", "grams_b").mapInArrow(similar, "a bigint, b bigint")
    links = settle(links, "ngram_links")
    discard(close, asked, sets)
    return links


def _set_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([row[0] for row in rows], pa.int64()),
            pa.array([row[1] for row in rows], pa.binary()),
        ],
        ["cid", "grams"],
    )


def _similar_counts(
    one: list[np.ndarray], other: list[np.ndarray], percent: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each set of both sides, how many of the other side are similar to it."""
    grams = [np.concatenate(side) for side in (one, other)]
    rows = [np.repeat(np.arange(len(side)), [len(x) for x in side]) for side in (one, other)]
    known = np.intersect1d(*[np.unique(x) for x in grams], assume_unique=True)
    shared = np.zeros((len(one), len(other)), np.float32)  # exact up to 2^24
    order = []
    for k in (0, 1):
        place = np.searchsorted(known, grams[k])
        place[place == len(known)] = 0
        met = known[place] == grams[k] if len(known) else np.zeros(len(grams[k]), bool)
        by = np.argsort(place[met], kind="stable")
        order.append((place[met][by], rows[k][met][by]))
    for low in range(0, len(known), DENSE):
        dense = []
        for (place, row), count in zip(order, shared.shape, strict=True):
            begin, end = np.searchsorted(place, (low, low + DENSE))
            table = np.zeros((count, min(DENSE, len(known) - low)), np.float32)
            table[row[begin:end], place[begin:end] - low] = 1
            dense.append(table)
        shared += dense[0] @ dense[1].T
    both = shared.astype(np.int64)
    sizes = [np.array([len(x) for x in side], np.int64) for side in (one, other)]
    close = 100 * both >= percent * (sizes[0][:, None] + sizes[1][None, :] - both)
    return close.sum(1), close.sum(0)


def count_links(
    labels: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int
) -> DataFrame:
    """cid and ``links``: to how many other classes each class in a component is similar.

    A link never leaves its component, so all pairs within each component are compared on the whole
    sets, found by no prefix and no hub. A component's sets are dealt into blocks by hash; each pair
    of blocks is one group, which is counted by matrix products and returns a count for each set.
    """
    members = labels.select(F.col("node").alias("cid"), "label").join(
        classes.select("cid", "size", "of_id", "of_key"), "cid"
    )
    members = settle(members, "ngram_members")
    blocks = members.groupBy("label").agg(
        F.greatest(F.ceil(F.sum("size") / BLOCK_GRAMS), F.ceil(F.count("*") / BLOCK_SETS)).alias("blocks")
    )
    dealt = settle(
        members.join(blocks, "label").select(
            "cid", "label", "blocks", F.pmod(F.xxhash64("cid"), F.col("blocks")).alias("block")
        ),
        "ngram_dealt",
    )
    asked = members.select("cid", "of_id", "of_key")
    sets = settle(_class_sets(_class_texts(asked, docs), width), "ngram_member_sets")
    # Block b is the one side with every later block, the other with every earlier one.
    partner = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("partner")
    groups = dealt.select("cid", "label", "block", partner).select(
        "cid", "label", "block",
        F.least("block", "partner").alias("low"), F.greatest("block", "partner").alias("high"),
    )
    grouped = groups.join(sets, "cid").repartition("label", "low", "high").sortWithinPartitions(
        "label", "low", "high"
    )

    def counted(group: tuple, rows: list[tuple]) -> pa.RecordBatch:
        _, low, high = group
        one = [row for row in rows if row[1] == low]
        other = [row for row in rows if row[1] == high]
        cids, found = [row[0] for row in one], []
        if one and other:
            first, second = _similar_counts([r[2] for r in one], [r[2] for r in other], percent)
            if low == high:
                found = first - 1  # each is similar to itself
            else:
                cids, found = cids + [r[0] for r in other], np.concatenate((first, second))
        else:
            cids = []
        return pa.RecordBatch.from_arrays(
            [pa.array(cids, pa.int64()), pa.array(found, pa.int64())], ["cid", "links"]
        )

    def run(batches):
        group, held = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("label", "low", "high", "cid", "block")]
            for *key, cid, block, grams in zip(*columns, batch.column("grams"), strict=True):
                if group != tuple(key):
                    if held:
                        yield counted(group, held)
                    group, held = tuple(key), []
                held.append((cid, block, np.frombuffer(grams.as_py(), "<u8")))
        if held:
            yield counted(group, held)

    parts = grouped.mapInArrow(run, "cid bigint, links bigint")
    counts = settle(parts.groupBy("cid").agg(F.sum("links").alias("links")), "ngram_link_counts")
    discard(members, dealt, sets)
    return counts


def link(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, text: str = "text",
    counted: bool = True,
) -> DataFrame:
    """One row per document: doc_id, text_key, n_shingles, class key, ``component_id``, ``links``.

    ``component_id`` is the least doc_id reachable by links, the document's own included; ``links``
    is the number of other classes that its class is similar to, whatever the order of rows, and
    null unless ``counted``. A null or empty text has no n-gram, is linked with nothing and keeps
    its own id. A null id never is a component's id unless all of its documents have none. Repeated
    rows are in one class. An empty table gives no rows.
    """
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text_key(F.col(text)).alias("text_key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    rows = settle(classify(narrow, width, percent), "ngram_rows")
    grouped = rows.where("size > 0").groupBy("one", "two").agg(
        F.first("size").alias("size"),
        F.min("doc_id").alias("least_id"),
        F.min(F.struct("doc_id", "text_key")).alias("of"),  # the document that shows its set
        F.first("prefix").alias("prefix"),
        F.first("profile").alias("profile"),
    )
    classes = settle(
        grouped.select(
            "one", "two", "size", "least_id", F.col("of.doc_id").alias("of_id"),
            F.col("of.text_key").alias("of_key"), "prefix", "profile",
            F.monotonically_increasing_id().alias("cid"),
        ),
        "ngram_classes",
    )
    shared, pairs = hub_pairs(prefix_entries(classes, percent), percent)
    near_hub = verify(pairs, classes, narrow, width, percent)
    near_labels = components(near_hub)
    rest = open_pairs(shared, near_labels, percent)
    discard(shared, near_labels)
    far_links = verify(rest, classes, narrow, width, percent)
    links = near_hub.unionByName(far_links).distinct()
    labels = components(links)
    if counted:
        counts = count_links(labels, classes, narrow, width, percent)
        number = F.coalesce("links", F.lit(0)).cast("bigint")
    else:
        counts = labels.select(F.col("node").alias("cid"), F.lit(None).cast("bigint").alias("links"))
        number = F.lit(None).cast("bigint")
    named = classes.select("one", "two", "cid", "least_id").join(
        labels.select(F.col("node").alias("cid"), "label"), "cid", "left"
    ).withColumn("label", F.coalesce("label", "cid"))
    ids = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    of_class = named.join(ids, "label").join(counts, "cid", "left").select(
        "one", "two", "label", "component_id", "links"
    )
    of_class = settle(of_class, "ngram_components")
    out = settle(rows.select("doc_id", "text_key", "size", "one", "two"), "ngram_documents")
    discard(rest, near_hub, far_links, labels, classes, rows)
    if counted:
        discard(counts)
    # One class may hold a third of all documents: the join splits such keys at run time.
    return out.join(of_class, ["one", "two"], "left").select(
        "doc_id",
        "text_key",
        F.col("size").alias("n_shingles"),
        "one",
        "two",
        "label",
        F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias(
            "component_id"
        ),
        number.alias("links"),
    )


def keep_one(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, text: str = "text"
) -> DataFrame:
    """``docs`` with one document of each group: the least id, then the least text key.

    Documents without words are in no group and all stay. Of repeated rows, equal in id and text,
    one stays, chosen by a hash of its other columns. All columns stay.
    """
    found = settle(link(docs, width, percent, text, counted=False), "ngram_found")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text_key"), F.col("rows"))
    documents = found.where("label is not null").groupBy("label", "doc_id", "text_key").agg(
        F.count("*").alias("rows")
    )
    kept = settle(documents.groupBy("label").agg(F.min(order).alias("best")), "ngram_kept")
    doc, key, own, whole = free_names(docs, "doc", "key", "own", "whole")
    chosen = kept.select(
        F.col("best.doc_id").alias(doc), F.col("best.text_key").alias(key), F.col("best.rows")
    )
    bare = found.where("label is null").select(
        F.col("doc_id").alias(doc), F.col("text_key").alias(key)
    ).distinct()
    keyed = docs.withColumn(own, text_key(F.col(text)))

    def rows_of(wanted: DataFrame) -> DataFrame:
        return keyed.join(
            wanted.select(doc, key),
            keyed["doc_id"].eqNullSafe(wanted[doc]) & (keyed[own] == wanted[key]),
        )

    out = rows_of(chosen.where("rows = 1").select(doc, key).unionByName(bare)).select(*docs.columns)
    several = chosen.where("rows > 1")
    if several.isEmpty():
        return out
    one = rows_of(several).groupBy(doc, key).agg(
        F.min_by(F.struct(*docs.columns), row_key(docs)).alias(whole)
    )
    return out.unionAll(one.select(f"{whole}.*"))
