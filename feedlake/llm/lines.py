"""Line deduplication by a deletion-neighbourhood join, in DataFrame functions only.

Two lines within one edit either are equal, or become equal when one character is deleted from the
longer one, or when the character at the same place is deleted from both. So every line emits the
hashes of itself and of all its variants with one character less; equal hashes are joined and the
edit distance is verified on the lines. Of lines within the bound the earliest is kept.

Only the earliest line of a joined hash is a partner: lines that share a variant at one place are
all within one edit of each other, so one earlier line is enough to drop the rest, and no pairs
within a group are made. Before variants are emitted, lines are left out that share neither their
first nor their second half with any line of nearly their length; one edit leaves a half whole. The
others are cut into pieces, about as many as a piece has characters; one edit leaves all that stands
outside of one piece whole, so variants are made only at places in pieces whose outside is shared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import free_names, text_key
from feedlake.plans.shared import discard, settle

SHORTEST = 16  # characters from which a line may differ by an edit; shorter ones must be equal
FEW = 500_000  # survivors whose keys are broadcast, at most
_ORDER = ("no_id", "doc_id", "text_key", "line_no")


def _hash(value: Column) -> tuple[Column, Column]:
    return F.xxhash64(value), F.xxhash64(F.lit("second"), value)


def split_lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per line that is not blank, with its place and its two hashes."""
    lines = docs.select(
        F.col("doc_id").isNull().alias("no_id"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        text_key(F.col(text)).alias("text_key"),
        F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("line_no", "line"),
    ).where(F.trim("line") != "")
    one, two = _hash(F.col("line"))
    return lines.withColumns({"h1": one, "h2": two, "size": F.length("line")})


def _half_keys() -> Column:
    """Hashes of the halves by which lines of lengths that differ by one at most can meet."""
    line, size = F.col("line"), F.col("size")
    keys = []
    for shorter in (size, size - 1):  # as the shorter or equal one, and as the longer one
        head = F.floor(shorter / 2).cast("int")
        tail = (shorter - head).cast("int")
        keys.append(F.xxhash64(F.lit("head"), shorter, F.left(line, head)))
        keys.append(F.xxhash64(F.lit("tail"), shorter, F.right(line, tail)))
    return F.array(*keys)


def _pieces(shorter: Column) -> Column:
    """Each piece of the line, cut as the shorter one of two is: its places, a hash of what is outside."""
    line, size = F.col("line"), F.col("size")
    width = F.ceil(F.sqrt(shorter)).cast("int")

    def piece(start: Column) -> Column:
        end = F.least(start + width, shorter)
        return F.struct(
            (start + 1).alias("low"),
            (end + size - shorter).alias("high"),
            F.xxhash64(F.left(line, start), shorter, start, F.right(line, shorter - end)).alias("outside"),
        )

    return F.transform(F.sequence(F.lit(0), shorter - 1, width), piece)


def shared_pieces(texts: DataFrame) -> DataFrame:
    """One row per line (id) that shares all but a piece with another; ``spans``: those pieces' places."""
    size = F.col("size")
    cuts = texts.select("id", F.explode(_pieces(size)).alias("piece"), F.lit(True).alias("shorter"))
    as_longer = texts.select(
        "id", F.explode(_pieces(size - 1)).alias("piece"), F.lit(False).alias("shorter")
    )
    cuts = cuts.unionByName(as_longer).select("id", "piece.low", "piece.high", "piece.outside", "shorter")
    # Of two longer ones nothing is asked here: each is cut by its own length, too.
    met = cuts.groupBy("outside").agg(
        F.count("*").alias("lines"), F.max("shorter").alias("any_shorter")
    ).where("lines > 1 and any_shorter").select("outside")
    return cuts.join(met, "outside").groupBy("id").agg(
        F.collect_set(F.struct("low", "high")).alias("spans")
    )


def _variants() -> Column:
    """The line itself at place 0, then the variants with the character at a place of ``spans`` deleted."""
    line = F.col("line")
    places = F.flatten(F.transform("spans", lambda span: F.sequence(span["low"], span["high"])))
    return F.concat(
        F.array(F.struct(F.lit(0).alias("place"), F.xxhash64(line).alias("key"))),
        F.transform(
            F.array_distinct(places),
            lambda k: F.struct(
                k.alias("place"),
                F.xxhash64(
                    F.concat(F.substring(line, F.lit(1), k - 1), F.substring(line, k + 1, F.col("size")))
                ).alias("key"),
            ),
        ),
    )


def near_lines(docs: DataFrame, distinct: DataFrame, text: str = "text") -> DataFrame:
    """Hashes (h1, h2) of distinct lines that are one edit from an earlier line."""
    long = distinct.where(F.col("size") >= SHORTEST).select("h1", "h2", "first", "halves")
    halves = long.select("h1", "h2", F.explode(F.array_distinct("halves")).alias("half"))
    met = halves.groupBy("half").agg(F.count("*").alias("lines")).where("lines > 1")
    some = halves.join(met, "half").select("h1", "h2").distinct()
    survivors = settle(long.drop("halves").join(some, ["h1", "h2"]), "line_survivors")
    # Their texts come from a second look at the documents, at each line's earliest place.
    place = survivors.select(
        "first", *[F.col(f"first.{c}").alias(f"_{c}") for c in ("doc_id", "text_key", "line_no")]
    )
    if place.count() <= FEW:
        place = F.broadcast(place)
    lines = split_lines(docs, text).select("doc_id", "text_key", "line_no", "line", "h1", "h2", "size")
    texts = lines.join(
        place,
        lines["doc_id"].eqNullSafe(F.col("_doc_id"))
        & (F.col("text_key") == F.col("_text_key"))
        & (F.col("line_no") == F.col("_line_no")),
    ).select("first", "line", "h1", "h2", "size")
    # Sorted into ranges by first place, so a line's number stands for its order in narrow tables.
    ordered = texts.dropDuplicates(["h1", "h2"]).repartitionByRange("first")
    texts = settle(
        ordered.sortWithinPartitions("first").withColumn("id", F.monotonically_increasing_id()),
        "line_texts",
    )
    variants = settle(
        texts.join(shared_pieces(texts), "id")
        .select("id", F.explode(_variants()).alias("v"))
        .select("id", "v.place", "v.key"),
        "line_variants",
    )
    shorter = variants.where("place > 0")
    at_place = shorter.groupBy("key", "place").agg(
        F.min("id").alias("earliest"), F.count("*").alias("lines")
    ).where("lines > 1").drop("lines")
    same_place = shorter.join(at_place, ["key", "place"])
    whole = variants.where("place = 0").select("id", "key")
    longer = shorter.select("id", "key").join(whole.withColumnRenamed("id", "earliest"), "key")
    least = longer.groupBy("earliest").agg(F.min("id").alias("found"))
    itself = least.select(F.col("earliest").alias("id"), F.col("found").alias("earliest"))
    pairs = None
    for found in (same_place, longer, itself):
        part = found.where(F.col("earliest") < F.col("id")).select("id", "earliest")
        pairs = part if pairs is None else pairs.unionByName(part)
    partner = texts.select(F.col("id").alias("earliest"), F.col("line").alias("kept"))
    mine = texts.select("id", "h1", "h2", "line")
    verified = (
        pairs.distinct()
        .join(partner, "earliest")
        .join(mine, "id")
        .where(F.levenshtein("line", "kept", 1) >= 0)
    )
    near = settle(verified.select("h1", "h2").distinct(), "near_lines")
    discard(survivors, texts, variants)
    return near


def find_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per document: doc_id, text_key, n_lines, ``dropped`` (line numbers from 0, in order).

    A line is dropped if an earlier one, by id and line number, is equal to it, or, from
    ``SHORTEST`` characters on, within one edit of it, whether that one is kept or not. Blank lines
    are never dropped nor counted; null and empty texts have none. Documents without id come last,
    by text key. Repeated rows, equal in id and text, are one document. An empty table gives no
    rows.
    """
    lines = split_lines(docs, text).withColumn("halves", _half_keys())
    lines = settle(lines.drop("line"), "lines")
    order = F.struct(*_ORDER)
    distinct = lines.groupBy("h1", "h2").agg(
        F.min(order).alias("first"), F.first("size").alias("size"), F.first("halves").alias("halves")
    )
    distinct = settle(distinct, "line_classes")
    near = near_lines(docs, distinct, text).withColumn("near", F.lit(True))
    known = distinct.select("h1", "h2", "first").join(near, ["h1", "h2"], "left")
    # A line may stand in a third of all documents: this join splits such keys at run time.
    told = lines.select(*_ORDER, "h1", "h2").join(known, ["h1", "h2"])
    drop = F.col("near").isNotNull() | (F.struct(*_ORDER) != F.col("first"))
    marked = told.groupBy("no_id", "doc_id", "text_key").agg(
        F.array_sort(F.collect_set(F.when(drop, F.col("line_no")))).alias("dropped"),
        F.count_distinct("line_no").alias("n_lines"),
    )
    every = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col(text)).alias("text_key")
    ).distinct()
    marked = marked.select(
        F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "n_lines", "dropped"
    )
    joined = every.join(
        marked, every["doc_id"].eqNullSafe(F.col("_doc")) & (F.col("text_key") == F.col("_key")),
        "left",
    )
    return joined.select(
        "doc_id",
        "text_key",
        F.coalesce("n_lines", F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
    )


def drop_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the dropped lines cut from their texts; null texts stay null."""
    doc, key, own, cut = free_names(docs, "doc", "key", "own", "cut")
    found = find_repeats(docs, text).select(
        F.col("doc_id").alias(doc), F.col("text_key").alias(key), F.col("dropped").alias(cut)
    )
    keyed = docs.withColumn(own, text_key(F.col(text)))
    lines = F.split(F.col(text), "\n")
    kept = F.filter(
        F.transform(lines, lambda line, k: F.struct(line.alias("line"), k.alias("k"))),
        lambda row: ~F.array_contains(F.col(cut), row["k"]),
    )
    joined = keyed.join(
        found, keyed["doc_id"].cast("bigint").eqNullSafe(found[doc]) & (keyed[own] == found[key])
    )
    return joined.withColumn(text, F.array_join(F.transform(kept, lambda r: r["line"]), "\n")).select(
        *docs.columns
    )
