"""Hard negatives, byte-level BPE and centroids against brute force, and on awkward tables."""

import base64
import hashlib
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from feedlake.llm import bpe, centroids, covertree, gnat, queries, vectors
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VECTORS = "vec_id bigint, embedding array<double>, label int, score double, distance string"


def whole(vector, scale):
    """The vector in whole numbers, or None where it takes no part."""
    if not vector or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [int(x) * scale if abs(x) >= 2.0**53 else math.floor(x * scale) for x in vector]


def table(spark, rows):
    return spark.createDataFrame([(*r, 0.5, "x") for r in rows], VECTORS).repartition(3)


@pytest.mark.parametrize("name", queries.TWINS)
def test_queries_equal_their_twins(spark, name):
    df = queries.QUERIES[name](spark, SF)
    assert difference(df, connect(SF), queries.TWINS[name]) is None


def test_whole_numbers_are_exact():
    rows = [[1.5, -1 / 3], None, [], [1e300, -1e300], [2.0**52 + 1, 0.5], [float("nan")], [None]]
    found = {}
    for places, matrix in vectors.scaled(pa.array(rows, pa.list_(pa.float64())), 1024):
        for place, row in zip(places, matrix.tolist(), strict=True):
            found[int(place)] = row
        again = np.concatenate([m for _, m in vectors.unpacked(
            vectors.packed(matrix), np.full(len(matrix), matrix.dtype == object))])
        assert again.tolist() == matrix.tolist()
    assert found == {k: whole(r, 1024) for k, r in enumerate(rows) if whole(r, 1024)}


# --- exact top-k search


def brute_search(rows, every=100, top=10):
    rows = [(i, whole(v, 1024)) for i, v, _ in rows if i is not None and whole(v, 1024)]
    out = Counter()
    for query, v in {(i, tuple(w)) for i, w in rows if i % every == 0}:
        scored = sorted(
            (-s, i) for i, w in rows if i != query and len(w) == len(v)
            for s in [sum(a * b for a, b in zip(v, w, strict=True))] if -(2**63) <= s < 2**63
        )[:top]
        out.update((query, k, i, -s) for k, (s, i) in enumerate(scored, 1))
    return out


def test_search_leaves_no_vector_out(spark):
    inf, nan = float("inf"), float("nan")
    draw = np.random.default_rng(8)
    rows = [(k, (draw.normal(size=3) * 10.0 ** (k % 12)).tolist(), 0) for k in range(400)]
    rows += [(k, (draw.normal(size=3) * 10.0 ** (k % 12 - 6)).tolist(), 0) for k in range(400, 650)]
    rows += [(700 + k, [3e6, -1.0, float(k % 3)], 0) for k in range(30)]
    rows += [
        (0, [3e6, 3e6, 1.0], 1), (0, [3e6, 3e6, 1.0], 1), (1000, [1e300, -1e300, 1e-9], 1),
        (1001, [1e-9, 1e-9, 1.7e308], 1), (1100, None, 1), (1101, [], 1), (None, [1.0] * 3, 1),
        (1102, [None, 1.0, 1.0], 1), (1200, [nan, 1.0, 1.0], 1), (1300, [inf, 1.0, 1.0], 1),
        (1400, [2.0], 1), (1401, [5e6], 1), (1402, [-3.0], 1), (1500, [0.0] * 3, 1),
    ]
    expected = brute_search(rows)
    for options in ({}, {"block": 50, "queries": 2}):
        found = covertree.top_k(table(spark, rows), **options)
        assert found.columns == ["query_id", "rank", "vec_id", "score"]
        assert Counter(map(tuple, found.collect())) == expected
    assert covertree.top_k(table(spark, [])).count() == 0


def test_cover_tree_holds_its_invariants():
    points = np.floor(cloud(3000, 5, middles=30, size=8) * 1024).astype(np.int64)
    tree = covertree.CoverTree(points)
    own = points[tree.order].astype(float)
    assert sorted(tree.order) == list(range(3000)) and len(tree.ranges) > 30
    for node, (low, high) in enumerate(tree.ranges):
        center = own[tree.centers[node]]
        assert np.sqrt(((own[low:high] - center) ** 2).sum(1)).max() <= tree.radius[node] + 1e-6
        assert tree.radius[node] <= 2.0 ** tree.level[node] or not tree.radius[node]
        children = tree.children[node]
        if len(children):
            assert sorted(tree.ranges[k] for k in children)[0][0] == low
            assert sum(b - a for a, b in (tree.ranges[k] for k in children)) == high - low
            middles = own[tree.centers[children]]
            apart = np.sqrt(((middles[:, None] - middles[None]) ** 2).sum(2))
            assert apart[~np.eye(len(children), dtype=bool)].min() > 2.0 ** (tree.level[node] - 1)
            assert all(tree.radius[k] <= 2.0 ** (tree.level[node] - 1) for k in children)


def test_radii_spare_most_comparisons():
    points = np.floor(cloud(8000, 2, middles=60, size=64, wide=0.02) * 1024).astype(np.int64)
    ids = np.arange(8000)
    search = covertree.Search(ids[::100], ids[::100], points[::100], 10)
    for low in range(0, 8000, 2000):
        tree = covertree.CoverTree(points[low : low + 2000])
        order = tree.order + low
        search.add(covertree.Points(ids[order], points[order], tree))
    assert search.compared < 0.2 * 80 * 8000
    scores = points[::100] @ points.T
    scores[np.arange(80), ids[::100]] = -(1 << 62)
    assert (np.sort(scores)[:, :-11:-1] == search.scores[np.argsort(search.own.ids)]).all()


# --- hard negatives


def brute_negatives(rows, every=100):
    rows = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, whole(v, 256)) for i, v, lab in rows
            if i is not None and lab is not None and whole(v, 256)]
    out = []
    for anchor, label, v in {(i, lab, tuple(w)) for i, lab, w in rows if i % every == 0}:
        scored = [
            (-s, i, lab) for i, lab, w in rows if i != anchor and len(w) == len(v)
            for s in [sum(a * b for a, b in zip(v, w, strict=True))] if -(2**63) <= s < 2**63
        ]
        positives = sorted((s, i) for s, i, lab in scored if lab == label)[:5]
        for place, (s, positive) in enumerate(positives, 1):
            window = sorted(
                (n, i) for n, i, lab in scored if lab != label and 80 * -s <= 100 * -n <= 100 * -s
            )[:5]
            out += [
                (anchor, positive, k, i, -s, -n, place) for k, (n, i) in enumerate(window, 1)
            ]
    return Counter(out)


def cloud(count, seed, middles=20, size=8, wide=0.05):
    draw = np.random.default_rng(seed)
    centers = draw.normal(size=(middles, size))
    points = centers[draw.integers(0, middles, count)] + wide * draw.normal(size=(count, size))
    return points / np.sqrt((points**2).sum(1, keepdims=True))


@pytest.mark.parametrize(("block", "anchors"), [(64, 3), (2048, 4096)])
def test_negatives_equal_brute_force(spark, block, anchors):
    draw = random.Random(3)
    rows = [(k, p.round(2).tolist(), draw.randrange(4)) for k, p in enumerate(cloud(900, 1))]
    rows += [(1000 + k, [0.5] * 8, k % 3) for k in range(300)]  # ties: a third of all rows
    rows += [(1100, [0.5] * 8, 1), (1100, [0.25] * 8, 2)]  # repeats of an id
    found = gnat.mine(table(spark, rows), block=block, anchors=anchors)
    assert Counter(map(tuple, found.collect())) == brute_negatives(rows)
    assert found.count() > 50


def test_negatives_on_awkward_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [1.0, 1.9], 2),
        (3, None, 1), (4, [], 1), (5, [None, 1.0], 1), (6, [nan, 1.0], 1), (8, [inf, 1.0], 2),
        (9, [1.0, 1.9], None), (None, [1.0, 1.9], 2), (10, [1.0], 2), (100, [1.0], 2),
        (11, [0.9], 3), (200, [-1.0, 0.0], 5), (12, [1.0, 0.0], 5), (13, [0.9, 0.0], 6),
        (300, [0.0, 0.0], 5), (400, [3e6, 1.0], 7), (15, [3e6, 1.0], 7), (16, [2.9e6, 1.0], 8),
        (17, [1e200, 1.0], 8), (500, [1e-9, 0.0], 4),
    ]
    found = Counter(map(tuple, gnat.mine(table(spark, rows)).collect()))
    assert found == brute_negatives(rows) and found
    assert gnat.mine(table(spark, [])).count() == 0


def test_ranges_spare_most_comparisons():
    points = np.floor(cloud(4000, 2, middles=40, size=64, wide=0.02) * 256).astype(np.int64)
    ids, labels = np.arange(4000), np.arange(4000) % 5
    tree = gnat.Gnat(points)
    asked = np.arange(0, 4000, 100)
    own = np.arange(len(asked))
    low, high = np.full(len(own), -(1 << 62)), np.full(len(own), 1 << 62)
    held = ids[asked], labels[asked], points[asked]
    search = gnat.Windows(held, own, low, high, 5, True)
    search.search(ids[tree.order], labels[tree.order], points[tree.order], tree)
    assert search.filled.all()
    assert search.compared < 0.2 * len(asked) * len(ids)


# --- byte-level BPE


@pytest.fixture(scope="module")
def codec():
    return bpe.load(RANKS)


@pytest.fixture(scope="module")
def reference(codec):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={}
    )


def odd_texts():
    draw = random.Random(1)
    parts = [
        " ", "  ", "\n", "\t", "'s", "'ll", "'", "''re", "a", "Bc", "12", "!", "é", "日", "😀",
        "x" * 9, "hello world", " ", " ", "\x1c", "<|endoftext|>", "internationalisation",
    ]
    texts = ["".join(draw.choices(parts, k=draw.randint(1, 60))) for _ in range(400)]
    return texts + [
        "", "ab" * 9000, "é" * 5000, " " * 5000 + "x", "日本語 " * 4000, "lorem ipsum " * 120_000,
    ]


def test_hash_is_minimal_and_perfect(codec):
    table, words = codec.table, list(codec.ranks)
    assert sorted(table.ranks) == sorted(codec.ranks.values())
    strangers = [w + b"\x00" for w in words[:2000]] + [b"", b"\x00" * 9]
    for asked in (words, strangers):
        ends = np.cumsum([len(w) for w in asked])
        starts = np.concatenate(([0], ends[:-1]))
        held = bpe.Words(np.frombuffer(b"".join(asked), np.uint8), starts, ends)
        found = table.find(held, held.hashes(table.seed))
        assert found.tolist() == [codec.ranks.get(w, -1) for w in asked]


@pytest.mark.parametrize("chunk", [7, 1 << 16])
def test_ids_are_the_tokenizers_own(codec, reference, monkeypatch, chunk):
    monkeypatch.setattr(bpe, "CHUNK", chunk)
    texts = odd_texts()[: 200 if chunk == 7 else None]
    own = codec.open()
    found = own.encode_column(pa.array([*texts, None]))
    assert found.to_pylist() == [reference.encode_ordinary(t) for t in texts] + [[]]
    assert own.decode_column(found).to_pylist() == [t.encode() for t in texts] + [b""]


def test_every_character_is_split_alike(codec, reference):
    draw = random.Random(2)
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(chr(c) + draw.choice(["a", " ", "1", "!", "\n"]) for c in codes)
    assert codec.open().encode_column(pa.array([text]))[0].as_py() == reference.encode_ordinary(text)


def test_words_of_one_hash_are_kept_apart():
    asked = [b"abc", b"xyz", b"abc", b"", b"abcabcabcabc", b"abc", b"xyz"]
    ends = np.cumsum([len(w) for w in asked])
    words = bpe.Words(np.frombuffer(b"".join(asked), np.uint8), np.r_[0, ends[:-1]], ends)
    for hashes in (words.hashes(1), np.zeros(len(asked), np.uint64)):
        rows = np.arange(1, len(asked))
        chosen, same = words.distinct(rows, hashes[rows])
        assert [asked[k] for k in chosen[same]] == asked[1:]


def test_remembered_words_are_bounded(codec, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 10)
    held = bpe._Remembered()
    for k in range(35):
        held.add(b"%d" % k, b"")
    assert len(held.newer) <= 10 and len(held.older) <= 10


def test_documents_are_encoded_whole(spark, awkward, codec, reference):
    docs = awkward.withColumn("ids", F.lit("clash")).withColumn("_text_to_encode", F.lit("no"))
    told = bpe.decode(bpe.encode(docs, codec), codec)
    at_once = bpe.encode(docs, codec, keep=["doc_id"], decoded=True)
    assert at_once.columns == ["doc_id", "ids", "decoded"]
    assert sorted(map(repr, at_once.collect())) == sorted(
        map(repr, told.select(*at_once.columns).collect())
    )
    assert set(told.columns) == set(docs.columns) | {"decoded"}
    given = Counter((r.doc_id, r.text or "") for r in docs.collect())
    rows = told.collect()
    assert Counter((r.doc_id, bytes(r.decoded).decode()) for r in rows) == given
    assert all(r.ids == reference.encode_ordinary(r.text or "") for r in rows)
    for r in bpe.digest(told).collect():
        text = next(x.text or "" for x in rows if x.doc_id == r.doc_id)
        ids = reference.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.digest(bpe.decode(bpe.encode(docs.limit(0), codec), codec)).count() == 0


def test_unknown_ids_decode_to_null(spark, codec):
    rows = spark.createDataFrame([([1, 99999999],), (None,), ([],), ([-1],)], "ids array<int>")
    cells = [r.decoded for r in bpe.decode(rows, codec).collect()]
    assert sorted(c is None for c in cells) == [False, True, True, True]


def test_a_vocabulary_without_a_byte_is_refused(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError, match="single bytes"):
        bpe.read_ranks(str(path))


# --- centroids


def brute_clusters(rows, clusters=8, rounds=10, size=64):
    kept = [(i, whole(v, 1024)) for i, v, _ in rows if v is not None and len(v) == size]
    kept = [(i, v) for i, v in kept if v and max(map(abs, v)) < 10**27]
    if not kept:
        return Counter()

    def drawn(row):
        name = hashlib.sha256(f"3:{row[0]}".encode()).hexdigest()
        return (row[0] is None, name, row[1])

    centers = [v for _, v in sorted(kept, key=drawn)[:clusters]]

    def nearest(v):
        return min(
            (sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centers)
        )

    for _ in range(rounds):
        told = [nearest(v)[1] for _, v in kept]
        centers = [
            [sum(x) // len(own) for x in zip(*own, strict=True)] if own else center
            for k, center in enumerate(centers)
            for own in [[v for (_, v), n in zip(kept, told, strict=True) if n == k]]
        ]
    told = [nearest(v) for _, v in kept]
    most = 2**63

    def fit(x):
        return x if x is not None and x < most else None

    out = []
    for (i, _), (distance, k) in zip(kept, told, strict=True):
        own = [d for d, n in told if n == k and d < most]
        every = [d for d, _ in told if d < most]
        digest = hashlib.sha256(",".join(map(str, centers[k])).encode()).hexdigest()
        out.append((i, k, fit(distance), fit(sum(own) if own else None),
                    fit(sum(every) if every else None), digest))
    return Counter(out)


def test_clusters_equal_brute_force(spark):
    points = cloud(500, 5, middles=6, size=64, wide=0.03)
    rows = [(k, p.tolist(), 0) for k, p in enumerate(points)]
    rows += [(1000 + k, points[7].tolist(), 0) for k in range(250)]  # a third is one vector
    assert Counter(map(tuple, centroids.cluster(table(spark, rows)).collect())) == brute_clusters(
        rows
    )


def test_clusters_on_awkward_rows(spark):
    draw = np.random.default_rng(8)
    inf, nan = float("inf"), float("nan")
    plain = [(k, draw.normal(size=64).tolist(), 0) for k in range(12)]
    odd = [
        (20, None, 0), (21, [], 0), (22, [1.0] * 63, 0), (23, [1.0] * 63 + [None], 0),
        (24, [1.0] * 63 + [nan], 0), (25, [1.0] * 63 + [inf], 0), (None, [1.0] * 64, 0),
        (3, [2.0] * 64, 0), (3, [2.0] * 64, 0), (26, [1e40] * 64, 0),
    ]
    long = [(30, [3e6] * 64, 0), (31, [3e6] * 63 + [3.1e6], 0), (32, [4e9] * 64, 0)]
    for rows in (plain + odd, plain + odd + long, plain[:3], odd[:6], []):
        found = centroids.cluster(table(spark, rows))
        assert Counter(map(tuple, found.collect())) == brute_clusters(rows)
        assert found.columns == list(centroids.cluster(table(spark, [])).columns)


@pytest.mark.parametrize("leaf", [1, 2, 5])
def test_vantage_tree_is_exact_and_prunes(leaf):
    draw = np.random.default_rng(4)
    centers = draw.integers(-400, 400, (200, 16))
    centers[50:60] = centers[0]  # ties
    points = centers[draw.integers(0, 200, 3000)] + draw.integers(-20, 21, (3000, 16))
    numbers, best, compared = centroids.VantageTree(centers, leaf).nearest(points)
    apart = ((points[:, None] - centers) ** 2).sum(2)
    assert (numbers == apart.argmin(1)).all() and (best == apart.min(1)).all()
    assert compared < 0.5 * apart.size
