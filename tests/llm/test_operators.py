"""Each operator against a brute-force version, and on awkward and empty tables."""

import collections
import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from feedlake.llm import (
    covertree,
    decontaminate,
    html,
    language,
    lines,
    mixing,
    ngram_join,
    quality,
    queries,
    secrets,
    tokens,
)
from feedlake.plans import shared

SF = "/root/testdata/sf0.001"
LOWER = {code: code + 32 for code in range(65, 91)}


def frame(spark, texts, first=0):
    rows = [(first + k, text) for k, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def words_of(draw, count):
    return ["".join(draw.choices("abcdefgh", k=draw.randint(2, 5))) for _ in range(count)]


# --- secrets


def brute_spans(text):
    assign = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII,
    )
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    for kind, pattern, least in ((1, "AKIA[A-Z0-9]+", 20), (2, "[0-9a-f]+", 24)):
        for match in re.finditer(pattern, text):
            if len(match[0]) >= least:
                found.append((match.start(), kind, match.end()))
    return sorted(found)


def test_base_spans_equal_the_patterns():
    draw = random.Random(5)
    parts = [
        "password", "PassWd", "secret", "token", "apikey", "API_KEY", ":", "=", " ", '"', "'", "é",
        "abcdef", "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "deadbeef", "x", "ſecret", "\n",
    ]
    for _ in range(3000):
        text = "".join(draw.choices(parts, k=draw.randint(1, 14)))
        assert secrets.base_spans(text) == brute_spans(text), text


def test_random_tokens_are_found_and_words_are_not(spark):
    draw = random.Random(3)
    keys = ["".join(draw.choices(secrets._SYMBOLS, k=48)) for _ in range(60)]
    plain = "Readers of long2words like internationalization4everyone and Some_Long_Name_2_of_things"
    docs = frame(spark, [f"see {key} here" for key in keys] + [plain] * 60)
    found = {r.doc_id: r.spans for r in secrets.find_secrets(docs).collect()}
    told = [any(s.kind == 3 for s in found[k]) for k in range(len(found))]
    assert sum(told[:60]) >= 50 and not any(told[60:])


def test_random_tokens_of_every_encoding_are_found(spark):
    draw = random.Random(12)
    kinds = [*secrets.ALPHABETS, "dashed"]
    keys = []
    for kind in kinds:
        for _ in range(40):
            alphabet = secrets.ALPHABETS.get(kind, secrets.ALPHABETS["hex"])
            key = "".join(draw.choices(alphabet, k=32 if kind == "dashed" else 48))
            if kind == "dashed":
                key = "-".join((key[:8], key[8:12], key[12:16], key[16:20], key[20:]))
            keys.append((kind, key))
    plain = "The 2nd reader of chapter3 met page_12 and internationalization4everyone in Some_Name_2_of"
    docs = frame(spark, [f"see {key} here" for _, key in keys] + [plain] * 60)
    found = {r.doc_id: r.spans for r in secrets.find_secrets(docs).collect()}
    told = collections.Counter()
    for k, (kind, key) in enumerate(keys):
        told[kind] += any(s.end - 4 >= len(key) and s.kind >= 2 for s in found[k])
    assert min(told[kind] for kind in kinds) >= 32, told
    assert not any(found[k] for k in range(len(keys), len(found)))


def test_secrets_on_awkward_rows(spark, awkward):
    rows = secrets.find_secrets(awkward).collect()
    assert len(rows) == 8 and all(r.spans == [] for r in rows)
    assert secrets.find_secrets(awkward.limit(0)).count() == 0


# --- tokens


def test_permutation_is_a_bijection():
    for count in (1, 2, 3, 17, 1000, 4097):
        slots = tokens.feistel(np.arange(count), count, key=9)
        assert sorted(slots.tolist()) == list(range(count))
    assert tokens.feistel(np.arange(1000), 1000, 9).tolist() != tokens.feistel(
        np.arange(1000), 1000, 10
    ).tolist()


def test_encoding_piece_by_piece_is_the_tokenizers_own(monkeypatch):
    monkeypatch.setattr(tokens, "PIECE", 50)
    draw = random.Random(1)
    parts = ["the", " ", "  ", "\n", "\t", "don't", "é", " ", "\x1c", "42", "!?", " a", "日本"]
    for _ in range(2000):
        text = "".join(draw.choices(parts, k=draw.randint(0, 40)))
        own = tokens.encode(text)
        assert own[:-1].tolist() == tokens.encoder().encode_ordinary(text) and own[-1] == tokens.END


def test_shards_round_trip_and_resume(spark, awkward):
    shards = tokens.write_order(awkward, key=4, length=32, per_shard=7).cache()
    rows = list(tokens.read_slots(shards, 0, 10**9, length=32))
    assert [r[0] for r in rows] == list(range(len(rows)))
    parts = collections.defaultdict(lambda: collections.defaultdict(list))
    for _, doc_id, part, own in rows:
        parts[doc_id][part].append(own)
    for row in awkward.distinct().collect():
        own = np.concatenate([parts[row.doc_id][k][0] for k in sorted(parts[row.doc_id])])
        assert tokens.decode(own) == (row.text or "")
    assert len(parts[1][0]) == 2  # the repeated row
    again = list(tokens.read_slots(shards, 10, 13, length=32))
    assert [(r[0], r[1]) for r in again] == [(r[0], r[1]) for r in rows[10:13]]
    other = tokens.write_order(awkward.repartition(5), key=4, length=32, per_shard=7)
    digests = {r.shard_id: r.sha256 for r in shards.collect()}
    assert {r.shard_id: r.sha256 for r in other.collect()} == digests
    per_shard = {r.shard_id: set(r.doc_ids) for r in shards.collect()}
    expected = collections.defaultdict(set)
    for slot, doc_id, _, _ in rows:
        expected[slot // 7] |= set() if doc_id is None else {doc_id}
    assert per_shard == expected
    assert tokens.write_order(awkward.limit(0)).count() == 0


def test_a_partition_holds_a_range_of_slots(spark):
    docs = frame(spark, [f"some words of text {k} " * (k % 9) for k in range(300)])
    shards = tokens.write_order(docs, length=8, per_shard=5).withColumn("at", F.spark_partition_id())
    rows = [(r.at, r.first_slot, r.shard_id, r.n_sequences) for r in shards.collect()]
    assert rows == sorted(rows) and len({r[0] for r in rows}) > 1
    assert [r[2] for r in rows] == list(range(len(rows)))
    assert all(first == 5 * k and n == 5 for _, first, k, n in rows[:-1])


# --- mixing


def brute_targets(sizes, weights=mixing.WEIGHTS, most=3):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, capped = {}, set()
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in capped)
        open_ = [s for s in names if s not in capped]
        total = sum(weight[s] for s in open_)
        target = {s: most * sizes[s] if s in capped else left * weight[s] / total for s in names}
        over = {s for s in open_ if target[s] > most * sizes[s] + 1e-9}
        if not over:
            return target
        capped |= over


def test_mix_meets_its_targets(spark):
    draw = random.Random(8)
    rows = [
        (k, " ".join(["w"] * int(draw.paretovariate(1) * 20 % 3000)), draw.choice([None, *"ABCDEF"]))
        for k in range(3000)
    ] + [(9000 + k, "w " * 5, "tiny") for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    plan = mixing.plan_mix(docs, block=128).toPandas()
    assert len(plan) == len(rows)
    sizes = {r[0]: len(r[1].split()) for r in rows}
    assert all(sizes[r.doc_id] == r.size for r in plan.itertuples())
    sources = collections.Counter()
    for _, text, source in rows:
        sources[source] += len(text.split())
    targets = brute_targets(sources)
    for source, own in plan.groupby("source", dropna=False):
        name = None if source != source or source is None else source
        assert own["target"].iloc[0] == pytest.approx(targets[name])
        taken = (own["copies"] * own["size"]).sum()
        assert abs(taken - targets[name]) <= 0.02 * targets[name] + 20
    assert plan["copies"].between(0, 3).all()
    other = mixing.plan_mix(docs.repartition(7), block=128).toPandas()
    key = ["doc_id"]
    assert plan.sort_values(key)["copies"].tolist() == other.sort_values(key)["copies"].tolist()


def test_flight_keeps_totals():
    draw = np.random.default_rng(2)
    sizes, chances = draw.integers(1, 900, 400), draw.random(400)
    before = (chances.sum(), (chances * sizes).sum())
    mixing.flight(chances, sizes, draw, land=False)
    assert ((chances == 0) | (chances == 1)).sum() >= 397
    assert (chances * sizes).sum() == pytest.approx(before[1], rel=1e-6)
    assert abs(chances.sum() - before[0]) < 2


def test_mix_on_awkward_rows(spark, awkward):
    mixed = mixing.mix(awkward)
    assert mixed.columns == awkward.columns
    counts = collections.Counter(r.doc_id for r in mixed.collect())
    assert all(n <= 6 for n in counts.values())
    assert mixing.plan_mix(awkward).count() == 8
    assert mixing.mix(awkward.limit(0)).count() == 0


NAMES = "doc_id text lang source key row copies place whole rows own cut doc text_key row_key size order"


def crowded(spark, rows):
    """Documents with further columns that have the names of the operators' own."""
    table = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    further = [F.lit(f"of {name}").alias(name) for name in NAMES.split()[4:]]
    further.append(F.create_map(F.lit("a"), F.lit(1)).alias("part"))
    return table.select("*", *further)


def test_equal_rows_are_one_unit_of_the_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "PIECE", 64)
    texts = [" ".join(["w"] * (1 + k % 40)) for k in range(3000)]
    rows = [(k, text, "en", "ab"[k % 2]) for k, text in enumerate(texts)]
    rows += [(7777, "one and the same row", "en", "a")] * 1500
    rows += [(8888, "under two sources", lang, source) for lang in "xy" for source in "ab"]
    rows += [((1 << 53) + 1, "a long id", "en", "a"), (None, "no id", "en", "a"), (None, None, None, "b")]
    docs = crowded(spark, rows)
    units = mixing.plan_units(docs).where("rows > 1").collect()
    assert [(r.doc_id, r.rows) for r in units] == [(7777, 1500)]
    plan = mixing.plan_mix(docs).collect()
    assert collections.Counter((r.doc_id, r.source) for r in plan) == collections.Counter(
        (r[0], r[3]) for r in rows
    )
    same = [r.copies for r in plan if r.doc_id == 7777]
    assert max(same) - min(same) <= 1 and max(r.copies for r in plan) <= 3
    for source in "ab":
        own = [r for r in plan if r.source == source]
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= 0.02 * own[0].target + 20
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    taken = collections.Counter((r.doc_id, r.lang, r.source) for r in mixed.collect())
    planned = collections.Counter()
    for r in plan:
        planned[r.doc_id, r.source] += r.copies
    for key, copies in planned.items():
        assert sum(n for (i, _, s), n in taken.items() if (i, s) == key) == copies
    assert mixed.where("place <> 'of place' or part['a'] <> 1").count() == 0


def test_further_columns_keep_their_values(spark):
    line = "a line of some length that is here, there and everywhere"
    rows = [(1, f"{line} one\n{line}", "en", "a"), (2, line, "en", "a"), (3, line, "fr", "b")]
    rows += [(9, "a common text of a few words that stands in very many rows", "en", "a")] * 900
    rows += [(9, "a common text of a few words that stands in very many rows", "de", "a")] * 600
    docs = crowded(spark, rows)
    one = ngram_join.keep_one(docs)
    assert one.columns == docs.columns
    kept = one.collect()
    assert sorted(r.doc_id for r in kept) == [1, 2, 9]
    other = ngram_join.keep_one(docs.repartition(7)).collect()
    assert sorted((r.doc_id, r.lang) for r in other) == sorted((r.doc_id, r.lang) for r in kept)
    cut = lines.drop_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    items = [(k, f"{line} and item {k} with words of its own as many as are needed") for k in range(4)]
    items.append((9, line))
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.find_contamination(docs, benchmark, block_chars=80)
    assert found.count() == len(rows) and set(docs.columns) <= set(found.columns)
    assert sorted(r.doc_id for r in found.where("contaminated").collect()) == [1, 2, 3]
    for result in (one, cut, found):
        wrong = [f"`{name}` <> 'of {name}'" for name in NAMES.split()[4:]]
        assert result.where(" or ".join(wrong)).count() == 0


# --- n-gram join


def brute_groups(texts, width=4, percent=85):
    sets = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        width_ = min(width, len(words))
        sets.append({tuple(words[k : k + width_]) for k in range(len(words) - width_ + 1) if words})
    group = list(range(len(sets)))

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                low, high = sorted((top(a), top(b)))
                group[high] = low
    return [(len(s), top(k)) for k, s in enumerate(sets)]


@pytest.mark.parametrize("sent", [ngram_join.SENT, 0])
def test_join_equals_brute_force(spark, monkeypatch, sent):
    monkeypatch.setattr(ngram_join, "SENT", sent)
    draw = random.Random(4)
    texts = []
    for length in (8, 40, 41, 90, 200):
        base = words_of(draw, length)
        for _ in range(45):
            own = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3, 5])):
                own[draw.randrange(len(own))] = words_of(draw, 1)[0]
            if draw.random() < 0.2:
                own = own[: -draw.randint(1, 5)]
            texts.append(" ".join(own).upper() if draw.random() < 0.3 else "  ".join(own))
    texts += [None, "", " ", "a b", "A B", "a", "a b c d", "one two"]
    rows = ngram_join.link(frame(spark, texts)).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert got == dict(enumerate(brute_groups(texts)))


def brute_links(texts, width=4, percent=85):
    sets = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        width_ = min(width, len(words))
        sets.append(
            frozenset(tuple(words[k : k + width_]) for k in range(len(words) - width_ + 1) if words)
        )
    classes = {s for s in sets if s}
    counts = {
        s: sum(100 * len(s & o) >= percent * len(s | o) for o in classes if o != s) for s in classes
    }
    return [counts.get(s, 0) for s in sets]


def test_links_within_a_hubs_component_are_counted(spark):
    base = words_of(random.Random(2), 100)
    texts = [" ".join([*base[:k], "other", *base[k + 1 :]]) for k in (0, 50, 99)]
    rows = ngram_join.link(frame(spark, texts)).collect()
    assert {r.doc_id: r.links for r in rows} == {0: 2, 1: 2, 2: 2}


@pytest.mark.parametrize("grams, sets, dense", [(1 << 19, 512, 2048), (1500, 9, 64)])
def test_links_equal_brute_force(spark, monkeypatch, grams, sets, dense):
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", grams)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", sets)
    monkeypatch.setattr(ngram_join, "DENSE", dense)
    draw = random.Random(11)
    texts = []
    for length in (8, 40, 90, 200):
        base = words_of(draw, length)
        for _ in range(40):
            own = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 3, 5])):
                own[draw.randrange(len(own))] = words_of(draw, 1)[0]
            texts.append(" ".join(own))
    texts += [None, "", "a b", "a"]
    expected = dict(enumerate(brute_links(texts)))
    rows = ngram_join.link(frame(spark, texts)).collect()
    assert {r.doc_id: r.links for r in rows} == expected
    rows = ngram_join.link(frame(spark, texts).repartition(7)).collect()
    assert {r.doc_id: r.links for r in rows} == expected


def test_join_on_awkward_rows(spark, awkward):
    assert ngram_join.link(awkward).count() == 8
    kept = ngram_join.keep_one(awkward)
    assert kept.columns == awkward.columns
    ids = collections.Counter(r.doc_id for r in kept.collect())
    assert ids == {1: 1, 2: 1, 3: 1, None: 1, 4: 1, 5: 1, 6: 1}
    assert ngram_join.keep_one(awkward.limit(0)).count() == 0


# --- quality and language


def test_quality_on_held_out_rows(spark):
    rows = {r.doc_id: r for r in queries.op5_quality(spark, "/root/testdata/sf0.01").collect()}
    held = [r for r in rows.values() if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows.values())
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    truth = {r.doc_id: r.quality for r in labels}
    known = [r for r in held if r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in known)
    assert right >= 0.9 * len(known)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows.values())


def test_models_on_awkward_rows(spark, awkward):
    model = quality.fit(pa.array(["good text", "bad ### text"]), np.array([1, 0]))
    rows = quality.score(awkward, model).collect()
    assert len(rows) == 8 and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(awkward.limit(0), model).count() == 0
    told = language.identify(awkward, language.train(awkward))
    names = {r.doc_id: r.lang_pred for r in told.collect()}
    assert names[2] == names[3] == names[5] == names[6] == "und" and names[1] in ("en", "fr")
    untrained = language.train(awkward.limit(0))
    assert {r.lang_pred for r in language.identify(awkward, untrained).collect()} == {"und"}


def test_quality_sample_is_bounded_and_without_copies(spark, monkeypatch):
    learned = [k for k in range(60) if zlib.crc32(str(k).encode()) % 3 != 1]
    rows = [(learned[0], f"own text {k}") for k in range(300)]  # many texts under one id
    rows += [(learned[1], "the same text again")] * 300  # a third of all rows
    rows += [(k, f"text of {k}") for k in range(60)] + [(None, "no id"), (learned[2], None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(None, 1)], "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(
        quality, "fit", lambda texts, known: seen.append(list(zip(texts.to_pylist(), known.tolist(), strict=True)))
    )
    quality.train(docs, labels, 50)
    quality.train(docs.repartition(3), labels.repartition(2), 50)
    assert seen[0] == seen[1] and len(set(seen[0])) == len(seen[0]) == 100
    quality.train(docs.where("text like 'text%'"), labels, 1000)
    assert sorted(seen[2]) == sorted((f"text of {k}", k % 2) for k in learned)
    quality.train(docs, labels.limit(0))
    assert seen[3] == []


def test_language_on_held_out_rows(spark):
    rows = queries.op8_language(spark, "/root/testdata/sf0.01").collect()
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    truth = {r.doc_id: r.lang for r in docs}
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)


def test_language_sample_is_bounded_and_without_copies(spark, monkeypatch):
    rows = [("the same text again", "en")] * 300 + [(f"text {chr(97 + k % 26)} {k}", "en")
            for k in range(300)] + [(f"phrase {k}", "fr") for k in range(30)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    seen = []
    monkeypatch.setattr(language, "fit", lambda *given: seen.append(list(zip(*given, strict=True))))
    language.train(docs, 20)
    language.train(docs.repartition(3), 20)
    assert seen[0] == seen[1] and len(set(seen[0])) == len(seen[0])
    for lang, least in (("en", 5), ("fr", 10)):
        assert least <= sum(known == lang for _, known in seen[0]) <= 40


# --- HTML


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<header><a href="/">Site</a></header><nav><ul><li><a href=a>Menu</a></ul></nav>
<div class="cookie-notice">We use cookies, please agree.</div>
<div class="page"><div id="sidebar"><p>Side, text, with many, commas, in it, and more of it.</p></div>
<div class="text"><h2>A &amp; B</h2><p>First   paragraph,\n with <b>bold<p>Second&nbsp;one, and
<a href=x>a link</a> in it, long enough.<script>var a="</p>";</script><ul><li>One<li>Two</ul></div>
<div class="comments"><p>Reader says, well, this, is a comment.</p></div></div>
<form><p>Send, us, your, mail, now.</p></form><footer>&copy; us</footer></body></html>"""


def test_main_text_of_a_page():
    assert html.extract(PAGE).split("\n") == [
        "A & B", "First paragraph, with bold", "Second one, and a link in it, long enough.", "One",
        "Two",
    ]


def test_broken_and_empty_pages(spark):
    for page in (None, "", "<", "<p", "text only", "<p>a<p>b", "</div></p>x", "<a<b>", "<!-- x", "&#xD800;"):
        html.extract(page)
    assert html.extract("<p>a<p>b") == "a\nb" and html.extract("text only") == "text only"
    pages = spark.createDataFrame([(1, "u", PAGE, 9), (1, "u", PAGE, 9), (None, None, None, None)],
                                  "page_id bigint, url string, html string, n_chars bigint")
    rows = html.extract_text(pages).collect()
    assert sorted(r.n_chars for r in rows) == [0, *[len(html.extract(PAGE))] * 2]
    assert html.extract_text(pages.limit(0)).count() == 0


LONG = "This, as we said before, is one of those sentences that make up a text, and a long one. " * 3
PART = f"<p>{LONG}</p><p>{LONG}</p>"
LINES = [LONG.strip()] * 2


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        # A heading and a short section beside the best container.
        (f"<div id=wrap><h1>Title</h1><div class=text>{PART}</div></div>", ["Title", *LINES]),
        (
            f"<div><h1>T</h1><p>By us</p><div>{PART * 2}</div><section><p>Short.</p></section>"
            f"<div>{PART}</div><div><a href=x>More</a></div></div>",
            ["T", "By us", *LINES * 2, "Short.", *LINES],
        ),
        # Two parts of a page, and an article with teasers and reader comments beside it.
        (f"<article>{PART}</article><article><h2>B</h2>{PART}</article>", [*LINES, "B", *LINES]),
        (
            f"<article>{PART}</article><article><a href=x>Other news of today</a></article>"
            f"<article class=comment>{PART}</article>",
            LINES,
        ),
        # Words that mark furniture, in names of other things.
        (
            f'<article><div class="social-history"><p>It was so.</p></div><section id="related-work">'
            f'{PART}</section><div class="related-posts"><p>{LONG}</p></div><div class="share-it">'
            f"<a href=x>Here</a></div></article>",
            ["It was so.", *LINES],
        ),
        (f'<div class="notice-board-history">{PART}</div>', LINES),
        # A form around the whole page.
        (f"<form><nav>Menu</nav><article>{PART}<form>x</form></article></form>", LINES),
        # Quotes that are not closed, and signs that are no markup.
        (f"<div title=it's class='a>b'>{PART}</div>", LINES),
        (f'<div class="text>{PART}</div>', LINES),
        ("<p>a < b and 3<4 & c", ["a < b and 3<4 & c"]),
    ],
)
def test_main_text_loses_nothing(page, expected):
    assert html.extract(page).split("\n") == expected


@pytest.mark.parametrize("tag", sorted(html.MEDIA | html.RAW | html.CHOICES))
def test_elements_that_are_never_closed(tag):
    page = f"<body><article><p>{LONG}<div><{tag} src=x></div><p>{LONG}</article></body>"
    assert html.extract(page).split("\n") == LINES
    closed = f"<body><article><p>{LONG}<div><{tag}>gone</{tag}></div><p>{LONG}</article></body>"
    assert html.extract(closed).split("\n") == LINES
    if tag in html.MEDIA:
        assert html.extract(f"<article><{tag} src=x>{PART}</article>").split("\n") == LINES


@pytest.mark.parametrize(
    "piece",
    ["<b ", "a <b c ", "<b>", "x<div>", "<a x='>' ", "<video>", "<![CDATA[", "<!--x", "<p>a<i>b</p></i>",
     "<", "<table><tr><td>", "<script>", "<a href=x>y", "<span hidden>", "&", "<p class=social-x>y"],
)
def test_time_grows_with_the_page_only(piece):
    def seconds(size: int) -> float:
        page = piece * (size // len(piece))
        start = time.process_time()
        html.extract(page)
        return time.process_time() - start

    assert seconds(600_000) < 20 * max(seconds(60_000), 0.05)


def test_text_in_deep_elements_is_kept():
    page = "<div>" * 5000 + "deep" + "</div>" * 5000 + "after"
    assert html.extract(page).split("\n") == ["deep", "after"]


def test_pages_of_the_test_tables(spark):
    rows = queries.op6_main_text(spark, SF).collect()
    source = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for row in rows:
        article = source[row.page_id].partition("<article>")[2].partition("</article>")[0]
        blocks = [re.sub("<[^>]*>", " ", x) for x in re.split(r"</?(?:p|h\d)>", article)]
        import html as entities

        blocks = [" ".join(entities.unescape(x).split()) for x in blocks]
        assert row.text == "\n".join(x for x in blocks if x)


# --- search


def brute_top(rows, every=100, top=10):
    clean = {}
    for vec_id, vector in rows:
        if vector and all(x is not None and np.isfinite(x) for x in vector):
            clean.setdefault(vec_id, []).append([int(np.floor(1024 * float(x))) for x in vector])
    out = []
    for vec_id in sorted(clean):
        if vec_id % every == 0:
            mine = clean[vec_id][0]
            scores = sorted(
                (-sum(a * b for a, b in zip(mine, own, strict=True)), other)
                for other, all_own in clean.items()
                if other != vec_id
                for own in all_own
            )[:top]
            out += [(vec_id, k + 1, other, -score) for k, (score, other) in enumerate(scores)]
    return sorted(out)


def test_search_equals_brute_force(spark):
    draw = np.random.default_rng(6)
    rows = [(k, (draw.normal(size=6) * (0.1 + k % 5)).tolist()) for k in range(700)]
    rows += [(1000 + k, [0.5] * 6) for k in range(300)]  # one common vector: ties
    rows += [(2000, None), (2001, [None] * 6), (2002, [float("nan")] * 6), (3000, [float("inf")] * 6)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(5)
    for options in ({}, {"block": 90, "queries": 3}, {"block": 60, "pivots": 4}):
        found = covertree.top_k(table, **options).collect()
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found) == brute_top(rows)
    assert covertree.top_k(table.limit(0)).count() == 0
    assert covertree.top_k(table.where("vec_id in (0, 7)")).count() == 1


# --- lines


def within_an_edit(a, b):
    a, b = sorted((a, b), key=len)
    k = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return len(b) - len(a) <= 1 and (
        a[k:] == b[k + 1 :] or (len(a) == len(b) and a[k + 1 :] == b[k + 1 :])
    )


def test_lines_equal_brute_force(spark):
    draw = random.Random(7)
    base = ["".join(draw.choices("abcd é", k=draw.randint(10, 40))) for _ in range(25)]
    texts = []
    for _ in range(60):
        own = []
        for line in draw.choices(base, k=draw.randint(0, 6)):
            place, kind = draw.randrange(len(line)), draw.randint(0, 5)
            line = {
                0: line[:place] + line[place + 1 :], 1: line[:place] + "x" + line[place:],
                2: line[:place] + "y" + line[place + 1 :],
            }.get(kind, line)
            own.append(line)
        texts.append("\n".join(own))
    texts += [None, "", "\n\n", texts[0]]

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(b) - len(a) > 1:
            return False
        k = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
        return a[k:] == b[k + 1 :] or (len(a) == len(b) and a[k + 1 :] == b[k + 1 :])

    seen, expected = [], {}
    for doc_id, text in enumerate(texts):
        dropped, n = [], 0
        for k, line in enumerate((text or "").split("\n")):
            if line.strip(" "):
                n += 1
                long = len(line) >= lines.SHORTEST
                if line in seen or (
                    long and any(len(x) >= lines.SHORTEST and near(x, line) for x in seen)
                ):
                    dropped.append(k)
                seen.append(line)
        expected[doc_id] = (n, dropped)
    rows = lines.find_repeats(frame(spark, texts)).collect()
    assert {r.doc_id: (r.n_lines, r.dropped) for r in rows} == expected
    kept = {r.doc_id: r.text for r in lines.drop_repeats(frame(spark, texts)).collect()}
    for doc_id, text in enumerate(texts):
        own = [x for k, x in enumerate((text or "").split("\n")) if k not in expected[doc_id][1]]
        assert (kept[doc_id] or "") == "\n".join(own)


def variants_made(monkeypatch):
    counts = []

    def settle(df, name):
        table = shared.settle(df, name)
        if name == "line_variants":
            counts.append(table.count())
        return table

    monkeypatch.setattr(lines, "settle", settle)
    return counts


def test_lines_that_share_a_half_make_few_variants(spark, monkeypatch):
    draw, made = random.Random(11), variants_made(monkeypatch)

    def some(count):
        return "".join(draw.choices("abcdefghij klm", k=count))

    head = some(200)
    halves = [head + some(200) for _ in range(8)]  # 401 variants each, if made of all places
    kept, place = some(400), 137
    near = [
        kept, kept[:place] + "X" + kept[place + 1 :], kept[:place] + kept[place + 1 :],
        kept[:place] + "XY" + kept[place:],
    ]
    found = {r.doc_id: r.dropped for r in lines.find_repeats(frame(spark, halves + near)).collect()}
    assert {k for k, dropped in found.items() if dropped} == {9, 10}
    # Of the near ones each has a line and one or two pieces of 20 or 21 places per cut.
    assert 0 < made[0] <= 4 * (1 + 4 * 21)


def test_lines_within_an_edit_meet_at_every_place(spark):
    draw, texts = random.Random(12), []
    for size in (15, 16, 17, 24, 25, 26, 50):
        line = "".join(draw.choices("abcde", k=size))
        edited = [line]
        for place in range(size + 1):
            edited.append(line[:place] + "X" + line[place + 1 :])
            edited.append(line[:place] + "Y" + line[place:])
            edited.append(line[:place] + line[place + 1 :])
        texts.append(edited)
    for part in (texts, [edited[::-1] for edited in texts]):
        seen, expected = [], []
        for edited in part:
            dropped = []
            for k, x in enumerate(edited):
                long = [y for y in seen if min(len(x), len(y)) >= lines.SHORTEST]
                if x in seen or any(within_an_edit(x, y) for y in long):
                    dropped.append(k)
                seen.append(x)
            expected.append(dropped)
        rows = lines.find_repeats(frame(spark, ["\n".join(edited) for edited in part])).collect()
        assert [r.dropped for r in sorted(rows, key=lambda r: r.doc_id)] == expected


def test_lines_of_one_character_and_very_long_lines(spark, monkeypatch):
    made = variants_made(monkeypatch)
    draw = random.Random(13)
    long = "".join(draw.choices("abcdefgh é", k=50_000))
    texts = ["a" * 40, "a" * 41, "a" * 43, "a" * 42 + "b"]
    texts += [long, long[:30_000] + long[30_001:], "Z" + long[:-1] + "Z"]
    found = {r.doc_id: r.dropped for r in lines.find_repeats(frame(spark, texts)).collect()}
    assert {k for k, dropped in found.items() if dropped} == {1, 3, 5}
    assert made[0] < 5_000  # 100,172, if made at all places


def test_lines_on_awkward_rows(spark, awkward):
    rows = lines.find_repeats(awkward).collect()
    assert len(rows) == 7 and all(r.dropped == [] for r in rows)
    assert lines.drop_repeats(awkward).columns == awkward.columns
    assert lines.find_repeats(awkward.limit(0)).count() == 0


# --- decontamination


def brute_hits(texts, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = {}
    for item, text in items:
        own = word.findall((text or "").translate(LOWER))
        size = min(13, len(own))
        for k in range(len(own) - size + 1 if own else 0):
            windows.setdefault(tuple(own[k : k + size]), set()).add(item)
    out = []
    for text in texts:
        own = word.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(own) - size + 1):
                items_here = windows.get(tuple(own[k : k + size]))
                if items_here:
                    hit |= set(range(k, k + size))
                    found |= items_here
        listed = ",".join(sorted(map(str, found)))
        out.append((len(own), len(hit), len(found), hashlib.sha256(listed.encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(own)))
    return out


@pytest.mark.parametrize("block_chars", [1 << 20, 300])
def test_contamination_equals_brute_force(spark, block_chars):
    draw = random.Random(9)
    items = [(k, " ".join(words_of(draw, draw.choice([0, 1, 5, 13, 14, 30])))) for k in range(12)]
    items += [(12, items[5][1]), (13, None), (100, items[4][1] + " tail")]
    texts = []
    for _ in range(60):
        own = words_of(draw, draw.randint(0, 120))
        for _ in range(draw.randint(0, 2)):
            passage = (draw.choice(items)[1] or "").split()
            place = draw.randint(0, len(own))
            own[place:place] = passage[draw.randint(0, 3) :]
        texts.append(draw.choice([" ", ", ", "-É "]).join(own).title())
    texts += [None, "", "é", "ab-cd"] + texts[:2]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.find_contamination(frame(spark, texts), benchmark, block_chars=block_chars)
    rows = {r.doc_id: tuple(r)[1:] for r in decontaminate.digest(found).collect()}
    assert rows == dict(enumerate(brute_hits(texts, items)))


def test_contamination_on_awkward_rows(spark, awkward):
    benchmark = spark.createDataFrame(
        [(None, "quick brown fox"), (7, None), (8, "lazy dog"), (8, "lazy dog")],
        "item_id bigint, text string",
    )
    rows = decontaminate.find_contamination(awkward, benchmark).collect()
    told = {r.doc_id: (r.n_hit, r.item_ids, r.other_items, r.contaminated) for r in rows}
    assert told[1] == (5, [8], 1, True) and told[2] == (0, [], 0, False) and len(rows) == 8
    none = decontaminate.find_contamination(awkward, benchmark.limit(0))
    assert none.agg(F.sum("n_hit")).first()[0] == 0
    assert decontaminate.find_contamination(awkward.limit(0), benchmark).count() == 0
