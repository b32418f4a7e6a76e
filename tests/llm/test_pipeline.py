"""The stages of the corpus pipeline, each on what the one before kept, against brute force."""

import collections

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from feedlake.llm import mixing, tokens
from feedlake.llm.common import read_table
from feedlake.plans.shared import settle
from tests.llm.test_operators import SF, brute_groups, brute_hits


def test_every_stage_equals_brute_force(spark):
    docs = read_table(spark, SF, "documents")
    columns = docs.columns
    given = docs.collect()
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = settle(stage(spark, docs, SF), f"test_{name}")
        assert docs.columns == columns
        kept[name] = docs.collect()

    told = [r for r in given if any(c.isalpha() for c in r.text or "")]
    assert sorted(r.doc_id for r in kept["language"]) == sorted(r.doc_id for r in told)
    assert all(r.lang for r in kept["language"])

    told = sorted(kept["language"], key=lambda r: r.doc_id)
    groups = brute_groups([r.text for r in told])
    firsts = [r for k, r in enumerate(told) if groups[k][1] == k]
    assert sorted(r.doc_id for r in kept["ngram_join"]) == [r.doc_id for r in firsts]
    assert len(firsts) < len(told)

    items = [(r.item_id, r.text) for r in read_table(spark, SF, "benchmark").collect()]
    hits = brute_hits([r.text for r in firsts], items)
    clean = [r for r, hit in zip(firsts, hits, strict=True) if not hit[-1]]
    assert sorted(kept["decontaminate"]) == sorted(clean)
    assert len(clean) < len(firsts)

    taken = collections.Counter(kept["mix"])
    assert set(taken) <= set(clean) and max(taken.values()) <= mixing.MOST_REPEATS
    sizes, words = collections.Counter(), collections.Counter()
    longest = collections.Counter()
    for r in clean:
        size = len(r.text.split())
        sizes[r.source] += size
        longest[r.source] = max(longest[r.source], size)
    for r, times in taken.items():
        words[r.source] += times * len(r.text.split())
    clean_docs = spark.createDataFrame(clean, docs.schema)
    targets = {r.source: r.target for r in mixing.plan_mix(clean_docs).collect()}
    assert set(targets) == set(sizes)
    for source, target in targets.items():
        assert target <= mixing.MOST_REPEATS * sizes[source] + 1e-6
        assert abs(words[source] - target) <= longest[source]

    shards = settle(corpus_pipeline.STAGES[-1][1](spark, docs, SF), "test_tokens")
    parts = collections.defaultdict(collections.Counter)
    for _, doc_id, part, own in tokens.read_slots(shards, 0, 1 << 40):
        parts[doc_id][part, own.tobytes()] += 1
    expected = collections.defaultdict(collections.Counter)
    for r, times in taken.items():
        whole = tokens.encode(r.text)
        for part, first in enumerate(range(0, len(whole), tokens.LENGTH)):
            expected[r.doc_id][part, whole[first : first + tokens.LENGTH].tobytes()] += times
    assert parts == expected


@pytest.mark.parametrize("kind", ["empty", "awkward"])
def test_run_on_few_and_odd_documents(spark, tmp_path, awkward, kind):
    docs = read_table(spark, SF, "documents")
    if kind == "empty":
        docs = docs.limit(0)
    else:
        odd = awkward.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
        docs = docs.where("doc_id > 10").unionByName(odd, allowMissingColumns=True)
    docs.coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    read_table(spark, SF, "benchmark").write.parquet(str(tmp_path / "benchmark.parquet"))
    shards = settle(corpus_pipeline.run(spark, str(tmp_path)), "test_run")
    ids = {i for row in shards.collect() for i in row.doc_ids}
    assert (len(ids) > 0) == (kind == "awkward")
    assert not ids & {2, 3, 5, 6}  # no letter in them


def test_stages_keep_further_columns(spark, awkward):
    docs = awkward.withColumn("n_chars", F.lit(0).cast("bigint")).withColumn("key", F.lit("k"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        known = [tuple(r) for r in docs.select("doc_id", "score", "spans", "key").collect()]
        assert {tuple(r) for r in out.select("doc_id", "score", "spans", "key").collect()} <= set(known)
