"""The law of equal bytes on copies that nothing but their place tells apart."""

from collections import Counter, defaultdict

import pytest

from offerloom.llm import sharding

SCHEMA = "doc_id long, text string, shard string, slot string, __key string"
SHARDS = 40


def check(rows, total, largest):
    sizes, slots = Counter(), defaultdict(list)
    for r in rows:
        sizes[r["shard"]] += len((r["text"] or "").encode()) + 16
        slots[r["shard"]].append(r["slot"])
    assert sum(sizes.values()) == total
    assert all(abs(sizes[s] - total / SHARDS) <= 2 * largest + 0.01 * total / SHARDS for s in range(SHARDS))
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


@pytest.mark.parametrize("doc_id", [None, 7])
def test_copies_without_an_id_or_with_one(spark, doc_id):
    rows = [(doc_id, "the same text " * 15)] * 4000 + [(i, f"text {i} " * (i % 40)) for i in range(4000)] + [(None, None)] * 300
    docs = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(6)
    out = sharding.shard_documents(docs)
    assert sorted(out.columns) == sorted(docs.columns)
    got = out.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(rows)
    sizes = [len((t or "").encode()) + 16 for _, t in rows]
    check(got, sum(sizes), max(sizes))


def test_digest_follows_the_same_law(spark):
    rows = [(None, "abc")] * 3000 + [(i, "x" * (i % 100)) for i in range(2000)]
    digest = sharding.shard_digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    sizes = Counter()
    for r in digest:
        sizes[r["shard"]] += r["size"]
    total = sum(sizes.values())
    assert total == sum(len(t) + 16 for _, t in rows)
    assert all(abs(sizes[s] - total / SHARDS) < 250 for s in range(SHARDS))
