"""Word and document vectors: steps against plain loops, shards against one run, and what they learn."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerloom.operators import embeddings as e
from offerloom.operators import similarity

TOPICS = [["baker", "bread", "flour", "oven", "dough", "yeast"], ["pilot", "plane", "wing", "airport", "cockpit", "flight"],
          ["judge", "court", "law", "trial", "verdict", "lawyer"]]
FAST = e.Training(size=16, window=3, epochs=30, min_count=2, sample=0, stretch=128, rate=(0.1, 0.005))


def corpus(n=90, seed=3):
    rng = np.random.default_rng(seed)
    return [(i, [str(w) for w in rng.choice(TOPICS[i % 3], 30)]) for i in range(n)]


def test_step_is_the_plain_gradient():
    """Against loops over positions, and against differences of the objective."""
    rng = np.random.default_rng(1)
    n, v, d, negative = 12, 7, 5, 3
    inner, outer, docs = rng.normal(size=(v, d)), rng.normal(size=(v, d)), rng.normal(size=(2, d))
    tokens, reach, pool = rng.integers(0, v, n), rng.integers(1, 4, n), np.array([0, 3, 3, 6])
    begin, end = np.repeat([0, 5], [5, 7]), np.repeat([5, 12], [5, 7])
    doc_of = np.repeat([0, 1], [5, 7])

    def objective(inner, outer, docs):
        total = 0.0
        for i in range(n):
            seen = [j for j in range(max(begin[i], i - reach[i]), min(end[i], i + reach[i] + 1)) if j != i]
            h = (sum(inner[tokens[j]] for j in seen) + docs[doc_of[i]]) / (len(seen) + 1)
            total += np.log(1 / (1 + np.exp(-h @ outer[tokens[i]])))
            total += sum(np.log(1 / (1 + np.exp(h @ outer[p]))) for p in pool if p != tokens[i]) * negative / len(pool)
        return total

    a, b, c, x = e.gradients(inner, outer, tokens, reach, begin, end, pool, negative, docs, doc_of)
    to_inner, to_outer = np.zeros((v, d)), np.zeros((v, d))
    np.add.at(to_inner, tokens, a)
    np.add.at(to_outer, tokens, b)
    np.add.at(to_outer, pool, c)
    for table, got in ((inner, to_inner), (outer, to_outer), (docs, x)):
        for r in range(len(table)):
            for k in range(d):
                table[r, k] += 1e-5
                up = objective(inner, outer, docs)
                table[r, k] -= 2e-5
                down = objective(inner, outer, docs)
                table[r, k] += 1e-5
                assert got[r, k] == pytest.approx((up - down) / 2e-5, rel=2e-3, abs=2e-4)


def by_topic(vectors):
    unit = {w: v / np.linalg.norm(v) for w, v in vectors.items()}
    same = np.mean([unit[a] @ unit[b] for t in TOPICS for a in t for b in t if a < b])
    other = np.mean([unit[a] @ unit[b] for t in TOPICS for u in TOPICS if t is not u for a in t for b in u])
    return same, other


@pytest.fixture(scope="module")
def texts(spark):
    rows = corpus() + [(900, None), (901, []), (902, ["onlyonce"]), (None, ["baker", "oven"]), (None, ["baker", "oven"])]
    return spark.createDataFrame(rows, "doc_id long, tokens array<string>").coalesce(1)


@pytest.mark.parametrize("shard_tokens", [1 << 18, 300])
def test_words_of_a_topic_come_near(texts, shard_tokens):
    model = e.fit(texts, "tokens", e.replace(FAST, shard_tokens=shard_tokens))
    vectors = {r["word"]: np.array(r["vector"]) for r in model.vectors().collect()}
    assert set(vectors) == {w for t in TOPICS for w in t}
    same, other = by_topic(vectors)
    assert same > other + 0.4


def test_one_shard_is_the_plain_run(texts):
    """The distributed fit of one shard equals training in one place, and reruns agree."""
    model, again = e.fit(texts, "tokens", FAST), e.fit(texts, "tokens", FAST)
    mine = {r["word"]: r["inner"] for r in model.words.collect()}
    assert mine == {r["word"]: r["inner"] for r in again.words.collect()}
    start = {r["word"]: r["v"] for r in model.words.select("word", e._start(FAST, F.col("word")).alias("v")).collect()}
    words = sorted(mine)
    rows = [[words.index(w) for w in (t or []) if w in mine] for _, t in [(r["doc_id"], r["tokens"]) for r in texts.collect()]]
    counts = np.bincount(np.concatenate([np.array(r, int) for r in rows]), minlength=len(words)).astype(float)
    inner, outer = np.array([start[w] for w in words], np.float32), np.zeros((len(words), FAST.size), np.float32)
    total = sum(len(r["tokens"] or []) for r in texts.collect())
    e.train(inner, outer, counts, float(total), [np.array(r, np.int64) for r in rows], FAST, [FAST.seed, 0], (0, FAST.epochs))
    assert np.allclose(inner, [mine[w] for w in words], atol=1e-5)


@pytest.mark.parametrize("shard_tokens", [1 << 18, 300])
def test_documents_find_their_copies(spark, shard_tokens):
    rng = np.random.default_rng(9)
    rows = [(i, [*t, *map(str, rng.choice([f"w{k}" for k in range(300)], 25))]) for i, t in corpus(120)]
    rows += [(1000 + i, rows[i][1]) for i in range(0, 40, 4)]  # planted copies
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>").coalesce(1)
    model = e.fit(docs, "tokens", e.replace(FAST, shard_tokens=shard_tokens), documents=True)
    vectors = e.infer(model, docs, "doc_id", "tokens")
    assert vectors.count() == len(rows)
    found = {r["doc_id"]: np.array(r["vector"]) for r in vectors.collect()}
    ids = list(found)
    unit = np.stack([found[i] / np.linalg.norm(found[i]) for i in ids])
    nearest = lambda v, skip: [ids[k] for k in np.argsort(-(unit @ (v / np.linalg.norm(v)))) if ids[k] != skip]
    assert all(nearest(found[i], i)[0] == i - 1000 for i in range(1000, 1040, 4))
    topic = [np.mean([j % 1000 % 3 == i % 1000 % 3 for j in nearest(found[i], i)[:10]]) for i in ids[:30]]
    assert np.mean(topic) > 0.8


def test_an_unseen_copy_finds_its_document(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [*t, *map(str, rng.choice([f"w{k}" for k in range(300)], 25))]) for i, t in corpus(90)]
    docs = spark.createDataFrame(rows, "doc_id long, tokens array<string>").coalesce(1)
    model = e.fit(docs, "tokens", FAST, documents=True)
    vectors = e.infer(model, docs, "doc_id", "tokens")
    unseen = spark.createDataFrame([(k, rows[k][1]) for k in (3, 40, 71)] + [(-1, None), (-2, ["never"]), (-3, rows[3][1])], "k long, tokens array<string>")
    got = {r["k"]: r["vector"] for r in e.infer(model, unseen, "k", "tokens").collect()}
    assert len(got) == 6 and np.allclose(got[-3], got[3], atol=1e-5) and got[-1] is None and got[-2] is None
    for k in (3, 40, 71):
        wanted = F.array(*map(F.lit, got[k]))
        assert similarity.nearest(vectors, "doc_id", "vector", wanted, 1).first()["doc_id"] == k


def test_ascent_reaches_the_best_vector():
    """The vector found is where plain gradient ascent with tiny steps ends, whatever other texts run beside it."""
    rng = np.random.default_rng(2)
    inner, outer = rng.normal(size=(20, 6)), rng.normal(size=(20, 6))
    texts = [rng.integers(0, 20, n) for n in (40, 7, 1, 25)]
    pool, t = np.array([1, 4, 9]), e.Training(size=6, window=2)
    together = np.zeros((4, 6))
    e.ascend(inner, outer, texts, pool, together, t, 300)
    for text, found in zip(texts, together):
        v, n = np.zeros(6), len(text)
        for _ in range(20_000):
            *_, to_doc = e.gradients(inner, outer, text, np.full(n, 2), np.zeros(n, int), np.full(n, n), pool, t.negative, v[None], np.zeros(n, int))
            v = v + 0.01 * (to_doc[0] - v)
        assert np.allclose(found, v, atol=1e-3)


def test_empty(texts):
    model = e.fit(texts.limit(0), "tokens", FAST, documents=True)
    assert model.words.count() == 0
    rare = e.fit(texts.where("doc_id = 902"), "tokens", FAST)
    assert rare.words.count() == 0 and e.infer(rare, texts.limit(3), "doc_id", "tokens").count() == 3


def test_shards_grow_before_they_become_many(texts, monkeypatch):
    """A large corpus is not cut into ever more shards of few tokens, and what the shards return is not written as it is."""
    t = e.Training()
    assert [e.shards_of(n, t) for n in (0, 1, 300_000, 3_000_000, 21_600_000, 216_000_000)] == [1, 1, 3, 12, 21, 206]
    labels, stored = [], e._stored
    monkeypatch.setattr(e, "_stored", lambda df, label: labels.append(label) or stored(df, label))
    monkeypatch.setattr(e, "SHARD_WORDS", 6)
    model = e.fit(texts, "tokens", e.replace(FAST, shard_tokens=1400, rounds=2), documents=True)
    assert labels.count("shard-words") > 1 and labels.count("learned") == 2 and "returned" not in labels
    same, other = by_topic({r["word"]: np.array(r["vector"]) for r in model.vectors().collect()})
    assert same > other + 0.4


def test_a_long_text_ascends_as_if_its_scores_were_kept(monkeypatch):
    rng = np.random.default_rng(6)
    inner, outer = (rng.normal(size=(30, 6)).astype(np.float32) for _ in "ab")
    text, pool, t = rng.integers(0, 30, 2 * e.UNIT + 17), np.array([1, 4, 4, 9]), e.Training(size=6, window=2)
    kept, again = np.zeros((1, 6)), np.zeros((1, 6))
    e.ascend(inner, outer, [text], pool, kept, t, 6)
    monkeypatch.setattr(e, "HELD", 0)
    e.ascend(inner, outer, [text], pool, again, t, 6)
    assert np.allclose(kept, again) and np.abs(kept).max() > 0


def test_words_that_a_stretch_repeats_stay_bounded():
    """Lines of one word and a very common word among others: summed gradients overshot there and grew from step to step."""
    rng = np.random.default_rng(5)
    texts = [np.full(600, 0), np.repeat([1, 2], 400)] + [np.where(rng.random(400) < 0.3, 3, rng.integers(0, 200, 400)) for _ in range(20)]
    counts = np.bincount(np.concatenate(texts), minlength=200).astype(float)
    inner, outer = ((rng.random((200, 100)) - 0.5).astype(np.float32) / 100 for _ in "ab")
    docs = np.zeros((len(texts), 100), np.float32)
    e.train(inner, outer, counts, counts.sum(), texts, e.Training(sample=0), [1], (0, 20), docs)
    assert all(np.isfinite(x).all() and np.abs(x).max() < 20 for x in (inner, outer, docs))
    bent = e._spanned(np.array([1.0, 2, 4, 8]), np.array([1, 2, 1, 1]), np.array([0, 0, 0, 3]), np.array([3, 3, 3, 4]))
    assert bent.tolist() == [2, 5, 2, 0]
    assert e._repeats(np.array([7, 5, 7, 7, 9, 1, 2, 3]), np.full(8, 1)).tolist() == [1, 2, 3, 3, 2, 1, 1, 1]


@pytest.mark.parametrize("shards", [1, 12, 21])
def test_every_shard_has_a_task_of_its_own(spark, shards):
    dealt = e._dealt(spark.range(2000).withColumnRenamed("id", "row"), shards)
    assert dealt.select("shard", "task").distinct().count() == shards
    full = dealt.repartition(shards, "task").select(F.spark_partition_id().alias("p"), "shard").distinct().collect()
    assert len(full) == shards and len({r["p"] for r in full}) == shards
