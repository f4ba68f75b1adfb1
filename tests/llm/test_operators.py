"""The training-data operators on awkward small tables, against plain Python."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from offerloom.llm import (decontaminate, mixing, oracles, quality_neighbours, rule_forest, secret_scan, sharding,
                           simhash_dedup, substring_dedup, token_counts, toxicity)

SCHEMA = "doc_id long, text string, source string, shard string, size string, draws string, component_id string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PASSAGE = " ".join(f"p{i}" for i in range(60))
LINES = [" ".join(f"w{i}x{j % 17}y{(i * j) % 23}" for j in range(80)) for i in range(12)]
TEXTS = [None, "", " \t\n", "one", "One  one\x0bone", PASSAGE, "a b " + PASSAGE + " c d", LINES[0], LINES[0], LINES[1],
         LINES[1] + " tail", "é è " * 60, " ".join(LINES), "x" * 5000, "loop a b c " * 40, *LINES]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 5 == 0 else f"s{i % 3}", "clash", "clash", "clash", "clash") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows + [rows[7], (None, "no id here", "s1", *["clash"] * 4)], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(len(TEXTS))], "doc_id long, quality int, toxic int")


def words(text):
    return WORD.findall(text or "")


def test_token_counts(docs, empty):
    pieces = {*token_counts.read_pieces(), *(bytes([c]) for c in range(256))}
    longest = max(map(len, pieces))

    def greedy(word):
        data, at, n = token_counts.MARK + word.encode(), 0, 0
        while at < len(data):
            end = min(len(data), at + longest)
            while data[at:end] not in pieces:
                end -= 1
            at, n = end, n + 1
        return n

    for r in token_counts.token_counts(docs).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        assert (r["n_words"], r["n_tokens"]) == (len(words(r["text"])), sum(map(greedy, words(r["text"]))))
    assert token_counts.token_counts(docs).count() == docs.count()
    assert token_counts.token_counts(empty).count() == 0


@pytest.mark.parametrize("module, name", [(quality_neighbours, "quality_scores"), (toxicity, "toxicity_scores")])
def test_classifiers(docs, empty, labels, module, name):
    out = getattr(module, name)(docs, labels).collect()
    assert len(out) == docs.count() and all(0 <= r["score"] <= 1 for r in out)
    assert getattr(module, name)(empty, labels).count() == 0
    assert getattr(module, name)(docs, labels.where("false")).count() == docs.count()


def test_toxicity_learns():
    rng = np.random.default_rng(0)
    plain = lambda: [f"word{i}" for i in rng.integers(0, 300, 60)]
    texts, y = [], []
    for i in range(800):
        w = plain()
        if i % 2:
            w[int(rng.integers(0, 60))] = "vile" + str(rng.integers(0, 9))
        texts.append(" ".join(w).encode())
        y.append(i % 2)
    net = toxicity.train(texts[:640], np.array(y[:640], float), rounds=20)
    table_words = [toxicity.split(t) for t in texts[640:]]
    number = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for ws in table_words for w in ws))}
    table = np.concatenate([np.zeros((1, 6 * toxicity.HIDDEN)), net.project(net.inputs(*toxicity.word_features(list(number))))]).astype(np.float32)
    ids, owner = toxicity.window_ids(np.array([number[w] for ws in table_words for w in ws]), np.array([len(w) for w in table_words]))
    best = np.maximum.reduceat(net.run(table, ids), np.flatnonzero(np.diff(owner, prepend=-1)))
    assert ((net.probability(best) >= 0.7) == np.array(y[640:])).mean() > 0.9


def test_simhash(docs, empty):
    def plain(text):
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        parts = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    rows = simhash_dedup.near_digest(docs).collect()
    source = docs.select("doc_id", "text").collect()
    prints = Counter((r["doc_id"], f"{plain(r['text']):016x}") for r in source)
    assert prints == Counter((r["doc_id"], r["fingerprint"]) for r in rows)
    group = {(r["doc_id"], r["fingerprint"]): r["doc_id"] for r in rows}
    low = {k: k[0] if k[0] is not None else 1 << 60 for k in group}
    for _ in group:
        for a in group:
            for b in group:
                if (int(a[1], 16) ^ int(b[1], 16)).bit_count() <= 4:
                    low[a] = low[b] = min(low[a], low[b])
    assert all(low[r["doc_id"], r["fingerprint"]] == (r["component_id"] if r["component_id"] is not None else 1 << 60) for r in rows)
    assert simhash_dedup.near_digest(empty).count() == 0
    kept = simhash_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.where("doc_id IN (7, 8)").count() == 1


def test_near_copies_are_dropped_by_row_and_not_by_id(spark):
    a, b, c, d = LINES[0], LINES[4], LINES[8], PASSAGE
    rows = [(3, a), (7, a), (7, b), (5, c), (5, d), (None, a), *[(None, LINES[11])] * 3, (9, b), (None, LINES[6])]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame([(i, t, "x") for i, t in order], "doc_id long, text string, __row string")
        kept = simhash_dedup.drop_near_duplicates(docs)
        assert kept.columns == docs.columns
        assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(
            [(3, a), (7, b), (5, c), (5, d), (None, LINES[11]), (None, LINES[6])])


def test_simhash_hot_key(spark, monkeypatch):
    """Keys with more fingerprints than a block are compared block by block."""
    monkeypatch.setattr(simhash_dedup, "BLOCK", 8)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 6)
    values = sorted({int(b) ^ sum(1 << int(k) for k in rng.integers(0, 62, rng.integers(0, 4))) for b in base for _ in range(60)})
    links = simhash_dedup.near_links(spark.createDataFrame([(v,) for v in values], "fp long")).collect()
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in links:
        assert (r["a"] ^ r["b"]).bit_count() <= 62
        root[find(r["a"])] = find(r["b"])
    mine = {v: find(v) for v in values}
    root.update({v: v for v in values})
    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= 4:
                root[find(a)] = find(b)
    assert len({*mine.values()}) == len({find(v) for v in values})


def test_quality_rules(docs, empty, labels):
    for r in rule_forest.rule_digest(docs, labels).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
        text = r["text"] or ""
        w, lines = words(text), [x for x in text.split("\n") if WORD.search(x)]
        seen = Counter(zip(w, w[1:], w[2:]))
        covered = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
        assert [r[k] for k in rule_forest.RULES] == [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len({*lines}), len(covered)]
        assert r["base_failed"] == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r["kept"] and r["base_failed"])
    assert rule_forest.rule_digest(empty, labels).count() == 0
    assert rule_forest.keep_documents(docs, labels.where("false")).columns == docs.columns


def test_forest_separates():
    rng = np.random.default_rng(2)
    x = np.abs(rng.normal(0, 0.01, (600, len(rule_forest.FEATURES))))
    y = np.ones(600, int)
    x[:60, 0], y[:60] = 0.4, 0
    judge = rule_forest.train(x, y)
    counts = np.tile([100, 500, 0, 0, 0], (600, 1))
    assert not judge.kept(counts, x)[:60].any() and judge.kept(counts, x)[60:].mean() > 0.99


@pytest.fixture(scope="module")
def con(docs, spark):
    connection = duckdb.connect()
    documents, benchmark = docs.toPandas(), BENCHMARK  # noqa: F841
    connection.execute("CREATE TABLE documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, text, source FROM documents")
    connection.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO benchmark VALUES (?, ?)", BENCHMARK)
    return connection


BENCHMARK = [(1, PASSAGE), (2, None), (3, ""), (4, "no id"), (5, LINES[3]), (5, LINES[3]), (6, " ".join(PASSAGE.split()[3:58])), (None, "one")]


def same(df, con, sql):
    names = sorted(df.columns)
    other = con.sql("SELECT " + ", ".join(names) + f" FROM ({sql})").fetchall()
    assert Counter(tuple(r[n] for n in names) for r in df.collect()) == Counter(other)


def test_decontamination(docs, empty, spark, con):
    benchmark = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    found = decontaminate.contaminations(docs, benchmark)
    same(found, con, oracles.DECONTAMINATION_SQL)
    same(decontaminate.contaminations(docs, benchmark, chunk_rows=40), con, oracles.DECONTAMINATION_SQL)
    assert {5, 6} <= {r["doc_id"] for r in found.collect()}
    assert decontaminate.contaminations(empty, benchmark).count() == 0
    assert decontaminate.contaminations(docs, benchmark.where("false")).count() == 0
    assert decontaminate.drop_contaminated(docs, benchmark).where("doc_id IN (5, 6, 12)").count() == 0


def test_contaminated_rows_are_dropped_by_row_and_not_by_id(spark):
    leak = f"a b {PASSAGE} c d"
    rows = [(None, leak), (None, LINES[1]), (None, None), (4, leak), (4, LINES[2]), (4, LINES[2]), (6, LINES[3]), (8, "")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, __hit string")
    benchmark = spark.createDataFrame([(1, PASSAGE), (None, LINES[3]), (2, None), (None, None)], "item_id long, text string")
    kept = decontaminate.drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(
        [(None, LINES[1]), (None, None), (4, LINES[2]), (4, LINES[2]), (8, "")])


def test_substring_dedup(docs, empty, con):
    same(substring_dedup.substring_digest(docs), con, oracles.SUBSTRING_SQL)
    assert substring_dedup.substring_digest(empty).count() == 0
    kept = {r["doc_id"]: r["kept_text"] for r in substring_dedup.remove_repeats(docs).collect()}
    assert kept[6] == "a b c d" and kept[5] == "" and kept[3] == "one"


def test_rows_that_repeat_an_id_keep_their_own_words(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    rows = [(1, f"head {passage}", "x"), (1, "other words", "y"), (2, f"{passage} tail", "z"), (None, "no id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    kept = {(r["doc_id"], r["kept_text"]) for r in substring_dedup.remove_repeats(docs).collect()}
    assert kept == {(1, "head"), (1, "other words"), (2, "tail"), (None, "no id")}


def test_marked_sequences_meet_their_texts_by_id_and_sequence(spark, monkeypatch):
    plans, stored = {}, substring_dedup.stored
    monkeypatch.setattr(substring_dedup, "stored", lambda df, label: plans.setdefault(label, df._jdf.queryExecution().optimizedPlan().toString()) and stored(df, label))
    rows = [(None, f"a{i} {PASSAGE} b{i}") for i in range(3)] + [(None, LINES[2]), (None, LINES[2])]
    kept = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(r["kept_text"] for r in kept.collect()) == Counter({"a0 b0": 1, "a1 b1": 1, "a2 b2": 1, "": 2})
    assert re.search(r"Join Inner, .*own_?\w*#\d+.*seq#\d+", plans["substring-texts"])


def test_texts_of_the_substring_search_pass_to_python_in_short_batches(spark, monkeypatch):
    seen, stored, conf = [], substring_dedup.stored, "spark.sql.execution.arrow.maxRecordsPerBatch"

    def note(df, label):
        seen.append((df._jdf.queryExecution().optimizedPlan().toString(), int(spark.conf.get(conf))))
        return stored(df, label)

    monkeypatch.setattr(substring_dedup, "stored", note)
    before = spark.conf.get(conf)
    rows = [(1, f"head {PASSAGE}"), (2, f"{PASSAGE} tail"), (None, None)]
    found = substring_dedup.substring_digest(spark.createDataFrame(rows, "doc_id long, text string"))
    python = re.compile("MapInArrow|ArrowEval|PythonUDF")
    assert [size for plan, size in seen if python.search(plan)] == [512] * 4
    assert not python.search(found._jdf.queryExecution().optimizedPlan().toString()) and spark.conf.get(conf) == before
    assert not any(re.search("ArrowEval|PythonUDF", plan) for plan, _ in seen)  # one kind of worker serves all


def test_fingerprinted_texts_pass_to_python_in_short_batches(spark, monkeypatch):
    seen, stored, conf = [], simhash_dedup.stored, "spark.sql.execution.arrow.maxRecordsPerBatch"

    def note(df, label):
        seen.append((label, "MapInArrow" in df._jdf.queryExecution().optimizedPlan().toString(), int(spark.conf.get(conf))))
        return stored(df, label)

    monkeypatch.setattr(simhash_dedup, "stored", note)
    before = spark.conf.get(conf)
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e"), (None, None)], "doc_id long, text string")
    assert simhash_dedup.near_groups(docs).count() == 3 and simhash_dedup.drop_near_duplicates(docs).count() == 2
    assert [size for label, python, size in seen if python and label != "simhash-links"] == [512] * 2 and spark.conf.get(conf) == before


def test_mixing(docs, empty, con):
    same(mixing.mix_digest(docs), con, oracles.MIXING_SQL)
    assert mixing.mix_digest(empty).count() == 0
    copies = mixing.mix_documents(docs)
    assert copies.columns == docs.columns and copies.count() > 0


def test_mixing_quotas():
    quotas = np.array([1000, 10, 0, 517])
    parts = mixing.split_quotas(quotas, 7)
    assert (parts.sum(axis=1) == quotas).all() and np.ptp(parts.sum(axis=0)) <= 7 and (parts >= 0).all()
    assert mixing.targets([100, 10, 0], [1, 1, 1]) == [145.0, 20.0, 0.0]


def test_secrets(spark, empty):
    key = "AKIA" + "ABCDEFGH01234567"
    texts = [None, "", "é token: abcdefghijklmnop and secret=short", "password==" + "a1" * 8, key + " AKIA12", "0123456789abcdef" * 2 + " deadbeef",
             "blob q8Zr2LkV9xTn4WbY7cJd1MfH3sGp end", "secret:token:abcdefghijklmnop", "example_q8Zr2LkV9xTn4WbY7cJd1MfH3sGp", "API_KEY = 'Zz9" + "b" * 20 + "'"]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, base string, spans string")
    assign = re.compile(secret_scan.ASSIGN.replace("(?i)", ""), re.I | re.A)
    for r in secret_scan.secret_digest(docs).collect():
        text = texts[r["doc_id"]] or ""
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer(secret_scan.ACCESS, text) if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer(secret_scan.HEX, text) if len(m[0]) >= 16]
        line = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        extra = [s for s in r["spans"].split(",") if s.startswith("entropy")]
        assert bool(extra) == (r["doc_id"] == 6)
        if extra:
            begin, end = map(int, extra[0].split(":")[1:])
            assert text[begin:end] in text.split()[1] and _entropies(text.split()[1]) >= 3.7
    assert secret_scan.secret_digest(empty).count() == 0


def test_entropy_class_is_that_of_the_window(spark):
    upper = "9F86D081884C7D659A2FEAA0C55AD015"
    texts = [upper, f"SIG={upper}", f"x-{upper}_y", "2024-01-02/1234-5678-9012-3456", "KEY=" + "7" * 30, "9" * 9 + "8765432101234567890123"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    spans = {r["doc_id"]: r["spans"] for r in secret_scan.secret_digest(docs).collect()}
    for i in range(3):
        begin, end = map(int, spans[i].split(":")[1:])
        assert spans[i].startswith("entropy:") and "," not in spans[i]
        assert begin <= texts[i].index(upper) + 1 and end >= texts[i].index(upper) + 31
    assert spans[3] == "" and spans[4] == "hex:4:34" and spans[5] == f"hex:0:{len(texts[5])}"


def _entropies(string):
    best = 0.0
    for i in range(len(string) - 19):
        share = np.array(list(Counter(string[i:i + 20]).values())) / 20
        best = max(best, float(-(share * np.log2(share)).sum()))
    return best


def test_sharding(docs, empty, spark):
    many = docs.unionByName(docs.select(*[(F.col("doc_id") + 1000).alias(c) if c == "doc_id" else F.lit("same " * 9).alias(c) if c == "text" else c for c in docs.columns]))
    for shards in (1, 3):
        rows = sharding.shard_digest(many, shards).collect()
        assert len(rows) == many.count()
        for s in range(shards):
            slots = sorted(r["slot"] for r in rows if r["shard"] == s)
            assert slots == list(range(len(slots)))
        sums = [sum(r["size"] for r in rows if r["shard"] == s) for s in range(shards)]
        assert max(sums) - min(sums) <= 2 * max(r["size"] for r in rows)
    assert sharding.shard_digest(empty).count() == 0
    full = sharding.shard_documents(docs, 2)
    assert set(docs.columns) | {"slot"} == set(full.columns) and full.count() == docs.count()


def test_components(spark):
    from offerloom.llm.common import components
    chain = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (300, 300)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and found[200] == found[150] == found[100] == 100 and 300 not in found


def test_labelled_sample_bounds_rows_and_not_only_ids(spark):
    from offerloom.llm.common import labelled_sample
    known = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    rows = [(i, f"text {j} of {i}") for i in range(30) for j in range(9)] + [(0, None), (None, "no id")]
    runs = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, "doc_id long, text string")
        for balanced in (False, True):
            sample = labelled_sample(docs, known, "quality", 10, balanced).collect()
            assert len(sample) == len({r["doc_id"] for r in sample}) == 10
            runs.append({(r["doc_id"], r["text"], r["label"]) for r in sample})
    assert runs[0] == runs[2] and runs[1] == runs[3]


def test_rules_learn_from_all_labelled_rows(spark):
    rng = np.random.default_rng(4)
    text = lambda i: " ".join(f"w{rng.integers(0, 40 + i % 60)}{'#' * (20 if i % 10 == 0 else int(rng.integers(0, 3)))}" for _ in range(60 + i % 30))
    known = spark.createDataFrame([(i, 0 if i % 10 == 0 else 1, 0) for i in range(400)], "doc_id long, quality int, toxic int")
    rows = spark.createDataFrame([(i, text(i)) for i in range(400)], "doc_id long, text string").cache()
    whole, dealt = rule_forest.fit(rows, known), rule_forest.fit(rows, known, rows=10)
    assert dealt.low == pytest.approx(whole.low) and dealt.high == pytest.approx(whole.high)
    kept = [r for r in rows.join(known, "doc_id").collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1]
    each = [rule_forest.statistics(r["text"].encode()) for r in kept]
    ok = ~rule_forest._base_failed(np.array([e[0] for e in each]))
    x, y = np.array([e[1] for e in each])[ok], np.array([r["quality"] for r in kept])[ok]
    assert np.isfinite(dealt.cut) and dealt.cut == pytest.approx(rule_forest.calibrate(dealt.forest.score(dealt.excess(x)), y, 0.001))
