"""Source mixing: shards of the splitting tree, copies without ids, columns of any name."""

from collections import Counter, defaultdict

import duckdb
import pytest

from offerloom.llm import mixing, oracles

SCHEMA = "doc_id long, text string, source string"
HOT = [(None, f"w{i % 7} " * (1 + i % 40), "big") for i in range(400)] + [(None, "the same row again", "big")] * 300
ROWS = [(i, f"text {i} " * (i % 90), None if i % 9 == 0 else f"s{i % 4}") for i in range(300)] + HOT + [(4, "other text", "s1"), (4, None, "s1"), (4, "", None)]
CLASHES = ["__n", "__rest", "__bits", "__cuts", "__w0", "__from", "mix_pass", "mix_shard", "u", "src", "words", "draws", "row", "h1", "shard", "pass",
           "chance", "copy", "part", "m", "size", "key", "target", "bucket", "a.b"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_reruns_agree_whatever_the_row_order(spark, docs):
    again = spark.createDataFrame(ROWS[::-1], SCHEMA).repartition(7)
    for operator in (mixing.mix_digest, mixing.mix_documents):
        assert Counter(map(tuple, operator(docs).collect())) == Counter(map(tuple, operator(again).collect()))


def test_sql_twin(docs):
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    mine = mixing.mix_digest(docs)
    rel = con.sql(oracles.MIXING_SQL)
    assert mine.columns == rel.columns
    assert Counter(map(tuple, mine.collect())) == Counter(rel.fetchall())


def test_blocks_go_where_the_tree_sends_them(docs):
    shards = 5
    rows = mixing.mix_blocks(docs, block_words=16, shards=shards).collect()
    drawn = defaultdict(Counter)
    for r in rows:
        for d in r["draws"]:
            drawn[r["source"]][d["shard"]] += 1
            assert d["words"] <= r["words"]
    # every source fills its quota, shards differ by the depth of the tree at most
    quotas = {s: sum(c.values()) for s, c in drawn.items()}
    order = sorted({r["source"] for r in rows}, key=lambda s: (s is None, s or ""))
    cells = mixing.split_quotas([quotas.get(s, 0) for s in order], shards)
    assert [[drawn[s][k] for k in range(shards)] for s in order] == cells.tolist()
    sizes = [sum(c[k] for c in drawn.values()) for k in range(shards)]
    assert max(sizes) - min(sizes) <= 3
    # a pass draws a block once, in one shard
    for r in rows:
        assert len({d["pass"] for d in r["draws"]}) == len(r["draws"])
    words = Counter()
    for r in rows:
        words[r["source"]] += sum(d["words"] for d in r["draws"])
    for r in rows:
        assert abs(words[r["source"]] - r["target"]) < 1


def test_columns_of_any_name(spark, docs):
    wide = docs.limit(60)
    for c in CLASHES:
        wide = wide.withColumn(c, docs["source"])
    out = mixing.mix_documents(wide)
    assert out.columns == wide.columns
    plain = mixing.mix_documents(docs.limit(60))
    assert out.count() > 0 and plain.columns == docs.columns
    assert all(r[c] == r["source"] for r in out.select("source", *(f"`{c}`" for c in CLASHES)).collect() for c in CLASHES)


def test_rows_that_differ_in_another_column_stay_apart(spark):
    rows = [(1, "one two three", "s", k) for k in ("x", "y", None)] + [(1, "one two three", "s", "x")]
    out = mixing.mix_documents(spark.createDataFrame(rows, SCHEMA + ", extra string")).collect()
    assert Counter(r["extra"] for r in out)["x"] >= 2 and {r["extra"] for r in out} == {"x", "y", None}


def test_written_shards(docs, spark, tmp_path):
    path = str(tmp_path / "mix")
    mixing.write_mix(docs, path, shards=4, parts=2)
    written = spark.read.parquet(path)
    assert {r["shard"] for r in written.select("shard").distinct().collect()} == {0, 1, 2, 3}
    assert Counter(tuple(r["row"]) for r in written.collect()) == Counter(map(tuple, mixing.mix_documents(docs, shards=4).collect()))


def test_a_large_group_of_equal_rows_is_numbered_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 16)
    rows = spark.createDataFrame([("a", 100), ("b", 1), ("c", 16), ("d", 17)], "h1 string, m long")
    out = defaultdict(list)
    for r in mixing._copies(rows, ["h1"]).collect():
        out[r["h1"]].append(r["copy"])
    assert {k: sorted(v) for k, v in out.items()} == {"a": list(range(100)), "b": [0], "c": list(range(16)), "d": list(range(17))}


def test_empty(docs):
    assert mixing.mix_digest(docs.limit(0)).count() == 0 and mixing.mix_documents(docs.limit(0)).count() == 0
