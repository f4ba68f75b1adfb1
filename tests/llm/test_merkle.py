"""The Merkle manifest on awkward rows, against a plain tree, and against its SQL twin."""

import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from offerloom.llm import merkle, oracles

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, pos string, size string, digest string, block string, wanted string"
ROWS = [(i, None if i % 4 == 0 else f"s{i % 3}", [None, "en", "de", "é", ""][0 if i % 3 == 0 else i % 5], None if i % 6 == 0 else i,
         [None, "", "text é", "x" * 30_000][i % 4]) for i in range(61)]
ROWS += [ROWS[7]] * 3 + [(None, "s", "en", 3, f"no id {i % 2}") for i in range(6)] + [(5, "other", "en", None, "same id"), (900, "s", "zz", 1, "alone")]
ROWS += [(None, None, None, None, None), (901, "s", "max", 2**63 - 1, "long")]


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute(rows):
    trees = defaultdict(list)
    for row in rows:
        trees[row[2]].append((row[0] is not None, row[0] or 0, leaf(row), row))
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
        return out

    built = {t: levels([x[2] for x in sorted(trees[t], key=lambda x: x[:3])]) for t in names}
    top = levels([built[t][-1][0] for t in names])
    out = Counter()
    for k, t in enumerate(names):
        for i, (_, _, digest, row) in enumerate(sorted(trees[t], key=lambda x: x[:3])):
            found = digest
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0 and row[3] is not None:
                found = leaf((*row[:3], row[3] + 1, row[4]))
            siblings, folded = [], found
            for at, tree in ((i, built[t]), (k, top)):
                for level in tree[:-1]:
                    pair = level[at // 2 * 2:at // 2 * 2 + 2]
                    siblings += [x for j, x in enumerate(pair) if j != at % 2]
                    folded = h("".join(folded if j == at % 2 else x for j, x in enumerate(pair)))
                    at //= 2
            out[row[0], digest, built[t][-1][0], top[-1][0], h("".join(siblings)), folded, folded == top[-1][0]] += 1
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *["clash"] * 5) for r in ROWS], SCHEMA)


@pytest.mark.parametrize("tier", [1, 2, 10])
def test_digest_is_the_plain_tree(docs, tier):
    out = merkle.manifest_digest(docs.repartition(5), tier)
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = Counter(tuple(r) for r in out.collect())
    assert rows == brute(ROWS)
    assert {r[-1] for r in rows} == {True, False}


def test_sql_twin(docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "source", "lang", "n_chars", "text").where("n_chars is null or n_chars < 1000000").toArrow())
    rows = [r for r in ROWS if (r[3] or 0) < 1_000_000]
    assert Counter(con.sql(oracles.MANIFEST_SQL).fetchall()) == brute(rows)


def test_small_and_empty(spark, docs):
    assert merkle.manifest_digest(docs.limit(0)).count() == 0
    one = merkle.manifest_digest(docs.where("doc_id = 900")).collect()
    assert Counter(tuple(r) for r in one) == brute([r for r in ROWS if r[0] == 900])
    assert one[0]["proof_sha256"] == h("")


def test_proofs_of_wanted_leaves(docs):
    manifest = merkle.build(docs, tier=2)
    some = merkle.proofs(manifest, F.col("order_key") % 20 == 3, tier=2)
    rows = some.collect()
    assert sorted(r["order_key"] for r in rows) == [3, 23, 43]
    for r in rows:
        assert merkle.fold(r["digest"], r["path"])[0] == manifest.root
        assert merkle.fold(h("forged"), r["path"])[0] != manifest.root


def test_only_every_other_level_is_stored(docs):
    manifest = merkle.build(docs.withColumn("lang", F.lit("one")), tier=2)
    sizes = [t.count() for t in manifest.tiers]
    assert sizes == [len(ROWS), -(-len(ROWS) // 4), -(-len(ROWS) // 16), -(-len(ROWS) // 64)][:len(sizes)] + [1] * (len(sizes) - 4)
