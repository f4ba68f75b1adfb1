"""Exact top-k search against all scores, and its SQL twin."""

import math
from collections import Counter

import duckdb
import numpy as np
import pytest

from offerloom.llm import oracles, topk

SCHEMA = "vec_id long, embedding array<float>, c string, v string, score string, rank string, block string"
RNG = np.random.default_rng(5)
PLAIN = [(i, (RNG.normal(size=8) / 3).astype(np.float32).tolist()) for i in range(230)]
SAME = [(1000 + i, [0.5] * 8) for i in range(60)]  # a large group of copies, queries among them
ODD = [(20, None), (40, [0.1, None] * 4), (60, [float("nan")] * 8), (80, [float("inf")] + [0.0] * 7), (None, [0.5] * 8), (None, [0.25] * 8),
       (1020, [0.5] * 8), (1020, [-0.5] * 8), (2000, [0.0] * 8), (2020, []), (2021, [0.5, 0.5]), (2040, [9.0] * 8), PLAIN[7], PLAIN[20]]


def brute(rows, k=20):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for n, (i, q) in enumerate(kept):
        if i is not None and i % 20 == 0:
            scored = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0, j) for m, (j, v) in enumerate(kept) if m != n]
            out.update((i, r, j, -s) for r, (s, _, _, j) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["clash"] * 5) for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("block, query_block", [(topk.BLOCK, topk.QUERIES), (40, 5)])
def test_all_scores(spark, block, query_block):
    rows = PLAIN + SAME + ODD
    out = topk.top_k(frame(spark, rows), block=block, query_block=query_block)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert Counter(tuple(r) for r in out.collect()) == brute(rows)


def test_few_and_none(spark):
    assert topk.top_k(frame(spark, PLAIN).limit(0)).count() == 0
    assert Counter(tuple(r) for r in topk.top_k(frame(spark, PLAIN[:5])).collect()) == brute(PLAIN[:5])
    assert topk.top_k(frame(spark, PLAIN[:1])).count() == 0


def test_sql_twin(spark):
    rows = [r for r in PLAIN + SAME + ODD if r[0] not in (2020, 2021)]
    con = duckdb.connect()
    con.register("embeddings", frame(spark, rows).select("vec_id", "embedding").toArrow())
    assert Counter(con.sql(oracles.TOP_K_SQL).fetchall()) == brute(rows)


def one_block(values):
    import pyarrow as pa
    table = topk.index_block(pa.table({"block": [0] * len(values), "c": np.arange(len(values)), "v": values.tolist(), "first_id": np.arange(len(values)) * 3}))
    at = np.argsort(table["dim"].to_numpy(), kind="stable")
    return topk.Block(table["dim"].to_numpy()[at], table["level"].to_numpy()[at], [table["members"].to_pylist()[i] for i in at])


@pytest.mark.parametrize("scale", [1, 64, 1 << 20, topk.MOST])
def test_bounds_hold_at_every_magnitude(scale):
    values = np.rint(RNG.uniform(-1, 1, (700, 16)) * scale).astype(np.int64)
    values[500:520] = values[3]
    search = topk.Search(values[:60], 21)
    search.run(one_block(values))
    exact = values[:60].astype(object) @ values.astype(object).T
    for q in range(60):
        best = sorted(range(700), key=lambda c: (-exact[q, c], c))[:21]
        assert search.best[q].tolist() == best
        assert search.score[q].tolist() == [exact[q, c] for c in best]


def test_stops_on_proof_before_all_is_read():
    """Queries with near copies are proved early: small impacts stay unread and few vectors are scored exactly."""
    base = RNG.normal(size=(20, 32)) * 12
    base[:, 4:] /= 20  # few dimensions carry the score
    values = np.rint(np.repeat(base, 100, axis=0) + RNG.normal(size=(2000, 32)) * 0.3).astype(np.int64)
    search = topk.Search(values[::50], 21)
    search.run(one_block(values))
    segments = len(one_block(values).postings)
    assert search.processed < 0.7 * 40 * segments
    assert search.rescored < 0.2 * 40 * 2000
