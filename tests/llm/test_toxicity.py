"""Parts of the toxicity network against brute force: gradients, windows, and labelled texts above the driver's bound."""

import numpy as np
from pyspark.sql import Row

from offerloom.llm import toxicity as tox
from offerloom.llm.common import held_out


def _loss(net, x, ids, y, weight):
    q = tox.sigmoid(net.run(net.project(x), ids))
    return float((weight * -(y * np.log(q) + (1 - y) * np.log(1 - q))).sum() / weight.sum())


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    net = tox.Network(5)
    net.p = {k: a.astype(np.float64) for k, a in net.p.items()}
    x = rng.standard_normal((9, tox.DIM))
    x[0] = 0
    ids = rng.integers(1, 9, (6, tox.WINDOW))
    ids[0, 5:] = 0
    ids[1] = 0
    y, weight = np.array([1.0, 0, 1, 0, 1, 0]), np.array([2.0, 1, 2, 1, 2, 1])
    grads, dx = net.gradients(x, ids, y, weight)
    step = 1e-3

    def slope(array, at):
        kept = array[at]
        array[at] = kept + step
        high = _loss(net, x, ids, y, weight)
        array[at] = kept - step
        low = _loss(net, x, ids, y, weight)
        array[at] = kept
        return (high - low) / (2 * step)

    for name, grad in grads.items():
        for flat in rng.integers(0, grad.size, 6):
            at = np.unravel_index(flat, grad.shape)
            assert abs(slope(net.p[name], at) - grad[at]) < 1e-3 + 0.02 * abs(grad[at]), name
    for flat in rng.integers(tox.DIM, x.size, 8):
        at = np.unravel_index(flat, x.shape)
        assert abs(slope(x, at) - dx[at]) < 1e-3 + 0.02 * abs(dx[at])


def test_windows_cover_every_start_of_half_a_window():
    size = np.array([0, 1, 32, 33, 48, 49, 200])
    ids = np.arange(1, size.sum() + 1)
    windows, owner = tox.window_ids(ids, size)
    begin = np.cumsum(size) - size
    for k, n in enumerate(size):
        mine = [set(w[w > 0].tolist()) for w in windows[owner == k]]
        for start in range(max(1, n - tox.STRIDE + 1)):
            passage = set(ids[begin[k] + start:begin[k] + min(n, start + tox.STRIDE)].tolist())
            assert any(passage <= w for w in mine), (n, start)


def _row(i, bad, size):
    rng = np.random.default_rng(i)
    words = [f"w{rng.integers(300)}" for _ in range(size)]
    if bad:
        at = int(rng.integers(size))
        words[at:at] = ["nasty", "horrid", "awful"]
    return Row(doc_id=i, text=" ".join(words), lang="en")


def test_hottest_windows_hold_the_planted_words():
    rows = [_row(i, i % 2, 60) for i in range(400)]
    net = tox.train([r.text.encode() for r in rows], np.array([i % 2 for i in range(400)], np.float64))
    long = _row(9_001, True, 30_000)
    kept = tox.hottest(net, long.text.encode(), 4)
    assert b"nasty" in kept and len(kept.split()) <= 4 * tox.WINDOW
    assert tox.hottest(net, None, 4) == b"" and tox.hottest(net, b"!" * 500, 4) == b""


def test_labelled_texts_above_the_bound_are_learned_from(spark):
    """Only long texts hold the second kind of toxic word, so scores of it come from their windows alone."""
    rows = [_row(i, i % 2, 50) for i in range(700)]
    rows += [Row(doc_id=i, text=_row(i, i % 2, 400).text + (" vile nasty vile" if i % 2 else ""), lang="en") for i in range(700, 1000)]
    docs = spark.createDataFrame(rows)
    labels = spark.createDataFrame([Row(doc_id=r.doc_id, quality=1, toxic=r.doc_id % 2) for r in rows])
    net = tox.fit(docs, labels, rows=1000, most_chars=1000, long_windows=8)
    again = tox.fit(docs, labels, rows=1000, most_chars=1000, long_windows=8)
    assert all(np.array_equal(net.p[k], again.p[k]) for k in net.p) and net.shift == again.shift
    held = [r.doc_id for r in docs.where(held_out(docs.doc_id)).select("doc_id").collect()]
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(held), pa.array([rows[i].text.encode() for i in held])], ["doc_id", "text"])
    score = np.asarray(next(tox.score_batches(net, [batch])).column(1))
    right = (score >= tox.THRESHOLD) == (np.array(held) % 2 == 1)
    assert right.mean() > 0.95
