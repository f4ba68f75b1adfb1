"""Quality rules judged by an isolation forest.

Every document is described by rule statistics (shares, so that length by itself is not odd). Each rule measures how
far a share lies outside the range of the rows labelled good, as a part of that range's width. Trees split a bounded
sample of these excesses at random; documents that random splits isolate early have short paths and a high anomaly
score. The ranges and the score above which a document goes are calibrated on the labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import free_name, held_out, labelled_sample, stored
from offerloom.operators.ranking import top_per_group

MIN_WORDS = 50
MOST_REPEATED = 50
SYMBOLS = [bytes([c]) for c in b"#*$%&|<>"]
UPPER = bytes(range(65, 91))
RULES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("symbols", "repeated", "echoes", "dup_lines", "upper", "exclamations", "word_length")


def statistics(text: bytes | None) -> tuple[list[int], list[float]]:
    """The five base counts and the features of one text; a null text has no words."""
    text = text or b""
    words = text.split()
    n = len(words)
    if not n:
        return [0, 0, sum(text.count(c) for c in SYMBOLS), 0, 0], [0.0] * len(FEATURES)
    body = b"".join(words)
    raw = np.frombuffer(body, np.uint8)
    chars = int(((raw & 0xC0) != 0x80).sum())
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split(b"\n") if x.strip()]
    dup_lines = len(lines) - len(set(lines))
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    repeated = 0
    if n >= 3:
        pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        _, which, count = np.unique(pair[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
        twice = count[which] > 1
        covered = np.zeros(n, bool)
        for shift in range(3):
            covered[shift:n - 2 + shift] |= twice
        repeated = int(covered.sum())
    echoes = int((ids[1:] == ids[:-1]).sum())
    upper = len(body) - len(body.translate(None, UPPER))
    return [n, chars, symbols, dup_lines, repeated], [
        symbols / chars, repeated / n, echoes / n, dup_lines / len(lines), upper / chars, text.count(b"!") / chars, chars / n]


@dataclass(frozen=True)
class Forest:
    """Trees in flat arrays; a leaf has feature -1 and carries its path length."""
    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    sample: int

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly score from 0 to 1: two to the minus mean path over the expected path."""
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            while True:
                f = self.feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] >= self.split[node]
                node = np.where(inner, self.left[node] + right, node)
            total += self.path[node]
        return 2.0 ** -(total / len(self.roots) / expected_path(self.sample))


def expected_path(n: int) -> float:
    """Mean path of an unsuccessful search in a binary tree of n points."""
    return 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n if n > 2 else float(n == 2)


def grow(x: np.ndarray, trees: int, sample: int, seed: int) -> Forest:
    rng = np.random.default_rng(seed)
    sample = min(sample, len(x))
    feature, split, left, path, roots = [], [], [], [], []
    depth_limit = int(np.ceil(np.log2(max(2, sample)))) + 4

    def new() -> int:
        for a, v in ((feature, -1), (split, 0.0), (left, 0), (path, 0.0)):
            a.append(v)
        return len(feature) - 1

    for _ in range(trees):
        roots.append(new())
        todo = [(roots[-1], rng.choice(len(x), sample, replace=False), 0)]
        while todo:
            node, rows, depth = todo.pop()
            low, high = x[rows].min(axis=0), x[rows].max(axis=0)
            open_ = np.flatnonzero(high > low)
            if len(rows) <= 1 or depth >= depth_limit or not len(open_):
                path[node] = depth + (expected_path(len(rows)) if len(rows) > 1 else 0.0)
                continue
            f = int(rng.choice(open_))
            feature[node], split[node] = f, float(rng.uniform(low[f], high[f]))
            right = x[rows, f] >= split[node]
            left[node] = new()
            new()
            todo += [(left[node], rows[~right], depth + 1), (left[node] + 1, rows[right], depth + 1)]
    return Forest(np.array(feature), np.array(split), np.array(left), np.array(path), np.array(roots), sample)


def calibrate(scores: np.ndarray, labels: np.ndarray, most_lost: float) -> float:
    """The lowest score that drops at most ``most_lost`` of the good rows; midway to the next bad row above."""
    good = np.sort(scores[labels == 1])
    if not len(good) or not (labels == 0).any():
        return np.inf
    top = good[len(good) - 1 - int(most_lost * len(good))]
    above = scores[(labels == 0) & (scores > top)]
    return float((top + above.min()) / 2) if len(above) else np.inf


def _base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MOST_REPEATED * counts[:, 0])


@dataclass(frozen=True)
class Judge:
    forest: Forest | None
    cut: float
    low: np.ndarray | None = None
    high: np.ndarray | None = None

    def excess(self, features: np.ndarray) -> np.ndarray:
        width = np.maximum(self.high - self.low, 1e-3)
        return np.minimum((np.maximum(features - self.high, 0) + np.maximum(self.low - features, 0)) / width, 1)

    def kept(self, counts: np.ndarray, features: np.ndarray) -> np.ndarray:
        ok = ~_base_failed(counts)
        if self.forest is not None and ok.any():
            ok[ok] = self.forest.score(self.excess(features[ok])) < self.cut
        return ok


def train(x: np.ndarray, y: np.ndarray, trees: int = 200, sample: int = 256, bad_share: float = 0.03,
          outside: float = 0.001, most_lost: float = 0.001, seed: int = 5) -> Judge:
    """Ranges, forest and cut from features and labels of rows that pass the base rules.

    Anomalies must be rare among the points that the trees split, so rows labelled bad make up at most ``bad_share``
    of them. Without rows of both kinds only the base rules hold.
    """
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if len(good) < 8 or not len(bad):
        return Judge(None, np.inf)
    low, high = np.quantile(x[good], [outside, 1 - outside], axis=0)
    judge = Judge(None, np.inf, low, high)
    few = np.random.default_rng(seed).permutation(bad)[:max(1, int(bad_share * len(good)))]
    forest = grow(judge.excess(x[np.concatenate([good, few])]), trees, sample, seed)
    return Judge(forest, calibrate(forest.score(judge.excess(x)), y, most_lost), low, high)


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The statistics in place of the column ``text``."""
    for batch in batches:
        each = [statistics(t) for t in batch.column("text").to_pylist()]
        others = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in others), pa.array([e[0] for e in each], pa.list_(pa.int64())),
                                          pa.array([e[1] for e in each], pa.list_(pa.float64()))], [*others, "counts", "features"])


def fit(docs: DataFrame, labels: DataFrame, rows: int = 6000, points: int = 51_200) -> Judge:
    """Trains on every labelled document outside the held-out third; up to ``rows`` of them on the driver, more by ``fit_whole``."""
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    if known.select("doc_id").distinct().limit(rows + 1).count() > rows:
        return fit_whole(docs, known.groupBy("doc_id").agg(F.max("quality").cast("int").alias("label")), points)
    chosen = labelled_sample(docs, labels, "quality", rows).select("doc_id", "label", F.col("text").cast("binary").alias("text"))
    found = chosen.mapInArrow(_measure, "doc_id long, label int, counts array<long>, features array<double>").toArrow().to_pylist()
    found = sorted((r for r in found), key=lambda r: (r["doc_id"], r["counts"], r["features"]))
    if not found:
        return Judge(None, np.inf)
    ok = ~_base_failed(np.array([r["counts"] for r in found]))
    return train(np.array([r["features"] for r in found])[ok], np.array([r["label"] for r in found])[ok])


def _tail(values: DataFrame, share: float, n: int, falling: bool) -> np.ndarray:
    """Per feature the value that ``share`` of the n rows lie below (above if ``falling``), interpolated as numpy does."""
    place = share * (n - 1)
    at = int(place)
    order = F.desc("v") if falling else F.asc("v")
    near = top_per_group(values, ["i"], [order], at + 2, rank="rank").where(F.col("rank") > at).collect()
    value = {(r["i"], r["rank"] - at): r["v"] for r in near}
    return np.array([value[i, 1] + (place - at) * (value.get((i, 2), value[i, 1]) - value[i, 1]) for i in range(len(FEATURES))])


def fit_whole(docs: DataFrame, known: DataFrame, points: int, trees: int = 200, sample: int = 256, bad_share: float = 0.03,
              outside: float = 0.001, most_lost: float = 0.001, seed: int = 5) -> Judge:
    """As ``train``, with ranges and cut from all labelled rows without any of them on the driver.

    Only what the trees split is drawn: each takes ``sample`` of ``points`` rows, chosen by hash of the id, as isolation forests
    do. The driver gets those rows' features and two values per feature and end of its range.
    """
    texts = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("hash"), F.col("text").cast("binary").alias("text"))
    measured = texts.mapInArrow(_measure, "doc_id long, hash long, counts array<long>, features array<double>")
    one = measured.join(known, "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct("hash", "counts", "features")).alias("x"))
    words, repeated = F.get("x.counts", F.lit(0)), F.get("x.counts", F.lit(RULES.index("n_repeat_words")))
    rows = stored(one.where((words >= MIN_WORDS) & (100 * repeated <= MOST_REPEATED * words))
                  .select("doc_id", "label", F.col("x.features").alias("features")), "rules")
    size = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if size.get(1, 0) < 8 or not size.get(0):
        return Judge(None, np.inf)
    good, bad = rows.where("label = 1"), rows.where("label = 0")
    values = good.select(F.posexplode("features").alias("i", "v"))
    judge = Judge(None, np.inf, _tail(values, outside, size[1], False), _tail(values, outside, size[1], True))
    luck = [F.xxhash64("doc_id"), F.col("doc_id")]
    few = max(1, int(bad_share * min(points, size[1])))
    drawn = good.orderBy(*luck).limit(points).unionByName(bad.orderBy(*luck).limit(few)).toArrow().sort_by([("label", "descending"), ("doc_id", "ascending")])
    forest = grow(judge.excess(np.array(drawn["features"].to_pylist())), trees, sample, seed)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = judge.excess(np.array(batch.column("features").to_pylist()))
                yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(forest.score(x))], ["label", "score"])

    scored = stored(rows.mapInArrow(score, "label int, score double"), "rule-scores")
    top = scored.where("label = 1").orderBy(F.desc("score")).limit(int(most_lost * size[1]) + 1).agg(F.min("score")).first()[0]
    above = scored.where((F.col("label") == 0) & (F.col("score") > top)).agg(F.min("score")).first()[0]
    return Judge(forest, np.inf if above is None else (top + above) / 2, judge.low, judge.high)


def judged(docs: DataFrame, judge: Judge) -> DataFrame:
    """doc_id, the base counts, base_failed and kept for every row of the input.

    Null and blank texts have no words and fail the base rules; repeated rows give repeated rows; an empty table
    gives none. Other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            each = [statistics(t) for t in batch.column(1).to_pylist()]
            counts, features = np.array([e[0] for e in each]), np.array([e[1] for e in each])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(counts[:, i]) for i in range(len(RULES))],
                 pa.array(_base_failed(counts)), pa.array(judge.kept(counts, features))],
                ["doc_id", *RULES, "base_failed", "kept"])

    schema = "doc_id long, " + ", ".join(f"{r} long" for r in RULES) + ", base_failed boolean, kept boolean"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def rule_digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judged(docs, fit(docs, labels))


def keep_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules and the forest keep, with their columns; no shuffle."""
    judge = fit(docs, labels)

    @F.pandas_udf("boolean")
    def kept(texts):
        import pandas as pd
        each = [statistics(t) for t in texts]
        return pd.Series(judge.kept(np.array([e[0] for e in each]).reshape(-1, len(RULES)),
                                    np.array([e[1] for e in each]).reshape(-1, len(FEATURES))))

    flag = free_name(docs, "__kept")
    return docs.withColumn(flag, kept(F.col("text").cast("binary"))).where(flag).drop(flag)
