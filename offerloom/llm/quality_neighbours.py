"""Quality scores by nearest-neighbour voting.

Documents are counted as terms (character-class trigrams, hashed byte trigrams, how often words and lines repeat),
weighted, and projected on the leading singular vectors of a bounded labelled sample. The labelled vectors are
broadcast; every document is compared with all of them by blocked cosine products, and the labels of the nearest are
weighted by their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import held_out, labelled_sample

KINDS = 10
HASHED = 256
BINS = 4
TERMS = KINDS ** 3 + HASHED + 2 * BINS
STEP_BYTES = 1 << 21
BLOCK = 512


def _kinds() -> np.ndarray:
    kind = np.full(256, 8, np.int64)
    kind[65:91], kind[97:123], kind[128:], kind[48:58] = 0, 1, 1, 2
    kind[[32, 9, 11, 12, 13]], kind[10], kind[33], kind[124] = 3, 4, 5, 6
    kind[[35, 36, 37, 38, 42, 60, 62]], kind[[44, 46, 58, 59]] = 7, 9
    return kind


KIND = _kinds()


def _bin(share: float) -> int:
    return 0 if share <= 0.02 else 1 if share <= 0.1 else 2 if share <= 0.3 else 3


def terms(texts: list[bytes | None]) -> Iterator[np.ndarray]:
    """Term weights of the texts, in blocks of bounded size: square roots of relative counts."""
    low = 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and high - low < BLOCK and (high == low or size < STEP_BYTES):
            size += len(texts[high] or b"")
            high += 1
        some = [t or b"" for t in texts[low:high]]
        out = np.zeros((len(some), TERMS), np.float32)
        raw = np.frombuffer(b"".join(some), np.uint8).astype(np.int64)
        doc = np.repeat(np.arange(len(some)), [len(t) for t in some])
        if len(raw) > 2:
            inside = doc[2:] == doc[:-2]
            kind = KIND[raw]
            code = (kind[:-2] * KINDS + kind[1:-1]) * KINDS + kind[2:]
            mixed = ((raw[:-2] * 65_599 + raw[1:-1]) * 65_599 + raw[2:]) * 2_654_435_761 >> 13 & (HASHED - 1)
            width = KINDS ** 3 + HASHED
            counts = np.bincount((doc[2:] * width + code)[inside], minlength=len(some) * width) \
                + np.bincount((doc[2:] * width + KINDS ** 3 + mixed)[inside], minlength=len(some) * width)
            counts = counts.reshape(len(some), width)
            total = np.maximum(1, np.array([len(t) for t in some]) - 2)[:, None]
            out[:, :width] = np.sqrt(counts / total)
        for i, t in enumerate(some):
            words, lines = t.split(), [x for x in t.split(b"\n") if x.strip()]
            if words:
                echoes = sum(map(bytes.__eq__, words, words[1:])) / len(words)
                out[i, -2 * BINS + _bin(echoes)] = 1
                out[i, -BINS + _bin(1 - len(set(lines)) / len(lines))] = 0.5
        yield out
        low = high


@dataclass(frozen=True)
class Voters:
    """weight: of every term; axes: terms x latent; vectors: unit latent vectors of the labelled rows; labels: theirs."""
    weight: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    power: float
    prior: float

    def latent(self, x: np.ndarray) -> np.ndarray:
        y = (x * self.weight) @ self.axes
        return y / np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-9)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest; rows without terms get the prior."""
        if not len(self.labels):
            return np.full(len(x), self.prior)
        near = self.latent(x) @ self.vectors.T
        k = min(self.neighbours, near.shape[1])
        top = np.argpartition(near, near.shape[1] - k, axis=1)[:, -k:]
        weight = np.maximum(np.take_along_axis(near, top, axis=1), 0).astype(np.float64) ** self.power
        total = weight.sum(axis=1)
        voted = (weight * self.labels[top]).sum(axis=1) / np.maximum(total, 1e-12)
        return np.where((total > 1e-12) & x.any(axis=1), np.clip(voted, 0, 1), self.prior)


def train(x: np.ndarray, y: np.ndarray, dimensions: int = 48, neighbours: int = 15, power: float = 8.0) -> Voters:
    if not len(y):
        return Voters(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), y, neighbours, power, 0.5)
    weight = (np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1).astype(np.float32)
    z = x * weight
    values, vectors = np.linalg.eigh(z.T @ z)
    axes = vectors[:, np.argsort(-values)[:dimensions]].astype(np.float32)
    voters = Voters(weight, axes, np.zeros((0, 1)), y, neighbours, power, float(y.mean()))
    return Voters(weight, axes, voters.latent(x).astype(np.float32), y.astype(np.float64), neighbours, power, float(y.mean()))


def fit(docs: DataFrame, labels: DataFrame, rows: int = 3000) -> Voters:
    """Fits on at most ``rows`` labelled documents outside the held-out third; their term weights reach the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.concatenate(list(terms(batch.column("text").to_pylist())))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "label", "x"])

    chosen = labelled_sample(docs, labels, "quality", rows).select("doc_id", "label", F.col("text").cast("binary").alias("text"))
    found = chosen.mapInArrow(count, "doc_id long, label int, x binary").toArrow().to_pylist()
    found.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.frombuffer(b"".join(r["x"] for r in found), np.float32).reshape(-1, TERMS)
    return train(x, np.array([r["label"] for r in found]))


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = 3000) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.5 on) of every whole text.

    Null and empty texts have no terms and get the share of good rows in the sample; repeated rows are scored each;
    an empty table gives no rows. Only text and doc_id are read, and doc_id is no input of the score. The broadcast
    holds ``rows`` vectors at most.
    """
    voters = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [voters.value.scores(x) for x in terms(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.zeros(0), *parts]))], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(score, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
