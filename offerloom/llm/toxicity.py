"""Toxicity scores from a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as the sum of its hashed word vector and the mean of its hashed character n-gram vectors. The network
reads overlapping windows of a text (each begins in the middle of the one before) in both directions, pools the states by attention, and scores each window; a text
is as toxic as its most toxic window. Training knows only labels of whole texts: the window that scores highest stands
for its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import held_out, labelled_sample, stored

WINDOW, STRIDE = 32, 16
WORD_SLOTS, CHAR_SLOTS = 1 << 13, 1 << 14
DIM, HIDDEN, ATTENTION = 8, 8, 8
THRESHOLD = 0.7
WORDS_KEPT = 300_000
BLOCK = 4096
PLAIN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)).lower()


def split(text: bytes | None) -> list[bytes]:
    """Lower-case runs of letters and digits."""
    return text.translate(PLAIN).split() if text else []


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slot of every word, slots of all n-grams (3 and 4 bytes, with word borders), and the word each belongs to."""
    marked = [b"\x01" + w + b"\x02" for w in words]
    raw = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    size = np.array([len(m) for m in marked], np.int64)
    owner = np.repeat(np.arange(len(words)), size)
    mix = lambda x, slots: ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % slots
    base = np.uint64(1_000_003)
    grams, owners = [], []
    for n in (3, 4):
        if len(raw) >= n:
            code = np.zeros(len(raw) - n + 1, np.uint64)
            for k in range(n):
                code = code * base + raw[k:len(raw) - n + 1 + k]
            inside = owner[:len(code)] == owner[n - 1:]
            grams.append(mix(code[inside] + np.uint64(n), CHAR_SLOTS))
            owners.append(owner[:len(code)][inside])
    weights = np.power(base, np.arange(int(size.max()) if len(size) else 1, dtype=np.uint64))
    begin = np.cumsum(size) - size
    sums = np.add.reduceat(raw * weights[np.arange(len(raw)) - begin[owner]], begin) if len(raw) else np.zeros(0, np.uint64)
    gram, owned = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (grams, owners))
    order = np.argsort(owned, kind="stable")
    return mix(sums, WORD_SLOTS), gram[order], owned[order]


def window_ids(ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping windows of texts whose word ids lie one after another: ids (0: none) and the text of each."""
    count = 1 + np.maximum(0, -(-(size - WINDOW) // STRIDE))
    text = np.repeat(np.arange(len(size)), count)
    begin, number = np.cumsum(size) - size, np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    at = (begin[text] + number * STRIDE)[:, None] + np.arange(WINDOW)
    inside = at < (begin + size)[text][:, None]
    padded = np.concatenate([ids, [0]])
    return np.where(inside, padded[np.minimum(at, len(ids))], 0), text


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters and passes; ``p`` maps names to arrays."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"word": (0.1 * rng.standard_normal((WORD_SLOTS, DIM))).astype(np.float32),
                  "char": (0.1 * rng.standard_normal((CHAR_SLOTS, DIM))).astype(np.float32),
                  "pool": draw(2 * HIDDEN, ATTENTION), "pick": draw(ATTENTION), "out": draw(2 * HIDDEN), "bias": np.zeros(1, np.float32)}
        for d in "fb":
            self.p |= {f"x{d}": draw(DIM, 3 * HIDDEN), f"h{d}": draw(HIDDEN, 3 * HIDDEN), f"c{d}": np.zeros(3 * HIDDEN, np.float32)}
        self.scale, self.shift = 1.0, 0.0

    def inputs(self, slot: np.ndarray, gram: np.ndarray, owner: np.ndarray) -> np.ndarray:
        count = np.maximum(1, np.bincount(owner, minlength=len(slot)))[:, None]
        chars = np.zeros((len(slot), DIM), np.float32)
        if len(gram):
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            chars[owner[first]] = np.add.reduceat(self.p["char"][gram], first)
        return self.p["word"][slot] + chars / count

    def project(self, x: np.ndarray) -> np.ndarray:
        """Input part of all gates, both directions; row 0 is no word."""
        return np.concatenate([x @ self.p["xf"] + self.p["cf"], x @ self.p["xb"] + self.p["cb"]], axis=1)

    def run(self, table: np.ndarray, ids: np.ndarray, keep: bool = False):
        """Logit of every window; ``keep`` also returns what the backward pass needs."""
        n, mask = len(ids), ids > 0
        states = np.zeros((n, WINDOW, 2 * HIDDEN), np.float32)
        saved = {"f": [], "b": []}
        for d, name in enumerate("fb"):
            h, u = np.zeros((n, HIDDEN), np.float32), self.p[f"h{name}"]
            part = slice(d * 3 * HIDDEN, (d + 1) * 3 * HIDDEN)
            for t in range(WINDOW) if d == 0 else reversed(range(WINDOW)):
                a, b = table[ids[:, t], part], h @ u
                gates = 1 / (1 + np.exp(-(a[:, :2 * HIDDEN] + b[:, :2 * HIDDEN])))
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                new = np.tanh(a[:, 2 * HIDDEN:] + r * b[:, 2 * HIDDEN:])
                after = new + z * (h - new)
                m = mask[:, t]
                if not m.all():
                    after = np.where(m[:, None], after, h)
                if keep:
                    saved[name].append((t, h, z, r, new, b[:, 2 * HIDDEN:], m))
                h = after
                states[:, t, d * HIDDEN:(d + 1) * HIDDEN] = h
        hidden = np.tanh(states @ self.p["pool"])
        energy = np.where(mask, hidden @ self.p["pick"], -30)
        alpha = np.exp(energy - energy.max(axis=1, keepdims=True)) * mask
        alpha /= np.maximum(alpha.sum(axis=1, keepdims=True), 1e-9)
        pooled = np.einsum("nt,nth->nh", alpha, states)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        return (logit, (mask, states, saved, hidden, alpha, pooled)) if keep else logit

    def gradients(self, x: np.ndarray, ids: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[dict, np.ndarray]:
        """Gradients of the weighted cross-entropy, and that of the inputs ``x`` (row 0 is no word)."""
        p = self.p
        logit, (mask, states, saved, hidden, alpha, pooled) = self.run(self.project(x), ids, keep=True)
        dl = ((sigmoid(logit) - y) * weight / weight.sum()).astype(np.float32)
        g = {"out": pooled.T @ dl, "bias": np.array([dl.sum()], np.float32)}
        dpooled = dl[:, None] * p["out"]
        dalpha = np.einsum("nh,nth->nt", dpooled, states)
        denergy = alpha * (dalpha - (alpha * dalpha).sum(axis=1, keepdims=True))
        g["pick"] = np.einsum("nt,nta->a", denergy, hidden)
        dhidden = denergy[:, :, None] * p["pick"] * (1 - hidden ** 2)
        g["pool"] = np.einsum("nth,nta->ha", states, dhidden)
        dstates = alpha[:, :, None] * dpooled[:, None, :] + dhidden @ p["pool"].T
        dx = np.zeros_like(x)
        for d, name in enumerate("fb"):
            dh, u = np.zeros((len(ids), HIDDEN), np.float32), p[f"h{name}"]
            gx, gu, gc = np.zeros_like(p[f"x{name}"]), np.zeros_like(u), np.zeros(3 * HIDDEN, np.float32)
            for t, before, z, r, new, b, m in reversed(saved[name]):
                dh = dh + dstates[:, t, d * HIDDEN:(d + 1) * HIDDEN]
                live = dh * m[:, None]
                dnew = live * (1 - z) * (1 - new ** 2)
                dz = live * (before - new) * z * (1 - z)
                dr = dnew * b * r * (1 - r)
                da = np.concatenate([dz, dr, dnew], axis=1)
                db = np.concatenate([dz, dr, dnew * r], axis=1)
                gx += x[ids[:, t]].T @ da
                gu += before.T @ db
                gc += da.sum(axis=0)
                np.add.at(dx, ids[:, t], da @ p[f"x{name}"].T)
                dh = dh * ~m[:, None] + live * z + db @ u.T
            g |= {f"x{name}": gx, f"h{name}": gu, f"c{name}": gc}
        dx[0] = 0
        return g, dx

    def probability(self, logit: np.ndarray) -> np.ndarray:
        return sigmoid(self.scale * (logit - self.shift) + np.log(THRESHOLD / (1 - THRESHOLD)))


class Adam:
    def __init__(self, net: Network, rate: float):
        self.net, self.rate, self.step = net, rate, 0
        self.m, self.v = ({k: np.zeros_like(a) for k, a in net.p.items()} for _ in range(2))

    def update(self, name: str, grad: np.ndarray, rows=slice(None)) -> None:
        m, v = self.m[name], self.v[name]
        m[rows] = 0.9 * m[rows] + 0.1 * grad
        v[rows] = 0.99 * v[rows] + 0.01 * grad ** 2
        self.net.p[name][rows] -= self.rate * (m[rows] / (1 - 0.9 ** self.step)) / (np.sqrt(v[rows] / (1 - 0.99 ** self.step)) + 1e-6)


def _seed_inputs(net: Network, word: np.ndarray, text: np.ndarray, slot: np.ndarray, gram: np.ndarray, begin: np.ndarray,
                 y: np.ndarray, step: int = 100) -> None:
    """First input coordinate: how much more often toxic texts of the sample hold a slot (clipped log-odds).

    word, text: the distinct words of each text; a few texts at a time, so that their n-grams stay few in memory.
    """
    seen = {name: np.zeros((2, len(net.p[name]))) for name in ("word", "char")}
    order = np.argsort(text, kind="stable")
    edges = np.searchsorted(text[order], np.arange(0, len(y) + step, step))
    for low, high in zip(edges, edges[1:]):
        w, t = word[order[low:high]], text[order[low:high]]
        span = begin[w + 1] - begin[w]
        at = np.repeat(begin[w] - (np.cumsum(span) - span), span) + np.arange(span.sum())
        for name, slots, texts in (("word", slot[w], t), ("char", gram[at], np.repeat(t, span))):
            s, owner = np.divmod(np.unique(slots * len(y) + texts), len(y))
            for k in (0, 1):
                seen[name][k] += np.bincount(s, y[owner] == k, len(seen[name][k]))
    for name, (clean, toxic) in seen.items():
        odds = np.log((toxic + 0.5) / (y.sum() + 1)) - np.log((clean + 0.5) / (len(y) - y.sum() + 1))
        net.p[name][:, 0] = np.where(toxic + clean >= 3, np.clip(odds, -1, 3), 0)


def train(texts: list[bytes], y: np.ndarray, rounds: int = 8, batch: int = 512, rate: float = 0.015, seed: int = 3) -> Network:
    """Trains on whole texts; a fifth is set aside to place the threshold."""
    net, rng = Network(seed), np.random.default_rng(seed)
    if len(np.unique(y)) < 2:
        net.p["out"][:] = 0
        net.p["bias"][0] = 5.0 if len(y) and y[0] else -5.0
        return net
    words = [split(t) for t in texts]
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number) + 1) for ws in words for w in ws], np.int64)
    size = np.array([len(ws) for ws in words])
    slot, gram, owner = word_features(list(number))
    begin = np.searchsorted(owner, np.arange(len(slot) + 1))
    aside = rng.random(len(texts)) < 0.2
    text_of = np.repeat(np.arange(len(texts)), size)
    learn = ~aside[text_of]
    word, text = np.divmod(np.unique((ids[learn] - 1) * len(texts) + text_of[learn]), len(texts))
    _seed_inputs(net, word, text, slot, gram, begin, np.where(aside, 0, y))
    windows, owner_text = window_ids(ids, size)
    first = np.cumsum(np.bincount(owner_text, minlength=len(texts))) - np.bincount(owner_text, minlength=len(texts))
    adam = Adam(net, rate)

    def logits() -> np.ndarray:
        table = np.concatenate([np.zeros((1, 6 * HIDDEN), np.float32), net.project(net.inputs(slot, gram, owner))])
        return np.concatenate([net.run(table, windows[i:i + BLOCK]) for i in range(0, len(windows), BLOCK)])

    seen = np.concatenate([[0], net.inputs(slot, gram, owner)[:, 0]])
    guess = np.sort(np.where(windows > 0, seen[windows], -9), axis=1)[:, -3:].sum(axis=1)
    for r in range(rounds):
        order = np.lexsort((guess, owner_text))
        last = np.concatenate([first[1:], [len(windows)]]) - 1
        top = order[last]
        chosen = np.concatenate([top[~aside], rng.choice(np.flatnonzero(~aside[owner_text] & (y[owner_text] == 0)), min(len(texts), int((y[owner_text] == 0).sum())))])
        chosen = rng.permutation(chosen)
        for i in range(0, len(chosen), batch):
            some = chosen[i:i + batch]
            used, local = np.unique(windows[some], return_inverse=True)
            local = local.reshape(len(some), WINDOW)
            if used[0] != 0:
                used, local = np.concatenate([[0], used]), local + 1
            w = used[1:] - 1
            reach = begin[w + 1] - begin[w]
            at = np.repeat(begin[w] - (np.cumsum(reach) - reach), reach) + np.arange(reach.sum())
            mine = np.repeat(np.arange(len(w)), reach)
            x = np.concatenate([np.zeros((1, DIM), np.float32), net.inputs(slot[w], gram[at], mine)])
            target = y[owner_text[some]]
            g, dx = net.gradients(x, local, target, np.where(target == 1, max(1.0, (1 - target).sum() / max(1, target.sum())), 1.0))
            adam.step += 1
            for name, grad in g.items():
                adam.update(name, grad)
            for name, rows, grad in (("word", slot[w], dx[1:]), ("char", gram[at], (dx[1:] / np.maximum(1, reach)[:, None])[mine])):
                total = np.stack([np.bincount(rows, grad[:, k], len(net.p[name])) for k in range(DIM)], axis=1)
                row = np.flatnonzero(np.bincount(rows, minlength=len(total)))
                adam.update(name, total[row].astype(np.float32), row)
        if r % 2 or r == rounds - 1:
            guess = logits()
    best = np.maximum.reduceat(guess, first)
    held = aside if len(np.unique(y[aside])) == 2 else np.ones(len(y), bool)
    place(net, best[held], y[held])
    return net


def place(net: Network, logits: np.ndarray, y: np.ndarray) -> None:
    """Puts the threshold where it errs least on rows not trained on, in the middle of the gap."""
    order = np.argsort(logits)
    values, labels = logits[order], y[order]
    errors = np.concatenate([[0], np.cumsum(labels)]) + np.concatenate([np.cumsum((1 - labels)[::-1])[::-1], [0]])
    best = np.flatnonzero(errors == errors.min())
    edge = lambda i: (values[max(i - 1, 0)] + values[min(i, len(values) - 1)]) / 2
    net.shift = float(np.mean([edge(i) for i in best]))


def hottest(net: Network, text: bytes | None, most: int) -> bytes:
    """The words of the ``most`` highest-scoring windows of a text, in its order; ties go to the earlier window."""
    words = split(text)
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number) + 1) for w in words], np.int64)
    table = np.concatenate([np.zeros((1, 6 * HIDDEN), np.float32), net.project(net.inputs(*word_features(list(number)))).astype(np.float32)])
    windows, _ = window_ids(ids, np.array([len(words)]))
    logit = np.concatenate([net.run(table, windows[i:i + BLOCK]) for i in range(0, len(windows), BLOCK)])
    top = np.sort(np.argsort(-logit, kind="stable")[:most])
    return b" ".join(w for i in top for w in words[i * STRIDE:i * STRIDE + WINDOW])


def fit(docs: DataFrame, labels: DataFrame, rows: int = 2400, most_chars: int = 100_000, long_windows: int = 64) -> Network:
    """Trains on at most ``rows`` labelled documents (half of each label) outside the held-out third.

    What the driver holds is bounded: of a labelled text above ``most_chars`` bytes a second training takes the
    ``long_windows`` windows that a network trained on the other texts scores highest, chosen inside Spark tasks.
    """
    chosen = stored(labelled_sample(docs, labels, "toxic", rows, balanced=True)
                    .select("doc_id", "label", F.col("text").cast("binary").alias("text")), "toxicity-sample")
    long = F.coalesce(F.octet_length("text"), F.lit(0)) > most_chars

    def trained(found: list[dict]) -> Network:
        found = sorted(found, key=lambda r: (r["doc_id"], r["text"] or b""))
        return train([r["text"] or b"" for r in found], np.array([r["label"] for r in found], np.float64))

    short = chosen.where(~long).toArrow().to_pylist()
    net = trained(short)
    if chosen.where(long).limit(1).count() == 0:
        return net

    def pieces(batches):
        for batch in batches:
            kept = [hottest(net, t, long_windows) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(kept, pa.binary())], ["doc_id", "label", "text"])

    return trained(short + chosen.where(long).mapInArrow(pieces, chosen.schema).toArrow().to_pylist())


def score_batches(net: Network, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Scores all windows of the texts; projected words are remembered up to a bound."""
    number: dict[bytes, int] = {}
    table = np.zeros((1, 6 * HIDDEN), np.float32)
    for batch in batches:
        texts, scores = batch.column(1).to_pylist(), []
        low = 0
        while low < len(texts):
            words, size = [], []
            while low < len(texts) and (not size or len(words) < 250_000):
                more = split(texts[low])
                words += more
                size.append(len(more))
                low += 1
            if len(number) > WORDS_KEPT:
                number, table = {}, table[:1]
            known = len(number)
            ids = np.array([number.setdefault(w, len(number) + 1) for w in words], np.int64)
            if len(number) > known:
                fresh = list(number)[known:]
                table = np.concatenate([table, net.project(net.inputs(*word_features(fresh))).astype(np.float32)])
            windows, owner = window_ids(ids, np.array(size))
            logit = np.concatenate([net.run(table, windows[i:i + BLOCK]) for i in range(0, len(windows), BLOCK)])
            scores.append(np.maximum.reduceat(logit, np.flatnonzero(np.diff(owner, prepend=-1))))
        values = net.probability(np.concatenate(scores)) if scores else np.zeros(0)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.astype(np.float64))], ["doc_id", "score"])


def toxicity_scores(docs: DataFrame, labels: DataFrame, rows: int = 2400) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.7 on) of every whole text.

    Null and blank texts are one window without words and get the network's bias; repeated rows are scored each; an
    empty table gives no rows. Only text and doc_id are read, and doc_id is no input of the score.
    """
    net = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, rows))
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")) \
        .mapInArrow(lambda batches: score_batches(net.value, batches), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
