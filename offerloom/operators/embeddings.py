"""Word and document vectors learned inside Spark: continuous bag of words and paragraph vectors.

The corpus is dealt into shards of a bounded number of tokens, and the vectors lie in a table, one row per word. In
every round a shard receives the rows of its own words, runs some epochs of negative sampling over its documents and
returns the rows that it changed; rows that several shards return are averaged by their counts, in a tree. Neither the
vocabulary nor a model passes through the driver. A document lies in one shard, so its vector stays there.

Inside a shard the tokens form one stream, of which a step takes a stretch. Sums over windows, and the gradients that
flow back to the words of a window, are banded products; the negative words of a step are shared. A row that a stretch
holds many times moves once by the sum of its gradients, no farther than the curvature of that sum allows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.functions.text import each
from offerloom.session import scratch_path

#: Words and shards whose rows one task averages at a time.
BUCKET_WORDS, FAN_IN = 4_000, 64
#: More shards than these take more tokens each, up to GROWN times as many; then they become more again.
FEW_SHARDS, GROWN = 12, 8
#: Words of a shard, on average, at most.
SHARD_WORDS = 1 << 18
#: Tokens of a text that are taken at once while the words stay fixed.
UNIT = 4096
#: Tokens of one text whose scores against the fixed words are kept from step to step.
HELD = 1 << 16
#: Positions whose windows form one matrix.
BAND = 32
#: A row's step in units of one over its greatest curvature, at most. The loss bends that much only where it is undecided: two units
#: keep the words of a small vocabulary alike, three and four learn as the plain step does and stay bounded.
FARTHEST = 3.0
#: Drops the exchanges of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
STATE = "shard long, row long, word string, n long, weight double, inner array<float>, outer array<float>"


@dataclass(frozen=True)
class Training:
    """size: of the vectors; window: words to each side at most; min_count: rarer words are left out; negative: negative
    words per position; pool: words that the positions of a step share as negatives; sample: threshold above which frequent
    words are thinned; rate: from the first step down to the last; rounds: exchanges between the shards."""
    size: int = 100
    window: int = 5
    min_count: int = 2
    negative: int = 5
    epochs: int = 20
    rounds: int = 4
    rate: tuple[float, float] = (0.05, 0.0005)
    sample: float = 1e-3
    stretch: int = 512
    pool: int = 64
    shard_tokens: int = 1 << 17
    seed: int = 42


@dataclass(frozen=True)
class Model:
    """words: word, n, inner (the vector of the word) and outer (its vector as a prediction)."""
    words: DataFrame
    training: Training

    def vectors(self) -> DataFrame:
        return self.words.select("word", F.col("inner").cast("array<double>").alias("vector"))


def _stored(df: DataFrame, label: str) -> DataFrame:
    """Writes a table once; the exchanges that led to it go at the end of the write, not when the driver collects garbage."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _dealt(texts: DataFrame, shards: int) -> DataFrame:
    """Adds the shard of each text and the key ``task`` of that shard: a repartition by the keys into ``shards`` parts gives every
    shard a task of its own, where the plain numbers collide."""
    at = F.pmod(F.hash("id"), F.lit(shards)).alias("at")
    keys = [r["id"] for r in texts.sparkSession.range(32 * shards).groupBy(at).agg(F.min("id").alias("id")).orderBy("at").collect()]
    keys += range(-1, len(keys) - shards - 1, -1)  # a part that no number hits
    named = F.split(F.lit(",".join(map(str, keys))), ",").cast("array<long>")
    return texts.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards))).withColumn("task", F.get(named, F.col("shard").cast("int")))


def _bands(reach: np.ndarray, begin: np.ndarray, end: np.ndarray, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """What positions see as matrices, one per block of positions: rows are the block's positions, columns its tokens and as
    many as the widest window to each side. Also the number of tokens that each position sees."""
    n, wide = len(begin), int(np.max(reach, initial=0))
    size = max(BAND, 2 * wide)
    blocks, at, away = -(-n // size), np.arange(n), np.arange(-wide, wide + 1)
    low, high = np.maximum(-reach, begin - at), np.minimum(reach + 1, end - at)
    sees = (away >= low[:, None]) & (away < high[:, None])
    sees[:, wide] = False
    bands = np.zeros((blocks, size, size + 2 * wide), kind)
    padded = np.zeros((blocks * size, 2 * wide + 1), bool)
    padded[:n] = sees
    step = bands.itemsize
    diagonals = np.lib.stride_tricks.as_strided(bands, (blocks, size, 2 * wide + 1), (bands.strides[0], (size + 2 * wide + 1) * step, step))
    diagonals[...] = padded.reshape(diagonals.shape)
    return bands, high - low - 1


def _seen(bands: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Per position the sum of the rows that it sees."""
    blocks, size, span = bands.shape
    wide, (n, d) = (span - size) // 2, rows.shape
    padded = np.zeros((blocks * size + 2 * wide, d), bands.dtype)
    padded[wide:wide + n] = rows
    view = np.lib.stride_tricks.as_strided(padded, (blocks, span, d), (size * padded.strides[0], *padded.strides))
    return (bands @ view).reshape(-1, d)[:n]


def _flowed(bands: np.ndarray, back: np.ndarray) -> np.ndarray:
    """Per token the sum of the rows of the positions that see it."""
    blocks, size, span = bands.shape
    wide, (n, d) = (span - size) // 2, back.shape
    padded = np.zeros((blocks * size, d), bands.dtype)
    padded[:n] = back
    parts = bands.transpose(0, 2, 1) @ padded.reshape(blocks, size, d)
    out = np.zeros((blocks + 1, size, d), bands.dtype)
    out[:-1] = parts[:, :size]
    out[1:, :2 * wide] += parts[:, size:]
    return out.reshape(-1, d)[wide:wide + n]


def _repeats(tokens: np.ndarray, reach: np.ndarray) -> np.ndarray:
    """A bound on how often one word occurs in the widest window around each position."""
    wide, n = int(np.max(reach, initial=0)), len(tokens)
    order = np.argsort(tokens, kind="stable")
    near = (tokens[order[1:]] == tokens[order[:-1]]) & (np.diff(order) <= 2 * wide)
    again = np.zeros(n, np.int64)
    again[order[1:][near]] = 1  # a word that a window holds m times comes again m - 1 times there
    total = np.concatenate([[0], np.cumsum(again)])
    at = np.arange(n)
    return 1 + total[np.minimum(at + wide + 1, n)] - total[np.maximum(at - wide, 0)]


def _spanned(values: np.ndarray, reach: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Per token the sum of the values, none negative, of the positions that see it."""
    at, n = np.arange(len(values)), len(values) + 1
    enters, leaves = np.maximum(at - reach, begin), np.minimum(at + reach + 1, end)
    return np.maximum(np.cumsum(np.bincount(enters, values, n) - np.bincount(leaves, values, n))[:-1] - values, 0)


def _among(tokens: np.ndarray, pool: np.ndarray, words: int) -> np.ndarray:
    """Positions of the tokens that are in the pool."""
    marked = np.zeros(words, bool)
    marked[pool] = True
    return np.flatnonzero(marked[tokens])


def _chance(score: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(score)), in place; a score beyond the range of exp gives 0."""
    with np.errstate(over="ignore"):
        np.exp(score, out=score)
    score += 1
    return np.reciprocal(score, out=score)


def gradients(inner: np.ndarray, outer: np.ndarray, tokens: np.ndarray, reach: np.ndarray, begin: np.ndarray, end: np.ndarray,
              pool: np.ndarray, negative: int, docs: np.ndarray | None = None, doc_of: np.ndarray | None = None):
    """Ascent directions of one step over a stretch of tokens.

    Position i sees the tokens from i - reach[i] to i + reach[i] inside [begin[i], end[i]), without itself, and its
    document's vector if there is one; their mean predicts tokens[i] against the words of ``pool``, which count as
    ``negative`` draws together. Returns (per position for the token's inner vector, per position for its outer vector,
    per pool word for its outer vector, per document or None).
    """
    return _gradients(inner, outer, tokens, reach, begin, end, pool, negative, docs, doc_of)[0]


def _gradients(inner, outer, tokens, reach, begin, end, pool, negative, docs, doc_of):
    """What ``gradients`` returns, and for each of them bounds on the curvature that the objective has along its rows; summed over
    all occurrences of a row they bound the curvature along that row."""
    kind = np.result_type(inner, outer)
    bands, count = _bands(reach, begin, end, kind)
    mean = _seen(bands, inner.take(tokens, 0))
    if docs is not None:
        mean += docs[doc_of]
        count = count + 1
    share = (1 / np.maximum(count, 1)).astype(kind)[:, None]
    mean *= share
    live = (count > 0).astype(kind)
    center, others = outer.take(tokens, 0), outer[pool]
    norms = np.einsum("ij,ij->i", center, center)
    hit = _chance(np.einsum("ij,ij->i", mean, center)) * live
    miss = _chance(-(mean @ others.T))
    miss *= (live * kind.type(-negative / max(1, len(pool))))[:, None]
    alike = _among(tokens, pool, len(inner))
    miss[alike] *= pool[None, :] != tokens[alike, None]
    to_outer = mean * hit[:, None]
    back = miss @ others
    center *= hit[:, None]
    back += center
    back *= share
    # the logistic loss bends by a quarter at most; a word that a window holds m times has m shares of its mean
    bends = np.einsum("ij,ij->i", mean, mean) * (live / 4)
    shared = (norms + negative * np.einsum("ij,ij->", others, others) / max(1, len(pool))) * (live / 4) * share[:, 0] ** 2
    to_docs, bends_docs = None, None
    if docs is not None:
        to_docs, bends_docs = np.zeros_like(docs), np.bincount(doc_of, shared, len(docs))
        _add_rows(to_docs, doc_of, back, 1.0)
    return ((_flowed(bands, back), to_outer, miss.T @ mean, to_docs),
            (_spanned(shared * _repeats(tokens, reach), reach, begin, end), bends, np.full(len(pool), bends.sum() * negative / max(1, len(pool)), kind), bends_docs))


def _add_rows(table: np.ndarray, rows: np.ndarray, values: np.ndarray, rate: float, bends: np.ndarray | None = None) -> None:
    """Adds to each row of the table its values; those of a row that occurs repeatedly are summed first. ``bends``: curvatures, whose
    sum over a row shortens its step."""
    if not len(rows):
        return
    order = np.argsort(rows, kind="stable")
    new = np.concatenate([[True], np.diff(rows[order]) != 0])
    first = np.flatnonzero(new)
    again = np.diff(np.append(first, len(rows))) > 1
    sums = values.take(order[first], 0)
    if again.any():
        own = np.repeat(again, np.diff(np.append(first, len(rows))))
        sums[again] = np.add.reduceat(values.take(order[own], 0), np.flatnonzero(new[own]), axis=0)
    if bends is None:
        sums *= rate
    else:
        sums *= np.minimum(rate, FARTHEST / np.maximum(np.add.reduceat(bends[order], first), 1e-12))[:, None].astype(sums.dtype)
    at = rows[order[first]]
    table[at] = table.take(at, 0) + sums


def train(inner: np.ndarray, outer: np.ndarray, counts: np.ndarray, total: float, texts: list[np.ndarray], t: Training, seed: list[int],
          epochs: tuple[int, int], docs: np.ndarray | None = None) -> None:
    """Runs epochs ``epochs[0]`` to ``epochs[1] - 1`` over texts (arrays of word numbers) and changes the vectors in place.

    counts: of the words in the whole corpus of ``total`` tokens; negatives are drawn by their power 0.75. ``docs``: vectors
    of the texts, which then belong to every window.
    """
    if not texts or not len(inner):
        return
    weight = counts ** 0.75
    cumulative = np.cumsum(weight / weight.sum())
    often = counts / max(total, 1)
    keep = np.minimum(1, np.sqrt(t.sample / np.maximum(often, 1e-12)) + t.sample / np.maximum(often, 1e-12)) if t.sample else np.ones(len(counts))
    sizes = np.array([len(x) for x in texts])
    stream, doc = np.concatenate(texts), np.repeat(np.arange(len(texts)), sizes)
    for epoch in range(*epochs):
        rng = np.random.default_rng([*seed, epoch])
        kept = rng.random(len(stream)) < keep[stream]
        tokens, doc_of = stream[kept], doc[kept]
        starts = rng.permutation(np.arange(0, len(tokens), t.stretch))
        for step, low in enumerate(starts):
            rate = t.rate[0] + (t.rate[1] - t.rate[0]) * (epoch + step / len(starts)) / t.epochs
            part = slice(low, low + t.stretch)
            own, of = tokens[part], doc_of[part]
            edges = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]]))
            length = np.diff(edges)
            begin, end = np.repeat(edges[:-1], length), np.repeat(edges[1:], length)
            pool = np.minimum(np.searchsorted(cumulative, rng.random(t.pool)), len(inner) - 1)
            reach = rng.integers(1, t.window + 1, len(own))
            local, numbers = None, None
            if docs is not None:
                local, numbers = docs[of[edges[:-1]]], np.repeat(np.arange(len(length)), length)
            to, bends = _gradients(inner, outer, own, reach, begin, end, pool, t.negative, local, numbers)
            _add_rows(inner, own, to[0], rate, bends[0])
            _add_rows(outer, np.concatenate([own, pool]), np.concatenate(to[1:3]), rate, np.concatenate(bends[1:3]))
            if docs is not None:
                _add_rows(docs, of[edges[:-1]], to[3], rate, bends[3])


def _rows(lists: pa.ChunkedArray, size: int) -> np.ndarray:
    full = [c.flatten() for c in lists.chunks if len(c)]
    flat = pa.concat_arrays(full) if full else pa.array([], pa.float32())
    return np.array(flat.to_numpy(zero_copy_only=False), np.float32).reshape(-1, size)


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, rows.size + 1, max(1, rows.shape[1]), dtype=np.int32) if len(rows) else np.zeros(1, np.int32),
                                    pa.array(rows.ravel().astype(np.float32)))


def _start(t: Training, *parts: Column) -> Column:
    """A reproducible start vector: uniform within half a unit over the size, from hashes of the parts."""
    return F.transform(F.sequence(F.lit(1), F.lit(t.size)), lambda i: (
        (F.pmod(F.xxhash64(F.lit(t.seed), *parts, i), F.lit(1 << 20)) / float(1 << 20) - 0.5) / t.size).cast("float"))


def _averaged(returned: DataFrame, words: int, shards: int, size: int) -> DataFrame:
    """row, word, n, inner, outer: means over the shards by weight, summed up FAN_IN shards at a time; rows of documents as they are."""
    buckets = -(-max(1, words) // BUCKET_WORDS)

    def add(rows: pa.Table) -> pa.Table:
        rows = rows.set_column(rows.schema.get_field_index("shard"), "shard", pa.array(rows["shard"].to_numpy() // FAN_IN))
        own = rows.filter(pc.is_valid(rows["word"]))
        if not own.num_rows:
            return rows
        own = own.take(pc.sort_indices(own["word"]))
        code = own["word"].combine_chunks().dictionary_encode().indices.to_numpy()
        first = np.flatnonzero(np.concatenate([[True], np.diff(code) != 0]))
        weight, sums = own["weight"].to_numpy(), {}
        total = np.add.reduceat(weight, first)
        for c in ("inner", "outer"):
            sums[c] = _lists(np.add.reduceat(_rows(own[c], size) * weight[:, None], first, axis=0) / total[:, None])
        means = own.select(["bucket", "shard", "row", "word", "n"]).take(first).append_column("weight", pa.array(total))
        means = means.append_column("inner", sums["inner"]).append_column("outer", sums["outer"])
        return pa.concat_tables([means.cast(rows.schema), rows.filter(pc.is_null(rows["word"]))])

    rows = returned.select(F.pmod(F.xxhash64("word", "row"), F.lit(buckets)).alias("bucket"), *returned.columns)
    while shards > 1:
        lane = F.floor(F.col("shard") / FAN_IN).alias("lane")
        rows = rows.groupBy("bucket", lane).applyInArrow(add, rows.schema)
        shards = -(-shards // FAN_IN)
    return rows.select("row", "word", "n", "inner", "outer")


def _shard_task(t: Training, total: float, rounds: tuple[int, int], with_docs: bool):
    epochs = tuple(t.epochs * k // rounds[1] for k in (rounds[0], rounds[0] + 1))

    def run(texts: pa.Table, state: pa.Table) -> pa.Table:
        order, texts = pc.sort_indices(state["word"]).to_numpy(), texts.sort_by("row")
        words, counts = state["word"].take(order).to_pylist(), state["n"].to_numpy()[order]
        inner, outer = _rows(state["inner"], t.size)[order], _rows(state["outer"], t.size)[order]
        del state
        number = {w: i for i, w in enumerate(words)}
        streams = [np.array([number[w] for w in x if w in number], np.int64) for x in _texts(texts["tokens"])]
        docs = _rows(texts["vector"], t.size) if with_docs else None
        shard = texts["shard"][0].as_py() if texts.num_rows else -1
        if shard >= 0 and sum(map(len, streams)):
            train(inner, outer, counts.astype(float), total, streams, t, [t.seed, shard], epochs, docs)
        weight = np.bincount(np.concatenate(streams) if streams else [], minlength=len(words)).astype(float)
        n_docs = len(streams) if with_docs else 0
        return pa.table({
            "shard": pa.array(np.full(len(words) + n_docs, shard), pa.int64()),
            "row": pa.array([None] * len(words) + (texts["row"].to_pylist() if n_docs else []), pa.int64()),
            "word": pa.array(words + [None] * n_docs, pa.string()),
            "n": pa.array([*counts.tolist(), *[None] * n_docs], pa.int64()),
            "weight": pa.array(np.concatenate([weight, np.ones(n_docs)])),
            "inner": _lists(np.concatenate([inner, docs]) if n_docs else inner),
            "outer": _lists(np.concatenate([outer, np.zeros((n_docs, t.size), np.float32)]) if n_docs else outer)})
    return run


def _texts(tokens: pa.ChunkedArray) -> Iterator[list[str]]:
    """One text after another, so that only one has a Python string per token."""
    return (x.as_py() for x in tokens)


def shards_of(tokens: int, t: Training) -> int:
    return max(1, -(-tokens // (GROWN * t.shard_tokens)), min(FEW_SHARDS, -(-tokens // t.shard_tokens)))


def fit(docs: DataFrame, tokens: str, training: Training = Training(), documents: bool = False) -> Model:
    """Learns word vectors; with ``documents`` a vector of every document belongs to each of its windows meanwhile.

    Those vectors live in their shard only; ``infer`` gives vectors that compare across shards. Null and empty token lists
    teach nothing; an empty table gives an empty model.
    """
    t, with_docs = training, documents
    texts = _stored(docs.select(F.coalesce(F.col(tokens), F.array().cast("array<string>")).alias("tokens"),
                                F.monotonically_increasing_id().alias("row")), "texts")
    total = texts.agg(F.sum(F.size("tokens").cast("long"))).first()[0] or 0
    shards = shards_of(total, t)
    while True:
        dealt = _dealt(texts, shards)
        counted = dealt.select("task", each(F.col("tokens")).alias("word")).groupBy("word", "task").agg(F.count(F.lit(1)).alias("m"))
        here = _stored(counted, "shard-words")
        fewer = -(-here.count() // SHARD_WORDS)
        if fewer <= shards:
            break
        shards = max(fewer, 2 * shards)  # unusually many different words
    vocabulary = here.groupBy("word").agg(F.sum("m").alias("n")).where(F.col("n") >= t.min_count)
    # every start follows from the words and texts, so that tasks make it where it is used
    nothing = F.transform(F.sequence(F.lit(1), F.lit(t.size)), lambda i: F.lit(0.0).cast("float"))
    begun = {"inner": _start(t, F.col("word")), "outer": nothing}
    words = _stored(vocabulary, "words")
    size = words.count()
    rounds = 1 if shards == 1 else max(1, min(t.rounds, t.epochs))
    for k in range(rounds if size else 0):
        state = here.select("task", "word").join(words, "word").repartition(shards, "task")
        given = dealt.withColumn("vector", _start(t, F.concat_ws(" ", "tokens")) if with_docs else F.array().cast("array<float>"))
        if k == 0:
            state = state.withColumns(begun)
        elif with_docs:
            given = dealt.join(vectors, "row")
        given = given.repartition(shards, "task")
        returned = given.groupBy("task").cogroup(state.groupBy("task")).applyInArrow(_shard_task(t, float(total), (k, rounds), with_docs), STATE)
        learned = _stored(_averaged(returned, size, shards, t.size), "learned")
        words = learned.where("word is not null").select("word", "n", "inner", "outer")
        if with_docs:
            vectors = learned.where("word is null").select("row", F.col("inner").alias("vector"))
    if not size:
        words = words.withColumns(begun)
    return Model(words, replace(t, rounds=rounds))


def ascend(inner: np.ndarray, outer: np.ndarray, texts: list[np.ndarray], pool: np.ndarray, vectors: np.ndarray, t: Training, steps: int,
           ridge: float = 1.0) -> None:
    """Moves each text's vector to where it predicts the text best while the words stay fixed.

    The objective (with a penalty of ``ridge`` / 2 on the squared norm) is concave in the vector, so every step has the safe
    length that its curvature allows, with momentum. What a text gets depends on that text alone. What the fixed words give is
    computed once for the texts that are held together, at every step for a text beyond HELD tokens.
    """
    together, held, norms = [], 0, (outer ** 2).sum(1)
    for i, x in enumerate(texts):
        if not together or held + len(x) > UNIT:
            together.append([])
            held = 0
        together[-1].append(i)
        held += len(x)
    for some in together:
        found = vectors[some]
        _ascend_some(inner, outer, norms, [texts[i] for i in some], pool, found, t, steps, ridge)
        vectors[some] = found


def _ascend_some(inner, outer, norms, texts, pool, vectors, t, steps, ridge) -> None:
    others, units = outer[pool], [(i, x[k:k + UNIT]) for i, x in enumerate(texts) for k in range(0, len(x), UNIT)]

    def fixed(units):
        """Of tokens: shares, the scores that the words alone give, and where each text begins."""
        size = np.array([len(x) for _, x in units])
        edge = np.concatenate([[0], np.cumsum(size)])
        tokens, of = np.concatenate([x for _, x in units]), np.repeat([i for i, _ in units], size)
        bands, count = _bands(np.full(len(tokens), t.window), np.repeat(edge[:-1], size), np.repeat(edge[1:], size), inner.dtype)
        share = (1 / (count + 1)).astype(inner.dtype)
        mean, center = _seen(bands, inner[tokens]) * share[:, None], outer[tokens]
        miss = mean @ others.T
        alike = _among(tokens, pool, len(inner))
        miss[alike] = np.where(pool[None, :] == tokens[alike, None], -np.inf, miss[alike])
        return tokens, of, edge[:-1], share, center, np.einsum("ij,ij->i", mean, center), miss

    batches = [units] if sum(len(x) for _, x in units) <= UNIT else [[u] for u in units]
    kept = list(map(fixed, batches)) if sum(map(len, texts)) <= HELD else None
    spread = norms[pool].mean() * t.negative if len(pool) else 0.0
    curvature, ahead, speed = np.full(len(texts), ridge), vectors.astype(np.float64), 1.0
    now = ahead.copy()
    for step in range(steps):
        slope, here = -ridge * ahead, ahead.astype(inner.dtype)
        for tokens, of, first, share, center, hit, miss in kept or map(fixed, batches):
            hit = _chance(hit + share * np.einsum("ij,ij->i", center, here.take(of, 0))) * share
            scores = (here @ -others.T).take(of, 0)
            scores *= share[:, None]
            scores -= miss
            miss = _chance(scores)
            miss *= share[:, None]
            own = of[first]
            _add_rows(slope, own, np.add.reduceat(center * hit[:, None], first, axis=0), 1.0)
            _add_rows(slope, own, np.add.reduceat(miss, first, axis=0) @ others, -t.negative / max(1, len(pool)))
            if not step:
                _add_rows(curvature, of, 0.25 * share ** 2 * (norms[tokens] + spread), 1.0)
        before, now = now, ahead + slope / curvature[:, None]
        faster = (1 + np.sqrt(1 + 4 * speed ** 2)) / 2
        ahead, speed = now + (speed - 1) / faster * (now - before), faster
    vectors[:] = now


def infer(model: Model, docs: DataFrame, id_col: str, tokens: str, steps: int = 40, pool_words: int = 200) -> DataFrame:
    """id and vector of texts, stored or unseen, learned against the fixed word vectors; equal token lists give equal vectors.

    Negatives are ``pool_words`` words, drawn once by their count to the power 0.75 and broadcast (that number bounds it). Texts
    without known words have a null vector; one row per input row.
    """
    t = model.training
    spark = docs.sparkSession
    luck = -F.log((F.pmod(F.xxhash64(F.lit(t.seed), "word"), F.lit(1 << 40)) + 1) / float((1 << 40) + 1)) / F.pow(F.col("n"), 0.75)
    pool = model.words.orderBy(luck, "word").limit(pool_words).select("word", "outer").toArrow().sort_by("word")
    shared = spark.sparkContext.broadcast((pool["word"].to_pylist(), _rows(pool["outer"], t.size)))
    texts = _stored(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(tokens), F.array().cast("array<string>")).alias("tokens"),
                                F.monotonically_increasing_id().alias("row")), "unseen")
    total = texts.agg(F.sum(F.size("tokens").cast("long"))).first()[0] or 0
    parts = max(spark.sparkContext.defaultParallelism, shards_of(total, t))
    dealt = _dealt(texts, parts)
    near = dealt.select(F.col("task").alias("part"), each(F.col("tokens")).alias("word")).distinct().join(model.words, "word") \
        .repartition(parts, "part")

    def run(texts: pa.Table, state: pa.Table) -> pa.Table:
        if not texts.num_rows or not state.num_rows:
            return pa.table({"row": texts["row"] if texts.num_rows else pa.array([], pa.int64()),
                             "vector": pa.nulls(texts.num_rows, pa.list_(pa.float32()))})
        pool_words, pool_outer = shared.value
        words = state["word"].to_pylist()
        number = {w: i for i, w in enumerate(words)}
        # a pool word of these texts keeps its number, so that it is no negative where it is the word to predict
        at = np.array([number.get(w, len(words) + i) for i, w in enumerate(pool_words)], np.int64)
        inner, outer = (np.concatenate([_rows(state[c], t.size), pool_outer]) for c in ("inner", "outer"))
        streams = [np.array([number[w] for w in x if w in number], np.int64) for x in _texts(texts["tokens"])]
        known = [i for i, x in enumerate(streams) if len(x)]
        vectors = np.zeros((len(known), t.size))
        ascend(inner, outer, [streams[i] for i in known], at, vectors, t, steps)
        found = dict(zip(known, vectors.astype(np.float32).tolist()))
        return pa.table({"row": texts["row"], "vector": pa.array([found.get(i) for i in range(len(streams))], pa.list_(pa.float32()))})

    found = dealt.repartition(parts, "task").groupBy("task").cogroup(near.groupBy("part")).applyInArrow(run, "row long, vector array<float>")
    return texts.select("id", "row").join(found, "row").select(F.col("id").alias(id_col), F.col("vector").cast("array<double>").alias("vector"))
