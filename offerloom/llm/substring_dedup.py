"""Removes passages whose word windows occur more than once anywhere in the corpus.

Windows of 35 words are told apart by two Rabin-Karp hashes, which roll over word hashes in one pass, and are counted
in Spark. Counting every window would move several times the corpus, so a first round rules most of them out without
loss: the smallest hash of the 8-word grams inside a window (its minimizer) depends on the window's words alone, hence
two equal windows have equal minimizers at two different places. Only windows whose minimizer occurs twice are counted.
Equal word sequences are one sequence with a number of copies. Repeated windows are merged into maximal intervals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from offerloom.llm.common import short_batches, stored

WINDOW = 35
GRAM = 8
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
EMPTY = hashlib.sha256(b"").hexdigest()


class WordHashes(dict):
    """Hashes of words; the memory is bounded, rarer words are hashed again."""
    MOST = 400_000

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < self.MOST and len(word) < 64:
            self[word] = value
        return value


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown as needed."""
    def __init__(self, base: int):
        self.factors = (base, pow(base, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, f, np.uint64)]), dtype=np.uint64) for f in self.factors)
        return self.up[:n], self.down[:n]


def rolling(values: np.ndarray, width: int, powers: Powers) -> np.ndarray:
    """Rabin-Karp hashes of all windows of a sequence, mixed so that their order is random."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.uint64)
    up, down = powers.upto(n)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(values * down, dtype=np.uint64)])
    out = (sums[width:] - sums[:-width]) * up[width - 1:]
    out ^= out >> np.uint64(33)
    out *= np.uint64(0xFF51AFD7ED558CCD)
    return out ^ (out >> np.uint64(29))


def sliding(values: np.ndarray, width: int, choose) -> np.ndarray:
    """Minimum or maximum of every window, by doubling."""
    done = 1
    while 2 * done <= width:
        values, done = choose(values[:-done], values[done:]), 2 * done
    return choose(values[:len(values) - (width - done)], values[width - done:]) if done < width else values


def minimizers(values: np.ndarray, window: int, gram: int, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """The minimizer of every window, and the hashes of the places that are one (once per place)."""
    if len(values) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    span = window - gram + 1
    grams = rolling(values, gram, powers)
    least = sliding(grams, span, np.minimum)
    pad = np.zeros(span - 1, np.uint64)
    chosen = sliding(np.concatenate([pad, least, pad]), span, np.maximum) == grams
    return least, grams[chosen]


def _stored(df: DataFrame, label: str) -> DataFrame:
    """Writes a table whose texts pass through Python, in short batches."""
    with short_batches(df.sparkSession):
        return stored(df, label)


def _hashed(split: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, split), np.uint64, len(split))


def _number(line: bytes) -> int:
    """A hash of the words, which are joined by one space."""
    return xxhash.xxh64_intdigest(line, 1) - (1 << 63)


def _sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of an id and a text with the hash of the text's words between them."""
    for batch in batches:
        seq = [_number(b" ".join(t.split()) if t else b"") for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(seq, pa.int64()), batch.column(1)], ["own", "own_seq", "text"])


def _sketches(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, powers = WordHashes(), Powers(BASES[0])
        for batch in batches:
            seq, count, sha, marks = [], [], [], []
            for text in batch.column(1).to_pylist():
                split = text.split() if text else []
                line = b" ".join(split)
                _, places = minimizers(_hashed(split, known), window, gram, powers) if len(split) >= window else (None, np.zeros(0, np.uint64))
                once, times = np.unique(places, return_counts=True)
                seq.append(_number(line))
                count.append(len(split))
                sha.append(hashlib.sha256(line).digest())
                marks.append(np.concatenate([once, once[times > 1]]).view(np.int64))
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(seq, pa.int64()), pa.array(count, pa.int64()), pa.array(sha, pa.binary()),
                pa.array(marks, pa.list_(pa.int64()))], ["doc_id", "seq", "n_words", "sha", "marks"])
    return run


def _windows(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, powers = WordHashes(), [Powers(b) for b in BASES]
        for batch in batches:
            for doc, seq, single, text, marks in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                values = _hashed(text.split(), known)
                least, _ = minimizers(values, window, gram, powers[0])
                starts = np.flatnonzero(np.isin(least, np.array(marks, np.int64).view(np.uint64)))
                h1, h2 = (rolling(v, window, p)[starts].view(np.int64) for v, p in zip((values, values ^ (values >> np.uint64(31))), powers))
                n = len(starts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(h1), pa.array(h2), pa.array([doc] * n, pa.int64()), pa.array(np.full(n, seq, np.int64)),
                    pa.array(np.full(n, single)), pa.array(starts.astype(np.int32))], ["h1", "h2", "doc_id", "seq", "single", "start"])
    return run


def _removals(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, sha, spans = [], [], []
            for text, starts in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                split = text.split()
                edge = np.zeros(len(split) + 1, np.int64)
                at = np.array(starts)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + window, -1)
                gone = np.cumsum(edge[:-1]) > 0
                turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                removed.append(int(gone.sum()))
                sha.append(hashlib.sha256(b" ".join(w for w, g in zip(split, gone.tolist()) if not g)).hexdigest())
                spans.append(turns.tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(sha, pa.string()),
                                              pa.array(spans, pa.list_(pa.int64()))], ["doc_id", "seq", "n_removed", "kept_sha256", "spans"])
    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, seq (a hash of the words), n_words, n_removed, kept_sha256 and spans (begin and end word of each removed interval, in turn; null
    where the whole text goes as a copy of another) for every row of ``docs``.

    Null and blank texts have no words and keep none; texts shorter than the window keep all; repeated rows are copies
    of each other; an empty table gives no rows; null ids are kept. Other columns are not read.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    sketch = _stored(texts.mapInArrow(_sketches(window, gram), "doc_id long, seq long, n_words long, sha binary, marks array<long>"), "substring-sketches")

    # One representative of every word sequence, with its number of copies.
    groups = stored(sketch.where(F.col("n_words") >= window).groupBy("sha").agg(
        F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first"), F.first("seq").alias("group_seq")), "substring-groups")
    heads = groups.join(sketch.select(F.col("sha").alias("own"), "doc_id", "marks"),
                        (F.col("sha") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("first"))) \
        .select("doc_id", F.col("group_seq").alias("seq"), (F.col("copies") == 1).alias("single"), "marks").dropDuplicates(["doc_id", "seq"])
    heads = stored(heads, "substring-heads")

    # Minimizers found at two places, back to their documents.
    places = heads.select("doc_id", "seq", "single", F.explode("marks").alias("mark"))
    twice = places.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("mark")
    marked = places.join(twice, "mark").groupBy("doc_id", "seq", "single").agg(F.collect_set("mark").alias("marks"))

    # Their windows, counted; only these texts are moved.
    seq = F.col("seq")
    own = texts.mapInArrow(_sequences, "own long, own_seq long, text binary")
    near = own.join(marked, F.col("own").eqNullSafe(F.col("doc_id")) & (F.col("own_seq") == seq)).select("doc_id", "seq", "single", "text", "marks")
    near = _stored(near.dropDuplicates(["doc_id", "seq"]), "substring-texts")
    windows = _stored(near.mapInArrow(_windows(window, gram), "h1 long, h2 long, doc_id long, seq long, single boolean, start int"), "substring-windows")
    # Written, so that the join has an exchange of its own, whose hot keys Spark's skew handling can divide.
    repeated = stored(windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2"), "substring-repeated")
    starts = windows.where("single").join(repeated, ["h1", "h2"]).groupBy("doc_id", "seq").agg(F.collect_list("start").alias("starts")) \
        .select(F.col("doc_id").alias("d"), F.col("seq").alias("s"), "starts")
    cut = near.join(starts, F.col("doc_id").eqNullSafe(F.col("d")) & (seq == F.col("s"))).select("doc_id", "seq", "text", "starts") \
        .mapInArrow(_removals(window), "doc_id long, seq long, n_removed long, kept_sha256 string, spans array<long>")
    cut = _stored(cut, "substring-cut") \
        .select(F.col("doc_id").alias("d"), F.col("seq").alias("s"), "n_removed", "kept_sha256", "spans")

    copies = groups.where("copies > 1").select(F.col("sha").alias("copied"))
    rows = sketch.drop("marks").join(copies, F.col("sha") == F.col("copied"), "left") \
        .join(cut, F.col("doc_id").eqNullSafe(F.col("d")) & (seq == F.col("s")), "left")
    whole = F.col("copied").isNotNull()
    none = F.array().cast("array<long>")
    return rows.select(
        "doc_id", "seq", "n_words", F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, F.lit(EMPTY)).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("sha")))).alias("kept_sha256"),
        F.when(~whole, F.coalesce("spans", none)).alias("spans"))


@F.pandas_udf(LongType())
def _sequence(texts):
    import pandas as pd
    return pd.Series([_number(b" ".join(t.split()) if t else b"") for t in texts], dtype="int64")


def substring_digest(docs: DataFrame) -> DataFrame:
    return repeated_spans(docs).drop("seq", "spans")


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id and the kept words of every row, joined by one space; rows that repeat an id keep their own words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    spans = repeated_spans(docs, window).select(F.col("doc_id").alias("id"), F.col("seq").alias("sequence"), "spans").dropDuplicates(["id", "sequence"])

    @F.pandas_udf("string")
    def kept(texts, cuts):
        import pandas as pd
        out = []
        for text, cut in zip(texts, cuts):
            split = text.split() if text else []
            if cut is None:
                out.append("")
                continue
            edge = [0, *[int(x) for x in cut], len(split)]
            out.append(b" ".join(w for i in range(0, len(edge), 2) for w in split[edge[i]:edge[i + 1]]).decode())
        return pd.Series(out)

    same = F.col("doc_id").eqNullSafe(F.col("id")) & (_sequence(F.col("text")) == F.col("sequence"))
    return rows.join(spans, same).select("doc_id", kept(F.col("text"), "spans").alias("kept_text"))
