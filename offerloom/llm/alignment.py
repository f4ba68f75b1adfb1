"""Alignment of two tokenizers: which of their tokens cover the same bytes, and how common each pair is.

A text is cut where neither tokenizer can join anything (a space between two other characters), so every distinct
stretch of a batch is encoded and aligned once, and no text is too long. A first pass counts the linked id pairs of
every task. The distinct pairs get a minimal perfect hash: shards of some ten thousand keys each build the bit levels of
their own, and a pair's slot is the number of bits set before its own. Every task then adds its counts to a dense
vector by slot, the vectors are summed block by block in a tree, and the key kept in each slot is verified on every
look-up. A second pass aligns the documents again and looks their counts up.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import stored

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: Fixed value: how byte-level vocabularies of this kind cut a text before they merge.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: A run of white space on which PATTERN would go back too far; texts with one are left to the encoder of the file.
LONG_RUN = 65_536
BLANKS = re.compile(r"(?<!\s)\s{%d}" % LONG_RUN)
#: The begin mark of pieces, which stands for a space.
MARK = "▁"
#: Neither vocabulary has a token that ends a stretch and begins the next one at such a space.
CUT = re.compile(rf"(?<=[^\s{MARK}]) (?=[^\s{MARK}])")
SLICE_CHARS = 1 << 23
#: Pairs that one table may hold (about 16 bytes each): what is broadcast at once.
TABLE_PAIRS = 1 << 22
SHARD_KEYS = 1 << 16
BLOCK = 1 << 16
#: Dense vectors that are built side by side, and how many of them one task adds up.
VECTORS, FAN_IN = 256, 16
DIGEST = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as letters from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, a_json: bytes, b_model: bytes):
        import sentencepiece

        spec, letters = json.loads(a_json), _byte_of_letter()
        self.encode_a = _ranked(spec, letters, a_json) or _whole(a_json)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        vocabulary = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode()
                        for i in range(self.b.vocab_size()) for p in [self.b.id_to_piece(i)]]
        self.sizes = [np.array([len(t) for t in tokens], np.int64) for tokens in (self.a_bytes, self.b_bytes)]
        #: The decimal ids with what follows them inside a group and at the end of a group's side.
        self.decimals = [np.array([str(i) + end for end in ends for i in range(len(tokens))], object)
                         for tokens, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;"))]

    def encode(self, stretches: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return self.encode_a([" " + s for s in stretches]), self.b.encode(stretches, num_threads=1)


def _ranked(spec: dict, letters: dict[str, int], a_json: bytes) -> Callable[[list[str]], list[list[int]]] | None:
    """An encoder by ranks, for a file whose merges stand in the order of the ids they make and that cuts texts by PATTERN alone."""
    import tiktoken

    model, cut = spec["model"], spec.get("pre_tokenizer") or {}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    plain = (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex")) == ("ByteLevel", False, True) and not spec.get("normalizer")
    if not plain or model.get("ignore_merges") or any(model["vocab"].get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(letters[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    encoding = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    whole = lru_cache(maxsize=1)(lambda: _whole(a_json))

    def encode(texts: list[str]) -> list[list[int]]:
        return [whole()([t])[0] if len(t) >= LONG_RUN and BLANKS.search(t) else encoding.encode_ordinary(t) for t in texts]

    return encode


def _whole(a_json: bytes) -> Callable[[list[str]], list[list[int]]]:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(a_json.decode())
    tokenizer.encode_special_tokens = True
    return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=1)
def _aligner(a_json: bytes, b_model: bytes) -> Aligner:
    return Aligner(a_json, b_model)


@dataclass
class Aligned:
    """A run of texts. Text i consists of the distinct stretches at[begin[i]:end[i]]; texts without tokens of none.
    counts: tokens of A, tokens of B, groups and links of each stretch; keys: the links of all stretches end to end."""
    at: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    counts: list[np.ndarray]
    keys: np.ndarray
    pieces: list[str]

    def per_text(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values[self.at])]) if len(self.at) else np.zeros(1, np.int64)
        return total[self.end] - total[self.begin]

    def per_stretch(self, links: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(links)])
        return np.diff(total[np.concatenate([[0], np.cumsum(self.counts[3])])])

    def digests(self) -> list[str]:
        """sha256 of the groups of each text, '' without tokens."""
        ends = np.cumsum(self.counts[0] + self.counts[1]).tolist()
        lines = ["".join(self.pieces[b:e]) for b, e in zip([0, *ends], ends)]
        at = self.at.tolist()
        return [sha256("".join([lines[i] for i in at[b:e]])[:-1].encode()).hexdigest() if e > b else ""
                for b, e in zip(self.begin.tolist(), self.end.tolist())]


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


def _differing(stretches: list[str], ids: list[np.ndarray], counts: list[np.ndarray], aligner: Aligner) -> list[int]:
    """The stretches that a tokenizer does not give back byte by byte."""
    data = [b" " + s.encode() for s in stretches]
    lengths = np.fromiter(map(len, data), np.int64, len(data))
    joined, bad = b"".join(data), set()
    for own, n, size, tokens in zip(ids, counts, aligner.sizes, (aligner.a_bytes, aligner.b_bytes)):
        ends = np.concatenate([[0], np.cumsum(n)])
        total = np.concatenate([[0], np.cumsum(size[own])])
        if b"".join([tokens[i] for i in own.tolist()]) != joined or (np.diff(total[ends]) != lengths).any():
            bad.update(k for k, (x, y) in enumerate(zip(ends[:-1], ends[1:])) if b"".join([tokens[i] for i in own[x:y].tolist()]) != data[k])
    return sorted(bad)


def _aligned(texts: list[str | None], aligner: Aligner, with_pieces: bool = False) -> Aligned:
    places: dict[str, int] = {}
    parts = [[places.setdefault(s, len(places)) for s in CUT.split(t)] if t else [] for t in texts]
    lists = aligner.encode(list(places))
    n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in lists)
    a_ids, b_ids = map(_flat, lists)
    if bad := _differing(list(places), [a_ids, b_ids], [n_a, n_b], aligner):
        wrong = set(bad)
        parts = [[] if not wrong.isdisjoint(p) else p for p in parts]
        used = np.zeros(len(places), bool)  # what only texts without tokens hold is neither counted nor looked up
        used[_flat(parts)] = True
        a_ids, b_ids = a_ids[np.repeat(used, n_a)], b_ids[np.repeat(used, n_b)]
        n_a, n_b = n_a * used, n_b * used
    a_end, b_end = np.cumsum(aligner.sizes[0][a_ids]), np.cumsum(aligner.sizes[1][b_ids])
    # Between two neighbouring token ends, of either side, lies one link; where both sides end, a group ends.
    ends = np.zeros(int(a_end[-1]) + 1 if len(a_end) else 1, bool)
    ends[a_end] = ends[b_end] = True
    cuts = np.flatnonzero(ends)
    i, j = np.searchsorted(a_end, cuts), np.searchsorted(b_end, cuts)
    both = (a_end[i] == cuts) & (b_end[j] == cuts)
    stretch = np.repeat(np.arange(len(places)), n_a)[i]
    counts = [n_a, n_b, *(np.bincount(x, minlength=len(places)) for x in (stretch[both], stretch))]
    pieces = []
    if with_pieces:
        sides = []
        for side, (ids, end) in enumerate(((a_ids, a_end), (b_ids, b_end))):
            group = np.searchsorted(cuts[both], end)
            last = np.concatenate([group[1:] != group[:-1], [True]]) if len(group) else np.zeros(0, bool)
            sides.append((group * 2 + side, aligner.decimals[side][ids + last * len(aligner.sizes[side])]))
        order = np.argsort(np.concatenate([s[0] for s in sides]), kind="stable")
        pieces = np.concatenate([s[1] for s in sides])[order].tolist()
    size = np.array([len(p) for p in parts], np.int64)
    end = np.cumsum(size)
    return Aligned(_flat(parts), end - size, end, counts, a_ids[i] * len(aligner.b_bytes) + b_ids[j], pieces)


def _runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Cuts a batch into runs of bounded length; one text is never divided here."""
    low = 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and (high == low or size < SLICE_CHARS):
            size += len(texts[high] or "")
            high += 1
        yield low, high
        low = high


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def pair_counts(docs: DataFrame, files: Broadcast) -> DataFrame:
    """First pass: (key, n) of every task; key = A's id times the size of B's vocabulary plus B's id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, held, size = _aligner(*files.value), [], 0
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for low, high in _runs(texts):
                got = _aligned(texts[low:high], aligner)
                n = np.repeat(np.bincount(got.at, minlength=len(got.counts[3])), got.counts[3])
                held.append(_summed(got.keys, n))
                size += len(held[-1][0])
                if size > 1 << 21:
                    held = [_summed(*map(np.concatenate, zip(*held)))]
                    size = len(held[0][0])
                    if size > 1 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(held[0][0]), pa.array(held[0][1])], ["key", "n"])
                        held, size = [], 0
        if held:
            keys, n = _summed(*map(np.concatenate, zip(*held)))
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["key", "n"])

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "key long, n long")


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of the keys; each seed is a function of its own."""
    x = keys.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return (mix(keys, 1 << 20) % np.uint64(shards)).astype(np.int64)


def hash_levels(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Bit levels of a minimal perfect hash of distinct keys: a key's bit is set on the first level where it is alone.

    Returns the bits of each level (multiples of 64, two a key) and the levels' words end to end.
    """
    sizes, words = [], []
    while len(keys):
        bits = -(-2 * len(keys) // 64) * 64
        at = (mix(keys, len(sizes)) % np.uint64(bits)).astype(np.int64)
        alone = np.bincount(at, minlength=bits) == 1
        sizes.append(bits)
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        keys = keys[~alone[at]]
    return sizes, np.concatenate(words) if words else np.zeros(0, np.uint64)


@dataclass
class PerfectHash:
    """first, size: bits of each (shard, level) in ``words``; before: bits set before each word."""
    low: int
    shards: int
    first: np.ndarray
    size: np.ndarray
    words: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, low: int, shards: int, levels: list[list[int]], words: list[np.ndarray]) -> PerfectHash:
        """From the levels of the shards ``low`` to ``low + len(levels) - 1`` out of ``shards``."""
        size = np.zeros((len(levels), max(map(len, levels), default=0)), np.int64)
        for i, own in enumerate(levels):
            size[i, :len(own)] = own
        first = (np.cumsum(size.ravel()) - size.ravel()).reshape(size.shape)
        joined = np.concatenate(words) if words else np.zeros(0, np.uint64)
        return cls(low, shards, first, size, joined, np.cumsum(np.bitwise_count(joined), dtype=np.int64) - np.bitwise_count(joined))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for keys of other shards and for some that are not in the set."""
        out = np.full(len(keys), -1, np.int64)
        shard = _shard_of(keys, self.shards) - self.low
        live = np.flatnonzero((shard >= 0) & (shard < len(self.size)))
        for level in range(self.size.shape[1]):
            bits = self.size[shard[live], level]
            live, bits = live[bits > 0], bits[bits > 0]
            at = self.first[shard[live], level] + (mix(keys[live], level) % bits.astype(np.uint64)).astype(np.int64)
            word, bit = self.words[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[live[hit]] = (self.before[at >> 6] + np.bitwise_count(below))[hit]
            live = live[~hit]
        return out


@dataclass
class Table:
    hash: PerfectHash
    keys: np.ndarray
    counts: np.ndarray

    def look_up(self, keys: np.ndarray) -> np.ndarray:
        """Counts of the keys that belong to this table, 0 for those of other tables; what a slot holds is verified."""
        slot = self.hash.slots(keys)
        found = slot >= 0
        out = np.zeros(len(keys), np.int64)
        if (self.keys[slot[found]] != keys[found]).any():
            raise KeyError("a pair of the second pass is not among those of the first")
        out[found] = self.counts[slot[found]]
        return out


def _tables(pairs: DataFrame, table_pairs: int, shard_keys: int) -> Iterator[Table]:
    """Tables over all pairs, each of about ``table_pairs`` of them, one after another on the driver."""
    spark = pairs.sparkSession
    distinct = stored(pairs.select("key").distinct(), "pair-keys")
    total = distinct.count()
    per_table = max(1, table_pairs // shard_keys)
    shards = max(1, -(-total // shard_keys))

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_shard_of(batch.column(0).to_numpy(), shards)), batch.column(0)], ["shard", "key"])

    def levels(keys: pa.Table) -> pa.Table:
        sizes, words = hash_levels(keys["key"].to_numpy())
        return pa.table({"shard": keys["shard"][:1], "n": [keys.num_rows], "sizes": pa.array([sizes], pa.list_(pa.int64())), "words": [words.tobytes()]})

    built = stored(distinct.mapInArrow(shard, "shard long, key long").groupBy("shard").applyInArrow(
        levels, "shard long, n long, sizes array<long>, words binary"), "pair-hash")
    for low in range(0, shards, per_table):
        own = {r["shard"]: r for r in built.where(F.col("shard").between(low, low + per_table - 1)).collect()}
        span = range(low, min(shards, low + per_table))
        perfect = PerfectHash.of(low, shards, [own[s]["sizes"] if s in own else [] for s in span],
                                 [np.frombuffer(own[s]["words"], "<u8") for s in span if s in own])
        yield _filled(spark, pairs, perfect, sum(r["n"] for r in own.values()))


def _filled(spark, pairs: DataFrame, perfect: PerfectHash, size: int) -> Table:
    """The table of one hash: dense vectors of counts and keys, one a task, summed by blocks in a tree."""
    shared = spark.sparkContext.broadcast(perfect)
    schema = "block long, lane long, counts binary, keys binary"

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            keys = batch.column(0).to_numpy()
            slot = shared.value.slots(keys)
            own = slot >= 0
            np.add.at(counts, slot[own], batch.column(1).to_numpy()[own])
            held[slot[own]] = keys[own]
        for block in range(0, size, BLOCK):
            part = counts[block:block + BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block // BLOCK]), pa.array([TaskContext.get().partitionId() // FAN_IN]), pa.array([part.tobytes()]),
                     pa.array([held[block:block + BLOCK].tobytes()])], ["block", "lane", "counts", "keys"])

    def add(vectors: pa.Table) -> pa.Table:
        counts, keys = (np.stack([np.frombuffer(x, np.int64) for x in vectors[c].to_pylist()]) for c in ("counts", "keys"))
        return pa.table({"block": vectors["block"][:1], "lane": [vectors["lane"][0].as_py() // FAN_IN],
                         "counts": [counts.sum(0).tobytes()], "keys": [keys.max(0).tobytes()]})

    few = pairs.coalesce(VECTORS)
    lanes = few.rdd.getNumPartitions()
    summed = few.mapInArrow(dense, schema)
    while True:
        summed = summed.groupBy("block", "lane").applyInArrow(add, schema)
        lanes = -(-lanes // FAN_IN)
        if lanes <= 1:
            break
    counts, keys = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for r in summed.collect():
        at = slice(r["block"] * BLOCK, r["block"] * BLOCK + BLOCK)
        counts[at], keys[at] = np.frombuffer(r["counts"], np.int64), np.frombuffer(r["keys"], np.int64)
    shared.unpersist()
    return Table(perfect, keys, counts)


def _looked_up(docs: DataFrame, files: Broadcast, table: Table | None, best: np.ndarray) -> DataFrame:
    """Second pass: the digest of every document, with the counts of the pairs in this table; row: its number."""
    shared = docs.sparkSession.sparkContext.broadcast((table, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*files.value)
        table, best = shared.value
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for low, high in _runs(texts):
                got = _aligned(texts[low:high], aligner, with_pieces=True)
                n = table.look_up(got.keys) if table else np.zeros(len(got.keys), np.int64)
                top = (n > 0) & (n == best[got.keys % len(best)])
                per_stretch = [*got.counts, got.per_stretch(top), got.per_stretch(n)]
                rows = batch.slice(low, high - low)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), *(pa.array(got.per_text(x), pa.int64()) for x in per_stretch),
                     pa.array(got.digests(), pa.string())],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return docs.select("row", "doc_id", "text").mapInArrow(run, "row long, " + DIGEST)


def alignment_digest(docs: DataFrame, a_file: str = A_FILE, b_file: str = B_FILE, table_pairs: int = TABLE_PAIRS,
                     shard_keys: int = SHARD_KEYS) -> DataFrame:
    """How the tokens of A and B cover each document, and how common its linked pairs are in all documents.

    A text that is null or empty, or that a tokenizer does not give back byte by byte, has no tokens: zeros and an empty
    digest. Rows that repeat count and are returned each; an empty table gives no rows; other columns are not read.
    With at most ``table_pairs`` distinct pairs one look-up table is broadcast. Beyond, the tables are used one after
    another: the documents are kept with a row number and aligned again for each, and the parts are added up.
    """
    sc = docs.sparkSession.sparkContext
    files = sc.broadcast((Path(a_file).read_bytes(), Path(b_file).read_bytes()))
    vocabulary = Aligner(*files.value).b.vocab_size()
    rows = docs.select(F.lit(0).cast("long").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pairs = stored(pair_counts(rows, files), "pair-counts")
    best, tables = np.zeros(vocabulary, np.int64), []
    for table in _tables(pairs, table_pairs, shard_keys):
        np.maximum.at(best, table.keys % vocabulary, table.counts)
        tables = [table] if not tables else [*tables, None]
    if len(tables) <= 1:
        return _looked_up(rows, files, tables[0] if tables else None, best).drop("row")
    kept = stored(rows.withColumn("row", F.monotonically_increasing_id()), "aligned-documents")
    parts = None
    for table in _tables(pairs, table_pairs, shard_keys):
        part = stored(_looked_up(kept, files, table, best), "aligned-part")
        parts = part if parts is None else parts.unionByName(part)
    same = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    whole = parts.groupBy(*same).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return whole.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
