"""Near-duplicates by SimHash with a byte-position index.

Fingerprints of 64 bits that differ in at most four bits differ in at most four of their eight bytes, so they share at
least four positional bytes. The index therefore keys every distinct fingerprint by each four of its (position, byte)
postings: any pair that reaches the guaranteed minimum of four matches meets under a key, and no list is as long as
that of a single byte. For the pairs that meet, the shared positional bytes are tallied, a pair is kept under the first
four it shares, and the kept ones are verified by their differing bits. What leaves a task is a spanning forest of the
verified links, not the links of a whole group.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from offerloom.llm.common import components, free_name, short_batches, stored

SEED = 42
SHINGLE = 4
RADIUS = 4
LEAST_SHARED = 8 - RADIUS
#: A key with more fingerprints than this is compared block by block in several tasks.
BLOCK = 2048
PICKS = np.array(list(combinations(range(8), LEAST_SHARED)))
LINKS = "kind int, a long, b long, key long, block int"


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles, repeats included, after lower-casing A-Z; 0 without words."""
    split = text.lower().split() if text else []
    if not split:
        return 0
    line = b" ".join(split)
    if len(split) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    else:
        gaps = np.flatnonzero(np.frombuffer(line, np.uint8) == 32)
        starts = [0, *(gaps[:len(split) - shingle] + 1).tolist()]
        ends = [*gaps[shingle - 1:].tolist(), len(line)]
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends)), np.uint64, len(starts))
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[part:part + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and its fingerprint as a (signed) long. Null and blank texts have fingerprint 0."""
    return _with_prints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), shingle)


def _with_prints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The other columns with ``fp`` in the place of ``text``, which is the last one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *others, texts = batch.columns
            values = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*others, pa.array(values)], [*batch.schema.names[:-1], "fp"])

    schema = StructType([*docs.schema.fields[:-1], StructField("fp", LongType())])
    return docs.withColumn("text", F.col("text").cast("binary")).mapInArrow(run, schema)


def _differing(a: np.ndarray, b: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """Whether pairs that meet under the key ``pick`` are links that belong to this key: the tally of shared
    positional bytes reaches the minimum, ``pick`` is the first such choice, and the bits agree up to the radius."""
    apart = a ^ b
    same = apart.view(np.uint8).reshape(-1, 8) == 0
    tally = np.cumsum(same, axis=1)
    near = tally[:, -1] >= LEAST_SHARED
    last = PICKS[pick, -1]
    near &= tally[np.arange(len(a)), last] == LEAST_SHARED
    return near & (np.bitwise_count(apart) <= RADIUS)


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest member of every other member's component, over the given links."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[:len(a)], flat[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        after = root.copy()
        for end in (x, y):
            np.minimum.at(after, end, low)
            np.minimum.at(after, root[end], low)
        after = after[after]
        if (after == root).all():
            break
        root = after
    moved = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[moved], nodes[root[moved]]


def _links_batch(kind: int, a, b, key=None, block: int = 0) -> pa.RecordBatch:
    n = len(a)
    key = np.zeros(n, np.int64) if key is None else key
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n, kind, np.int32)), pa.array(np.asarray(a).view(np.int64)), pa.array(np.asarray(b).view(np.int64)),
        pa.array(key), pa.array(np.full(n, block, np.int32))], ["kind", "a", "b", "key", "block"])


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys of every fingerprint: which four positions, and their bytes."""
    for batch in batches:
        fps = batch.column(0).to_numpy()
        for part in range(0, len(fps), 1024):
            some = fps[part:part + 1024]
            octets = some.view(np.uint8).reshape(-1, 8)[:, PICKS].astype(np.int64)  # rows x picks x 4
            keys = octets @ (1 << np.arange(0, 8 * LEAST_SHARED, 8)) + (np.arange(len(PICKS)) << 8 * LEAST_SHARED)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(some, len(PICKS)))], ["key", "fp"])


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares the fingerprints of each key in rows sorted by key. A key with more than BLOCK fingerprints is handed
    on in numbered blocks instead, so a task holds one batch and one block at most."""
    held_key, held_fp, hot, number = np.zeros(0, np.int64), np.zeros(0, np.uint64), None, 0

    def compare(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        at, found = np.flatnonzero(key[:-1] == key[1:]), []
        step = 1
        while len(at):
            ok = _differing(fp[at], fp[at + step], (key[at] >> 8 * LEAST_SHARED).astype(int))
            found.append((at[ok], at[ok] + step))
            step += 1
            at = at[at + step < len(key)]
            at = at[key[at] == key[at + step]]
            if sum(len(x) for x, _ in found) > 1_000_000:
                yield from links(fp, found)
                found = []
        yield from links(fp, found)

    def links(fp, found):
        if found and sum(len(x) for x, _ in found):
            x, y = (np.concatenate([f[i] for f in found]) for i in (0, 1))
            yield _links_batch(0, *_forest(fp[x], fp[y]))

    for batch in batches:
        key = np.concatenate([held_key, batch.column(0).to_numpy()])
        fp = np.concatenate([held_fp, batch.column(1).to_numpy().view(np.uint64)])
        if not len(key):
            continue
        edges = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]])
        small = np.ones(len(key), bool)
        for i in np.flatnonzero((np.diff(edges) > BLOCK) | ((key[edges[:-1]] == hot) if hot is not None else False)):
            low, high = edges[i], edges[i + 1]
            if key[low] != hot:
                hot, number = key[low], 0
            last = high == len(key)
            full = low + (high - low) // BLOCK * BLOCK if last else high
            for part in range(low, full, BLOCK):
                end = min(part + BLOCK, full)
                yield _links_batch(1, fp[part:end], fp[part:end], key[part:end], number)
                number += 1
            small[low:full] = False
        tail = edges[-2]
        keep = small[:tail]
        yield from compare(key[:tail][keep], fp[:tail][keep])
        rest = small[tail:]
        held_key, held_fp = key[tail:][rest], fp[tail:][rest]
    if len(held_key):
        if held_key[0] == hot:
            yield _links_batch(1, held_fp, held_fp, held_key, number)
        else:
            yield from compare(held_key, held_fp)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between two blocks of one key (or inside one); a group has at most two blocks."""
    parts = list(batches)
    key = int(parts[0].column("key")[0].as_py())
    fp = np.concatenate([p.column("a").to_numpy() for p in parts]).view(np.uint64)
    block = np.concatenate([p.column("block").to_numpy() for p in parts])
    pick = key >> 8 * LEAST_SHARED
    low, high = fp[block == block.min()], fp[block == block.max()]
    for part in range(0, len(low), 64):
        some = low[part:part + 64]
        x, y = (m.ravel() for m in np.broadcast_arrays(some[:, None], high[None, :]))
        x, y = np.ascontiguousarray(x), np.ascontiguousarray(y)
        near = (x != y) & (np.bitwise_count(x ^ y) <= RADIUS)
        x, y = x[near], y[near]
        ok = _differing(x, y, np.full(len(x), pick))
        if ok.any():
            yield _links_batch(0, *_forest(x[ok], y[ok]))


def near_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of fingerprints within the radius."""
    spark = distinct.sparkSession
    keys = distinct.select("fp").mapInArrow(_postings, "key long, fp long")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = stored(keys.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_meet, LINKS), "simhash-links")
    blocks = met.where("kind = 1")
    last = blocks.groupBy("key").agg(F.max("block").alias("last"))
    pairs = blocks.join(last, "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last")))) \
        .select("kind", "a", "b", "key", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    across = pairs.groupBy("key", "low", "high").applyInArrow(_pair_of_blocks, LINKS)
    return met.where("kind = 0").select("a", "b").unionByName(across.select("a", "b"))


def _pair_of_blocks(table: pa.Table) -> pa.Table:
    found = list(_across(iter(table.combine_chunks().to_batches())))
    return pa.Table.from_batches(found or [_links_batch(0, np.zeros(0, np.int64), np.zeros(0, np.int64))])


def near_groups(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable over links of at most four bits).

    Equal fingerprints are one node, however many rows have them. Null ids stay and count as no id; repeated rows
    give repeated rows; an empty table gives none. Other columns are not read, so their names don't matter.
    """
    with short_batches(docs.sparkSession):
        prints = stored(fingerprints(docs), "simhash-prints")
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-nodes")
    roots = components(near_links(nodes), "simhash-components")
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = stored(named.join(lowest, "root").select(F.col("fp").alias("node"), "component_id"), "simhash-labels")
    return prints.join(labels, prints["fp"] == labels["node"]).select("doc_id", "fp", "component_id")


def near_digest(docs: DataFrame) -> DataFrame:
    return near_groups(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each group of near copies stays: the one with the smallest id; a row without an id only where no row
    of the group has one.

    Groups are those of the fingerprints, not of the ids: rows that repeat an id over unrelated texts are judged
    apart. Rows get a key that is written before it is read twice; among
    rows of equal id it decides only after a hash of the row, so reruns keep the same rows.
    """
    key = free_name(docs, "__row")
    rows = stored(docs.withColumn(key, F.monotonically_increasing_id()), "simhash-rows")
    hashed = [f.name for f in docs.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    prints = _with_prints(rows.select("doc_id", F.xxhash64(*hashed).alias("hash"), F.col(key).alias("row"), "text"))
    rank = F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "hash", "row")
    with short_batches(docs.sparkSession):
        nodes = stored(prints.groupBy("fp").agg(F.min(rank).alias("first")), "simhash-nodes")
    roots = components(near_links(nodes), "simhash-components")
    named = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("first", F.coalesce("root", "fp").alias("root"))
    kept = named.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(key))
    return rows.join(kept, key, "left_semi").select(*docs.columns)
