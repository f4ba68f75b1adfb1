"""Shards of near-equal bytes by histogram sort.

Every row gets a sort key whose high bits hash the text, whose middle bits hash the id and whose low bits hash a row number:
equal texts lie side by side, and even a group of copies that holds a third of all rows, with ids or without, can be cut. Splitters are found by probing: each
round counts, over all rows, the exact bytes below the candidate boundaries of every open interval, and narrows
the interval around the target. Rows then cross the network once, to their place in the order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.llm.common import free_name, stored

KEY_BITS = 63
ID_BITS = 15
ROW_BITS = 14
ROW_BYTES = 16


def row_size(text: Column) -> Column:
    """UTF-8 bytes of the text (null: none) plus the fixed cost of a row."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def sort_key(text: Column, doc_id: Column) -> Column:
    """Differs by row, so it holds only in a table that was stored with it."""
    def bits(n: int, *parts: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(*parts), 64 - n)
    return F.shiftleft(bits(KEY_BITS - ID_BITS - ROW_BITS, text), ID_BITS + ROW_BITS).bitwiseOR(
        F.shiftleft(bits(ID_BITS, doc_id), ROW_BITS)).bitwiseOR(bits(ROW_BITS, F.monotonically_increasing_id()))


def _below(table: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with a key below each probe; what returns is bounded by the number of probes."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            at = np.searchsorted(probes, batch.column(0).to_numpy(), side="right")
            rows += np.bincount(at, minlength=len(rows))
            # two halves keep the float sums of bincount exact
            weight = batch.column(1).to_numpy()
            for half, factor in ((weight & 0xFFFFFF, 1), (weight >> 24, 1 << 24)):
                size += np.bincount(at, half, len(size)).astype(np.int64) * factor
        used = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(size[used]), pa.array(rows[used])], ["at", "size", "n"])

    size, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    counts = table.mapInArrow(tally, "at long, size long, n long").groupBy("at").agg(F.sum("size").alias("size"), F.sum("n").alias("n"))
    for r in counts.collect():
        size[r["at"]], rows[r["at"]] = r["size"], r["n"]
    return np.cumsum(size)[:-1], np.cumsum(rows)[:-1]


def find_splitters(table: DataFrame, parts: int, tolerance: float = 0.001, probes: int = 16, rounds: int = 80) -> np.ndarray:
    """Keys that cut a (key, size) table into parts of equal bytes, each cut off by at most
    ``tolerance`` of a part, or as near as rows of one key allow."""
    total = table.agg(F.sum("size")).first()[0] or 0
    goal = np.array([total * i // parts for i in range(1, parts)], np.int64)
    low, high = np.zeros(parts - 1, np.int64), np.full(parts - 1, np.int64((1 << KEY_BITS) - 1))
    low_bytes, high_bytes = np.zeros_like(goal), np.full_like(goal, total)
    for _ in range(rounds):
        slack = max(1, int(tolerance * total / parts))
        open_ = (np.minimum(goal - low_bytes, high_bytes - goal) > slack) & (high - low > 1)
        if not open_.any():
            break
        steps = np.arange(1, probes, dtype=np.int64)
        width = (high - low)[open_]
        inner = low[open_][:, None] + width[:, None] // probes * steps + width[:, None] % probes * steps // probes
        candidates = np.unique(inner)
        size, _ = _below(table, candidates)
        for i in np.flatnonzero(open_):
            at = np.searchsorted(size, goal[i], side="right")
            if at > 0 and candidates[at - 1] > low[i]:
                low[i], low_bytes[i] = candidates[at - 1], size[at - 1]
            if at < len(candidates) and candidates[at] < high[i]:
                high[i], high_bytes[i] = candidates[at], size[at]
    return np.where(goal - low_bytes <= high_bytes - goal, low, high)


def shard(docs: DataFrame, key: Column, size: Column, shards: int = 40, piece_bytes: int = 1 << 28,
          most_pieces: int = 10_000, tolerance: float = 0.001) -> DataFrame:
    """Adds ``shard`` (0 to shards-1) and ``slot`` (gapless from 0 within the shard) to every row.

    Law `bytes`: shard sizes are equal up to ``tolerance`` of a shard plus the rows that share one key. A shard is
    dealt as several pieces (about ``piece_bytes`` each, at most ``most_pieces`` in all), so that no task sorts a
    whole shard. Null ids and texts hash like any value; repeated rows lie side by side, but a boundary may cut them; an
    empty table stays empty. Columns named shard or slot are replaced. The rows are stored once with their keys.
    """
    k, b, p, o = (free_name(docs, x) for x in ("__key", "__size", "__piece", "__first"))
    keyed = stored(docs.withColumns({k: key, b: size}), "shard-keys")
    table = keyed.select(F.col(k).alias("key"), F.col(b).alias("size"))
    total = table.agg(F.sum("size")).first()[0] or 0
    per_shard = int(min(max(1, -(-total // (shards * piece_bytes))), max(1, most_pieces // shards)))
    splitters = find_splitters(table, shards * per_shard, tolerance / per_shard)
    _, rows = _below(table, splitters) if len(splitters) else (None, np.zeros(0, np.int64))
    first = np.concatenate([[0], rows])  # rows before each piece
    offset = first - first[np.arange(len(first)) // per_shard * per_shard]

    @F.pandas_udf("long")
    def piece(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(splitters, keys.to_numpy(), side="right"))

    @F.pandas_udf("long")
    def before(pieces: pd.Series) -> pd.Series:
        return pd.Series(offset[pieces.to_numpy()])

    placed = keyed.withColumn(p, piece(k)).withColumn(o, before(p))
    order = Window.partitionBy(p).orderBy(k, b)
    return placed.withColumns({
        "shard": F.floor(F.col(p) / per_shard).cast("int"),
        "slot": (F.col(o) + F.row_number().over(order) - 1).cast("long")}).drop(k, b, p, o)


def shard_digest(docs: DataFrame, shards: int = 40) -> DataFrame:
    """One row per document: where it goes and what it weighs."""
    rows = docs.select("doc_id", row_size(F.col("text")).alias("size"),
                       F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
                       sort_key(F.col("text"), F.col("doc_id")).alias("order_key"))
    return shard(rows, F.col("order_key"), F.col("size"), shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Whole documents with their shard and slot."""
    return shard(docs, sort_key(F.col("text"), F.col("doc_id")), row_size(F.col("text")), shards)
