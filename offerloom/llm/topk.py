"""Exact top-k by inner product from an impact-ordered index, read score at a time.

Vectors of integers are cut into blocks; in each block a dimension's values are quantised to a few levels, and every
(dimension, level) has a posting segment. For a query the impact of a segment is the query's component times the level;
segments are processed by descending quantised impact, many queries at once. What is not yet processed, and what
quantising lost, bounds every vector's score from above; a query stops once the vectors that the bound does not exclude
are few (or all segments are done), and these possible members are scored exactly. Equal vectors are one class that
keeps its k + 1 smallest ids, which is all that a top-k with ties by id can use.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.llm.common import stored

SCALE = 64
#: Components are held within this bound, so that a score of 64 dimensions fits a long.
MOST = 1 << 28
#: Vectors of a block, blocks that one task reads for a block of queries, and queries of such a block.
BLOCK, BLOCKS_PER_TASK, QUERIES = 8192, 2, 2048
LEVELS = 8
#: Quantised impact runs from 0 to IMPACTS - 1; the bands in which it is processed.
IMPACTS, BANDS = 64, (2, 0)
#: A query stops when so many possible members of a block are left.
FEW = 256
SIDE_BY_SIDE = 256
NO_ID = np.iinfo(np.int64).max
NO_SCORE = -NO_ID
INDEX = "block long, dim int, level long, members binary"
FORWARD, CLASSES, FIRST_IDS = -1, -2, -3


def whole(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null for vectors that are null or hold a null or non-finite one."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = F.transform(vector, lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(float(-MOST))), F.lit(float(MOST)))).cast("long"))
    return F.when(vector.isNotNull() & ~bad, kept)


def _matrix(lists: pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    rows = [np.asarray(x, np.int64) for x in lists.to_pylist()]
    out = np.zeros((len(rows), width or max(map(len, rows), default=0)), np.int64)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def index_block(vectors: pa.Table) -> pa.Table:
    """Posting segments of a block, by dimension and level, and its vectors for exact scores."""
    values, block = _matrix(vectors["v"]), vectors["block"][0].as_py()
    rows = []
    for dim in range(values.shape[1]):
        column = values[:, dim]
        cuts = np.unique(np.quantile(column, np.arange(1, LEVELS) / LEVELS, method="lower"))
        level = np.searchsorted(cuts, column, side="left")
        for x in np.unique(level):
            members = np.flatnonzero(level == x).astype(np.int32)
            rows.append((dim, int(np.rint(column[members].mean())), members.tobytes()))
    small = np.abs(values).max(initial=0) < 1 << 15
    rows.append((FORWARD, values.shape[1], values.astype(np.int16 if small else np.int64).tobytes()))
    rows.append((CLASSES, len(values), vectors["c"].to_numpy().tobytes()))
    rows.append((FIRST_IDS, len(values), vectors["first_id"].to_numpy().tobytes()))
    return pa.table({"block": pa.array([block] * len(rows), pa.int64()), "dim": pa.array([r[0] for r in rows], pa.int32()),
                     "level": pa.array([r[1] for r in rows], pa.int64()), "members": pa.array([r[2] for r in rows], pa.binary())})


class Block:
    def __init__(self, dims: np.ndarray, levels: np.ndarray, members: list[bytes]):
        own = {d: (n, m) for d, n, m in zip(dims, levels, members) if d < 0}
        self.classes, self.first_ids = (np.frombuffer(own[k][1], np.int64) for k in (CLASSES, FIRST_IDS))
        size, width, data = len(self.classes), own[FORWARD][0], own[FORWARD][1]
        self.values = np.frombuffer(data, np.int16 if len(data) == 2 * size * width else np.int64).reshape(size, width)
        self.dims, self.levels = dims[dims >= 0], levels[dims >= 0]
        self.postings = [np.frombuffer(m, np.int32) for d, m in zip(dims, members) if d >= 0]

    def width(self) -> int:
        return self.values.shape[1]


class Search:
    """Runs a block of queries against one index block after another and keeps the best ``k`` classes of each query."""

    def __init__(self, queries: np.ndarray, k: int):
        self.queries, self.k = queries, k
        n = len(queries)
        self.score = np.full((n, k), NO_SCORE)
        self.first = np.full((n, k), NO_ID)
        self.best = np.full((n, k), -1)
        self.processed = self.rescored = 0

    def exact(self, values: np.ndarray, q: np.ndarray, c: np.ndarray, kind: type) -> np.ndarray:
        out = np.empty(len(q), np.int64)
        for i in range(0, len(q), 1 << 17):
            part = slice(i, i + (1 << 17))
            out[part] = np.einsum("ij,ij->i", self.queries[q[part]].astype(kind), values[c[part]].astype(kind))
        return out

    def merge(self, block: Block, q: np.ndarray, c: np.ndarray, score: np.ndarray) -> None:
        """Takes exactly scored (query, class) pairs into the lists, ordered by score and smallest id."""
        near = score >= self.score[q, -1]
        q, c, score = q[near], c[near], score[near]
        used = np.unique(q)
        rows = np.concatenate([np.repeat(used, self.k), q])
        scores = np.concatenate([self.score[used].ravel(), score])
        first = np.concatenate([self.first[used].ravel(), block.first_ids[c]])
        best = np.concatenate([self.best[used].ravel(), block.classes[c]])
        order = np.lexsort((best, first, -scores, rows))
        rows = rows[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left")
        order, rows, rank = order[rank < self.k], rows[rank < self.k], rank[rank < self.k]
        self.score[rows, rank], self.first[rows, rank], self.best[rows, rank] = scores[order], first[order], best[order]

    def run(self, block: Block) -> None:
        width = max(self.queries.shape[1], block.width())
        if self.queries.shape[1] < width:
            self.queries = np.pad(self.queries, ((0, 0), (0, width - self.queries.shape[1])))
        values = np.pad(block.values, ((0, 0), (0, width - block.width())))
        largest = float(np.abs(self.queries).max(initial=0)) * float(np.abs(values.astype(np.int64)).max(initial=0)) * max(1, width)
        kind = np.float32 if largest < 1 << 23 else np.float64
        exact_kind = kind if largest < 1 << 52 else np.int64
        incidence = np.zeros((len(block.postings), len(values)), kind)
        level = np.zeros((len(values), width), np.int64)
        for s, (d, x, members) in enumerate(zip(block.dims, block.levels, block.postings)):
            incidence[s, members] = 1
            level[members, d] = x
        lost = np.sqrt(((values - level).astype(np.float64) ** 2).sum(1))
        for low in range(0, len(self.queries), SIDE_BY_SIDE):
            self.side_by_side(block, values, incidence, lost, np.arange(low, min(low + SIDE_BY_SIDE, len(self.queries))), kind, exact_kind, largest)

    def side_by_side(self, block, values, incidence, lost, live, kind, exact_kind, largest) -> None:
        impact = self.queries[live][:, block.dims] * block.levels
        most = np.abs(impact).max(1, initial=0, keepdims=True)
        quantised = np.abs(impact) * (IMPACTS - 1) // np.maximum(most, 1)
        reach = np.sqrt((self.queries[live].astype(np.float64) ** 2).sum(1))
        slack = largest * 2.0 ** -48 if kind is np.float64 else 0.0
        total = np.zeros((len(live), len(values)), kind)
        begin = np.flatnonzero(np.concatenate([[True], block.dims[1:] != block.dims[:-1]])) if len(block.dims) else None
        above, seeded = IMPACTS, False
        for band in BANDS:
            now = (quantised >= band) & (quantised < above)
            above = band
            self.processed += int(now.sum())
            total += np.where(now, impact, 0).astype(kind) @ incidence
            rest = np.zeros(len(live))
            if band and begin is not None:
                open_ = quantised < band
                most_open = np.maximum.reduceat(np.where(open_, impact, np.iinfo(np.int64).min), begin, axis=1)
                all_open = np.logical_and.reduceat(open_, begin, axis=1)
                rest = np.where(all_open, most_open, np.maximum(most_open, 0)).sum(1, dtype=np.float64)
            if not seeded:  # exact scores of what looks best so far give a floor that the k-th best score cannot fall below
                few = min(self.k, len(values))
                at = np.argpartition(total, len(values) - few, axis=1)[:, len(values) - few:]
                q, c = np.repeat(live, few), at.ravel()
                scores = self.exact(values, q, c, exact_kind).reshape(len(live), few)
                own = scores.min(1) if few == self.k else np.full(len(live), NO_SCORE)
                seeded = True
            floor = np.maximum(own, self.score[live, -1])
            needed = floor - rest - slack - 1e-6
            possible = total + (reach[:, None] * lost).astype(kind) * kind(1.00001) >= needed[:, None].astype(np.float64)
            count = possible.sum(1)
            done = (count <= FEW) | (band == 0)
            q, c = np.nonzero(possible & done[:, None])
            self.rescored += len(q)
            scores = self.exact(values, live[q], c, exact_kind)
            near = scores >= floor[q]
            self.merge(block, live[q][near], c[near], scores[near])
            if done.all():
                return
            keep = ~done
            live, impact, quantised, reach, total, own = (x[keep] for x in (live, impact, quantised, reach, total, own))


def _searched(queries: pa.Table, index: pa.Table, k: int) -> pa.Table:
    if queries.num_rows and index.num_rows:
        search = Search(_matrix(queries["v"]), k)
        block, dim, level = (index[c].to_numpy() for c in ("block", "dim", "level"))
        members = index["members"].to_pylist()
        for b in np.unique(block):
            at = np.flatnonzero(block == b)
            at = at[np.argsort(dim[at], kind="stable")]
            search.run(Block(dim[at], level[at], [members[i] for i in at]))
        row, rank = np.nonzero(search.best >= 0)
        found = (queries["c"].to_numpy()[row], search.best[row, rank], search.score[row, rank])
    else:
        found = (np.zeros(0, np.int64),) * 3
    return pa.table({n: pa.array(x, pa.int64()) for n, x in zip(("q", "c", "score"), found)})


def classes_of(vectors: DataFrame, ids: int) -> DataFrame:
    """Equal vectors as one row: c (its number), v, ids (the ``ids`` smallest, ascending, nulls last)."""
    at = Window.partitionBy("v").orderBy(F.col("vec_id").asc_nulls_last())
    few = vectors.withColumn("at", F.row_number().over(at)).where(F.col("at") <= ids)
    grouped = few.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("at", "vec_id"))).alias("ids"))
    return stored(grouped.select("v", F.col("ids.vec_id").alias("ids")).withColumn("c", F.monotonically_increasing_id()), "vector-classes")


def build_index(classes: DataFrame, blocks: int) -> DataFrame:
    """The posting segments of all classes, in ``blocks`` blocks, written to the shared folder."""
    dealt = classes.select(F.pmod(F.xxhash64("c"), F.lit(blocks)).alias("block"), "c", "v",
                           F.coalesce(F.col("ids")[0], F.lit(int(NO_ID))).alias("first_id"))
    return stored(dealt.groupBy("block").applyInArrow(index_block, INDEX), "impact-index")


def best_classes(classes: DataFrame, queries: DataFrame, k: int, block: int = BLOCK, query_block: int = QUERIES) -> DataFrame:
    """For each query (c, v) the k best classes: q, c, score. Queries and index meet block by block."""
    blocks = max(1, -(-classes.count() // block))
    groups = max(1, -(-queries.count() // query_block))
    ranges = -(-blocks // BLOCKS_PER_TASK)
    index = build_index(classes, blocks).withColumn("range", F.floor(F.col("block") / BLOCKS_PER_TASK)).withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = queries.select("c", "v").withColumn("group", F.pmod(F.xxhash64("c"), F.lit(groups)).cast("int")).withColumn(
        "range", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ranges - 1).cast("long"))))

    def run(asked: pa.Table, index: pa.Table) -> pa.Table:
        return _searched(asked, index, k)

    found = asked.groupBy("group", "range").cogroup(index.groupBy("group", "range")).applyInArrow(run, "q long, c long, score long")
    first = classes.select("c", F.col("ids")[0].alias("first_id"))
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("first_id").asc_nulls_last())
    return found.join(first, "c").withColumn("at", F.row_number().over(best)).where(F.col("at") <= k).select("q", "c", "score")


def top_k(embeddings: DataFrame, k: int = 20, every: int = 20, scale: int = SCALE, block: int = BLOCK, query_block: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of every query by inner product of floor(scale * x).

    Queries are the rows whose vec_id is divisible by ``every``; candidates all rows but the query's own. Ties go to the
    smaller vec_id, null ids last. Vectors that are null or hold null or non-finite components take no part; shorter vectors
    count as ending in zeros, and components are held within 2**28. A row that repeats is a query and a candidate each
    time. Fewer candidates than k give fewer rows, an empty table none; other columns are not read.
    """
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), whole(F.col("embedding"), scale).alias("v")).where("v is not null")
    classes = classes_of(rows, k + 1)
    asking = rows.where(F.col("vec_id") % every == 0)
    queries = stored(classes.join(asking.select("v").distinct(), "v").select("c", "v"), "query-classes")
    best = best_classes(classes, queries, k + 1, block, query_block)
    single = best.join(classes.select("c", F.explode("ids").alias("vec_id")), "c")
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last(), "c")
    few = single.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    lists = few.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("at", "c", "vec_id", "score"))).alias("found"))
    known = queries.join(lists, F.col("q") == F.col("c")).select("v", "q", "found")
    answers = asking.select(F.col("vec_id").alias("query_id"), "v").join(known, "v")
    own = F.array_position(F.transform("found", lambda x: (x["c"] == F.col("q")) & x["vec_id"].eqNullSafe(F.col("query_id"))), True)
    others = F.slice(F.filter("found", lambda x: x["at"] != F.col("own")), 1, k)
    return answers.withColumn("own", own).select("query_id", F.posexplode(others).alias("at", "one")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("one.vec_id").alias("vec_id"), F.col("one.score").alias("score"))
