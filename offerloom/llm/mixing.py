"""Mixing sources to target weights with exact block quotas.

Each source is cut into blocks of words that lie in a pseudo-random order. A source's target is met by whole passes
over its blocks plus a prefix of that order, cut to the word. Which output shard a drawn block goes to follows from a
splitting tree: the quotas of all sources are split between the left and the right half of the shards by a
multivariate hypergeometric draw, and so on down, so that shards have equal block counts and every block is drawn
exactly as often as its quota says. Blocks are then shuffled inside their shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.llm.common import stored, word_count

WEIGHTS = (3, 1, 2)
BUCKET_BLOCKS = 4096
MOST_SOURCES = 200_000
MOST_CELLS = 20_000_000
LARGEST_DRAW = 500_000_000
#: Equal rows that one task numbers at once.
COPIES = 4096
SHUFFLE_SEED = 11


def targets(sizes: list[int], weights: list[float], share: float = 1.5, most: float = 2.0) -> list[float]:
    """Words per source: ``share`` of all words by weight, none above ``most`` times its size, the excess
    reshared by weight until none is above."""
    out, left, open_ = [0.0] * len(sizes), share * sum(sizes), [i for i, s in enumerate(sizes) if s > 0]
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        for i in full or open_:
            out[i] = float(most * sizes[i]) if full else left * weights[i] / weight
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)] if full else []
    return [round(x, 4) for x in out]


def split_quotas(quotas: np.ndarray, shards: int, seed: int = 7) -> np.ndarray:
    """Blocks of every source in every shard (sources x shards) by recursive hypergeometric draws.

    Draws above what the generator takes are made in units of several blocks; the remainder of a unit stays left.
    """
    rng, out = np.random.default_rng(seed), np.zeros((len(quotas), shards), np.int64)

    def descend(counts: np.ndarray, low: int, high: int) -> None:
        if high - low == 1:
            out[:, low] = counts
            return
        middle, total = (low + high) // 2, int(counts.sum())
        want = total * (middle - low) // (high - low)
        unit = -(-total // LARGEST_DRAW) or 1
        left = rng.multivariate_hypergeometric(counts // unit, min(want // unit, int((counts // unit).sum())), method="marginals") * unit
        descend(left, low, middle)
        descend(counts - left, middle, high)

    descend(np.asarray(quotas, np.int64), 0, shards)
    return out


def _draw(blocks: DataFrame, ties: list[str], shards: int, cut_last: bool = True, share: float = 1.5,
          weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Adds to every block: source_size, target, and draws, an array of (pass, words, shard).

    Blocks have source, words and u, a pseudo-random long below 2^60 that orders them (then ``ties``); the other columns are
    the caller's. A block without words is never drawn. Sources lie by code point, null last, and take the weights in turn. With ``cut_last`` the block at the
    target is cut to the word; else it is drawn whole if more than half of it fits. The number of sources is bounded by
    MOST_SOURCES (the mixture is a setting, not data).
    """
    named = blocks.withColumn("src", F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source"))))
    spark = blocks.sparkSession
    sums = named.groupBy("src").agg(F.sum("words").cast("long").alias("words"), F.count_if(F.col("words") > 0).alias("n")) \
        .orderBy("src").limit(MOST_SOURCES + 1).collect()
    if len(sums) > MOST_SOURCES or len(sums) * shards > MOST_CELLS:
        raise ValueError(f"a mixture of more than {MOST_SOURCES} sources needs coarser sources")
    goal = targets([r["words"] or 0 for r in sums], [weights[i % len(weights)] for i in range(len(sums))], share)
    plan = []
    for r, t in zip(sums, goal):
        size = r["words"] or 0
        passes = int(t // size) if size else 0
        bits = max(0, int(np.ceil(np.log2(max(1, r["n"] / BUCKET_BLOCKS)))))
        plan.append((r["src"], size, r["n"], float(t), passes, int(t + 1e-6) - passes * size, bits))
    plans = spark.createDataFrame(plan, "src string, source_size long, n_blocks long, target double, passes int, rest long, bits int")

    planned = named.join(F.broadcast(plans), "src")
    dealt = planned.where("words > 0").withColumn("bucket", F.expr("shiftright(u, 60 - bits)"))
    heads = dealt.groupBy("src", "bucket").agg(F.sum("words").alias("w"), F.count(F.lit(1)).alias("c"))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = stored(heads.select("src", "bucket", F.coalesce(F.sum("w").over(before), F.lit(0)).alias("words_before"),
                                F.coalesce(F.sum("c").over(before), F.lit(0)).alias("blocks_before")), "mix-buckets")
    inside = Window.partitionBy("src", "bucket").orderBy("u", *ties)
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    ranked = dealt.join(heads, ["src", "bucket"]).withColumns({
        "begin": F.col("words_before") + F.coalesce(F.sum("words").over(upto), F.lit(0)),
        "at": F.col("blocks_before") + F.row_number().over(inside) - 1})
    room = F.col("rest") - F.col("begin")
    part = F.greatest(F.lit(0), F.least(F.col("words"), room)) if cut_last else \
        F.when(F.col("words") <= 2 * room, F.col("words")).otherwise(0)
    ranked = ranked.withColumn("part", part.cast("long"))

    # The number of draws of every source, exact, then the tree.
    used = {r["src"]: r["n"] for r in _part_counts(heads, plans, dealt, ties, cut_last).collect()}
    quotas = np.array([p[2] * p[4] + used.get(p[0], 0) for p in plan], np.int64)
    cuts = np.cumsum(split_quotas(quotas, shards), axis=1) if len(plan) else np.zeros((0, shards), np.int64)
    bounds = spark.createDataFrame([(p[0], [int(x) for x in c]) for p, c in zip(plan, cuts)], "src string, cuts array<long>")

    # Whole passes draw every block; the partial one draws the first `used` in the order.
    kind = "array<struct<pass:int,words:bigint,shard:int>>"

    def drawn(k: Column, words: str) -> Column:
        number = k * F.col("n_blocks") + F.col("at")
        return F.struct(k.cast("int").alias("pass"), F.col(words).cast("long").alias("words"),
                        F.size(F.filter("cuts", lambda c: c <= number)).cast("int").alias("shard"))

    whole = F.when(F.col("passes") > 0, F.transform(F.sequence(F.lit(0), F.col("passes") - 1), lambda k: drawn(k, "words")))
    last = F.when(F.col("part") > 0, F.array(drawn(F.col("passes"), "part")))
    none = F.array().cast(kind)
    draws = F.concat(F.coalesce(whole.cast(kind), none), F.coalesce(last.cast(kind), none))
    full = ranked.join(F.broadcast(bounds), "src").select(*blocks.columns, "source_size", "target", draws.alias("draws"))
    return full.unionByName(planned.where("words = 0").select(*blocks.columns, "source_size", "target", none.alias("draws")))


def _part_counts(heads: DataFrame, plans: DataFrame, dealt: DataFrame, ties: list[str], cut_last: bool) -> DataFrame:
    """How many positions of each source's order the partial pass reaches: whole buckets before the target by
    their counts, and the one bucket in which the target lies row by row."""
    last = Window.partitionBy("src").orderBy(F.desc("words_before"), F.desc("bucket"))
    edge = heads.join(F.broadcast(plans.select("src", F.col("rest").alias("all_rest"))), "src").where("all_rest > words_before") \
        .withColumn("k", F.row_number().over(last)).where("k = 1").select("src", "bucket", "words_before", "blocks_before")
    inside = Window.partitionBy("src").orderBy("u", *ties).rowsBetween(Window.unboundedPreceding, -1)
    rows = dealt.join(F.broadcast(edge), ["src", "bucket"]).withColumn(
        "room", F.col("rest") - F.col("words_before") - F.coalesce(F.sum("words").over(inside), F.lit(0)))
    reach = (F.col("room") > 0) if cut_last else (F.col("words") <= 2 * F.col("room"))
    number = F.row_number().over(Window.partitionBy("src").orderBy("u", *ties))
    return rows.withColumn("i", number).where(reach).groupBy("src").agg((F.max("blocks_before") + F.max("i")).alias("n"))


def order_of(*parts: Column) -> Column:
    """A pseudo-random long below 2^60 from the first 15 hex digits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def _copies(groups: DataFrame, key: list[str]) -> DataFrame:
    """Each group of equal rows, counted in m, as m rows numbered by copy; a large group is dealt over many tasks."""
    chunk = groups.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("m") - 1) / COPIES).cast("int"))))
    first = F.col("chunk").cast("long") * COPIES
    return chunk.repartition(*key, "chunk").withColumn(
        "copy", F.explode(F.sequence(first, F.least(first + COPIES, F.col("m")) - 1))).drop("chunk", "m")


def mix_blocks(docs: DataFrame, block_words: int = 512, shards: int = 32) -> DataFrame:
    """Every block of every document with its draws: doc_id, source, key (MD5 of the text), copy, size, block, words,
    source_size, target and draws (pass, words, shard).

    The order hashes id, text and the number among equal rows, so it does not depend on where a row lies: rows that share id,
    source and text are interchangeable and are counted first, then numbered.
    """
    key = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    groups = docs.select("doc_id", "source", key.alias("key"), word_count(F.col("text")).alias("size")) \
        .groupBy("doc_id", "source", "key", "size").agg(F.count(F.lit(1)).alias("m"))
    count = F.greatest(F.lit(1), F.ceil(F.col("size") / block_words)).cast("int")
    blocks = _copies(groups, ["doc_id", "source", "key"]).withColumn("block", F.explode(F.sequence(F.lit(0), count - 1))).withColumns({
        "words": F.least(F.lit(block_words), F.col("size") - F.col("block") * block_words).cast("long"),
        "u": order_of(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("key"), F.col("copy").cast("string"), F.col("block").cast("string"))})
    return _draw(stored(blocks, "mix-blocks"), ["doc_id", "key", "copy", "block"], shards).drop("u")


def mix_digest(docs: DataFrame, block_words: int = 512, shards: int = 32) -> DataFrame:
    """Words that the mix takes of every document, repeats counted, and drawn, the number of its block draws.

    Both are sums over what the shards of the splitting tree draw. A null text or a text without words has size 0 and
    takes nothing; a null source is a source of its own; repeated rows count each by itself; an empty table gives no rows.
    """
    inside = F.filter("draws", lambda d: d["shard"].between(0, shards - 1))
    taken = F.aggregate(inside, F.lit(0).cast("long"), lambda a, d: a + d["words"])
    rows = mix_blocks(docs, block_words, shards).groupBy("doc_id", "source", "key", "copy", "size", "source_size", "target")
    return rows.agg(F.sum(taken).alias("taken"), F.sum(F.size(inside).cast("long")).alias("drawn")).drop("source", "key", "copy")


def _row_key(docs: DataFrame) -> list[Column]:
    """Two hashes of all columns of a row, nulls told from each other; rows that share both count as equal."""
    maps = {f.name for f in docs.schema.fields if "map<" in f.dataType.simpleString() or f.dataType.simpleString() == "variant"}
    own = [F.col(f"`{c}`") for c in docs.columns]
    parts = [*(F.to_json(F.struct(c)) if n in maps else c for n, c in zip(docs.columns, own)), *(c.isNull() for c in own)]
    return [F.xxhash64(F.lit(k), *parts).alias(f"h{k}") for k in (1, 2)]


def mixed_copies(docs: DataFrame, shards: int = 32) -> DataFrame:
    """The mix as rows of whole documents: row (a struct of the input's columns), shard, pass, and chance (a hash that
    shuffles a shard). Rows are ranked as hashes; equal rows are counted before, and the texts travel once.

    Documents without words are no material for a word mixture: they are kept once, in shard 0. Nulls are values like
    others, rows that repeat are drawn each; an empty table stays empty; columns may have any names.
    """
    keyed = docs.select(*_row_key(docs), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("words"),
                        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    groups = keyed.groupBy("h1", "h2", "source", "words").agg(F.count(F.lit(1)).alias("m"))
    single = _copies(groups, ["h1", "h2"]).withColumn("u", order_of(*(F.col(c).cast("string") for c in ("h1", "h2", "copy"))))
    drawn = _draw(stored(single, "mix-rows"), ["h1", "h2", "copy"], shards, cut_last=False)
    none = F.array(F.struct(F.lit(0).alias("pass"), F.lit(0).cast("long").alias("words"), F.lit(0).alias("shard")))
    each = drawn.select("h1", "h2", "copy", F.explode(F.when(F.col("words") == 0, none).otherwise(F.col("draws"))).alias("draw"))
    texts = keyed.groupBy("h1", "h2").agg(F.first("row").alias("row"))
    return texts.join(each, ["h1", "h2"]).select("row", F.col("draw.shard").alias("shard"), F.col("draw.pass").alias("pass"),
                                                 F.xxhash64(F.lit(SHUFFLE_SEED), "h1", "h2", "copy", "draw.pass").alias("chance"))


def shuffled(copies: DataFrame, parts: int = 64) -> DataFrame:
    """Deals every shard over ``parts`` tasks and shuffles it inside each."""
    return copies.repartition("shard", F.pmod("chance", F.lit(parts))).sortWithinPartitions("shard", "chance")


def mix_documents(docs: DataFrame, shards: int = 32) -> DataFrame:
    """The mix with the columns of the input, in the order of the shards."""
    return shuffled(mixed_copies(docs, shards)).select("row.*")


def write_mix(docs: DataFrame, path: str, shards: int = 32, parts: int = 64) -> None:
    """Writes one folder ``shard=k`` per output shard, shuffled inside each file; a row is in the struct ``row``."""
    shuffled(mixed_copies(docs, shards), parts).select("row", "shard").write.partitionBy("shard").parquet(path)
