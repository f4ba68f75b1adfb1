"""Finds benchmark passages in documents, with DataFrame functions only.

A window of a document is as long as the benchmark item it is held against. Windows without a shingle of the item
have similarity zero, and moving a window right to its first shared shingle loses none of the others; so only windows
that begin at a shared shingle (or end with the document) can be the best ones, and these get a SimHash. Fingerprints
are cut into one block more than the Hamming radius: two within the radius agree in one block at least, which an
equality join on (length, block number, block) finds. Pairs within the radius are verified by the exact weighted
Jaccard similarity of their shingles.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import broadcast_within, free_name

SHINGLE = 5
SIMILARITY = 0.8
#: At similarity 0.8 two fingerprints differ in about 10 of 64 bits; 23 is more than four deviations above.
RADIUS = 23
CHUNK_ROWS = 1_000_000
WORD_GAP = r"[^\p{L}\p{M}\p{N}]+"


def _words(text: Column) -> Column:
    """Lower-case runs of letters and digits; a null text has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_GAP), "")


def _shingle_at(words: Column, at: Column, k: int) -> Column:
    return F.xxhash64(F.lit(k), *[F.get(words, at + i) for i in range(k)])


def _shingles(words: Column, k: int) -> Column:
    """Hashes of all shingles of k words, in order."""
    return F.transform(F.sequence(F.lit(0), F.size(words) - k), lambda i: _shingle_at(words, i.cast("int"), k))


def _simhash(hashes: Column, planes: int) -> Column:
    """Bits set in more than half of the hashes: bit-plane counters are added up, then compared with half the size."""
    def add(acc: Column, x: Column) -> Column:
        carry, out = x, []
        for i in range(planes):
            out.append(acc[i].bitwiseXOR(carry))
            carry = carry.bitwiseAND(acc[i])
        return F.array(*out)

    counts = F.aggregate(hashes, F.array(*[F.lit(0).cast("long")] * planes), add)

    def above(c: Column) -> Column:
        half = F.floor(F.size(hashes) / 2)
        more, equal = F.lit(0).cast("long"), F.lit(-1).cast("long")
        for i in reversed(range(planes)):
            bit = -F.shiftright(half, i).bitwiseAND(F.lit(1).cast("long"))
            more = more.bitwiseOR(equal.bitwiseAND(c[i]).bitwiseAND(F.bitwise_not(bit)))
            equal = equal.bitwiseAND(F.bitwise_not(c[i].bitwiseXOR(bit)))
        return more

    # not nullable: a null check that Spark derives from the join would be computed a second time below it
    return F.coalesce(F.transform(F.array(counts), above)[0], F.lit(0).cast("long"))


def _bag(hashes: Column) -> Column:
    """A multiset as a set: every hash is joined with the number of its occurrence."""
    return F.transform(F.array(F.array_sort(hashes)), lambda s: F.transform(
        s, lambda x, i: F.xxhash64(x, i.cast("long") - F.array_position(s, x))))[0]


def _blocks(fp: Column, radius: int) -> Column:
    """radius + 1 disjoint blocks of the 64 bits, numbered."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << high - low) - 1)).alias("bits"))
                     for i, (low, high) in enumerate(zip(cuts, cuts[1:]))])


def _items(benchmark: DataFrame, planes: int, radius: int) -> DataFrame:
    base = benchmark.select("item_id", _words(F.col("text")).alias("words")).where("item_id IS NOT NULL AND size(words) > 0")
    parts = [base.where(F.least(F.size("words"), F.lit(SHINGLE)) == k).withColumn("hashes", _shingles(F.col("words"), k)).withColumn("k", F.lit(k))
             for k in range(1, SHINGLE + 1)]
    all_ = reduce(DataFrame.unionByName, parts)
    return all_.select("item_id", "k", F.size("words").alias("length"), "hashes", _simhash(F.col("hashes"), planes).alias("fp"), _bag(F.col("hashes")).alias("bag"))


def contaminations(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS,
                   chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per (doc_id, item_id) with a window of at least this weighted-shingle similarity: the best
    similarity and the first word of the first such window.

    Shingles have five words; an item with fewer words is one shingle. A document shorter than an item is one window.
    Null texts and texts without words match nothing; null ids of documents are reported under null, items without an
    id are left out; repeated rows and repeated items count once. The benchmark is held against the documents in
    chunks of at most ``chunk_rows`` shingles, so what is broadcast is bounded; each chunk reads the documents once.
    Other columns are not read.
    """
    longest = benchmark.select(F.max(F.size(_words(F.col("text")))).alias("n"), F.count(F.lit(1)).alias("items"),
                               F.sum(F.size(_words(F.col("text")))).alias("words")).first()
    planes = max(1, int(longest["n"] or 1).bit_length())
    items = _items(benchmark, planes, radius)
    anchors = items.select("k", "length", F.explode("hashes").alias("h")).groupBy("h", "k").agg(F.collect_set("length").alias("lengths"))
    chunks = max(1, -(-int(longest["words"] or 0) // chunk_rows))
    ks = [r["k"] for r in items.select("k").distinct().collect()] or [SHINGLE]  # at most SHINGLE values
    targets = broadcast_within(items.select("item_id", F.col("length").alias("item_length"), F.col("fp").alias("item_fp"), F.col("bag").alias("item_bag"),
                               F.explode(_blocks(F.col("fp"), radius)).alias("b")).select(
        "item_id", "item_length", "item_fp", "item_bag", "b.block", "b.bits"), chunk_rows)
    tokens = docs.select("doc_id", _words(F.col("text")).alias("words"))
    found = []
    for chunk in range(chunks):
        some = F.broadcast(anchors.where(F.pmod("h", F.lit(chunks)) == chunk))
        for k in ks:
            at = F.when(F.size("words") >= k, F.sequence(F.lit(0), F.size("words") - k))
            places = tokens.select("doc_id", "words", F.explode_outer(at).alias("at")).where("at IS NOT NULL") \
                .withColumn("h", _shingle_at(F.col("words"), F.col("at"), k))
            start = F.greatest(F.lit(0), F.least("at", F.size("words") - F.col("length")))
            hits = places.join(some.where(F.col("k") == k).drop("k"), "h").select("doc_id", "words", "at", F.explode("lengths").alias("length"))
            window = F.slice("words", start + 1, F.col("length"))
            found.append(hits.select("doc_id", "length", start.alias("start"), window.alias("window"))
                         .select("doc_id", "length", "start", _shingles(F.col("window"), k).alias("hashes")))
    windows = reduce(DataFrame.unionByName, found).withColumn("fp", _simhash(F.col("hashes"), planes))
    met = windows.withColumn("b", F.explode(_blocks(F.col("fp"), radius))).join(
        targets, (F.col("length") == F.col("item_length")) & (F.col("b.block") == targets["block"]) & (F.col("b.bits") == targets["bits"]))
    near = met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius) \
        .where(_first_equal_block(F.col("fp").bitwiseXOR(F.col("item_fp")), radius) == F.col("b.block"))
    shared = F.size(F.array_intersect(_bag(F.col("hashes")), F.col("item_bag")))
    either = F.size("hashes") + F.size("item_bag") - F.col("shared")
    exact = near.withColumn("shared", shared).withColumn("similarity", F.col("shared") / either).where(F.col("similarity") >= similarity)
    best = exact.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"), F.min("start").alias("first_word"))
    return best.select("doc_id", "item_id", "similarity", "first_word")


def _first_equal_block(apart: Column, radius: int) -> Column:
    """Number of the first block in which two fingerprints agree, so that a pair is verified once."""
    cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
    out = F.lit(None).cast("int")
    for i in reversed(range(radius + 1)):
        mask = ((1 << cuts[i + 1] - cuts[i]) - 1) << cuts[i]
        mask = mask - (1 << 64) if mask >= 1 << 63 else mask
        out = F.when(apart.bitwiseAND(F.lit(mask)) == 0, F.lit(i)).otherwise(out)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a benchmark passage.

    Rows and items are known by the SHA-256 of their text: every row is judged by its own text, whatever its id, and
    items without an id count like the others.
    """
    def key() -> Column:
        return F.unhex(F.sha2(F.col("text").cast("binary"), 256))

    items = benchmark.where("text IS NOT NULL").select(key().alias("item_id"), "text").distinct()
    hit, own = free_name(docs, "__hit"), free_name(docs, "__text_key")
    hits = contaminations(docs.select(key().alias("doc_id"), "text"), items).select(F.col("doc_id").alias(hit)).distinct()
    return docs.withColumn(own, key()).join(hits, F.col(own) == F.col(hit), "left_anti").drop(own)
