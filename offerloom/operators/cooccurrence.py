"""Co-occurrence of all terms; presence and correlation of the most frequent ones.

The vocabulary of presence and correlation has at most 62 terms, so a document's presence row is one 64-bit mask.
Equal masks are counted before pairs are formed: a document set with few distinct
term sets collapses, and a mask yields at most 62*61/2 pairs whatever the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_MASK_TERMS = 62


def frequent_terms(links: DataFrame, term: str, n: int = 50) -> DataFrame:
    """The n terms in most documents with a bit position (links: distinct document-term pairs).

    At most 62 rows reach the driver and come back as a literal table, so that the plans
    that use them do not count the links again.
    """
    if n > MAX_MASK_TERMS:
        raise ValueError(f"at most {MAX_MASK_TERMS} terms fit a presence mask")
    counts = links.groupBy(term).agg(F.count(F.lit(1)).alias("df"))
    best = counts.orderBy(F.desc("df"), F.asc(term)).limit(n).collect()
    kind = links.schema[term].dataType.simpleString()
    return links.sparkSession.createDataFrame([(r[term], r["df"], i) for i, r in enumerate(best)],
                                              f"{term} {kind}, df bigint, bit int")


def presence(links: DataFrame, doc: str, term: str, n: int = 50) -> DataFrame:
    """Long form of the binary matrix: (doc, term) for the n most frequent terms."""
    kept = F.broadcast(frequent_terms(links, term, n).select(term))
    return links.join(kept, term, "left_semi").select(doc, term)


def _mask_counts(links: DataFrame, doc: str, term: str, terms: DataFrame) -> DataFrame:
    bits = links.join(F.broadcast(terms.select(term, "bit")), term).select(doc, F.expr("shiftleft(1L, bit)").alias("b"))
    return bits.groupBy(doc).agg(F.bit_or("b").alias("mask")).groupBy("mask").agg(F.count(F.lit(1)).alias("docs"))


def pair_counts(links: DataFrame, doc: str, term: str) -> DataFrame:
    """(term_a, term_b, together) for every pair of terms that meet, a before b in name order.

    Equal term lists are counted before their pairs are formed; a list is as long as one document's terms.
    """
    lists = links.groupBy(doc).agg(F.array_sort(F.collect_set(term)).alias("terms")) \
        .groupBy("terms").agg(F.count(F.lit(1)).alias("docs"))
    heads = lists.select("docs", "terms", F.posexplode("terms").alias("at", "term_a"))
    pairs = heads.select("docs", "term_a", F.explode(F.slice("terms", F.col("at") + 2, F.size("terms"))).alias("term_b"))
    return pairs.groupBy("term_a", "term_b").agg(F.sum("docs").alias("together"))


def _pairs_of(links: DataFrame, doc: str, term: str, terms: DataFrame, n: int) -> DataFrame:
    masks = _mask_counts(links, doc, term, terms)
    bits = F.filter(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.getbit("mask", i) == 1)
    rows = masks.select("docs", bits.alias("bits")).select("docs", "bits", F.explode("bits").alias("a")) \
        .select("docs", "a", F.explode(F.filter("bits", lambda i: i > F.col("a"))).alias("b"))
    counts = rows.groupBy("a", "b").agg(F.sum("docs").alias("together"))
    left = terms.select(F.col("bit").alias("a"), F.col(term).alias("x"), F.col("df").alias("df_x"))
    right = terms.select(F.col("bit").alias("b"), F.col(term).alias("y"), F.col("df").alias("df_y"))
    named = counts.join(F.broadcast(left), "a").join(F.broadcast(right), "b")
    swap = F.col("x") > F.col("y")
    return named.select(
        F.when(swap, F.col("y")).otherwise(F.col("x")).alias("term_a"),
        F.when(swap, F.col("x")).otherwise(F.col("y")).alias("term_b"), "together",
        F.when(swap, F.col("df_y")).otherwise(F.col("df_x")).alias("df_a"),
        F.when(swap, F.col("df_x")).otherwise(F.col("df_y")).alias("df_b"))


def correlation(links: DataFrame, doc: str, term: str, docs_total: DataFrame, n: int = 50) -> DataFrame:
    """Pearson correlation of the presence columns for every unordered pair of kept terms.

    Terms that never meet still have a (negative) correlation; a constant column gives NULL.
    """
    terms = frequent_terms(links, term, n)
    listed = terms.agg(F.array_sort(F.collect_list(F.struct(F.col(term).alias("t"), "df")))).scalar()
    grid = links.sparkSession.range(1).select(listed.alias("l")).select("l", F.posexplode("l").alias("i", "x")) \
        .select("x", F.explode(F.slice("l", F.col("i") + 2, F.size("l"))).alias("y")) \
        .select(F.col("x.t").alias("term_a"), F.col("y.t").alias("term_b"),
                F.col("x.df").cast("double").alias("na"), F.col("y.df").cast("double").alias("nb"))
    met = _pairs_of(links, doc, term, terms, n).select("term_a", "term_b", "together")
    total = docs_total.agg(F.count(F.lit(1)).cast("double")).scalar()
    rows = grid.join(met, ["term_a", "term_b"], "left").withColumn("n", total)
    spread = F.sqrt(F.col("na") * (F.col("n") - F.col("na")) * F.col("nb") * (F.col("n") - F.col("nb")))
    return rows.select("term_a", "term_b", F.round(F.try_divide(
        F.col("n") * F.coalesce("together", F.lit(0)) - F.col("na") * F.col("nb"), spread), 6).alias("correlation"))
