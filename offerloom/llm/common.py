"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.session import scratch_path

#: What separates words: space and the control characters 9 to 13.
GAPS = " \t\n\x0b\x0c\r"
#: Texts that pass between a task and its Python worker at a time, at most; either side holds such a batch as a whole.
BATCH = 512
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def trimmed(text: Column) -> Column:
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(GAPS))


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    body = trimmed(text)
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, f"[{GAPS}]+"))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def held_out(doc_id: Column) -> Column:
    """Rows that no classifier may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the table does not use yet (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back, which cuts the lineage for good."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """What is executed inside passes at most BATCH rows at a time to Python; a smaller setting of the session stays."""
    before = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, str(min(int(before), BATCH) if int(before) > 0 else BATCH))
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, before)


def broadcast_within(df: DataFrame, rows: int) -> DataFrame:
    """Marks a table for broadcasting once its row count is known to be within the bound.

    Beyond the bound the table is returned as it is and the join shuffles instead.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, balanced: bool = False) -> DataFrame:
    """At most ``rows`` labelled documents outside the held-out third: doc_id, text, label.

    The choice is by hash of the id, so it is the same on every run. With ``balanced`` each of the two
    classes gives at most half of the rows. The chosen ids are bounded by ``rows`` and may be broadcast; of rows that
    repeat an id one stands for all, the one with the least hash of its text.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    if balanced:
        parts = [known.where(F.col("label") == k).orderBy(*order).limit(rows // 2) for k in (0, 1)]
        chosen = parts[0].unionByName(parts[1])
    else:
        chosen = known.orderBy(*order).limit(rows)
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = found.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    return one.select("doc_id", F.col("least.text").alias("text"), "label")


def components(links: DataFrame, label: str = "links", rounds: int = 60) -> DataFrame:
    """Connected components of links (a, b) of longs: one row (node, root), root the smallest node.

    Alternates the large-star and small-star steps, whose edge count never grows; every round is written
    to the shared folder. A hub's edges are split by Spark's skew join, minima combine before the shuffle.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    if edges.limit(1).count() == 0:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large.unionByName(edges.join(low.where("m = a").select("a"), "a", "left_semi")).distinct(), label)
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        own = low.select("a", F.col("m").alias("b"))
        rest = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = stored(own.unionByName(rest).distinct(), label)
        changed = small.join(edges, ["a", "b"], "left_anti").limit(1).count() + edges.join(small, ["a", "b"], "left_anti").limit(1).count()
        edges = small
        if not changed:
            break
    else:
        raise RuntimeError(f"components did not settle within {rounds} rounds")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())
