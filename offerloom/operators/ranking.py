"""Top-n, keep-first and mode per group.

Spark prunes ``row_number() <= n`` inside every map task before the shuffle, so a
hot group reaches its final task as n rows per map task, not as all its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
                  rank: str | None = None) -> DataFrame:
    window = W.partitionBy(*group).orderBy(*order)
    name = rank or "__rank"
    ranked = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)
    return ranked if rank else ranked.drop(name)


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in an explicit order."""
    return top_per_group(df, key, order, 1)


def dominant_value(df: DataFrame, group: str, value: str) -> DataFrame:
    """Most frequent value per group (ties: smallest), its count, the group size and the share."""
    counts = df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(group, value) \
        .agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(group).agg(
        F.min_by(value, F.struct((-F.col("n")).alias("n"), F.col(value).alias("v"))).alias(value),
        F.max("n").alias("n"), F.sum("n").alias("group_size")) \
        .withColumn("pct", F.round(100.0 * F.col("n") / F.col("group_size"), 6))


def top_groups(df: DataFrame, group: str, n: int) -> DataFrame:
    """The n most frequent group values."""
    return (df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), group).limit(n))


def representative(df: DataFrame, topic: str, probability: str, key: str, n: int) -> DataFrame:
    """The n rows of highest probability in each topic."""
    return top_per_group(df, [topic], [F.desc(probability), F.asc(key)], n)
