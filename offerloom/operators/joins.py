"""Star, bridge and lookup joins.

No broadcast hints: Spark broadcasts a side only when its measured size is below
the session threshold and sort-merges (with skew splitting) otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_LITERAL_ROWS = 10_000


def star_join(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Fact rows with every dimension attached (a missing key keeps the row)."""
    for dim, key in dimensions:
        fact = fact.join(dim, key, "left")
    return fact


def bridge_join(offers: DataFrame, bridge: DataFrame, skills: DataFrame, how: str = "inner") -> DataFrame:
    """One row per offer and skill; ``how='left'`` keeps offers without skills."""
    links = bridge.join(skills, "skill_key", "left" if how == "left" else "inner")
    return offers.join(links, "offer_key", how)


def key_lookup(df: DataFrame, dim: DataFrame, value: str, dim_value: str, key: str) -> DataFrame:
    """Adds the surrogate key of a value; NULL or unknown values get NULL."""
    lookup = dim.select(F.col(dim_value).alias(value), key)
    return df.join(lookup, value, "left")


def split_existing(new: DataFrame, existing: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose key is new, rows whose key exists already)."""
    keys = existing.select(key)
    return new.join(keys, key, "left_anti"), new.join(keys, key, "left_semi")


def restrict_to(df: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    return df.join(groups.select(key), key, "left_semi")


def first_containing(text: Column, entries: Sequence[tuple[str, str]]) -> Column:
    """Label of the first list entry that contains the text or is contained in it.

    The list is a driver-side parameter of checked size; it ships as a literal, so
    the match is a projection and not a nested-loop join.
    """
    if len(entries) > MAX_LITERAL_ROWS:
        raise ValueError(f"{len(entries)} entries are too many for a literal list")
    rows = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(label).alias("label")) for t, label in entries])
    hits = F.filter(rows, lambda r: F.contains(text, r.t) | F.contains(r.t, text))
    return F.when(text != "", F.get(hits, F.lit(0)).label)


def name_map(df: DataFrame, names: DataFrame, key: str, name: str, fallback: Column) -> DataFrame:
    return df.join(names.select(key, name), key, "left").withColumn(name, F.coalesce(F.col(name), fallback))


def align(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Columns of two results side by side, matched by document id and never by position."""
    return left.join(right, key)
