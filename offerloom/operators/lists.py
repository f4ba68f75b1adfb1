"""Texts against lists of any size: the first entry that a text contains, or that contains the text.

List and texts are tables. Distinct texts and entries are dealt into shards of bounded size that meet cell by cell; a
cell builds one automaton from its entries and runs its texts through it, and one from its texts for the entries. The work per
text does not depend on how many entries a shard holds, and only the best rank per text leaves a cell.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.functions.text import fold_place
from offerloom.session import materialize

SHARD_ENTRIES, SHARD_TEXTS = 100_000, 50_000
FOUND = "text string, rank long"


def _automaton(words: dict):
    import ahocorasick

    machine = ahocorasick.Automaton()
    for word, value in words.items():
        machine.add_word(word, value)
    machine.make_automaton()
    return machine


def _cell(texts: pa.Table, entries: pa.Table) -> pa.Table:
    best: dict[str, int] = {}
    if texts.num_rows and entries.num_rows:
        known = sorted(zip(entries["rank"].to_pylist(), entries["entry"].to_pylist(), entries["inside"].to_pylist()))
        first: dict[str, int] = {}
        for rank, entry, _ in known:
            first.setdefault(entry, rank)
        everywhere = first.pop("", None)  # an empty entry lies in every text
        own = texts["text"].to_pylist()
        if first:
            machine = _automaton(first)
            for t in own:
                rank = min((r for _, r in machine.iter(t)), default=None)
                if rank is not None:
                    best[t] = rank
        if everywhere is not None:
            best.update((t, min(best.get(t, everywhere), everywhere)) for t in own)
        machine = _automaton({t: t for t in own})
        for rank, entry, inside in known:  # by rank: the first hit of a text is its best
            if inside:
                for _, t in machine.iter(entry):
                    if rank < best.get(t, rank + 1):
                        best[t] = rank
    return pa.table({"text": pa.array(list(best), pa.string()), "rank": pa.array(list(best.values()), pa.int64())})


def best_rank(texts: DataFrame, entries: DataFrame) -> DataFrame:
    """(text, rank): the lowest rank of an entry that lies in the text or, where ``inside`` holds, has the text in it.

    texts: text, distinct and not empty. entries: entry, rank, inside (null entries match nothing).
    """
    texts = materialize(texts)
    entries = materialize(entries.where("entry IS NOT NULL"))
    rows, parts = (max(1, -(-df.count() // n)) for df, n in ((texts, SHARD_TEXTS), (entries, SHARD_ENTRIES)))
    left = texts.withColumn("i", F.pmod(F.xxhash64("text"), F.lit(rows)).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = entries.withColumn("j", F.pmod(F.xxhash64("entry", "rank"), F.lit(parts)).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))
    found = left.groupBy("i", "j").cogroup(right.groupBy("i", "j")).applyInArrow(_cell, FOUND)
    return found.groupBy("text").agg(F.min("rank").alias("rank"))


def first_in_list(df: DataFrame, text: str, entries: DataFrame, labels: list[str]) -> DataFrame:
    """Adds the columns ``labels`` of the first entry of a list that contains the text or is contained in it.

    entries: entry, rank (unique), optional inside (false: only an entry inside the text counts) and the labels. Null and empty texts
    and texts without an entry get nulls; the input's rows all stay.
    """
    if "inside" not in entries.columns:
        entries = entries.withColumn("inside", F.lit(True))
    texts = df.where(F.col(text) != "").select(F.col(text).alias("text")).distinct()
    best = best_rank(texts, entries.select("entry", F.col("rank").cast("long").alias("rank"), "inside"))
    hits = best.join(entries.select(F.col("rank").cast("long").alias("rank"), *labels), "rank").select(F.col("text").alias("text_of_list"), *labels)
    return df.join(hits, F.col(text) == F.col("text_of_list"), "left").drop("text_of_list")


def locate(df: DataFrame, location: str, places: DataFrame, departments: DataFrame) -> DataFrame:
    """Adds region, lat and lon by département code, else by city, else by region name, for references of any size.

    places: place, kind ('city' or 'region'), region, lat, lon; the order of rank (unique) decides among cities and among regions.
    departments: code, region. A code of a region that is no place is unknown.
    """
    folded = df.withColumns({"place_folded": fold_place(F.col(location)), "code_found": F.regexp_extract(location, r"(?U)\b(\d{2,3}|2[AB])\b", 1)})
    last = places.agg(F.coalesce(F.max("rank"), F.lit(0)) + 1).scalar()
    entries = places.select(fold_place(F.col("place")).alias("entry"), F.col("rank") + F.when(F.col("kind") == "city", F.lit(0)).otherwise(last).alias("rank"),
                            (F.col("kind") == "city").alias("inside"), *(F.col(c).alias(f"{c}_by_place") for c in ("region", "lat", "lon")))
    entries = materialize(entries.toDF("entry", "rank", "inside", "region_by_place", "lat_by_place", "lon_by_place"))
    named = first_in_list(folded, "place_folded", entries, ["region_by_place", "lat_by_place", "lon_by_place"])
    regions = places.where("kind = 'region'").select("region", "lat", "lon").dropDuplicates(["region"])
    codes = departments.join(regions, "region").select(F.col("code").alias("code_found"), *(F.col(c).alias(f"{c}_by_code") for c in ("region", "lat", "lon")))
    both = named.join(codes, "code_found", "left")
    return both.select(*df.columns, *(F.when(F.col("region_by_code").isNotNull(), F.col(f"{c}_by_code")).otherwise(F.col(f"{c}_by_place")).alias(c)
                                      for c in ("region", "lat", "lon")))
