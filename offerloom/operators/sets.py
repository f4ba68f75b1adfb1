"""Unions and set comparisons."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.operators.ranking import keep_first


def union_sources(sources: Sequence[DataFrame | None], key: str, rank: str, seq: str) -> DataFrame:
    """All available sources on one schema, each key once: first source, then first row."""
    present = [s for s in sources if s is not None]
    if not present:
        raise ValueError("no source available")
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)
    return keep_first(merged, [key], [F.col(rank), F.col(seq)])


def compare_terms(left: DataFrame, right: DataFrame, term: str = "term") -> DataFrame:
    """Terms labelled only_left, only_right or common."""
    sides = left.select(term).distinct().withColumn("s", F.lit(1)) \
        .unionByName(right.select(term).distinct().withColumn("s", F.lit(2)))
    return sides.groupBy(term).agg(F.sum("s").alias("s")).select(
        term, F.when(F.col("s") == 1, F.lit("only_left")).when(F.col("s") == 2, F.lit("only_right"))
        .otherwise(F.lit("common")).alias("side"))


# Score floors of the verdicts, best first.
VERDICTS = (("EXCELLENT", 80.0), ("BON", 60.0), ("MOYEN", 40.0))


def profile_overlap(profile_terms: Column, offer_terms: Column) -> dict[str, Column]:
    """Matched and missing offer terms, the score and its verdict for one (profile, offer) row."""
    matched = F.array_sort(F.array_intersect(offer_terms, profile_terms))
    missing = F.array_sort(F.array_except(offer_terms, profile_terms))
    asked = F.size(matched) + F.size(missing)
    score = F.coalesce(F.round(F.try_divide(100.0 * F.size(matched), asked), 6), F.lit(0.0))
    verdict = None
    for label, floor in VERDICTS:
        verdict = F.when(score >= floor, F.lit(label)) if verdict is None else verdict.when(score >= floor, F.lit(label))
    return {"matched": matched, "missing": missing, "score": score,
            "verdict": verdict.otherwise(F.lit("FAIBLE"))}
