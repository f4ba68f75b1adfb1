"""Rule-based labels of clusters from their top terms and sample titles.

One row per cluster with bounded lists (15 terms, 20 titles) meets the rule tables,
which are small parameters held as literals.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.operators.ranking import top_per_group

MAX_TITLES = 20
TOP_SKILLS = 5


@dataclass(frozen=True)
class LabelRules:
    lexicon: Sequence[str]
    families: Sequence[tuple[str, Sequence[str]]]
    insights: Sequence[tuple[str, Sequence[str]]]
    excluded: Sequence[str] = field(default_factory=tuple)
    default_family: str = "IT Généraliste"
    default_label: str = "Profil Technique Polyvalent"


def occurrences(text: Column, needle: Column) -> Column:
    return ((F.length(text) - F.length(F.replace(text, needle, F.lit("")))) / F.length(needle)).cast("int")


def _matching(detected: Column, rules: Sequence[tuple[str, Sequence[str]]]) -> Column:
    table = F.array(*[F.struct(F.lit(name).alias("name"), F.array(*[F.lit(s) for s in skills]).alias("skills"))
                      for name, skills in rules])
    return F.transform(F.filter(table, lambda r: F.arrays_overlap(r.skills, detected)), lambda r: r["name"])


def label_clusters(terms: DataFrame, titles: DataFrame, sizes: DataFrame, cluster: str,
                   rules: LabelRules, title_order: Sequence[Column]) -> DataFrame:
    """Detected skills, the five best, label, families, insights, confidence and complexity."""
    term_lists = terms.groupBy(cluster).agg(F.array_sort(F.collect_list(F.lower("term"))).alias("terms"))
    sample = top_per_group(titles, [cluster], title_order, MAX_TITLES)
    title_text = sample.groupBy(cluster).agg(
        F.lower(F.array_join(F.array_sort(F.collect_list("title")), " ")).alias("title_text"))
    rows = sizes.join(term_lists, cluster, "left").join(title_text, cluster, "left").select(
        cluster, "n_docs", F.coalesce("terms", F.array().cast("array<string>")).alias("terms"),
        F.coalesce("title_text", F.lit("")).alias("title_text"))

    usable = [s for s in rules.lexicon if s not in set(rules.excluded)]
    lexicon = F.array(*[F.lit(s) for s in sorted(usable)])
    detected = F.filter(lexicon, lambda s: F.array_contains(F.col("terms"), s)
                        | F.contains(F.col("title_text"), s))
    rows = rows.withColumn("detected", detected).withColumn("terms_text", F.array_join("terms", " "))
    scored = F.array_sort(F.transform("detected", lambda s: F.struct(
        (-(2 * occurrences(F.col("title_text"), s) + occurrences(F.col("terms_text"), s))).alias("o"), s.alias("s"))))
    rows = rows.withColumn("top_skills", F.transform(F.slice(scored, 1, TOP_SKILLS), lambda x: x.s))
    families = _matching(F.col("detected"), rules.families)
    n = F.size("detected")
    return rows.withColumn("families", families).select(
        cluster, "n_docs", "detected", "top_skills",
        F.when(n > 0, F.concat(F.lit("Expert "), F.array_join(
            F.transform(F.slice("top_skills", 1, 3), lambda s: F.initcap(s)), " • ")))
        .otherwise(F.lit(rules.default_label)).alias("label"),
        F.when(F.size("families") > 0, F.col("families")).otherwise(
            F.array(F.lit(rules.default_family))).alias("families"),
        _matching(F.col("detected"), rules.insights).alias("insights"),
        F.least(n / F.lit(10.0), F.lit(1.0)).alias("confidence"),
        (n * 5 + F.greatest(F.size("families"), F.lit(1)) * 10).alias("complexity"))
