"""Counts, shares, distributions and summaries.

Facts are reduced by key before a dimension is joined, so the join sees one row per
key; NULL keys are left out of groupings but stay in the denominators.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.functions.text import each
from offerloom.operators.ranking import top_per_group


def percent2(part: Column, whole: Column) -> Column:
    """100*part/whole rounded half up to two places, in exact integer arithmetic."""
    return F.when(whole != 0, F.floor((part * 20000 + whole) / (whole * 2)) / 100.0)


def row_total(df: DataFrame) -> Column:
    """Number of rows as an uncorrelated scalar subquery."""
    return df.agg(F.count(F.lit(1))).scalar()


def top_skills(bridge: DataFrame, skills: DataFrame, offers: DataFrame, n: int | None = None,
               skill_type: str | None = None) -> DataFrame:
    """Offers per skill with their share of all offers; the bridge holds distinct pairs."""
    counts = bridge.groupBy("skill_key").agg(F.count(F.lit(1)).alias("offer_count"))
    named = counts.join(skills, "skill_key")
    if skill_type:
        named = named.where(F.col("skill_type") == skill_type)
    result = named.select(
        "skill_key", "skill_name", "skill_type", "skill_category", "offer_count",
        percent2(F.col("offer_count"), row_total(offers)).alias("percentage"))
    ordered = result.orderBy(F.desc("offer_count"), F.asc("skill_key"))
    return ordered if n is None else ordered.limit(n)


def offers_by_region(offers: DataFrame, regions: DataFrame) -> DataFrame:
    """Offers and mean skills of every region, regions without offers included."""
    counts = offers.where(F.col("region_key").isNotNull()).groupBy("region_key").agg(
        F.count("offer_key").alias("offer_count"), F.avg("skills_count").alias("avg_skills_per_offer"))
    return regions.join(counts, "region_key", "left") \
        .withColumn("offer_count", F.coalesce("offer_count", F.lit(0).cast("bigint")))


def global_stats(offers: DataFrame, skills: DataFrame) -> DataFrame:
    """One row of totals: one pass over each table, read back as scalar subqueries."""
    o = offers.agg(F.struct(F.count(F.lit(1)).alias("n"), F.countDistinct("region_key").alias("r"),
                            F.avg("skills_count").alias("a"))).scalar()
    s = skills.agg(F.struct(F.count(F.lit(1)).alias("n"),
                            F.count_if(F.col("skill_type") == "competences").alias("c"),
                            F.count_if(F.col("skill_type") == "savoir_etre").alias("e"))).scalar()
    return offers.sparkSession.range(1).select(o.alias("o"), s.alias("s")).select(
        F.col("o.n").alias("total_offers"), F.col("o.r").alias("total_regions"),
        F.col("s.n").alias("total_skills"), F.col("s.c").alias("total_competences"),
        F.col("s.e").alias("total_savoir_etre"), F.col("o.a").alias("avg_skills_per_offer"))


def skill_lists(bridge: DataFrame, skills: DataFrame) -> DataFrame:
    """Per offer the sorted hard, soft and all-skill names; NULL where a list is empty.

    An offer links each skill at most once, so the lists are bounded by the skill table.
    """
    def names(condition: Column | None) -> Column:
        value = F.col("skill_name") if condition is None else F.when(condition, F.col("skill_name"))
        items = F.array_sort(F.collect_list(value))
        return F.when(F.size(items) > 0, items)

    return bridge.join(skills, "skill_key").groupBy("offer_key").agg(
        names(F.col("skill_type") == "competences").alias("competences"),
        names(F.col("skill_type") == "savoir_etre").alias("savoir_etre"),
        names(None).alias("all_skills"))


def offers_with_skills(offers: DataFrame, bridge: DataFrame, skills: DataFrame) -> DataFrame:
    return offers.join(skill_lists(bridge, skills), "offer_key", "left")


def remote_rate(df: DataFrame, group: str, remote: Column) -> DataFrame:
    agg = df.where(F.col(group).isNotNull()).groupBy(group).agg(
        F.count_if(remote).alias("remote_offers"), F.count(F.lit(1)).alias("total_offers"))
    return agg.withColumn("remote_pct", percent2(F.col("remote_offers"), F.col("total_offers")))


def kpi_row(offers: DataFrame, remote: Column) -> DataFrame:
    return offers.agg(
        F.count(F.lit(1)).alias("offers"), F.countDistinct("company_key").alias("companies"),
        F.countDistinct("region_name").alias("regions"),
        F.round(F.avg("skills_count"), 6).alias("avg_skills"),
        F.round(100.0 * F.count_if(remote) / F.count(F.lit(1)), 6).alias("remote_pct"))


def value_counts(df: DataFrame, col: str, n: int | None = None) -> DataFrame:
    """Count of each value and its share of all rows."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("pct", F.round(100.0 * F.col("n") / row_total(df), 6))
    return counts if n is None else counts.orderBy(F.desc("n"), F.asc(col)).limit(n)


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Filled values and their share per column, in one pass."""
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(c).alias(c) for c in columns])
    return counts.unpivot("__rows", list(columns), "column_name", "filled").select(
        "column_name", "filled", F.round(100.0 * F.col("filled") / F.col("__rows"), 6).alias("pct"))


def quality_report(df: DataFrame, uid: str, required: Sequence[str], date_text: str) -> DataFrame:
    """Rows, surplus uids, missing required values and unreadable dates."""
    missing = [F.count_if(F.col(c).isNull() | (F.trim(F.col(c)) == "")).alias(f"missing_{c}") for c in required]
    bad_date = F.col(date_text).isNotNull() & F.try_to_timestamp(F.col(date_text)).isNull()
    return df.agg(F.count(F.lit(1)).alias("total"),
                  (F.count(uid) - F.countDistinct(uid)).alias("duplicate_uids"),
                  *missing, F.count_if(bad_date).alias("invalid_dates"))


def repeated(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def metric_by(df: DataFrame, group: str, metric: str | None) -> DataFrame:
    """Mean of a metric (or the row count) per group."""
    value = F.count(F.lit(1)).cast("double") if metric is None else F.round(F.avg(metric), 6)
    return df.where(F.col(group).isNotNull()).groupBy(group).agg(value.alias("value"))


def pivot_counts(df: DataFrame, rows: str, cols: str, values: Sequence[str]) -> DataFrame:
    """Counts of a known set of column values per row value, zero where absent."""
    return df.where(F.col(rows).isNotNull()).groupBy(rows).agg(
        *[F.count_if(F.col(cols) == v).alias(v) for v in values])


def counts_by(df: DataFrame, name: str, expr: Column) -> DataFrame:
    return (df.select(expr.alias(name)).where(F.col(name).isNotNull())
            .groupBy(name).agg(F.count(F.lit(1)).alias("n")))


def resample_counts(df: DataFrame, ts: str, unit: str = "month") -> DataFrame:
    """Rows per period from the first to the last period, empty periods as zero."""
    counts = counts_by(df, "period", F.to_date(F.date_trunc(unit, F.col(ts))))
    bounds = df.agg(F.struct(F.min(ts).alias("a"), F.max(ts).alias("b"))).scalar()
    first, last = (F.to_date(F.date_trunc(unit, F.col(f"bounds.{x}"))) for x in "ab")
    calendar = df.sparkSession.range(1).select(bounds.alias("bounds")).select(
        F.explode(F.sequence(first, last, F.expr(f"interval 1 {unit}"))).alias("period"))
    return calendar.join(counts, "period", "left").select(
        "period", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last bin is closed."""
    bounds = df.agg(F.struct(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi"))).scalar()
    values = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("v"), bounds.alias("b"))
    width = (F.col("b.hi") - F.col("b.lo")) / bins
    slot = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - F.col("b.lo")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1)))
    return values.groupBy(slot.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def quartiles(df: DataFrame, group: str, value: str) -> DataFrame:
    """Five-number summary of an integer measure per group.

    Values are counted first, so the percentile works on (value, count) pairs.
    """
    counted = df.where(F.col(group).isNotNull() & F.col(value).isNotNull()) \
        .groupBy(group, value).agg(F.count(F.lit(1)).alias("__n"))
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col("__n"))
    return counted.groupBy(group).agg(F.min(value).alias("lo"), q.alias("q"), F.max(value).alias("hi")).select(
        group, "lo", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "hi")


def mean_median(df: DataFrame, value: str) -> DataFrame:
    counted = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("__n"))
    return counted.agg(
        F.round(F.sum(F.col(value) * F.col("__n")) / F.sum("__n"), 6).alias("mean"),
        F.percentile(value, F.lit(0.5), F.col("__n")).alias("median"))


def item_frequency(df: DataFrame, items: Column, n: int | None = None, name: str = "item") -> DataFrame:
    """Occurrences of array items, most frequent first."""
    counts = df.select(each(items).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), F.asc(name))
    return ordered if n is None else ordered.limit(n)


def first_different(df: DataFrame, key: str, cols: Sequence[str], n: int) -> DataFrame:
    """The first n different rows of each key in the order of the columns, each once.

    Rows are sorted by key and columns once, which spills; no map of all different rows is held.
    """
    rank = F.dense_rank().over(Window.partitionBy(key).orderBy(*cols))
    first = df.select(key, *cols).withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")
    return top_per_group(first, [key, *cols], [F.asc(key)], 1)


def hierarchy(df: DataFrame, levels: Sequence[str]) -> DataFrame:
    """Counts of every level with the totals of its parents (``depth`` = filled levels)."""
    return df.rollup(*levels).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("__gid")) \
        .withColumn("depth", F.lit(len(levels)) - F.bit_count("__gid").cast("int")).drop("__gid")


def radar_counts(links: DataFrame, regions: Sequence[str], skills: Sequence[str]) -> DataFrame:
    """Offers per chosen region and skill, zero where none (both lists are parameters)."""
    spark = links.sparkSession
    grid = spark.range(1).select(F.explode(F.array(*[F.lit(r) for r in regions])).alias("region_name")) \
        .select("region_name", F.explode(F.array(*[F.lit(s) for s in skills])).alias("skill_name"))
    counts = links.where(F.col("region_name").isin(*regions) & F.col("skill_name").isin(*skills)) \
        .groupBy("region_name", "skill_name").agg(F.countDistinct("offer_key").alias("n"))
    return grid.join(counts, ["region_name", "skill_name"], "left").select(
        "region_name", "skill_name", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def corpus_stats(df: DataFrame, tokens: Column) -> DataFrame:
    """Words, distinct words, words per document and diversity."""
    word_counts = df.select(each(tokens).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    totals = word_counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_words"),
                             F.count(F.lit(1)).alias("unique_words"))
    return totals.select(
        "total_words", "unique_words",
        F.round(F.col("total_words") / row_total(df), 6).alias("avg_words"),
        F.round(F.try_divide(F.col("unique_words"), F.col("total_words")), 6).alias("diversity"))


def term_counts(df: DataFrame, tokens: Column, terms: Sequence[str]) -> DataFrame:
    """Occurrences of the listed single-word terms (tokens are filtered before any shuffle)."""
    hits = F.filter(tokens, lambda t: t.isin(*terms))
    return df.select(each(hits).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def letter_term_counts(df: DataFrame, text: Column, letters: Sequence[str]) -> DataFrame:
    """Occurrences of one-letter language names, upper case only, in the original text."""
    counts = df.agg(*[F.sum(F.regexp_count(text, F.lit(r"(?<!\S)%s(?=[\s,./+]|$)" % letter))).alias(letter)
                      for letter in letters])
    return counts.unpivot([], list(letters), "term", "n").where(F.col("n") > 0)


def skill_by_region(links: DataFrame, offers: DataFrame, skill: str) -> DataFrame:
    """Offers that ask for a skill per region, and their share of the region's offers."""
    asking = links.where(F.col("skill_name") == skill).select("offer_key").distinct()
    flagged = offers.where(F.col("region_name").isNotNull()).select("offer_key", "region_name") \
        .join(asking.withColumn("__hit", F.lit(1)), "offer_key", "left")
    return flagged.groupBy("region_name").agg(F.count("__hit").alias("n"), F.count(F.lit(1)).alias("offers")) \
        .withColumn("share", F.round(F.try_divide(F.col("n"), F.col("offers")), 6))


def region_profile(offers: DataFrame, links: DataFrame, top: int = 5) -> DataFrame:
    """Per region: offers, leading skills, contract mix and leading companies.

    Each part is counted and cut to its top list first; only bounded lists are collected.
    """
    located = offers.where(F.col("region_name").isNotNull())

    def listed(counts: DataFrame, value: str, name: str, n: int | None) -> DataFrame:
        best = counts if n is None else top_per_group(counts, ["region_name"], [F.desc("n"), F.asc(value)], n)
        item = F.struct((-F.col("n")).alias("o"), F.col(value).cast("string").alias("v"), F.col("n").alias("n"))
        return best.groupBy("region_name").agg(F.transform(
            F.array_sort(F.collect_list(item)), lambda x: F.concat(x.v, F.lit(":"), x.n.cast("string"))).alias(name))

    def counted(df: DataFrame, value: str) -> DataFrame:
        return df.where(F.col(value).isNotNull()).groupBy("region_name", value).agg(F.count(F.lit(1)).alias("n"))

    # each offer's skill once, by sorting, which spills: no map of all offers and skills is held
    asked = top_per_group(links.where(F.col("region_name").isNotNull()).select("offer_key", "region_name", "skill_name"),
                          ["offer_key", "region_name", "skill_name"], [F.asc("offer_key")], 1)
    skills = counted(asked, "skill_name")
    return (located.groupBy("region_name").agg(F.count(F.lit(1)).alias("offers"))
            .join(listed(skills, "skill_name", "top_skills", top), "region_name", "left")
            .join(listed(counted(located, "contract_type"), "contract_type", "contracts", None), "region_name", "left")
            .join(listed(counted(located, "company_key"), "company_key", "top_companies", top), "region_name", "left"))


def geo_bins(df: DataFrame, lat: str, lon: str, step: float) -> DataFrame:
    """Points per grid cell."""
    cell = [F.floor(F.col(c) / F.lit(step)).alias(f"{c}_bin") for c in (lat, lon)]
    return df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).groupBy(*cell) \
        .agg(F.count(F.lit(1)).alias("n"))
