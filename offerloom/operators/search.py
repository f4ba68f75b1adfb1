"""Filters, free search, detail view, option lists and paging."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# List entries that mean "no restriction".
ALL_SENTINELS = ("Toutes", "Tous")


def in_list(col: Column, values: Sequence[str] | None) -> Column | None:
    """Membership condition, or None when the selection does not restrict."""
    if not values or any(v in ALL_SENTINELS for v in values):
        return None
    return col.isin(*values)


def equals(col: Column, value: str | None) -> Column | None:
    return None if not value or value in ALL_SENTINELS else col == value


def apply_conditions(df: DataFrame, *conditions: Column | None) -> DataFrame:
    for condition in conditions:
        if condition is not None:
            df = df.where(condition)
    return df


def date_between(ts: Column, first: str, last: str) -> Column:
    """Date part within two inclusive dates, written so that it still reaches the scan."""
    start = F.lit(first).cast("date")
    after = F.date_add(F.lit(last).cast("date"), 1)
    return (ts >= start) & (ts < after)


def matches_regex(cols: Sequence[Column], pattern: str) -> Column:
    """Case-insensitive pattern on any column; NULL counts as no match."""
    hit = F.lit(False)
    for col in cols:
        hit = hit | F.coalesce(col.rlike("(?iu)" + pattern), F.lit(False))
    return hit


def escape_like(text: str) -> str:
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def contains_ci(cols: Sequence[Column], text: str) -> Column:
    hit = F.lit(False)
    for col in cols:
        hit = hit | F.coalesce(F.contains(F.lower(col), F.lit(text.lower())), F.lit(False))
    return hit


def like_ci(cols: Sequence[Column], text: str) -> Column:
    hit = F.lit(False)
    for col in cols:
        hit = hit | F.coalesce(F.ilike(col, F.lit(f"%{escape_like(text)}%")), F.lit(False))
    return hit


def any_skill_exact(skills: Column, wanted: Sequence[str]) -> Column:
    tokens = F.transform(skills, lambda s: F.lower(F.trim(s)))
    return F.coalesce(F.arrays_overlap(tokens, F.array(*[F.lit(w.strip().lower()) for w in wanted])), F.lit(False))


def any_skill_substring(joined_skills: Column, wanted: Sequence[str]) -> Column:
    return contains_ci_any(joined_skills, wanted)


def contains_ci_any(text: Column, wanted: Sequence[str]) -> Column:
    hit = F.lit(False)
    for w in wanted:
        hit = hit | F.coalesce(F.contains(F.lower(text), F.lit(w.lower())), F.lit(False))
    return hit


def all_skills(skills: Column, wanted: Sequence[str]) -> Column:
    return F.coalesce(F.size(F.array_except(F.array(*[F.lit(w) for w in wanted]), skills)) == 0, F.lit(False))


def offers_with_any_skill(bridge: DataFrame, skills: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keys of offers linked to a named skill (semi-join side: duplicates do no harm)."""
    keys = skills.where(F.col("skill_name").isin(*names)).select("skill_key")
    return bridge.join(keys, "skill_key", "left_semi").select("offer_key")


def offers_with_all_skills(bridge: DataFrame, skills: DataFrame, names: Sequence[str]) -> DataFrame:
    wanted = skills.where(F.col("skill_name").isin(*names)).select("skill_key", "skill_name")
    found = bridge.join(wanted, "skill_key").select("offer_key", "skill_name").distinct()
    return (found.groupBy("offer_key").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") == len(set(names))).select("offer_key"))


def search_offers(offers: DataFrame, bridge: DataFrame, skills: DataFrame, *,
                  regions: Sequence[str] | None = None, wanted_skills: Sequence[str] | None = None,
                  contract_types: Sequence[str] | None = None, remote: str | None = None,
                  text: str | None = None) -> DataFrame:
    """Offers meeting every given restriction, newest first.

    Restrictions on offer columns come before the semi-join, so they reach the scan;
    the semi-join replaces a DISTINCT over all offer columns.
    """
    found = apply_conditions(
        offers,
        in_list(F.col("region_name"), regions),
        in_list(F.col("contract_type"), contract_types),
        equals(F.col("remote"), remote),
        like_ci([F.col("title"), F.col("description")], text) if text else None,
    )
    if wanted_skills:
        found = found.join(offers_with_any_skill(bridge, skills, wanted_skills), "offer_key", "left_semi")
    return found.orderBy(F.desc("added_at"), F.asc("offer_key"))


def offer_details(offers: DataFrame, bridge: DataFrame, skills: DataFrame, offer_key: int) -> DataFrame:
    """One offer with its two skill lists in name order."""
    linked = bridge.where(F.col("offer_key") == offer_key).join(skills, "skill_key")

    def names(kind: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("skill_type") == kind, F.col("skill_name"))))

    lists = linked.groupBy("offer_key").agg(names("competences").alias("competences"),
                                            names("savoir_etre").alias("savoir_etre"))
    return offers.where(F.col("offer_key") == offer_key).join(lists, "offer_key", "left")


def unique_values(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col)


def skill_vocabulary(df: DataFrame, joined_skills: str, n: int = 100) -> DataFrame:
    items = df.select(F.explode(F.split(F.col(joined_skills), ",")).alias("skill"))
    return (items.select(F.trim("skill").alias("skill")).where(F.col("skill") != "")
            .distinct().orderBy("skill").limit(n))


def paginate(df: DataFrame, order: Sequence[Column], page: int, size: int = 20) -> DataFrame:
    """One page with the total number of pages; use :func:`next_page` for deep paging."""
    total = df.agg(F.ceil(F.count(F.lit(1)) / F.lit(size)).cast("bigint")).scalar()
    return (df.orderBy(*order).offset((page - 1) * size).limit(size)
            .withColumn("total_pages", total))


def next_page(df: DataFrame, key: str, after, size: int = 20) -> DataFrame:
    """The page after a key value: a range filter on the scan instead of an offset."""
    rows = df if after is None else df.where(F.col(key) > F.lit(after))
    return rows.orderBy(key).limit(size)


def preview(df: DataFrame, columns: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).select(*columns).limit(n)
