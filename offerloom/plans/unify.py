"""The three raw sources on the harmonised 13-column record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.functions.offers import normalize_contract, normalize_remote, normalize_salary, source_uid
from offerloom.operators.sets import union_sources
from offerloom.schemas import OFFER


def _optional(df: DataFrame, *names: str) -> Column:
    """First non-NULL of the columns that exist."""
    present = [F.col(n) for n in names if n in df.columns]
    return F.coalesce(*present).cast("string") if present else F.lit(None).cast("string")


def _record(df: DataFrame, prefix: str, source: str, seq: str | None, **fields: Column) -> DataFrame:
    values = {
        "uid": source_uid(prefix, F.col("offer_id").cast("string")),
        "source": F.lit(source), "source_url": F.col("url"), "offer_id": F.col("offer_id").cast("string"),
        "title": F.col("title"), "company": _optional(df, "company"), "location": F.col("location"),
        "contract_type": normalize_contract(_optional(df, "contract_type")),
        "salary": normalize_salary(_optional(df, "salary")), "remote": F.lit("unknown"),
        "published_date": _optional(df, "published_date"), "description": _optional(df, "description"),
        "query": _optional(df, "query"), **fields,
    }
    order = [F.col(seq)] if seq else []
    return df.select(*[values[name].alias(name) for name in OFFER.fieldNames()], *order)


def unify_a(raw: DataFrame, seq: str | None = None) -> DataFrame:
    return _record(raw, "FT", "France Travail", seq)


def unify_b(raw: DataFrame, seq: str | None = None) -> DataFrame:
    remote = normalize_remote(F.col("remote")) if "remote" in raw.columns else F.lit("unknown")
    company = _optional(raw, "employer") if "employer" in raw.columns else _optional(raw, "company")
    return _record(raw, "HW", "HelloWork", seq, company=company, remote=remote,
                   published_date=_optional(raw, "published_relative"), query=F.lit(None).cast("string"))


def unify_c(raw: DataFrame, seq: str | None = None) -> DataFrame:
    return _record(raw, "AZ", "Adzuna", seq, published_date=_optional(raw, "published_date", "created"),
                   description=_optional(raw, "raw_text", "description"))


def unify_all(raw_a: DataFrame | None, raw_b: DataFrame | None, raw_c: DataFrame | None, seq: str) -> DataFrame:
    """All available sources, one row per uid; ``seq`` is the input order column of the raw frames."""
    parts = [unify(raw, seq).withColumn("__rank", F.lit(rank))
             for rank, (raw, unify) in enumerate(((raw_a, unify_a), (raw_b, unify_b), (raw_c, unify_c)))
             if raw is not None]
    return union_sources(parts, "uid", "__rank", seq).drop("__rank", seq)
