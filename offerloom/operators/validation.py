"""Checks on incoming rows; rejects are returned, not dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.functions.offers import region_from_location_tail

REQUIRED = ("title", "company_name", "location")
DEFAULT_COMPANY = "Entreprise non précisée"


def clean_title(df: DataFrame) -> DataFrame:
    """Rows with title and company, the title trimmed, a blank company replaced."""
    kept = df.dropna(subset=["title", "company"])
    return kept.withColumns({
        "title": F.trim("title"),
        "company": F.when(F.trim("company") == "", F.lit(DEFAULT_COMPANY)).otherwise(F.col("company"))})


def validate_upload(df: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) uploaded rows with source, added_at and region_name filled in."""
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    if "source" not in df.columns:
        df = df.withColumn("source", F.lit("upload"))
    if "added_at" not in df.columns:
        df = df.withColumn("added_at", now)
    if "region_name" not in df.columns:
        df = df.withColumn("region_name", region_from_location_tail(F.col("location")))
    filled = F.lit(True)
    for c in REQUIRED:
        filled = filled & F.col(c).isNotNull() & (F.col(c) != "")
    return df.where(filled), df.where(~filled)
