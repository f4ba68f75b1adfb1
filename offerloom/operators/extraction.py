"""Merging the structs an external extraction service returned into the offers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.schemas import EXTRACTION

# Fields that fall back to the offer (then to a default) when the extraction leaves them empty.
FALLBACKS = {"title": "Sans titre", "company_name": "Collectivité", "location": ""}
LISTS = ("competences", "savoir_etre")


def merge_extraction(offers: DataFrame, extracted: DataFrame, key: str) -> DataFrame:
    """Extracted fields win, even as NULL; offers without an extraction stay as they are."""
    joined = offers.join(extracted.select(key, "extraction"), key, "left")
    has = F.col("extraction").isNotNull()
    merged = {}
    for field in EXTRACTION.fieldNames():
        new = F.col(f"extraction.{field}")
        old = F.col(field) if field in offers.columns else F.lit(None).cast(EXTRACTION[field].dataType)
        if field in FALLBACKS:
            new = F.coalesce(F.nullif(new, F.lit("")), old, F.lit(FALLBACKS[field]))
        elif field in LISTS:
            new = F.coalesce(new, F.array().cast("array<string>"))
        merged[field] = F.when(has, new).otherwise(old)
    result = joined.withColumns(merged).drop("extraction")
    sizes = {f: F.coalesce(F.size(f), F.lit(0)) for f in LISTS}
    return result.withColumns({"competences_count": sizes["competences"], "savoir_etre_count": sizes["savoir_etre"],
                               "skills_count": sizes["competences"] + sizes["savoir_etre"]})
