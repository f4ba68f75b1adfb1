"""Expressions that bring single offer fields to their harmonised form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Contract label and the upper-case wordings that select it, in priority order.
CONTRACT_WORDINGS = (
    ("CDI", ("CDI", "INDÉTERMINÉE", "INDETERMINEE")),
    ("CDD", ("CDD", "DÉTERMINÉE", "DETERMINEE")),
    ("Stage", ("STAGE",)),
    ("Alternance", ("ALTERNANCE", "APPRENTISSAGE", "PROFESSIONNALISATION")),
    ("Intérim", ("INTERIM", "INTÉRIM", "TEMPORAIRE")),
    ("Freelance", ("FREELANCE", "INDÉPENDANT", "INDEPENDANT")),
)

# Remote-work wordings per label.
REMOTE_WORDINGS = {
    "yes": ("yes", "oui", "complet", "total", "full", "remote"),
    "no": ("no", "non", "aucun", "sur site", "onsite"),
    "hybrid": ("partiel", "hybride", "occasionnel", "hybrid"),
}

# Wordings that count as remote work in the dashboards.
REMOTE_POSITIVE = ("yes", "oui", "hybrid")


def any_contains(text: Column, needles: Sequence[str]) -> Column:
    hit = F.lit(False)
    for needle in needles:
        hit = hit | F.contains(text, F.lit(needle))
    return hit


def first_label(text: Column, rules: Sequence[tuple[str, Sequence[str]]], default: Column) -> Column:
    """Label of the first rule with a contained needle."""
    expr = None
    for label, needles in rules:
        hit = any_contains(text, needles)
        expr = F.when(hit, F.lit(label)) if expr is None else expr.when(hit, F.lit(label))
    return default if expr is None else expr.otherwise(default)


def normalize_contract(col: Column) -> Column:
    wording = F.trim(F.upper(col))
    return F.when(col.isNotNull(), first_label(wording, CONTRACT_WORDINGS, wording))


def normalize_remote(col: Column) -> Column:
    wording = F.trim(F.lower(col))
    expr = None
    for label, accepted in REMOTE_WORDINGS.items():
        hit = wording.isin(*accepted)
        expr = F.when(hit, F.lit(label)) if expr is None else expr.when(hit, F.lit(label))
    return expr.otherwise(F.lit("unknown"))


def normalize_salary(col: Column) -> Column:
    return F.trim(col)


def form_remote(col: Column) -> Column:
    return F.when(col == "Oui", F.lit("yes")).when(col == "Hybride", F.lit("hybrid")).otherwise(F.lit("no"))


def source_type(col: Column) -> Column:
    return F.when(F.contains(F.lower(col), F.lit("france travail")), F.lit("api")).otherwise(F.lit("scraping"))


def region_from_location_tail(col: Column) -> Column:
    """Text after the last comma, or the whole location."""
    return F.trim(F.element_at(F.split(col, ","), -1))


def has_remote(col: Column) -> Column:
    return F.coalesce(F.lower(col).isin(*REMOTE_POSITIVE), F.lit(False))


def source_uid(prefix: str, offer_id: Column) -> Column:
    return F.concat(F.lit(prefix + "_"), offer_id)


def content_uid(title: Column, company: Column, location: Column) -> Column:
    """md5 of the lower-cased identifying text; a missing part counts as empty."""
    empty = F.lit("")
    return F.md5(F.lower(F.concat_ws(
        "|", F.coalesce(title, empty), F.coalesce(company, empty), F.coalesce(location, empty))))


def id_source_uid(offer_id: Column, source: Column, title: Column | None = None) -> Column:
    parts = [offer_id, source] + ([] if title is None else [title])
    return F.md5(F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def categorize_job(title: Column, description: Column,
                   categories: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """First category, in the given order, with a keyword contained in the text."""
    text = F.lower(F.concat_ws(" ", title, description))
    lowered = [(name, [k.lower() for k in keywords]) for name, keywords in categories]
    return first_label(text, lowered, F.lit("other"))


def first_filled(*cols: Column) -> Column:
    """First candidate that is neither NULL nor empty; the last one as it is."""
    *head, last = cols
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in head], last)
