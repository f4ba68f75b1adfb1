"""Expressions on URLs and on the visible text of offer pages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerloom.functions.text import slugify

# Metadata patterns of an offer page (Java syntax, Unicode classes). A look at the first character comes before the
# word bound, which costs more per position.
LOCATION_PATTERN = r"(?U)(?=[A-ZÉÈÊÀÂÎÏÔÙÛÇ])\b([A-ZÉÈÊÀÂÎÏÔÙÛÇ][\w'’\- ]+\s-\s\d{2})\b"
DEPARTMENT_PATTERN = r"(?U)\s-\s\d{2}\b"
CONTRACT_PATTERN = r"(?iuU)(?=[CISAF])\b(CDI|CDD|Intérim|Stage|Alternance|Freelance|Indépendant|Franchise)\b"
SALARY_PATTERN = (
    r"(?iuU)(?=\d)\b(\d[\d\s]*\s?(?:-\s?\d[\d\s]*\s?)?€\s?/\s?(?:an|mois|heure))\b")
REMOTE_PATTERNS = (
    ("yes", r"(?iuU)(?=t)\btélétravail\s+(?:complet|total)\b"),
    ("hybrid", r"(?iuU)(?=t)\btélétravail\s+(?:partiel|hybride|occasionnel)\b"),
    ("no", r"(?iuU)(?=p)\bpas de télétravail\b"),
)
RELATIVE_DATE_PATTERN = (
    r"(?iuU)(?=[im])\b(il y a \d+ (?:jour|jours|heure|heures|minute|minutes)|moins d'une heure)\b")
OFFER_ID_PATTERN = r"/emplois/(\d+)\.html"

# Path segment per search mode.
MODE_SEGMENTS = ("emploi", "stage", "alternance")


def _extract(col: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit(""))


def url_offer_id(url: Column) -> Column:
    return _extract(url, OFFER_ID_PATTERN)


def page_location(text: Column) -> Column:
    """A text without a department at the end of a place is not searched for the place."""
    return F.when(text.rlike(DEPARTMENT_PATTERN), F.trim(_extract(text, LOCATION_PATTERN)))


def page_contract(text: Column) -> Column:
    return _extract(text, CONTRACT_PATTERN)


def page_salary(text: Column) -> Column:
    return F.trim(F.regexp_replace(_extract(text, SALARY_PATTERN), r"(?U)\s+", " "))


def page_remote(text: Column) -> Column:
    expr = None
    for label, pattern in REMOTE_PATTERNS:
        hit = text.rlike(pattern)
        expr = F.when(hit, F.lit(label)) if expr is None else expr.when(hit, F.lit(label))
    return expr.otherwise(F.lit("unknown"))


def page_relative_date(text: Column) -> Column:
    return _extract(text, RELATIVE_DATE_PATTERN)


def relative_timestamp(relative: Column, crawled_at: Column) -> Column:
    """Publication time: the crawl time minus the stated age."""
    low = F.lower(relative)
    count = F.regexp_extract(low, r"(\d+)", 1)
    amount = F.when(count != "", count.cast("int"))
    return (F.when(F.contains(low, F.lit("jour")), crawled_at - F.make_dt_interval(days=amount))
            .when(F.contains(low, F.lit("heure")) & amount.isNotNull(),
                  crawled_at - F.make_dt_interval(hours=amount))
            .when(F.contains(low, F.lit("minute")), crawled_at - F.make_dt_interval(mins=amount))
            .when(F.contains(low, F.lit("moins d'une heure")), crawled_at))


def valid_url(url: Column) -> Column:
    text = F.trim(F.coalesce(url, F.lit("")))
    return F.startswith(text, F.lit("http"))


def _without(pairs: Column, name: str) -> Column:
    return F.filter(pairs, lambda p: p.k != name)


def _with_value(pairs: Column, name: str, value: str) -> Column:
    """The pair replaced where the name exists, appended where it does not."""
    entry = F.struct(F.lit(name).alias("k"), F.lit(value).alias("v"))
    replaced = F.transform(pairs, lambda p: F.when(p.k == name, entry).otherwise(p))
    return F.when(F.exists(pairs, lambda p: p.k == name), replaced).otherwise(F.concat(pairs, F.array(entry)))


def set_query_param(url: Column, params: Mapping[str, str | None]) -> Column:
    """The URL with query parameters set (or removed, for None); first value per name wins."""
    base = F.regexp_extract(url, r"^[^?#]*", 0)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(url, r"#.*$", 0)

    def decoded(text: Column) -> Column:
        return F.coalesce(F.try_url_decode(text), text)

    pairs = F.transform(
        F.filter(F.split(query, "&"), lambda p: p.rlike(r"(?s)^[^=]*=.")),
        lambda p: F.struct(decoded(F.regexp_extract(p, r"^([^=]*)=", 1)).alias("k"),
                           decoded(F.regexp_extract(p, r"(?s)^[^=]*=(.*)$", 1)).alias("v")))
    names = F.transform(pairs, lambda p: p.k)
    pairs = F.filter(pairs, lambda p, i: F.array_position(names, p.k) == i + 1)
    for name, value in params.items():
        pairs = _without(pairs, name) if value is None else _with_value(pairs, name, str(value))
    encoded = F.array_join(
        F.transform(pairs, lambda p: F.concat(F.url_encode(p.k), F.lit("="), F.url_encode(p.v))), "&")
    return F.concat(base, F.when(encoded != "", F.concat(F.lit("?"), encoded)).otherwise(F.lit("")), fragment)


def listing_url(base: str, mode: Column, keyword: Column, city: Column, postal: Column) -> Column:
    """Listing address for a search; NULL when the keyword has no usable characters."""
    wanted = F.lower(F.trim(mode))
    segment = F.when(wanted.isin(*MODE_SEGMENTS), wanted).otherwise(F.lit("emploi"))
    slug = slugify(keyword)
    has_city = F.coalesce(city, F.lit("")) != ""
    place = F.concat_ws("-", F.trim(city), F.nullif(F.trim(postal), F.lit("")))
    path = F.concat(F.lit(base + "/fr-fr/"), segment, F.lit("/metier_"), slug,
                    F.when(has_city, F.concat(F.lit("-ville_"), slugify(place))).otherwise(F.lit("")),
                    F.lit(".html"))
    return F.when(slug != "", path)


def absolute_url(base: str, href: Column) -> Column:
    return (F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
            .when(F.startswith(href, F.lit("//")), F.concat(F.lit("https:"), href))
            .when(F.startswith(href, F.lit("/")), F.concat(F.lit(base), href))
            .otherwise(F.concat(F.lit(base + "/"), href)))
