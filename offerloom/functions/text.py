"""Text expressions: accents, slugs, tokens, cleaning, list literals, JSON replies."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerloom.schemas import EXTRACTION


def _accent_table() -> tuple[str, str]:
    """(from, to) strings for ``translate``, derived from Unicode decompositions.

    ``translate`` deletes source characters that have no counterpart, so the bare
    combining marks go last.
    """
    source, target = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        char = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if base != char and len(base) == 1:
            source.append(char)
            target.append(base)
    marks = [chr(code) for code in range(0x0300, 0x0370)]
    return "".join(source + marks), "".join(target)


_ACCENTED, _PLAIN = _accent_table()


def strip_accents(col: Column) -> Column:
    return F.translate(col, _ACCENTED, _PLAIN)


def fold_place(col: Column) -> Column:
    """Place name for comparison: no accents, hyphens or apostrophes, lower case, trimmed."""
    return F.trim(F.lower(F.translate(strip_accents(col), "-'", "  ")))


def slugify(col: Column) -> Column:
    plain = strip_accents(F.lower(F.trim(F.coalesce(col, F.lit("")))))
    ascii_only = F.regexp_replace(plain, r"[^a-z0-9\s-]", " ")
    hyphenated = F.regexp_replace(ascii_only, r"[\s-]+", "-")
    return F.regexp_replace(hyphenated, r"^-+|-+$", "")


def collapse_spaces(col: Column) -> Column:
    return F.trim(F.regexp_replace(col, r"\s+", " "))


def normalize_skill_text(col: Column) -> Column:
    """One space between words; dotted three-letter acronyms lose their dots."""
    return F.trim(F.regexp_replace(F.regexp_replace(col, r"\s+", " "),
                                   r"([A-Z])\.([A-Z])\.([A-Z])", "$1$2$3"))


def words(col: Column) -> Column:
    """Lower-cased runs of letters, digits and underscore."""
    return F.regexp_extract_all(F.lower(col), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def each(items: Column) -> Column:
    """Explodes a computed string array.

    Spark guards ``explode(column)`` with a filter on the size of the column, which would
    run the tokeniser once more for the test; an expression is not guarded.
    """
    return F.explode(F.concat(items, F.array().cast("array<string>")))


def tokenize(col: Column, min_length: int = 3) -> Column:
    """Lower-cased alphabetic runs of at least ``min_length`` characters."""
    return F.regexp_extract_all(F.lower(col), F.lit(r"\p{L}{%d,}" % min_length), F.lit(0))


def ngrams_1_2(tokens: Column) -> Column:
    """The tokens followed by their adjacent pairs."""
    pairs = F.zip_with(F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))),
                       F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))),
                       lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(tokens, pairs)


def clean_tokens(col: Column, stop_words: Sequence[str], min_length: int = 3) -> Column:
    parts = F.split(F.regexp_replace(col, r"[^\p{L}\p{N}_\s]", " "), r"\s+")
    keep = F.filter(parts, lambda w: F.length(w) >= min_length)
    if stop_words:
        keep = F.filter(keep, lambda w: ~w.isin(*stop_words))
    return keep


def clean_text(col: Column, stop_words: Sequence[str], min_length: int = 3) -> Column:
    return F.array_join(clean_tokens(col, stop_words, min_length), " ")


def text_corpus(*cols: Column) -> Column:
    return F.lower(F.concat_ws(" ", *cols))


def parse_list_literal(col: Column, comma_fallback: bool = False) -> Column:
    """Array from list text such as ``['a', "l'b"]``; malformed text gives an empty array.

    With ``comma_fallback`` text that is no list literal is split on commas instead.
    """
    parsed = F.from_json(col, "array<string>")
    empty = F.array().cast("array<string>")
    if comma_fallback:
        pieces = F.filter(F.transform(F.split(col, ","), lambda x: F.trim(x)), lambda x: x != "")
        return F.coalesce(parsed, F.when(~F.startswith(F.trim(col), F.lit("[")), pieces), empty)
    return F.coalesce(parsed, empty)


def split_list(col: Column) -> Column:
    """Comma list to trimmed non-empty items (NULL stays NULL)."""
    return F.filter(F.transform(F.split(col, ","), lambda x: F.trim(x)), lambda x: x != "")


def comma_count(col: Column) -> Column:
    """Number of comma-separated items, 0 for NULL."""
    return F.when(col.isNull(), F.lit(0)).otherwise(F.size(F.split(col, ",")))


def clean_json_reply(col: Column) -> Column:
    """The JSON text of a service reply without its Markdown code fence."""
    opened = F.regexp_replace(F.trim(F.regexp_replace(col, r"^\s+|\s+$", "")), r"^```(?:json)?\s*", "")
    return F.regexp_replace(opened, r"\s*```$", "")


def parse_json_reply(col: Column) -> Column:
    """Extraction struct of a reply; NULL where the reply is not a JSON object."""
    text = clean_json_reply(col)
    return F.when(text.rlike(r"(?s)^\{.*\}$"), F.from_json(text, EXTRACTION))


# Interface phrases that carry no offer content.
UI_PHRASES = (
    "Aller au contenu principal",
    "Complétez votre profil",
    "Téléchargez l'app",
    "Postuler",
    "Lire dans l'app",
    "Mon espace",
    "Hellowork",
)


def strip_noise(col: Column, phrases: Sequence[str] = UI_PHRASES, max_chars: int | None = None) -> Column:
    """Text without tags, URLs and interface phrases, one space between words."""
    plain = F.regexp_replace(F.regexp_replace(col, r"<[^>]+>", ""), r"https?://\S+", "")
    if phrases:
        plain = F.regexp_replace(plain, "(?iu)" + "|".join(phrases), "")
    plain = collapse_spaces(plain)
    return plain if max_chars is None else F.substring(plain, 1, max_chars)
