"""Lexicon-based skill extraction.

A text is cut into overlapping windows and each window into word runs and single
other characters; the pieces concatenate back to the window, so a lexicon term is a
fixed sequence of pieces.  Inside each window only positions whose piece starts a
lexicon term are kept; those few candidates are exploded and matched by an equi-join
with the lexicon.  Overlapping terms all match, and nothing is shuffled before the
per-document maximum.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.functions.text import normalize_skill_text
from offerloom.schemas import LEXICON

MAX_LEXICON_TERMS = 200_000
WINDOW_CHARS = 512
PIECE = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_]"

# The parts of the confidence score.
BASE_SCORE = 0.7
EARLY_CHARS, EARLY_BONUS = 500, 0.2
UPPER_BONUS = 0.1
CONTEXT_CHARS, CONTEXT_BONUS = 50, 0.05
CUE_WORDS = (
    "expérience", "maîtrise", "connaissance", "compétence",
    "expertise", "utilisation", "développement", "implémentation",
    "required", "must", "skill", "experience", "knowledge",
)

# Other spellings of well-known skills.
KNOWN_ALIASES = {
    "Python": ("python3", "py"),
    "JavaScript": ("JS", "javascript"),
    "TypeScript": ("TS",),
    "PostgreSQL": ("Postgres", "psql"),
    "MySQL": ("mysql",),
    "MongoDB": ("mongo",),
    "TensorFlow": ("tf",),
    "PyTorch": ("torch",),
    "Scikit-learn": ("sklearn", "scikit learn"),
    "Natural Language Processing": ("NLP",),
    "Computer Vision": ("CV",),
    "Machine Learning": ("ML",),
    "Deep Learning": ("DL",),
    "Artificial Intelligence": ("AI", "IA"),
    "Amazon Web Services": ("AWS",),
    "Google Cloud Platform": ("GCP",),
    "Microsoft Azure": ("Azure",),
    "Kubernetes": ("k8s",),
}


@dataclass(frozen=True)
class Entry:
    canonical: str
    type: str
    category: str


@dataclass(frozen=True)
class LexiconTerm:
    term: str
    canonical: str
    type: str
    category: str
    rank: int


def variants(skill: str, aliases: Mapping[str, Sequence[str]] = KNOWN_ALIASES) -> list[str]:
    """Aliases of a skill plus its spellings without dots and without hyphens."""
    found = list(aliases.get(skill, ()))
    if "." in skill:
        found.append(skill.replace(".", ""))
    if "-" in skill:
        found += [skill.replace("-", " "), skill.replace("-", "")]
    return found


def expand_lexicon(entries: Iterable[Entry],
                   aliases: Mapping[str, Sequence[str]] = KNOWN_ALIASES) -> list[LexiconTerm]:
    """Terms to look for.

    A skill listed again overwrites type and category of the earlier listing; a
    variant never replaces a term that exists already.  Only hard skills
    ('competences') outside the certifications get variants.
    """
    terms: dict[str, tuple[str, str, str]] = {}
    for e in entries:
        terms[e.canonical] = (e.canonical, e.type, e.category)
        if e.type == "competences" and e.category != "certifications":
            for v in variants(e.canonical, aliases):
                terms.setdefault(v, (e.canonical, e.type, e.category))
    return [LexiconTerm(t, c, ty, cat, i) for i, (t, (c, ty, cat)) in enumerate(terms.items())]


def lexicon_frame(spark: SparkSession, terms: Sequence[LexiconTerm]) -> DataFrame:
    if len(terms) > MAX_LEXICON_TERMS:
        raise ValueError(f"a lexicon of {len(terms)} terms is too large for a literal table")
    return spark.createDataFrame([(t.term, t.canonical, t.type, t.category, t.rank) for t in terms], LEXICON)


def _pieces(term: str) -> list[str]:
    return re.findall(r"[^\W]+|\W", term)


def _windows(texts: DataFrame, id_col: str, text_col: str, look_ahead: int) -> DataFrame:
    """Texts as overlapping windows: (id, window, core offset in the window, core length, text offset).

    The cores tile the text; each window adds the characters before and after its core
    that a match starting in the core can need.  Work per candidate is thus bounded by
    the window, however long the text is.
    """
    size = max(WINDOW_CHARS, look_ahead)
    chunks = texts.where(F.col(text_col).isNotNull()).select(
        id_col, F.regexp_extract_all(normalize_skill_text(F.col(text_col)), F.lit("(?s).{1,%d}" % size), F.lit(0))
        .alias("__c"))

    def window(core: Column, k: Column) -> Column:
        before = F.coalesce(F.right(F.get("__c", k - 1), F.lit(CONTEXT_CHARS + 1)), F.lit(""))
        after = F.coalesce(F.left(F.get("__c", k + 1), F.lit(look_ahead)), F.lit(""))
        return F.struct(F.concat(before, core, after).alias("text"), F.length(before).alias("core_start"),
                        F.length(core).alias("core_length"), (k * size).alias("offset"))

    return chunks.select(id_col, F.explode(F.transform("__c", window)).alias("w")).select(id_col, "w.*")


def find_terms(texts: DataFrame, terms: Sequence[LexiconTerm], id_col: str, text_col: str) -> DataFrame:
    """Every occurrence: id, term attributes, whether it is early, upper-case first, near a cue word."""
    spark = texts.sparkSession
    # lexicon_frame has checked the number of terms, so the broadcast is bounded.
    lexicon = lexicon_frame(spark, terms).withColumn("__key", F.lower("term"))
    first_pieces = sorted({_pieces(t.term.lower())[0] for t in terms})
    lengths = sorted({len(_pieces(t.term)) for t in terms})
    look_ahead = max(len(t.term) for t in terms) + CONTEXT_CHARS + 1
    windows = _windows(texts, id_col, text_col, look_ahead) \
        .withColumn("__p", F.regexp_extract_all("text", F.lit(PIECE), F.lit(0)))

    def joined(start: Column, length: Column) -> Column:
        return F.array_join(F.slice("__p", start, length), "")

    indexed = F.filter(F.transform("__p", lambda p, i: F.struct(p.alias("p"), i.alias("i"))),
                       lambda s: F.lower(s.p).isin(*first_pieces))
    keyed = F.transform(indexed, lambda s: F.struct(s.i.alias("i"), F.array(*[
        F.lower(F.concat_ws("", s.p, *[F.get("__p", s.i + k) for k in range(1, n)])) for n in lengths]).alias("keys")))
    # The terms are tested in place (a hash set), so that positions are computed for real matches only.
    known = sorted({t.term.lower() for t in terms})
    keyed = F.filter(F.transform(keyed, lambda s: F.struct(
        s.i.alias("i"), F.filter(s["keys"], lambda k: k.isin(*known)).alias("keys"))), lambda s: F.size(s["keys"]) > 0)
    placed = F.transform(keyed, lambda s: F.struct(F.length(joined(F.lit(1), s.i)).alias("at"), s["keys"].alias("keys")))
    inside = F.filter(placed, lambda s: (s["at"] >= F.col("core_start"))
                      & (s["at"] < F.col("core_start") + F.col("core_length")))
    rows = windows.select(id_col, "text", (F.col("offset") - F.col("core_start")).alias("base"), F.explode(inside).alias("c")) \
        .select(id_col, "text", "base", "c.at", F.explode("c.keys").alias("__key"))
    hits = rows.join(F.broadcast(lexicon), "__key").select(
        id_col, "term", "canonical", "type", "category", "rank",
        (F.col("base") + F.col("at") < EARLY_CHARS).alias("early"),
        F.substring("text", F.col("at") + 1, F.lit(1)).alias("head"),
        F.right(F.left("text", F.col("at")), F.lit(CONTEXT_CHARS)).alias("before"),
        F.substring("text", F.col("at") + F.length("term") + 1, F.lit(CONTEXT_CHARS)).alias("after"))

    # A term that starts or ends with a non-word character must not touch a word there.
    blocked_left = F.left("term", F.lit(1)).rlike(r"[^\p{L}\p{N}_]") & F.col("before").rlike(r"[\p{L}\p{N}_]$")
    blocked_right = F.right("term", F.lit(1)).rlike(r"[^\p{L}\p{N}_]") & F.col("after").rlike(r"^[\p{L}\p{N}_]")
    context = F.lower(F.concat("before", F.col("term"), F.col("after")))
    return hits.where(~blocked_left & ~blocked_right).select(
        id_col, "term", "canonical", "type", "category", "rank", "early",
        ((F.upper("head") == F.col("head")) & (F.lower("head") != F.col("head"))).alias("upper_first"),
        context.rlike("|".join(CUE_WORDS)).alias("near_cue"))


def confidence() -> Column:
    """Score of one occurrence."""
    bonus = lambda flag, value: F.when(F.col(flag), F.lit(value)).otherwise(F.lit(0.0))
    return F.round(F.least(F.lit(1.0), F.lit(BASE_SCORE) + bonus("early", EARLY_BONUS)
                           + bonus("upper_first", UPPER_BONUS) + bonus("near_cue", CONTEXT_BONUS)), 6)


def extract_skills(texts: DataFrame, terms: Sequence[LexiconTerm], id_col: str = "offer_id",
                   text_col: str = "description", min_confidence: float = 0.5) -> DataFrame:
    """One row per document and canonical skill with its best score."""
    found = find_terms(texts, terms, id_col, text_col).withColumn("confidence", confidence())
    if min_confidence > BASE_SCORE:
        found = found.where(F.col("confidence") >= min_confidence)
    best = found.groupBy(id_col, "canonical").agg(
        F.max("confidence").alias("confidence"),
        F.min(F.struct("rank", "type", "category")).alias("first"))
    return best.select(id_col, F.col("canonical").alias("skill"), F.col("first.type").alias("type"),
                       F.col("first.category").alias("category"), "confidence")


def skills_by_type(extracted: DataFrame, id_col: str) -> DataFrame:
    """Both name arrays, best score first, and the number of skills (bounded by the lexicon)."""
    def names(kind: str) -> Column:
        item = F.when(F.col("type") == kind, F.struct((-F.col("confidence")).alias("o"), F.col("skill")))
        return F.transform(F.array_sort(F.collect_list(item)), lambda x: x.skill)

    return extracted.groupBy(id_col).agg(names("competences").alias("competences"),
                                         names("savoir_etre").alias("savoir_etre"),
                                         F.count(F.lit(1)).cast("int").alias("skills_count"))


def skills_by_category(extracted: DataFrame, id_col: str) -> DataFrame:
    per_category = extracted.groupBy(id_col, "category").agg(F.array_sort(F.collect_list("skill")).alias("names"))
    return per_category.groupBy(id_col).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "names")))).alias("skills_by_category"))


def enrich_offers(offers: DataFrame, terms: Sequence[LexiconTerm], id_col: str = "uid",
                  text_col: str = "description") -> DataFrame:
    """Offers with competences, savoir_etre, skills_count and the full skill structs."""
    found = extract_skills(offers, terms, id_col, text_col)
    item = F.struct((-F.col("confidence")).alias("o"), F.col("skill").alias("name"), "category", "type", "confidence")
    structs = found.groupBy(id_col).agg(F.transform(
        F.array_sort(F.collect_list(item)),
        lambda x: F.struct(x["name"].alias("name"), x["category"].alias("category"), x["type"].alias("type"),
                           x["confidence"].alias("confidence"))).alias("skills"))
    empty = F.array().cast("array<string>")
    return offers.join(skills_by_type(found, id_col), id_col, "left").join(structs, id_col, "left") \
        .withColumns({"competences": F.coalesce("competences", empty),
                      "savoir_etre": F.coalesce("savoir_etre", empty),
                      "skills_count": F.coalesce("skills_count", F.lit(0))})


def skill_documents(offers: DataFrame, id_col: str, competences: str, savoir_etre: str) -> DataFrame:
    """One token list per offer from both skill lists; multi-word skills become several tokens."""
    empty = F.array().cast("array<string>")
    names = F.concat(F.coalesce(competences, empty), F.coalesce(savoir_etre, empty))
    text = F.array_join(names, " ")
    return offers.select(id_col, text.alias("document"),
                         F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)).alias("tokens"))


def expand_lexicon_table(entries: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """The same expansion for a lexicon kept as a table (rank, canonical, type, category)."""
    name = F.col("canonical")
    no_alias = F.array().cast("array<string>")
    known = no_alias
    if aliases:
        table = F.create_map(*[c for k, vs in aliases.items() for c in (F.lit(k), F.array(*[F.lit(v) for v in vs]))])
        known = F.coalesce(F.try_element_at(table, name), no_alias)
    dotted = F.when(F.contains(name, F.lit(".")), F.array(F.replace(name, F.lit("."), F.lit("")))).otherwise(no_alias)
    hyphened = F.when(F.contains(name, F.lit("-")), F.array(
        F.replace(name, F.lit("-"), F.lit(" ")), F.replace(name, F.lit("-"), F.lit("")))).otherwise(no_alias)
    latest = entries.groupBy("canonical").agg(F.max_by(F.struct("type", "category", "rank"), "rank").alias("e")) \
        .select(F.col("canonical").alias("term"), "canonical", "e.type", "e.category", "e.rank")
    eligible = entries.where((F.col("type") == "competences") & (F.col("category") != "certifications"))
    spelled = eligible.select(F.explode(F.concat(known, dotted, hyphened)).alias("term"),
                              F.struct("rank", "canonical", "type", "category").alias("e"))
    first = spelled.groupBy("term").agg(F.min_by("e", "e.rank").alias("e")) \
        .select("term", "e.canonical", "e.type", "e.category", "e.rank")
    return latest.unionByName(first.join(latest.select("term"), "term", "left_anti"))
