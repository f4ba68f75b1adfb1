"""The analytic roles (offers, bridge, skills, ...) bound to the generic test tables.

Wordings the tables lack (contract, remote, location, ...) are element ``key % size``
of a fixed list; :func:`pick` builds the Spark expression and :func:`pick_sql` the SQL one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.functions.geo import Region
from offerloom.operators.skills import Entry, expand_lexicon
from offerloom.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(key: str, values: Sequence[str | None]) -> Column:
    items = F.array(*[F.lit(v).cast("string") for v in values])
    return F.get(items, F.pmod(F.col(key), F.lit(len(values))).cast("int"))


def quoted(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def pick_sql(key: str, values: Sequence) -> str:
    cases = " ".join(f"WHEN {i} THEN {quoted(v) if v is None or isinstance(v, str) else v}"
                     for i, v in enumerate(values))
    return f"(CASE {key} % {len(values)} {cases} END)"


def sql_list(values: Sequence[str]) -> str:
    return ", ".join(quoted(v) for v in values)


TITLES = (
    "Data Engineer Spark", "Data Scientist NLP", "Développeur Java", "Analyste décisionnel",
    "Chef de projet", "ML Engineer", "Architecte Big Data", "Consultant GPT et RAG",
    "Ingénieur machine learning", "Comptable", "Business Intelligence développeur",
)
CONTRACTS = (
    "CDI", "cdd 6 mois", "Contrat à durée indéterminée", "contrat à durée déterminée",
    "Stage de fin d'études", "Contrat d'apprentissage", "Mission intérim", "Travail temporaire",
    "Freelance", " vacation ", None, "", "INDÉTERMINÉE", "Indépendant", "professionnalisation",
)
REMOTES = ("Oui", " complet ", "NON", "sur site", "Hybride", "partiel", "parfois", None, "", "remote", "occasionnel")
SALARIES = (" 45k € ", None, "", "2 500 € / mois", "38000-42000", "selon profil ")
LOCATIONS = (
    "69 - Lyon", "75001 Paris", "2A - Ajaccio", "-", "Saint-Paul", "Île-de-France",
    "Bordeaux, Nouvelle-Aquitaine", "Zone inconnue", None, "", "Pau", "L'Haÿ-les-Roses, 94",
    "Région Grand Est", "lyon 3e", "Marseille (13)", "Saint-Étienne, Loire, ",
)
COMPANIES = ("Acme", None, "Beta SARL", "", "Gamma & Fils", "Delta", " Epsilon ")
DATES = ("2024-01-15", "2024-02-30", "il y a 3 jours", None, "2023-12-01 08:30:00", "", "2024-03-09T10:15:00")
SKILL_TEXTS = ("Python,SQL", " SQL , Power BI", None, "Communication", "", "python, Spark ,Kafka,SQL", "Rigueur,SQL,Docker")
LIST_TEXTS = ("['a', \"l'b\"]", "[]", "oops", None, "['x']", "[\"p\", \"q r\"]", "['un', 'deux', 'trois']")

# Small reference tables of our own, in the shape of the parameter tables.
REGIONS = (
    Region("Auvergne-Rhône-Alpes", 45.75, 4.85, ("Lyon", "Grenoble", "Saint-Étienne")),
    Region("Île-de-France", 48.85, 2.35, ("Paris", "Versailles")),
    Region("Nouvelle-Aquitaine", 44.84, -0.58, ("Bordeaux", "Pau")),
    Region("Grand Est", 48.58, 7.75, ("Strasbourg", "Reims")),
    Region("Provence-Alpes-Côte d'Azur", 43.3, 5.37, ("Marseille", "Nice")),
    Region("Corse", 41.93, 8.74, ("Ajaccio", "Bastia")),
)
DEPARTMENTS = {
    "69": "Auvergne-Rhône-Alpes", "42": "Auvergne-Rhône-Alpes", "75": "Île-de-France", "94": "Île-de-France",
    "33": "Nouvelle-Aquitaine", "67": "Grand Est", "13": "Provence-Alpes-Côte d'Azur",
}
JOB_CATEGORIES = (
    ("data_science", ("data scientist", "machine learning", "nlp")),
    ("data_engineering", ("data engineer", "big data", "spark")),
    ("data_analysis", ("business intelligence", "décisionnel")),
    ("gen_ai", ("gpt", "rag")),
)
RELEVANCE_WORDS = ("data", "spark", "nlp", "machine learning", "décisionnel", "gpt")
STOP_WORDS = (
    "the", "and", "that", "for", "was", "with", "this", "are", "from", "les", "des", "que", "une",
    "est", "pour", "par", "dans", "qui", "der", "die", "und", "den", "von", "das", "mit", "los", "las", "del",
)

# Lexicon of words that occur in the prose of the test documents, with overlapping entries.
LEXICON_ENTRIES = (
    Entry("thon", "competences", "alpha"),
    Entry("ther", "competences", "alpha"),
    Entry("the ther", "competences", "beta"),
    Entry("of the", "competences", "beta"),
    Entry("of the thon", "competences", "gamma"),
    Entry("nicht", "competences", "langue"),
    Entry("avec", "competences", "langue"),
    Entry("que la", "competences", "langue"),
    Entry("an-an", "competences", "delta"),
    Entry("erin", "savoir_etre", "soft"),
    Entry("onan", "savoir_etre", "soft"),
    Entry("für", "savoir_etre", "soft"),
    Entry("thou", "competences", "certifications"),
    Entry("ther", "savoir_etre", "soft"),
)
LEXICON = tuple(expand_lexicon(LEXICON_ENTRIES, {"thon": ("thin",), "avec": ("dans la",)}))

HARD_TYPES = ("ECONOMY", "STANDARD", "PROMO")

# SQL twins of the bindings below, as common table expressions.
CTE = {
    "bridge": "bridge AS (SELECT DISTINCT l_orderkey AS offer_key, l_partkey AS skill_key FROM lineitem)",
    "skills": f"""skills AS (SELECT p_partkey AS skill_key, p_name AS skill_name,
        CASE WHEN p_type IN ({sql_list(HARD_TYPES)}) THEN 'competences' ELSE 'savoir_etre' END AS skill_type,
        p_brand AS skill_category FROM part)""",
    "companies": """companies AS (SELECT c_custkey AS company_key, c_name AS company_name,
        r_regionkey AS region_key, r_name AS region_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)""",
    "regions": """regions AS (SELECT r_regionkey AS region_key, r_name AS region_name,
        CAST(r_regionkey * 10.5 AS DOUBLE) AS latitude, CAST(r_regionkey - 2.25 AS DOUBLE) AS longitude FROM region)""",
    "offers": f"""offers AS (SELECT o_orderkey AS offer_key, o_custkey AS company_key, company_name, region_key,
        region_name, o_orderpriority AS contract_type,
        CASE o_orderstatus WHEN 'O' THEN 'yes' WHEN 'P' THEN 'hybrid' ELSE 'no' END AS remote,
        o_totalprice AS amount, o_orderdate AS added_at, {pick_sql('o_orderkey', TITLES)} AS title,
        {pick_sql('o_orderkey', LOCATIONS)} AS location, CAST(coalesce(sc.n, 0) AS INTEGER) AS skills_count
        FROM orders LEFT JOIN companies ON o_custkey = companies.company_key
        LEFT JOIN (SELECT offer_key, count(*) AS n FROM bridge GROUP BY offer_key) sc ON o_orderkey = sc.offer_key)""",
    "links": """links AS (SELECT offer_key, skill_key, skill_name, skill_type, skill_category
        FROM bridge JOIN skills USING (skill_key))""",
    "located": """located AS (SELECT links.*, region_name, contract_type FROM links JOIN offers USING (offer_key))""",
}
CTE_ORDER = ("bridge", "skills", "companies", "regions", "offers", "links", "located")
CTE_NEEDS = {"offers": ("bridge", "companies"), "links": ("bridge", "skills"),
             "located": ("bridge", "skills", "companies", "offers", "links")}


def with_roles(*names: str, extra: str = "") -> str:
    """WITH clause of the named roles and what they depend on."""
    wanted = set(names)
    for n in names:
        wanted.update(CTE_NEEDS.get(n, ()))
    parts = [CTE[n] for n in CTE_ORDER if n in wanted]
    if extra:
        parts.append(extra)
    return "WITH " + ",\n".join(parts) + "\n"


def bridge(spark: SparkSession, d: str) -> DataFrame:
    """Distinct offer-skill pairs."""
    lines = spread(table(spark, d, "lineitem").select("l_orderkey", "l_partkey"), "l_orderkey")
    return lines.select(F.col("l_orderkey").alias("offer_key"), F.col("l_partkey").alias("skill_key")).distinct()


def skills(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("p_type").isin(*HARD_TYPES), F.lit("competences")).otherwise(F.lit("savoir_etre"))
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("skill_key"), F.col("p_name").alias("skill_name"),
        kind.alias("skill_type"), F.col("p_brand").alias("skill_category"))


def regions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "region").select(
        F.col("r_regionkey").alias("region_key"), F.col("r_name").alias("region_name"),
        (F.col("r_regionkey") * 10.5).alias("latitude"), (F.col("r_regionkey") - 2.25).alias("longitude"))


def companies(spark: SparkSession, d: str) -> DataFrame:
    nation = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, d, "region").select("r_regionkey", "r_name")
    return (table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("c_custkey").alias("company_key"), F.col("c_name").alias("company_name"),
                    F.col("r_regionkey").alias("region_key"), F.col("r_name").alias("region_name")))


def offers(spark: SparkSession, d: str, *, with_company: bool = True, with_skills: bool = False) -> DataFrame:
    """Fact rows; company attributes and the skill count only where a query needs them."""
    remote = F.when(F.col("o_orderstatus") == "O", F.lit("yes")) \
        .when(F.col("o_orderstatus") == "P", F.lit("hybrid")).otherwise(F.lit("no"))
    fact = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("offer_key"), F.col("o_custkey").alias("company_key"),
        F.col("o_orderpriority").alias("contract_type"), remote.alias("remote"),
        F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("added_at"),
        pick("o_orderkey", TITLES).alias("title"), pick("o_orderkey", LOCATIONS).alias("location"))
    if with_company:
        fact = fact.join(companies(spark, d), "company_key", "left")
    if with_skills:
        counts = bridge(spark, d).groupBy("offer_key").agg(F.count(F.lit(1)).cast("int").alias("__n"))
        fact = fact.join(counts, "offer_key", "left").withColumn("skills_count", F.coalesce("__n", F.lit(0))).drop("__n")
    return fact


def links(spark: SparkSession, d: str) -> DataFrame:
    return bridge(spark, d).join(skills(spark, d), "skill_key")


def located_links(spark: SparkSession, d: str) -> DataFrame:
    attributes = offers(spark, d).select("offer_key", "region_name", "contract_type")
    return links(spark, d).join(attributes, "offer_key")


def region_skill_counts(spark: SparkSession, d: str) -> DataFrame:
    """(region_name, skill_name, n): offers that ask for a skill by region. Links are counted by company and skill key,
    regions and names come to the counts."""
    company = table(spark, d, "orders").select(F.col("o_orderkey").alias("offer_key"), F.col("o_custkey").alias("company_key"))
    counts = bridge(spark, d).join(company, "offer_key").groupBy("company_key", "skill_key").agg(F.count(F.lit(1)).alias("n"))
    placed = counts.join(companies(spark, d).select("company_key", "region_name"), "company_key") \
        .groupBy("region_name", "skill_key").agg(F.sum("n").alias("n"))
    return placed.join(skills(spark, d).select("skill_key", "skill_name"), "skill_key") \
        .groupBy("region_name", "skill_name").agg(F.sum("n").alias("n"))


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents"), "doc_id")


def pages(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "pages"), "page_id")


def stamp(col: Column) -> Column:
    """Timestamp as text, the same in both engines."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")
