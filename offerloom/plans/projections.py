"""Harmonising, normalising and validating projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.functions import dates, offers as fo, text, web
from offerloom.plans.bindings import (COMPANIES, CONTRACTS, DATES, LIST_TEXTS, LOCATIONS, REMOTES, SALARIES,
                                      SKILL_TEXTS, STOP_WORDS, TITLES, documents, pick, pick_sql, quoted, stamp, table)
from offerloom.plans.registry import query
from offerloom.plans.unify import unify_a, unify_b, unify_c
from offerloom.operators import extraction, validation

ORDERS_KEY = "SELECT o_orderkey AS offer_key, "


def keyed(spark, d, *cols):
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("offer_key"), *cols)


def contract_sql(value: str) -> str:
    """SQL twin of the contract rules over a text expression."""
    w = f"trim(upper({value}))"
    tests = " ".join(
        "WHEN " + " OR ".join(f"contains({w}, {quoted(n)})" for n in needles) + f" THEN {quoted(label)}"
        for label, needles in fo.CONTRACT_WORDINGS)
    return f"CASE WHEN {value} IS NULL THEN NULL {tests} ELSE {w} END"


def remote_sql(value: str) -> str:
    tests = " ".join(f"WHEN trim(lower({value})) IN ({', '.join(quoted(x) for x in accepted)}) THEN {quoted(label)}"
                     for label, accepted in fo.REMOTE_WORDINGS.items())
    return f"CASE {tests} ELSE 'unknown' END"


K = "doc_id"


def raw_a(spark, d):
    return documents(spark, d).select(
        F.lit("A").alias("source"), F.col(K).cast("string").alias("offer_id"),
        F.concat(F.lit("https://a.example/"), F.col(K).cast("string")).alias("url"),
        pick(K, TITLES).alias("title"), pick(K, COMPANIES).alias("company"), pick(K, LOCATIONS).alias("location"),
        pick(K, DATES).alias("published_date"), pick(K, CONTRACTS).alias("contract_type"),
        pick(K, SALARIES).alias("salary"), F.col("lang").alias("query"), F.col("text").alias("description"))


def raw_b(spark, d):
    return documents(spark, d).select(
        F.lit("B").alias("source"), F.concat(F.lit("https://b.example/"), F.col(K).cast("string")).alias("url"),
        F.col(K).cast("string").alias("offer_id"), pick(K, TITLES).alias("title"),
        pick(K, COMPANIES).alias("employer"), pick(K, LOCATIONS).alias("location"),
        pick(K, CONTRACTS).alias("contract_type"), pick(K, SALARIES).alias("salary"),
        pick(K, REMOTES).alias("remote"), pick(K, DATES).alias("published_relative"),
        F.col("text").alias("description"))


def raw_c(spark, d):
    return documents(spark, d).select(
        F.lit("C").alias("source"), F.col(K).cast("string").alias("offer_id"),
        F.concat(F.lit("https://c.example/"), F.col(K).cast("string")).alias("url"), pick(K, TITLES).alias("title"),
        pick(K, COMPANIES).alias("company"), pick(K, LOCATIONS).alias("location"),
        pick(K, CONTRACTS).alias("contract_type"), pick(K, SALARIES).alias("salary"),
        pick(K, DATES).alias("published_date"), F.lit("2024-05-05").alias("created"),
        F.lit(None).cast("string").alias("query"),
        F.when(F.col("lang") == "fr", F.col("text")).alias("raw_text"), F.col("source").alias("description"))


def unified_sql(prefix: str, source: str, base: str, remote: str, published: str, query_col: str, desc: str) -> str:
    return f"""SELECT '{prefix}_' || doc_id AS uid, '{source}' AS source, 'https://{base}.example/' || doc_id AS source_url,
  CAST(doc_id AS VARCHAR) AS offer_id, {pick_sql(K, TITLES)} AS title, {pick_sql(K, COMPANIES)} AS company,
  {pick_sql(K, LOCATIONS)} AS location, {contract_sql(pick_sql(K, CONTRACTS))} AS contract_type,
  trim({pick_sql(K, SALARIES)}) AS salary, {remote} AS remote, {published} AS published_date,
  {desc} AS description, {query_col} AS query FROM documents"""


UNIFIED_A = unified_sql("FT", "France Travail", "a", "'unknown'", pick_sql(K, DATES), "lang", "text")
UNIFIED_B = unified_sql("HW", "HelloWork", "b", remote_sql(pick_sql(K, REMOTES)), pick_sql(K, DATES),
                        "CAST(NULL AS VARCHAR)", "text")
UNIFIED_C = unified_sql("AZ", "Adzuna", "c", "'unknown'", f"coalesce({pick_sql(K, DATES)}, '2024-05-05')",
                        "CAST(NULL AS VARCHAR)", "CASE WHEN lang = 'fr' THEN text ELSE source END")


@query("unify_source_a", UNIFIED_A)
def unify_source_a(spark, d):
    return unify_a(raw_a(spark, d))


@query("unify_source_b", UNIFIED_B)
def unify_source_b(spark, d):
    return unify_b(raw_b(spark, d))


@query("unify_source_c", UNIFIED_C)
def unify_source_c(spark, d):
    return unify_c(raw_c(spark, d))


@query("normalize_contract", f"{ORDERS_KEY}{contract_sql(pick_sql('o_orderkey', CONTRACTS))} AS contract FROM orders")
def normalize_contract(spark, d):
    return keyed(spark, d, fo.normalize_contract(pick("o_orderkey", CONTRACTS)).alias("contract"))


@query("normalize_remote", f"{ORDERS_KEY}{remote_sql(pick_sql('o_orderkey', REMOTES))} AS remote FROM orders")
def normalize_remote(spark, d):
    return keyed(spark, d, fo.normalize_remote(pick("o_orderkey", REMOTES)).alias("remote"))


@query("normalize_salary", f"{ORDERS_KEY}trim({pick_sql('o_orderkey', SALARIES)}) AS salary FROM orders")
def normalize_salary(spark, d):
    return keyed(spark, d, fo.normalize_salary(pick("o_orderkey", SALARIES)).alias("salary"))


@query("clean_title", f"""WITH r AS (SELECT o_orderkey AS offer_key, {pick_sql('o_orderkey', COMPANIES)} AS title,
  {pick_sql('o_orderkey', LOCATIONS)} AS company FROM orders)
SELECT offer_key, trim(title) AS title, CASE WHEN trim(company) = '' THEN 'Entreprise non précisée' ELSE company END
  AS company FROM r WHERE title IS NOT NULL AND company IS NOT NULL""")
def clean_title(spark, d):
    rows = keyed(spark, d, pick("o_orderkey", COMPANIES).alias("title"), pick("o_orderkey", LOCATIONS).alias("company"))
    return validation.clean_title(rows)


@query("region_from_location_tail", f"""WITH r AS (SELECT o_orderkey AS offer_key,
  {pick_sql('o_orderkey', LOCATIONS)} AS location FROM orders)
SELECT offer_key, trim(split_part(location, ',', -1)) AS region_name FROM r""")
def region_from_location_tail(spark, d):
    return keyed(spark, d, fo.region_from_location_tail(pick("o_orderkey", LOCATIONS)).alias("region_name"))


@query("upload_validate", f"""WITH r AS (SELECT o_orderkey AS offer_key, {pick_sql('o_orderkey', TITLES)} AS title,
  {pick_sql('o_orderkey', COMPANIES)} AS company_name, {pick_sql('o_orderkey', LOCATIONS)} AS location FROM orders)
SELECT offer_key, title, company_name, location, 'upload' AS source, '2024-06-01 00:00:00' AS added_at,
  trim(split_part(location, ',', -1)) AS region_name,
  title IS NOT NULL AND title <> '' AND company_name IS NOT NULL AND company_name <> ''
    AND location IS NOT NULL AND location <> '' AS accepted FROM r""")
def upload_validate(spark, d):
    rows = keyed(spark, d, pick("o_orderkey", TITLES).alias("title"), pick("o_orderkey", COMPANIES).alias("company_name"),
                 pick("o_orderkey", LOCATIONS).alias("location"))
    accepted, rejected = validation.validate_upload(rows, F.lit("2024-06-01 00:00:00"))
    return accepted.withColumn("accepted", F.lit(True)).unionByName(rejected.withColumn("accepted", F.lit(False)))


FORM = ("Oui", "Hybride", "Non", None, "oui")


@query("form_remote_map", f"""{ORDERS_KEY}CASE {pick_sql('o_orderkey', FORM)} WHEN 'Oui' THEN 'yes'
  WHEN 'Hybride' THEN 'hybrid' ELSE 'no' END AS remote FROM orders""")
def form_remote_map(spark, d):
    return keyed(spark, d, fo.form_remote(pick("o_orderkey", FORM)).alias("remote"))


SOURCES = ("France Travail", "HelloWork", "API france travail v2", "Adzuna", "manuel")


@query("source_type", f"""WITH r AS (SELECT o_orderkey AS offer_key, {pick_sql('o_orderkey', SOURCES)} AS s FROM orders)
SELECT offer_key, CASE WHEN lower(s) LIKE '%france travail%' THEN 'api' ELSE 'scraping' END AS source_type FROM r""")
def source_type(spark, d):
    return keyed(spark, d, fo.source_type(pick("o_orderkey", SOURCES)).alias("source_type"))


@query("derive_calendar", """SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, CAST(hour(ts) AS INTEGER) AS hour,
  dayname(ts) AS day_name, monthname(ts) AS month_name FROM events""")
def derive_calendar(spark, d):
    parts = dates.calendar(F.col("ts"))
    parts["date"] = F.date_format(parts["date"], "yyyy-MM-dd")
    return table(spark, d, "events").select("event_id", *[c.alias(n) for n, c in parts.items()])


# Months the date texts stand for; unreadable text has none.
DATE_MONTHS = ("2024-01-01", None, None, None, "2023-12-01", None, "2024-03-01")


@query("derive_year_month", f"{ORDERS_KEY}{pick_sql('o_orderkey', DATE_MONTHS)} AS year_month FROM orders")
def derive_year_month(spark, d):
    return keyed(spark, d, F.date_format(dates.year_month(pick("o_orderkey", DATES)), "yyyy-MM-dd").alias("year_month"))


@query("skills_count_from_csv", f"""WITH r AS (SELECT o_orderkey AS offer_key, {pick_sql('o_orderkey', SKILL_TEXTS)} AS s
  FROM orders) SELECT offer_key, CAST(CASE WHEN s IS NULL THEN 0 ELSE len(string_split(s, ',')) END AS INTEGER)
  AS skills_count FROM r""")
def skills_count_from_csv(spark, d):
    return keyed(spark, d, text.comma_count(pick("o_orderkey", SKILL_TEXTS)).alias("skills_count"))


@query("has_remote", f"""{ORDERS_KEY}coalesce(lower({pick_sql('o_orderkey', REMOTES)}) IN ('yes', 'oui', 'hybrid'), false)
  AS has_remote FROM orders""")
def has_remote(spark, d):
    return keyed(spark, d, fo.has_remote(pick("o_orderkey", REMOTES)).alias("has_remote"))


URLS = ("https://x.example/1", "nan", None, "", " http://y.example", "None", "ftp://z")


@query("valid_url", f"""{ORDERS_KEY}coalesce(trim({pick_sql('o_orderkey', URLS)}) LIKE 'http%', false) AS ok FROM orders""")
def valid_url(spark, d):
    return keyed(spark, d, web.valid_url(pick("o_orderkey", URLS)).alias("ok"))


@query("text_corpus", f"""{ORDERS_KEY}lower(concat_ws(' ', {pick_sql('o_orderkey', TITLES)},
  {pick_sql('o_orderkey', COMPANIES)}, {pick_sql('o_orderkey', SKILL_TEXTS)})) AS corpus FROM orders""")
def text_corpus(spark, d):
    return keyed(spark, d, text.text_corpus(pick("o_orderkey", TITLES), pick("o_orderkey", COMPANIES),
                                            pick("o_orderkey", SKILL_TEXTS)).alias("corpus"))


LIST_ITEMS = ("a|l'b", "", "", "", "x", "p|q r", "un|deux|trois")


@query("parse_list_literal", f"{ORDERS_KEY}{pick_sql('o_orderkey', LIST_ITEMS)} AS items FROM orders")
def parse_list_literal(spark, d):
    items = text.parse_list_literal(pick("o_orderkey", LIST_TEXTS))
    return keyed(spark, d, F.array_join(items, "|").alias("items"))


REPLIES = (
    '```json\n{"title": "Data", "competences": ["SQL", "R"], "experience_min": 2}\n```',
    '{"title": null, "company_name": "Acme", "salary": "40k"}',
    "désolé, pas de réponse",
    '```\n{"title": "", "location": "Pau", "savoir_etre": ["Rigueur"], "contract_type": null}\n```',
    None,
    '{"title": "cassé',
)
REPLY_TITLE = ("Data", None, None, "", None, None)
REPLY_SKILLS = ("SQL|R", None, None, None, None, None)


@query("clean_llm_json", f"""{ORDERS_KEY}{pick_sql('o_orderkey', REPLY_TITLE)} AS title,
  {pick_sql('o_orderkey', REPLY_SKILLS)} AS competences FROM orders""")
def clean_llm_json(spark, d):
    parsed = keyed(spark, d, text.parse_json_reply(pick("o_orderkey", REPLIES)).alias("x"))
    return parsed.select("offer_key", F.col("x.title").alias("title"),
                         F.array_join("x.competences", "|").alias("competences"))


# Expected merge of the replies above over an offer titled 'Ancien' at 'Lyon' with contract 'CDI'.
MERGED_TITLE = ("Data", "Ancien", "Ancien", "Ancien", "Ancien", "Ancien")
MERGED_LOCATION = ("Lyon", "Lyon", "Lyon", "Pau", "Lyon", "Lyon")
MERGED_CONTRACT = (None, None, "CDI", None, "CDI", "CDI")
MERGED_COUNT = (2, 0, 0, 1, 0, 0)


@query("merge_extraction", f"""{ORDERS_KEY}{pick_sql('o_orderkey', MERGED_TITLE)} AS title,
  {pick_sql('o_orderkey', MERGED_LOCATION)} AS location, {pick_sql('o_orderkey', MERGED_CONTRACT)} AS contract_type,
  CAST({pick_sql('o_orderkey', MERGED_COUNT)} AS INTEGER) AS skills_count FROM orders""")
def merge_extraction(spark, d):
    base = keyed(spark, d, F.lit("Ancien").alias("title"), F.lit("Acme").alias("company_name"),
                 F.lit("Lyon").alias("location"), F.lit("CDI").alias("contract_type"))
    replies = keyed(spark, d, text.parse_json_reply(pick("o_orderkey", REPLIES)).alias("extraction"))
    merged = extraction.merge_extraction(base, replies, "offer_key")
    return merged.select("offer_key", "title", "location", "contract_type", "skills_count")
