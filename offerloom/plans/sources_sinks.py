"""Scans, sinks and source parsing."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.functions.text import UI_PHRASES, words
from offerloom.operators.tfidf import group_terms
from offerloom.plans.bindings import pages as html_pages
from offerloom.plans.bindings import (CONTRACTS, DATES, LOCATIONS, SALARIES, TITLES, documents, offers, pick,
                                      pick_sql, quoted, regions, stamp, table, with_roles)
from offerloom.plans.registry import query
from offerloom.schemas import RAW_API
from offerloom.session import scratch_path
from offerloom.sources import api, files, pages

DOC_SQL = "SELECT doc_id, text, lang, source, n_chars FROM documents"


@query("scan_csv", DOC_SQL)
def scan_csv(spark, d):
    path = scratch_path(spark, "csv")
    docs = documents(spark, d)
    files.write_csv(docs, path)
    return files.read_csv(spark, path, docs.schema)


@query("scan_jsonl", "SELECT conv_id, turn, role, text FROM conversations")
def scan_jsonl(spark, d):
    path = scratch_path(spark, "jsonl")
    talks = table(spark, d, "conversations")
    files.write_jsonl(talks, path)
    return files.read_jsonl(spark, path, talks.schema)


@query("scan_json_array", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def scan_json_array(spark, d):
    path = scratch_path(spark, "json-array")
    parts = table(spark, d, "part")
    files.write_json_array(parts, path)
    return files.read_json_array(spark, path, parts.schema)


@query("scan_text_files",
       "SELECT CAST(sum(length(text) + 1) AS BIGINT) AS total_chars FROM conversations")
def scan_text_files(spark, d):
    path = scratch_path(spark, "text")
    table(spark, d, "conversations").select("text").write.text(path)
    return files.read_text_files(spark, path + "/*.txt").agg(F.sum(F.length("text")).alias("total_chars"))


@query("scan_table", with_roles("offers", "regions") + """
SELECT offer_key, title, offers.region_name, latitude, longitude, contract_type, company_name, remote,
       strftime(added_at, '%Y-%m-%d') AS added_on
FROM offers LEFT JOIN regions USING (region_key)""")
def scan_table(spark, d):
    fact = offers(spark, d).join(regions(spark, d).drop("region_name"), "region_key", "left")
    return fact.select(
        "offer_key", "title", "region_name", "latitude", "longitude", "contract_type", "company_name", "remote",
        F.date_format("added_at", "yyyy-MM-dd").alias("added_on"))


@query("sink_csv", "SELECT doc_id, text AS description FROM documents")
def sink_csv(spark, d):
    path = scratch_path(spark, "csv-out")
    export = documents(spark, d).select("doc_id", F.col("text").alias("description"))
    files.write_csv(export, path)
    return files.read_csv(spark, path, export.schema)


@query("sink_jsonl", "SELECT event_id, event_type, props, value FROM events")
def sink_jsonl(spark, d):
    path = scratch_path(spark, "jsonl-out")
    export = table(spark, d, "events").select("event_id", "event_type", "props", "value")
    files.write_jsonl(export, path)
    return files.read_jsonl(spark, path, export.schema)


@query("sink_json_records", r"""
WITH w AS (SELECT lang, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS term FROM documents),
c AS (SELECT lang, term, CAST(count(*) AS DOUBLE) AS score FROM w GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, term) AS k FROM c)
SELECT lang, term, score FROM r WHERE k <= 20""")
def sink_json_records(spark, d):
    path = scratch_path(spark, "records")
    top = group_terms(documents(spark, d), words(F.col("text")), "lang", 20) \
        .select("lang", "term", F.col("n").cast("double").alias("score"))
    files.write_json_records(top, path, "lang", "term", "score")
    nested = files.read_jsonl(spark, path, files.region_records(top, "lang", "term", "score").schema)
    return nested.select("lang", F.explode("top_terms").alias("t")).select(
        "lang", "t.term", F.col("t.tfidf_score").alias("score"))


API_PLACES = ("Lyon", "", None, "Pau")
API_COMMUNES = ("69123", "75056", "", None, "64445")
API_URLS = ("https://a.example/1", "", None)


@query("unwrap_api_json", f"""
SELECT 'france-travail-api' AS source, CAST(event_id AS VARCHAR) AS offer_id, {pick_sql('event_id', TITLES)} AS title,
  event_type AS company,
  coalesce(nullif({pick_sql('event_id', API_PLACES)}, ''), {pick_sql('event_id', API_COMMUNES)}) AS location,
  coalesce(nullif({pick_sql('event_id', DATES)}, ''), strftime(ts, '%Y-%m-%d')) AS published_date,
  coalesce(nullif({pick_sql('event_id', CONTRACTS)}, ''), 'CDD') AS contract_type,
  coalesce(nullif({pick_sql('event_id', SALARIES)}, ''), event_type) AS salary,
  coalesce(nullif({pick_sql('event_id', API_URLS)}, ''), 'https://b.example/' || event_id) AS url,
  event_type AS query, props AS description FROM events""")
def unwrap_api_json(spark, d):
    """Raw API offers arrive as JSON text with nested objects."""
    as_text = F.col("event_id").cast("string")
    reply = F.to_json(F.struct(
        as_text.alias("id"), pick("event_id", TITLES).alias("intitule"), F.col("props").alias("description"),
        pick("event_id", DATES).alias("dateCreation"),
        F.date_format("ts", "yyyy-MM-dd").alias("dateActualisation"),
        F.lit("CDD").alias("typeContrat"), pick("event_id", CONTRACTS).alias("typeContratLibelle"),
        F.struct(F.col("event_type").alias("nom")).alias("entreprise"),
        F.struct(pick("event_id", API_PLACES).alias("libelle"),
                 pick("event_id", API_COMMUNES).alias("commune")).alias("lieuTravail"),
        F.struct(pick("event_id", SALARIES).alias("libelle"),
                 F.col("event_type").alias("commentaire")).alias("salaire"),
        F.struct(pick("event_id", API_URLS).alias("urlOrigine"),
                 F.concat(F.lit("https://b.example/"), as_text).alias("url")).alias("origineOffre")))
    raw = table(spark, d, "events").select("event_type", F.from_json(reply, RAW_API).alias("o"))
    return api.unwrap_offers(raw.select("event_type", "o.*"), F.col("event_type"))


HTML_TEXT_SQL = r"""
SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(
    regexp_replace(html, '(?s)<(script|style|noscript)[^>]*>.*?</(script|style|noscript)>', '', 'g'),
    '(?s)<!--.*?-->|<!DOCTYPE[^>]*>', '', 'g'), '(?s)<[^>]+>', chr(10), 'g'),
    '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g')) AS page_text
FROM pages"""


def page_match(pattern: str) -> str:
    """The first match of a pattern between word bounds; NULL if there is none."""
    edge = r"[^\p{L}\p{M}\p{N}_]"
    return f"nullif(regexp_extract(page_text, '(?:^|{edge})({pattern})(?:$|{edge})', 1), '')"


def marker_sql(text: str, markers: tuple[str, ...], after: bool, default: str) -> str:
    """Position after (or before) the first marker, in marker order, that the text holds."""
    at = "".join(f" WHEN contains(lower({text}), {quoted(m.lower())}) THEN strpos(lower({text}), {quoted(m.lower())}) {f'+ {len(m)}' if after else '- 1'}"
                 for m in markers)
    return f"CASE{at} ELSE {default} END"


def ld_json_sql(path: str, kept: str) -> str:
    """The first text at a path of the page's JSON-LD scripts that passes the condition on x."""
    return (f"[x for x in [CASE WHEN json_valid(s) THEN trim(json_extract_string(s, '{path}')) END for s in "
            rf"""regexp_extract_all(html, '(?is)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>', 1)] if {kept}][1]""")


# SQL reads no description blocks: regular expressions do not match nested tags
@query("parse_html_pages", rf"""
WITH t AS ({HTML_TEXT_SQL.replace('SELECT page_id,', 'SELECT page_id, url, html,', 1)}),
r AS (SELECT *, substr(page_text, {marker_sql('page_text', pages.DESCRIPTION_STARTS, True, '1')}) AS rest FROM t),
d AS (SELECT *, coalesce({ld_json_sql('$.description', 'length(x) > 100')},
  substr(rest, 1, {marker_sql('rest', pages.DESCRIPTION_ENDS, False, 'length(rest)')}), '') AS long_text FROM r)
SELECT page_id, 'hellowork.com' AS source, url, nullif(regexp_extract(url, '/emplois/(\d+)\.html', 1), '') AS offer_id,
       trim(replace(regexp_extract(html, '<h1>([^<]*)</h1>', 1), '&amp;', '&')) AS title,
       {ld_json_sql('$.hiringOrganization.name', "x <> ''")} AS employer,
       trim({page_match(r"[A-ZÉÈÊÀÂÎÏÔÙÛÇ][\p{L}\p{M}\p{N}_''’\- ]+\s-\s\d{2}")}) AS location,
       {page_match("(?i:CDI|CDD|Intérim|Stage|Alternance|Freelance|Indépendant|Franchise)")} AS contract_type,
       trim({page_match(r"\d[\d\s]*(?:-\s?\d[\d\s]*)?€\s?/\s?(?i:an|mois|heure)")}) AS salary,
       CASE WHEN {page_match(r"(?i:télétravail\s+(?:complet|total))")} IS NOT NULL THEN 'yes'
            WHEN {page_match(r"(?i:télétravail\s+(?:partiel|hybride|occasionnel))")} IS NOT NULL THEN 'hybrid'
            WHEN {page_match("(?i:pas de télétravail)")} IS NOT NULL THEN 'no' ELSE 'unknown' END AS remote,
       {page_match(r"(?i:il y a \d+ (?:jour|jours|heure|heures|minute|minutes)|moins d''une heure)")} AS published_relative,
       trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(long_text, '<[^>]+>', '', 'g'), 'https?://\S+', '', 'g'),
         '(?i){'|'.join(UI_PHRASES).replace("'", "''")}', '', 'g'), '\s+', ' ', 'g')) AS description
FROM d""")
def parse_html_pages(spark, d):
    return pages.offers_from_pages(html_pages(spark, d))


@query("html_to_text", HTML_TEXT_SQL)
def html_to_text(spark, d):
    return pages.parse_pages(html_pages(spark, d)).select("page_id", "page_text")


@query("extract_description", rf"""
WITH t AS ({HTML_TEXT_SQL})
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(page_text, '<[^>]+>', '', 'g'),
       'https?://\S+', '', 'g'), '\s+', ' ', 'g')) AS description FROM t""")
def extract_description(spark, d):
    return pages.offers_from_pages(html_pages(spark, d)).select("page_id", "description")


LINK_BASE = "https://offres.example"


@query("extract_links", rf"""
WITH h AS (SELECT trim(unnest(regexp_extract_all(html, '(?i)<a\s[^>]*?href="([^"]*)"', 1))) AS href FROM pages)
SELECT DISTINCT '{LINK_BASE}' || href AS url FROM h WHERE contains(href, '/') AND href LIKE '%n'""")
def extract_links(spark, d):
    return pages.page_links(html_pages(spark, d), "html", LINK_BASE, "/", "n")


NOTICES = (
    "Poste de rédacteur\nLieu : Mairie, Lyon, Rhône\nCollectivité de Lyon",
    "Agent\nlieu de travail : Pau\nTemps complet",
    "Sans précision",
    "Collectivité A\nautre\nCollectivité B\nLieu A\nLieu B",
    "",
)
NOTICE_LOCATION = ("Lieu : Mairie, Lyon, Rhône", "lieu de travail : Pau", "", "Lieu B", "")
NOTICE_COMPANY = ("Collectivité de Lyon", "Collectivité territoriale", "Collectivité territoriale",
                  "Collectivité B", "Collectivité territoriale")
NOTICE_REGION = ("Rhône", "lieu de travail : Pau", None, "Lieu B", None)


@query("parse_listing_rows", f"""
SELECT o_orderkey AS offer_key, {pick_sql('o_orderkey', NOTICE_LOCATION)} AS location,
       {pick_sql('o_orderkey', NOTICE_COMPANY)} AS company_name, {pick_sql('o_orderkey', NOTICE_REGION)} AS region_name
FROM orders""")
def parse_listing_rows(spark, d):
    notices = table(spark, d, "orders").select(F.col("o_orderkey").alias("offer_key"),
                                               pick("o_orderkey", NOTICES).alias("notice"))
    return notices.select("offer_key", *[c.alias(n) for n, c in pages.notice_fields(F.col("notice")).items()])


@query("collect_dedup", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS k FROM lineitem WHERE l_quantity > 10)
SELECT l_orderkey AS offer_id, l_linenumber AS query_rank, l_partkey, l_suppkey FROM r WHERE k = 1""")
def collect_dedup(spark, d):
    results = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("offer_id"), F.col("l_linenumber").alias("query_rank"), "l_quantity",
        F.struct("l_partkey", "l_suppkey", "l_extendedprice").alias("seq"))
    kept = api.merge_query_results(results, "offer_id", "query_rank", "seq", F.col("l_quantity") > 10)
    return kept.select("offer_id", "query_rank", "seq.l_partkey", "seq.l_suppkey")


@query("capped_collect", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey
    ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS k FROM lineitem)
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey FROM r WHERE k <= 150""")
def capped_collect(spark, d):
    order = [F.desc("l_shipdate"), *[F.asc(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")]]
    lines = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey",
                                               "l_extendedprice", "l_shipdate")
    return api.cap_per_query(lines, "l_suppkey", order, 150).select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey")
