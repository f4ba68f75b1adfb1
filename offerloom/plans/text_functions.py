"""Identifiers, slugs, page patterns, categories, regions and skill extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.functions import geo, offers as fo, text, web
from offerloom.operators import labels, lists, skills as sk
from offerloom.operators.tfidf import group_terms
from offerloom.plans.bindings import (COMPANIES, DEPARTMENTS, JOB_CATEGORIES, LEXICON, LEXICON_ENTRIES, LOCATIONS,
                                      REGIONS, STOP_WORDS, TITLES, documents, pick, pick_sql, quoted, skills, sql_list,
                                      table)
from offerloom.plans.aggregations import CLEAN_SQL
from offerloom.plans.projections import ORDERS_KEY, keyed
from offerloom.plans.registry import query

K = "o_orderkey"


@query("content_uid", f"""{ORDERS_KEY}md5(lower(coalesce({pick_sql(K, TITLES)}, '') || '|' || coalesce({pick_sql(K, COMPANIES)}, '')
  || '|' || coalesce({pick_sql(K, LOCATIONS)}, ''))) AS uid FROM orders""")
def content_uid(spark, d):
    return keyed(spark, d, fo.content_uid(pick(K, TITLES), pick(K, COMPANIES), pick(K, LOCATIONS)).alias("uid"))


@query("source_uid", f"{ORDERS_KEY}'FT_' || o_orderkey AS uid FROM orders")
def source_uid(spark, d):
    return keyed(spark, d, fo.source_uid("FT", F.col(K).cast("string")).alias("uid"))


@query("hash_uid_id_source", f"{ORDERS_KEY}md5(o_orderkey || o_orderstatus || {pick_sql(K, TITLES)}) AS uid FROM orders")
def hash_uid_id_source(spark, d):
    return keyed(spark, d, fo.id_source_uid(F.col(K), F.col("o_orderstatus"), pick(K, TITLES)).alias("uid"))


@query("strip_accents", "SELECT doc_id, trim(lower(translate(strip_accents(text), '-''', '  '))) AS folded FROM documents")
def strip_accents(spark, d):
    return documents(spark, d).select("doc_id", text.fold_place(F.col("text")).alias("folded"))


@query("slugify", r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(strip_accents(lower(trim(text))),
  '[^a-z0-9\s-]', ' ', 'g'), '[\s-]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM documents""")
def slugify(spark, d):
    return documents(spark, d).select("doc_id", text.slugify(F.col("text")).alias("slug"))


@query("set_query_param", r"""SELECT page_id, regexp_extract(url, '^[^?#]*') || '?' ||
  CASE WHEN url LIKE '%?utm_source=feed%' THEN 'utm_source=feed&' ELSE '' END || 'page=7&tri=date+du+jour'
  || regexp_extract(url, '#.*$') AS url FROM pages""")
def set_query_param(spark, d):
    changed = web.set_query_param(F.col("url"), {"page": "7", "ref": None, "tri": "date du jour"})
    return table(spark, d, "pages").select("page_id", changed.alias("url"))


MODES = ("emploi", "Stage ", "alternance", "autre", None)
KEYWORDS = ("Data Engineer", "Développeur  C++", "  ", "chef d'équipe")
CITIES = (None, "Saint-Étienne", " Paris ", "")
POSTALS = ("42000", None, "75001")
MODE_SQL = f"coalesce(nullif({pick_sql(K, ('emploi', 'stage', 'alternance', 'emploi', 'emploi'))}, ''), 'emploi')"
SLUG_SQL = pick_sql(K, ("data-engineer", "developpeur-c", None, "chef-d-equipe"))
CITY_SQL = pick_sql(K, (None, "saint-etienne", "paris", None))
POSTAL_SQL = pick_sql(K, ("-42000", "", "-75001"))


@query("listing_url", f"""{ORDERS_KEY}'https://offres.example/fr-fr/' || {MODE_SQL} || '/metier_' || {SLUG_SQL} ||
  coalesce('-ville_' || {CITY_SQL} || {POSTAL_SQL}, '') || '.html' AS url FROM orders""")
def listing_url(spark, d):
    return keyed(spark, d, web.listing_url("https://offres.example", pick(K, MODES), pick(K, KEYWORDS), pick(K, CITIES),
                                           pick(K, POSTALS)).alias("url"))


PAGE_TEXTS = (
    "Technicien Saint-Étienne - 42 CDI 35 000 - 45 000 € / an télétravail partiel il y a 3 jours",
    "Offre d'intérim à Lyon, 12 € / heure, pas de télétravail, publiée il y a 5 heures",
    "Rien à signaler ici",
    "alternance Télétravail  complet Le Havre - 76 moins d'une heure",
    "freelance 2 500 €/mois TÉLÉTRAVAIL occasionnel",
    "CDDX indéfini, télétravailler, il y a longtemps",
)
# The location pattern is greedy, so the first phrase runs on to the last "- NN".
PAGE_LOCATION = ("Technicien Saint-Étienne - 42 CDI 35 000 - 45", None, None, "Télétravail  complet Le Havre - 76", None, None)
PAGE_CONTRACT = ("CDI", "intérim", None, "alternance", "freelance", None)
PAGE_SALARY = ("35 000 - 45 000 € / an", "12 € / heure", None, None, "2 500 €/mois", None)
PAGE_REMOTE = ("hybrid", "no", "unknown", "yes", "hybrid", "unknown")
PAGE_AGE = ("il y a 3 jours", "il y a 5 heures", None, "moins d'une heure", None, None)


@query("regex_location", f"{ORDERS_KEY}{pick_sql(K, PAGE_LOCATION)} AS location FROM orders")
def regex_location(spark, d):
    return keyed(spark, d, web.page_location(pick(K, PAGE_TEXTS)).alias("location"))


@query("regex_contract", f"{ORDERS_KEY}{pick_sql(K, PAGE_CONTRACT)} AS contract FROM orders")
def regex_contract(spark, d):
    return keyed(spark, d, web.page_contract(pick(K, PAGE_TEXTS)).alias("contract"))


@query("regex_salary", f"{ORDERS_KEY}{pick_sql(K, PAGE_SALARY)} AS salary FROM orders")
def regex_salary(spark, d):
    return keyed(spark, d, web.page_salary(pick(K, PAGE_TEXTS)).alias("salary"))


@query("regex_remote", f"{ORDERS_KEY}{pick_sql(K, PAGE_REMOTE)} AS remote FROM orders")
def regex_remote(spark, d):
    return keyed(spark, d, web.page_remote(pick(K, PAGE_TEXTS)).alias("remote"))


@query("regex_relative_date", f"""{ORDERS_KEY}{pick_sql(K, PAGE_AGE)} AS age, strftime(o_orderdate -
  CASE {pick_sql(K, PAGE_AGE)} WHEN 'il y a 3 jours' THEN INTERVAL 3 DAY WHEN 'il y a 5 heures' THEN INTERVAL 5 HOUR
  WHEN 'moins d''une heure' THEN INTERVAL 0 HOUR END, '%Y-%m-%d %H:%M:%S') AS published FROM orders""")
def regex_relative_date(spark, d):
    age = web.page_relative_date(pick(K, PAGE_TEXTS))
    stamped = web.relative_timestamp(age, F.col("o_orderdate"))
    return keyed(spark, d, age.alias("age"), F.date_format(stamped, "yyyy-MM-dd HH:mm:ss").alias("published"))


@query("url_offer_id", f"{ORDERS_KEY}CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS offer_id FROM orders")
def url_offer_id(spark, d):
    path = F.when(F.col("o_custkey") % 3 == 0, F.lit("/societe/")).otherwise(F.lit("/fr-fr/emplois/"))
    url = F.concat(F.lit("https://offres.example"), path, F.col("o_custkey").cast("string"), F.lit(".html?x=1"))
    return keyed(spark, d, web.url_offer_id(url).alias("offer_id"))


@query("strip_noise", r"""SELECT doc_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  '<b>Postuler</b> ' || text || ' MON ESPACE https://x.example/a?b ', '<[^>]+>', '', 'g'), 'https?://\S+', '', 'g'),
  '(?i)aller au contenu principal|postuler|lire dans l''app|mon espace|hellowork', '', 'g'), '\s+', ' ', 'g'))
  AS description FROM documents""")
def strip_noise(spark, d):
    noisy = F.concat(F.lit("<b>Postuler</b> "), F.col("text"), F.lit(" MON ESPACE https://x.example/a?b "))
    return documents(spark, d).select("doc_id", text.strip_noise(noisy).alias("description"))


@query("categorize_job", f"WITH r AS (SELECT o_orderkey AS offer_key, lower(concat_ws(' ', {pick_sql(K, TITLES)}, "
       f"{pick_sql(K, PAGE_TEXTS)})) AS t FROM orders) SELECT offer_key, CASE "
       + " ".join("WHEN " + " OR ".join(f"contains(t, {quoted(k)})" for k in ks) + f" THEN '{c}'" for c, ks in JOB_CATEGORIES)
       + " ELSE 'other' END AS category FROM r")
def categorize_job(spark, d):
    return keyed(spark, d, fo.categorize_job(pick(K, TITLES), pick(K, PAGE_TEXTS), JOB_CATEGORIES).alias("category"))


# Region index of each location in LOCATIONS (None: no region).
LOCATION_REGION = (0, 1, 5, None, 2, 1, 2, None, None, None, 2, 1, 3, 0, 4, 0)


def _region_values(attribute):
    return tuple(None if i is None else getattr(REGIONS[i], attribute) for i in LOCATION_REGION)


GEO_SQL = (f"""{ORDERS_KEY}{pick_sql(K, _region_values('name'))} AS region,
  CAST({pick_sql(K, _region_values('lat'))} AS DOUBLE) AS lat, CAST({pick_sql(K, _region_values('lon'))} AS DOUBLE) AS lon
FROM orders""")


@query("geo_region", GEO_SQL)
def geo_region(spark, d):
    located = keyed(spark, d, geo.geo_region(pick(K, LOCATIONS), REGIONS, DEPARTMENTS).alias("g"))
    return located.select("offer_key", "g.region", "g.lat", "g.lon")


@query("geo_region_listed", GEO_SQL)
def geo_region_listed(spark, d):
    """The reference as tables, which may be of any size."""
    rows = [(c, "city", r.name, r.lat, r.lon) for r in REGIONS for c in r.cities] + [(r.name, "region", r.name, r.lat, r.lon) for r in REGIONS]
    places = spark.createDataFrame([(p, k, n, float(x), float(y), i) for i, (p, k, n, x, y) in enumerate(rows)],
                                   "place string, kind string, region string, lat double, lon double, rank long")
    codes = spark.createDataFrame(list(DEPARTMENTS.items()), "code string, region string")
    located = keyed(spark, d, pick(K, LOCATIONS).alias("location"))
    return lists.locate(located, "location", places, codes).drop("location")


@query("normalize_skill_text", r"""SELECT doc_id, trim(regexp_replace(regexp_replace(text || '  N.L.P  et A.B.C.D', '\s+', ' ', 'g'),
  '([A-Z])\.([A-Z])\.([A-Z])', '\1\2\3', 'g')) AS normalized FROM documents""")
def normalize_skill_text(spark, d):
    marked = F.concat(F.col("text"), F.lit("  N.L.P  et A.B.C.D"))
    return documents(spark, d).select("doc_id", text.normalize_skill_text(marked).alias("normalized"))


ALIASES = {"red bolt": ("rb", "bolt rouge"), "old-anvil": ("rb",)}


@query("lexicon_expand", """WITH e AS (SELECT p_partkey AS rank,
  CASE p_partkey % 3 WHEN 0 THEN replace(p_name, ' ', '-') WHEN 1 THEN replace(p_name, ' ', '.') ELSE p_name END AS canonical,
  CASE WHEN p_type IN ('ECONOMY', 'STANDARD', 'PROMO') THEN 'competences' ELSE 'savoir_etre' END AS type,
  CASE WHEN p_brand = 'Brand#1' THEN 'certifications' ELSE p_brand END AS category FROM part),
c AS (SELECT canonical AS term, canonical, arg_max(type, rank) AS type, arg_max(category, rank) AS category,
  max(rank) AS rank FROM e GROUP BY canonical),
v AS (SELECT *, unnest(CASE WHEN contains(canonical, '.') THEN [replace(canonical, '.', '')]
  WHEN contains(canonical, '-') THEN list_concat(CASE WHEN canonical = 'old-anvil' THEN ['rb'] ELSE [] END,
    [replace(canonical, '-', ' '), replace(canonical, '-', '')])
  WHEN canonical = 'red bolt' THEN ['rb', 'bolt rouge'] ELSE [] END) AS term FROM e
  WHERE type = 'competences' AND category <> 'certifications'),
f AS (SELECT term, arg_min(canonical, rank) AS canonical, arg_min(type, rank) AS type,
  arg_min(category, rank) AS category, min(rank) AS rank FROM v GROUP BY term)
SELECT * FROM c UNION ALL SELECT * FROM f WHERE term NOT IN (SELECT term FROM c)""")
def lexicon_expand(spark, d):
    key = F.col("skill_key") % 3
    name = F.when(key == 0, F.replace("skill_name", F.lit(" "), F.lit("-"))) \
        .when(key == 1, F.replace("skill_name", F.lit(" "), F.lit("."))).otherwise(F.col("skill_name"))
    category = F.when(F.col("skill_category") == "Brand#1", F.lit("certifications")).otherwise(F.col("skill_category"))
    entries = skills(spark, d).select(F.col("skill_key").alias("rank"), name.alias("canonical"),
                                      F.col("skill_type").alias("type"), category.alias("category"))
    return sk.expand_lexicon_table(entries, ALIASES)


# SQL twin of the extraction: running offsets by window sums, terms as runs of 1, 3 or 5 pieces.
_LEXICON_ROWS = ", ".join(
    f"({quoted(t.term.lower())}, {len(sk._pieces(t.term))}, {quoted(t.canonical)}, {quoted(t.type)}, "
    f"{quoted(t.category)}, {t.rank})" for t in LEXICON)
_CUES = " OR ".join(f"contains(ctx, {quoted(c)})" for c in sk.CUE_WORDS)
EXTRACT_SQL = rf"""
WITH n AS (SELECT doc_id, trim(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'),
    '([A-Z])\.([A-Z])\.([A-Z])', '\1\2\3', 'g')) AS t FROM documents),
p AS (SELECT doc_id, unnest(regexp_extract_all(t, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]')) AS w,
    generate_subscripts(regexp_extract_all(t, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_]'), 1) AS i FROM n),
o AS (SELECT *, CAST(coalesce(sum(length(w)) OVER (PARTITION BY doc_id ORDER BY i
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
    lead(w, 1) OVER d AS w1, lead(w, 2) OVER d AS w2, lead(w, 3) OVER d AS w3, lead(w, 4) OVER d AS w4
  FROM p WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
l AS (SELECT * FROM (VALUES {_LEXICON_ROWS}) AS v(term, n, canonical, type, category, rank)),
m AS (SELECT doc_id, w, start, l.* FROM o JOIN l ON l.n = 1 AND l.term = lower(w)
  UNION ALL SELECT doc_id, w, start, l.* FROM o JOIN l ON l.n = 3 AND l.term = lower(w || w1 || w2)
  UNION ALL SELECT doc_id, w, start, l.* FROM o JOIN l ON l.n = 5 AND l.term = lower(w || w1 || w2 || w3 || w4)),
x AS (SELECT *, lower(substr(t, greatest(start - 50, 0) + 1, start - greatest(start - 50, 0) + length(term) + 50)) AS ctx FROM m JOIN n USING (doc_id)),
s AS (SELECT *, round(least(1.0, 0.7 + CASE WHEN start < 500 THEN 0.2 ELSE 0 END
    + CASE WHEN upper(substr(w, 1, 1)) = substr(w, 1, 1) AND lower(substr(w, 1, 1)) <> substr(w, 1, 1) THEN 0.1 ELSE 0 END
    + CASE WHEN {_CUES} THEN 0.05 ELSE 0 END), 6) AS c FROM x),
e AS (SELECT doc_id, canonical AS skill, arg_min(type, rank) AS type, arg_min(category, rank) AS category,
    CAST(max(c) AS DOUBLE) AS confidence FROM s GROUP BY doc_id, canonical)
"""


def extracted(spark, d):
    return sk.extract_skills(documents(spark, d), LEXICON, "doc_id", "text")


@query("extract_skills", EXTRACT_SQL + "SELECT doc_id, skill, type, category FROM e")
def extract_skills(spark, d):
    return extracted(spark, d).select("doc_id", "skill", "type", "category")


@query("skill_confidence", EXTRACT_SQL + "SELECT doc_id, skill, confidence FROM e")
def skill_confidence(spark, d):
    return extracted(spark, d).select("doc_id", "skill", "confidence")


@query("skills_by_type", EXTRACT_SQL + """SELECT doc_id,
  coalesce(string_agg(skill, '|' ORDER BY confidence DESC, skill) FILTER (type = 'competences'), '') AS competences,
  coalesce(string_agg(skill, '|' ORDER BY confidence DESC, skill) FILTER (type = 'savoir_etre'), '') AS savoir_etre,
  CAST(count(*) AS INTEGER) AS skills_count FROM e GROUP BY doc_id""")
def skills_by_type(spark, d):
    rows = sk.skills_by_type(extracted(spark, d), "doc_id")
    return rows.select("doc_id", F.array_join("competences", "|").alias("competences"),
                       F.array_join("savoir_etre", "|").alias("savoir_etre"), "skills_count")


@query("skills_by_category", EXTRACT_SQL + """SELECT doc_id, category, string_agg(skill, '|' ORDER BY skill) AS skills
FROM e GROUP BY doc_id, category""")
def skills_by_category(spark, d):
    rows = sk.skills_by_category(extracted(spark, d), "doc_id")
    return rows.select("doc_id", F.explode("skills_by_category").alias("category", "names")) \
        .select("doc_id", "category", F.array_join("names", "|").alias("skills"))


@query("clean_text", f"SELECT doc_id, array_to_string({CLEAN_SQL}, ' ') AS cleaned FROM documents")
def clean_text(spark, d):
    return documents(spark, d).select("doc_id", text.clean_text(F.lower("text"), STOP_WORDS).alias("cleaned"))


@query("tokenize", r"SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '\p{L}{3,}'), ' ') AS tokens FROM documents")
def tokenize(spark, d):
    return documents(spark, d).select("doc_id", F.array_join(text.tokenize(F.col("text")), " ").alias("tokens"))


HARD_LISTS = ("['Power BI', 'SQL']", "[]", None, "['C++ avancé']")
SOFT_LISTS = ("['esprit d''équipe']", None, "['Rigueur', 'Écoute active']")
HARD_TEXT = ("Power BI SQL", "", "", "C++ avancé")
SOFT_TEXT = ("esprit d''équipe", "", "Rigueur Écoute active")


@query("build_skill_documents", f"""WITH r AS (SELECT o_orderkey AS offer_key, trim({pick_sql(K, HARD_TEXT)} || ' ' ||
  {pick_sql(K, SOFT_TEXT).replace("d''''équipe", "d équipe")}) AS document FROM orders)
SELECT offer_key, document, array_to_string(regexp_extract_all(lower(document), '[\\p{{L}}\\p{{N}}_]+'), '|') AS tokens FROM r""")
def build_skill_documents(spark, d):
    soft = tuple(None if v is None else v.replace("d''équipe", "d équipe") for v in SOFT_LISTS)
    rows = keyed(spark, d, text.parse_list_literal(pick(K, HARD_LISTS)).alias("competences"),
                 text.parse_list_literal(pick(K, soft)).alias("savoir_etre"))
    built = sk.skill_documents(rows, "offer_key", "competences", "savoir_etre")
    return built.select("offer_key", "document", F.array_join("tokens", "|").alias("tokens"))


RULES = labels.LabelRules(
    lexicon=("thon", "ther", "thin", "avec", "nicht", "erin", "une", "los", "ent"),
    families=(("Famille th", ("thon", "ther")), ("Famille fr", ("avec", "une")), ("Famille de", ("nicht",))),
    insights=(("Insight in", ("thin", "erin")), ("Insight es", ("los",))),
    excluded=("ent",),
)
_LEX = sorted(set(RULES.lexicon) - set(RULES.excluded))


def _rule_sql(rules) -> str:
    parts = ", ".join(f"CASE WHEN list_has_any(detected, [{sql_list(s)}]) THEN {quoted(n)} END" for n, s in rules)
    return f"[x for x in [{parts}] if x IS NOT NULL]"


def _occ(text_col: str, needle: str) -> str:
    return f"((length({text_col}) - length(replace({text_col}, {needle}, ''))) // length({needle}))"


@query("label_cluster", f"""
WITH w AS (SELECT source AS cluster_id, unnest({CLEAN_SQL}) AS term FROM documents),
c AS (SELECT cluster_id, term, count(*) AS n FROM w GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY n DESC, term) AS r FROM c),
t AS (SELECT cluster_id, list(term ORDER BY term) AS terms FROM k WHERE r <= 15 GROUP BY 1),
d AS (SELECT source AS cluster_id, split_part(text, chr(10), 1) AS title,
  row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents),
u AS (SELECT cluster_id, lower(string_agg(title, ' ' ORDER BY title)) AS title_text FROM d WHERE r <= 20 GROUP BY 1),
z AS (SELECT source AS cluster_id, count(*) AS n_docs FROM documents GROUP BY 1),
j AS (SELECT cluster_id, n_docs, terms, title_text, array_to_string(terms, ' ') AS terms_text,
  [s for s in [{sql_list(_LEX)}] if list_contains(terms, s) OR contains(title_text, s)] AS detected
  FROM z JOIN t USING (cluster_id) JOIN u USING (cluster_id)),
s AS (SELECT cluster_id, skill, 2 * {_occ('title_text', 'skill')} + {_occ('terms_text', 'skill')} AS score
  FROM (SELECT *, unnest(detected) AS skill FROM j)),
b AS (SELECT cluster_id, list(skill ORDER BY score DESC, skill)[1:5] AS top FROM s GROUP BY 1),
f AS (SELECT j.*, coalesce(top, []) AS top, {_rule_sql(RULES.families)} AS fam, {_rule_sql(RULES.insights)} AS ins
  FROM j LEFT JOIN b USING (cluster_id))
SELECT cluster_id, n_docs, array_to_string(top, '|') AS top_skills,
  CASE WHEN len(detected) = 0 THEN 'Profil Technique Polyvalent' ELSE 'Expert ' || array_to_string(
    [upper(x[1]) || substr(x, 2) for x in top[1:3]], ' • ') END AS label,
  CASE WHEN len(fam) = 0 THEN 'IT Généraliste' ELSE array_to_string(fam, '|') END AS families,
  array_to_string(ins, '|') AS insights, CAST(least(len(detected) / 10.0, 1.0) AS DOUBLE) AS confidence,
  CAST(len(detected) * 5 + greatest(len(fam), 1) * 10 AS INTEGER) AS complexity FROM f""")
def label_cluster(spark, d):
    docs = documents(spark, d).select("doc_id", F.col("source").alias("cluster_id"), "text")
    terms = group_terms(docs, text.clean_tokens(F.lower("text"), STOP_WORDS), "cluster_id", 15)
    titles = docs.select("doc_id", "cluster_id", F.substring_index("text", "\n", 1).alias("title"))
    sizes = docs.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n_docs"))
    labelled = labels.label_clusters(terms, titles, sizes, "cluster_id", RULES, [F.asc("doc_id")])
    return labelled.select("cluster_id", "n_docs", F.array_join("top_skills", "|").alias("top_skills"), "label",
                           F.array_join("families", "|").alias("families"),
                           F.array_join("insights", "|").alias("insights"), "confidence", "complexity")
