"""Per-group rankings and set comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.functions.text import tokenize, words
from offerloom.operators import ranking, sets
from offerloom.operators.tfidf import regional_terms
from offerloom.plans.bindings import documents, offers, region_skill_counts, table, with_roles
from offerloom.plans.mining import REGIONAL_SQL, word_docs
from offerloom.plans.projections import UNIFIED_A, UNIFIED_B, raw_a, raw_b
from offerloom.plans.registry import query
from offerloom.plans.unify import unify_all


@query("top_skills_per_group", with_roles("located") + """
, c AS (SELECT region_name, skill_name, count(*) AS n FROM located WHERE region_name IS NOT NULL GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY region_name ORDER BY n DESC, skill_name) AS k FROM c)
SELECT region_name, skill_name, n FROM r WHERE k <= 10""")
def top_skills_per_group(spark, d):
    counts = region_skill_counts(spark, d).where(F.col("region_name").isNotNull())
    return ranking.top_per_group(counts, ["region_name"], [F.desc("n"), F.asc("skill_name")], 10)


@query("dominant_group_per_region", """WITH r AS (SELECT c_nationkey AS nation, CAST(floor(o_totalprice / 100000) AS BIGINT) AS profile
  FROM orders JOIN customer ON o_custkey = c_custkey),
t AS (SELECT nation FROM r GROUP BY 1 ORDER BY count(*) DESC, nation LIMIT 5),
c AS (SELECT nation, profile, count(*) AS n FROM r GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY n DESC, profile) AS k,
  CAST(sum(n) OVER (PARTITION BY nation) AS BIGINT) AS group_size FROM c)
SELECT nation, profile, n, group_size, round(100.0 * n / group_size, 6) AS pct FROM k WHERE k = 1
  AND nation IN (SELECT nation FROM t)""")
def dominant_group_per_region(spark, d):
    nation = table(spark, d, "customer").select(F.col("c_custkey").alias("company_key"), F.col("c_nationkey").alias("nation"))
    rows = offers(spark, d, with_company=False).join(nation, "company_key").select(
        "nation", F.floor(F.col("amount") / 100000).alias("profile"))
    dominant = ranking.dominant_value(rows, "nation", "profile")
    return dominant.join(ranking.top_groups(rows, "nation", 5).select("nation"), "nation", "left_semi")


@query("representative_offers", """WITH r AS (SELECT o_orderpriority AS topic, o_orderkey AS offer_key, o_totalprice AS probability,
  row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS k FROM orders)
SELECT topic, offer_key, probability FROM r WHERE k <= 5""")
def representative_offers(spark, d):
    rows = offers(spark, d, with_company=False).select(F.col("contract_type").alias("topic"), "offer_key",
                                                       F.col("amount").alias("probability"))
    return ranking.representative(rows, "topic", "probability", "offer_key", 5)


@query("keep_first_by_key", """WITH r AS (SELECT md5(text) AS uid, doc_id, source,
  row_number() OVER (PARTITION BY md5(text) ORDER BY source, doc_id) AS k FROM documents)
SELECT uid, doc_id, source FROM r WHERE k = 1""")
def keep_first_by_key(spark, d):
    rows = documents(spark, d).select(F.md5("text").alias("uid"), "doc_id", "source")
    return ranking.keep_first(rows, ["uid"], [F.asc("source"), F.asc("doc_id")])


@query("union_sources", f"""WITH r AS (SELECT *, 0 AS rank FROM ({UNIFIED_A.replace(' FROM documents', ', doc_id AS seq FROM documents')})
  UNION ALL SELECT *, 1 AS rank FROM ({UNIFIED_B.replace(' FROM documents', ', doc_id AS seq FROM documents')})),
k AS (SELECT *, split_part(uid, '_', 1) || '_' || md5(description) AS key FROM r),
o AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY rank, seq) AS n FROM k)
SELECT key AS uid, source, source_url, offer_id, title, company, location, contract_type, salary, remote, published_date,
  description, query FROM o WHERE n = 1""")
def union_sources(spark, d):
    """Two sources (the third is missing); offers are numbered by their text, so copies share a uid."""
    def numbered(raw):
        return raw.withColumn("seq", F.col("offer_id").cast("bigint")).withColumn("number", F.md5("description"))

    a, b = numbered(raw_a(spark, d)), numbered(raw_b(spark, d))
    parts = [raw.withColumn("source_id", F.col("offer_id")).withColumn("offer_id", F.col("number")) for raw in (a, b)]
    merged = unify_all(parts[0], parts[1], None, "seq")
    return merged.withColumn("offer_id", F.regexp_extract("source_url", r"(\d+)$", 1))


@query("term_set_compare", REGIONAL_SQL.replace("source", "lang") + """
SELECT coalesce(a.term, b.term) AS term,
  CASE WHEN b.term IS NULL THEN 'only_left' WHEN a.term IS NULL THEN 'only_right' ELSE 'common' END AS side
FROM (SELECT term FROM top WHERE lang = 'fr') a FULL JOIN (SELECT term FROM top WHERE lang = 'es') b ON a.term = b.term""")
def term_set_compare(spark, d):
    """The leading TF-IDF terms of two groups."""
    top = regional_terms(word_docs(spark, d), "doc_id", "tokens", "lang")
    return sets.compare_terms(top.where(F.col("lang") == "fr"), top.where(F.col("lang") == "es"))


@query("profile_offer_overlap", r"""
WITH p AS (SELECT conv_id, turn, list_distinct(regexp_extract_all(lower(text), '\p{L}{3,}')) AS pt
  FROM conversations WHERE role = 'user'),
o AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '\p{L}{3,}')) AS ot FROM documents),
x AS (SELECT conv_id, turn, doc_id, list_sort([w for w in ot if list_contains(pt, w)]) AS m,
  [w for w in ot if not list_contains(pt, w)] AS s FROM p JOIN o ON conv_id = doc_id),
y AS (SELECT *, coalesce(round(100.0 * len(m) / nullif(len(m) + len(s), 0), 6), 0.0) AS score FROM x)
SELECT conv_id, turn, doc_id, array_to_string(m, '|') AS matched, CAST(len(s) AS INTEGER) AS n_missing, score,
  CASE WHEN score >= 80 THEN 'EXCELLENT' WHEN score >= 60 THEN 'BON' WHEN score >= 40 THEN 'MOYEN' ELSE 'FAIBLE' END AS verdict
FROM y""")
def profile_offer_overlap(spark, d):
    """Pairs are given: each user message meets the document of its conversation number."""
    profiles = table(spark, d, "conversations").where(F.col("role") == "user").select(
        "conv_id", "turn", F.array_distinct(tokenize(F.col("text"))).alias("profile"))
    wanted = documents(spark, d).select("doc_id", F.array_distinct(tokenize(F.col("text"))).alias("offer"))
    pairs = profiles.join(wanted, F.col("conv_id") == F.col("doc_id"))
    parts = sets.profile_overlap(F.col("profile"), F.col("offer"))
    return pairs.select("conv_id", "turn", "doc_id", F.array_join(parts["matched"], "|").alias("matched"),
                        F.size(parts["missing"]).alias("n_missing"), parts["score"].alias("score"),
                        parts["verdict"].alias("verdict"))
