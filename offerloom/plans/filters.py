"""Filters, search, option lists and paging."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.functions import dates, offers as fo, text
from offerloom.operators import aggregates, search
from offerloom.plans.bindings import (RELEVANCE_WORDS, SKILL_TEXTS, TITLES, bridge, documents, links, offers, pick,
                                      pick_sql, skills, sql_list, stamp, table, with_roles)
from offerloom.plans.registry import query

REGION_CHOICE = ("EUROPE", "ASIA")


@query("filter_in", with_roles("offers") + f"""SELECT offer_key, region_name FROM offers
WHERE region_name IN ({sql_list(REGION_CHOICE)})""")
def filter_in(spark, d):
    rows = offers(spark, d)
    kept = search.apply_conditions(rows, search.in_list(F.col("region_name"), REGION_CHOICE),
                                   search.in_list(F.col("contract_type"), ("Tous",)))
    return kept.select("offer_key", "region_name")


@query("filter_eq", "SELECT o_orderkey AS offer_key FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'O'")
def filter_eq(spark, d):
    rows = offers(spark, d, with_company=False)
    return search.apply_conditions(rows, search.equals(F.col("contract_type"), "2-HIGH"),
                                   search.equals(F.col("remote"), "yes")).select("offer_key")


@query("filter_range", with_roles("offers") + "SELECT offer_key, skills_count FROM offers WHERE skills_count BETWEEN 3 AND 6")
def filter_range(spark, d):
    return offers(spark, d, with_company=False, with_skills=True) \
        .where(F.col("skills_count").between(3, 6)).select("offer_key", "skills_count")


@query("filter_date_range", """SELECT o_orderkey AS offer_key, strftime(o_orderdate, '%Y-%m-%d') AS added_on FROM orders
WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1997-08-15'""")
def filter_date_range(spark, d):
    rows = offers(spark, d, with_company=False)
    return rows.where(search.date_between(F.col("added_at"), "1996-03-01", "1997-08-15")) \
        .select("offer_key", F.date_format("added_at", "yyyy-MM-dd").alias("added_on"))


@query("filter_last_days", """SELECT event_id FROM events
WHERE CAST(ts AS DATE) > DATE '2024-01-15' - 7 AND CAST(ts AS DATE) <= DATE '2024-01-15'""")
def filter_last_days(spark, d):
    as_of = F.lit("2024-01-15").cast("date")
    return table(spark, d, "events").where(dates.within_last_days(F.col("ts"), as_of, 7)).select("event_id")


@query("filter_text_regex", r"SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)th(on|in)\s+(of|the)')")
def filter_text_regex(spark, d):
    return documents(spark, d).where(search.matches_regex([F.col("text")], r"th(on|in)\s+(of|the)")).select("doc_id")


@query("filter_text_like", "SELECT doc_id FROM documents WHERE text ILIKE '%the thon%' OR source ILIKE '%the thon%'")
def filter_text_like(spark, d):
    return documents(spark, d).where(search.like_ci([F.col("text"), F.col("source")], "the thon")).select("doc_id")


@query("filter_text_multi", with_roles("offers") + f"""SELECT offer_key FROM offers WHERE contains(lower(title), 'data')
OR contains(lower(company_name), 'data') OR contains(lower(coalesce({pick_sql('offer_key', SKILL_TEXTS)}, '')), 'data')
OR contains(lower(company_name), '00042')
OR contains(lower(title), '00042')""")
def filter_text_multi(spark, d):
    rows = offers(spark, d).withColumn("all_skills", pick("offer_key", SKILL_TEXTS))
    cols = [F.col("title"), F.col("company_name"), F.col("all_skills")]
    return rows.where(search.contains_ci(cols, "data") | search.contains_ci(cols[:2], "00042")).select("offer_key")


@query("filter_any_skill_exact", f"""WITH r AS (SELECT o_orderkey AS offer_key, unnest(string_split(lower(
  {pick_sql('o_orderkey', SKILL_TEXTS)}), ',')) AS s FROM orders)
SELECT DISTINCT offer_key FROM r WHERE trim(s) IN ('sql', 'kafka')""")
def filter_any_skill_exact(spark, d):
    rows = offers(spark, d, with_company=False).withColumn("all_skills", pick("offer_key", SKILL_TEXTS))
    return rows.where(search.any_skill_exact(F.split("all_skills", ","), ["SQL", "Kafka"])).select("offer_key")


@query("filter_any_skill_substring", f"""SELECT o_orderkey AS offer_key FROM orders
WHERE contains(lower({pick_sql('o_orderkey', SKILL_TEXTS)}), 'power')
   OR contains(lower({pick_sql('o_orderkey', SKILL_TEXTS)}), 'dock')""")
def filter_any_skill_substring(spark, d):
    rows = offers(spark, d, with_company=False).withColumn("all_skills", pick("offer_key", SKILL_TEXTS))
    return rows.where(search.any_skill_substring(F.col("all_skills"), ["Power", "dock"])).select("offer_key")


WANTED = ("small ring", "red bolt")


@query("filter_all_skills", with_roles("links") + f"""SELECT offer_key FROM links WHERE skill_name IN ({sql_list(WANTED)})
GROUP BY offer_key HAVING count(DISTINCT skill_name) = 2""")
def filter_all_skills(spark, d):
    return search.offers_with_all_skills(bridge(spark, d), skills(spark, d), WANTED)


@query("relevance_regex", f"""SELECT o_orderkey AS offer_key FROM orders
WHERE regexp_matches({pick_sql('o_orderkey', TITLES)}, '(?i)({"|".join(RELEVANCE_WORDS)})')""")
def relevance_regex(spark, d):
    rows = offers(spark, d, with_company=False)
    pattern = r"\b(" + "|".join(RELEVANCE_WORDS) + r")\b"
    return rows.where(search.matches_regex([F.col("title")], "(?U)" + pattern)).select("offer_key")


@query("search_offers", with_roles("offers", "links") + f"""SELECT offer_key, title, region_name, contract_type, remote,
  strftime(added_at, '%Y-%m-%d') AS added_on FROM offers
WHERE region_name IN ({sql_list(REGION_CHOICE)}) AND contract_type IN ('1-URGENT', '2-HIGH') AND remote = 'yes'
  AND (title ILIKE '%data%' OR location ILIKE '%data%')
  AND offer_key IN (SELECT offer_key FROM links WHERE skill_name IN ({sql_list(WANTED)}, 'blue bolt', 'hot gear'))""")
def search_offers(spark, d):
    rows = offers(spark, d).withColumn("description", F.col("location"))
    found = search.search_offers(rows, bridge(spark, d), skills(spark, d), regions=REGION_CHOICE,
                                 wanted_skills=[*WANTED, "blue bolt", "hot gear"],
                                 contract_types=("1-URGENT", "2-HIGH"), remote="yes", text="data")
    return found.select("offer_key", "title", "region_name", "contract_type", "remote",
                        F.date_format("added_at", "yyyy-MM-dd").alias("added_on"))


@query("offer_details", with_roles("offers", "links") + """SELECT o.offer_key, title, company_name, region_name, contract_type,
  (SELECT string_agg(skill_name, '|' ORDER BY skill_name) FROM links l
   WHERE l.offer_key = o.offer_key AND skill_type = 'competences') AS competences,
  (SELECT string_agg(skill_name, '|' ORDER BY skill_name) FROM links l
   WHERE l.offer_key = o.offer_key AND skill_type = 'savoir_etre') AS savoir_etre
FROM offers o WHERE o.offer_key = 3""")
def offer_details(spark, d):
    detail = search.offer_details(offers(spark, d), bridge(spark, d), skills(spark, d), 3)
    return detail.select("offer_key", "title", "company_name", "region_name", "contract_type",
                         F.nullif(F.array_join("competences", "|"), F.lit("")).alias("competences"),
                         F.nullif(F.array_join("savoir_etre", "|"), F.lit("")).alias("savoir_etre"))


@query("unique_values", "SELECT DISTINCT p_brand AS skill_category FROM part")
def unique_values(spark, d):
    return search.unique_values(skills(spark, d), "skill_category")


@query("skill_vocabulary", f"""WITH r AS (SELECT unnest(string_split({pick_sql('o_orderkey', SKILL_TEXTS)}, ',')) AS s FROM orders)
SELECT DISTINCT trim(s) AS skill FROM r WHERE trim(s) <> '' ORDER BY skill LIMIT 100""")
def skill_vocabulary(spark, d):
    rows = offers(spark, d, with_company=False).withColumn("all_skills", pick("offer_key", SKILL_TEXTS))
    return search.skill_vocabulary(rows, "all_skills")


@query("paginate", """SELECT o_orderkey AS offer_key, o_totalprice AS amount,
  CAST(ceil((SELECT count(*) FROM orders) / 20.0) AS BIGINT) AS total_pages
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40""")
def paginate(spark, d):
    rows = offers(spark, d, with_company=False).select("offer_key", "amount")
    return search.paginate(rows, [F.desc("amount"), F.asc("offer_key")], page=3)


@query("preview_limit", "SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 5")
def preview_limit(spark, d):
    return search.preview(documents(spark, d), ["doc_id", "lang", "source"], [F.asc("doc_id")], 5)
