"""Counts, shares, pivots, distributions, hierarchies and corpus statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.functions import offers as fo
from offerloom.functions.text import clean_tokens, split_list, words
from offerloom.operators import aggregates as agg
from offerloom.operators.ranking import top_groups, top_per_group
from offerloom.plans.bindings import (DATES, LOCATIONS, SALARIES, SKILL_TEXTS, STOP_WORDS, TITLES, bridge, documents,
                                      links, located_links, offers, pick, pick_sql, regions, skills, sql_list, table,
                                      with_roles)
from offerloom.plans.registry import query


def pct2_sql(part: str, whole: str) -> str:
    return f"CAST((({part}) * 20000 + ({whole})) // (({whole}) * 2) AS DOUBLE) / 100.0"


@query("top_skills", with_roles("bridge", "skills") + f"""SELECT s.skill_key, skill_name, skill_type, skill_category,
  count(*) AS offer_count, {pct2_sql('count(*)', 'SELECT count(*) FROM orders')} AS percentage
FROM bridge JOIN skills s USING (skill_key) GROUP BY ALL""")
def top_skills(spark, d):
    return agg.top_skills(bridge(spark, d), skills(spark, d), table(spark, d, "orders"))


@query("top_skills_by_type", with_roles("bridge", "skills") + f"""SELECT s.skill_key, skill_name, skill_type, skill_category,
  count(*) AS offer_count, {pct2_sql('count(*)', 'SELECT count(*) FROM orders')} AS percentage
FROM bridge JOIN skills s USING (skill_key) WHERE skill_type = 'competences' GROUP BY ALL
ORDER BY offer_count DESC, skill_key LIMIT 20""")
def top_skills_by_type(spark, d):
    return agg.top_skills(bridge(spark, d), skills(spark, d), table(spark, d, "orders"), 20, "competences")


@query("offers_by_region", with_roles("offers", "regions") + """SELECT r.region_name, latitude, longitude,
  count(o.offer_key) AS offer_count, round(avg(o.skills_count), 6) AS avg_skills_per_offer
FROM regions r LEFT JOIN offers o USING (region_key) GROUP BY ALL""")
def offers_by_region(spark, d):
    rows = agg.offers_by_region(offers(spark, d, with_skills=True), regions(spark, d))
    return rows.select("region_name", "latitude", "longitude", "offer_count",
                       F.round("avg_skills_per_offer", 6).alias("avg_skills_per_offer"))


@query("region_stats_companies", with_roles("offers") + """SELECT region_name, count(*) AS offer_count,
  count(DISTINCT company_key) AS companies, round(avg(skills_count), 6) AS avg_skills FROM offers
WHERE region_name IS NOT NULL GROUP BY region_name""")
def region_stats_companies(spark, d):
    rows = offers(spark, d, with_skills=True).where(F.col("region_name").isNotNull())
    return rows.groupBy("region_name").agg(F.count(F.lit(1)).alias("offer_count"),
                                           F.countDistinct("company_key").alias("companies"),
                                           F.round(F.avg("skills_count"), 6).alias("avg_skills"))


@query("global_stats", with_roles("offers", "skills") + """SELECT (SELECT count(*) FROM offers) AS total_offers,
  (SELECT count(DISTINCT region_key) FROM offers) AS total_regions, (SELECT count(*) FROM skills) AS total_skills,
  (SELECT count(*) FROM skills WHERE skill_type = 'competences') AS total_competences,
  (SELECT count(*) FROM skills WHERE skill_type = 'savoir_etre') AS total_savoir_etre,
  (SELECT round(avg(skills_count), 6) FROM offers) AS avg_skills_per_offer""")
def global_stats(spark, d):
    stats = agg.global_stats(offers(spark, d, with_skills=True), skills(spark, d))
    return stats.withColumn("avg_skills_per_offer", F.round("avg_skills_per_offer", 6))


@query("offers_with_skills", with_roles("offers", "links") + """SELECT offer_key, title, region_name, company_name,
  string_agg(CASE WHEN skill_type = 'competences' THEN skill_name END, ',' ORDER BY skill_name) AS competences,
  string_agg(CASE WHEN skill_type = 'savoir_etre' THEN skill_name END, ',' ORDER BY skill_name) AS savoir_etre,
  string_agg(skill_name, ',' ORDER BY skill_name) AS all_skills
FROM offers LEFT JOIN links USING (offer_key) GROUP BY ALL""")
def offers_with_skills(spark, d):
    rows = agg.offers_with_skills(offers(spark, d), bridge(spark, d), skills(spark, d))
    return rows.select("offer_key", "title", "region_name", "company_name",
                       *[F.array_join(c, ",").alias(c) for c in ("competences", "savoir_etre", "all_skills")])


@query("skills_list", with_roles("skills") + "SELECT * FROM skills ORDER BY skill_name, skill_key")
def skills_list(spark, d):
    return skills(spark, d).orderBy("skill_name", "skill_key")


@query("offer_skill_string", with_roles("links") + """SELECT offer_key,
  string_agg(skill_name, ', ' ORDER BY skill_name) AS skills FROM links GROUP BY offer_key""")
def offer_skill_string(spark, d):
    return links(spark, d).groupBy("offer_key").agg(
        F.array_join(F.array_sort(F.collect_list("skill_name")), ", ").alias("skills"))


@query("remote_rate_by_region", with_roles("offers") + f"""SELECT region_name,
  count(*) FILTER (remote IN ('yes', 'hybrid')) AS remote_offers, count(*) AS total_offers,
  {pct2_sql("count(*) FILTER (remote IN ('yes', 'hybrid'))", 'count(*)')} AS remote_pct
FROM offers WHERE region_name IS NOT NULL GROUP BY region_name""")
def remote_rate_by_region(spark, d):
    return agg.remote_rate(offers(spark, d), "region_name", fo.has_remote(F.col("remote")))


@query("kpi_row", with_roles("offers") + """SELECT count(*) AS offers, count(DISTINCT company_key) AS companies,
  count(DISTINCT region_name) AS regions, round(avg(skills_count), 6) AS avg_skills,
  round(100.0 * count(*) FILTER (remote IN ('yes', 'hybrid')) / count(*), 6) AS remote_pct FROM offers""")
def kpi_row(spark, d):
    return agg.kpi_row(offers(spark, d, with_skills=True), fo.has_remote(F.col("remote")))


@query("region_density", with_roles("offers", "regions") + """SELECT round(count(*) / count(DISTINCT region_name), 6) AS density,
  (SELECT region_name FROM offers WHERE region_name IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, region_name LIMIT 1)
  AS top_region, round(avg(latitude), 6) AS mean_lat, round(avg(longitude), 6) AS mean_lon
FROM offers LEFT JOIN regions USING (region_key)""".replace("count(DISTINCT region_name)", "count(DISTINCT offers.region_name)"))
def region_density(spark, d):
    """Offers per region, the leading region and the mean position, from one row per region."""
    per_region = offers(spark, d).groupBy("region_key", "region_name").agg(F.count(F.lit(1)).alias("n")) \
        .join(regions(spark, d).drop("region_name"), "region_key", "left")
    located = F.sum(F.when(F.col("latitude").isNotNull(), F.col("n")))
    return per_region.agg(
        F.round(F.try_divide(F.sum("n"), F.count_if(F.col("region_name").isNotNull())), 6).alias("density"),
        F.min(F.when(F.col("region_name").isNotNull(), F.struct((-F.col("n")).alias("o"), "region_name"))).alias("t"),
        F.round(F.sum(F.col("latitude") * F.col("n")) / located, 6).alias("mean_lat"),
        F.round(F.sum(F.col("longitude") * F.col("n")) / located, 6).alias("mean_lon")) \
        .select("density", F.col("t.region_name").alias("top_region"), "mean_lat", "mean_lon")


@query("value_counts_pct", f"""WITH r AS (SELECT {pick_sql('o_orderkey', LOCATIONS)} AS location FROM orders)
SELECT location, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM r), 6) AS pct FROM r
WHERE location IS NOT NULL GROUP BY location ORDER BY n DESC, location LIMIT 8""")
def value_counts_pct(spark, d):
    return agg.value_counts(offers(spark, d, with_company=False), "location", 8)


GAPS = f"""r AS (SELECT o_orderkey AS uid, {pick_sql('o_orderkey', SALARIES)} AS salary,
  {pick_sql('o_orderkey', LOCATIONS)} AS location, {pick_sql('o_orderkey', DATES)} AS published_date,
  {pick_sql('o_orderkey', TITLES)} AS title FROM orders)"""


def gaps(spark, d):
    k = "o_orderkey"
    return table(spark, d, "orders").select(
        F.col(k).alias("uid"), pick(k, SALARIES).alias("salary"), pick(k, LOCATIONS).alias("location"),
        pick(k, DATES).alias("published_date"), pick(k, TITLES).alias("title"))


@query("completeness", "WITH " + GAPS + " " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS filled, round(100.0 * count({c}) / count(*), 6) AS pct FROM r"
    for c in ("salary", "location", "published_date", "title")))
def completeness(spark, d):
    return agg.completeness(gaps(spark, d), ["salary", "location", "published_date", "title"])


@query("quality_report", f"""WITH r AS (SELECT l_orderkey AS uid, {pick_sql('l_orderkey', LOCATIONS)} AS location,
  {pick_sql('l_orderkey', SALARIES)} AS salary, {pick_sql('l_orderkey', DATES)} AS published_date FROM lineitem)
SELECT count(*) AS total, count(uid) - count(DISTINCT uid) AS duplicate_uids,
  count(*) FILTER (location IS NULL OR trim(location) = '') AS missing_location,
  count(*) FILTER (salary IS NULL OR trim(salary) = '') AS missing_salary,
  count(*) FILTER (published_date IN ('2024-02-30', 'il y a 3 jours', '')) AS invalid_dates FROM r""")
def quality_report(spark, d):
    k = "l_orderkey"
    rows = table(spark, d, "lineitem").select(F.col(k).alias("uid"), pick(k, LOCATIONS).alias("location"),
                                              pick(k, SALARIES).alias("salary"), pick(k, DATES).alias("published_date"))
    return agg.quality_report(rows, "uid", ["location", "salary"], "published_date")


@query("duplicate_uids", "SELECT md5(text) AS uid, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_uids(spark, d):
    return agg.repeated(documents(spark, d).select(F.md5("text").alias("uid")), "uid")


@query("region_bubble", with_roles("offers") + """SELECT region_name, count(company_name) AS companies,
  round(avg(skills_count), 6) AS avg_skills FROM offers WHERE region_name IS NOT NULL GROUP BY region_name""")
def region_bubble(spark, d):
    return offers(spark, d, with_skills=True).where(F.col("region_name").isNotNull()).groupBy("region_name").agg(
        F.count("company_name").alias("companies"), F.round(F.avg("skills_count"), 6).alias("avg_skills"))


@query("metric_by_region", with_roles("offers") + """SELECT region_name, round(avg(skills_count), 6) AS value FROM offers
WHERE region_name IS NOT NULL GROUP BY region_name""")
def metric_by_region(spark, d):
    return agg.metric_by(offers(spark, d, with_skills=True), "region_name", "skills_count") \
        .orderBy(F.desc("value"), "region_name")


CONTRACT_VALUES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
PIVOT_SQL = ", ".join(f"count(*) FILTER (contract_type = '{v}') AS \"{v}\"" for v in CONTRACT_VALUES)


@query("region_contract_pivot", with_roles("offers") + f"""SELECT region_name, {PIVOT_SQL} FROM offers
WHERE region_name IS NOT NULL GROUP BY region_name""")
def region_contract_pivot(spark, d):
    return agg.pivot_counts(offers(spark, d), "region_name", "contract_type", CONTRACT_VALUES)


@query("date_contract_pivot", f"""SELECT strftime(o_orderdate, '%Y-%m-%d') AS date,
  {PIVOT_SQL.replace('contract_type', 'o_orderpriority')} FROM orders GROUP BY 1""")
def date_contract_pivot(spark, d):
    rows = offers(spark, d, with_company=False).withColumn("date", F.date_format("added_at", "yyyy-MM-dd"))
    return agg.pivot_counts(rows, "date", "contract_type", CONTRACT_VALUES)


@query("daily_counts", "SELECT strftime(o_orderdate, '%Y-%m-%d') AS date, count(*) AS n FROM orders GROUP BY 1")
def daily_counts(spark, d):
    return agg.counts_by(offers(spark, d, with_company=False), "date", F.date_format("added_at", "yyyy-MM-dd"))


@query("hourly_counts", "SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n FROM events GROUP BY 1")
def hourly_counts(spark, d):
    return agg.counts_by(table(spark, d, "events"), "hour", F.hour("ts"))


@query("resample_counts", """WITH r AS (SELECT date_trunc('month', o_orderdate) AS m FROM orders),
g AS (SELECT unnest(generate_series((SELECT min(m) FROM r)::TIMESTAMP, (SELECT max(m) FROM r)::TIMESTAMP, INTERVAL 1 MONTH)) AS m)
SELECT strftime(g.m, '%Y-%m-%d') AS period, count(r.m) AS n FROM g LEFT JOIN r ON g.m = r.m GROUP BY 1""")
def resample_counts(spark, d):
    return agg.resample_counts(offers(spark, d, with_company=False), "added_at").withColumn("period", F.date_format("period", "yyyy-MM-dd"))


@query("histogram", """WITH b AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 30)), 29) AS INTEGER) AS bin, count(*) AS n
FROM orders, b GROUP BY 1""")
def histogram(spark, d):
    return agg.histogram(offers(spark, d, with_company=False), "amount", 30)


@query("box_stats", with_roles("offers") + """SELECT contract_type, min(skills_count) AS lo,
  quantile_cont(CAST(skills_count AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(skills_count AS DOUBLE), 0.5) AS median,
  quantile_cont(CAST(skills_count AS DOUBLE), 0.75) AS q3, max(skills_count) AS hi FROM offers GROUP BY contract_type""")
def box_stats(spark, d):
    return agg.quartiles(offers(spark, d, with_company=False, with_skills=True), "contract_type", "skills_count")


@query("median_skills", with_roles("offers") + """SELECT round(avg(skills_count), 6) AS mean,
  median(CAST(skills_count AS DOUBLE)) AS median FROM offers""")
def median_skills(spark, d):
    return agg.mean_median(offers(spark, d, with_company=False, with_skills=True), "skills_count")


@query("skill_frequency", f"""WITH r AS (SELECT trim(unnest(string_split({pick_sql('o_orderkey', SKILL_TEXTS)}, ','))) AS skill
  FROM orders) SELECT skill, count(*) AS n FROM r WHERE skill <> '' GROUP BY skill ORDER BY n DESC, skill LIMIT 20""")
def skill_frequency(spark, d):
    rows = offers(spark, d, with_company=False)
    return agg.item_frequency(rows, split_list(pick("offer_key", SKILL_TEXTS)), 20, "skill")


@query("region_profile", with_roles("offers", "located") + """
, sk AS (SELECT region_name, skill_name AS v, count(DISTINCT offer_key) AS n FROM located GROUP BY ALL),
ct AS (SELECT region_name, contract_type AS v, count(*) AS n FROM offers GROUP BY ALL),
co AS (SELECT region_name, company_key AS v, count(*) AS n FROM offers GROUP BY ALL),
rk AS (SELECT *, row_number() OVER (PARTITION BY region_name ORDER BY n DESC, v) AS k FROM sk),
rc AS (SELECT *, row_number() OVER (PARTITION BY region_name ORDER BY n DESC, v) AS k FROM co)
SELECT region_name, count(*) AS offers,
  (SELECT string_agg(v || ':' || n, '|' ORDER BY n DESC, v) FROM rk WHERE k <= 5 AND rk.region_name = o.region_name) AS top_skills,
  (SELECT string_agg(v || ':' || n, '|' ORDER BY n DESC, v) FROM ct WHERE ct.region_name = o.region_name) AS contracts,
  (SELECT string_agg(v || ':' || n, '|' ORDER BY n DESC, CAST(v AS VARCHAR)) FROM rc WHERE k <= 5
   AND rc.region_name = o.region_name) AS top_companies
FROM offers o WHERE region_name IS NOT NULL GROUP BY region_name""")
def region_profile(spark, d):
    rows = agg.region_profile(offers(spark, d), located_links(spark, d))
    return rows.select("region_name", "offers", *[F.array_join(c, "|").alias(c)
                                                  for c in ("top_skills", "contracts", "top_companies")])


@query("skill_by_region", with_roles("offers", "links") + """
, h AS (SELECT DISTINCT offer_key FROM links WHERE skill_name = 'red bolt')
SELECT region_name, count(h.offer_key) AS n, count(*) AS offers, round(count(h.offer_key) / count(*), 6) AS share
FROM offers LEFT JOIN h USING (offer_key) WHERE region_name IS NOT NULL GROUP BY region_name""")
def skill_by_region(spark, d):
    return agg.skill_by_region(links(spark, d), offers(spark, d), "red bolt")


@query("skill_share", with_roles("links") + """SELECT round((SELECT count(DISTINCT offer_key) FROM links
  WHERE skill_name = 'red bolt') / (SELECT count(*) FROM orders), 6) AS share""")
def skill_share(spark, d):
    asking = links(spark, d).where(F.col("skill_name") == "red bolt").agg(F.countDistinct("offer_key").alias("n"))
    return asking.select(F.round(F.col("n") / agg.row_total(table(spark, d, "orders")), 6).alias("share"))


@query("region_skill_hierarchy", with_roles("located") + """
, s AS (SELECT DISTINCT offer_key, region_name, contract_type, skill_name FROM located),
r AS (SELECT *, row_number() OVER (PARTITION BY offer_key ORDER BY skill_name) AS k FROM s)
SELECT region_name, contract_type, skill_name, count(*) AS n,
  CAST(3 - GROUPING(region_name) - GROUPING(contract_type) - GROUPING(skill_name) AS INTEGER) AS depth
FROM r WHERE k <= 3 GROUP BY ROLLUP (region_name, contract_type, skill_name)""")
def region_skill_hierarchy(spark, d):
    named = located_links(spark, d).select("offer_key", "region_name", "contract_type", "skill_name")
    three = agg.first_different(named, "offer_key", ["skill_name", "region_name", "contract_type"], 3)
    return agg.hierarchy(three, ["region_name", "contract_type", "skill_name"])


RADAR_REGIONS = ("ASIA", "EUROPE", "ATLANTIS")
RADAR_SKILLS = ("red bolt", "small ring", "golden fleece")


@query("radar_counts", with_roles("located") + f"""SELECT r.v AS region_name, s.v AS skill_name, count(DISTINCT offer_key) AS n
FROM (SELECT unnest([{sql_list(RADAR_REGIONS)}]) AS v) r CROSS JOIN (SELECT unnest([{sql_list(RADAR_SKILLS)}]) AS v) s
LEFT JOIN located l ON l.region_name = r.v AND l.skill_name = s.v GROUP BY ALL""")
def radar_counts(spark, d):
    return agg.radar_counts(located_links(spark, d), RADAR_REGIONS, RADAR_SKILLS)


WORDS_SQL = r"unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'))"
CLEAN_SQL = rf"""[w for w in string_split_regex(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+')
  if len(w) > 2 and w not in ({sql_list(STOP_WORDS)})]"""


@query("corpus_stats", f"""WITH t AS (SELECT unnest({CLEAN_SQL}) AS w FROM documents)
SELECT count(*) AS total_words, count(DISTINCT w) AS unique_words,
  round(count(*) / (SELECT count(*) FROM documents), 6) AS avg_words,
  round(count(DISTINCT w) / count(*), 6) AS diversity FROM t""")
def corpus_stats(spark, d):
    return agg.corpus_stats(documents(spark, d), clean_tokens(F.lower("text"), STOP_WORDS))


TECH_TERMS = ("thon", "ther", "erin", "nicht", "avec", "absent")


@query("tech_term_counts", f"""WITH t AS (SELECT {WORDS_SQL} AS term FROM documents)
SELECT term, count(*) AS n FROM t WHERE term IN ({sql_list(TECH_TERMS)}) GROUP BY term""")
def tech_term_counts(spark, d):
    return agg.term_counts(documents(spark, d), words(F.col("text")), TECH_TERMS)


@query("word_frequency", f"WITH t AS (SELECT {WORDS_SQL} AS word FROM documents) SELECT word, count(*) AS n FROM t GROUP BY word")
def word_frequency(spark, d):
    return agg.item_frequency(documents(spark, d), words(F.col("text")), name="word")


@query("etl_load_stats", with_roles("links") + """SELECT (SELECT count(DISTINCT md5(text)) FROM documents) AS inserted,
  (SELECT count(*) - count(DISTINCT md5(text)) FROM documents) AS duplicates,
  (SELECT count(DISTINCT skill_name) FROM links) AS skills, (SELECT count(*) FROM bridge) AS links""")
def etl_load_stats(spark, d):
    docs = documents(spark, d).agg(F.struct(F.countDistinct(F.md5("text")).alias("u"), F.count(F.lit(1)).alias("n"))).scalar()
    pairs = links(spark, d).agg(F.struct(F.countDistinct("skill_name").alias("s"), F.count(F.lit(1)).alias("l"))).scalar()
    return spark.range(1).select(docs.alias("d"), pairs.alias("p")).select(
        F.col("d.u").alias("inserted"), (F.col("d.n") - F.col("d.u")).alias("duplicates"),
        F.col("p.s").alias("skills"), F.col("p.l").alias("links"))
