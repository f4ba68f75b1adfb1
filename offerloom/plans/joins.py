"""Star, bridge, lookup and exclusion joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.functions.text import fold_place
from offerloom.operators import aggregates, joins, lists, ranking
from offerloom.plans.bindings import (LOCATIONS, REGIONS, bridge, companies, links, offers, pick, pick_sql, quoted,
                                      regions, skills, table, with_roles)
from offerloom.plans.registry import query


@query("star_join", with_roles("offers", "regions") + """SELECT offer_key, company_name, offers.region_name, latitude,
  longitude, contract_type, strftime(added_at, '%Y-%m-%d') AS published_date
FROM offers LEFT JOIN regions USING (region_key)""")
def star_join(spark, d):
    fact = offers(spark, d, with_company=False)
    located = companies(spark, d)
    joined = joins.star_join(fact, [(located, "company_key"), (regions(spark, d).drop("region_name"), "region_key")])
    return joined.select("offer_key", "company_name", "region_name", "latitude", "longitude", "contract_type",
                         F.date_format("added_at", "yyyy-MM-dd").alias("published_date"))


@query("bridge_join", with_roles("offers", "links") + """SELECT offer_key, title, skill_name, skill_type, skill_category
FROM offers JOIN links USING (offer_key)""")
def bridge_join(spark, d):
    rows = joins.bridge_join(offers(spark, d, with_company=False), bridge(spark, d), skills(spark, d))
    return rows.select("offer_key", "title", "skill_name", "skill_type", "skill_category")


@query("left_bridge_join", with_roles("offers", "links") + """SELECT offer_key, title, skill_name, skill_type
FROM offers LEFT JOIN links USING (offer_key)""")
def left_bridge_join(spark, d):
    rows = joins.bridge_join(offers(spark, d, with_company=False), bridge(spark, d), skills(spark, d), how="left")
    return rows.select("offer_key", "title", "skill_name", "skill_type")


@query("dim_left_fact", with_roles("offers", "regions") + """SELECT r.region_name, count(o.offer_key) AS offer_count
FROM regions r LEFT JOIN (SELECT * FROM offers WHERE contract_type = '1-URGENT' AND region_name <> 'ASIA') o
USING (region_key) GROUP BY r.region_name""")
def dim_left_fact(spark, d):
    """Regions keep their row even where the filtered fact has none."""
    counts = offers(spark, d).where((F.col("contract_type") == "1-URGENT") & (F.col("region_name") != "ASIA")) \
        .groupBy("region_key").agg(F.count("offer_key").alias("n"))
    return regions(spark, d).join(counts, "region_key", "left").select(
        "region_name", F.coalesce("n", F.lit(0).cast("bigint")).alias("offer_count"))


@query("key_lookup", """SELECT o_orderkey AS offer_key, c.c_name AS company_name, CASE WHEN c.c_custkey % 7 = 0 THEN NULL
  ELSE c.c_custkey END AS company_key FROM orders LEFT JOIN customer c ON o_custkey = c.c_custkey""")
def key_lookup(spark, d):
    """Names resolved against a dimension that lacks every seventh company."""
    names = offers(spark, d).select("offer_key", "company_name")
    dim = companies(spark, d).where(F.col("company_key") % 7 != 0)
    return joins.key_lookup(names, dim, "company_name", "company_name", "company_key") \
        .select("offer_key", "company_name", "company_key")


@query("anti_existing", """SELECT event_id, user_id, CASE WHEN user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)
  THEN 'duplicate' ELSE 'new' END AS status FROM events""")
def anti_existing(spark, d):
    existing = table(spark, d, "customer").where(F.col("c_acctbal") > 5000).select(F.col("c_custkey").alias("user_id"))
    incoming = table(spark, d, "events").select("event_id", "user_id")
    fresh, known = joins.split_existing(incoming, existing, "user_id")
    return fresh.withColumn("status", F.lit("new")).unionByName(known.withColumn("status", F.lit("duplicate"))) \
        .select("event_id", "user_id", "status")


@query("semi_top_groups", """WITH t AS (SELECT c_nationkey, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY 1 ORDER BY n DESC, c_nationkey LIMIT 10)
SELECT o_orderkey AS offer_key, c_nationkey AS nation FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_nationkey IN (SELECT c_nationkey FROM t)""")
def semi_top_groups(spark, d):
    nation = table(spark, d, "customer").select(F.col("c_custkey").alias("company_key"), F.col("c_nationkey").alias("nation"))
    rows = offers(spark, d, with_company=False).select("offer_key", "company_key").join(nation, "company_key") \
        .select("offer_key", "nation")
    return joins.restrict_to(rows, ranking.top_groups(rows, "nation", 10), "nation")


CITIES = [(c, r.name) for r in REGIONS for c in r.cities]
_FOLD = "trim(lower(translate(strip_accents({0}), '-''', '  ')))"


def _city_cases(value: str) -> str:
    folded = _FOLD.format(value)
    tests = " ".join(f"WHEN contains({folded}, {_FOLD.format(quoted(c))}) OR contains({_FOLD.format(quoted(c))}, {folded})"
                     f" THEN {quoted(r)}" for c, r in CITIES)
    return f"CASE WHEN {folded} = '' OR {value} IS NULL THEN NULL {tests} END"


@query("substring_theta_join", f"SELECT o_orderkey AS offer_key, {_city_cases(pick_sql('o_orderkey', LOCATIONS))} AS region FROM orders")
def substring_theta_join(spark, d):
    rows = offers(spark, d, with_company=False)
    entries = spark.createDataFrame([(_fold_text(c), i, r) for i, (c, r) in enumerate(CITIES)], "entry string, rank long, region string")
    folded = rows.select("offer_key", fold_place(F.col("location")).alias("place"))
    return lists.first_in_list(folded, "place", entries, ["region"]).select("offer_key", "region")


def _fold_text(name: str) -> str:
    import unicodedata
    plain = "".join(c for c in unicodedata.normalize("NFKD", name) if not unicodedata.combining(c))
    return plain.replace("-", " ").replace("'", " ").lower().strip()


@query("name_map", """SELECT o_orderkey AS offer_key, coalesce(n_name, 'inconnu') AS name FROM orders
LEFT JOIN nation ON o_custkey % 40 = n_nationkey""")
def name_map(spark, d):
    names = table(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("code"), F.col("n_name").alias("name"))
    rows = offers(spark, d, with_company=False).select("offer_key", (F.col("company_key") % 40).alias("code"))
    return joins.name_map(rows, names, "code", "name", F.lit("inconnu")).select("offer_key", "name")


@query("align_by_position", "SELECT d.doc_id, lang, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def align_by_position(spark, d):
    return joins.align(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), "doc_id")
