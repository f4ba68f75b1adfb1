"""Star-schema load, incremental upsert and integrity checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.functions.offers import normalize_contract
from offerloom.functions.text import parse_list_literal
from offerloom.operators import warehouse as wh
from offerloom.plans.bindings import (COMPANIES, CONTRACTS, DATES, REGIONS, bridge, companies, documents, offers, pick,
                                      pick_sql, skills, sql_list, table, with_roles)
from offerloom.plans.projections import contract_sql
from offerloom.plans.registry import query
from offerloom.session import scratch_path
from offerloom.sources.snapshots import append_snapshot, read_tables, write_all, write_snapshot

K = "doc_id"
REGION_OF = (0, 1, None, 3, 4, 2, 5)
HARD = ("['Python', 'SQL']", "[]", None, "['SQL', 'Spark', 'Rigueur']", "oops", "['Docker']")
SOFT = ("['Rigueur']", None, "['Écoute', 'Rigueur']", "[]", "['SQL']")
HARD_SQL = ("['Python', 'SQL']", "CAST([] AS VARCHAR[])", "CAST([] AS VARCHAR[])", "['SQL', 'Spark', 'Rigueur']",
            "CAST([] AS VARCHAR[])", "['Docker']")
SOFT_SQL = ("['Rigueur']", "CAST([] AS VARCHAR[])", "['Écoute', 'Rigueur']", "CAST([] AS VARCHAR[])", "['SQL']")
# Days the date texts stand for.
DATE_KEYS = (20240115, None, None, None, 20231201, None, 20240309)


def _region(attribute):
    return tuple(None if i is None else str(getattr(REGIONS[i], attribute)) for i in REGION_OF)


def _cases(key, values):
    return f"(CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END)"


def num(name: str) -> str:
    """SQL twin of the surrogate numbering."""
    return f"row_number() OVER (ORDER BY md5({name}), {name})"


def harmonised(spark, d):
    """Enriched offers; exact copies of a text share their uid."""
    return documents(spark, d).select(
        F.col(K).alias("seq"), F.md5("text").alias("uid"), F.col(K).cast("string").alias("offer_id"), "source",
        pick(K, _region("name")).alias("region"), pick(K, _region("lat")).cast("double").alias("region_lat"),
        pick(K, _region("lon")).cast("double").alias("region_lon"), pick(K, COMPANIES).alias("company"),
        normalize_contract(pick(K, CONTRACTS)).alias("contract_type"), F.col("lang").alias("title"),
        F.lit(None).cast("string").alias("source_url"), F.lit(None).cast("string").alias("location"),
        F.lit(None).cast("string").alias("salary"), F.lit("unknown").alias("remote"),
        pick(K, DATES).alias("published_date"), F.col("text").alias("description"),
        parse_list_literal(pick(K, HARD)).alias("competences"), parse_list_literal(pick(K, SOFT)).alias("savoir_etre"))


H = f"""h AS (SELECT doc_id AS seq, md5(text) AS uid, CAST(doc_id AS VARCHAR) AS offer_id, source, lang AS title,
  {pick_sql(K, _region('name'))} AS region, CAST({pick_sql(K, _region('lat'))} AS DOUBLE) AS region_lat,
  CAST({pick_sql(K, _region('lon'))} AS DOUBLE) AS region_lon, {pick_sql(K, COMPANIES)} AS company,
  {contract_sql(pick_sql(K, CONTRACTS))} AS contract_type, CAST({pick_sql(K, DATE_KEYS)} AS BIGINT) AS date_key,
  {_cases(K, HARD_SQL)} AS competences, {_cases(K, SOFT_SQL)} AS savoir_etre FROM documents)"""
DIMS = f"""ds AS (SELECT source AS source_name, {num('source')} AS source_key FROM (SELECT DISTINCT source FROM h)),
dr AS (SELECT region AS region_name, lat AS latitude, lon AS longitude, {num('region')} AS region_key FROM
  (SELECT region, min(region_lat) AS lat, min(region_lon) AS lon FROM h WHERE region IS NOT NULL GROUP BY region)),
dc AS (SELECT company AS company_name, {num('company')} AS company_key FROM (SELECT DISTINCT company FROM h WHERE company IS NOT NULL)),
dt AS (SELECT contract_type, {num('contract_type')} AS contract_key
  FROM (SELECT DISTINCT contract_type FROM h WHERE contract_type IS NOT NULL)),
sk0 AS (SELECT unnest(competences) AS skill_name, 0 AS r FROM h UNION ALL SELECT unnest(savoir_etre), 1 FROM h),
dk AS (SELECT skill_name, CASE min(r) WHEN 0 THEN 'competences' ELSE 'savoir_etre' END AS skill_type,
  {num('skill_name')} AS skill_key FROM sk0 GROUP BY skill_name)"""
FACT = f"""f0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY seq) AS k FROM h) WHERE k = 1),
f AS (SELECT {num('uid')} AS offer_key, uid, offer_id, source_key, region_key, company_key, contract_key, date_key,
  CAST(len(competences) + len(savoir_etre) AS INTEGER) AS skills_count, CAST(len(competences) AS INTEGER) AS competences_count,
  CAST(len(savoir_etre) AS INTEGER) AS savoir_etre_count
  FROM f0 LEFT JOIN ds ON f0.source = source_name LEFT JOIN dr ON f0.region = region_name
  LEFT JOIN dc ON f0.company = company_name LEFT JOIN dt USING (contract_type))"""


@query("build_dimensions", f"""WITH {H}, {DIMS} SELECT 'dim_source' AS dim, source_key AS key, source_name AS name,
  'scraping' AS attribute FROM ds UNION ALL SELECT 'dim_region', region_key, region_name, latitude || '/' || longitude FROM dr
  UNION ALL SELECT 'dim_company', company_key, company_name, '' FROM dc
  UNION ALL SELECT 'dim_contract', contract_key, contract_type, '' FROM dt""")
def build_dimensions(spark, d):
    dims = wh.build_dimensions(harmonised(spark, d))
    point = F.concat_ws("/", F.col("latitude").cast("string"), F.col("longitude").cast("string"))
    parts = [("dim_source", "source_key", "source_name", F.col("source_type")),
             ("dim_region", "region_key", "region_name", point),
             ("dim_company", "company_key", "company_name", F.lit("")),
             ("dim_contract", "contract_key", "contract_type", F.lit(""))]
    frames = [dims[t].select(F.lit(t).alias("dim"), F.col(k).alias("key"), F.col(n).alias("name"), a.alias("attribute"))
              for t, k, n, a in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])


@query("build_dim_skill", f"WITH {H}, {DIMS} SELECT skill_key, skill_name, skill_type, 'unknown' AS skill_category FROM dk")
def build_dim_skill(spark, d):
    return wh.build_dim_skill(harmonised(spark, d))


@query("build_dim_date", """WITH g AS (SELECT unnest(generate_series((SELECT min(o_orderdate) FROM orders)::TIMESTAMP,
  (SELECT max(o_orderdate) FROM orders)::TIMESTAMP, INTERVAL 1 DAY)) AS t)
SELECT strftime(t, '%Y-%m-%d') AS full_date, CAST(strftime(t, '%Y%m%d') AS BIGINT) AS date_key, CAST(year(t) AS INTEGER) AS year,
  CAST(month(t) AS INTEGER) AS month, CAST(day(t) AS INTEGER) AS day, CAST(quarter(t) AS INTEGER) AS quarter,
  CAST(week(t) AS INTEGER) AS week_of_year, dayname(t) AS day_of_week, monthname(t) AS month_name FROM g""")
def build_dim_date(spark, d):
    return wh.build_dim_date(table(spark, d, "orders"), "o_orderdate") \
        .withColumn("full_date", F.date_format("full_date", "yyyy-MM-dd"))


FACT_COLUMNS = ("offer_key", "uid", "offer_id", "source_key", "region_key", "company_key", "contract_key", "date_key",
                "skills_count", "competences_count", "savoir_etre_count")


def stored(spark, label, tables):
    """Tables written and read back, so that the joins on them know their real size."""
    root = scratch_path(spark, label)
    write_all({name: (df, f"{root}/{name}") for name, df in tables.items()})
    return {name: spark.read.schema(df.schema).parquet(f"{root}/{name}") for name, df in tables.items()}


NARROW = ("uid", "seq", "source", "region", "region_lat", "region_lon", "company", "contract_type", "competences", "savoir_etre")


def loaded(spark, d, dims=True, skills=True):
    """Load order of the warehouse: the narrow columns once, keys and the wanted dimensions from them, then the fact."""
    rows = harmonised(spark, d)
    narrow = stored(spark, "attributes", {"attributes": rows.select(*NARROW)})["attributes"]
    tables = {"keys": wh.offer_keys(narrow, "seq")}
    if dims:
        tables |= wh.build_dimensions(narrow)
    if skills:
        tables["dim_skill"] = wh.build_dim_skill(narrow)
    return rows, narrow, stored(spark, "dimensions", tables)


@query("build_fact", f"WITH {H}, {DIMS}, {FACT} SELECT {', '.join(FACT_COLUMNS)} FROM f")
def build_fact(spark, d):
    rows, narrow, tables = loaded(spark, d, skills=False)
    return wh.build_fact(rows, narrow, tables["keys"], tables, "seq").select(*FACT_COLUMNS)


@query("build_bridge", f"""WITH {H}, {DIMS}, {FACT}, n AS (SELECT uid, unnest(list_concat(competences, savoir_etre)) AS skill_name FROM h)
SELECT DISTINCT offer_key, skill_key FROM n JOIN dk USING (skill_name) JOIN f USING (uid)""")
def build_bridge(spark, d):
    _, narrow, tables = loaded(spark, d, dims=False)
    return wh.build_bridge(narrow, tables["keys"], tables["dim_skill"])


@query("get_or_create_dim", f"""WITH m AS (SELECT max(r_regionkey) AS k FROM region),
n AS (SELECT DISTINCT n_name AS region_name FROM nation WHERE n_name NOT IN (SELECT r_name FROM region))
SELECT CAST(r_regionkey AS BIGINT) AS region_key, r_name AS region_name, 1.5 AS latitude FROM region
UNION ALL SELECT k + {num('region_name')}, region_name, 0.0 FROM n, m""".replace("1.5 AS latitude", "CAST(1.5 AS DOUBLE) AS latitude"))
def get_or_create_dim(spark, d):
    dim = table(spark, d, "region").select(F.col("r_regionkey").cast("bigint").alias("region_key"),
                                           F.col("r_name").alias("region_name"), F.lit(1.5).alias("latitude"))
    incoming = table(spark, d, "nation").select(F.col("n_name").alias("region_name")) \
        .unionByName(dim.select("region_name"))
    return wh.get_or_create(dim, incoming, "region_name", "region_key", {"latitude": F.lit(0.0)})


ALL_SKILLS = ("Python, SQL", " SQL ,Nouveau ,", None, "Kafka,Kafka, SQL", "")


def warehouse(spark, d):
    """All tables of the bulk load."""
    rows, narrow, tables = loaded(spark, d)
    dims = {name: df for name, df in tables.items() if name.startswith("dim_")}
    return {**dims, "fact_offers": wh.build_fact(rows, narrow, tables["keys"], dims, "seq"),
            "fact_offer_skill": wh.build_bridge(narrow, tables["keys"], dims["dim_skill"])}


def contributed(docs):
    return docs.select(
        F.col(K).alias("seq"), F.lit(None).cast("string").alias("offer_id"), F.md5("text").alias("title"),
        F.col("lang").alias("company_name"), F.lit("Paris").alias("location"), "source",
        F.lit("Île-de-France").alias("region_name"), pick(K, CONTRACTS).alias("contract_type"),
        F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("salary"),
        F.lit(None).cast("string").alias("remote"), F.col("text").alias("description"),
        pick(K, ALL_SKILLS).alias("all_skills"))


@query("upsert_offers", f"""WITH c AS (SELECT doc_id AS seq, md5(lower(md5(text) || '|' || lang || '|paris')) AS uid, source,
  coalesce({pick_sql(K, CONTRACTS)}, 'Unknown') AS contract_type, {pick_sql(K, ALL_SKILLS)} AS s FROM documents),
e AS (SELECT DISTINCT uid FROM c JOIN documents ON doc_id = seq WHERE lang = 'en'),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY seq) AS k FROM c
  WHERE uid NOT IN (SELECT uid FROM e)) WHERE k = 1),
l AS (SELECT DISTINCT uid, trim(x) AS skill FROM (SELECT uid, unnest(string_split(s, ',')) AS x FROM n) WHERE trim(x) <> '')
SELECT 'duplicates' AS measure, (SELECT count(*) FROM c) - (SELECT count(*) FROM n) AS value
UNION ALL SELECT 'inserted', count(*) FROM n
UNION ALL SELECT 'links', count(*) FROM l
UNION ALL SELECT 'new_contracts', (SELECT count(DISTINCT contract_type) FROM n)
UNION ALL SELECT 'offers', (SELECT count(DISTINCT md5(text)) FROM documents) + (SELECT count(*) FROM e) + (SELECT count(*) FROM n)
UNION ALL SELECT 'skills', (SELECT count(DISTINCT skill) FROM l)""")
def upsert_offers(spark, d):
    """Two contributed batches onto the bulk-loaded warehouse, each appended as one snapshot: the English documents,
    then all documents."""
    root = scratch_path(spark, "warehouse")
    base = warehouse(spark, d)
    now = F.lit("2024-06-01 12:00:00").cast("timestamp")
    batch = contributed(documents(spark, d))

    write_snapshot(spark, root, base)
    append_snapshot(spark, root, wh.upsert_rows(read_tables(spark, root), batch.where(F.col("company_name") == "en"), "seq", now))
    before = read_tables(spark, root)
    append_snapshot(spark, root, wh.upsert_rows(before, batch, "seq", now))
    after = read_tables(spark, root)
    fresh = after["fact_offers"].join(before["fact_offers"].select("offer_key"), "offer_key", "left_anti")
    fresh_links = after["fact_offer_skill"].join(fresh.select("offer_key"), "offer_key", "left_semi")

    def measure(name, df):
        return df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("measure"), "value")

    inserted = measure("inserted", fresh)
    duplicates = batch.agg((F.count(F.lit(1)) - fresh.agg(F.count(F.lit(1))).scalar()).alias("value")) \
        .select(F.lit("duplicates").alias("measure"), "value")
    return (inserted.unionByName(duplicates).unionByName(measure("offers", after["fact_offers"]))
            .unionByName(measure("links", fresh_links))
            .unionByName(measure("skills", fresh_links.select("skill_key").distinct()))
            .unionByName(measure("new_contracts", fresh.select("contract_key").distinct())))


@query("link_skills", f"""WITH n AS (SELECT DISTINCT o_orderkey AS offer_key, trim(x) AS skill_name FROM (SELECT o_orderkey,
  unnest(string_split({pick_sql('o_orderkey', ALL_SKILLS)}, ',')) AS x FROM orders) WHERE trim(x) <> ''),
d AS (SELECT min(p_partkey) AS skill_key, p_name AS skill_name FROM part GROUP BY p_name),
m AS (SELECT max(skill_key) AS k FROM d),
c AS (SELECT skill_name, k + {num('skill_name')} AS skill_key FROM
  (SELECT DISTINCT skill_name FROM n WHERE skill_name NOT IN (SELECT skill_name FROM d)), m)
SELECT offer_key, skill_key, skill_name FROM n JOIN c USING (skill_name)""")
def link_skills(spark, d):
    dim = skills(spark, d).groupBy("skill_name").agg(
        F.min("skill_key").alias("skill_key"), F.first("skill_type").alias("skill_type"),
        F.first("skill_category").alias("skill_category"))
    rows = offers(spark, d, with_company=False).select("offer_key", pick("offer_key", ALL_SKILLS).alias("all_skills"))
    grown, found = wh.link_skills(rows, dim, "offer_key", "all_skills")
    return found.join(grown.select("skill_key", "skill_name"), "skill_key").select("offer_key", "skill_key", "skill_name")


@query("touch_updated_at", """SELECT o_orderkey AS offer_key, CASE WHEN o_orderstatus = 'P' THEN '2024-06-01 12:00:00'
  ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS updated_at FROM orders""")
def touch_updated_at(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderkey").alias("offer_key"), "o_orderstatus",
                                            F.col("o_orderdate").cast("timestamp").alias("updated_at"))
    touched = wh.touch(rows, F.col("o_orderstatus") == "P", F.lit("2024-06-01 12:00:00").cast("timestamp"))
    return touched.select("offer_key", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"))


@query("cascade_delete", with_roles("bridge") + """SELECT offer_key, skill_key FROM bridge
WHERE offer_key IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')
  AND skill_key IN (SELECT p_partkey FROM part WHERE p_type <> 'SMALL')""")
def cascade_delete(spark, d):
    kept = table(spark, d, "orders").where(F.col("o_orderstatus") != "F").select(F.col("o_orderkey").alias("offer_key"))
    known = table(spark, d, "part").where(F.col("p_type") != "SMALL").select(F.col("p_partkey").alias("skill_key"))
    return wh.surviving_links(bridge(spark, d), kept, known)


@query("integrity_checks", with_roles("bridge", "skills") + """SELECT 'uid_unique' AS check_name,
  (SELECT count(*) FROM (SELECT md5(text) FROM documents GROUP BY 1 HAVING count(*) > 1)) AS violations
UNION ALL SELECT 'skill_name_unique', (SELECT count(*) FROM (SELECT skill_name FROM skills GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'skill_type_domain', 0
UNION ALL SELECT 'bridge_offer_known', (SELECT count(*) FROM bridge WHERE offer_key NOT IN (SELECT doc_id FROM documents))
UNION ALL SELECT 'bridge_skill_known', (SELECT count(*) FROM bridge WHERE skill_key NOT IN (SELECT skill_key FROM skills))
UNION ALL SELECT 'company_key_known', (SELECT count(*) FROM documents WHERE n_chars NOT IN (SELECT c_custkey FROM customer))""")
def integrity_checks(spark, d):
    """Documents stand in for a damaged fact table, so that rules are violated."""
    fact = documents(spark, d).select(F.col(K).alias("offer_key"), F.md5("text").alias("uid"), F.col("n_chars").alias("company_key"))
    return wh.integrity_checks(fact, bridge(spark, d), skills(spark, d),
                               [(table(spark, d, "customer").select(F.col("c_custkey").alias("company_key")), "company_key")])
