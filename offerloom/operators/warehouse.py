"""Star schema: dimensions, fact, bridge, incremental upsert and integrity checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from offerloom.functions.offers import content_uid, source_type
from offerloom.functions.text import split_list
from offerloom.operators.ranking import keep_first
from offerloom.session import materialize

KEY_DIGITS = 4  # hex digits of a bucket: at most 65,536 buckets


def numbered(df: DataFrame, name: str, key: str, start: Column | int = 0, digits: int = KEY_DIGITS) -> DataFrame:
    """Dense surrogate keys 1..n for distinct names, without a single-task window.

    Names lie in the order of their md5, which fills the buckets (prefixes of it) evenly whatever the names are.
    They are numbered inside the buckets and shifted by the sizes of the preceding ones, so that the keys do
    not depend on ``digits``; the broadcast sizes have one row per bucket, 65,536 at most.
    """
    hashed = df.withColumn("__h", F.md5(F.col(name).cast("string"))).withColumn("__b", F.substring("__h", 1, digits))
    local = hashed.withColumn("__i", F.row_number().over(W.partitionBy("__b").orderBy("__h", name)))
    sizes = hashed.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select("__b", (F.sum("__n").over(W.orderBy("__b")) - F.col("__n")).alias("__o"))
    base = start if isinstance(start, Column) else F.lit(start)
    return local.join(F.broadcast(offsets), "__b").withColumn(key, (base + F.col("__o") + F.col("__i")).cast("bigint")) \
        .drop("__h", "__b", "__i", "__o")


def distinct_names(df: DataFrame, source: str, name: str) -> DataFrame:
    return df.where(F.col(source).isNotNull()).select(F.col(source).alias(name)).distinct()


def build_dimensions(offers: DataFrame) -> dict[str, DataFrame]:
    """Source, region, company and contract dimensions of harmonised, located offers."""
    sources = distinct_names(offers, "source", "source_name") \
        .withColumn("source_type", source_type(F.col("source_name")))
    located = offers.where(F.col("region").isNotNull() & F.col("region_lat").isNotNull()
                           & F.col("region_lon").isNotNull())
    regions = located.groupBy(F.col("region").alias("region_name")).agg(
        F.min(F.struct(F.col("region_lat").alias("latitude"), F.col("region_lon").alias("longitude"))).alias("p")) \
        .select("region_name", "p.latitude", "p.longitude")
    return {
        "dim_source": numbered(sources, "source_name", "source_key"),
        "dim_region": numbered(regions, "region_name", "region_key"),
        "dim_company": numbered(distinct_names(offers, "company", "company_name"), "company_name", "company_key"),
        "dim_contract": numbered(distinct_names(offers, "contract_type", "contract_type"),
                                 "contract_type", "contract_key"),
    }


def build_dim_skill(offers: DataFrame) -> DataFrame:
    """Skill names of both lists; a name in both counts as 'competences'."""
    lists = F.array(*[F.struct(F.lit(rank).alias("rank"), F.lit(kind).alias("type"), F.col(kind).alias("names"))
                      for rank, kind in enumerate(("competences", "savoir_etre"))])
    named = offers.select(F.explode(lists).alias("l")).select("l.rank", "l.type", F.explode("l.names").alias("skill_name"))
    skills = named.where(F.col("skill_name").isNotNull()).groupBy("skill_name").agg(
        F.min(F.struct("rank", "type")).alias("t")).select(
        "skill_name", F.col("t.type").alias("skill_type"), F.lit("unknown").alias("skill_category"))
    return numbered(skills, "skill_name", "skill_key")


def date_attributes(date: Column) -> dict[str, Column]:
    return {
        "date_key": F.date_format(date, "yyyyMMdd").cast("bigint"),
        "year": F.year(date), "month": F.month(date), "day": F.dayofmonth(date),
        "quarter": F.quarter(date), "week_of_year": F.weekofyear(date),
        "day_of_week": F.date_format(date, "EEEE"), "month_name": F.date_format(date, "MMMM"),
    }


def build_dim_date(df: DataFrame, ts: str) -> DataFrame:
    """Every calendar day from the first to the last date; the key is the date as yyyymmdd."""
    bounds = df.agg(F.struct(F.to_date(F.min(ts)).alias("a"), F.to_date(F.max(ts)).alias("b"))).scalar()
    days = df.sparkSession.range(1).select(bounds.alias("x")).select(
        F.explode(F.sequence("x.a", "x.b", F.expr("interval 1 day"))).alias("full_date"))
    return days.withColumns(date_attributes(F.col("full_date")))


def offer_keys(attributes: DataFrame, seq: str) -> DataFrame:
    """(uid, seq, offer_key): the first row of every uid and its key. Rows without a uid are no offers.

    Copies of one uid combine to their minimum before the shuffle.
    """
    first = attributes.where(F.col("uid").isNotNull()).groupBy("uid").agg(F.min(seq).alias(seq))
    return numbered(first, "uid", "offer_key")


def looked_up(rows: DataFrame, dim: DataFrame, column: str, name: str, key: str) -> DataFrame:
    """Adds the surrogate key of a name. Rows without the name match nothing and are spread by their uid."""
    names = dim.select(F.col(name).alias("__name"), key)
    dealt = F.coalesce(F.col(column), F.concat(F.lit("-"), F.col("uid")))
    return rows.join(names, (dealt == F.col("__name")) & F.col(column).isNotNull(), "left").drop("__name")


def build_fact(offers: DataFrame, attributes: DataFrame, keys: DataFrame, dims: Mapping[str, DataFrame],
               seq: str) -> DataFrame:
    """Fact rows: first offer per uid, surrogate keys looked up, the three skill counts.

    Rows are chosen and dimensions looked up on the narrow ``attributes`` (uid, seq and the names); the wide offers,
    in which ``seq`` is unique, meet the result once. Pass tables read back from storage: their real size then
    decides between broadcast and shuffle.
    """
    chosen = attributes.select("uid", seq, "source", "region", "company", "contract_type").join(keys, ["uid", seq])
    for table, column, name, key in (("dim_source", "source", "source_name", "source_key"),
                                     ("dim_region", "region", "region_name", "region_key"),
                                     ("dim_company", "company", "company_name", "company_key"),
                                     ("dim_contract", "contract_type", "contract_type", "contract_key")):
        chosen = looked_up(chosen, dims[table], column, name, key)
    resolved = chosen.select("uid", seq, "offer_key", "source_key", "region_key", "company_key", "contract_key")
    fact = offers.join(resolved, ["uid", seq])

    def size(col: str) -> Column:
        return F.coalesce(F.size(col), F.lit(0))

    published = F.to_date(F.try_to_timestamp("published_date"))
    return fact.select(
        "offer_key", "uid", "offer_id", "source_key", "region_key", "company_key", "contract_key",
        F.date_format(published, "yyyyMMdd").cast("bigint").alias("date_key"),
        "title", "source_url", "location", "salary", "remote", "published_date", "description",
        (size("competences") + size("savoir_etre")).alias("skills_count"),
        size("competences").alias("competences_count"), size("savoir_etre").alias("savoir_etre_count"),
        F.lit("import").alias("added_by"))


def build_bridge(attributes: DataFrame, keys: DataFrame, dim_skill: DataFrame) -> DataFrame:
    """Distinct (offer_key, skill_key) pairs over all rows of an offer; the names of copies merge before the joins."""
    empty = F.array().cast("array<string>")
    names = F.concat(F.coalesce("competences", empty), F.coalesce("savoir_etre", empty))
    named = attributes.select("uid", F.explode(F.array_distinct(names)).alias("skill_name")).distinct()
    return (named.join(dim_skill.select("skill_name", "skill_key"), "skill_name")
            .join(keys.select("uid", "offer_key"), "uid").select("offer_key", "skill_key"))


def get_or_create(dim: DataFrame, incoming: DataFrame, name: str, key: str,
                  defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """The dimension with a new key for every incoming name it lacks."""
    return dim.unionByName(created(dim, incoming, name, key, defaults))


def created(dim: DataFrame, incoming: DataFrame, name: str, key: str,
            defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """The rows that the dimension lacks, numbered behind its own."""
    fresh = incoming.where(F.col(name).isNotNull()).select(name).distinct().join(dim.select(name), name, "left_anti")
    start = F.coalesce(dim.agg(F.max(key)).scalar(), F.lit(0))
    keyed = numbered(fresh, name, key, start)
    for column, value in (defaults or {}).items():
        keyed = keyed.withColumn(column, value)
    return keyed.select(*dim.columns)


SKILL_DEFAULTS = {"skill_type": "competences", "skill_category": "technique"}


def named_skills(offers: DataFrame, key: str, joined: str) -> DataFrame:
    """(key, skill_name) from comma-separated skill text, distinct within an offer."""
    return offers.select(key, F.explode(F.array_distinct(split_list(F.col(joined)))).alias("skill_name"))


def link_skills(offers: DataFrame, dim_skill: DataFrame, key: str, joined: str) -> tuple[DataFrame, DataFrame]:
    """(skill dimension with created skills, distinct links) from comma-separated skill text."""
    named = named_skills(offers, key, joined)
    dim = get_or_create(dim_skill, named, "skill_name", "skill_key", {k: F.lit(v) for k, v in SKILL_DEFAULTS.items()})
    return dim, named.join(dim.select("skill_name", "skill_key"), "skill_name").select(key, "skill_key").distinct()


def touch(df: DataFrame, changed: Column, now: Column) -> DataFrame:
    """updated_at set on changed rows only."""
    return df.withColumn("updated_at", F.when(changed, now).otherwise(F.col("updated_at")))


def surviving_links(bridge: DataFrame, offers: DataFrame, skills: DataFrame) -> DataFrame:
    """Bridge rows whose offer and skill both still exist."""
    return bridge.join(offers.select("offer_key"), "offer_key", "left_semi") \
        .join(skills.select("skill_key"), "skill_key", "left_semi")


def integrity_checks(fact: DataFrame, bridge: DataFrame, skills: DataFrame,
                     dims: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Violations per rule as (check_name, violations)."""
    def check(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check_name"), "violations")

    def repeated(df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)

    result = check("uid_unique", repeated(fact, "uid")) \
        .unionByName(check("skill_name_unique", repeated(skills, "skill_name"))) \
        .unionByName(check("skill_type_domain",
                           skills.where(~F.col("skill_type").isin("competences", "savoir_etre")))) \
        .unionByName(check("bridge_offer_known", bridge.join(fact, "offer_key", "left_anti"))) \
        .unionByName(check("bridge_skill_known", bridge.join(skills, "skill_key", "left_anti")))
    for dim, key in dims:
        orphans = fact.where(F.col(key).isNotNull()).join(dim, key, "left_anti")
        result = result.unionByName(check(f"{key}_known", orphans))
    return result


def new_offers(incoming: DataFrame, existing: DataFrame, seq: str) -> DataFrame:
    """Incoming offers by content uid: first of each uid in the batch, none the table has."""
    uid = content_uid(F.col("title"), F.col("company_name"), F.col("location"))
    batch = keep_first(incoming.withColumn("uid", uid), ["uid"], [F.col(seq)])
    return batch.join(existing.select("uid"), "uid", "left_anti")


#: Name and key of the dimensions that a contributed offer may extend, and the other columns of a new row.
GROWING = {
    "dim_source": ("source_name", "source_key", {"source_type": "manual"}),
    "dim_region": ("region_name", "region_key", {"latitude": 0.0, "longitude": 0.0}),
    "dim_company": ("company_name", "company_key", {}),
    "dim_contract": ("contract_type", "contract_key", {}),
    "dim_skill": ("skill_name", "skill_key", SKILL_DEFAULTS),
}


def new_names(tables: Mapping[str, DataFrame], names: Mapping[str, DataFrame]) -> DataFrame:
    """(dim, name, key) of the names that no dimension has yet, numbered on from each dimension's last key.

    One pass serves all dimensions; the order within a dimension is that of ``numbered``.
    """
    def union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    known = union([tables[t].select(F.lit(t).alias("dim"), F.col(n).cast("string").alias("name"), F.col(k).cast("bigint").alias("key"))
                   for t, (n, k, _) in GROWING.items()])
    wanted = union([df.select(F.lit(t).alias("dim"), F.col(GROWING[t][0]).cast("string").alias("name")) for t, df in names.items()])
    fresh = wanted.where("name IS NOT NULL").distinct().join(known.select("dim", "name"), ["dim", "name"], "left_anti") \
        .withColumn("h", F.md5("name")).withColumn("b", F.substring("h", 1, KEY_DIGITS))
    local = fresh.withColumn("i", F.row_number().over(W.partitionBy("dim", "b").orderBy("h", "name")))
    sizes = fresh.groupBy("dim", "b").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select("dim", "b", (F.sum("n").over(W.partitionBy("dim").orderBy("b")) - F.col("n")).alias("o"))
    starts = known.groupBy("dim").agg(F.max("key").alias("start"))  # one row per dimension
    return local.join(offsets, ["dim", "b"]).join(F.broadcast(starts), "dim", "left").select(
        "dim", "name", (F.coalesce("start", F.lit(0)) + F.col("o") + F.col("i")).cast("bigint").alias("key"))


def upsert(tables: Mapping[str, DataFrame], incoming: DataFrame, seq: str, now: Column) -> dict[str, DataFrame]:
    """All tables after a batch of contributed offers."""
    return {name: tables[name].unionByName(rows) for name, rows in upsert_rows(tables, incoming, seq, now).items()}


def upsert_rows(tables: Mapping[str, DataFrame], incoming: DataFrame, seq: str, now: Column) -> dict[str, DataFrame]:
    """The rows that a batch of contributed offers adds to each table.

    Needs dim_source, dim_region, dim_company, dim_contract, dim_skill, fact_offers and
    fact_offer_skill; the caller appends the result as one snapshot, which makes the
    batch all-or-nothing. Which offers are new and what their names resolve to is found on
    narrow columns, which are checkpointed; the texts meet the result once. Rows that share uid and ``seq`` count as one.
    """
    unknown = F.lit("Unknown")
    uid = content_uid(F.col("title"), F.col("company_name"), F.col("location"))
    narrow = incoming.select(seq, "title", "company_name", "location", "all_skills", F.coalesce("source", F.lit("manual")).alias("source_name"),
                             F.coalesce("region_name", unknown).alias("region"), F.coalesce("company_name", unknown).alias("company"),
                             F.coalesce("contract_type", unknown).alias("contract"))
    fresh = new_offers(narrow, tables["fact_offers"], seq).drop("title", "company_name", "location")
    start = F.coalesce(tables["fact_offers"].agg(F.max("offer_key")).scalar(), F.lit(0))
    keyed = materialize(numbered(fresh, "uid", "offer_key", start))
    named = named_skills(keyed, "offer_key", "all_skills")
    names = {"dim_source": keyed.select("source_name"), "dim_region": keyed.select(F.col("region").alias("region_name")),
             "dim_company": keyed.select(F.col("company").alias("company_name")),
             "dim_contract": keyed.select(F.col("contract").alias("contract_type")), "dim_skill": named.select("skill_name")}
    created_names = materialize(new_names(tables, names))

    added, keys = {}, {}
    for t, (name, key, defaults) in GROWING.items():
        own = created_names.where(F.col("dim") == t).select(F.col("name").alias(name), F.col("key").alias(key))
        keys[t] = tables[t].select(name, key).unionByName(own)
        added[t] = own.withColumns({c: F.lit(v) for c, v in defaults.items()}).select(*tables[t].columns) if defaults else own.select(*tables[t].columns)
    links = named.join(keys["dim_skill"], "skill_name").select("offer_key", "skill_key").distinct()
    counts = links.groupBy("offer_key").agg(F.count(F.lit(1)).cast("int").alias("skills_count"))
    resolved = keyed.select(seq, "uid", "offer_key", "source_name", F.col("region").alias("region_name"), F.col("company").alias("company_name"),
                            F.col("contract").alias("contract_type"))
    for t in ("dim_source", "dim_region", "dim_company", "dim_contract"):
        resolved = resolved.join(keys[t], GROWING[t][0], "left")
    resolved = resolved.join(counts, "offer_key", "left").select(
        F.col(seq).alias("own_seq"), F.col("uid").alias("own_uid"), "offer_key", "source_key", "region_key", "company_key", "contract_key", "skills_count")
    texts = incoming.select(seq, uid.alias("uid"), "offer_id", "title", "url", "location", "salary", "remote", "description") \
        .dropDuplicates([seq, "uid"])
    rows = texts.join(resolved, F.col(seq).eqNullSafe(F.col("own_seq")) & (F.col("uid") == F.col("own_uid")))
    today = F.to_date(now)
    fact_rows = rows.select(
        "offer_key", "uid", F.coalesce("offer_id", "uid").alias("offer_id"), "source_key", "region_key",
        "company_key", "contract_key", F.date_format(today, "yyyyMMdd").cast("bigint").alias("date_key"),
        "title", F.col("url").alias("source_url"), "location", "salary",
        F.coalesce("remote", F.lit("no")).alias("remote"),
        F.date_format(today, "yyyy-MM-dd").alias("published_date"), "description",
        F.coalesce("skills_count", F.lit(0)).alias("skills_count"),
        F.coalesce("skills_count", F.lit(0)).alias("competences_count"),
        F.lit(0).alias("savoir_etre_count"), F.lit("contribution").alias("added_by"))
    return {**added, "fact_offers": fact_rows, "fact_offer_skill": links}
