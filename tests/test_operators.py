"""Operators on small frames, including hot keys and repeated batches."""

import math
import random
import re

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from offerloom.functions.text import normalize_skill_text
from offerloom.operators import aggregates, agglomeration, cooccurrence, models, ranking, search, skills as sk, warehouse as wh
from offerloom.operators.tfidf import fit_tfidf, regional_terms
from offerloom.plans.unify import unify_all, unify_b
from offerloom.session import scratch_path
from offerloom.sources import files, pages, snapshots
from offerloom.sources.snapshots import append_snapshot, current_version, read_snapshot, write_snapshot
from offerloom.streaming import ingest
from offerloom.streaming.counts import window_counts

ENTRIES = [sk.Entry("Azure Databricks", "competences", "cloud"), sk.Entry("Azure", "competences", "cloud"),
           sk.Entry("C++", "competences", "langages"), sk.Entry("C#", "competences", "langages"),
           sk.Entry("Scikit-learn", "competences", "ml"), sk.Entry("NLP", "competences", "ml"),
           sk.Entry("R", "competences", "langages"), sk.Entry("Rigueur", "savoir_etre", "soft")]
TERMS = sk.expand_lexicon(ENTRIES)


def reference_scores(body):
    """Direct scan of the whole text, one pattern per term."""
    best = {}
    for t in TERMS:
        for m in re.finditer(r"(?<!\w)" + re.escape(t.term) + r"(?!\w)", body, re.I):
            if not re.match(r"\w", t.term[-1]) and m.end() < len(body) and re.match(r"\w", body[m.end()]):
                continue
            context = body[max(0, m.start() - 50):m.end() + 50].lower()
            score = 0.7 + 0.2 * (m.start() < 500) + 0.1 * (m.group()[0].upper() == m.group()[0] != m.group()[0].lower())
            score = min(1.0, score + 0.05 * any(c in context for c in sk.CUE_WORDS))
            best[t.canonical] = max(best.get(t.canonical, 0), round(score, 6))
    return best


def test_skill_extraction_equals_direct_scan(spark):
    rng = random.Random(3)
    pool = ["Azure", "azure databricks", "Databricks", "C++", "c#,", "scikit learn", "sklearn", "N.L.P", "nlp", "r", "R",
            "rigueur", "mot", "autre", "expérience", "must", "xC++", "C++x", "azur", "l'R", "a" * 70, "\n", "été"]
    texts = [" ".join(rng.choice(pool) for _ in range(n)) for n in (0, 1, 5, 60, 400, 900)] + [None, "C++", "Azure Databricks"]
    df = spark.createDataFrame(list(enumerate(texts)), "offer_id int, description string")
    got = {}
    for r in sk.extract_skills(df, TERMS).collect():
        got.setdefault(r["offer_id"], {})[r["skill"]] = r["confidence"]
    bodies = {r[0]: r[1] for r in df.select("offer_id", normalize_skill_text(F.col("description"))).collect()}
    for i, body in bodies.items():
        assert got.get(i, {}) == (reference_scores(body) if body else {}), i


def test_enriched_offers_keep_every_row(spark):
    df = spark.createDataFrame([("a", "Azure et rigueur"), ("b", None)], "uid string, description string")
    rows = {r["uid"]: r for r in sk.enrich_offers(df, TERMS).collect()}
    assert rows["a"]["competences"] == ["Azure"] or rows["a"]["competences"] == ["Microsoft Azure"]
    assert rows["a"]["savoir_etre"] == ["Rigueur"] and rows["b"]["skills_count"] == 0 and rows["b"]["competences"] == []


def test_hot_group_is_pruned_before_the_shuffle(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), "id")
    top = ranking.top_per_group(df, ["k"], [F.desc("id")], 2)
    assert "WindowGroupLimit" in top._jdf.queryExecution().toString()
    assert [r["id"] for r in top.where("k = 0").orderBy(F.desc("id")).collect()] == [19998, 19995]


def test_keep_first_uses_the_given_order(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 1, "z")], "k string, o int, v string")
    assert {r["k"]: r["v"] for r in ranking.keep_first(df, ["k"], [F.col("o")]).collect()} == {"a": "y", "b": "z"}


def test_surrogate_keys_are_dense(spark):
    df = spark.range(5000).select(F.concat(F.lit("n"), F.col("id").cast("string")).alias("name"))
    keys = sorted(r["k"] for r in wh.numbered(df, "name", "k", 10).collect())
    assert keys == list(range(11, 5011))
    few, many = ({r["name"]: r["k"] for r in wh.numbered(df, "name", "k", digits=n).collect()} for n in (1, 4))
    assert few == many


def test_fact_takes_the_first_copy_and_keeps_offers_without_names(spark):
    offers = spark.createDataFrame(
        [("u", 2, "late", "s", None, "Acme"), ("u", 1, "first", "s", None, None), ("v", 3, "other", None, "R", "Acme"), (None, 4, "lost", "s", "R", "Acme")],
        "uid string, seq long, title string, source string, region string, company string").select(
        "*", F.lit("CDI").alias("contract_type"), F.array(F.lit("SQL"), F.lit("SQL")).alias("competences"),
        F.lit(None).cast("array<string>").alias("savoir_etre"), F.lit(1.0).alias("region_lat"), F.lit(2.0).alias("region_lon"),
        *[F.lit(None).cast("string").alias(c) for c in ("offer_id", "source_url", "location", "salary", "remote", "published_date", "description")])
    keys, dims, skills = wh.offer_keys(offers, "seq"), wh.build_dimensions(offers), wh.build_dim_skill(offers)
    fact = {r["uid"]: r for r in wh.build_fact(offers, offers, keys, dims, "seq").collect()}
    assert set(fact) == {"u", "v"} and fact["u"]["title"] == "first" and fact["u"]["company_key"] is None
    assert fact["v"]["company_key"] == 1 and fact["v"]["source_key"] is None and fact["u"]["skills_count"] == 2
    assert wh.build_bridge(offers, keys, skills).count() == 2


def test_dominant_text_value(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", None), ("h", "z")], "g string, v string")
    assert {r["g"]: (r["v"], r["n"]) for r in ranking.dominant_value(df, "g", "v").collect()} == {"g": ("a", 1), "h": ("z", 1)}


def test_appending_writes_the_new_rows_only(spark):
    root = scratch_path(spark, "test-append")
    write_snapshot(spark, root, {"t": spark.range(100), "u": spark.range(1)})
    append_snapshot(spark, root, {"t": spark.range(100, 103)})
    version, folders = current_version(spark, root)
    assert version == 2 and len(folders["t"]) == 2 and len(folders["u"]) == 1
    assert spark.read.parquet(f"{root}/{folders['t'][1]}").count() == 3
    assert read_snapshot(spark, root, "t").count() == 103 and read_snapshot(spark, root, "u").count() == 1
    write_snapshot(spark, root, {"t": spark.range(5)})
    assert read_snapshot(spark, root, "t").count() == 5


def test_a_second_writer_of_a_version_fails(spark, monkeypatch):
    root = scratch_path(spark, "test-conflict")
    write_snapshot(spark, root, {"t": spark.range(3)})
    seen = current_version(spark, root)
    append_snapshot(spark, root, {"t": spark.range(3, 4)})
    monkeypatch.setattr(snapshots, "current_version", lambda *_: seen)
    with pytest.raises(AnalysisException):
        append_snapshot(spark, root, {"t": spark.range(4, 9)})
    monkeypatch.undo()
    assert read_snapshot(spark, root, "t").count() == 4


def test_unify_accepts_missing_columns_and_sources(spark):
    raw = spark.createDataFrame([("1", "u", "t", "Acme", "Lyon", "cdi", 7)],
                                "offer_id string, url string, title string, company string, location string, "
                                "contract_type string, seq int")
    row = unify_b(raw).first()
    assert row["remote"] == "unknown" and row["company"] == "Acme" and row["contract_type"] == "CDI"
    assert unify_all(None, raw.unionByName(raw), None, "seq").count() == 1


def empty_warehouse(spark):
    def empty(schema):
        return spark.createDataFrame([], schema)

    tables = {
        "dim_source": empty("source_key bigint, source_name string, source_type string"),
        "dim_region": empty("region_key bigint, region_name string, latitude double, longitude double"),
        "dim_company": empty("company_key bigint, company_name string"),
        "dim_contract": empty("contract_key bigint, contract_type string"),
        "dim_skill": empty("skill_key bigint, skill_name string, skill_type string, skill_category string"),
        "fact_offer_skill": empty("offer_key bigint, skill_key bigint"),
        "fact_offers": empty(
            "offer_key bigint, uid string, offer_id string, source_key bigint, region_key bigint, company_key bigint, "
            "contract_key bigint, date_key bigint, title string, source_url string, location string, salary string, "
            "remote string, published_date string, description string, skills_count int, competences_count int, "
            "savoir_etre_count int, added_by string"),
    }
    return tables


def contributed(spark):
    return spark.createDataFrame(
        [(1, None, "Data", "Acme", "Lyon", None, None, "CDI", "u", None, None, "d", "SQL, SQL,Python"),
         (2, None, "DATA", "acme", "lyon", "web", "ARA", None, "u", None, None, "d", ""),
         (3, None, "Dev", None, None, "web", "ARA", None, "u", None, None, "d", None)],
        "seq int, offer_id string, title string, company_name string, location string, source string, region_name string, "
        "contract_type string, url string, salary string, remote string, description string, all_skills string")


def test_upsert_twice_changes_nothing(spark):
    tables, batch = empty_warehouse(spark), contributed(spark)
    root, now = scratch_path(spark, "test-upsert"), F.lit("2024-01-02 03:04:05").cast("timestamp")
    write_snapshot(spark, root, wh.upsert(tables, batch, "seq", now))
    first = {n: read_snapshot(spark, root, n) for n in tables}
    fact = {r["title"]: r for r in first["fact_offers"].collect()}
    assert set(fact) == {"Data", "Dev"} and fact["Data"]["skills_count"] == 2 and fact["Dev"]["skills_count"] == 0
    assert {r["source_name"] for r in first["dim_source"].collect()} == {"manual", "web"}
    write_snapshot(spark, root, wh.upsert(first, batch, "seq", now))
    assert current_version(spark, root)[0] == 2
    for name, df in first.items():
        assert sorted(map(str, df.collect())) == sorted(map(str, read_snapshot(spark, root, name).collect())), name


def test_text_files_fall_back_to_latin1(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("été".encode("utf-8"))
    (tmp_path / "b.txt").write_bytes("été".encode("latin-1"))
    assert [r["text"] for r in files.read_text_files(spark, str(tmp_path)).collect()] == ["été", "été"]


def test_csv_round_trip_with_quotes_and_lines(spark):
    df = spark.createDataFrame([(1, 'a "b", c\nd'), (2, " x "), (3, None)], "id int, description string")
    path = scratch_path(spark, "test-csv")
    files.write_csv(df, path)
    assert {r["id"]: r["description"] for r in files.read_csv(spark, path, df.schema).collect()} == \
        {1: 'a "b", c\nd', 2: " x ", 3: None}


HTML = """<html><head><script type="application/ld+json">{"description": "%s", "hiringOrganization": {"name": " Acme "}}</script>
<style>p{}</style></head><body><h1>Data <b>Engineer</b></h1><p>Lyon - 69 CDI</p><p>télétravail partiel</p></body></html>"""


def test_offer_pages(spark):
    rows = [(1, "https://x/emplois/42.html", HTML % ("<p>long</p> " + "mot " * 40)),
            (2, "https://x/1", "<body><script type='application/ld+json'>{oops</script><p>Missions du poste : Contexte</p>"
                               "<div class='job-description'>%s</div></body>" % ("bloc " * 30)),
            (3, "https://x/2", "<p>Avant</p><p>Description du poste</p><p>Coder</p><p>Profil recherché</p><p>X</p>"),
            (4, "https://x/3", None)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string")
    got = {r["page_id"]: r for r in pages.offers_from_pages(df).collect()}
    assert got[1]["offer_id"] == "42" and got[1]["title"] == "Data Engineer" and got[1]["employer"] == "Acme"
    assert got[1]["location"].endswith("Lyon - 69") and got[1]["contract_type"] == "CDI" and got[1]["remote"] == "hybrid"
    assert got[1]["description"].startswith("long mot") and got[2]["description"].startswith("bloc bloc")
    assert got[2]["title"] is None and got[2]["employer"] is None and got[3]["description"] == "Coder"
    assert got[4]["description"] == ""


def test_tfidf_rows_have_unit_norm_and_known_weights(spark):
    docs = spark.createDataFrame([(1, ["a", "a", "b"]), (2, ["b", "c"]), (3, ["z"])], "id int, tokens array<string>")
    model = fit_tfidf(docs, "tokens", max_features=3)
    assert model.terms == ["a", "b", "c"]
    rows = {(r["id"], r["term"]): r["tfidf"] for r in model.weights(docs, "id", "tokens").collect()}
    idf = {"a": math.log(4 / 2) + 1, "b": math.log(4 / 3) + 1}
    norm = math.hypot(2 * idf["a"], idf["b"])
    assert rows[1, "a"] == pytest.approx(2 * idf["a"] / norm) and rows[1, "b"] == pytest.approx(idf["b"] / norm)
    assert not any(i == 3 for i, _ in rows)


def test_small_regions_have_no_terms(spark):
    docs = spark.createDataFrame([(i, "big" if i < 6 else "small", ["x", "y"]) for i in range(9)],
                                 "id int, region string, tokens array<string>")
    assert {r["region"] for r in regional_terms(docs, "id", "tokens", "region").collect()} == {"big"}


def test_correlation_of_constant_and_disjoint_terms(spark):
    links = spark.createDataFrame([(d, "all") for d in range(4)] + [(0, "x"), (1, "x"), (2, "y"), (3, "y")], "d int, t string")
    rows = {(r["term_a"], r["term_b"]): r["correlation"] for r in
            cooccurrence.correlation(links, "d", "t", spark.range(4)).collect()}
    assert rows == {("all", "x"): None, ("all", "y"): None, ("x", "y"): -1.0}


def test_letter_terms_need_upper_case(spark):
    df = spark.createDataFrame([("R, for C et r. C++ RC",)], "v string")
    assert {r["term"]: r["n"] for r in aggregates.letter_term_counts(df, F.col("v"), ["R", "C"]).collect()} == {"R": 1, "C": 2}


def test_deep_paging_by_key(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    assert [r["k"] for r in search.next_page(df, "k", 39, 3).collect()] == [40, 41, 42]


def test_like_takes_wildcards_literally(spark):
    df = spark.createDataFrame([("100% remote",), ("100 remote",)], "v string")
    assert df.where(search.like_ci([F.col("v")], "100%")).count() == 1


def test_nmf_separates_two_blocks(spark):
    from pyspark.ml.linalg import Vectors
    rows = [(i, Vectors.dense([1.0, 1.0, 0, 0] if i % 2 else [0, 0, 1.0, 2.0])) for i in range(20)]
    vectors = spark.createDataFrame(rows, ["id", "features"])
    model = models.Nmf(2, max_iter=60).fit(vectors, 4)
    topics = {r["id"]: r["dominant_profile"] for r in models.assign_topics(model.transform(vectors, "id"), "id").collect()}
    assert len({topics[i] for i in range(0, 20, 2)}) == 1 and topics[0] != topics[1]
    assert all(abs(sum(r["topic_distribution"]) - 1) < 1e-6 for r in model.transform(vectors, "id").collect())


def test_kmeans_is_repeatable(spark):
    from pyspark.ml.linalg import Vectors
    rows = [(i, Vectors.dense([float(i % 3) * 10 + i * 0.01, 0.0])) for i in range(30)]
    vectors = spark.createDataFrame(rows, ["id", "features"])
    runs = [sorted((r["id"], r["cluster_id"]) for r in models.fit_kmeans(vectors, 3, restarts=2).transform(vectors).collect())
            for _ in range(2)]
    assert runs[0] == runs[1] and len({c for _, c in runs[0]}) == 3
    assert -1 <= agglomeration.silhouette(models.fit_kmeans(vectors, 3, restarts=1).transform(vectors)).first()[0] <= 1


def test_stream_drops_repeats_across_restarts(spark):
    source, target = scratch_path(spark, "test-stream-in"), scratch_path(spark, "test-stream-out")
    schema = "uid string, ts timestamp"

    def arrive(*uids):
        spark.createDataFrame([(u,) for u in uids], "uid string").select(
            "uid", F.lit("2024-01-01").cast("timestamp").alias("ts")).coalesce(1).write.mode("append").parquet(source)

    def run():
        from pyspark.sql.types import StringType, StructField, StructType, TimestampType
        typed = StructType([StructField("uid", StringType()), StructField("ts", TimestampType())])
        fresh = ingest.first_seen(ingest.read_stream(spark, source, typed), "uid", "ts", "1 day")
        ingest.run_to_end(fresh, ingest.append_batches(target + "/rows"), target + "/checkpoint")
        return sorted(r["uid"] for r in spark.read.parquet(target + "/rows").collect())

    arrive("a", "b", "a")
    assert run() == ["a", "b"]
    arrive("b", "c")
    assert run() == ["a", "b", "c"]


def test_late_events_are_dropped_and_windows_updated(spark):
    source, target = scratch_path(spark, "test-late-in"), scratch_path(spark, "test-late-out")
    schema = "window_start timestamp, event_type string, n bigint"

    def arrive(*days):
        spark.createDataFrame([(f"2024-01-{d:02d} 10:00:00",) for d in days], "t string").select(
            F.to_timestamp("t").alias("ts"), F.lit("a").alias("event_type")).coalesce(1).write.mode("append").parquet(source)
        stream = ingest.read_stream(spark, source, spark.read.parquet(source).schema)
        windows = window_counts(stream, "ts", "event_type", "1 day", watermark="2 days")
        ingest.run_to_end(windows, ingest.append_batches(target + "/rows"), target + "/checkpoint", mode="update")
        rows = ingest.latest(spark, target + "/rows", ["window_start", "event_type"], "n", schema).collect()
        return {r["window_start"].day: r["n"] for r in rows}

    assert arrive(1, 1, 20) == {1: 2, 20: 1}
    assert arrive(19, 20, 1) == {1: 2, 19: 1, 20: 2}  # the first of January is behind the watermark


def test_stored_keys_stay_unique_beyond_the_watermark(spark):
    target = scratch_path(spark, "test-append-new")
    handle = ingest.append_new(target, "uid")
    frame = lambda *uids: spark.createDataFrame([(u,) for u in uids], "uid string")
    for number, uids in ((0, ("a", "b")), (1, ("b", "c")), (1, ("b", "c"))):
        handle(frame(*uids), number)
    assert sorted(r["uid"] for r in spark.read.parquet(target).collect()) == ["a", "b", "c"]


def test_streamed_upsert_equals_one_batch(spark):
    source, root = scratch_path(spark, "test-upsert-in"), scratch_path(spark, "test-upsert-root")
    now = F.lit("2024-01-02 03:04:05").cast("timestamp")
    tables, batch = empty_warehouse(spark), contributed(spark)
    write_snapshot(spark, root, tables)
    for n in (1, 2, 3):
        batch.where(F.col("seq") == n).coalesce(1).write.mode("append").parquet(source)
    handler = ingest.upsert_batches(root, list(tables), "seq", now)
    stream = ingest.read_stream(spark, source, batch.schema, files_per_batch=2)
    ingest.run_to_end(stream, handler, root + "/checkpoint")
    streamed = {r["uid"] for r in read_snapshot(spark, root, "fact_offers").collect()}
    whole = {r["uid"] for r in wh.upsert(tables, batch, "seq", now)["fact_offers"].collect()}
    assert streamed == whole and len(streamed) == 2
    assert current_version(spark, root)[0] >= 2


def test_upsert_resolves_names_in_one_pass(spark):
    """New names number on from each dimension; rows without seq or names find their texts; copies count once."""
    dims = {"dim_source": ("a", 4, "api"), "dim_region": ("Sud", 2, 1.0, 2.0), "dim_company": ("acme", 9), "dim_contract": ("CDI", 1), "dim_skill": ("sql", 3, "competences", "t")}
    columns = {"dim_source": "source_name string, source_key long, source_type string", "dim_region": "region_name string, region_key long, latitude double, longitude double",
               "dim_company": "company_name string, company_key long", "dim_contract": "contract_type string, contract_key long",
               "dim_skill": "skill_name string, skill_key long, skill_type string, skill_category string"}
    tables = {t: spark.createDataFrame([row], columns[t]) for t, row in dims.items()}
    tables["fact_offers"] = spark.createDataFrame([], "offer_key long, uid string")
    tables["fact_offer_skill"] = spark.createDataFrame([], "offer_key long, skill_key long")
    schema = ("seq long, offer_id string, title string, company_name string, location string, source string, region_name string, contract_type string, "
              "url string, salary string, remote string, description string, all_skills string")
    rows = [(1, None, "t1", "acme", "x", "a", "Sud", "CDI", None, None, None, "d1", "sql,spark"), (2, None, "t1", "acme", "x", "b", None, None, None, None, None, "later copy", "sql"),
            (None, None, "t2", None, "y", None, None, "CDD", None, None, "yes", "d2", None), (3, None, "t3", "zeta", "y", "a", "Nord", "CDI", None, None, None, "d3", "go,go, spark")]
    out = wh.upsert_rows(tables, spark.createDataFrame(rows, schema), "seq", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    fact = {r["description"]: r for r in out["fact_offers"].collect()}
    assert set(fact) == {"d1", "d2", "d3"} and sorted(r["offer_key"] for r in fact.values()) == [1, 2, 3]
    assert (fact["d1"]["source_key"], fact["d1"]["region_key"], fact["d1"]["company_key"], fact["d1"]["contract_key"]) == (4, 2, 9, 1)
    names = {t: {r[0]: r[1] for r in out[t].collect()} for t in dims}
    assert set(names["dim_company"]) == {"Unknown", "zeta"} and sorted(names["dim_company"].values()) == [10, 11]
    assert names["dim_contract"] == {"CDD": 2} and set(names["dim_source"]) == {"manual"} and set(names["dim_region"]) == {"Unknown", "Nord"}
    assert set(names["dim_skill"]) == {"spark", "go"} and [r["skills_count"] for r in (fact["d1"], fact["d2"], fact["d3"])] == [2, 0, 2]
    assert fact["d2"]["company_key"] == names["dim_company"]["Unknown"]
    assert out["fact_offer_skill"].count() == 4


def test_first_different_rows_of_a_key(spark):
    """Against plain Python, with repeated rows, ties and nulls; nothing is gathered by key in a map."""
    rows = [(1, "b", "x"), (1, "b", "x"), (1, "b", "y"), (1, "a", None), (1, "c", "x"), (2, None, "x"), (2, None, "x"), (None, "a", "x"), (None, "a", "x")]
    df = spark.createDataFrame(rows, "k long, a string, b string")
    got = aggregates.first_different(df, "k", ["a", "b"], 3)
    order = lambda r: tuple((x is not None, x or 0 if i == 0 else x or "") for i, x in enumerate(r))
    wanted = [r for k in (1, 2, None) for r in sorted({r for r in rows if r[0] == k}, key=order)[:3]]
    assert sorted(map(tuple, got.collect()), key=order) == sorted(wanted, key=order)
    assert "HashAggregate" not in got._jdf.queryExecution().toString()


def test_region_profile_holds_no_map_of_offers_and_skills(spark):
    offers = spark.createDataFrame([(k, "north" if k % 2 else "south", "c", k % 3) for k in range(6)],
                                   "offer_key long, region_name string, contract_type string, company_key long")
    links = spark.createDataFrame([(k, "north" if k % 2 else "south", s) for k in range(6) for s in ("a", "a", "b")[:1 + k // 2]],
                                  "offer_key long, region_name string, skill_name string")
    profile = aggregates.region_profile(offers, links)
    assert {r["region_name"]: list(r["top_skills"]) for r in profile.collect()} == {"north": ["a:3", "b:1"], "south": ["a:3", "b:1"]}
    assert not re.search(r"HashAggregate\(keys=\[offer_key", profile._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("few", [0, 100_000])
def test_grouped_weights_shuffle_only_known_terms(spark, few, monkeypatch):
    """Equal weights with and without a broadcast vocabulary; with it only its terms are counted."""
    from offerloom.operators import tfidf
    monkeypatch.setattr(tfidf, "FEW_TERMS", few)
    docs = spark.createDataFrame([(1, "g", ["a", "a", "b"]), (2, "g", ["a", "c"]), (3, "h", ["a"]), (4, None, ["a", "a"]), (5, "g", None)],
                                 "id long, g string, tokens array<string>")
    weights = tfidf.grouped_tfidf(docs, "id", "tokens", "g", min_df=2)
    assert [(r["g"], r["id"], r["term"], round(r["tfidf"], 9)) for r in weights.orderBy("id", "term").collect()] == [("g", 1, "a", 1.0), ("g", 2, "a", 1.0)]
    plan = weights._jdf.queryExecution().executedPlan().toString()
    assert bool(re.search("BroadcastHashJoin", plan[plan.rindex("HashAggregate"):])) == bool(few)  # below the lowest aggregate
