"""Column functions on the awkward inputs: NULL, empty, accents, malformed text."""

import pytest
from pyspark.sql import functions as F

from offerloom.functions import geo, offers as fo, text, web
from offerloom.functions.geo import Region


def values(spark, column_of, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(column_of(F.col("v")).alias("x")).collect()]


def test_contract_order_matters(spark):
    got = values(spark, fo.normalize_contract, ["Contrat à durée INDÉTERMINÉE", "durée déterminée", "cdi ", "Intérim",
                                                "mission", "", None, "indépendant"])
    assert got == ["CDI", "CDD", "CDI", "Intérim", "MISSION", "", None, "Freelance"]


def test_remote(spark):
    assert values(spark, fo.normalize_remote, [" OUI", "partiel", "sur site", "x", None, ""]) == \
        ["yes", "hybrid", "no", "unknown", "unknown", "unknown"]


def test_region_tail(spark):
    assert values(spark, fo.region_from_location_tail, ["Lyon, Rhône ", "Pau", None, "a, "]) == ["Rhône", "Pau", None, ""]


def test_content_uid_ignores_case_and_null(spark):
    df = spark.createDataFrame([("Data", None, "Paris"), ("DATA", "", "paris")], "t string, c string, l string")
    assert len({r[0] for r in df.select(fo.content_uid(F.col("t"), F.col("c"), F.col("l"))).collect()}) == 1


def test_list_literals(spark):
    got = values(spark, text.parse_list_literal, ["[]", "['a', \"l'b\"]", "oops", None])
    assert got == [[], ["a", "l'b"], [], []]
    fallback = values(spark, lambda c: text.parse_list_literal(c, comma_fallback=True), ["a, b", "['x']", None])
    assert fallback == [["a", "b"], ["x"], []]


def test_json_reply(spark):
    got = values(spark, text.parse_json_reply, ['```json\n{"title": "T"}\n```', "non", '{"title": "x', None])
    assert got[0].title == "T" and got[1:] == [None, None, None]


def test_slug_and_accents(spark):
    assert values(spark, text.slugify, ["  Développeur C++ / Été ", None, "--a--b"]) == ["developpeur-c-ete", "", "a-b"]
    assert values(spark, text.fold_place, ["Saint-Étienne", "L'Haÿ"]) == ["saint etienne", "l hay"]


def test_noise_keeps_text(spark):
    long = "mot " * 2000
    got = values(spark, text.strip_noise, ["<b>Postuler</b> ici https://a.b/c?d fin", long])
    assert got[0] == "ici fin" and len(got[1]) == 7999
    assert len(values(spark, lambda c: text.strip_noise(c, max_chars=5000), [long])[0]) == 5000


def test_page_reader():
    from offerloom.sources.pages import _read_page
    assert _read_page("<h1>A</h1><p>x</p><h1>B</h1>")[0] == "A"
    assert len(_read_page("<div>x" * 100_000)[2]) == 199_999


def test_references_that_are_cut_off_stay():
    from offerloom.sources.pages import _read_page
    title, shown, _, scripts, _ = _read_page(
        '<h1>a &amp; b &amp</h1><p>&lt &quot;x&quot; &copynow &nosuch; R&D && &#38; &#x26 \ufdd0</p>'
        '<script type="application/ld+json">R&D &amp &amp;</script>')
    assert title == "a & b &amp" and shown == 'a & b &amp &lt "x" &copynow &nosuch; R&D && & & \ufdd0'
    assert scripts == ["R&D &amp &amp;"]


def test_skill_text(spark):
    assert values(spark, text.normalize_skill_text, ["N.L.P  et\nA.B.C.D"]) == ["NLP et ABC.D"]


REGIONS = (Region("Auvergne-Rhône-Alpes", 1.0, 2.0, ("Lyon",)), Region("Nouvelle-Aquitaine", 3.0, 4.0, ("Pau",)),
           Region("Corse", 5.0, 6.0, ("Ajaccio",)))


def test_geo_rules(spark):
    got = values(spark, lambda c: geo.geo_region(c, REGIONS, {"69": "Auvergne-Rhône-Alpes", "64": "Nouvelle-Aquitaine"}),
                 ["69 - Lyon", "75001 Paris", "2A - Ajaccio", "-", "Saint-Paul", "", None, "ly", "corse du sud", "64 Lyon"])
    assert [g and g.region for g in got] == [
        "Auvergne-Rhône-Alpes", None, "Corse", None, "Nouvelle-Aquitaine", None, None, "Auvergne-Rhône-Alpes", "Corse",
        "Nouvelle-Aquitaine"]


def test_geo_reference_is_bounded():
    with pytest.raises(ValueError):
        geo.geo_region(None, [Region("r", 0, 0, ("c",) * 100_001)], {})


def test_query_parameters(spark):
    url = "https://a.b/p?x=1&p=2&x=9&e=#frag"
    assert values(spark, lambda c: web.set_query_param(c, {"p": "3"}), [url]) == ["https://a.b/p?x=1&p=3#frag"]
    assert values(spark, lambda c: web.set_query_param(c, {"x": None, "p": None}), [url]) == ["https://a.b/p#frag"]
    assert values(spark, lambda c: web.set_query_param(c, {"q": "é a"}), ["https://a.b/"]) == ["https://a.b/?q=%C3%A9+a"]


def test_page_patterns(spark):
    page = "Poste Nantes - 44 en CDI, 2 000 - 2 500 € / mois. Pas de télétravail. Moins d'une heure"
    assert values(spark, web.page_location, [page]) == ["Poste Nantes - 44"]
    assert values(spark, web.page_salary, [page, "rien"]) == ["2 000 - 2 500 € / mois", None]
    assert values(spark, web.page_remote, [page, "télétravail hybride"]) == ["no", "hybrid"]
    assert values(spark, web.page_relative_date, [page]) == ["Moins d'une heure"]


def test_categories_keep_priority(spark):
    df = spark.createDataFrame([("Data Engineer et NLP", None), ("autre", "big data"), (None, None)], "t string, d string")
    rules = (("science", ("nlp",)), ("engineering", ("data engineer", "big data")))
    got = [r[0] for r in df.select(fo.categorize_job(F.col("t"), F.col("d"), rules)).collect()]
    assert got == ["science", "engineering", "other"]
