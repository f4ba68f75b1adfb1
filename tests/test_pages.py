"""Offer pages with every field, against the SQL twin and the values that the pages state."""

import duckdb

import __spark_entry__ as entry
from tools.check_oracles import compare

PAGE = """<html><head><script>var a = "Stage";</script><script type="application/ld+json">{%s}</script></head><body><h1>%s</h1>
<p>%s</p></body></html>"""
LONG = "Concevoir des tables &amp; des flux. " * 5
ROWS = [
    (1, "https://x/emplois/42.html", PAGE % ('"description": "<p>%s</p> https://y/z Postuler", "hiringOrganization": {"name": " Acme "}' % ("mot " * 40),
                                             "Data Engineer", "À pourvoir : Saint-Étienne - 42, CDI, 38 000 - 42 000 € / an, télétravail partiel, il y a 3 jours")),
    (1, "https://x/emplois/43.html", PAGE % ("broken", "Analyste", "Avant. Description du poste " + LONG + "Profil recherché : moins d'une heure, intérim, 12 €/heure, pas de télétravail")),
    (2, "https://x/1", PAGE % ('"hiringOrganization": {"name": ""}', "Chef", "Contexte " + LONG + " Voir plus. Télétravail total, Lyon - 69, freelance, il y a 2 heures")),
    (3, None, "<h1>CDIste</h1>. lyon - 69 et 12 € par an"),
    (None, "https://x/2", None),
]


def test_all_fields_of_a_page(spark, tmp_path):
    spark.createDataFrame(ROWS, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    found = entry.queries()["parse_html_pages"](spark, str(tmp_path))
    got = {r["url"]: r for r in found.collect()}
    assert len(got) == 5 and set(got[None].asDict()) == {
        "page_id", "source", "url", "offer_id", "title", "employer", "location", "contract_type", "salary", "remote", "published_relative", "description"}
    fields = ("offer_id", "employer", "location", "contract_type", "salary", "remote", "published_relative")
    assert [got["https://x/emplois/42.html"][c] for c in fields] == \
        ["42", "Acme", "Saint-Étienne - 42", "CDI", "38 000 - 42 000 € / an", "hybrid", "il y a 3 jours"]
    assert [got["https://x/emplois/43.html"][c] for c in fields] == ["43", None, None, "intérim", "12 €/heure", "no", "moins d'une heure"]
    assert [got["https://x/1"][c] for c in fields] == [None, None, "Lyon - 69", "freelance", None, "yes", "il y a 2 heures"]
    assert [got[None][c] for c in fields] == [None] * 5 + ["unknown", None]
    assert got["https://x/emplois/42.html"]["description"] == ("mot " * 40).strip()
    assert got["https://x/emplois/43.html"]["description"] == got["https://x/1"]["description"] == LONG.replace("&amp;", "&").strip()
    assert got["https://x/2"]["description"] == "" and got["https://x/2"]["source"] == "hellowork.com"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    result = compare(found, con, entry.oracle_sql()["parse_html_pages"])
    assert result.startswith("ok 5"), result
