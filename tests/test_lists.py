"""List look-ups of any size against a scan of the list."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerloom.functions.geo import Region, geo_region
from offerloom.operators import lists


def brute(text, entries):
    if not text:
        return None
    return next((label for entry, _, label, inside in sorted(entries, key=lambda e: e[1]) if entry is not None and (entry in text or inside and text in entry)), None)


@pytest.mark.parametrize("shard", [100_000, 7])
def test_first_entry_is_that_of_a_scan(spark, monkeypatch, shard):
    monkeypatch.setattr(lists, "SHARD_ENTRIES", shard)
    monkeypatch.setattr(lists, "SHARD_TEXTS", shard + 4)
    rng = np.random.default_rng(1)
    word = lambda n: "".join(rng.choice(list("abé "), n))
    entries = [(word(rng.integers(1, 7)), int(r), f"L{i}", bool(i % 3)) for i, r in enumerate(rng.permutation(40))] + [(None, 99, "none", True)]
    texts = [word(rng.integers(1, 12)) for _ in range(80)] + ["zzz", "", None, "a"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    listed = spark.createDataFrame(entries, "entry string, rank long, label string, inside boolean")
    got = {r["id"]: r["label"] for r in lists.first_in_list(df, "t", listed, ["label"]).collect()}
    assert got == {i: brute(t, entries) for i, t in enumerate(texts)}


def test_an_empty_entry_lies_in_every_text(spark):
    df = spark.createDataFrame([("ab",), ("q",), (None,)], "t string")
    listed = spark.createDataFrame([("", 5, "any"), ("b", 2, "b"), ("q", 9, "q")], "entry string, rank long, label string")
    assert {r["t"]: r["label"] for r in lists.first_in_list(df, "t", listed, ["label"]).collect()} == {"ab": "b", "q": "any", None: None}
    assert lists.first_in_list(df, "t", listed.limit(0), ["label"]).where("label is null").count() == 3


def test_a_list_of_many_entries(spark):
    listed = spark.range(300_000).select(F.concat(F.lit("ville "), F.col("id")).alias("entry"), F.col("id").alias("rank"), F.col("id").alias("label"))
    df = spark.createDataFrame([("a ville 123456 b",), ("ville 299999",), ("ville 1",), ("nowhere",)], "t string")
    got = {r["t"]: r["label"] for r in lists.first_in_list(df, "t", listed, ["label"]).collect()}
    assert got == {"a ville 123456 b": 1, "ville 299999": 2, "ville 1": 1, "nowhere": None}


def test_regions_like_the_expression(spark):
    regions = [Region("Île-de-France", 48.8, 2.3, ("Paris", "Saint-Denis")), Region("Bretagne", 48.2, -2.9, ("Rennes", "Brest"))]
    departments = {"75": "Île-de-France", "35": "Bretagne", "99": "Nulle part"}
    texts = ["Paris 11e", "RENNES (35)", "75 - Brest", "ren", "bretagne sud", "99 - Brest", "Lyon", "", None, "île de france", "35"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    rows = [(c, "city", r.name, r.lat, r.lon) for r in regions for c in r.cities] + [(r.name, "region", r.name, r.lat, r.lon) for r in regions]
    places = spark.createDataFrame([(*x, i) for i, x in enumerate(rows)], "place string, kind string, region string, lat double, lon double, rank long")
    codes = spark.createDataFrame(list(departments.items()), "code string, region string")
    mine = {r["id"]: (r["region"], r["lat"], r["lon"]) for r in lists.locate(df, "t", places, codes).collect()}
    hit = df.select("id", geo_region(F.col("t"), regions, departments).alias("g")).select("id", "g.region", "g.lat", "g.lon")
    assert mine == {r["id"]: (r["region"], r["lat"], r["lon"]) for r in hit.collect()}
