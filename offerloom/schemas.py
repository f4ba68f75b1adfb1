"""Explicit schemas: readers never infer types."""

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Harmonised offer record, all text (typed columns are derived next to it).
OFFER = _strings(
    "uid", "source", "source_url", "offer_id", "title", "company", "location",
    "contract_type", "salary", "remote", "published_date", "description", "query",
)

RAW_SOURCE_A = _strings(
    "source", "offer_id", "url", "title", "company", "location", "published_date",
    "contract_type", "salary", "query", "description",
)
RAW_SOURCE_B = _strings(
    "source", "url", "offer_id", "title", "employer", "location", "contract_type",
    "salary", "remote", "published_relative", "description",
)
RAW_SOURCE_C = _strings(
    "source", "offer_id", "url", "title", "company", "location", "contract_type",
    "salary", "published_date", "created", "query", "raw_text", "description",
)

# One offer as the job-board API returns it.
RAW_API = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("intitule", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("dateCreation", T.StringType()),
    T.StructField("dateActualisation", T.StringType()),
    T.StructField("typeContrat", T.StringType()),
    T.StructField("typeContratLibelle", T.StringType()),
    T.StructField("entreprise", T.StructType([T.StructField("nom", T.StringType())])),
    T.StructField("lieuTravail", T.StructType([
        T.StructField("libelle", T.StringType()), T.StructField("commune", T.StringType())])),
    T.StructField("salaire", T.StructType([
        T.StructField("libelle", T.StringType()), T.StructField("commentaire", T.StringType())])),
    T.StructField("origineOffre", T.StructType([
        T.StructField("urlOrigine", T.StringType()), T.StructField("url", T.StringType())])),
])

# Fields an external extraction service returns as JSON text.
EXTRACTION = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("contract_type", T.StringType()),
    T.StructField("remote", T.StringType()),
    T.StructField("salary", T.StringType()),
    T.StructField("experience_min", T.DoubleType()),
    T.StructField("management", T.BooleanType()),
    T.StructField("competences", T.ArrayType(T.StringType())),
    T.StructField("savoir_etre", T.ArrayType(T.StringType())),
    T.StructField("published_date", T.StringType()),
])

LEXICON = T.StructType([
    T.StructField("term", T.StringType(), False),
    T.StructField("canonical", T.StringType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("category", T.StringType(), False),
    T.StructField("rank", T.IntegerType(), False),
])

# What the HTML page parser hands to the column expressions.
PARSED_PAGE = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("page_text", T.StringType()),
    T.StructField("raw_text", T.StringType()),
    T.StructField("json_ld", T.ArrayType(T.StringType())),
    T.StructField("block_text", T.StringType()),
])
