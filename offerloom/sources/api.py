"""Offers of the job-board API: flattening and merging of result lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.functions.offers import first_filled
from offerloom.operators.ranking import keep_first, top_per_group


def unwrap_offers(raw: DataFrame, query: Column | None = None,
                  source: str = "france-travail-api") -> DataFrame:
    """Eleven flat columns from nested API offers; an empty value falls through to the next field."""
    c = F.col
    return raw.select(
        F.lit(source).alias("source"),
        c("id").alias("offer_id"),
        c("intitule").alias("title"),
        c("entreprise.nom").alias("company"),
        first_filled(c("lieuTravail.libelle"), c("lieuTravail.commune")).alias("location"),
        first_filled(c("dateCreation"), c("dateActualisation")).alias("published_date"),
        first_filled(c("typeContratLibelle"), c("typeContrat")).alias("contract_type"),
        first_filled(c("salaire.libelle"), c("salaire.commentaire")).alias("salary"),
        first_filled(c("origineOffre.urlOrigine"), c("origineOffre.url")).alias("url"),
        (F.lit(None).cast("string") if query is None else query).alias("query"),
        c("description"),
    )


def merge_query_results(results: DataFrame, id_col: str, query_rank: str, seq: str,
                        relevant: Column | None = None) -> DataFrame:
    """Each id once, from the first query that returned a relevant version of it."""
    kept = results.where(F.col(id_col).isNotNull() & (F.col(id_col).cast("string") != ""))
    if relevant is not None:
        kept = kept.where(relevant)
    return keep_first(kept, [id_col], [F.col(query_rank), F.col(seq)])


def cap_per_query(results: DataFrame, query: str, order: list[Column], cap: int) -> DataFrame:
    """At most ``cap`` results per query, as the collection settings ask."""
    return top_per_group(results, [query], order, cap)
