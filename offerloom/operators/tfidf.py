"""TF-IDF with smoothed idf and unit-length documents.

weight = tf * (ln((1 + n) / (1 + df)) + 1), each document divided by its L2 norm; the
vocabulary keeps terms with min_df <= df <= max_df * n and, of those, the
``max_features`` most frequent in the corpus (ties by term).

Corpus-wide: the fitted vocabulary (at most ``max_features`` rows) goes to the
driver and documents are vectorised row by row, without a shuffle.  Per group: one
relational plan with the group in every key, no loop over groups.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from offerloom.functions.text import each
from offerloom.operators.ranking import top_per_group
from offerloom.session import materialize

MAX_DRIVER_FEATURES = 10_000
#: Rows of a vocabulary by group that is broadcast.
FEW_TERMS = 100_000


def _term_statistics(docs: DataFrame, tokens: str, group: str | None) -> DataFrame:
    """Corpus frequency and document frequency per (group, term), in one pass over the text."""
    keys = [group] if group else []
    # sorted, so that a document's first occurrence of a term is the one after another term
    rows = docs.select(*keys, F.array_sort(tokens).alias("__sorted"))
    rows = rows.select(*keys, F.posexplode(F.concat("__sorted", F.array().cast("array<string>"))).alias("__at", "term"), "__sorted")
    first = (F.col("__at") == 0) | ~F.get("__sorted", F.col("__at") - 1).eqNullSafe(F.col("term"))
    return rows.groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("cf"), F.count_if(first).alias("df"))


def group_sizes(docs: DataFrame, group: str) -> DataFrame:
    return docs.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"))


def vocabulary(docs: DataFrame, tokens: str, *, group: str | None = None, min_df: int = 1, max_df: float = 1.0,
               max_features: int | None = None, min_docs: int = 1) -> DataFrame:
    """Kept terms with cf, df, the number of documents n and idf; smaller groups have no terms."""
    stats = _term_statistics(docs, tokens, group)
    if group:
        sizes = group_sizes(docs, group).where(F.col("n") >= min_docs)
        stats = stats.join(sizes, group)
    else:
        stats = stats.withColumn("n", docs.agg(F.count(F.lit(1))).scalar())
    kept = stats.where((F.col("df") >= min_df) & (F.col("df") <= F.col("n") * F.lit(max_df)))
    order = [F.desc("cf"), F.asc("term")]
    if max_features is not None:
        kept = top_per_group(kept, [group], order, max_features) if group else kept.orderBy(*order).limit(max_features)
    return kept.withColumn("idf", F.ln((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0)


def grouped_tfidf(docs: DataFrame, id_col: str, tokens: str, group: str, *, min_df: int = 2,
                  max_df: float = 1.0, max_features: int = 50, min_docs: int = 1) -> DataFrame:
    """(group, id, term, tfidf), every group with its own vocabulary and document frequencies."""
    vocab = vocabulary(docs, tokens, group=group, min_df=min_df, max_df=max_df, max_features=max_features,
                       min_docs=min_docs)
    vocab = materialize(vocab.select(group, "term", "idf"))
    terms = docs.select(group, id_col, each(F.col(tokens)).alias("term"))
    if vocab.count() <= FEW_TERMS:  # other tokens end in the map task
        counts = terms.join(F.broadcast(vocab), [group, "term"]).groupBy(group, id_col, "term", "idf").agg(F.count(F.lit(1)).alias("tf"))
    else:  # what meets the vocabulary is one row per document and term
        counts = terms.groupBy(group, id_col, "term").agg(F.count(F.lit(1)).alias("tf")).join(vocab, [group, "term"])
    weights = counts.select(group, id_col, "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(W.partitionBy(group, id_col)))
    return weights.withColumn("tfidf", F.col("w") / norm).drop("w")


def regional_terms(docs: DataFrame, id_col: str, tokens: str, group: str, *, min_docs: int = 5,
                   max_features: int = 50, top: int = 20) -> DataFrame:
    """Leading terms by mean TF-IDF of every group with enough documents."""
    weights = grouped_tfidf(docs, id_col, tokens, group, max_features=max_features, min_docs=min_docs)
    sums = weights.groupBy(group, "term").agg(F.sum("tfidf").alias("s"))
    means = sums.join(group_sizes(docs, group), group).select(
        group, "term", F.round(F.col("s") / F.col("n"), 6).alias("tfidf_score"))
    return top_per_group(means, [group], [F.desc("tfidf_score"), F.asc("term")], top, rank="rank")


@dataclass(frozen=True)
class TfidfModel:
    """A fitted vocabulary with the transforms that use it."""

    terms: list[str]
    idf: list[float]

    def counts(self, docs: DataFrame, tokens: str, out: str = "tf", binary: bool = False) -> DataFrame:
        model = CountVectorizerModel.from_vocabulary(self.terms, inputCol=tokens, outputCol=out, minTF=1.0,
                                                     binary=binary) \
            if binary else CountVectorizerModel.from_vocabulary(self.terms, inputCol=tokens, outputCol=out, minTF=1.0)
        return model.transform(docs)

    def transform(self, docs: DataFrame, tokens: str, out: str = "features") -> DataFrame:
        """Unit-length TF-IDF vectors; documents without a known term get the zero vector."""
        counted = self.counts(docs, tokens, "__tf")
        weighted = ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol="__tf",
                                      outputCol="__w").transform(counted)
        return Normalizer(p=2.0, inputCol="__w", outputCol=out).transform(weighted).drop("__tf", "__w")

    def weights(self, docs: DataFrame, id_col: str, tokens: str) -> DataFrame:
        """Long form (id, term, tfidf) of the non-zero weights."""
        return explode_vector(self.transform(docs.select(id_col, tokens), tokens), id_col, "features",
                              self.terms, "tfidf")

    def mean_terms(self, docs: DataFrame, tokens: str, id_col: str) -> DataFrame:
        """Mean weight per term over all documents (absent counts as zero)."""
        total = docs.agg(F.count(F.lit(1))).scalar()
        return self.weights(docs, id_col, tokens).groupBy("term").agg(F.sum("tfidf").alias("s")).select(
            "term", F.round(F.col("s") / total, 6).alias("tfidf_score"))


    def top_terms(self, docs: DataFrame, id_col: str, tokens: str, k: int) -> DataFrame:
        """The k highest weights of each document, chosen inside the row (no shuffle)."""
        vectors = self.transform(docs.select(id_col, tokens), tokens)
        entries = F.transform(_named_entries("features", self.terms), lambda x: F.struct(
            (-F.round(x.w, 6)).alias("o"), x.term.alias("term")))
        best = F.slice(F.array_sort(entries), 1, k)
        return vectors.select(id_col, F.posexplode(best).alias("pos", "x")).select(
            id_col, F.col("x.term").alias("term"), (-F.col("x.o")).alias("tfidf"), (F.col("pos") + 1).alias("rank"))


def _named_entries(vector: str, names: list[str]) -> Column:
    labels = F.array(*[F.lit(n) for n in names])
    return F.filter(F.arrays_zip(labels.alias("term"), vector_to_array(F.col(vector)).alias("w")), lambda x: x.w != 0)


def explode_vector(df: DataFrame, id_col: str, vector: str, names: list[str], value: str) -> DataFrame:
    """Non-zero entries of a vector column with their names."""
    return df.select(id_col, F.explode(_named_entries(vector, names)).alias("x")).select(
        id_col, F.col("x.term").alias("term"), F.col("x.w").alias(value))


def fit_tfidf(docs: DataFrame, tokens: str, *, min_df: int = 1, max_df: float = 1.0,
              max_features: int = 200) -> TfidfModel:
    """Fits the vocabulary; at most ``max_features`` rows reach the driver."""
    if max_features > MAX_DRIVER_FEATURES:
        raise ValueError(f"max_features must not exceed {MAX_DRIVER_FEATURES}")
    rows = vocabulary(docs, tokens, min_df=min_df, max_df=max_df, max_features=max_features) \
        .select("term", "idf").collect()
    rows = sorted(rows, key=lambda r: r["term"])
    return TfidfModel([r["term"] for r in rows], [r["idf"] for r in rows])


def group_terms(docs: DataFrame, tokens: Column, group: str, n: int) -> DataFrame:
    """Most frequent terms per group (one concatenated text per group has a constant idf)."""
    counts = docs.where(F.col(group).isNotNull()).select(group, each(tokens).alias("term")) \
        .groupBy(group, "term").agg(F.count(F.lit(1)).alias("n"))
    return top_per_group(counts, [group], [F.desc("n"), F.asc("term")], n, rank="rank")


def specialisation(terms: DataFrame, group: str, keywords: list[tuple[str, list[str]]],
                   default: str = "généraliste") -> DataFrame:
    """Category with most keywords contained in a group's terms; ties go to the earlier category.

    Keywords are a small parameter, so the substring test is a filter on a literal array.
    """
    rules = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(c).alias("category"), F.lit(k).alias("keyword"))
                      for i, (c, ks) in enumerate(keywords) for k in ks])
    hits = terms.select(group, F.explode(F.filter(rules, lambda r: F.contains(F.lower("term"), r.keyword))).alias("r"))
    scores = hits.groupBy(group, F.col("r.rank").alias("rank"), F.col("r.category").alias("category")) \
        .agg(F.countDistinct("r.keyword").alias("n"))
    best = scores.groupBy(group).agg(
        F.max_by("category", F.struct("n", (-F.col("rank")).alias("o"))).alias("category"), F.max("n").alias("score"))
    return terms.select(group).distinct().join(best, group, "left").select(
        group, F.coalesce("category", F.lit(default)).alias("category"),
        F.coalesce("score", F.lit(0).cast("bigint")).alias("score"))
