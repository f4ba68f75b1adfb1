"""Text mining: TF-IDF, co-occurrence, clusters, topics, word vectors and similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.functions.text import clean_tokens, each, ngrams_1_2, tokenize, words
from offerloom.operators import agglomeration, cooccurrence, density, embeddings, models, neighbourhoods, similarity
from offerloom.operators.ranking import top_per_group
from offerloom.operators.tfidf import (explode_vector, fit_tfidf, group_terms, regional_terms, specialisation)
from offerloom.plans.aggregations import CLEAN_SQL
from offerloom.plans.bindings import STOP_WORDS, documents, links, quoted, table, with_roles
from offerloom.plans.registry import query
from offerloom.session import materialize

WORD_LIST = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"


def word_docs(spark, d):
    return documents(spark, d).select("doc_id", "lang", "source", words(F.col("text")).alias("tokens"))


def tfidf_sql(token_list: str, min_df: int, max_df: float, max_features: int) -> str:
    """Common table expressions ending in w(doc_id, term, tfidf)."""
    return f"""WITH a AS (SELECT doc_id, unnest({token_list}) AS term FROM documents),
nd AS (SELECT count(*) AS n FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM a GROUP BY ALL),
st AS (SELECT term, sum(tf) AS cf, count(*) AS df FROM tf GROUP BY term),
v AS (SELECT term, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM st, nd
  WHERE df >= {min_df} AND df <= {max_df} * n ORDER BY cf DESC, term LIMIT {max_features}),
r AS (SELECT doc_id, term, tf * idf AS x FROM tf JOIN v USING (term)),
w AS (SELECT doc_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS tfidf FROM r)
"""


@query("tfidf", tfidf_sql(WORD_LIST, 5, 0.8, 200) + "SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM w")
def tfidf(spark, d):
    docs = word_docs(spark, d)
    model = fit_tfidf(docs, "tokens", min_df=5, max_df=0.8, max_features=200)
    return model.weights(docs, "doc_id", "tokens").withColumn("tfidf", F.round("tfidf", 6))


@query("tfidf_mean_terms", tfidf_sql(WORD_LIST, 2, 1.0, 50) + """SELECT term,
  round(sum(tfidf) / (SELECT n FROM nd), 6) AS tfidf_score FROM w GROUP BY term""")
def tfidf_mean_terms(spark, d):
    docs = word_docs(spark, d)
    model = fit_tfidf(docs, "tokens", min_df=2, max_features=50)
    return model.mean_terms(docs, "tokens", "doc_id").orderBy(F.desc("tfidf_score"), "term")


@query("tfidf_bigrams", tfidf_sql(f"""list_concat({CLEAN_SQL}, [x[1] || ' ' || x[2] for x in
  list_zip(({CLEAN_SQL})[1:-2], ({CLEAN_SQL})[2:])])""", 2, 0.8, 100) + "SELECT doc_id, term, round(tfidf, 6) AS tfidf FROM w")
def tfidf_bigrams(spark, d):
    docs = documents(spark, d).select("doc_id", ngrams_1_2(clean_tokens(F.lower("text"), STOP_WORDS)).alias("tokens"))
    model = fit_tfidf(docs, "tokens", min_df=2, max_df=0.8, max_features=100)
    return model.weights(docs, "doc_id", "tokens").withColumn("tfidf", F.round("tfidf", 6))


REGIONAL_SQL = rf"""WITH a AS (SELECT source, doc_id, unnest({WORD_LIST}) AS term FROM documents),
nd AS (SELECT source, count(*) AS n FROM documents GROUP BY source HAVING count(*) >= 5),
tf AS (SELECT source, doc_id, term, count(*) AS tf FROM a GROUP BY ALL),
st AS (SELECT source, term, sum(tf) AS cf, count(*) AS df FROM tf GROUP BY ALL),
vr AS (SELECT source, term, n, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf,
  row_number() OVER (PARTITION BY source ORDER BY cf DESC, term) AS k FROM st JOIN nd USING (source) WHERE df >= 2),
r AS (SELECT source, doc_id, term, n, tf * idf AS x FROM tf JOIN (SELECT * FROM vr WHERE k <= 50) USING (source, term)),
w AS (SELECT *, x / sqrt(sum(x * x) OVER (PARTITION BY source, doc_id)) AS tfidf FROM r),
m AS (SELECT source, term, round(sum(tfidf) / n, 6) AS tfidf_score FROM w GROUP BY source, term, n),
q AS (SELECT *, CAST(row_number() OVER (PARTITION BY source ORDER BY tfidf_score DESC, term) AS INTEGER) AS rank FROM m),
top AS (SELECT source, term, tfidf_score, rank FROM q WHERE rank <= 20)
"""


@query("tfidf_by_region", REGIONAL_SQL + "SELECT * FROM top")
def tfidf_by_region(spark, d):
    return regional_terms(word_docs(spark, d), "doc_id", "tokens", "source")


@query("cluster_top_terms", f"""WITH w AS (SELECT lang, unnest({CLEAN_SQL}) AS term FROM documents),
c AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS INTEGER) AS rank FROM c)
SELECT lang, term, n, rank FROM r WHERE rank <= 15""")
def cluster_top_terms(spark, d):
    return group_terms(documents(spark, d), clean_tokens(F.lower("text"), STOP_WORDS), "lang", 15)


KEYWORDS = [("articles", ["the", "der", "les"]), ("liaisons", ["and", "und", "with"]), ("lieux", ["on", "in"])]


def _keyword_sql() -> str:
    return ", ".join(f"({i}, {quoted(c)}, {quoted(k)})" for i, (c, ks) in enumerate(KEYWORDS) for k in ks)


@query("region_specialisation", REGIONAL_SQL + f""", kw AS (SELECT * FROM (VALUES {_keyword_sql()}) AS k(o, category, keyword)),
s AS (SELECT source, o, category, count(DISTINCT keyword) AS n FROM top JOIN kw ON contains(lower(term), keyword) GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, o) AS k FROM s)
SELECT source, coalesce(category, 'généraliste') AS category, coalesce(n, 0) AS score
FROM (SELECT DISTINCT source FROM top) LEFT JOIN (SELECT * FROM b WHERE k = 1) USING (source)""")
def region_specialisation(spark, d):
    terms = regional_terms(word_docs(spark, d), "doc_id", "tokens", "source")
    return specialisation(terms, "source", KEYWORDS)


PRESENT = with_roles("links") + """, p AS (SELECT DISTINCT offer_key, skill_name FROM links),
t AS (SELECT skill_name, count(*) AS df FROM p GROUP BY 1 ORDER BY df DESC, skill_name LIMIT 50),
q AS (SELECT offer_key, skill_name, df FROM p JOIN t USING (skill_name)),
c AS (SELECT a.skill_name AS term_a, b.skill_name AS term_b, count(*) AS together FROM q a JOIN q b
  ON a.offer_key = b.offer_key AND a.skill_name < b.skill_name GROUP BY ALL)
"""


def named_links(spark, d):
    return links(spark, d).select("offer_key", "skill_name").distinct()


@query("binary_skill_matrix", PRESENT + "SELECT offer_key, skill_name FROM q")
def binary_skill_matrix(spark, d):
    return cooccurrence.presence(named_links(spark, d), "offer_key", "skill_name", 50)


@query("skill_correlation", PRESENT + """SELECT a.skill_name AS term_a, b.skill_name AS term_b, round((n * coalesce(together, 0) - a.df * b.df)
  / sqrt(CAST(a.df AS DOUBLE) * (n - a.df) * b.df * (n - b.df)), 6) AS correlation
FROM t a JOIN t b ON a.skill_name < b.skill_name LEFT JOIN c ON c.term_a = a.skill_name AND c.term_b = b.skill_name,
  (SELECT CAST(count(*) AS DOUBLE) AS n FROM orders)""")
def skill_correlation(spark, d):
    return cooccurrence.correlation(named_links(spark, d), "offer_key", "skill_name", table(spark, d, "orders"), 50)


@query("skill_cooccurrence", with_roles("links", extra="named AS (SELECT DISTINCT offer_key, skill_name FROM links)") + """
SELECT a.skill_name AS term_a, b.skill_name AS term_b, count(*) AS together
FROM named a JOIN named b ON a.offer_key = b.offer_key AND a.skill_name < b.skill_name GROUP BY 1, 2""")
def skill_cooccurrence(spark, d):
    return cooccurrence.pair_counts(named_links(spark, d), "offer_key", "skill_name")


@query("top_terms_per_row", tfidf_sql(WORD_LIST, 5, 0.8, 200) + """, k AS (SELECT doc_id, term, round(tfidf, 6) AS tfidf,
  CAST(row_number() OVER (PARTITION BY doc_id ORDER BY round(tfidf, 6) DESC, term) AS INTEGER) AS rank FROM w)
SELECT * FROM k WHERE rank <= 5""")
def top_terms_per_row(spark, d):
    docs = word_docs(spark, d)
    model = fit_tfidf(docs, "tokens", min_df=5, max_df=0.8, max_features=200)
    return model.top_terms(docs, "doc_id", "tokens", 5)


@query("term_weights_per_group", rf"""WITH a AS (SELECT lang, source, unnest({WORD_LIST}) AS term FROM documents),
g AS (SELECT 'all' AS scope, '*' AS grp, term FROM a UNION ALL SELECT 'lang', lang, term FROM a
  UNION ALL SELECT 'source', source, term FROM a),
c AS (SELECT scope, grp, term, count(*) AS n FROM g GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY scope, grp ORDER BY n DESC, term) AS k FROM c)
SELECT scope, grp, term, n FROM r WHERE k <= 100""")
def term_weights_per_group(spark, d):
    """Counted once per (lang, source, term); the wider scopes are summed from those counts."""
    base = word_docs(spark, d).select("lang", "source", each(F.col("tokens")).alias("term")) \
        .groupBy("lang", "source", "term").agg(F.count(F.lit(1)).alias("n"))
    scopes = F.array(*[F.struct(F.lit(s).alias("scope"), g.alias("grp")) for s, g in
                       (("all", F.lit("*")), ("lang", F.col("lang")), ("source", F.col("source")))])
    counts = base.select(F.explode(scopes).alias("s"), "term", "n").groupBy("s.scope", "s.grp", "term") \
        .agg(F.sum("n").alias("n"))
    return top_per_group(counts, ["scope", "grp"], [F.desc("n"), F.asc("term")], 100)


@query("geo_bins", """SELECT CAST(floor((c_nationkey * 1.7 - 20) / 5.0) AS BIGINT) AS lat_bin,
  CAST(floor((c_acctbal / 100.0) / 5.0) AS BIGINT) AS lon_bin, count(*) AS n FROM customer GROUP BY ALL""")
def geo_bins(spark, d):
    from offerloom.operators.aggregates import geo_bins as bins
    points = table(spark, d, "customer").select((F.col("c_nationkey") * F.lit(1.7) - 20).alias("lat"),
                                                (F.col("c_acctbal") / 100.0).alias("lon"))
    return bins(points, "lat", "lon", 5.0)


# --- vectors and models -------------------------------------------------------------

def doc_vectors(spark, d):
    """TF-IDF vectors of all documents (200 terms), written once: what is fitted on them reads them several times."""
    docs = word_docs(spark, d)
    model = fit_tfidf(docs, "tokens", min_df=5, max_df=0.8, max_features=200)
    return model, materialize(model.transform(docs, "tokens").select("doc_id", "features"))


def clustered(vectors):
    return models.fit_kmeans(vectors, 6).transform(vectors)


@query("kmeans_offers")
def kmeans_offers(spark, d):
    return clustered(doc_vectors(spark, d)[1]).select("doc_id", "cluster_id")


@query("silhouette", """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
m AS (SELECT x.vec_id, x.label, y.label AS k, avg(list_distance(x.v, y.v)) AS far FROM e x JOIN e y ON x.vec_id <> y.vec_id GROUP BY ALL),
s AS (SELECT vec_id, max(far) FILTER (k = label) AS a, min(far) FILTER (k <> label) AS b FROM m GROUP BY vec_id)
SELECT round(avg(CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0.0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM s""")
def silhouette(spark, d):
    """Embedding labels as given clusters."""
    given = table(spark, d, "embeddings").select(F.col("embedding").alias("features"), F.col("label").alias("cluster_id"))
    return agglomeration.silhouette(given).select(F.round("silhouette", 6).alias("silhouette"))


@query("silhouette_fitted")
def silhouette_fitted(spark, d):
    return agglomeration.silhouette(clustered(doc_vectors(spark, d)[1]))


@query("pca_2d")
def pca_2d(spark, d):
    _, vectors = doc_vectors(spark, d)
    return models.Projection(vectors).transform(vectors).select("doc_id", "coord_x", "coord_y")


@query("cluster_assignments", """SELECT vec_id AS doc_id, label AS cluster_id, CAST(embedding[1] AS DOUBLE) AS coord_x,
  CAST(embedding[2] AS DOUBLE) AS coord_y, count(*) OVER (PARTITION BY label) AS n,
  round(100.0 * count(*) OVER (PARTITION BY label) / count(*) OVER (), 6) AS pct FROM embeddings""")
def cluster_assignments(spark, d):
    """Embedding labels as given clusters, the first two elements as coordinates."""
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), F.col("label").alias("cluster_id"),
                                                at(0).alias("coord_x"), at(1).alias("coord_y"))
    return models.with_sizes(rows)


@query("cluster_assignments_fitted")
def cluster_assignments_fitted(spark, d):
    _, vectors = doc_vectors(spark, d)
    rows = models.Projection(vectors).transform(clustered(vectors))
    return models.with_sizes(rows.select("doc_id", "cluster_id", "coord_x", "coord_y"))


@query("hierarchical_clusters")
def hierarchical_clusters(spark, d):
    _, vectors = doc_vectors(spark, d)
    return agglomeration.Ward(vectors, 6).transform(vectors).select("doc_id", "cluster_id")


@query("density_clusters")
def density_clusters(spark, d):
    """In the space of the TF-IDF rows."""
    return neighbourhoods.density_clusters(doc_vectors(spark, d)[1], "doc_id", eps=0.5, min_points=5)


@query("density_clusters_plane")
def density_clusters_plane(spark, d):
    """In the plane of the two principal components."""
    _, vectors = doc_vectors(spark, d)
    points = models.Projection(vectors).transform(vectors).select("doc_id", "coord_x", "coord_y")
    return density.density_clusters(points, "doc_id", "coord_x", "coord_y", eps=0.05, min_points=5)


def lda(spark, d):
    docs = word_docs(spark, d)
    model = fit_tfidf(docs, "tokens", min_df=5, max_df=0.8, max_features=200)
    counts = materialize(model.counts(docs, "tokens", "tf").select("doc_id", "tf"))
    return model, counts, models.fit_lda(counts, 6)


@query("lda_topics")
def lda_topics(spark, d):
    model, _, fitted = lda(spark, d)
    return models.topic_terms(fitted, model.terms, 15)


@query("assign_topics", """WITH p AS (SELECT vec_id, [CAST(x AS DOUBLE) * x for x in embedding] AS w FROM embeddings),
q AS (SELECT vec_id, w, list_max(w) AS top, list_sum(w) AS total FROM p)
SELECT vec_id, CAST(list_position(w, top) - 1 AS INTEGER) AS dominant_profile, round(top / total, 6) AS profile_probability FROM q""")
def assign_topics(spark, d):
    """Shares of the squared embedding elements as given topic distributions."""
    squares = F.transform("embedding", lambda x: x.cast("double") * x.cast("double"))
    total = F.aggregate("w", F.lit(0.0), lambda acc, x: acc + x)
    given = table(spark, d, "embeddings").select("vec_id", squares.alias("w")) \
        .select("vec_id", F.transform("w", lambda x: x / total).alias("topic_distribution"))
    return models.assign_topics(given, "vec_id").withColumn("profile_probability", F.round("profile_probability", 6))


@query("assign_topics_fitted")
def assign_topics_fitted(spark, d):
    from pyspark.ml.functions import vector_to_array
    _, counts, fitted = lda(spark, d)
    rows = fitted.transform(counts).select("doc_id", vector_to_array("topic_distribution").alias("topic_distribution"))
    return models.assign_topics(rows, "doc_id")


@query("topic_keywords", f"""WITH w AS (SELECT lang, unnest({CLEAN_SQL}) AS term FROM documents),
c AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL),
r AS (SELECT lang, term, CAST(row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS INTEGER) AS rank FROM c),
t AS (SELECT lang, CAST(row_number() OVER (ORDER BY lang) - 1 AS INTEGER) AS topic_id FROM (SELECT DISTINCT lang FROM documents))
SELECT topic_id, rank, term FROM r JOIN t USING (lang) WHERE topic_id = 2 AND rank <= 10""")
def topic_keywords(spark, d):
    """The leading terms of each language as given topics, numbered in name order."""
    from pyspark.sql import Window
    docs = documents(spark, d)
    # one row per language
    numbers = docs.select("lang").distinct().withColumn(
        "topic_id", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("lang")) - 1)
    given = group_terms(docs, clean_tokens(F.lower("text"), STOP_WORDS), "lang", 15).join(F.broadcast(numbers), "lang")
    return models.topic_keywords(given, 2, 10)


@query("topic_keywords_fitted")
def topic_keywords_fitted(spark, d):
    model, _, fitted = lda(spark, d)
    return models.topic_keywords(models.topic_terms(fitted, model.terms, 15), 2, 10)


@query("nmf_topics")
def nmf_topics(spark, d):
    model, vectors = doc_vectors(spark, d)
    return models.Nmf(6).fit(vectors, len(model.terms)).topic_terms(spark, model.terms, 15)


@query("topic_distribution", """SELECT label AS topic_id, count(*) AS n,
  round(100.0 * count(*) / (SELECT count(*) FROM embeddings), 6) AS pct,
  coalesce(max(n_name), 'Topic ' || label) AS name FROM embeddings
LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 7) ON label = n_nationkey GROUP BY label""")
def topic_distribution(spark, d):
    """Embedding labels as given assignments; topics without a name get a numbered one."""
    names = table(spark, d, "nation").where(F.col("n_nationkey") < 7).select(
        F.col("n_nationkey").alias("topic_id"), F.col("n_name").alias("name"))
    assigned = table(spark, d, "embeddings").select("vec_id", F.col("label").alias("dominant_profile"))
    return models.topic_distribution(assigned, names)


def vocabulary_docs(spark, d):
    return documents(spark, d).select("doc_id", "lang", "source", tokenize(F.col("text")).alias("tokens"))


def word_model(spark, d):
    return embeddings.fit(vocabulary_docs(spark, d), "tokens")


def vectors_of_words(spark, d):
    return word_model(spark, d).vectors()


def paragraph_model(spark, d):
    """Words learned with a vector of every document in its windows, and the documents' vectors against them."""
    docs = vocabulary_docs(spark, d)
    model = embeddings.fit(docs, "tokens", documents=True)
    return model, embeddings.infer(model, docs, "doc_id", "tokens")


def frequent_words(spark, d, n):
    counts = vocabulary_docs(spark, d).select(each(F.col("tokens")).alias("word")).groupBy("word") \
        .agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc("word")).limit(n)


def given_vectors(spark, d):
    """Embeddings as vectors of words whose names are the ids."""
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("word"), F.col("embedding").alias("vector"), "label")


NEAR_SQL = """WITH e AS (SELECT vec_id AS word, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
q AS (SELECT v AS w FROM e WHERE word = 11)
SELECT word, round(list_cosine_similarity(v, w), 6) AS similarity FROM e, q"""


@query("word2vec")
def word2vec(spark, d):
    return vectors_of_words(spark, d)


@query("similar_words", NEAR_SQL + " WHERE word <> 11 ORDER BY similarity DESC, word LIMIT 10")
def similar_words(spark, d):
    vectors = given_vectors(spark, d)
    return similarity.nearest(vectors, "word", "vector", similarity.vector_of(vectors, "word", "vector", 11), 10, exclude=(11,))


@query("similar_words_fitted")
def similar_words_fitted(spark, d):
    vectors = vectors_of_words(spark, d)
    return similarity.nearest(vectors, "word", "vector", similarity.vector_of(vectors, "word", "vector", "avec"), 10,
                              exclude=("avec",))


@query("dissimilar_words", NEAR_SQL + " WHERE word <> 11 AND label <> 3 ORDER BY similarity, word LIMIT 10")
def dissimilar_words(spark, d):
    """The farthest among the words of some groups."""
    vectors = given_vectors(spark, d)
    return similarity.nearest(vectors.where("label <> 3"), "word", "vector", similarity.vector_of(vectors, "word", "vector", 11), 10,
                              exclude=(11,), farthest=True)


@query("dissimilar_words_fitted")
def dissimilar_words_fitted(spark, d):
    vectors = vectors_of_words(spark, d)
    common = vectors.join(frequent_words(spark, d, 1000).select("word"), "word", "left_semi")
    return similarity.nearest(common, "word", "vector", similarity.vector_of(vectors, "word", "vector", "avec"), 10,
                              exclude=("avec",), farthest=True)


@query("word_analogy", """WITH e AS (SELECT vec_id AS word, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT word, [x / sqrt(list_dot_product(v, v)) for x in v] AS w FROM e WHERE word IN (1, 2, 3)),
q AS (SELECT [t[1] - t[2] + t[3] for t in list_zip((SELECT w FROM u WHERE word = 1), (SELECT w FROM u WHERE word = 2),
  (SELECT w FROM u WHERE word = 3))] AS w)
SELECT word, round(list_cosine_similarity(v, w), 6) AS similarity FROM e, q WHERE word NOT IN (1, 2, 3)
ORDER BY similarity DESC, word LIMIT 10""")
def word_analogy(spark, d):
    return similarity.analogy(given_vectors(spark, d), "word", "vector", 1, 2, 3, 10)


@query("word_analogy_fitted")
def word_analogy_fitted(spark, d):
    return similarity.analogy(vectors_of_words(spark, d), "word", "vector", "the", "les", "der", 10)


@query("word_clusters")
def word_clusters(spark, d):
    from pyspark.ml.functions import array_to_vector
    frequent = frequent_words(spark, d, 200)
    vectors = vectors_of_words(spark, d).join(frequent, "word").select(
        "word", "n", array_to_vector("vector").alias("features"))
    return models.fit_kmeans(vectors, 8).transform(vectors).select("word", "n", "cluster_id")


@query("doc_vectors")
def doc_vectors_query(spark, d):
    return paragraph_model(spark, d)[1]


@query("similar_docs", """WITH q AS (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id = 7)
SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), v), 6) AS similarity FROM embeddings, q
WHERE vec_id <> 7 ORDER BY similarity DESC, vec_id LIMIT 10""")
def similar_docs(spark, d):
    vectors = table(spark, d, "embeddings").select("vec_id", "embedding")
    wanted = similarity.vector_of(vectors, "vec_id", "embedding", 7)
    return similarity.nearest(vectors, "vec_id", "embedding", wanted, 10, exclude=(7,))


@query("similar_to_text")
def similar_to_text(spark, d):
    """Documents nearest to one conversation message."""
    model, rows = paragraph_model(spark, d)
    message = table(spark, d, "conversations").where((F.col("conv_id") == 0) & (F.col("turn") == 0)) \
        .select("conv_id", tokenize(F.col("text")).alias("tokens"))
    wanted = embeddings.infer(model, message, "conv_id", "tokens").agg(F.first("vector")).scalar()
    return similarity.nearest(rows, "doc_id", "vector", wanted, 10)
