"""What the text mining queries read."""

from offerloom.plans import mining


def test_fitted_vectors_are_read_and_not_computed_again(spark, tmp_path):
    rows = [(i, f"alpha beta{i % 3} gamma", "en", "s", 10) for i in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    vectors = mining.doc_vectors(spark, str(tmp_path))[1]
    assert vectors.count() == 30 and vectors.columns == ["doc_id", "features"]
    assert "regexp_extract_all" not in vectors._jdf.queryExecution().toString()


def test_term_statistics_count_each_document_once(spark):
    from offerloom.operators.tfidf import _term_statistics
    docs = spark.createDataFrame([(["b", "a", "b"],), (["b"],), ([],), (None,)], "tokens array<string>")
    found = _term_statistics(docs, "tokens", None)
    assert {r["term"]: (r["cf"], r["df"]) for r in found.collect()} == {"a": (1, 1), "b": (3, 2)}
    assert "array_distinct" not in found._jdf.queryExecution().toString()
