"""CSV, JSON Lines, JSON array, text files and Parquet."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

EXPORT_DESCRIPTION_CHARS = 4000


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Offers CSV: header, quoted multi-line text, doubled quotes."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').option("encoding", "UTF-8").csv(path))


def read_jsonl(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_json_array(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: UTF-8 where the bytes are valid UTF-8, Latin-1 otherwise."""
    raw = spark.read.format("binaryFile").load(path)
    utf8 = F.try_validate_utf8(F.col("content").cast("string"))
    return raw.select("path", F.coalesce(utf8, F.decode("content", "ISO-8859-1")).alias("text"))


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
               limit: int | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    if columns is not None:
        df = df.select(*columns)
    return df if limit is None else df.limit(limit)


def write_csv(df: DataFrame, path: str, description: str = "description",
              max_chars: int | None = None) -> None:
    """CSV export; with ``max_chars`` (some exports use EXPORT_DESCRIPTION_CHARS) the description is cut."""
    if max_chars is not None and description in df.columns:
        df = df.withColumn(description, F.substring(F.col(description), 1, max_chars))
    df.write.mode("errorifexists").option("header", True).option("quote", '"').option("escape", '"') \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False) \
        .option("encoding", "UTF-8").csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line, NULL fields kept, non-ASCII unescaped."""
    df.write.mode("errorifexists").option("ignoreNullFields", False).json(path)


def write_json_array(df: DataFrame, path: str) -> None:
    """JSON array files, one per partition, each streamed row by row."""
    def bracketed(batches):
        opened = False
        for batch in batches:
            rows = ",\n".join(batch.column(0).to_pylist())
            if rows:
                yield pa.RecordBatch.from_pydict({"value": [("," if opened else "[") + rows]})
                opened = True
        yield pa.RecordBatch.from_pydict({"value": ["]" if opened else "[]"]})

    lines = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    lines.mapInArrow(bracketed, "value string").write.mode("errorifexists").option("lineSep", "\n").text(path)


def region_records(terms: DataFrame, group: str, term: str, score: str) -> DataFrame:
    """One nested record per group: the terms by descending score.

    The input holds a bounded top list per group, so the array is bounded too.
    """
    item = F.struct((-F.col(score)).alias("o"), F.col(term).alias("term"), F.col(score).alias("score"))
    ordered = F.array_sort(F.collect_list(item))
    return terms.groupBy(group).agg(
        F.transform(ordered, lambda x: F.struct(x.term.alias("term"), x.score.alias("tfidf_score")))
        .alias("top_terms"))


def write_json_records(terms: DataFrame, path: str, group: str, term: str, score: str) -> None:
    region_records(terms, group, term, score).write.mode("errorifexists").json(path)
