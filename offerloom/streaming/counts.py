"""Windowed counts, the same expression for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def window_counts(df: DataFrame, ts: str, key: str, width: str = "1 day", watermark: str | None = None) -> DataFrame:
    """Rows per time window and key; with a watermark, later rows are dropped by the stream."""
    timed = df.withColumn(ts, F.col(ts).cast("timestamp"))
    if watermark:
        timed = timed.withWatermark(ts, watermark)
    return timed.groupBy(F.window(ts, width).alias("w"), key).agg(F.count(F.lit(1)).alias("n")) \
        .select(F.col("w.start").alias("window_start"), key, "n")
