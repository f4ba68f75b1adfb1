"""Structured Streaming jobs, run to the end of the available data."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.plans.bindings import stamp, table
from offerloom.plans.registry import query
from offerloom.plans.star import contributed, warehouse
from offerloom.session import scratch_path
from offerloom.sources.snapshots import read_tables, write_snapshot
from offerloom.streaming import counts, ingest


def stream_of(spark, d, name):
    """A table of the data folder as a stream (the pattern matches a single file as well as a folder)."""
    schema = spark.read.parquet(f"{d}/{name}.parquet").schema
    return ingest.read_stream(spark, f"{d}/{name}.parque[t]", schema)


@query("stream_window_counts", """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n
FROM events GROUP BY ALL""")
def stream_window_counts(spark, d):
    """Daily counts per event type from a file stream. The watermark follows the events' own time and bounds the state;
    each batch writes the windows it changed, and the newest value of a window counts."""
    target = scratch_path(spark, "stream-counts")
    events = stream_of(spark, d, "events")
    windows = counts.window_counts(events.select("ts", "event_type"), "ts", "event_type", "1 day", watermark="7 days")
    ingest.run_to_end(windows, ingest.append_batches(target + "/windows"), target + "/checkpoint", mode="update")
    newest = ingest.latest(spark, target + "/windows", ["window_start", "event_type"], "n",
                           "window_start timestamp, event_type string, n bigint")
    return newest.select(stamp(F.col("window_start")).alias("window_start"), "event_type", "n")


@query("batch_window_counts", """SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type,
  count(*) AS n FROM events GROUP BY ALL""")
def batch_window_counts(spark, d):
    windows = counts.window_counts(table(spark, d, "events").select("ts", "event_type"), "ts", "event_type", "6 hours")
    return windows.select(stamp(F.col("window_start")).alias("window_start"), "event_type", "n")


@query("stream_ingest_dedup", "SELECT DISTINCT md5(text) AS uid FROM documents")
def stream_ingest_dedup(spark, d):
    """Documents as a stream of contributed offers, one a minute: repeats of a uid within a day are dropped by the
    stream, later ones when a batch is added to what is stored."""
    target = scratch_path(spark, "stream-ingest")
    stream = stream_of(spark, d, "documents")
    offers = stream.select(F.md5("text").alias("uid"), "doc_id", "source",
                           F.timestamp_seconds(F.lit(1_700_000_000) + 60 * F.col("doc_id")).alias("received_at"))
    fresh = ingest.first_seen(offers, "uid", "received_at", "1 day")
    ingest.run_to_end(fresh, ingest.append_new(target + "/offers", "uid"), target + "/checkpoint")
    return spark.read.parquet(target + "/offers").select("uid")


@query("stream_upsert", """SELECT DISTINCT md5(text) AS uid FROM documents
UNION ALL SELECT DISTINCT md5(lower(md5(text) || '|' || lang || '|paris')) FROM documents""")
def stream_upsert(spark, d):
    """Documents as a stream of contributed offers onto the bulk-loaded warehouse, one snapshot per batch."""
    root = scratch_path(spark, "stream-upsert")
    write_snapshot(spark, root, warehouse(spark, d))
    handle = ingest.upsert_batches(root, list(read_tables(spark, root)), "seq", F.lit("2024-06-01 12:00:00").cast("timestamp"))
    ingest.run_to_end(contributed(stream_of(spark, d, "documents")), handle, root + "/checkpoint")
    return read_tables(spark, root)["fact_offers"].select("uid")
