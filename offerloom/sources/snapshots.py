"""Versioned Parquet tables: write new files, then log a version that lists the folders of every table.

A reader takes the newest logged version, so a job that dies while writing leaves the previous version in force.
Appending writes the new rows only; the folders of the previous version stay part of the table.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOG_SCHEMA = "folders map<string,array<string>>, version bigint"


def current_version(spark: SparkSession, root: str) -> tuple[int, dict[str, list[str]]] | None:
    """The newest version and the folders of its tables."""
    try:
        log = spark.read.schema(_LOG_SCHEMA).parquet(f"{root}/_versions")
    except AnalysisException:
        return None
    newest = log.orderBy(F.desc("version")).limit(1).collect()
    return (newest[0]["version"], newest[0]["folders"]) if newest else None


def read_snapshot(spark: SparkSession, root: str, table: str) -> DataFrame:
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no snapshot below {root}")
    return spark.read.parquet(*[f"{root}/{folder}" for folder in version[1][table]])


def read_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables of one version."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no snapshot below {root}")
    return {name: spark.read.parquet(*[f"{root}/{f}" for f in folders]) for name, folders in version[1].items()}


def write_all(tables: dict[str, tuple[DataFrame, str]]) -> None:
    """Writes independent tables to their paths; Spark runs their jobs side by side."""
    with ThreadPoolExecutor(max(1, len(tables))) as pool:
        for done in [pool.submit(df.write.parquet, path) for df, path in tables.values()]:
            done.result()


def _publish(spark: SparkSession, root: str, tables: dict[str, DataFrame], previous) -> int:
    version = 1 if previous is None else previous[0] + 1
    before = {} if previous is None else previous[1]
    mark = uuid.uuid4().hex
    folders = {name: [*before.get(name, ()), f"{name}/v{version}-{mark}"] for name in tables}
    write_all({name: (df, f"{root}/{folders[name][-1]}") for name, df in tables.items()})
    entry = spark.createDataFrame([({**before, **folders},)], "folders map<string,array<string>>")
    # a second writer of the same version finds the folder there and fails
    entry.coalesce(1).write.mode("errorifexists").parquet(f"{root}/_versions/version={version}")
    return version


def write_snapshot(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> int:
    """Writes all tables as one version; it becomes visible only when all are complete."""
    previous = current_version(spark, root)
    return _publish(spark, root, tables, (previous[0], {}) if previous else None)


def append_snapshot(spark: SparkSession, root: str, rows: dict[str, DataFrame]) -> int:
    """Adds rows to tables as one version; files are written for the new rows only."""
    return _publish(spark, root, rows, current_version(spark, root))
