"""Readers, writers and the materialisation modes of the model graph.

* raw scan with a declared schema (no inference)
* append-only landing (full refresh + append)
* view materialisation (lazy, optionally a temp view)
* table materialisation (full rebuild, written to a shared path - this also
  cuts lineage, so downstream models survive executor loss)
* export of a query result to CSV
"""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession

from rankforge.operators.topn import latest_per_key
from rankforge.session import list_names, path_exists, touch
from rankforge.sources.schemas import RAW_TABLES


def read_raw(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Scan one raw landing table with its declared schema: files appended by
    batch runs and the per-batch folders of the landing stream alike."""
    return (spark.read.schema(RAW_TABLES[name]).format(fmt).option("recursiveFileLookup", "true")
                 .load(os.path.join(root, name)))


def read_all_raw(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    return {n: read_raw(spark, root, n, fmt) for n in RAW_TABLES}


def land_append(df: DataFrame, root: str, name: str, fmt: str = "parquet", batch_id: str | None = None) -> bool:
    """Append one extraction batch to the immutable landing table; whether anything was landed.

    With a ``batch_id`` the append can be repeated: the batch goes to a folder of its own, and a marker in
    ``_batches`` says that it is whole. A batch whose marker is there lands no second time; one that failed half-way has
    no marker and replaces what it left. Without an id every call appends.
    """
    rows = df.select(*RAW_TABLES[name].fieldNames())
    table = os.path.join(root, name)
    if batch_id is None:
        rows.write.mode("append").format(fmt).save(table)
        return True
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", batch_id):
        raise ValueError(f"not a batch id: {batch_id!r}")
    marker = os.path.join(table, "_batches", batch_id)
    if path_exists(df.sparkSession, marker):
        return False
    rows.write.mode("overwrite").format(fmt).save(os.path.join(table, f"batch-{batch_id}"))
    touch(df.sparkSession, marker)
    return True


def landed_batches(spark: SparkSession, root: str, name: str) -> list[str]:
    """The ids of the batches that are whole, in order of their ids."""
    return list_names(spark, os.path.join(root, name, "_batches"))


# What makes two landed rows the same record.
LANDING_KEYS = {
    "ranked_list": ["published_date", "rank", "primary_isbn13", "book_uri"],
    "catalogue_search": ["isbn13", "id"],
    "catalogue_isbn": ["isbn13", "id"],
    "pageviews": ["project", "article", "access", "agent", "granularity", "timestamp"],
}


def latest_landing(df: DataFrame, name: str) -> DataFrame:
    """One row for each record of a raw table, its latest landing."""
    return latest_per_key(df, LANDING_KEYS[name], "_airbyte_extracted_at")


def as_view(df: DataFrame, name: str | None = None) -> DataFrame:
    """View materialisation: stays lazy; optionally registered for SQL."""
    if name:
        df.createOrReplaceTempView(name)
    return df


def as_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
             fmt: str = "parquet") -> DataFrame:
    """Table materialisation: overwrite ``path`` and return a scan of it.

    A partitioned write first rebalances rows by the partition columns (an
    AQE-aware hint), so each partition value gets a few files of the advisory
    size instead of one small file per task, and a hot value is still split.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    # The declared schema gives partition columns their own types back, and the
    # selection their own places (folder names alone give neither).
    return df.sparkSession.read.format(fmt).schema(df.schema).load(path).select(*df.columns)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write a query result as CSV with a header row.

    Written by the executors in parallel; ``single_file`` brings the rows of a
    small report together for the final write only (the query itself stays
    parallel).
    """
    out = df.repartition(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)
