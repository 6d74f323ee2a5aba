"""Append-only landing with Structured Streaming.

Each extraction run drops files for a raw table into a source folder. The
landing stream appends every new file exactly once to the immutable landing
table (full refresh + append, never updates): the file source tracks which
files were read, and every micro-batch overwrites a folder of its own inside the
table, so a batch that is run again after a failure replaces itself. Batch
appends and streams can share a table (the file sink's commit log would hide
the appended files; plain folders hide nothing). ``availableNow`` processes what
has arrived and stops, which suits a scheduled weekly build.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from rankforge.session import checkpoint_dir
from rankforge.sources.schemas import RAW_TABLES


def start_landing(spark: SparkSession, source_dir: str, name: str, landing_root: str,
                  checkpoint: str | None = None, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None, stream: str = "stream") -> StreamingQuery:
    """Start appending new ``source_dir`` files of raw table ``name`` to
    ``landing_root/name``. Returns the running query (``awaitTermination``
    waits for the available files to be landed). Streams with checkpoints of
    their own into one table need different ``stream`` names."""
    reader = spark.readStream.schema(RAW_TABLES[name]).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(source_dir)
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "landing-streams", name)
    table = os.path.join(landing_root, name)

    def land(batch, batch_id):
        batch.write.mode("overwrite").format(fmt).save(os.path.join(table, f"{stream}-{batch_id:08d}"))

    return (src.writeStream.foreachBatch(land)
               .option("checkpointLocation", ckpt)
               .trigger(availableNow=True)
               .start())


def land_available(spark: SparkSession, source_dir: str, name: str, landing_root: str,
                   checkpoint: str | None = None, fmt: str = "parquet") -> None:
    """Land every file that has arrived, then return."""
    q = start_landing(spark, source_dir, name, landing_root, checkpoint, fmt)
    q.awaitTermination()
