"""Append new landing files to a raw table, exactly once, with a file stream.

The reference's append loader re-reads a folder and appends every file it finds, so
running it twice loads the files twice. A Structured Streaming file source records which
files it has consumed in the checkpoint. Each micro-batch takes the names of its files
and goes through the same loader as a batch load (header rule, key check, staged part,
publish). Its part is named after the stream and the batch number, so a batch that is
run again after a failure adds nothing, and rows loaded before stay visible.
``trigger(availableNow=True)`` processes everything that is new and stops, which
fits a scheduled batch job.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from reelmart.sources.catalog import file_for
from reelmart.sources.ingest import load_files


def landing_glob(table: str) -> str:
    """File-name glob of a table's landing files: ``title.basics.tsv``, ``title.basics.2024-06.tsv``…"""
    stem = file_for(table)[: -len(".tsv")]
    return f"{stem}*.tsv"


def append_new_landing_files(spark: SparkSession, landing_dir: str, table: str, raw_root: str,
                             checkpoint_path: str, wait: bool = True,
                             max_files_per_trigger: int | None = None,
                             file_glob: str | None = None, enforce_keys: bool = True) -> StreamingQuery:
    """Append every landing file of ``table`` not seen before to the raw table under ``raw_root``.

    ``file_glob`` overrides the file-name filter (default: the table's landing-file names).
    """
    reader = spark.readStream.format("text").option("pathGlobFilter", file_glob or landing_glob(table))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    names = reader.load(landing_dir).select("_metadata.file_path")
    stream = hashlib.sha256(checkpoint_path.encode()).hexdigest()[:12]

    def append(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        files = [r.file_path for r in batch.distinct().collect()]  # names of the new files only
        if not files:
            return
        load_files(session, files, raw_root, table, "append", enforce_keys, part_name=f"stream-{stream}-{batch_id}")

    query = (names.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint_path)
             .trigger(availableNow=True).start())
    if wait:
        query.awaitTermination()
    return query
