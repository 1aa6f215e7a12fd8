"""Crawl logs as a file stream: each micro-batch goes through the batch functions, so both give the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlake.functions.intake import parse_time
from postlake.operators import ingest
from postlake.sources.logs import SCHEMA, split
from postlake.sources.versions import Change, Lake


def stream_log(spark: SparkSession, path: str, checkpoint: str, apply: Callable[[DataFrame, int], None], max_files: int = 100) -> StreamingQuery:
    """Starts a query that hands every batch of new log files to apply(batch, id); it stops when there are no more.

    Rows have `seq`, their order in the batch, by file and place in it, as those of read_log; broken lines stay out. After a failure the last batch is handed over
    again, with the same id and rows.
    """
    rows = spark.readStream.schema(SCHEMA).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt").option("maxFilesPerTrigger", max_files).json(path)
    rows = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))

    def ordered(batch: DataFrame, number: int) -> None:
        seq = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), F.monotonically_increasing_id().alias("line"))
        apply(batch.withColumn("seq", seq).filter("corrupt is null").drop("corrupt", "_file", "_block"), number)

    return rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(ordered).start()


def apply_log(now: Change, log: DataFrame) -> None:
    """Applies log lines to the tables jobs, hits and details of a change, bucket by bucket: discovered jobs, their hits, details, postings that are gone."""
    keyed = log.withColumns({"platform": F.col("source"), "scraped_at": parse_time(F.col("scraped_at"))})
    _, found, details = split(keyed)
    now.rewrite("jobs", found, lambda jobs: ingest.apply_discovery(jobs, found))
    now.rewrite("hits", found.filter("search_run_id is not null"), lambda hits: ingest.add_hits(hits, found))
    now.rewrite("details", details, lambda rows: ingest.apply_details(rows, details))
    now.rewrite("jobs", details, lambda jobs: ingest.apply_gone(jobs, details))


def import_stream(lake: Lake, path: str, checkpoint: str, name: str = "log", apply: Callable[[Change, DataFrame], None] = apply_log, max_files: int = 100) -> StreamingQuery:
    """stream_log into a lake: tables and the number of the batch are published together, so a batch that comes again changes nothing."""
    return stream_log(lake.spark, path, checkpoint, lambda batch, number: lake.apply_batch(name, batch, number, apply) and None, max_files)
