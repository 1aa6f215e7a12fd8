"""Crawl logs: JSON lines of several record types."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

PREVIEW = "map<string,string>"
#: One schema for all record types; fields that a type lacks are null.
SCHEMA = (
    "record_type string, crawl_run_id string, search_run_id string, search_definition_id string, search_name string, source string, job_id string, job_url string, rank int, page_start int, "
    "status_code int, blocked boolean, item_count int, fetched_at string, url string, scraped_at string, is_external boolean, list_preview map<string,string>, parse_ok boolean, last_error string, "
    "job_title string, company_name string, job_location string, posted_time_ago string, job_description string, criteria string, main_total int, main_displayed int, corrupt string"
)


def read_log(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All parseable records with `seq`, their order: by file and place in it. Blank lines are skipped; broken ones stay out, `recover` counts them."""
    rows = spark.read.schema(SCHEMA).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt").json(paths)
    return rows.filter("corrupt is null").drop("corrupt").withColumn("seq", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")))


def counted_log(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, Observation]:
    """read_log, and an observation of what it met: kept and skipped lines, and job details without a job. It is filled by the first action on the rows, without another scan."""
    rows = spark.read.schema(SCHEMA).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt").json(paths)
    seen, nameless = Observation(), (F.col("record_type") == "job_detail") & (F.coalesce("job_id", F.lit("")) == "")
    rows = rows.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("seq"))
    rows = rows.observe(seen, F.count_if(F.col("corrupt").isNull()).alias("kept"), F.count_if(F.col("corrupt").isNotNull()).alias("skipped"), F.count_if(F.col("corrupt").isNull() & nameless).alias("nameless"))
    return rows.filter("corrupt is null").drop("corrupt"), seen


def split(log: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(page fetches, discovered jobs, job details); other types are dropped."""
    of = lambda kind: log.filter(F.col("record_type") == kind)
    return of("page_fetch"), of("job_discovered"), of("job_detail").filter("job_id <> ''")


def skipped_details(log: DataFrame) -> DataFrame:
    """One row: job details that `split` leaves out as they name no job."""
    return log.agg(F.count_if((F.col("record_type") == "job_detail") & (F.coalesce("job_id", F.lit("")) == "")).alias("skipped"))


def recover(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row: lines kept and lines skipped because they were cut off."""
    lines = spark.read.text(paths).filter("trim(value) <> ''")
    return lines.agg(F.count_if(F.try_parse_json("value").isNotNull()).alias("kept"), F.count_if(F.try_parse_json("value").isNull()).alias("skipped"))


def merge(spark: SparkSession, parts: list[str]) -> DataFrame:
    """Part files as one log, in the order given: `seq` goes by part, then by the order inside it."""
    out = None
    for i, path in enumerate(parts):
        rows = read_log(spark, path).withColumn("seq", F.struct(F.lit(i).alias("part"), "seq.file", "seq.block", "seq.line"))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select("page_id", "url", "html")


def report_json(df: DataFrame) -> DataFrame:
    """Each row as one JSON document."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("report"))
