"""One row per job of any platform, with its normalised posting time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import posted

KEY = ["platform", "job_id"]


def unify(jobs: DataFrame, details: DataFrame) -> DataFrame:
    """Jobs with the fields of their details and posted_at_utc, its source, parse flag and parse detail."""
    rows = jobs.join(details, KEY, "left").withColumn("posted", posted.parsed(F.col("posted_time_ago"), F.col("scraped_at")))
    norm, unit, native = F.col("posted.norm"), F.col("posted.unit"), (F.col("platform") == "xing") & F.col("native_posted_at_utc").isNotNull()
    source = (
        F.when(native, "native_xing_posted_at_utc").when(norm.isNull(), "missing_input").when(posted.is_keyword(norm), "parsed_keyword")
        .when(F.col("posted.english"), "parsed_relative_en").when(unit.isNotNull(), "parsed_relative_de").otherwise("unparsed_format")
    )
    detail = F.when(native, "posted_at_utc").when(norm.isNull(), "missing_input").otherwise(F.coalesce(unit, norm))
    rows = rows.withColumns({"posted_at_utc": F.when(native, F.col("native_posted_at_utc")).otherwise(F.col("posted.at")), "posted_at_source": source, "posted_at_parse_detail": detail})
    return rows.withColumn("posted_at_parse_ok", F.col("posted_at_utc").isNotNull()).drop("posted")


def event_ts() -> Column:
    return F.coalesce("posted_at_utc", "first_seen_at")
