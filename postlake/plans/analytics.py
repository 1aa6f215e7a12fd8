"""KPIs, monthly trend and top skills."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import skills
from postlake.plans import places
from postlake.plans.unified import KEY, event_ts


def kpis(base: DataFrame, as_of: Column, active_days: int | None = 60) -> DataFrame:
    """One row: active jobs, remote roles among them, companies first seen in a week. active_days=None counts all jobs.

    One pass over base (a row a job): jobs are counted by new company, then all together.
    """
    active = F.lit(True) if active_days is None else F.coalesce(F.col("last_seen_at") >= as_of - F.lit(timedelta(days=active_days)), F.lit(False))
    fresh = F.when(F.col("first_seen_at") >= as_of - F.lit(timedelta(days=7)), F.nullif(F.trim("company_name"), F.lit("")))
    rows = base.select(active.alias("active"), (active & F.coalesce(places.remote_like(), F.lit(False))).alias("remote"), fresh.alias("company"))
    rows = rows.groupBy("company").agg(F.count_if("active").alias("active"), F.count_if("remote").alias("remote"))
    counts = {"total_active_jobs": F.sum("active"), "remote_roles": F.sum("remote")}
    return rows.agg(*[F.coalesce(c, F.lit(0)).alias(n) for n, c in counts.items()], F.count("company").alias("new_companies_7d")).withColumn("as_of", as_of)


def monthly_trend(base: DataFrame, as_of: Column, months: int = 12) -> DataFrame:
    """Distinct jobs of each of the last months, zero where none; ascending."""
    first = F.date_trunc("month", F.add_months(as_of, -(months - 1)).cast("timestamp"))
    counted = base.select(*KEY, F.date_trunc("month", event_ts()).alias("bucket_start")).filter(F.col("bucket_start") >= first)
    counted = counted.groupBy("bucket_start").agg(F.count_distinct(F.struct(*KEY)).alias("n"))
    series = base.sparkSession.range(1).select(F.explode(F.sequence(first, F.date_trunc("month", as_of), F.expr("INTERVAL 1 MONTH"))).alias("bucket_start"))
    return series.join(counted, "bucket_start", "left").select("bucket_start", F.coalesce("n", F.lit(0)).cast("long").alias("jobs_unique")).orderBy("bucket_start")


def top_skills(base: DataFrame, as_of: Column, windows: tuple[int, ...] = (30, 90)) -> DataFrame:
    """Distinct jobs by window and skill, in one pass: an event is repeated for the windows it lies in."""
    longest = as_of - F.lit(timedelta(days=max(windows)))
    rows = base.select(*KEY, event_ts().alias("event_ts"), skills.skill_values(F.col("extracted_skills")).alias("s")).filter(F.col("event_ts") >= longest)
    inside = F.array_compact(F.array(*[F.when(F.col("event_ts") >= as_of - F.lit(timedelta(days=w)), F.lit(w)) for w in windows]))
    rows = rows.select(*KEY, inside.alias("w"), F.explode("s").alias("skill")).select(*KEY, "w", F.lower(F.trim("skill")).alias("skill")).filter("skill <> ''")
    return rows.select(*KEY, "skill", F.explode("w").alias("days_window")).groupBy("days_window", "skill").agg(F.count_distinct(F.struct(*KEY)).alias("jobs_unique"))
