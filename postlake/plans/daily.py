"""Counts of distinct jobs for any window, kept up to date: bitmaps of job numbers by day, merged when they are asked for.

A job's facts are (metric, value, time): it was posted, names a skill, was seen, was seen with remote work. They are stored by day, beside the state of each day, a bitmap of
job numbers for each metric and value. When jobs arrive or change, only the days on which they have or had facts are read and made again. A window that begins inside a day
takes that day's facts by their times and all later days by their bitmaps, so it is exact.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.functions import skills
from postlake.plans import places
from postlake.plans.unified import KEY, event_ts
from postlake.sources.versions import Lake

FACTS = "platform string, job_id string, job_no long, metric string, value string, at timestamp, day date"
STATES = "day date, metric string, value string, part long, bits binary"
NUMBERS = "platform string, job_id string, job_no long, days array<date>"
#: Lanes in which new jobs are numbered side by side; lane k takes the numbers that leave k.
LANES = 64


def create(lake: Lake, day_buckets: int = 128, job_buckets: int = 64) -> None:
    """Empty tables."""
    of = lambda schema: lake.spark.createDataFrame([], schema)
    with lake.change() as now:
        now.put("facts", of(FACTS), keys=["day"], buckets=day_buckets)
        now.put("states", of(STATES), keys=["day"], buckets=day_buckets)
        now.put("numbers", of(NUMBERS), keys=KEY, buckets=job_buckets)
        now.put("counter", of("next long"))


def facts(base: DataFrame) -> DataFrame:
    """KEY, metric, value, at, day of unified jobs (one row a job); times that are null give none."""
    posted, seen = event_ts(), F.col("last_seen_at")
    one = lambda metric, at, value="": F.struct(F.lit(metric).alias("metric"), (F.lit(value) if isinstance(value, str) else value).alias("value"), at.alias("at"))
    named = F.array_distinct(F.transform(skills.skill_values(F.col("extracted_skills")), lambda s: F.lower(F.trim(s))))
    named = F.transform(F.filter(named, lambda s: s != ""), lambda s: one("skill", posted, s))
    away = F.when(F.coalesce(places.remote_like(), F.lit(False)), F.array(one("remote", seen))).otherwise(F.array().cast("array<struct<metric:string,value:string,at:timestamp>>"))
    rows = base.select(*KEY, F.explode(F.concat(F.array(one("job", posted), one("active", seen)), named, away)).alias("f")).select(*KEY, "f.*").filter("at is not null")
    return rows.withColumn("day", F.to_date("at"))


def _states(rows: DataFrame) -> DataFrame:
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("job_no")).alias("bits")
    return rows.groupBy("day", "metric", "value", F.bitmap_bucket_number("job_no").alias("part")).agg(bits)


def update(lake: Lake, jobs: DataFrame) -> list:
    """Puts unified jobs (one row each) in the place of their older rows, or adds them; returns the days that were made again.

    Read and written are the buckets of those days and of these jobs' numbers, nothing else.
    """
    with lake.change() as now:
        counter = now.read("counter").first()
        start = counter["next"] if counter else 0
        fresh = facts(jobs)
        days_of = fresh.groupBy(*KEY).agg(F.array_sort(F.collect_set("day")).alias("days"))
        days_of = jobs.select(*KEY).join(days_of, KEY, "left").withColumn("days", F.coalesce("days", F.array().cast("array<date>")))

        before: list[DataFrame] = []

        def numbered(known: DataFrame) -> DataFrame:
            before.append(known.join(jobs.select(*KEY), KEY, "left_semi"))
            old = known.withColumnRenamed("days", "_old").join(days_of, KEY, "left")
            kept = old.select(*KEY, "job_no", F.coalesce("days", "_old").alias("days"))
            new = days_of.join(known.select(*KEY), KEY, "left_anti").withColumn("_lane", F.pmod(F.xxhash64(*KEY), F.lit(LANES)))
            number = F.lit(start) + (F.row_number().over(Window.partitionBy("_lane").orderBy(*KEY)) - 1) * LANES + F.col("_lane")
            return kept.unionByName(new.withColumn("job_no", number.cast("long")).select(*KEY, "job_no", "days"))

        now.rewrite("numbers", jobs, numbered)
        if not before:
            return []
        earlier = before[0].select(F.explode("days").alias("day"))
        touched = fresh.select("day").unionByName(earlier).distinct()
        days = sorted(r["day"] for r in touched.collect())  # one row a day
        here = now.read("numbers", now.buckets_of("numbers", jobs)).select(*KEY, "job_no")
        added = fresh.join(here, KEY).select(*[c.split()[0] for c in FACTS.split(", ")])
        which = lake.spark.createDataFrame([(d,) for d in days], "day date")
        now.rewrite("facts", which, lambda rows: rows.join(jobs.select(*KEY), KEY, "left_anti").select(*added.columns).unionByName(added))
        made = F.col("day").isin(days) if days else F.lit(False)
        again = now.read("facts", now.buckets_of("facts", which)).filter(made)
        now.rewrite("states", which, lambda rows: rows.filter(~made).unionByName(_states(again)))
        last = here.agg(F.max("job_no")).first()[0]
        now.put("counter", lake.spark.createDataFrame([(max(start, (last // LANES + 1) * LANES if last is not None else 0),)], "next long"))
        return days


def counts(lake: Lake, metric: str, since: Column) -> DataFrame:
    """(value, jobs_unique) of a metric from a time on: whole days by their bitmaps, the day in which it lies by its facts."""
    state = lake.manifest()
    first = lake.spark.range(1).select(since.cast("timestamp").alias("at"), F.to_date(since.cast("timestamp")).alias("day")).first()
    which = lake.spark.createDataFrame([(first["day"],)], "day date")
    whole = lake.read("states", state=state).filter((F.col("metric") == metric) & (F.col("day") > F.lit(first["day"]))).select("value", "part", "bits")
    part = lake.read("facts", lake.buckets_of("facts", which, state), state).filter((F.col("metric") == metric) & (F.col("day") == F.lit(first["day"])) & (F.col("at") >= since))
    both = whole.unionByName(_states(part).select("value", "part", "bits"))
    return _merged(both, ["value"])


def _merged(rows: DataFrame, by: list[str]) -> DataFrame:
    """Distinct jobs of the bitmaps of each group."""
    merged = rows.groupBy(*by, "part").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).cast("long").alias("jobs_unique"))


def monthly_trend(lake: Lake, as_of: Column, months: int = 12) -> DataFrame:
    """analytics.monthly_trend from the states."""
    first = F.date_trunc("month", F.add_months(as_of, -(months - 1)).cast("timestamp"))
    rows = lake.read("states").filter((F.col("metric") == "job") & (F.col("day") >= F.to_date(first))).withColumn("bucket_start", F.date_trunc("month", F.col("day").cast("timestamp")))
    series = lake.spark.range(1).select(F.explode(F.sequence(first, F.date_trunc("month", as_of), F.expr("INTERVAL 1 MONTH"))).alias("bucket_start"))
    return series.join(_merged(rows, ["bucket_start"]), "bucket_start", "left").select("bucket_start", F.coalesce("jobs_unique", F.lit(0)).cast("long").alias("jobs_unique")).orderBy("bucket_start")


def top_skills(lake: Lake, as_of: Column, windows: tuple[int, ...] = (30, 90)) -> DataFrame:
    """analytics.top_skills from the states."""
    out = None
    for w in windows:
        rows = counts(lake, "skill", as_of - F.lit(timedelta(days=w))).select(F.lit(w).alias("days_window"), F.col("value").alias("skill"), "jobs_unique")
        out = rows if out is None else out.unionByName(rows)
    return out


def active(lake: Lake, as_of: Column, days: int = 60) -> DataFrame:
    """One row: total_active_jobs and remote_roles of analytics.kpis from the states."""
    since = as_of - F.lit(timedelta(days=days))
    of = lambda metric, name: counts(lake, metric, since).agg(F.coalesce(F.sum("jobs_unique"), F.lit(0)).alias(name)).withColumn("_one", F.lit(1))
    return of("active", "total_active_jobs").join(of("remote", "remote_roles"), "_one").drop("_one")
