"""Run reports, reconciliation with external runs, and data-quality checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATUSES = ("success", "blocked", "failed", "running")


def runs_by_day(runs: DataFrame, at: str = "started_at") -> DataFrame:
    """UTC day and trigger: runs, and runs by status."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    return runs.groupBy(F.date_format(at, "yyyy-MM-dd").alias("day"), "trigger").agg(F.count("*").alias("total"), *counts)


def external_by_day(external: DataFrame) -> DataFrame:
    """UTC day: scheduled external runs by conclusion."""
    rows = external.filter("event = 'schedule'")
    return rows.groupBy(F.date_format("created_at", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("total"), *[F.count_if(F.col("conclusion") == c).alias(c) for c in ("success", "failure", "cancelled")])


def day_comparison(external: DataFrame, runs: DataFrame) -> DataFrame:
    """Both sides by day, zero where one has none."""
    left = external_by_day(external).select("day", *[F.col(c).alias(f"ext_{c}") for c in ("total", "success", "failure", "cancelled")])
    right = runs_by_day(runs).groupBy("day").agg(*[F.sum(c).alias(f"run_{c}") for c in ("total", *STATUSES)])
    both = left.join(right, "day", "full_outer")
    return both.select("day", *[F.coalesce(c, F.lit(0)).alias(c) for c in both.columns if c != "day"])


def nearest(left: DataFrame, right: DataFrame, on: str, left_at: str, right_at: str, left_id: str, right_id: str, within: int) -> DataFrame:
    """For each left row the right row of the same `on` nearest in time, within `within` seconds; the later one on ties.

    Seconds meet, not rows: of the right rows of one second only that with the smallest id can be the nearest. Seconds are dealt into buckets of `within`, those of
    the right also into the two beside theirs, and inside a bucket the last one before and the first one after each left second are carried along in
    order. So a bucket holds at most four seconds for each one that it is long, however many rows there are, and no pair is made that is not the answer.
    Neither join is broadcast by Spark's guess, which takes compressed files for rows.
    """
    size = max(int(within), 1)
    second, bucket = F.unix_timestamp, F.floor(F.col("_s") / size)
    asked = left.select(on, second(left_at).alias("_s")).distinct()
    known = right.groupBy(on, second(right_at).alias("_s")).agg(F.min(F.struct(right_id, "status")).alias("_r"))
    known = known.select(on, "_s", F.struct(F.col("_s").alias("at"), f"_r.{right_id}", "_r.status").alias("_k"), F.explode(F.array(*[bucket + d for d in (-1, 0, 1)])).alias("_b"))
    rows = known.unionByName(asked.select(on, "_s", bucket.alias("_b")), allowMissingColumns=True)
    beside = lambda order: F.last("_k", ignorenulls=True).over(Window.partitionBy(on, "_b").orderBy(order))
    rows = rows.withColumns({"_before": beside(F.col("_s")), "_after": beside(F.col("_s").desc())}).filter("_k is null")
    passed, ahead = F.col("_s") - F.col("_before.at"), F.col("_after.at") - F.col("_s")
    best = F.when(ahead <= F.least(passed, F.lit(within)), F.col("_after")).when(passed <= within, F.col("_before"))
    best = rows.select(on, "_s", best.alias("_m")).filter("_m is not null").select(on, "_s", F.struct(F.abs(F.col("_m.at") - F.col("_s")).alias("delta_seconds"), (-F.col("_m.at")).alias("later"), f"_m.{right_id}", "_m.status").alias("m"))
    best = left.select(left_id, on, second(left_at).alias("_s")).join(best.hint("merge"), [on, "_s"]).groupBy(left_id).agg(F.min("m").alias("m"))
    return left.join(best.hint("merge"), left_id, "left").select(*left.columns, F.col(f"m.{right_id}").alias(right_id), F.col("m.status").alias("run_status"), F.col("m.delta_seconds").alias("delta_seconds"), F.col("m").isNotNull().alias("matched"))


def reconcile(external: DataFrame, runs: DataFrame, within: int = 1200) -> DataFrame:
    """External runs with the run of the expected trigger nearest to their creation."""
    return nearest(external, runs, "trigger", "created_at", "started_at", "external_id", "run_id", within)


def mismatches(external: DataFrame, runs: DataFrame, within: int = 1200) -> DataFrame:
    """(code, id): successes without a run, failures whose run still runs, scheduled runs without an external one."""
    failed = F.col("conclusion").isin("failure", "cancelled", "timed_out") & F.col("matched") & (F.col("run_status") == "running")
    code = F.when((F.col("conclusion") == "success") & ~F.col("matched"), "success_without_run").when(failed, "failure_with_running_run")
    wrong = reconcile(external, runs, within).select(code.alias("code"), F.col("external_id").alias("id")).filter("code is not null")
    planned = runs.filter("trigger = 'schedule'")
    other = external.filter("event = 'schedule'").select("trigger", F.col("external_id"), "created_at", F.lit("x").alias("status"))
    alone = nearest(planned.drop("status"), other, "trigger", "started_at", "created_at", "run_id", "external_id", within).filter("not matched")
    return wrong.unionByName(alone.select(F.lit("scheduled_run_without_external").alias("code"), F.col("run_id").alias("id")))


def run_report(runs: DataFrame, by: str = "platform") -> DataFrame:
    """Per platform: runs, blocked ones, pages, discovered jobs, and a histogram of statuses as a map."""
    counts = runs.groupBy(by, "status").agg(F.count("*").alias("n"), F.sum("pages_fetched").alias("p"), F.sum("jobs_discovered").alias("j"))
    return counts.groupBy(by).agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col("status") == "blocked", F.col("n")).otherwise(0)).alias("blocked"), F.sum("p").alias("pages"), F.sum("j").alias("discovered"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))).alias("by_status"),
    )


def dedupe_report(hits: DataFrame) -> DataFrame:
    """Per platform: hits, distinct jobs, duplicates removed."""
    out = hits.groupBy("platform").agg(F.count("*").alias("hits"), F.count_distinct("job_id").alias("unique_jobs"))
    return out.withColumn("duplicates_removed", F.greatest(F.col("hits") - F.col("unique_jobs"), F.lit(0)))


def run_hits(hits: DataFrame, search_runs: DataFrame) -> DataFrame:
    """Per crawl run, over all of its search runs: hits, distinct jobs, duplicates removed."""
    rows = hits.select("search_run_id", "job_id").join(search_runs.select("search_run_id", "crawl_run_id"), "search_run_id")
    out = rows.groupBy("crawl_run_id").agg(F.count("*").alias("hits"), F.count_distinct("job_id").alias("unique_jobs"))
    return out.withColumn("duplicates_removed", F.greatest(F.col("hits") - F.col("unique_jobs"), F.lit(0)))


def inconsistent_searches(runs: DataFrame, search_runs: DataFrame, ended: tuple[str, ...] | None = None) -> DataFrame:
    """Running search runs under a crawl run that no longer runs; `ended` lists the statuses that count as such, else all but running."""
    over = F.col("status") != "running" if ended is None else F.col("status").isin(*ended)
    return search_runs.filter("status = 'running'").join(runs.filter(over).select(F.col("run_id").alias("crawl_run_id")), "crawl_run_id", "left_semi")


def skills_fill(details: DataFrame) -> DataFrame:
    """Per platform: details, parsed ones, those with skills, and their share in percent (null without details)."""
    out = details.groupBy("platform").agg(F.count("*").alias("details"), F.count_if("parse_ok").alias("parsed"), F.count_if(F.coalesce("extracted_skills", F.lit("{}")) != "{}").alias("with_skills"))
    return out.withColumn("fill_percent", F.when(F.col("details") > 0, F.round(100.0 * F.col("with_skills") / F.col("details"), 2)))


def stale_running(runs: DataFrame, as_of: Column, minutes: int) -> DataFrame:
    """Per platform: running runs that are overdue."""
    return runs.groupBy("platform").agg(F.count_if((F.col("status") == "running") & (F.col("started_at") < as_of - F.make_interval(mins=F.lit(minutes)))).alias("overdue"))


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def constraint_checks(checks: list[tuple[str, DataFrame]]) -> DataFrame:
    """(name, violations, ok) of named tables of violating rows."""
    parts = [rows.agg(F.count("*").alias("violations")).select(F.lit(name).alias("name"), "violations", (F.col("violations") == 0).alias("ok")) for name, rows in checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_checks(rows: DataFrame, conditions: dict[str, Column], unique: tuple[str, list[str]] | None = None) -> DataFrame:
    """(name, violations, ok) of all checks of one table in one scan: rows that meet a condition, and keys that occur more than once."""
    counts = {n: F.count_if(c) for n, c in conditions.items()}
    if unique:
        name, keys = unique
        grouped = rows.groupBy(*keys).agg(F.count("*").alias("_n"), *[c.alias(n) for n, c in counts.items()])
        counts = {name: F.count_if(F.col("_n") > 1)} | {n: F.coalesce(F.sum(n), F.lit(0)) for n in counts}
        rows = grouped
    one = rows.agg(*[c.alias(n) for n, c in counts.items()])
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).cast("long").alias("violations")) for n in counts]))
    return one.select(each.alias("x")).select("x.name", "x.violations", (F.col("x.violations") == 0).alias("ok"))


def backlog_progress(counts: DataFrame, by: str, batch: str = "batch", remaining: str = "remaining") -> DataFrame:
    """counts with `delta` (how far a batch brought the backlog down, null for the first) and `go_on`: something is left and the last batch brought it down.
    One row a key and batch: the window holds a key's batches, of which there are few."""
    w = Window.partitionBy(by).orderBy(batch)
    delta = F.lag(remaining).over(w) - F.col(remaining)
    return counts.withColumn("delta", delta).withColumn("go_on", (F.col(remaining) > 0) & F.coalesce(F.col("delta") > 0, F.lit(True)))


def missing_details(jobs: DataFrame, details: DataFrame) -> DataFrame:
    """Per platform: jobs without details."""
    return jobs.join(details.select("platform", "job_id"), ["platform", "job_id"], "left_anti").groupBy("platform").agg(F.count("*").alias("missing"))
