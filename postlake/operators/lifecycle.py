"""Expiry, deletion, run health and repair, and the work queues."""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from postlake.operators.ingest import apply_details, blocked_verdict
from postlake.operators.keyed import update_where
from postlake.sources.versions import Lake

KEY = ["platform", "job_id"]


def _ago(as_of: Column, **d) -> Column:
    return as_of - F.lit(timedelta(**d))


def health_gate(runs: DataFrame, as_of: Column, max_age_hours: int = 36) -> DataFrame:
    """Per platform its latest run (started last; skipped ones do not count) and what follows: processed or skipped_unhealthy.
    A platform without a row has no recent run."""
    rows = runs.filter(F.coalesce(F.get_json_object("stats", "$.discovery.status"), F.lit("")) != "skipped")
    latest = rows.groupBy("platform").agg(F.max_by(F.struct("run_id", "status", "finished_at"), F.struct("started_at", "run_id")).alias("r")).select("platform", "r.*")
    old = F.col("finished_at") < _ago(as_of, hours=max_age_hours)
    note = F.when(F.col("status") != "success", F.concat(F.lit("status "), "status")).when(F.col("finished_at").isNull(), "not finished").when(old, "too old")
    return latest.withColumns({"action_status": F.when(note.isNull(), "processed").otherwise("skipped_unhealthy"), "note": note})


def is_stale(as_of: Column, days: int) -> Column:
    return F.coalesce("is_active", F.lit(True)) & (F.col("last_seen_at") < _ago(as_of, days=days))


def soft_expire(jobs: DataFrame, as_of: Column, days: int = 60) -> DataFrame:
    """jobs with those unseen for `days` inactive."""
    return update_where(jobs, is_stale(as_of, days), {"is_active": F.lit(False), "stale_since_at": F.coalesce("stale_since_at", as_of), "expired_at": as_of, "expire_reason": F.lit("not_seen_window")})


def hard_delete(jobs: DataFrame, children: dict[str, DataFrame], as_of: Column, days: int = 120) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(jobs, children) without jobs unseen for `days` and without their rows. Store the children before the jobs."""
    gone = jobs.filter(F.col("last_seen_at") < _ago(as_of, days=days)).select(*KEY)
    return jobs.join(gone, KEY, "left_anti"), {n: c.join(gone, KEY, "left_anti") for n, c in children.items()}


def lifecycle_counts(jobs: DataFrame, hits: DataFrame, details: DataFrame, as_of: Column, stale_days: int = 60, delete_days: int = 120) -> DataFrame:
    """Per platform: what a run would expire and delete."""
    old = jobs.filter(F.col("last_seen_at") < _ago(as_of, days=delete_days)).select(*KEY)
    out = jobs.groupBy("platform").agg(F.count_if(is_stale(as_of, stale_days)).alias("soft_expired"), F.count_if(F.col("last_seen_at") < _ago(as_of, days=delete_days)).alias("jobs_deleted"))
    for name, child in (("hits_deleted", hits), ("details_deleted", details)):
        n = child.select(*KEY).join(old, KEY, "left_semi").groupBy("platform").agg(F.count("*").alias(name))
        out = out.join(n, "platform", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out


def final_status(stats: DataFrame) -> DataFrame:
    """One row: totals and failed, partial or success by how many platforms failed."""
    failed = F.count_if(F.col("action_status") == "failed")
    status = F.when((failed == F.count("*")) & (failed > 0), "failed").when(failed > 0, "partial").otherwise("success")
    return stats.agg(status.alias("status"), *[F.sum(c).alias(c) for c in ("soft_expired", "jobs_deleted", "hits_deleted", "details_deleted")])


RUNS = "run_id string, trigger string, status string, dry_run boolean, stale_days int, delete_days int, max_age_hours int, started_at timestamp, summary string"
STATS = "run_id string, platform string, action_status string, latest_run_id string, latest_status string, latest_finished_at timestamp, soft_expired long, jobs_deleted long, hits_deleted long, details_deleted long, note string"
_COUNTS = ("soft_expired", "jobs_deleted", "hits_deleted", "details_deleted")


def _one_platform(lake: Lake, platform: str, runs: DataFrame, as_of: Column, stale_days: int, delete_days: int, max_age_hours: int, dry_run: bool) -> dict:
    """Expires and deletes one platform's jobs, if its latest run is healthy, and publishes its three tables together. Counts are taken while the tables are written."""
    gate = health_gate(runs.filter(F.col("platform") == platform), as_of, max_age_hours).first()
    told = {"platform": platform, "action_status": gate["action_status"] if gate else "skipped_no_recent_run", "note": gate["note"] if gate else None}
    told |= {"latest_run_id": str(gate["run_id"]), "latest_status": gate["status"], "latest_finished_at": gate["finished_at"]} if gate else {}
    if told["action_status"] != "processed":
        return told
    state = lake.manifest()
    tables = {n: lake.read(f"{platform}_{n}", state=state) for n in ("jobs", "hits", "details")}
    if dry_run:
        counted = lifecycle_counts(tables["jobs"], tables["hits"], tables["details"], as_of, stale_days, delete_days).filter(F.col("platform") == platform).first()
        return told | ({c: counted[c] for c in _COUNTS} if counted else {})
    seen = {n: (Observation(), Observation()) for n in tables}
    n_rows, old = F.count("*").alias("n"), F.coalesce(F.col("last_seen_at") < _ago(as_of, days=delete_days), F.lit(False))
    _, after = hard_delete(tables["jobs"], {n: tables[n].observe(seen[n][0], n_rows) for n in ("hits", "details")}, as_of, delete_days)
    jobs = tables["jobs"].observe(seen["jobs"][0], n_rows, F.count_if(is_stale(as_of, stale_days)).alias("stale"))
    after["jobs"] = soft_expire(jobs.filter(~old), as_of, stale_days)
    with lake.change() as now:
        for name, rows in after.items():
            table = state["tables"][f"{platform}_{name}"]
            now.put(f"{platform}_{name}", rows.observe(seen[name][1], n_rows), keys=table["keys"], buckets=table["buckets"])
    lost = {n: first.get["n"] - last.get["n"] for n, (first, last) in seen.items()}
    return told | {"soft_expired": seen["jobs"][0].get["stale"], "jobs_deleted": lost["jobs"], "hits_deleted": lost["hits"], "details_deleted": lost["details"]}


def lifecycle_run(lake: Lake, platforms: list[str], runs: DataFrame, run_id: str, as_of: Column, trigger: str = "manual", stale_days: int = 60, delete_days: int = 120, max_age_hours: int = 36, dry_run: bool = False) -> str:
    """Runs the lifecycle of all platforms side by side, each apart from the others: a platform that fails keeps its tables and is noted as failed, the others go on.

    Tables <platform>_jobs, _hits and _details of the lake are changed; a row for each platform goes to `lifecycle_stats`, one for the run to `lifecycle_runs`. Returns the
    run's status: failed if all platforms failed, partial if some did, else success. Jobs past the deletion age count as expired and as deleted.
    """
    spark = lake.spark
    started = spark.range(1).select(as_of).first()[0]

    def one(platform: str) -> dict:
        try:
            return _one_platform(lake, platform, runs, as_of, stale_days, delete_days, max_age_hours, dry_run)
        except Exception as error:  # kept apart: it becomes the platform's row
            return {"platform": platform, "action_status": "failed", "note": str(error)[:500]}

    with ThreadPoolExecutor(max(len(platforms), 1)) as pool:
        told = [{"run_id": run_id} | dict.fromkeys(_COUNTS, 0) | x for x in pool.map(one, platforms)]
    names = [f.split()[0] for f in STATS.split(", ")]
    stats = spark.createDataFrame([tuple(x.get(n) for n in names) for x in told], STATS)
    total = final_status(stats).first()
    settings = {"stale_days": stale_days, "delete_days": delete_days, "max_age_hours": max_age_hours}
    summary = {"status": total["status"], "trigger": trigger, "dry_run": dry_run, "settings": settings, "platforms": [{k: v for k, v in x.items() if k != "latest_finished_at"} for x in told], "totals": {c: total[c] for c in _COUNTS}}
    row = spark.createDataFrame([(run_id, trigger, total["status"], dry_run, stale_days, delete_days, max_age_hours, started, json.dumps(summary))], RUNS)
    with lake.change() as now:
        for name, rows, keys in (("lifecycle_stats", stats, ["run_id", "platform"]), ("lifecycle_runs", row, ["run_id"])):
            if name in now.state["tables"]:
                now.upsert(name, rows)
            else:
                now.put(name, rows, keys=keys, buckets=4)
    return total["status"]


def repair_stale_runs(runs: DataFrame, searches: DataFrame, as_of: Column, minutes: int, status: str = "abandoned", reason: str = "stale") -> tuple[DataFrame, DataFrame]:
    """Runs that have been running too long are closed, and their running searches fail; an error that is there stays."""
    stale = (F.col("status") == "running") & (F.col("started_at") < _ago(as_of, minutes=minutes))
    ids = runs.filter(stale).select(F.col("run_id").alias("crawl_run_id"), F.lit(True).alias("_stale"))
    closed = update_where(runs, stale, {"status": F.lit(status), "finished_at": as_of, "error": F.coalesce("error", F.lit(reason))})
    linked = searches.join(ids, "crawl_run_id", "left")
    failed = update_where(linked, F.col("_stale") & (F.col("status") == "running"), {"status": F.lit("failed"), "finished_at": as_of, "error": F.coalesce("error", F.lit(reason))})
    return closed, failed.drop("_stale")


def finalize_from_log(runs: DataFrame, searches: DataFrame, details: DataFrame, log: DataFrame, as_of: Column, minutes: int, max_blocked: float = 0.1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(runs, searches, details) after stale runs are closed. One whose detail log has lines takes the import's status, its lines are
    applied to details; one without fails. Running searches of either fail. log: crawl_run_id and what apply_details reads."""
    stale = (F.col("status") == "running") & (F.col("started_at") < _ago(as_of, minutes=minutes))
    ids = runs.filter(stale).select(F.col("run_id").alias("crawl_run_id"))
    lines = log.join(ids, "crawl_run_id", "left_semi")
    imported = lines.groupBy("crawl_run_id").agg(F.count("*").alias("upserted"), F.count_if("parse_ok").alias("parse_ok"), F.count_if(F.col("last_error") == "blocked").alias("blocked"))
    verdict = F.when(blocked_verdict(F.col("blocked"), F.col("upserted"), max_blocked), "blocked").otherwise("success")
    told = F.struct(verdict.alias("status"), "upserted", "parse_ok", "blocked")
    stats = F.to_json(F.struct(F.struct(F.lit("skipped").alias("status")).alias("discovery"), told.alias("details")))
    known = ids.join(imported, "crawl_run_id", "left").select(F.col("crawl_run_id").alias("run_id"), F.when(F.col("upserted").isNotNull(), verdict).alias("_status"), F.when(F.col("upserted").isNotNull(), stats).alias("_stats"), F.lit(True).alias("_stale"))
    closed = update_where(runs.join(known, "run_id", "left"), F.col("_stale"), {
        "status": F.coalesce("_status", F.lit("failed")), "stats": F.coalesce("_stats", F.lit("{}")), "finished_at": as_of,
        "error": F.when(F.col("_status").isNull(), "stale, without a completed detail log"),
    }).select(*runs.columns)
    linked = searches.join(ids.withColumn("_stale", F.lit(True)), "crawl_run_id", "left")
    failed = update_where(linked, F.col("_stale") & (F.col("status") == "running"), {"status": F.lit("failed"), "finished_at": as_of, "error": F.lit("stale recovery")})
    return closed, failed.select(*searches.columns), apply_details(details, lines.drop("crawl_run_id"))


def cooldown_active(runs: DataFrame, as_of: Column, minutes: int) -> DataFrame:
    """Per platform whether a blocked run finished within the window."""
    last = F.max(F.when(F.col("status") == "blocked", F.col("finished_at")))
    return runs.groupBy("platform").agg(F.coalesce(last >= _ago(as_of, minutes=minutes), F.lit(False)).alias("cooldown"))


def search_history(runs: DataFrame) -> DataFrame:
    """Per definition: whether any run finished, and the last success."""
    ok = (F.col("status") == "success") & F.col("finished_at").isNotNull()
    return runs.groupBy("search_definition_id").agg(F.bool_or(F.col("finished_at").isNotNull()).alias("has_finished"), F.max(F.when(ok, F.col("finished_at"))).alias("last_success"))


def recency_code(has_finished: Column, last_success: Column, as_of: Column, day_hours: int = 30) -> Column:
    """No window without history, one day after a recent success, else a week."""
    return F.when(~has_finished, None).when(last_success >= _ago(as_of, hours=day_hours), "r86400").otherwise("r604800")


def detail_queue(jobs: DataFrame, details: DataFrame, as_of: Column, limit: int, window_days: int = 60, stale_days: int = 30, retry_hours: int = 24) -> DataFrame:
    """Active recent jobs whose details are missing, old, or blocked long enough ago; missing first, then oldest."""
    rows = jobs.join(details.select(*KEY, "scraped_at", "last_error", F.lit(True).alias("known")), KEY, "left")
    due = F.col("known").isNull() | (F.col("scraped_at") < _ago(as_of, days=stale_days)) | ((F.col("last_error") == "blocked") & (F.col("scraped_at") < _ago(as_of, hours=retry_hours)))
    rows = rows.filter((F.col("last_seen_at") > _ago(as_of, days=window_days)) & F.coalesce("is_active", F.lit(True)) & due)
    return rows.orderBy(F.col("known").isNull().desc(), F.asc_nulls_first("scraped_at"), F.desc("last_seen_at"), *KEY).limit(limit)


def skill_queue(details: DataFrame, version: int, limit: int) -> DataFrame:
    """Parsed texts without skills of this version, newest first."""
    rows = details.filter(F.col("parse_ok") & (F.trim("job_description") != "") & (F.col("extracted_skills").isNull() | (F.coalesce("extracted_skills_version", F.lit(0)) < version)))
    return rows.orderBy(F.desc_nulls_last("scraped_at"), *KEY).limit(limit)


def block_streaks(pages: DataFrame, by: list[str], order: list[str], least: int = 3) -> DataFrame:
    """Runs of consecutive blocked pages of a search, of at least `least`: the search's key, first and last order value, length."""
    w = Window.partitionBy(*by).orderBy(*order)
    island = F.sum(F.when(F.col("blocked"), 0).otherwise(1)).over(w)
    rows = pages.withColumn("_island", island).filter("blocked")
    return rows.groupBy(*by, "_island").agg(F.min(order[0]).alias("first"), F.max(order[0]).alias("last"), F.count("*").alias("length")).filter(F.col("length") >= least).drop("_island")


def first_seen(found: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Each job once a search: its first row."""
    return found.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter("_n = 1").drop("_n")
