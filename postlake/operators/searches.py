"""Searches: facets, places, budgets of pages, previews of external ads, run records."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.operators.keyed import update_where
from postlake.plans.places import small


def enabled(definitions: DataFrame, platform: str) -> DataFrame:
    return definitions.filter((F.col("platform") == platform) & F.col("enabled")).orderBy("name")


def best_place(hits: DataFrame, suffix: str | None) -> DataFrame:
    """Per query the first hit whose name ends with the suffix, else the first. hits: query, pos, id, display_name."""
    ends = F.lower(F.trim("display_name")).endswith((suffix or "").strip().lower()) if suffix else F.lit(False)
    return hits.groupBy("query").agg(F.min_by(F.struct("id", "display_name"), F.struct(~ends, "pos")).alias("h")).select("query", "h.*")


def resolve_facets(requests: DataFrame, options: DataFrame) -> DataFrame:
    """(search, facet, pos, value): labels as codes by the option table, codes unchanged, null value where neither fits.

    requests: search, facet, labels (array); options: facet, label, value. `unknown` holds labels that the option table lacks.
    """
    norm = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    rows = requests.select("search", "facet", F.posexplode("labels").alias("pos", "label")).withColumn("label", F.trim("label")).filter("label <> ''")
    raw = F.when(F.col("facet") == "f_TPR", F.col("label").rlike("^r[0-9]+$")).otherwise(F.col("label").rlike("^[A-Za-z0-9]{1,4}$"))
    known = options.select("facet", norm(F.col("label")).alias("key"), F.col("value").alias("coded"))
    rows = rows.withColumns({"raw": raw, "key": norm(F.col("label"))}).join(known, ["facet", "key"], "left")
    return rows.select("search", "facet", "pos", F.when(F.col("raw"), F.col("label")).otherwise(F.col("coded")).alias("value"), F.when(~F.col("raw") & F.col("coded").isNull(), F.col("label")).alias("unknown"))


def age_days(runs: DataFrame, as_of: Column, default: int = 1, widen_after_hours: int = 36) -> DataFrame:
    """Per platform: no window before any run finished, the default after a recent success, else a week."""
    ok = F.max(F.when(F.col("status") == "success", F.col("finished_at")))
    value = F.when(F.max("finished_at").isNull(), None).when(ok >= as_of - F.lit(timedelta(hours=widen_after_hours)), default).otherwise(7)
    return runs.groupBy("platform").agg(value.cast("int").alias("age_days"))


def page_budget(found: DataFrame, by: str, page: str, order: str, max_jobs: int, max_repeats: int) -> DataFrame:
    """What a search would keep: jobs at their first place, up to max_jobs, and only from pages before the max_repeats-th page in a row
    without a new job. found: by, job_id, page, order."""
    first = Window.partitionBy(by, "job_id").orderBy(order)
    rows = found.withColumn("_new", F.row_number().over(first) == 1)
    pages = rows.groupBy(by, page).agg(F.max("_new").alias("any_new"))
    w = Window.partitionBy(by).orderBy(page)
    pages = pages.withColumn("_island", F.sum(F.col("any_new").cast("int")).over(w))
    streak = F.sum((~F.col("any_new")).cast("int")).over(Window.partitionBy(by, "_island").orderBy(page))
    stop = pages.withColumn("_streak", streak).filter(F.col("_streak") >= max_repeats).groupBy(by).agg(F.min(page).alias("_stop"))
    kept = rows.filter("_new").join(stop, by, "left").filter(F.col("_stop").isNull() | (F.col(page) < F.col("_stop")))
    return kept.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(order))).filter(F.col("_n") <= max_jobs).drop("_new", "_stop", "_n")


def preview_details(jobs: DataFrame, as_of: Column) -> DataFrame:
    """Detail rows of external ads from their list previews; parsed if there is a title, a company or a location."""
    names = ("job_title", "company_name", "job_location", "posted_time_ago", "employment_type", "salary_range_text", "work_model")
    field = {n: F.col("list_preview")[n] for n in names}
    ok = F.coalesce(*[F.nullif(field[n], F.lit("")) for n in names[:3]]).isNotNull()
    return jobs.filter("is_external").select("platform", "job_id", as_of.alias("scraped_at"), ok.alias("parse_ok"), F.when(~ok, "missing_list_preview_fields").alias("last_error"), *[c.alias(n) for n, c in field.items()])


def open_run(runs: DataFrame, run_id: str, platform: str, trigger: str, as_of: Column) -> DataFrame:
    """runs and a new running one."""
    row = runs.sparkSession.range(1).select(F.lit(run_id).cast(runs.schema["run_id"].dataType).alias("run_id"), F.lit(platform).alias("platform"), F.lit(trigger).alias("trigger"), F.lit("running").alias("status"), as_of.alias("started_at"))
    return runs.unionByName(row, allowMissingColumns=True)


def finish_run(runs: DataFrame, run_id: str, status: str, as_of: Column, stats: str | None = None, error: str | None = None) -> DataFrame:
    changes = {"status": F.lit(status), "finished_at": as_of, "stats": F.lit(stats), "error": F.lit(error)}
    return update_where(runs, F.col("run_id") == F.lit(run_id), {k: v.cast(runs.schema[k].dataType) for k, v in changes.items()})


def step_outcomes(runs: DataFrame, path: str = "$.details.status") -> DataFrame:
    """Per platform: runs whose step ended blocked, and runs that skipped it to wait."""
    status = F.get_json_object("stats", path)
    return runs.groupBy("platform").agg(F.count_if(status == "blocked").alias("blocked"), F.count_if(status == "skipped_backoff").alias("skipped_backoff"))


def expected_trigger(external: DataFrame, table: DataFrame) -> DataFrame:
    """external with the trigger that its workflow and event stand for, null if unknown. table: workflow, event, trigger."""
    return external.withColumn("event", F.lower(F.trim("event"))).join(small(table), ["workflow", "event"], "left")


def integrity(cases: DataFrame) -> DataFrame:
    """(case_id, code): what is wrong after a workflow step. cases: case_id, outcome, expected_trigger, crawl_run_id, row_status, row_trigger (null without a row), stale, lingering (counts)."""
    o = F.lower(F.trim(F.coalesce("outcome", F.lit(""))))
    good, bad = o == "success", o.isin("failure", "cancelled", "skipped")
    row = F.col("row_status").isNotNull()
    rules = {
        "stale_rows_remain": F.col("stale") > 0, "missing_crawl_run_id": good & (F.coalesce("crawl_run_id", F.lit("")) == ""), "missing_crawl_row": good & ~row,
        "non_terminal_crawl_row": good & row & ~F.col("row_status").isin("success", "blocked", "failed"), "trigger_mismatch": good & row & F.col("expected_trigger").isNotNull() & ~F.col("expected_trigger").eqNullSafe(F.col("row_trigger")),
        "lingering_running_after_non_success": bad & (F.col("lingering") > 0), "unsupported_run_step_outcome": ~good & ~bad,
    }
    return cases.select("case_id", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))).alias("code"))


def integrity_checks(cases: DataFrame) -> DataFrame:
    """(case_id, name, ok, detail): every check that applies to a case of `integrity`, whether it holds, and what it saw."""
    o = F.lower(F.trim(F.coalesce("outcome", F.lit(""))))
    good, bad, row = o == "success", o.isin("failure", "cancelled", "skipped"), F.col("row_status").isNotNull()
    run_id, text = F.coalesce("crawl_run_id", F.lit("")), lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    checks = [
        (F.lit(True), "no_stale_running_rows_after_repair", F.col("stale") == 0, F.concat(F.lit("remaining_stale_count="), text("stale"))),
        (good, "success_has_crawl_run_id", run_id != "", F.concat(F.lit("crawl_run_id="), run_id)),
        (good, "success_row_exists", row, F.concat(F.lit("found_row="), row.cast("int").cast("string"))),
        (good & row, "success_row_terminal_status", F.col("row_status").isin("success", "blocked", "failed"), F.concat(F.lit("db_status="), text("row_status"))),
        (good & row & F.col("expected_trigger").isNotNull(), "success_trigger_matches", F.col("expected_trigger").eqNullSafe(F.col("row_trigger")), F.concat(F.lit("db_trigger="), text("row_trigger"), F.lit(" expected="), text("expected_trigger"))),
        (bad, "non_success_has_no_lingering_running_rows", F.col("lingering") == 0, F.concat(F.lit("lingering_running_count="), text("lingering"))),
        (~good & ~bad, "supported_run_step_outcome", F.lit(False), F.concat(F.lit("run_step_outcome="), o)),
    ]
    rows = F.array_compact(F.array(*[F.when(applies, F.struct(F.lit(n).alias("name"), F.coalesce(ok, F.lit(False)).alias("ok"), detail.alias("detail"))) for applies, n, ok, detail in checks]))
    return cases.select("case_id", F.explode(rows).alias("x")).select("case_id", "x.*")
