"""Applying crawl logs to the tables. `seq` is the order of log lines; times may go back, the line order decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.operators.keyed import insert_if_absent, last_by_key, upsert

KEY = ["platform", "job_id"]


def merge_maps(left: Column, right: Column) -> Column:
    """Shallow merge: keys of the right win, also where their value is null."""
    empty = F.create_map().cast("map<string,string>")
    left, right = F.coalesce(left, empty), F.coalesce(right, empty)
    return F.map_zip_with(left, right, lambda k, x, y: F.when(F.map_contains_key(right, k), y).otherwise(x))


def search_run_stats(log: DataFrame, max_blocked: float | None = 0.5) -> DataFrame:
    """Per search run: distinct pages over both record types, discovered rows, blocked pages, and whether it counts as blocked:
    by the share of blocked pages, or with max_blocked=None by any."""
    page = F.col("record_type") == "page_fetch"
    stats = log.filter(F.col("record_type").isin("page_fetch", "job_discovered")).groupBy("search_run_id").agg(
        F.count_distinct(F.coalesce("page_start", F.lit(0))).alias("pages"), F.count_if(~page).alias("discovered"), F.count_if(page & F.col("blocked")).alias("blocked_pages")
    )
    return stats.withColumn("blocked", blocked_verdict(F.col("blocked_pages"), F.col("pages"), max_blocked))


def blocked_verdict(blocked: Column, total: Column, most: float | None) -> Column:
    return blocked > 0 if most is None else blocked / F.greatest(total, F.lit(1)) > most


def apply_discovery(jobs: DataFrame, found: DataFrame) -> DataFrame:
    """jobs after the log: new keys begin at their first line; known ones take the last line and become active again."""
    first = found.groupBy(*KEY).agg(F.min_by("scraped_at", "seq").alias("first_seen_at"))
    last = last_by_key(found.select(*KEY, "job_url", F.col("scraped_at").alias("last_seen_at"), "seq"), KEY, ["seq"]).drop("seq")
    updates = last.join(first, KEY).withColumn("is_active", F.lit(True))
    cleared = {c: F.lit(None).cast(t) for c, t in jobs.dtypes if c in ("stale_since_at", "expired_at", "expire_reason")}
    kept = {"job_url": F.col("u.job_url"), "last_seen_at": F.col("u.last_seen_at"), "is_active": F.lit(True)}
    return upsert(jobs, updates, KEY, kept | cleared)


def merge_previews(found: DataFrame) -> DataFrame:
    """Per job: list previews folded in line order, later lines over earlier ones key by key."""
    pairs = found.select(*KEY, "seq", F.explode("list_preview").alias("field", "value"))
    last = pairs.groupBy(*KEY, "field").agg(F.max_by(F.struct("value"), "seq").alias("v"))
    return last.groupBy(*KEY).agg(F.map_from_entries(F.collect_list(F.struct("field", F.col("v.value")))).alias("list_preview"))


def add_hits(hits: DataFrame, found: DataFrame) -> DataFrame:
    """hits and the first line of each (search run, job) not in them; missing rank and page are 0."""
    rows = found.filter("search_run_id is not null").select("search_run_id", *KEY, F.coalesce("rank", F.lit(0)).alias("rank"), F.coalesce("page_start", F.lit(0)).alias("page_start"), "scraped_at", "seq")
    return insert_if_absent(hits, rows, ["search_run_id", *KEY], ["seq"]).select(*hits.columns)


def apply_details(details: DataFrame, log: DataFrame) -> DataFrame:
    """details with the last line of each job in place of its row."""
    return upsert(details, log, KEY, order=["seq"])


def detail_stats(log: DataFrame, max_blocked: float = 0.1) -> DataFrame:
    """One row: upserted, parsed, failed, blocked, and the verdict."""
    blocked = F.coalesce(F.nullif("last_error", F.lit("")), F.lit("")) == "blocked"
    out = log.agg(F.count("*").alias("upserted"), F.count_if("parse_ok").alias("parse_ok"), F.count_if(~F.col("parse_ok")).alias("parse_failed"), F.count_if(blocked).alias("blocked"))
    return out.withColumn("is_blocked", F.col("blocked") / F.greatest("upserted", F.lit(1)) > max_blocked)


def apply_gone(jobs: DataFrame, log: DataFrame) -> DataFrame:
    """jobs after detail lines in order: a gone posting is inactive and keeps its first time and reason; a parsed one is active again.

    Lines that say neither are skipped. After the last reset the first gone line gives the time.
    """
    gone = F.col("last_error") == "http_410"
    rows = log.select(*KEY, "seq", "scraped_at", F.when(gone, "gone").when(F.col("parse_ok"), "back").alias("what")).filter("what is not null")
    last_back = rows.groupBy(*KEY).agg(F.max(F.when(F.col("what") == "back", F.col("seq"))).alias("reset"), F.max_by("what", "seq").alias("last"))
    after = rows.join(last_back, KEY).filter((F.col("what") == "gone") & (F.col("reset").isNull() | (F.col("seq") > F.col("reset"))))
    first = after.groupBy(*KEY).agg(F.min_by("scraped_at", "seq").alias("gone_at"))
    u = last_back.join(first, KEY, "left").select(*KEY, "last", "reset", "gone_at")
    was = F.col("last") == "gone"
    keep = F.col("reset").isNull()
    out = jobs.join(u, KEY, "left")
    return out.withColumns({
        "is_active": F.when(F.col("last").isNotNull(), ~was).otherwise(F.col("is_active")),
        "expired_at": F.when(was, F.coalesce(F.when(keep, F.col("expired_at")), F.col("gone_at"))).when(F.col("last").isNull(), F.col("expired_at")),
        "expire_reason": F.when(was, F.coalesce(F.when(keep, F.col("expire_reason")), F.lit("http_410"))).when(F.col("last").isNull(), F.col("expire_reason")),
    }).drop("last", "reset", "gone_at")
