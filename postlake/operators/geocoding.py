"""State of the geocode cache. The lookups themselves are an input table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.operators.keyed import update_where

KEY = ["provider", "location_text_norm", "country_scope"]
RETRY = ("pending", "error", "no_match")


def backoff_minutes(attempt: Column, base: int = 60, cap: int = 10080) -> Column:
    return F.least(F.lit(base) * F.pow(F.lit(2.0), F.greatest(F.lit(0), attempt - 1)), F.lit(float(cap))).cast("int")


def unresolved_status(attempt: Column, is_error: Column, most: int = 6) -> Column:
    return F.when(attempt >= most, "failed_permanent").when(is_error, "error").otherwise("no_match")


def seed(cache: DataFrame, candidates: DataFrame, as_of: Column, provider: str = "geoapify") -> DataFrame:
    """Distinct city tokens that the cache lacks, pending and due now."""
    fresh = candidates.filter("token_kind = 'city'").select(F.lit(provider).alias("provider"), F.trim("city_token_norm").alias("location_text_norm"), "country_scope").filter("location_text_norm <> ''").distinct()
    return fresh.join(cache.select(*KEY), KEY, "left_anti").withColumns({"status": F.lit("pending"), "attempt_count": F.lit(0), "next_retry_at": as_of})


def queue(cache: DataFrame, as_of: Column, limit: int, most: int = 6) -> DataFrame:
    return cache.filter(F.col("status").isin(*RETRY) & (F.col("next_retry_at") <= as_of) & (F.col("attempt_count") < most)).orderBy("next_retry_at", "id").limit(limit)


def apply_results(cache: DataFrame, batch: DataFrame, results: DataFrame, as_of: Column, most: int = 6) -> DataFrame:
    """cache after a batch: rows with both coordinates are resolved, others try again later.

    batch: (id, position, query). results: (position, query, lat, lon, error) with lat and lon as text; a result belongs to the batch row with its
    query text or, where none has it, with its position.
    """
    text = batch.join(results.select(F.col("query"), F.struct("lat", "lon", "error").alias("by_text")).dropDuplicates(["query"]), "query", "left")
    both = text.join(results.select("position", F.struct("lat", "lon", "error").alias("by_place")), "position", "left")
    got = both.select("id", F.coalesce("by_text", "by_place").alias("g")).select("id", F.col("g.lat").try_cast("double").alias("_lat"), F.col("g.lon").try_cast("double").alias("_lon"), F.col("g.error").alias("_error"), F.lit(True).alias("_asked"))
    rows = cache.join(got, "id", "left")
    ok = F.col("_lat").isNotNull() & F.col("_lon").isNotNull()
    attempt = F.col("attempt_count") + 1
    wait = as_of + F.make_interval(mins=backoff_minutes(attempt))
    asked = F.coalesce("_asked", F.lit(False))
    state = F.when(ok, "resolved").otherwise(unresolved_status(attempt, F.col("_error").isNotNull(), most))
    changes = {"status": state, "lat": F.when(ok, F.col("_lat")), "lon": F.when(ok, F.col("_lon")), "next_retry_at": F.when(state.isin("error", "no_match"), wait), "resolved_at": F.when(ok, as_of), "last_error": F.when(~ok, F.col("_error")), "attempt_count": attempt}
    first = {k: v for k, v in changes.items() if k != "attempt_count"}  # the other columns are computed from the old count
    out = rows.withColumns({k: F.when(asked, v).otherwise(F.col(k)) for k, v in first.items()} | {"attempt_count": F.when(asked, attempt).otherwise(F.col("attempt_count"))})
    return out.drop("_lat", "_lon", "_error", "_asked")


def reset_failed(cache: DataFrame, as_of: Column) -> DataFrame:
    failed = F.col("status") == "failed_permanent"
    return update_where(cache, failed, {"attempt_count": F.lit(0), "next_retry_at": as_of, "status": F.lit("pending")})


def coverage(points: DataFrame) -> DataFrame:
    """Per platform: city points and how many have coordinates."""
    return points.filter("token_kind = 'city'").groupBy("platform").agg(F.count("*").alias("total"), F.count_if("is_geocoded").alias("geocoded"))
