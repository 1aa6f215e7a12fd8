"""Parameterised reads of the stored outputs. Every order ends in a key, so pages are stable."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import cells


def clamp(value: int | None, low: int, high: int, default: int) -> int:
    """A request parameter within its limits."""
    return default if value is None else max(low, min(high, int(value)))


def inside(south: float, west: float, north: float, east: float) -> Column:
    return F.col("lat").between(south, north) & F.col("lon").between(west, east)


def since(as_of: Column, timeframe: str) -> Column:
    """Posted or first seen within 24h, 7d or 30d; all: always."""
    if timeframe == "all":
        return F.lit(True)
    at = as_of - F.lit({"24h": timedelta(hours=24), "7d": timedelta(days=7), "30d": timedelta(days=30)}[timeframe])
    return (F.col("posted_at_utc") >= at) | (F.col("first_seen_at") >= at)


def bubbles(stored: DataFrame, box: tuple[float, float, float, float], metric: str = "jobs_unique", limit: int | None = None) -> DataFrame:
    """Bubbles in a box with a positive metric, largest first."""
    rows = stored.filter(inside(*box) & (F.col(metric) > 0))
    return rows.orderBy(F.desc(metric), "lat", "lon", "map_city_label").limit(clamp(limit, 10, 500, 500))


def hotspots(stored: DataFrame, metric: str = "new_7d_unique", limit: int | None = None) -> DataFrame:
    return stored.filter(F.col(metric) > 0).orderBy(F.desc(metric), "lat", "lon", "map_city_label").limit(clamp(limit, 3, 15, 8))


def top_skills_page(stored: DataFrame, days: int = 30, limit: int | None = None) -> DataFrame:
    return stored.filter(F.col("days_window") == (30 if days <= 30 else 90)).orderBy(F.desc("jobs_unique"), "skill").limit(clamp(limit, 5, 25, 10))


def trend_tail(stored: DataFrame, as_of: Column, months: int | None = None) -> DataFrame:
    """The last buckets, ascending, by the bucket's own month."""
    n = clamp(months, 3, 12, 12)
    return stored.filter(F.col("bucket_start") >= F.date_trunc("month", F.add_months(as_of, -(n - 1)).cast("timestamp"))).orderBy("bucket_start")


def city_jobs(points: DataFrame, lat: float, lon: float, as_of: Column, timeframe: str = "all", limit: int | None = None, offset: int = 0) -> DataFrame:
    """Jobs at a place, newest first and unknown times last, one row a job."""
    eps = 1e-7
    rows = points.filter((F.col("token_kind") == "city") & inside(lat - eps, lon - eps, lat + eps, lon + eps) & since(as_of, timeframe))
    rows = rows.groupBy("platform", "job_id").agg(F.max("posted_at_utc").alias("posted_at_utc"), F.min("map_point_id").alias("map_point_id"))
    return rows.orderBy(F.desc_nulls_last("posted_at_utc"), "platform", "job_id").offset(offset).limit(clamp(limit, 1, 200, 200))


def remote_points(points: DataFrame, as_of: Column, timeframe: str = "all", box: tuple[float, float, float, float] | None = None, limit: int | None = None, offset: int = 0) -> DataFrame:
    rows = points.filter((F.col("token_kind") == "remote") & since(as_of, timeframe))
    rows = rows.filter(inside(*box)) if box else rows
    return rows.orderBy("map_point_id").offset(offset).limit(clamp(limit, 1, 1000, 1000))


def job_detail(base: DataFrame, platform: str, job_id: str) -> DataFrame:
    return base.filter((F.col("platform") == platform) & (F.col("job_id") == job_id))


def newest_first(rows: DataFrame, at: Column) -> DataFrame:
    return rows.orderBy(at.desc_nulls_last(), "platform", "job_id")


# reads of the snapshot that is stored in the order of its cells


def store_by_cell(rows: DataFrame, path: str, files: int | None = None, group_bytes: int = 4 << 20) -> None:
    """Writes rows with lat and lon in the order of their cells, so that a box is few row groups of few files; rows without a place come first.

    files: how many ranges of cells, by default what the session shuffles into; a cell is never split over files, so one that holds very many rows is one file's.
    """
    keyed = rows.withColumn("cell", cells.cell(F.col("lat"), F.col("lon")))
    keyed = keyed.repartitionByRange(files, "cell") if files else keyed.repartitionByRange("cell")
    keyed.sortWithinPartitions("cell").write.mode("errorifexists").option("parquet.block.size", group_bytes).parquet(path)


def in_box(stored: DataFrame, box: tuple[float, float, float, float], most: int = 24) -> DataFrame:
    """Rows of a box, from a table with `cell`: ranges of cells choose the row groups, the box itself the rows."""
    return stored.filter(cells.in_ranges(F.col("cell"), cells.cover(*box, most=most)) & inside(*box))


def page_after(rows: DataFrame, order: list[tuple[str, bool]], last: tuple | None, size: int) -> DataFrame:
    """The next page in an order of columns, (name, descending) each, that ends in a key: rows behind the last one seen, not counted off from the start. Nulls come last.

    A filter on the first columns reaches the scan; rows that another page added or removed neither repeat nor hide one. last: the order's values of the last row seen, None for the first page.
    """
    by = [F.desc_nulls_last(c) if down else F.asc_nulls_last(c) for c, down in order]
    if last is not None:
        behind, same = F.lit(False), F.lit(True)
        for (c, down), value in zip(order, last, strict=True):
            v = F.lit(value)
            further = F.lit(False) if value is None else F.col(c).isNull() | ((F.col(c) < v) if down else (F.col(c) > v))
            behind = behind | (same & further)
            same = same & (F.col(c).isNull() if value is None else F.coalesce(F.col(c) == v, F.lit(False)))
        rows = rows.filter(behind)
    return rows.orderBy(*by).limit(size)


def city_page(stored: DataFrame, lat: float, lon: float, as_of: Column, timeframe: str = "all", last: tuple | None = None, size: int | None = None) -> DataFrame:
    """A page of the jobs at a place of a stored snapshot, newest first and unknown times last, one row a job; last: (posted_at_utc, platform, job_id) of the last one seen."""
    eps = 1e-7
    rows = in_box(stored, (lat - eps, lon - eps, lat + eps, lon + eps)).filter((F.col("token_kind") == "city") & since(as_of, timeframe))
    rows = rows.groupBy("platform", "job_id").agg(F.max("posted_at_utc").alias("posted_at_utc"), F.min("map_point_id").alias("map_point_id"))
    return page_after(rows, [("posted_at_utc", True), ("platform", False), ("job_id", False)], last, clamp(size, 1, 200, 200))


def remote_page(stored: DataFrame, as_of: Column, timeframe: str = "all", box: tuple[float, float, float, float] | None = None, last: str | None = None, size: int | None = None) -> DataFrame:
    """A page of remote points by their id; last: the id of the last one seen."""
    rows = (in_box(stored, box) if box else stored).filter((F.col("token_kind") == "remote") & since(as_of, timeframe))
    return page_after(rows, [("map_point_id", False)], None if last is None else (last,), clamp(size, 1, 1000, 1000))
