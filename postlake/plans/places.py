"""Locations of jobs: candidates, map points, city bubbles."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.functions import locations, skills
from postlake.plans.unified import KEY, event_ts


def _location() -> Column:
    return F.nullif(F.trim("job_location"), F.lit(""))


def remote_like() -> Column:
    """Whether a job of the unified table can be done from anywhere; null if nothing tells."""
    home = F.when(F.col("platform") == "stepstone", F.col("homeoffice_possible"))
    model = F.when(F.col("platform") == "xing", F.col("work_model"))
    return locations.is_remote_like(_location(), home, model)


def location_candidates(base: DataFrame, carry: bool = False) -> DataFrame:
    """A row for each city token kept of a job and one for a remote-like job; carry keeps all columns of base in it.

    Tokens are filtered and made distinct inside the array, so dropped ones never become rows and no shuffle is needed: all
    windows of the rule run over one row's array.
    """
    raw = _location()
    carried = [c for c in base.columns if c not in (*KEY, "is_remote_like")] if carry else []
    rows = base.select(*KEY, *carried, raw.alias("job_location_raw"), remote_like().alias("is_remote_like"), F.lit("de").alias("country_scope"), F.array_sort(locations.city_tokens(locations.canonical(raw))).alias("tokens"))
    total = F.size("tokens")
    admin = lambda t: t["token"].isin(*locations.ADMIN_REGIONS)
    rows = rows.withColumns({"map_locations_total": total, "map_locations_used": F.least(total, F.lit(locations.MOST_TOKENS)), "has_city_tokens": total > 0, "any_city": F.exists("tokens", lambda t: ~admin(t))})
    ranked = F.transform(F.slice("tokens", 1, locations.MOST_TOKENS), lambda t, i: F.struct((i + 1).alias("city_token_idx"), t["token"].alias("city_token_norm"), F.lit("city").alias("token_kind")))
    cities = F.filter(ranked, lambda t: ~F.col("any_city") | ~t["city_token_norm"].isin(*locations.ADMIN_REGIONS))
    remote = F.when(F.col("is_remote_like"), F.array(F.struct(F.lit(None).cast("int").alias("city_token_idx"), F.lit(None).cast("string").alias("city_token_norm"), F.lit("remote").alias("token_kind")))).otherwise(F.array())
    out = rows.select(*KEY, *carried, "job_location_raw", "is_remote_like", "has_city_tokens", "map_locations_total", "map_locations_used", "country_scope", F.explode(F.concat(cities, remote)).alias("t"))
    return out.select(*KEY, *carried, "job_location_raw", "is_remote_like", "has_city_tokens", "map_locations_total", "map_locations_used", "t.*", F.col("t.city_token_norm").alias("city_token_raw"), "country_scope")


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """df marked for broadcast if it has at most `rows` rows; else unchanged, and the planner shuffles."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def map_points(base: DataFrame, candidates: DataFrame, cache: DataFrame) -> DataFrame:
    """Candidates with job fields, coordinates, status and weight. Candidates that carry base's columns need no join with it."""
    known = small(cache.filter("provider = 'geoapify'").select("location_text_norm", F.col("country_scope").alias("scope"), F.col("lat").alias("g_lat"), F.col("lon").alias("g_lon"), F.col("status").alias("g_status"), F.col("city").alias("geocode_city"), F.col("provider").alias("g_provider")))
    rows = candidates if set(base.columns) - {"is_remote_like"} <= set(candidates.columns) else candidates.join(base.drop("is_remote_like"), KEY)
    rows = rows.join(known, (F.col("token_kind") == "city") & (F.col("location_text_norm") == F.col("city_token_norm")) & (F.col("scope") == F.col("country_scope")), "left")
    remote = F.col("token_kind") == "remote"
    south, north, west, east = locations.BOX
    key = F.concat_ws(":", "platform", "job_id")
    shared = F.lit(1.0) / (F.col("map_locations_used") + 1)
    weight = (
        F.when(remote, F.when(F.col("has_city_tokens"), shared).otherwise(1.0))
        .when(F.col("map_locations_used") > 0, F.when(F.col("is_remote_like") & F.col("has_city_tokens"), shared).otherwise(F.lit(1.0) / F.col("map_locations_used")))
    )
    return rows.withColumns({
        "map_point_id": F.concat_ws(":", "platform", "job_id", "token_kind", F.coalesce("city_token_idx", F.lit(0)).cast("string")),
        "map_city_label": F.when(remote, locations.REMOTE_LABEL).otherwise(locations.initcap_words(F.col("city_token_norm"))),
        "lat": F.when(remote, locations.scatter(F.concat(key, F.lit(":remote:lat")), south, north)).otherwise(F.col("g_lat")),
        "lon": F.when(remote, locations.scatter(F.concat(key, F.lit(":remote:lon")), west, east)).otherwise(F.col("g_lon")),
        "geocode_status": F.when(remote, "remote_scatter").when(F.col("city_token_norm").isNull(), "missing_input").otherwise(F.coalesce("g_status", F.lit("not_cached"))),
        "geocode_provider": F.when(remote, "synthetic").otherwise(F.coalesce("g_provider", F.lit("geoapify"))),
        "remote_scatter_ok": remote, "map_weight": weight, "is_geocoded": remote | (F.col("g_lat").isNotNull() & F.col("g_lon").isNotNull()),
    }).drop("location_text_norm", "scope", "g_lat", "g_lon", "g_status", "g_provider")


def _jobs(condition: Column | None = None) -> Column:
    """Distinct jobs, optionally those with a condition."""
    job = F.struct("platform", "job_id")
    return F.count_distinct(job if condition is None else F.when(condition, job)).cast("long")


def city_bubbles(points: DataFrame, as_of: Column, companies: int = 5, most_skills: int = 10) -> DataFrame:
    """City points grouped by place and label: distinct jobs, weight, new jobs, top companies and skills (by jobs, ties by name).

    One pass over points: each job of a place becomes one row, that row one for the place, its company and each of its skills,
    and these are counted together. Counting precedes the ranking, which therefore sees one row for each place and name.
    """
    by = ["lat", "lon", "bubble"]
    rows = points.filter("token_kind = 'city' and lat is not null and lon is not null").withColumns({"event_ts": event_ts(), "bubble": F.coalesce(F.nullif("geocode_city", F.lit("")), F.col("map_city_label"))})
    # the weight is a sum of k/(1..11): summed exactly in units of 1/27720, so the order of rows does not matter
    weight = F.round(F.col("map_weight") * 27720).cast("long")
    rows = rows.select(*KEY, *by, "event_ts", weight.alias("weight"), "company_name", "extracted_skills")
    jobs = rows.groupBy(*KEY, *by).agg(F.sum("weight").alias("weight"), F.max("event_ts").alias("event_ts"), F.min("company_name").alias("company"), F.min("extracted_skills").alias("skills"))
    since = lambda **d: F.coalesce(F.col("event_ts") >= as_of - F.lit(timedelta(**d)), F.lit(False))
    item = lambda kind, name: F.struct(F.lit(kind).alias("kind"), name.alias("name"))
    company = F.when(F.trim("company") != "", F.array(item("company", F.col("company")))).otherwise(F.array())
    named = F.filter(F.array_distinct(F.coalesce(skills.skill_values(F.col("skills")), F.array())), lambda s: F.trim(s) != "")
    every = F.concat(F.array(item("place", F.lit(None).cast("string"))), company, F.transform(named, lambda s: item("skill", s)))
    counted = jobs.select(*by, "weight", since(days=1).alias("d1"), since(days=7).alias("d7"), F.explode(every).alias("x")).groupBy(*by, "x.kind", "x.name")
    counted = counted.agg(F.count("*").alias("n"), F.sum("weight").alias("weight"), F.count_if("d1").alias("d1"), F.count_if("d7").alias("d7"))
    ranked = counted.withColumn("at", F.row_number().over(Window.partitionBy(*by, "kind").orderBy(F.desc("n"), F.asc("name")))).filter(F.col("at") <= F.when(F.col("kind") == "skill", most_skills).otherwise(companies))
    own = lambda c: F.max(F.when(F.col("kind") == "place", F.col(c)))
    top = lambda kind: F.transform(F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("at", "name")))), lambda x: x["name"])
    out = ranked.groupBy(*by).agg(own("n").alias("jobs_unique"), (own("weight") / 27720.0).alias("jobs_weighted"), own("d1").alias("new_24h_unique"), own("d7").alias("new_7d_unique"), top("company").alias("c"), top("skill").alias("s"))
    filled = lambda c: F.when(F.size(c) > 0, F.col(c))
    return out.select("lat", "lon", F.col("bubble").alias("map_city_label"), "jobs_unique", "jobs_weighted", "new_24h_unique", "new_7d_unique", filled("c").alias("top_companies"), filled("s").alias("top_skills"), F.lit("city").alias("token_kind"))


def job_map(base: DataFrame, cache: DataFrame) -> DataFrame:
    """One row per job, its whole location looked up in the cache."""
    known = small(cache.filter("provider = 'geoapify'").select(F.col("location_text_norm").alias("k_norm"), F.col("country_scope").alias("k_scope"), "lat", "lon", "status"))
    rows = base.withColumns({"location_text_norm": locations.location_norm(F.col("job_location")), "geocode_country_scope": locations.country_scope(F.col("platform"))})
    rows = rows.join(known, (F.col("k_norm") == F.col("location_text_norm")) & (F.col("k_scope") == F.col("geocode_country_scope")), "left")
    status = F.when(F.col("location_text_norm").isNull(), "missing_input").otherwise(F.coalesce("status", F.lit("not_cached")))
    return rows.withColumns({"geocode_status": status, "is_geocoded": F.col("lat").isNotNull() & F.col("lon").isNotNull()}).drop("k_norm", "k_scope", "status")


def recent_bubbles(points: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Distinct jobs by place and label, posted or first seen in the last days."""
    cutoff = as_of - F.lit(timedelta(days=days))
    rows = points.filter("token_kind = 'city' and lat is not null and lon is not null").filter((F.col("posted_at_utc") >= cutoff) | (F.col("first_seen_at") >= cutoff))
    return rows.groupBy("lat", "lon", "map_city_label").agg(_jobs().alias("jobs_unique"))
