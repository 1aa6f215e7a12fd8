"""The job model projected onto a star schema of orders, customers and so on, by arithmetic on the keys.

It gives realistic tables whose size follows the input, with every branch of the rules in them. The same projection
in SQL (`SQL`) is the start of the statements that results are compared with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-08-01 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"
PLATFORMS = ["linkedin", "stepstone", "xing"]
TITLES = [
    "Data Engineer", "Werkstudent:in Data Engineering", "Student Success Manager", "Internal Tools Engineer", "Praktikant Controlling", "Software Engineer (Part-Time)",
    "Working Student Analytics", "Teilzeitjob Lager", "Studentische Hilfskraft IT", "Senior Consultant", "Pflichtpraktikum Marketing",
]
DESCRIPTIONS = [
    "We build pipelines with Spark and SQL.", "Apply as a working student in our team.", "An internship for curious people.", "Auch in Teilzeit möglich.", "", None,
    "Werkstudent oder Praktikum, wir freuen uns.", "Full time role, permanent contract, überpraktikum.", "Golang, Kubernetes and SQL Server.",
]
LOCATIONS = [
    "Berlin, Hamburg / München", "Bavaria, Germany", "Munich, Bavaria, Germany", "Berlin (Hybrid)", "Remote", "Berlin Hybrid", "Home-Office", "A, Berlin, berlin", "Garmisch-Partenkirchen",
    "Aachen, Bonn, Celle, Dresden, Essen, Fulda, Gera, Halle, Ingolstadt, Jena, Kassel, Leipzig", "", None, " Oldenburg   , Lower   Saxony ", "Frankfurt am Main | Köln",
]
POSTED = [
    "3 days ago", "1 month ago", "vor 2 Wochen", "vor 1 Tag", "Published: 5 hours ago", "Heute", "yesterday", "just now", "", None, "über 30 Tage", "2 years ago", "vor 45 Minuten",
]
EMPLOYMENT = ["Full-time", "Part-time", "Internship", " ", None, "Student", "For students", "Contract"]
CONTRACTS = ["Feste Anstellung", "Befristeter Vertrag", "", None, "Praktikum"]
WORK_TYPES = ["Vollzeit", "Teilzeit", "Homeoffice möglich, Teilzeit", None, "Industrial Placement Student"]
MODELS = ["Remote", "Hybrid", "On-site", None]
SKILLS = [
    '{"languages":["Python","SQL"],"tools":["Spark"]}', '{"languages":["Python"],"note":"x"}', '{"a":[" ","SQL "]}', "{}", None, '{"cloud":["AWS","Azure"],"languages":["Go","Python"]}', '{"tools":["Kafka","spark"]}',
]
CITIES = ["berlin", "hamburg", "münchen", "munich", "aachen", "bonn", "dresden", "leipzig", "garmisch-partenkirchen", "bavaria", "köln", "halle", "kassel", "oldenburg", "essen"]


def _pick(values: list, at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (at % len(values) + 1).cast("int"))


def _sql_pick(values: list, at: str) -> str:
    return "[" + ", ".join("null" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + f"][1 + ({at}) % {len(values)}]"


def _days(at: str, n: Column) -> Column:
    return F.lit(at).cast("timestamp") - F.make_interval(days=n.cast("int"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    seen = _days(AS_OF, k * 7 % 200)
    return table(spark, sf_dir, "orders").select(
        _pick(PLATFORMS, k).alias("platform"), k.cast("string").alias("job_id"), F.concat(F.lit("https://jobs.example.org/view/"), k.cast("string")).alias("job_url"),
        (seen - F.make_interval(days=(k % 90).cast("int"))).alias("first_seen_at"), seen.alias("last_seen_at"),
        F.when(k % 11 == 0, None).when(k % 11 < 3, False).otherwise(True).alias("is_active"),
        F.lit(None).cast("timestamp").alias("stale_since_at"), F.when(k % 11 == 2, seen).cast("timestamp").alias("expired_at"), F.when(k % 11 == 2, "http_410").alias("expire_reason"),
    )


def details(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, platform = F.col("o_orderkey"), _pick(PLATFORMS, F.col("o_orderkey"))
    only = lambda name, c: F.when(platform == name, c)
    rows = table(spark, sf_dir, "orders").filter(k % 10 != 0).join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    return rows.select(
        platform.alias("platform"), k.cast("string").alias("job_id"), F.when(k % 23 != 0, _days(AS_OF, k * 7 % 200 + k % 5)).alias("scraped_at"),
        _pick(TITLES, k * 3).alias("job_title"), F.when(k % 13 == 0, "").when(k % 17 != 0, F.concat(F.lit(" "), F.col("c_name"))).alias("company_name"),
        _pick(LOCATIONS, k * 5).alias("job_location"), _pick(POSTED, k * 2).alias("posted_time_ago"), _pick(DESCRIPTIONS, k * 4).alias("job_description"),
        only("xing", F.when(k % 4 == 0, _days(AS_OF, k % 300))).alias("native_posted_at_utc"),
        F.when(platform.isin("linkedin", "xing"), _pick(EMPLOYMENT, k * 3 + 1)).alias("employment_type"), only("stepstone", _pick(CONTRACTS, k)).alias("contract_type"),
        only("stepstone", _pick(WORK_TYPES, k * 2)).alias("work_type"), only("stepstone", F.when(k % 7 != 0, k % 7 == 1)).alias("part_time"),
        only("stepstone", F.when(k % 8 != 0, k % 8 == 1)).alias("homeoffice_possible"), only("xing", _pick(MODELS, k * 3)).alias("work_model"),
        (k % 19 != 0).alias("parse_ok"), F.when(k % 19 == 0, F.when(k % 38 == 0, "blocked").otherwise("http_410")).alias("last_error"),
        _pick(SKILLS, k * 2 + 1).alias("extracted_skills"), F.when(k % 6 != 0, (k % 3).cast("int")).alias("extracted_skills_version"),
    )


def geocodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cache row for each (nation, city) pair whose number is even; a few are unresolved."""
    k = F.col("n_nationkey")
    rows = table(spark, sf_dir, "nation").filter(k < len(CITIES))
    resolved = k % 7 != 3
    return rows.select(
        (k + 1).cast("long").alias("id"), F.lit("geoapify").alias("provider"), _pick(CITIES, k).alias("location_text_norm"), F.lit("de").alias("country_scope"),
        F.when(resolved, "resolved").when(k % 2 == 0, "failed_permanent").otherwise("no_match").alias("status"), (k % 6).cast("int").alias("attempt_count"),
        F.when(resolved, F.lit(48.0) + k * 0.25).alias("lat"), F.when(resolved, F.lit(7.0) + k * 0.5).alias("lon"), F.when(resolved & (k % 3 == 0), "").when(resolved & (k % 3 == 1), F.concat(F.lit("City "), k.cast("string"))).alias("city"),
        F.when(~resolved, _days(AS_OF, k - 8)).alias("next_retry_at"), F.lit(None).cast("timestamp").alias("resolved_at"), F.lit(None).cast("string").alias("last_error"),
    )


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search hits, one a line item: the first of its key wins."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("search_run_id"), _pick(PLATFORMS, F.col("l_orderkey")).alias("platform"), F.col("l_orderkey").cast("string").alias("job_id"),
        F.col("l_linenumber").alias("rank"), F.col("l_quantity").cast("int").alias("page_start"), F.col("l_shipdate").alias("scraped_at"),
        (((F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100_000 + F.col("l_suppkey")) * 20_000 + F.datediff("l_shipdate", F.lit("1990-01-01"))).alias("seq"),
    )


def crawl_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs, one an event."""
    e = F.col("event_type")
    status = F.when(e == "purchase", "success").when(e == "error", "failed").when(e == "click", "blocked").when(e == "signup", "running").otherwise("success")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("run_id"), _pick(PLATFORMS, F.col("event_id")).alias("platform"), F.when(F.col("user_id") % 3 == 0, "manual").otherwise("schedule").alias("trigger"), status.alias("status"),
        F.col("ts").alias("started_at"), F.when(status != "running", F.col("ts") + F.make_interval(mins=(F.col("event_id") % 90).cast("int"))).alias("finished_at"),
        F.col("user_id").alias("search_definition_id"), (F.col("event_id") % 7).cast("int").alias("pages_fetched"), F.floor("value").cast("long").alias("jobs_discovered"), F.col("props").alias("stats"),
        F.when(status == "failed", "boom").alias("error"),
    )


def search_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search runs, two a customer; each belongs to a crawl run and to a definition."""
    k, half = F.col("c_custkey"), F.explode(F.array(F.lit(0), F.lit(1)))
    rows = table(spark, sf_dir, "customer").select(k, "c_nationkey", half.alias("h"))
    status = F.when((k + F.col("h")) % 3 == 0, "running").when((k + F.col("h")) % 3 == 1, "success").otherwise("blocked")
    return rows.select((k * 2 + F.col("h")).alias("search_run_id"), (k * 3 + F.col("h")).alias("crawl_run_id"), F.col("c_nationkey").alias("search_definition_id"), status.alias("status"), F.lit(None).cast("timestamp").alias("finished_at"), F.when(k % 5 == 0, "slow").alias("error"))


def definitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("search_definition_id"), _pick(PLATFORMS, F.col("n_nationkey")).alias("source"))


def geocode_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A cache row for each customer's place, in every state."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("id"), F.lower("c_name").alias("location_text_norm"), _pick(["pending", "error", "no_match", "resolved", "failed_permanent"], k).alias("status"),
        (k % 7).cast("int").alias("attempt_count"), F.when(k % 4 != 0, _days(AS_OF, k % 11 - 5)).alias("next_retry_at"),
    )


SQL = f"""
star_jobs as (select {_sql_pick(PLATFORMS, "o_orderkey")} as platform, cast(o_orderkey as varchar) as job_id, 'https://jobs.example.org/view/' || o_orderkey as job_url,
  timestamp '{AS_OF}' - to_days(cast(o_orderkey * 7 % 200 + o_orderkey % 90 as integer)) as first_seen_at, timestamp '{AS_OF}' - to_days(cast(o_orderkey * 7 % 200 as integer)) as last_seen_at,
  case when o_orderkey % 11 = 0 then null when o_orderkey % 11 < 3 then false else true end as is_active, cast(null as timestamp) as stale_since_at,
  case when o_orderkey % 11 = 2 then timestamp '{AS_OF}' - to_days(cast(o_orderkey * 7 % 200 as integer)) end as expired_at, case when o_orderkey % 11 = 2 then 'http_410' end as expire_reason, o_orderkey as k from orders),
star_details as (select platform, job_id, case when k % 23 <> 0 then timestamp '{AS_OF}' - to_days(cast(k * 7 % 200 + k % 5 as integer)) end as scraped_at, {_sql_pick(TITLES, "k * 3")} as job_title,
  case when k % 13 = 0 then '' when k % 17 <> 0 then ' ' || c_name end as company_name, {_sql_pick(LOCATIONS, "k * 5")} as job_location, {_sql_pick(POSTED, "k * 2")} as posted_time_ago, {_sql_pick(DESCRIPTIONS, "k * 4")} as job_description,
  case when platform = 'xing' and k % 4 = 0 then timestamp '{AS_OF}' - to_days(cast(k % 300 as integer)) end as native_posted_at_utc, case when platform <> 'stepstone' then {_sql_pick(EMPLOYMENT, "k * 3 + 1")} end as employment_type,
  case when platform = 'stepstone' then {_sql_pick(CONTRACTS, "k")} end as contract_type, case when platform = 'stepstone' then {_sql_pick(WORK_TYPES, "k * 2")} end as work_type,
  case when platform = 'stepstone' and k % 7 <> 0 then k % 7 = 1 end as part_time, case when platform = 'stepstone' and k % 8 <> 0 then k % 8 = 1 end as homeoffice_possible, case when platform = 'xing' then {_sql_pick(MODELS, "k * 3")} end as work_model,
  k % 19 <> 0 as parse_ok, case when k % 19 = 0 then case when k % 38 = 0 then 'blocked' else 'http_410' end end as last_error, {_sql_pick(SKILLS, "k * 2 + 1")} as extracted_skills, case when k % 6 <> 0 then cast(k % 3 as integer) end as extracted_skills_version
  from star_jobs join orders on o_orderkey = k left join customer on o_custkey = c_custkey where k % 10 <> 0),
star_geo as (select cast(n_nationkey + 1 as bigint) as id, 'geoapify' as provider, {_sql_pick(CITIES, "n_nationkey")} as location_text_norm, 'de' as country_scope,
  case when n_nationkey % 7 <> 3 then 'resolved' when n_nationkey % 2 = 0 then 'failed_permanent' else 'no_match' end as status, n_nationkey % 6 as attempt_count,
  case when n_nationkey % 7 <> 3 then 48.0::double + n_nationkey * 0.25::double end as lat, case when n_nationkey % 7 <> 3 then 7.0::double + n_nationkey * 0.5::double end as lon,
  case when n_nationkey % 7 <> 3 then case when n_nationkey % 3 = 0 then '' when n_nationkey % 3 = 1 then 'City ' || n_nationkey end end as city,
  case when n_nationkey % 7 = 3 then timestamp '{AS_OF}' - to_days(n_nationkey - 8) end as next_retry_at from nation where n_nationkey < {len(CITIES)}),
star_hits as (select l_suppkey as search_run_id, {_sql_pick(PLATFORMS, "l_orderkey")} as platform, cast(l_orderkey as varchar) as job_id, l_linenumber as rank, cast(l_quantity as integer) as page_start, l_shipdate as scraped_at, ((l_orderkey * 8 + l_linenumber) * 100000 + l_suppkey) * 20000 + date_diff('day', date '1990-01-01', cast(l_shipdate as date)) as seq from lineitem),
star_runs as (select event_id as run_id, {_sql_pick(PLATFORMS, "event_id")} as platform, case when user_id % 3 = 0 then 'manual' else 'schedule' end as trigger,
  case event_type when 'purchase' then 'success' when 'error' then 'failed' when 'click' then 'blocked' when 'signup' then 'running' else 'success' end as status, ts as started_at,
  case when event_type <> 'signup' then ts + to_minutes(event_id % 90) end as finished_at, user_id as search_definition_id, cast(event_id % 7 as integer) as pages_fetched, cast(floor(value) as bigint) as jobs_discovered, props as stats,
  case when event_type = 'error' then 'boom' end as error from events),
star_searches as (select c_custkey * 2 + h as search_run_id, c_custkey * 3 + h as crawl_run_id, c_nationkey as search_definition_id, case (c_custkey + h) % 3 when 0 then 'running' when 1 then 'success' else 'blocked' end as status, cast(null as timestamp) as finished_at, case when c_custkey % 5 = 0 then 'slow' end as error from customer, (values (0), (1)) as t(h)),
star_definitions as (select n_nationkey as search_definition_id, {_sql_pick(PLATFORMS, "n_nationkey")} as source from nation),
star_requests as (select c_custkey as id, {_sql_pick(["pending", "error", "no_match", "resolved", "failed_permanent"], "c_custkey")} as status, c_custkey % 7 as attempt_count, case when c_custkey % 4 <> 0 then timestamp '{AS_OF}' - to_days(cast(c_custkey % 11 - 5 as integer)) end as next_retry_at from customer)
"""
