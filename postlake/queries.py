"""The registered queries over the job model, and the same in SQL."""

from __future__ import annotations

import pathlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.functions import intake, locations, urls
from postlake.operators import extraction, geocoding, ingest, keyed, lifecycle, postings, reports, searches, taxonomy
from postlake.plans import analytics, places, serving
from postlake.plans import roles as role_plan
from postlake.plans.unified import event_ts, unify
from postlake.sources import star

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query and its SQL, which may use the tables of star.SQL and of COMMON."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = "with recursive " + star.SQL.strip() + ",\n" + COMMON + "\n" + sql.strip()
        return f

    return put


def _now():
    return F.lit(star.AS_OF).cast("timestamp")


def base(spark: SparkSession, sf: str) -> DataFrame:
    return unify(star.jobs(spark, sf), star.details(spark, sf))


def points(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    rows = base(spark, sf) if rows is None else rows
    return places.map_points(rows, places.location_candidates(rows, carry=True), star.geocodes(spark, sf))


def bubbles(spark: SparkSession, sf: str) -> DataFrame:
    return places.city_bubbles(points(spark, sf), _now())


#: Rules with literal patterns and word lists, so that a wrong one in the package differs from them.
COMMON = (pathlib.Path(__file__).parent / "sql" / "job_model.sql").read_text().split("\n", 1)[1]


@query("unified_jobs", "select platform, job_id, company_name, scraped_at, first_seen_at, last_seen_at, posted_at_utc, posted_at_source, posted_at_parse_ok, posted_at_parse_detail from uno")
def unified_jobs(spark, sf):
    return base(spark, sf).select("platform", "job_id", "company_name", "scraped_at", "first_seen_at", "last_seen_at", "posted_at_utc", "posted_at_source", "posted_at_parse_ok", "posted_at_parse_detail")


@query("monthly_trend", f"""
select cast(b as timestamp) as bucket_start, cast(coalesce(n, 0) as bigint) as jobs_unique from generate_series(date_trunc('month', timestamp '{star.AS_OF}' - interval 11 month), timestamp '{star.AS_OF}', interval 1 month) as s(b)
left join (select date_trunc('month', event_ts) as m, count(distinct platform || job_id) as n from uno group by 1) q on q.m = b""")  # fmt: skip
def monthly_trend(spark, sf):
    return analytics.monthly_trend(base(spark, sf), _now())


@query("kpis", f"""
select (select count(*) from uno where last_seen_at >= timestamp '{star.AS_OF}' - interval 60 day) as total_active_jobs,
(select count(distinct platform || job_id) from cand join uno using (platform, job_id) where kind = 'remote' and last_seen_at >= timestamp '{star.AS_OF}' - interval 60 day) as remote_roles,
(select count(distinct trim(company_name)) from uno where first_seen_at >= timestamp '{star.AS_OF}' - interval 7 day and trim(company_name) <> '') as new_companies_7d, timestamp '{star.AS_OF}' as as_of""")  # fmt: skip
def kpis(spark, sf):
    rows = base(spark, sf)
    return analytics.kpis(rows, _now())


@query("top_skills", f"""
select w as days_window, lower(trim(s)) as skill, count(distinct platform || job_id) as jobs_unique from skill, (values (30), (90)) as t(w) where trim(s) <> '' and event_ts >= timestamp '{star.AS_OF}' - to_days(w) group by all""")  # fmt: skip
def top_skills(spark, sf):
    return analytics.top_skills(base(spark, sf), _now())


_ROLE_COLUMNS = ["platform", "job_id", "employment_type", "part_time_flag", "is_working_student", "is_internship", "is_part_time", "is_target_role", "target_role_confidence"]
_REASONS = {
    "working_student.structured_terms": "ws_s", "working_student.xing_employment_type": "ws_x", "working_student.title_terms": "ws_t", "working_student.description_terms": "ws_e", "internship.structured_terms": "in_s", "internship.linkedin_employment_type": "in_l",
    "internship.title_terms": "in_t", "internship.description_terms": "in_e", "part_time.part_time_flag": "pt_f", "part_time.structured_terms": "pt_s", "part_time.linkedin_employment_type": "pt_l", "part_time.xing_employment_type": "pt_x", "part_time.title_terms": "pt_t", "part_time.description_terms": "pt_d",
}
_ROLE_SQL = f"""platform, job_id, employment_type, part_time_flag, is_working_student, is_internship, is_part_time, is_target_role, ['low', 'medium', 'high'][rnk] as target_role_confidence, cast(rnk as smallint) as target_role_confidence_rank,
concat_ws('|', case when ws_s or ws_x or in_s or in_l or pt_f or pt_s or pt_l or pt_x then 'structured' end, case when ws_t or in_t or pt_t then 'title' end, case when ws_e or in_e or pt_d then 'description' end) as match_sources,
concat_ws('|', {", ".join(f"case when {c} then '{n}' end" for n, c in _REASONS.items())}) as match_reasons"""


def _role_view(rows: DataFrame) -> DataFrame:
    return rows.select(*_ROLE_COLUMNS, "target_role_confidence_rank", F.array_join("match_sources", "|").alias("match_sources"), F.array_join("match_reasons", "|").alias("match_reasons"))


@query("role_classification", f"select {_ROLE_SQL} from cls")
def role_classification(spark, sf):
    return _role_view(role_plan.classify(base(spark, sf)))


@query("target_jobs", f"select {_ROLE_SQL} from cls where is_target_role")
def target_jobs(spark, sf):
    return _role_view(role_plan.target_jobs(base(spark, sf)))


@query("working_student_jobs", f"select {_ROLE_SQL} from cls where is_working_student and is_active and rnk >= 2")
def working_student_jobs(spark, sf):
    return _role_view(role_plan.role_jobs(role_plan.target_jobs(base(spark, sf))))


@query("low_confidence_jobs", f"select {_ROLE_SQL} from cls where is_internship and is_active and rnk = 1")
def low_confidence_jobs(spark, sf):
    return _role_view(role_plan.role_jobs(role_plan.target_jobs(base(spark, sf)), "internship", ("low",)))


@query("location_candidates", "select platform, job_id, kind as token_kind, cast(idx as integer) as city_token_idx, tok as city_token_norm, cast(total as integer) as map_locations_total, cast(used as integer) as map_locations_used, remote_like as is_remote_like from cand")
def location_candidates(spark, sf):
    return places.location_candidates(base(spark, sf)).select("platform", "job_id", "token_kind", "city_token_idx", "city_token_norm", "map_locations_total", "map_locations_used", "is_remote_like")


@query("map_points", """
select platform || ':' || job_id || ':' || kind || ':' || coalesce(idx, 0) as map_point_id, label as map_city_label, case when kind = 'city' then lat end as city_lat, case when kind = 'city' then lon end as city_lon,
case when kind = 'remote' then 'remote_scatter' else coalesce(gstatus, 'not_cached') end as geocode_status, round(weight, 9) as map_weight, kind = 'remote' or (lat is not null and lon is not null) as is_geocoded, kind = 'remote' as remote_scatter_ok from pt""")  # fmt: skip
def map_points(spark, sf):
    city = F.col("token_kind") == "city"
    south, north, west, east = locations.BOX
    box = F.col("lat").between(south, north) & F.col("lon").between(west, east)
    return points(spark, sf).select("map_point_id", "map_city_label", F.when(city, F.col("lat")).alias("city_lat"), F.when(city, F.col("lon")).alias("city_lon"), "geocode_status", F.round("map_weight", 9).alias("map_weight"), "is_geocoded", (~city & box).alias("remote_scatter_ok"))


_BUBBLES_SQL = """
tc as (select lat, lon, bl, string_agg(company_name, '|' order by pos) as top_companies from (select *, row_number() over (partition by lat, lon, bl order by n desc, company_name) as pos from (select lat, lon, bl, company_name, count(distinct platform || job_id) as n from bub0 where trim(company_name) <> '' group by all) q) q where pos <= 5 group by all),
ts as (select lat, lon, bl, string_agg(s, '|' order by pos) as top_skills from (select *, row_number() over (partition by lat, lon, bl order by n desc, s) as pos from (select lat, lon, bl, s, count(distinct b.platform || b.job_id) as n from bub0 b join skill k on b.platform = k.platform and b.job_id = k.job_id where trim(s) <> '' group by all) q) q where pos <= 10 group by all)
"""


@query("city_bubbles", "select 1")
def city_bubbles(spark, sf):
    rows = bubbles(spark, sf)
    return rows.select("lat", "lon", "map_city_label", "jobs_unique", F.round("jobs_weighted", 6).alias("jobs_weighted"), "new_24h_unique", "new_7d_unique", F.array_join("top_companies", "|").alias("top_companies"), F.array_join("top_skills", "|").alias("top_skills"))


SQL["city_bubbles"] = SQL["city_bubbles"].removesuffix("select 1") + "," + _BUBBLES_SQL + "select lat, lon, bl as map_city_label, jobs_unique, round(jobs_weighted, 6) as jobs_weighted, new_24h_unique, new_7d_unique, top_companies, top_skills from bub left join tc using (lat, lon, bl) left join ts using (lat, lon, bl)"


@query("working_student_map", "select lat, lon, coalesce(nullif(gcity, ''), label) as map_city_label, count(distinct platform || job_id) as jobs_unique from pt join cls using (platform, job_id) where is_working_student and is_active and rnk >= 2 and kind = 'city' and lat is not null group by all")
def working_student_map(spark, sf):
    rows = role_plan.role_jobs(role_plan.target_jobs(base(spark, sf)))
    return places.city_bubbles(points(spark, sf, rows), _now()).select("lat", "lon", "map_city_label", "jobs_unique")


@query("working_student_kpis", f"""
select (select count(*) from cls where is_working_student and is_active and rnk >= 2) as total_active_jobs, (select count(distinct platform || job_id) from cand join cls using (platform, job_id) where kind = 'remote' and is_working_student and is_active and rnk >= 2) as remote_roles,
(select count(distinct trim(company_name)) from cls where is_working_student and is_active and rnk >= 2 and first_seen_at >= timestamp '{star.AS_OF}' - interval 7 day and trim(company_name) <> '') as new_companies_7d""")  # fmt: skip
def working_student_kpis(spark, sf):
    rows = role_plan.role_jobs(role_plan.target_jobs(base(spark, sf)))
    return analytics.kpis(rows, _now(), active_days=None).drop("as_of")


_NORM_SQL = "nullif(lower(trim(regexp_replace(regexp_replace(coalesce(job_location, ''), '\\s+', ' ', 'g'), '\\s*,\\s*', ', ', 'g'))), '')"


@query("job_map", f"""
select platform, job_id, {_NORM_SQL} as location_text_norm, case when platform = 'xing' then 'de,at,ch' else 'de' end as geocode_country_scope, case when {_NORM_SQL} is null then 'missing_input' else coalesce(g.status, 'not_cached') end as geocode_status,
lat is not null and lon is not null as is_geocoded from uno left join star_geo g on g.location_text_norm = {_NORM_SQL} and g.country_scope = case when platform = 'xing' then 'de,at,ch' else 'de' end""")  # fmt: skip
def job_map(spark, sf):
    return places.job_map(base(spark, sf), star.geocodes(spark, sf)).select("platform", "job_id", "location_text_norm", "geocode_country_scope", "geocode_status", "is_geocoded")


@query("recent_bubbles", f"select lat, lon, label as map_city_label, count(distinct platform || job_id) as jobs_unique from bub0 where posted_at_utc >= timestamp '{star.AS_OF}' - interval 30 day or first_seen_at >= timestamp '{star.AS_OF}' - interval 30 day group by all")
def recent_bubbles(spark, sf):
    return places.recent_bubbles(points(spark, sf), _now())


@query("bubbles_in_box", "select lat, lon, bl as map_city_label, jobs_unique from bub where lat between 48 and 50 and lon between 7 and 12 and jobs_unique > 0 order by jobs_unique desc, lat, lon, bl limit 500")
def bubbles_in_box(spark, sf):
    return serving.bubbles(bubbles(spark, sf), (48, 7, 50, 12)).select("lat", "lon", "map_city_label", "jobs_unique")


@query("hotspots", "select lat, lon, bl as map_city_label, new_7d_unique from bub where new_7d_unique > 0 order by new_7d_unique desc, lat, lon, bl limit 8")
def hotspots(spark, sf):
    return serving.hotspots(bubbles(spark, sf)).select("lat", "lon", "map_city_label", "new_7d_unique")


@query("top_skills_page", f"select 90 as days_window, lower(trim(s)) as skill, count(distinct platform || job_id) as jobs_unique from skill where trim(s) <> '' and event_ts >= timestamp '{star.AS_OF}' - interval 90 day group by all order by jobs_unique desc, skill limit 5")
def top_skills_page(spark, sf):
    return serving.top_skills_page(analytics.top_skills(base(spark, sf), _now()), 90, 5)


@query("trend_tail", f"""
select cast(b as timestamp) as bucket_start, cast(coalesce(n, 0) as bigint) as jobs_unique from generate_series(date_trunc('month', timestamp '{star.AS_OF}' - interval 5 month), timestamp '{star.AS_OF}', interval 1 month) as s(b)
left join (select date_trunc('month', event_ts) as m, count(distinct platform || job_id) as n from uno group by 1) q on q.m = b""")  # fmt: skip
def trend_tail(spark, sf):
    return serving.trend_tail(analytics.monthly_trend(base(spark, sf), _now()), _now(), 6)


@query("city_jobs", "select platform, job_id, posted_at_utc from bub0 where abs(lat - 48) <= 1e-7 and abs(lon - 7) <= 1e-7 group by all order by posted_at_utc desc nulls last, platform, job_id limit 200")
def city_jobs(spark, sf):
    return serving.city_jobs(points(spark, sf), 48.0, 7.0, _now()).select("platform", "job_id", "posted_at_utc")


@query("remote_points", "select platform || ':' || job_id || ':remote:0' as map_point_id from cand where kind = 'remote' order by 1 limit 1000")
def remote_points(spark, sf):
    return serving.remote_points(points(spark, sf), _now()).select("map_point_id")


@query("job_detail", "select platform, job_id, job_title, posted_at_source from uno where platform = 'stepstone' and job_id = '1'")
def job_detail(spark, sf):
    return serving.job_detail(base(spark, sf), "stepstone", "1").select("platform", "job_id", "job_title", "posted_at_source")


@query("flat_skills", """
select platform, job_id, array_to_string(list_slice(list_filter(l, lambda x, i: list_position(l, x) = i), 1, 10), '|') as skills from (select platform, job_id, list_filter(list_transform(flatten(list_transform(list_filter(json_keys(coalesce(extracted_skills, '{}')), lambda g: json_type(extracted_skills, '$.' || g) = 'ARRAY'),
  lambda g: cast(json_extract(extracted_skills, '$.' || g) as varchar[]))), lambda x: trim(x)), lambda x: x <> '') as l from uno) q where len(l) > 0""")  # fmt: skip
def flat_skills(spark, sf):
    from postlake.functions.skills import flat_skills as flat

    return base(spark, sf).select("platform", "job_id", flat(F.col("extracted_skills")).alias("s")).filter("size(s) > 0").select("platform", "job_id", F.array_join("s", "|").alias("skills"))


@query("freshness_order", "select platform, job_id, event_ts from cls where is_target_role")
def freshness_order(spark, sf):
    rows = role_plan.target_jobs(base(spark, sf)).select("platform", "job_id", event_ts().alias("event_ts"))
    return serving.newest_first(rows, F.col("event_ts"))


@query("parse_gaps", "select posted_time_ago, count(*) as n from uno where posted_at_source = 'unparsed_format' group by all")
def parse_gaps(spark, sf):
    return base(spark, sf).filter("posted_at_source = 'unparsed_format'").groupBy("posted_time_ago").agg(F.count("*").alias("n"))


# ---- ingest and keyed writes: line items are log lines, in the order of seq ----
def _found(spark, sf):
    return star.hits(spark, sf).withColumn("job_url", F.concat(F.lit("https://new.example.org/"), "job_id"))


_FOUND_SQL = "found as (select *, 'https://new.example.org/' || job_id as job_url from star_hits),\nlastl as (select platform, job_id, arg_max(job_url, seq) as url, arg_max(scraped_at, seq) as seen, arg_min(scraped_at, seq) as first from found group by all)\n"


def with_sql(extra: str, sql: str) -> str:
    return "select * from (with " + extra + sql + ") q"


@query("apply_discovery", with_sql(_FOUND_SQL, """select coalesce(j.platform, l.platform) as platform, coalesce(j.job_id, l.job_id) as job_id, coalesce(url, job_url) as job_url, coalesce(first_seen_at, first) as first_seen_at, coalesce(seen, last_seen_at) as last_seen_at,
case when l.job_id is not null then true else is_active end as is_active, case when l.job_id is null then expired_at end as expired_at, case when l.job_id is null then expire_reason end as expire_reason from (select * from star_jobs where k % 4 <> 0) j full join lastl l on l.platform = j.platform and l.job_id = j.job_id"""))
def apply_discovery(spark, sf):
    known = star.jobs(spark, sf).filter(F.col("job_id").cast("long") % 4 != 0)
    return ingest.apply_discovery(known, _found(spark, sf)).select("platform", "job_id", "job_url", "first_seen_at", "last_seen_at", "is_active", "expired_at", "expire_reason")


@query("insert_hits", "select search_run_id, platform, job_id, arg_min(rank, seq) as rank, arg_min(page_start, seq) as page_start, arg_min(scraped_at, seq) as scraped_at from star_hits group by all")
def insert_hits(spark, sf):
    found = _found(spark, sf)
    old = keyed.first_by_key(found.filter("search_run_id % 2 = 0"), ["search_run_id", "platform", "job_id"], ["seq"]).select("search_run_id", "platform", "job_id", "rank", "page_start", "scraped_at")
    return ingest.add_hits(old, found)


def _detail_log(spark, sf):
    """Detail lines from line items: some gone, some parsed, some neither."""
    n = F.col("seq") % 5
    return star.hits(spark, sf).select("platform", "job_id", "seq", "scraped_at", F.when(n == 1, "http_410").when(n == 2, "blocked").alias("last_error"), (n > 2).alias("parse_ok"))


_LOG_SQL = "log as (select platform, job_id, seq, scraped_at, case seq % 5 when 1 then 'http_410' when 2 then 'blocked' end as last_error, seq % 5 > 2 as parse_ok from star_hits)"


@query("apply_gone", with_sql(_LOG_SQL + """, dec as (select *, case when last_error = 'http_410' then 'gone' when parse_ok then 'back' end as what from log where last_error = 'http_410' or parse_ok),
lb as (select platform, job_id, max(case when what = 'back' then seq end) as reset, arg_max(what, seq) as last from dec group by all),
g as (select d.platform, d.job_id, arg_min(scraped_at, seq) as gone_at from dec d join lb using (platform, job_id) where what = 'gone' and (reset is null or seq > reset) group by all)
""", """select platform, job_id, case when last is not null then last = 'back' else is_active end as is_active, case when last = 'gone' then coalesce(case when reset is null then expired_at end, gone_at) when last is null then expired_at end as expired_at,
case when last = 'gone' then coalesce(case when reset is null then expire_reason end, 'http_410') when last is null then expire_reason end as expire_reason from star_jobs left join lb using (platform, job_id) left join g using (platform, job_id)"""))
def apply_gone(spark, sf):
    return ingest.apply_gone(star.jobs(spark, sf), _detail_log(spark, sf)).select("platform", "job_id", "is_active", "expired_at", "expire_reason")


@query("apply_details", with_sql(_LOG_SQL, """select coalesce(d.platform, l.platform) as platform, coalesce(d.job_id, l.job_id) as job_id, case when l.job_id is not null then l.scraped_at else d.scraped_at end as scraped_at, case when l.job_id is not null then l.parse_ok else d.parse_ok end as parse_ok,
case when l.job_id is not null then l.last_error else d.last_error end as last_error from star_details d full join (select platform, job_id, unnest(s) from (select platform, job_id, max_by(struct_pack(scraped_at, parse_ok, last_error), seq) as s from log group by platform, job_id) q) l on l.platform = d.platform and l.job_id = d.job_id"""))
def apply_details(spark, sf):
    return ingest.apply_details(star.details(spark, sf), _detail_log(spark, sf)).select("platform", "job_id", "scraped_at", "parse_ok", "last_error")


@query("detail_import_stats", with_sql(_LOG_SQL, "select count(*) as upserted, count(nullif(parse_ok, false)) as parse_ok, count(nullif(not parse_ok, false)) as parse_failed, count(nullif(last_error = 'blocked', false)) as blocked, count(nullif(last_error = 'blocked', false)) / greatest(count(*), 1) > 0.1 as is_blocked from log"))
def detail_import_stats(spark, sf):
    return ingest.detail_stats(_detail_log(spark, sf))


def _page_log(spark, sf):
    """Pages and discovered jobs from events."""
    e = F.col("event_type")
    return star.table(spark, sf, "events").select(F.col("user_id").alias("search_run_id"), F.when(e.isin("click", "error"), "page_fetch").when(e == "signup", "other").otherwise("job_discovered").alias("record_type"), (F.col("event_id") % 7).cast("int").alias("page_start"), (e == "error").alias("blocked"), "event_id", "ts")


_PAGES_SQL = "log as (select user_id as search_run_id, case when event_type in ('click', 'error') then 'page_fetch' when event_type = 'signup' then 'other' else 'job_discovered' end as record_type, cast(event_id % 7 as integer) as page_start, event_type = 'error' as blocked, event_id, ts from events)"


@query("search_run_stats", with_sql(_PAGES_SQL, " select search_run_id, count(distinct page_start) as pages, count(nullif(record_type = 'job_discovered', false)) as discovered, count(nullif(record_type = 'page_fetch' and blocked, false)) as blocked_pages, count(nullif(record_type = 'page_fetch' and blocked, false)) / greatest(count(distinct page_start), 1) > 0.5 as blocked from log where record_type <> 'other' group by all"))
def search_run_stats(spark, sf):
    return ingest.search_run_stats(_page_log(spark, sf))


@query("block_streaks", with_sql(_PAGES_SQL, """ select search_run_id, min(event_id) as first, max(event_id) as last, count(*) as length from (select *, sum(case when blocked then 0 else 1 end) over (partition by search_run_id order by event_id) as island from log where record_type = 'page_fetch') q where blocked group by search_run_id, island having count(*) >= 2"""))
def block_streaks(spark, sf):
    return lifecycle.block_streaks(_page_log(spark, sf).filter("record_type = 'page_fetch'"), ["search_run_id"], ["event_id"], 2)


@query("first_seen", "select search_run_id, platform, job_id, min(seq) as seq from star_hits group by all")
def first_seen(spark, sf):
    return lifecycle.first_seen(star.hits(spark, sf), ["search_run_id", "platform", "job_id"], ["seq"]).select("search_run_id", "platform", "job_id", "seq")


# ---- lifecycle ----
_AS = f"timestamp '{star.AS_OF}'"
_EV = f"timestamp '{star.EVENTS_AS_OF}'"


def _events_now():
    return F.lit(star.EVENTS_AS_OF).cast("timestamp")


@query("soft_expire", f"""select platform, job_id, case when s then false else is_active end as is_active, case when s then {_AS} end as stale_since_at, case when s then {_AS} else expired_at end as expired_at, case when s then 'not_seen_window' else expire_reason end as expire_reason
from (select *, coalesce(is_active, true) and last_seen_at < {_AS} - interval 60 day as s from star_jobs) q""")
def soft_expire(spark, sf):
    return lifecycle.soft_expire(star.jobs(spark, sf), _now()).select("platform", "job_id", "is_active", "stale_since_at", "expired_at", "expire_reason")


@query("lifecycle_counts", f"""select platform, count(nullif(coalesce(is_active, true) and last_seen_at < {_AS} - interval 60 day, false)) as soft_expired, count(nullif(last_seen_at < {_AS} - interval 120 day, false)) as jobs_deleted,
(select count(*) from star_hits h join star_jobs x on x.platform = h.platform and x.job_id = h.job_id where x.last_seen_at < {_AS} - interval 120 day and h.platform = j.platform) as hits_deleted,
(select count(*) from star_details h join star_jobs x on x.platform = h.platform and x.job_id = h.job_id where x.last_seen_at < {_AS} - interval 120 day and h.platform = j.platform) as details_deleted from star_jobs j group by platform""")
def lifecycle_counts(spark, sf):
    return lifecycle.lifecycle_counts(star.jobs(spark, sf), star.hits(spark, sf), star.details(spark, sf), _now())


@query("hard_delete", f"select d.platform, d.job_id from star_details d join star_jobs j on j.platform = d.platform and j.job_id = d.job_id where j.last_seen_at >= {_AS} - interval 120 day")
def hard_delete(spark, sf):
    return lifecycle.hard_delete(star.jobs(spark, sf), {"details": star.details(spark, sf)}, _now())[1]["details"].select("platform", "job_id")


@query("lifecycle_totals", f"select 'success' as status, count(nullif(coalesce(is_active, true) and last_seen_at < {_AS} - interval 60 day, false)) as soft_expired, count(nullif(last_seen_at < {_AS} - interval 120 day, false)) as jobs_deleted from star_jobs")
def lifecycle_totals(spark, sf):
    stats = lifecycle.lifecycle_counts(star.jobs(spark, sf), star.hits(spark, sf), star.details(spark, sf), _now()).withColumn("action_status", F.lit("processed"))
    return lifecycle.final_status(stats).select("status", "soft_expired", "jobs_deleted")


@query("health_gate", f"""select platform, r.run_id as run_id, r.status as status, case when r.status = 'success' and r.finished_at >= {_EV} - interval 36 hour then 'processed' else 'skipped_unhealthy' end as action_status,
case when r.status <> 'success' then 'status ' || r.status when r.finished_at is null then 'not finished' when r.finished_at < {_EV} - interval 36 hour then 'too old' end as note
from (select platform, max_by(struct_pack(run_id, status, finished_at), (epoch(started_at), run_id)) as r from star_runs group by platform) q""")
def health_gate(spark, sf):
    return lifecycle.health_gate(star.crawl_runs(spark, sf), _events_now()).select("platform", "run_id", "status", "action_status", "note")


@query("repair_stale_runs", f"""select run_id, case when s then 'abandoned' else status end as status, case when s then {_EV} else finished_at end as finished_at, case when s then coalesce(error, 'stale') else error end as error from (select *, status = 'running' and started_at < {_EV} - interval 600 minute as s from star_runs) q""")
def repair_stale_runs(spark, sf):
    runs = star.crawl_runs(spark, sf)
    searches = runs.select(F.col("run_id").alias("search_run_id"), F.col("run_id").alias("crawl_run_id"), "status", "finished_at", "error")
    return lifecycle.repair_stale_runs(runs, searches, _events_now(), 600)[0].select("run_id", "status", "finished_at", "error")


@query("cooldown_active", f"select platform, coalesce(max(case when status = 'blocked' then finished_at end) >= {_EV} - interval 180 minute, false) as cooldown from star_runs group by platform")
def cooldown_active(spark, sf):
    return lifecycle.cooldown_active(star.crawl_runs(spark, sf), _events_now(), 180)


@query("recency_policy", f"""select search_definition_id, has_finished, last_success, case when not has_finished then null when last_success >= {_EV} - interval 30 hour then 'r86400' else 'r604800' end as code
from (select search_definition_id, bool_or(finished_at is not null) as has_finished, max(case when status = 'success' then finished_at end) as last_success from star_runs group by all) q""")
def recency_policy(spark, sf):
    rows = lifecycle.search_history(star.crawl_runs(spark, sf))
    return rows.withColumn("code", lifecycle.recency_code(F.col("has_finished"), F.col("last_success"), _events_now()))


@query("detail_queue", f"""select j.platform, j.job_id from star_jobs j left join star_details d on d.platform = j.platform and d.job_id = j.job_id where last_seen_at > {_AS} - interval 60 day and coalesce(is_active, true)
and (d.job_id is null or scraped_at < {_AS} - interval 30 day or (last_error = 'blocked' and scraped_at < {_AS} - interval 24 hour)) order by d.job_id is null desc, scraped_at asc nulls first, last_seen_at desc, j.platform, j.job_id limit 500""")
def detail_queue(spark, sf):
    return lifecycle.detail_queue(star.jobs(spark, sf), star.details(spark, sf), _now(), 500).select("platform", "job_id")


@query("skill_queue", "select platform, job_id from star_details where parse_ok and trim(job_description) <> '' and (extracted_skills is null or coalesce(extracted_skills_version, 0) < 2) order by scraped_at desc nulls last, platform, job_id limit 500")
def skill_queue(spark, sf):
    return lifecycle.skill_queue(star.details(spark, sf), 2, 500).select("platform", "job_id")


# ---- geocode cache ----
@query("geocode_seed", "select distinct tok as location_text_norm from cand where kind = 'city' and tok not in (select location_text_norm from star_geo)")
def geocode_seed(spark, sf):
    return geocoding.seed(star.geocodes(spark, sf), places.location_candidates(base(spark, sf)), _now()).select("location_text_norm")


def _geocode_results(spark, sf):
    cache = star.geocodes(spark, sf).filter("status <> 'resolved' or id % 2 = 0")
    batch = cache.select("id", F.col("id").alias("position"), F.col("location_text_norm").alias("query"))
    results = batch.select("position", F.when(F.col("id") % 3 != 0, F.col("query")).alias("query"), F.when(F.col("id") % 4 != 0, "50.5").otherwise("x").alias("lat"), F.lit("8.25").alias("lon"), F.when(F.col("id") % 4 == 0, "bad").alias("error"))
    return batch, results


@query("geocode_apply", f"""select id, case when not asked then status when id % 4 <> 0 then 'resolved' when attempt_count + 1 >= 6 then 'failed_permanent' else 'error' end as status, case when not asked then lat when id % 4 <> 0 then 50.5 end as lat, case when asked then attempt_count + 1 else attempt_count end as attempt_count,
case when not asked then next_retry_at when id % 4 = 0 and attempt_count + 1 < 6 then {_AS} + to_minutes(cast(least(60 * pow(2, attempt_count), 10080) as bigint)) end as next_retry_at from (select *, status <> 'resolved' or id % 2 = 0 as asked from star_geo) q""")
def geocode_apply(spark, sf):
    batch, results = _geocode_results(spark, sf)
    return geocoding.apply_results(star.geocodes(spark, sf), batch, results, _now()).select("id", "status", "lat", "attempt_count", "next_retry_at")


@query("geocode_reset", f"select id, case when status = 'failed_permanent' then 'pending' else status end as status, case when status = 'failed_permanent' then 0 else attempt_count end as attempt_count, case when status = 'failed_permanent' then {_AS} else next_retry_at end as next_retry_at from star_geo")
def geocode_reset(spark, sf):
    return geocoding.reset_failed(star.geocodes(spark, sf), _now()).select("id", "status", "attempt_count", "next_retry_at")


@query("geocode_coverage", "select platform, count(*) as total, count(nullif(lat is not null and lon is not null, false)) as geocoded from pt where kind = 'city' group by platform")
def geocode_coverage(spark, sf):
    return geocoding.coverage(points(spark, sf))


# ---- reports ----
@query("runs_by_day", "select strftime(started_at, '%Y-%m-%d') as day, trigger, count(*) as total, count(nullif(status = 'success', false)) as success, count(nullif(status = 'blocked', false)) as blocked, count(nullif(status = 'failed', false)) as failed, count(nullif(status = 'running', false)) as running from star_runs group by all")
def runs_by_day(spark, sf):
    return reports.runs_by_day(star.crawl_runs(spark, sf))


def _external(spark, sf):
    """External runs: every third run, shifted by some minutes; manual and scheduled."""
    r = star.crawl_runs(spark, sf).filter("run_id % 3 = 0")
    return r.select((F.col("run_id") + 1_000_000_000).alias("external_id"), "trigger", F.when(F.col("trigger") == "schedule", "schedule").otherwise("dispatch").alias("event"), F.when(F.col("run_id") % 4 == 0, "failure").when(F.col("run_id") % 5 == 0, "cancelled").otherwise("success").alias("conclusion"), (F.col("started_at") + F.make_interval(mins=(F.col("run_id") % 40).cast("int"))).alias("created_at"))


_EXT_SQL = "ext as (select run_id + 1000000000 as external_id, trigger, case when trigger = 'schedule' then 'schedule' else 'dispatch' end as event, case when run_id % 4 = 0 then 'failure' when run_id % 5 = 0 then 'cancelled' else 'success' end as conclusion, started_at + to_minutes(run_id % 40) as created_at from star_runs where run_id % 3 = 0)"
_NEAR_SQL = """, pairs as (select external_id, run_id, status, abs(cast(floor(epoch(started_at)) as bigint) - cast(floor(epoch(created_at)) as bigint)) as delta, -cast(floor(epoch(started_at)) as bigint) as later from ext join star_runs r on r.trigger = ext.trigger and r.started_at between created_at - interval 61 second and created_at + interval 61 second),
rec as (select ext.*, m.run_id as run_id, m.delta as delta_seconds, m.status as run_status from ext left join (select external_id, run_id, status, delta, row_number() over (partition by external_id order by delta, later, run_id) as n from pairs where delta <= 60) m on m.external_id = ext.external_id and m.n = 1)
"""


@query("reconcile_runs", with_sql(_EXT_SQL + _NEAR_SQL, "select external_id, run_id, delta_seconds, run_id is not null as matched from rec"))
def reconcile_runs(spark, sf):
    return reports.reconcile(_external(spark, sf), star.crawl_runs(spark, sf), 60).select("external_id", "run_id", "delta_seconds", "matched")


@query("run_mismatches", with_sql(_EXT_SQL + _NEAR_SQL, """select 'success_without_run' as code, external_id as id from rec where conclusion = 'success' and run_id is null union all select 'failure_with_running_run', external_id from rec where conclusion <> 'success' and run_status = 'running'
union all select 'scheduled_run_without_external', run_id from star_runs r where trigger = 'schedule' and not exists (select 1 from ext where event = 'schedule' and created_at between r.started_at - interval 61 second and r.started_at + interval 61 second and abs(cast(floor(epoch(r.started_at)) as bigint) - cast(floor(epoch(created_at)) as bigint)) <= 60)"""))
def run_mismatches(spark, sf):
    return reports.mismatches(_external(spark, sf), star.crawl_runs(spark, sf), 60)


@query("day_comparison", with_sql(_EXT_SQL, """, e as (select strftime(created_at, '%Y-%m-%d') as day, count(*) as t, count(nullif(conclusion = 'success', false)) as s, count(nullif(conclusion = 'failure', false)) as f, count(nullif(conclusion = 'cancelled', false)) as c from ext where event = 'schedule' group by 1),
r as (select strftime(started_at, '%Y-%m-%d') as day, count(*) as t, count(nullif(status = 'success', false)) as s, count(nullif(status = 'blocked', false)) as b, count(nullif(status = 'failed', false)) as f, count(nullif(status = 'running', false)) as g from star_runs group by 1)
select coalesce(e.day, r.day) as day, coalesce(e.t, 0) as ext_total, coalesce(e.s, 0) as ext_success, coalesce(e.f, 0) as ext_failure, coalesce(e.c, 0) as ext_cancelled, coalesce(r.t, 0) as run_total, coalesce(r.s, 0) as run_success, coalesce(r.b, 0) as run_blocked, coalesce(r.f, 0) as run_failed, coalesce(r.g, 0) as run_running from e full join r on e.day = r.day"""))
def day_comparison(spark, sf):
    return reports.day_comparison(_external(spark, sf), star.crawl_runs(spark, sf))


@query("run_report", "select platform, count(*) as total, count(nullif(status = 'blocked', false)) as blocked, cast(sum(pages_fetched) as bigint) as pages, cast(sum(jobs_discovered) as bigint) as discovered, count(nullif(status = 'success', false)) as n_success from star_runs group by platform")
def run_report(spark, sf):
    return reports.run_report(star.crawl_runs(spark, sf)).select("platform", "total", "blocked", "pages", "discovered", F.coalesce(F.col("by_status")["success"], F.lit(0)).alias("n_success"))


@query("dedupe_report", "select platform, count(*) as hits, count(distinct job_id) as unique_jobs, greatest(count(*) - count(distinct job_id), 0) as duplicates_removed from star_hits group by platform")
def dedupe_report(spark, sf):
    return reports.dedupe_report(star.hits(spark, sf))


@query("skills_fill", "select platform, count(*) as details, count(nullif(parse_ok, false)) as parsed, count(nullif(coalesce(extracted_skills, '{}') <> '{}', false)) as with_skills, round(100.0::double * count(nullif(coalesce(extracted_skills, '{}') <> '{}', false)) / count(*), 2) as fill_percent from star_details group by platform")
def skills_fill(spark, sf):
    return reports.skills_fill(star.details(spark, sf))


@query("latest_run", "select platform, max_by(run_id, (epoch(started_at), run_id)) as run_id from star_runs group by platform")
def latest_run(spark, sf):
    return star.crawl_runs(spark, sf).groupBy("platform").agg(F.max_by("run_id", F.struct("started_at", "run_id")).alias("run_id"))


@query("stale_running", f"select platform, count(nullif(status = 'running' and started_at < {_EV} - interval 600 minute, false)) as overdue from star_runs group by platform")
def stale_running(spark, sf):
    return reports.stale_running(star.crawl_runs(spark, sf), _events_now(), 600)


@query("missing_details", "select j.platform, count(*) as missing from star_jobs j where not exists (select 1 from star_details d where d.platform = j.platform and d.job_id = j.job_id) group by j.platform")
def missing_details(spark, sf):
    return reports.missing_details(star.jobs(spark, sf), star.details(spark, sf))


@query("migrate_platform", "select 'jobs' as table_name, count(*) as n_rows from star_jobs where platform = 'xing' union all select 'details', count(*) from star_details where platform = 'xing' union all select 'hits', count(*) from star_hits h where platform = 'xing' and exists (select 1 from star_jobs j where j.platform = 'xing' and j.job_id = h.job_id)")
def migrate_platform(spark, sf):
    return keyed.table_counts(keyed.migrate({"jobs": star.jobs(spark, sf), "details": star.details(spark, sf), "hits": star.hits(spark, sf)}, "xing"))


# ---- pages and texts ----
_TEXT = "trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace({}, '<(script|style)\\b[^>]*>.*?</(?:script|style)>', ' ', 'gis'), '<!--.*?-->|<[^>]*>', ' ', 'gs'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&'), '\\s+', ' ', 'g'))"
_TAG = "nullif(" + _TEXT.format("regexp_extract(html, '<{0}\\b[^>]*>(.*?)</{0}>', 1, 'is')") + ", '')"


@query("page_fields", f"select page_id, coalesce({_TAG.format('h1')}, {_TAG.format('title')}) as title, len(regexp_extract_all(html, '(?i)<a\\s[^>]*href')) as n_links, len(regexp_extract_all(html, '(?i)<li\\b')) as n_items, length({_TEXT.format('html')}) as n_text from pages")
def page_fields(spark, sf):
    rows = extraction.dom_fields(star.table(spark, sf, "pages"))
    return rows.select("page_id", "title", F.col("n_links").cast("long").alias("n_links"), F.col("n_items").cast("long").alias("n_items"), F.length("text").cast("long").alias("n_text"))


_CARD = '(?is)<a\\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>'


@query("page_cards", f"""select page_id, i as rank, case when regexp_matches(h, '^https?://') then h when starts_with(h, '/') then 'https://pages.example.org' || h else 'https://pages.example.org/' || h end as url
from (select page_id, i, regexp_replace(hs[i], '[?#].*$', '') as h, hs[i] as raw from (select page_id, regexp_extract_all(html, '{_CARD}', 1) as hs from pages) q, unnest(generate_series(1, len(hs))) as t(i)) q where raw <> ''""")
def page_cards(spark, sf):
    return extraction.list_cards(star.table(spark, sf, "pages"), "https://pages.example.org").select("page_id", F.col("rank").cast("long").alias("rank"), "url")


DICTIONARY = taxonomy.flatten({
    "articles": [{"canonical": "the", "aliases": ["the"]}, {"canonical": "les", "aliases": {"fr": ["les"], "es": ["los"]}}],
    "verbs": [{"canonical": "is", "aliases": ["was"]}, {"canonical": "sind", "aliases": ["sind", "ist"]}],
    "phrases": [{"canonical": "All rights reserved"}, {"canonical": "Licensed", "aliases": ["licensed under"]}],
})


def _skill_sql() -> str:
    groups: dict = {}
    for g, _, c, _, a in DICTIONARY:
        groups.setdefault(g, {}).setdefault(c, []).append(a)
    parts = []
    for g, names in groups.items():
        tests = ", ".join("case when " + " or ".join(f"regexp_matches(t, '(?:^|[^A-Za-z0-9]){a}(?:$|[^A-Za-z0-9])')" for a in own) + f" then '{c}' end" for c, own in names.items())
        parts.append(f"case when concat_ws(',', {tests}) <> '' then '{g}:' || concat_ws(',', {tests}) end")
    return f"select doc_id, concat_ws('|', {', '.join(parts)}) as skills from (select doc_id, regexp_replace(lower(coalesce(text, '')), '\\s+', ' ', 'g') as t from documents) q"


@query("grouped_skills", _skill_sql())
def grouped_skills(spark, sf):
    rows = taxonomy.grouped_skills(star.table(spark, sf, "documents").select("doc_id", "text"), DICTIONARY)
    shown = F.array_join(F.transform(F.map_entries("skills"), lambda e: F.concat(e["key"], F.lit(":"), F.array_join(e["value"], ","))), "|")
    return rows.select("doc_id", shown.alias("skills"))


@query("search_grid", "select 'xing__' || substr(trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g'), '_'), 1, 40) || '__' || lower(r_name) as name from (select lower(p_name) as l, arg_min(p_name, p_partkey) as p_name from part group by 1) q, (select translate(lower(r_name), ' ', '_') as r_name from region) r")
def search_grid(spark, sf):
    words = star.table(spark, sf, "part").select(F.lit("xing").alias("platform"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("keyword"))
    where = star.table(spark, sf, "region").select(F.lit("xing").alias("platform"), F.col("r_name").alias("location"))
    return taxonomy.search_terms(words, where).select("name")


@query("posting_ids", """select page_id, nullif(coalesce(nullif(regexp_extract(url, '/jobs/view/(?:[^/?#]*-)?([0-9]+)', 1), ''), nullif(regexp_extract(url, '[?&]currentJobId=([0-9]+)', 1), ''), nullif(regexp_extract(url, '/jobs/[^?#]*?-([0-9]+)(?:[/?#.]|$)', 1), '')), '') as posting_id, 'ext_' || substr(sha1(regexp_replace(url, '[?#].*$', '')), 1, 20) as external_id
from (select page_id, case page_id % 4 when 0 then url || '/jobs/view/some-title-' || page_id || '/?x=1' when 1 then url || '?currentJobId=' || page_id when 2 then url || '/jobs/berlin-title-' || page_id else url end as url from pages) q""")
def posting_ids(spark, sf):
    n, u, s = F.col("page_id") % 4, F.col("url"), F.col("page_id").cast("string")
    rows = star.table(spark, sf, "pages").select("page_id", F.when(n == 0, F.concat(u, F.lit("/jobs/view/some-title-"), s, F.lit("/?x=1"))).when(n == 1, F.concat(u, F.lit("?currentJobId="), s)).when(n == 2, F.concat(u, F.lit("/jobs/berlin-title-"), s)).otherwise(u).alias("url"))
    return rows.select("page_id", urls.posting_id(F.col("url")).alias("posting_id"), urls.external_id(urls.canonical_url(F.col("url"), "https://x.example.org")).alias("external_id"))


# ---- searches and intake ----
@query("intake_scalars", """select platform, job_id, coalesce(contains(lower(work_type), 'homeoffice') or contains(lower(work_type), 'home office'), false) as homeoffice_possible, coalesce(contains(lower(work_type), 'vollzeit') or contains(lower(work_type), 'full time'), false) as full_time,
trim(regexp_replace(regexp_replace(lower(trim(coalesce(job_title, ''))), '[/\\s]+|[^0-9a-zÀ-ɏ-]', '-', 'g'), '-+', '-', 'g'), '-') as title_slug, case when last_error is not null then last_error when k % 3 = 0 then 'blocked' end as error
from (select *, cast(job_id as bigint) as k from star_details) q""")  # fmt: skip
def intake_scalars(spark, sf):
    flags = intake.work_flags(F.col("work_type"))
    return star.details(spark, sf).select("platform", "job_id", flags["homeoffice_possible"].alias("homeoffice_possible"), flags["full_time"].alias("full_time"), intake.url_slug(F.col("job_title")).alias("title_slug"), intake.detail_error(F.col("last_error"), F.col("job_id").cast("long") % 3 == 0).alias("error"))


@query("search_age_days", f"select platform, case when max(finished_at) is null then null when max(case when status = 'success' then finished_at end) >= {_EV} - interval 36 hour then 1 else 7 end as age_days from star_runs group by platform")
def search_age_days(spark, sf):
    return searches.age_days(star.crawl_runs(spark, sf), _events_now())


@query("working_student_trend", f"""
select cast(b as timestamp) as bucket_start, cast(coalesce(n, 0) as bigint) as jobs_unique from generate_series(date_trunc('month', {_AS} - interval 11 month), {_AS}, interval 1 month) as s(b)
left join (select date_trunc('month', event_ts) as m, count(distinct platform || job_id) as n from cls where is_working_student and is_active and rnk >= 2 group by 1) q on q.m = b""")
def working_student_trend(spark, sf):
    return analytics.monthly_trend(role_plan.role_jobs(role_plan.target_jobs(base(spark, sf))), _now())


@query("working_student_skills", f"select w as days_window, lower(trim(s)) as skill, count(distinct k.platform || k.job_id) as jobs_unique from skill k join cls using (platform, job_id), (values (30), (90)) as t(w) where is_working_student and is_active and rnk >= 2 and trim(s) <> '' and k.event_ts >= {_AS} - to_days(w) group by all")
def working_student_skills(spark, sf):
    return analytics.top_skills(role_plan.role_jobs(role_plan.target_jobs(base(spark, sf))), _now())


@query("geocode_queue", f"select id from star_requests where status in ('pending', 'error', 'no_match') and next_retry_at <= {_AS} and attempt_count < 6 order by next_retry_at, id limit 100")
def geocode_queue(spark, sf):
    return geocoding.queue(star.geocode_requests(spark, sf), _now(), 100).select("id")


@query("constraint_checks", """select * from (with known as (select search_run_id, platform, job_id from star_hits), odd as (select status from star_searches union all select status from star_runs)
select name, n as violations, n = 0 as ok from (
  select 'duplicate_hits' as name, (select count(*) from (select 1 from known group by search_run_id, platform, job_id having count(*) > 1) q) as n
  union all select 'details_without_job', (select count(*) from star_details d where not exists (select 1 from star_jobs j where j.platform = d.platform and j.job_id = d.job_id and j.is_active))
  union all select 'unknown_status', (select count(*) from odd where status not in ('success', 'failed', 'running'))
  union all select 'jobs_without_activity', (select count(*) from star_jobs where is_active is null)) q) q""")
def constraint_checks(spark, sf):
    jobs_, details_ = star.jobs(spark, sf), star.details(spark, sf)
    statuses = star.search_runs(spark, sf).select("status").unionByName(star.crawl_runs(spark, sf).select("status"))
    key = ["platform", "job_id"]
    both = jobs_.select(*key, "is_active", F.lit(True).alias("job")).join(details_.select(*key, F.lit(True).alias("detail")), key, "full_outer")
    odd = ~F.col("status").isin("success", "failed", "running")
    parts = [
        reports.table_checks(star.hits(spark, sf), {}, ("duplicate_hits", ["search_run_id", *key])), reports.table_checks(statuses, {"unknown_status": odd}),
        reports.table_checks(both, {"details_without_job": F.col("detail") & ~F.coalesce("is_active", F.lit(False)), "jobs_without_activity": F.col("job") & F.col("is_active").isNull()}),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("step_outcomes", "select platform, count(*) filter (k = 7) as blocked, count(*) filter (k = 3) as skipped_backoff from (select platform, cast(json_extract_string(stats, '$.k') as integer) as k from star_runs) q group by platform")
def step_outcomes(spark, sf):
    k = F.get_json_object("stats", "$.k")
    said = F.when(k == "7", "blocked").when(k == "3", "skipped_backoff").otherwise("success")
    runs = star.crawl_runs(spark, sf).withColumn("stats", F.to_json(F.struct(F.struct(said.alias("status")).alias("details"))))
    return searches.step_outcomes(runs)


@query("page_budget", """select * from (with f as (select search_run_id, cast(cast(job_id as bigint) % 60 as varchar) as job_id, page_start, seq from star_hits),
n as (select *, row_number() over (partition by search_run_id, job_id order by seq) = 1 as fresh from f),
p as (select search_run_id, page_start, max(fresh) as any_new from n group by all),
i as (select *, sum(cast(any_new as integer)) over (partition by search_run_id order by page_start) as island from p),
t as (select *, sum(cast(not any_new as integer)) over (partition by search_run_id, island order by page_start) as streak from i),
stop as (select search_run_id, min(page_start) as until from t where streak >= 3 group by all)
select search_run_id, job_id from (select n.search_run_id, job_id, row_number() over (partition by n.search_run_id order by seq) as k from n left join stop using (search_run_id) where fresh and (until is null or page_start < until)) q where k <= 50) q""")
def page_budget(spark, sf):
    found = star.hits(spark, sf).withColumn("job_id", (F.col("job_id").cast("long") % 60).cast("string"))
    return searches.page_budget(found, "search_run_id", "page_start", "seq", 50, 3).select("search_run_id", "job_id")


@query("repair_stale_searches", f"""select s.search_run_id, case when x then 'failed' else s.status end as status, case when x then {_EV} else s.finished_at end as finished_at, case when x then coalesce(s.error, 'stale') else s.error end as error
from (select s.*, coalesce(s.status = 'running' and r.status = 'running' and r.started_at < {_EV} - interval 600 minute, false) as x from star_searches s left join star_runs r on r.run_id = s.crawl_run_id) s""")
def repair_stale_searches(spark, sf):
    return lifecycle.repair_stale_runs(star.crawl_runs(spark, sf), star.search_runs(spark, sf), _events_now(), 600)[1].select("search_run_id", "status", "finished_at", "error")


_FINAL_SQL = f"""select * from (with stale as (select run_id from star_runs where status = 'running' and started_at < {_EV} - interval 600 minute),
log as (select cast(job_id as bigint) % 997 as run_id, platform, job_id, job_title || ' again' as job_title, parse_ok, last_error from star_details),
imp as (select run_id, count(*) as n, count(*) filter (last_error = 'blocked') as b from log semi join stale using (run_id) group by run_id)
"""


def _finalized(spark, sf):
    details_ = star.details(spark, sf)
    log = details_.select((F.col("job_id").cast("long") % 997).alias("crawl_run_id"), "platform", "job_id", F.concat("job_title", F.lit(" again")).alias("job_title"), "parse_ok", "last_error", F.col("job_id").cast("long").alias("seq"))
    return lifecycle.finalize_from_log(star.crawl_runs(spark, sf), star.search_runs(spark, sf), details_, log, _events_now(), 600)


@query("finalized_runs", _FINAL_SQL + f"""select r.run_id, case when s.run_id is null then r.status when n is null then 'failed' when b / n > 0.1 then 'blocked' else 'success' end as status, case when s.run_id is null then r.finished_at else {_EV} end as finished_at,
case when s.run_id is not null then n end as upserted, case when s.run_id is null then r.error when n is null then 'stale, without a completed detail log' end as error from star_runs r left join stale s using (run_id) left join imp using (run_id)) q""")
def finalized_runs(spark, sf):
    return _finalized(spark, sf)[0].select("run_id", "status", "finished_at", F.get_json_object("stats", "$.details.upserted").cast("long").alias("upserted"), "error")


@query("finalized_details", _FINAL_SQL + "select d.platform, d.job_id, coalesce(l.job_title, d.job_title) as job_title from star_details d left join (select * from log semi join stale using (run_id)) l on l.platform = d.platform and l.job_id = d.job_id) q")
def finalized_details(spark, sf):
    return _finalized(spark, sf)[2].select("platform", "job_id", "job_title")


@query("migrated_runs", "select distinct r.run_id, r.status from star_runs r join star_searches s on s.crawl_run_id = r.run_id join star_definitions d on d.search_definition_id = s.search_definition_id where d.source = 'xing'")
def migrated_runs(spark, sf):
    return keyed.migrate_runs(star.crawl_runs(spark, sf), star.search_runs(spark, sf), star.definitions(spark, sf), "xing")["runs"].select("run_id", "status")


@query("run_hits", "select crawl_run_id, count(*) as hits, count(distinct job_id) as unique_jobs, greatest(count(*) - count(distinct job_id), 0) as duplicates_removed from star_hits join star_searches using (search_run_id) group by crawl_run_id")
def run_hits(spark, sf):
    return reports.run_hits(star.hits(spark, sf), star.search_runs(spark, sf))


@query("inconsistent_searches", "select search_run_id, crawl_run_id from star_searches s where status = 'running' and exists (select 1 from star_runs r where r.run_id = s.crawl_run_id and r.status <> 'running')")
def inconsistent_searches(spark, sf):
    return reports.inconsistent_searches(star.crawl_runs(spark, sf), star.search_runs(spark, sf)).select("search_run_id", "crawl_run_id")


@query("no_results", """select page_id, page_id % 3 = 0 as empty, case when page_id % 3 = 0 then 'data & ' || page_id end as keywords, case when page_id % 3 = 0 then 'Nothing for data & ' || page_id end as title_text, case when page_id % 3 = 0 and page_id % 2 = 0 then 'Try other words' end as subheading from pages""")
def no_results(spark, sf):
    k = F.col("page_id")
    hint = F.when(k % 2 == 0, '<p class="no-results__subheading">Try <strong>other</strong> words</p>').otherwise("")
    box = F.concat(F.lit('<section class="core no-results"><h1>Nothing for <span class="no-results__main-title-keywords">data &amp; '), k.cast("string"), F.lit("</span></h1>"), hint, F.lit("</section>"))
    found = extraction.no_results(F.concat("html", F.when(k % 3 == 0, box).otherwise('<section class="results">no-results</section>')))
    return star.table(spark, sf, "pages").select("page_id", found.alias("f")).select("page_id", F.col("f").isNotNull().alias("empty"), "f.keywords", "f.title_text", "f.subheading")


# Marked pages: even ones in one platform's layout, odd ones in the other's.
_DETAIL_SQL = f"""select page_id, case when page_id % 2 = 0 then 'linkedin' else 'stepstone' end as platform, title as job_title,
case when page_id % 2 = 1 then 'Haus & Co ' || page_id when page_id % 4 = 0 then 'Firm ' || page_id else 'Other ' || page_id end as company_name, case when page_id % 2 = 0 then 'Berlin, Germany' else 'Köln' end as job_location,
case when page_id % 2 = 0 then '3 days ago' else 'vor 1 Tag' end as posted_time_ago, case when page_id % 2 = 0 then 'About ' || page_id || ' Build it' else 'The role ' || page_id || ' Build rules' end as job_description,
case when page_id % 2 = 1 then 'Feste Anstellung' end as contract_type, case when page_id % 2 = 1 and page_id % 3 = 0 then 'Vollzeit' end as work_type,
not shut and status is not null and status <> 500 and title is not null as parse_ok, case when shut then 'blocked' when status is null then 'request_failed' when status = 500 then 'http_500' when title is null then 'missing_job_title' end as last_error
from (select *, coalesce(status = 403, false) or contains(low, 'captcha') or contains(low, 'verify you are a human') or case when page_id % 2 = 0 then contains(low, 'security verification') or contains(low, 'unusual activity') or contains(url, '/checkpoint/')
  else contains(low, 'access denied') or contains(low, 'errors.edgesuite.net') or contains(low, 'temporarily blocked') end as shut from (select page_id, url, lower(html) as low, case when page_id % 2 = 1 then {_TAG.format('h1')} when page_id % 10 <> 4 then 'Data & AI ' || page_id end as title, case page_id % 7 when 0 then 403 when 1 then 500 when 2 then null else 200 end as status
  from (select page_id, case when page_id % 11 = 0 then url || '/checkpoint/x' else url end as url, case when page_id % 13 = 0 then html || ' Unusual ACTIVITY' when page_id % 13 = 1 then html || ' Temporarily blocked' else html end as html from pages) p) q) q"""


@query("detail_pages", _DETAIL_SQL)
def detail_pages(spark, sf):
    k, s = F.col("page_id"), F.col("page_id").cast("string")
    lit = F.lit
    company = F.when(k % 4 == 0, F.concat(lit('<a class="x topcard__org-name-link" href="/y">Firm <b>'), s, lit("</b></a>"))).otherwise(F.concat(lit('<span class="topcard__flavor"><a href="https://x.org/company/z?q=1">Other '), s, lit("</a></span>")))
    title = F.when(k % 10 != 4, F.concat(lit('<h1 class="topcard__title">second</h1><h2 class="top-card-layout__title big">Data &amp; AI '), s, lit("</h2>"))).otherwise("")
    even = F.concat("html", title, company, lit('<div class="topcard__flavor-row"><span class="topcard__flavor topcard__flavor--bullet"> Berlin,\n Germany </span></div><span class="posted-time-ago__text">3 days ago</span>'), lit('<div class="description__text description__text--rich"><div class="show-more-less-html__markup"><p>About '), s, lit("</p><ul><li>Build it</li></ul></div></div>"))
    work = F.when(k % 3 == 0, '<li><span data-at="metadata-work-type">Vollzeit</span></li>').otherwise("")
    odd = F.concat("html", lit('<li><span data-at="metadata-company-name"><style>.x{color:red}</style>Haus &amp; Co '), s, lit('</span></li><span data-at="metadata-location">Köln</span><span data-at="metadata-online-date">Erschienen: vor 1 Tag</span><span data-at="metadata-contract-type">Feste Anstellung</span>'), work,
                   lit('<div data-at="job-ad-content"><span class="job-ad-display-nfizss"><p>The role '), s, lit('</p></span><span class="job-ad-display-nfizss">See salary</span><span class="a job-ad-display-nfizss">Build rules</span></div><div data-at="job-ad-salary"><span class="job-ad-display-nfizss">See  salary</span></div>'))
    status = F.when(k % 7 == 0, 403).when(k % 7 == 1, 500).when(k % 7 != 2, 200)
    more = F.when(k % 13 == 0, " Unusual ACTIVITY").when(k % 13 == 1, " Temporarily blocked").otherwise("")
    pages = star.table(spark, sf, "pages").withColumns({"status": status, "html": F.concat("html", more), "url": F.when(k % 11 == 0, F.concat("url", lit("/checkpoint/x"))).otherwise(F.col("url"))})
    of = lambda n, name, html: postings.detail_fields(pages.filter(k % 2 == n).withColumn("html", html), name).withColumns({"platform": lit(name), "shut": extraction.is_blocked(F.col("html"), F.col("status"), F.col("url"), name)})
    rows = of(0, "linkedin", even).unionByName(of(1, "stepstone", odd))
    ok, error = postings.detail_outcome(F.col("job_title"), F.col("status"), F.col("shut"))
    return rows.select("page_id", "platform", *postings.DETAIL_FIELDS["linkedin"], ok.alias("parse_ok"), error.alias("last_error"))


@query("posting_cards", """select page_id, cast(0 as bigint) as rank, cast(page_id as varchar) as job_id, 'https://x.example.org/jobs/view/data-eng-' || page_id as job_url, 'Data & ' || page_id as title, 'Acme' as company, 'Berlin' as location, '2026-02-01' as posted_at from pages
union all select page_id, 2, page_id || '9', 'https://y.example.org/z', 'Intern', 'Beta ' || page_id, null, '2 days ago' from pages""")
def posting_cards(spark, sf):
    s, lit = F.col("page_id").cast("string"), F.lit
    first = F.concat(lit('<li><a class="base-card__full-link x" href="/jobs/view/data-eng-'), s, lit('?x=1#y">job</a><h3 class="base-search-card__title"> Data &amp;\n '), s, lit('</h3><h4 class="base-search-card__subtitle">Acme</h4><span class="job-search-card__location">Berlin</span><time datetime="2026-02-01">1 day ago</time></li>'))
    last = F.concat(lit('<li data-entity-urn="urn:li:jobPosting:'), s, lit('9"><a href="https://y.example.org/z?k=1" class="base-card__full-link">job</a><h3 class="base-search-card__title">Intern</h3><a class="hidden-nested-link">Beta '), s, lit("</a><time>2 days ago</time></li>"))
    skipped = lit('<li><a class="base-card__full-link" href="/about">job</a></li>')
    pages = star.table(spark, sf, "pages").withColumn("html", F.concat("html", lit('<ul class="jobs-search__results-list">'), first, skipped, last, lit("</ul>")))
    return postings.posting_cards(pages, "https://x.example.org").withColumn("rank", F.col("rank").cast("long"))


@query("embedded_postings", """select page_id, case when page_id % 4 < 2 then 'Dev ' || page_id end as ld_title, case when page_id % 4 < 2 then 'Acme' end as ld_company, case page_id % 4 when 0 then 'Bonn, NRW, DE' when 1 then 'Ulm' end as ld_location, case when page_id % 4 = 0 then 'First & second' when page_id % 4 = 1 then 'bare text' end as ld_description,
case when page_id % 3 < 2 then 'State ' || page_id end as st_title, case page_id % 3 when 0 then 'Referred' when 1 then 'Own name' end as st_company, case page_id % 3 when 0 then 'Bremen, Germany' when 1 then 'Kiel, SH, DE' end as st_location, case page_id % 3 when 0 then 'Full-time' end as st_employment,
case page_id % 3 when 0 then 'Hybrid' when 1 then 'On-site' end as st_work_model, case page_id % 3 when 0 then false when 1 then true end as st_external from pages""")
def embedded_postings(spark, sf):
    k, s, lit = F.col("page_id"), F.col("page_id").cast("string"), F.lit
    ld = lambda body: F.concat(lit('<script type="application/ld+json">'), body, lit("</script>"))
    many = ld(F.concat(lit('[{"@type":"Thing"},{"@type":"JobPosting","title":"Dev '), s, lit('","hiringOrganization":{"name":"Acme"},"jobLocation":{"address":{"addressLocality":"Bonn","addressRegion":"NRW","addressCountry":"DE"}},"description":"&lt;p&gt;First &amp;amp;&lt;/p&gt;&lt;p&gt;second&lt;/p&gt;"}]')))
    one = ld(F.concat(lit('{"@type":"JobPosting","title":"Dev '), s, lit('","hiringOrganization":{"name":" Acme "},"jobLocation":[{"x":1},{"address":{"addressLocality":"Ulm"}}],"description":"bare text"}')))
    html = F.when(k % 4 == 0, many).when(k % 4 == 1, F.concat(ld(lit("{broken")), one)).when(k % 4 == 2, ld(lit('[{"@type":"JobPosting"')))
    state = lambda body: F.concat(lit('<script id="runtime-config">window.crate={"a":undefined,"serverData":{"APOLLO_STATE":'), body, lit("}};</script>"))
    by_ref = state(F.concat(lit('{"VisibleJob:0":{"title":"other"},"ROOT_QUERY":{"__typename":"Query","job":{"__ref":"VisibleJob:1"}},"C:1":{"companyName":"Referred"},"E:1":{"localizationValue":"Full-time"},"VisibleJob:1":{"title":"State '), s, lit('","companyInfo":{"companyNameOverride":undefined,"company":{"__ref":"C:1"}},"employmentType":{"__ref":"E:1"},"location":{"city":"Bremen","country":{"localizationValue":"Germany"}},"remoteOptions":["PARTLY_HYBRID","REMOTE"]}}')))
    by_key = state(F.concat(lit('{"VisibleJob:7":{"title":"State '), s, lit('","companyInfo":{"companyNameOverride":"Own name"},"location":{"city":"Kiel","region":"SH","country":{"countryCode":"DE"}},"remoteOptions":["NON_REMOTE"],"redirectsToThirdPartyUrl":true}}')))
    html = F.concat("html", F.coalesce(html, lit("")), F.when(k % 3 == 0, by_ref).when(k % 3 == 1, by_key).otherwise(""))
    rows = postings.state_posting(star.table(spark, sf, "pages").withColumn("html", html)).withColumn("ld", postings.jsonld_posting(F.col("html")))
    return rows.select("page_id", F.col("ld.title").alias("ld_title"), F.col("ld.company_name").alias("ld_company"), F.col("ld.job_location").alias("ld_location"), F.col("ld.description").alias("ld_description"), F.col("state.title").alias("st_title"), F.col("state.company_name").alias("st_company"),
                       F.col("state.job_location").alias("st_location"), F.col("state.employment_type").alias("st_employment"), F.col("state.work_model").alias("st_work_model"), F.col("state.is_external").alias("st_external"))


@query("recompute_skills", f"""select * from (with due as (select platform, job_id from star_details where parse_ok and trim(job_description) <> '' and (extracted_skills is null or coalesce(extracted_skills_version, 0) < 2) order by scraped_at desc nulls last, platform, job_id limit 200),
hit as (select platform, job_id, concat_ws(',', case when regexp_matches(t, '(?:^|[^a-z0-9])(?:spark|python)(?:$|[^a-z0-9])') then '"Engine"' end, case when regexp_matches(t, '(?:^|[^a-z0-9])sql(?:$|[^a-z0-9])') then '"SQL"' end) as tools,
  case when regexp_matches(t, '(?:^|[^a-z0-9])(?:data|daten)(?:$|[^a-z0-9])') then '"Data"' else '' end as fields from (select d.platform, d.job_id, regexp_replace(lower(job_description), '\\s+', ' ', 'g') as t from star_details d semi join due on due.platform = d.platform and due.job_id = d.job_id) q)
select d.platform, d.job_id, case when hit.job_id is null then d.extracted_skills else '{{' || concat_ws(',', case when tools <> '' then '"tools":[' || tools || ']' end, case when fields <> '' then '"fields":[' || fields || ']' end) || '}}' end as extracted_skills,
case when hit.job_id is null then d.extracted_skills_version else 2 end as extracted_skills_version, case when hit.job_id is not null then {_AS} end as extracted_skills_at from star_details d left join hit on hit.platform = d.platform and hit.job_id = d.job_id) q""")
def recompute_skills(spark, sf):
    words = taxonomy.flatten({"tools": [{"canonical": "Engine", "aliases": ["spark", "python"]}, {"canonical": "SQL", "aliases": []}], "fields": [{"canonical": "Data", "aliases": {"de": ["daten"]}}]})
    words = [w for w in words if w[4] != "engine"]
    details_ = star.details(spark, sf).withColumn("extracted_skills_at", F.lit(None).cast("timestamp"))
    out = taxonomy.recompute_skills(details_, lifecycle.skill_queue(details_, 2, 200), words, 2, _now(), ["platform", "job_id"])
    return out.select("platform", "job_id", "extracted_skills", "extracted_skills_version", "extracted_skills_at")


from postlake import queries_pages, queries_state  # noqa: E402, F401  they register their own
