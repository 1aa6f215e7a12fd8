"""Registered queries over logs, stored tables and states, and over the smaller operators of pages and runs; the same in SQL with plain values."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake.functions import cells, intake, urls
from postlake.operators import extraction, geocoding, keyed, lifecycle, reports, searches, taxonomy
from postlake.plans import daily, places, serving
from postlake.plans.unified import unify
from postlake.queries import query
from postlake.sources import logs, star, versions
from postlake.sources.shared import shared_folder
from postlake.streaming.ingest import apply_log, import_stream

lit = F.lit


def _now():
    return F.lit(star.AS_OF).cast("timestamp")


# logs


#: Lines of a log file, some 750 MB before compression: one task writes or reads it.
FILE_LINES = 2_500_000


def _written_log(spark, sf, files=None):
    """Every line item as a line of a crawl log: a discovered job, a detail (one in 13 without a job), a page, another type, a line that is cut off, a blank one."""
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    kind = F.when(k % 5 < 2, "job_discovered").when(k % 5 == 2, "job_detail").when(k % 5 == 3, "page_fetch").otherwise("else")
    at = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    record = F.to_json(F.struct(
        kind.alias("record_type"), star._pick(star.PLATFORMS, F.col("l_orderkey")).alias("source"), F.when((k % 5 == 2) & (k % 13 == 0), "").otherwise(F.col("l_orderkey").cast("string")).alias("job_id"), F.col("l_suppkey").cast("string").alias("search_run_id"),
        F.concat(lit("https://n.example.org/"), F.col("l_orderkey").cast("string"), lit("/"), F.col("l_linenumber").cast("string")).alias("job_url"), F.col("l_linenumber").alias("rank"), F.col("l_quantity").cast("int").alias("page_start"), at.alias("scraped_at"),
        (k % 3 == 0).alias("parse_ok"), F.when(k % 3 == 1, "http_410").alias("last_error"), F.concat(lit("Title "), k.cast("string")).alias("job_title"),
    ))
    line = F.when(k % 97 == 0, F.substring(record, 1, 20)).when(k % 89 == 0, "").otherwise(record)
    path = shared_folder(spark, "log")
    rows = star.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity")
    files = max(files or 4, -(-rows.count() // FILE_LINES))
    # numbers are shuffled and sorted, lines are made behind that; a job's lines lie in one file
    rows = rows.repartitionByRange(files, "l_orderkey").sortWithinPartitions("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate")
    rows.select(line.alias("line")).write.option("compression", "gzip").text(path)
    return path


_LINES = f"""lines as (select *, case when k % 5 < 2 then 'job_discovered' when k % 5 = 2 then 'job_detail' when k % 5 = 3 then 'page_fetch' else 'else' end as kind from (select l_orderkey * 8 + l_linenumber as k, ((l_orderkey * 8 + l_linenumber) * 100000 + l_suppkey) * 20000 + date_diff('day', date '1990-01-01', l_shipdate) as kk, l_orderkey as o, l_linenumber as n, l_suppkey, l_shipdate, l_quantity, {star._sql_pick(star.PLATFORMS, "l_orderkey")} as platform from lineitem) q),
good as (select * from lines where k % 97 <> 0 and k % 89 <> 0)"""


@query("log_counts", f"""select * from (with {_LINES} select (select count(*) from good) as kept, (select count(*) from lines where k % 97 = 0) as skipped, (select count(*) from good where kind = 'job_detail' and k % 13 = 0) as nameless,
(select count(*) from good where kind = 'page_fetch') as pages, (select count(*) from good where kind = 'job_discovered') as found, (select count(*) from good where kind = 'job_detail' and k % 13 <> 0) as details) q""")
def log_counts(spark, sf):
    log, seen = logs.counted_log(spark, _written_log(spark, sf))
    stored = shared_folder(spark, "records")
    log.write.parquet(stored)  # the observation is filled on the way
    pages, found, details = logs.split(spark.read.parquet(stored))
    of = lambda rows, name: rows.agg(F.count("*").alias(name)).withColumn("_one", lit(1))
    counts = of(pages, "pages").join(of(found, "found"), "_one").join(of(details, "details"), "_one").drop("_one")
    return counts.select(*[lit(seen.get[n]).cast("long").alias(n) for n in ("kept", "skipped", "nameless")], "pages", "found", "details")


@query("log_recovery", f"""select * from (with {_LINES} select (select count(*) from good) as kept, (select count(*) from lines where k % 97 = 0) as skipped) q""")
def log_recovery(spark, sf):
    return logs.recover(spark, _written_log(spark, sf))


@query("merged_log", f"""select * from (with {_LINES} select cast(part as integer) as part, kind as record_type, count(*) as n from good, unnest([0, 1]) as t(part) group by all) q""")
def merged_log(spark, sf):
    path = _written_log(spark, sf)
    return logs.merge(spark, [path, path]).groupBy(F.col("seq.part").alias("part"), "record_type").agg(F.count("*").alias("n"))


def _start(spark, sf):
    """A lake with three in four of the jobs and their details, and no hits."""
    lake = versions.Lake(spark, shared_folder(spark, "lake"))
    jobs = star.jobs(spark, sf).filter(F.col("job_id").cast("long") % 4 != 0)
    details = star.details(spark, sf).select("platform", "job_id", "scraped_at", "parse_ok", "last_error", "job_title")
    hits = spark.createDataFrame([], "search_run_id string, platform string, job_id string, rank int, page_start int, scraped_at timestamp")
    with lake.change() as now:
        now.put("jobs", jobs, keys=["platform", "job_id"], buckets=16)
        now.put("details", details, keys=["platform", "job_id"], buckets=16)
        now.put("hits", hits, keys=["search_run_id", "platform", "job_id"], buckets=16)
    return lake


_APPLIED = f"""{_LINES},
found as (select *, 'https://n.example.org/' || o || '/' || n as url from good where kind = 'job_discovered'), det as (select *, case when k % 3 = 1 then 'gone' when k % 3 = 0 then 'back' end as what from good where kind = 'job_detail' and k % 13 <> 0),
lastf as (select o, platform, arg_max(url, kk) as url, arg_max(l_shipdate, kk) as seen, arg_min(l_shipdate, kk) as first from found group by all),
j1 as (select coalesce(j.k, l.o) as o, coalesce(j.platform, l.platform) as platform, coalesce(l.url, j.job_url) as job_url, coalesce(l.seen, j.last_seen_at) as last_seen_at, case when l.o is not null then true else j.is_active end as is_active,
  case when l.o is null then j.expired_at end as expired_at, case when l.o is null then j.expire_reason end as expire_reason from (select * from star_jobs where k % 4 <> 0) j full join lastf l on l.o = j.k),
lb as (select o, max(case when what = 'back' then kk end) as reset, arg_max(what, kk) as last from det where what is not null group by o),
g as (select d.o, arg_min(d.l_shipdate, d.kk) as gone_at from det d join lb using (o) where what = 'gone' and (reset is null or kk > reset) group by d.o),
applied as (select platform, cast(o as varchar) as job_id, job_url, last_seen_at, case when last is not null then last = 'back' else is_active end as is_active, case when last = 'gone' then coalesce(case when reset is null then expired_at end, gone_at) when last is null then expired_at end as expired_at,
  case when last = 'gone' then coalesce(case when reset is null then expire_reason end, 'http_410') when last is null then expire_reason end as expire_reason from j1 left join lb using (o) left join g using (o))"""
_JOB = ("platform", "job_id", "job_url", "last_seen_at", "is_active", "expired_at", "expire_reason")


@query("imported_log", f"select * from (with {_APPLIED} select * from applied) q")
def imported_log(spark, sf):
    lake = _start(spark, sf)
    with lake.change() as now:
        apply_log(now, logs.read_log(spark, _written_log(spark, sf)))
    return lake.read("jobs").select(*_JOB)


@query("streamed_log", f"select * from (with {_APPLIED} select * from applied) q")
def streamed_log(spark, sf):
    lake, path = _start(spark, sf), _written_log(spark, sf, files=3)
    import_stream(lake, path, shared_folder(spark, "progress"), max_files=100).awaitTermination()
    return lake.read("jobs").select(*_JOB)


@query("streamed_hits", f"select * from (with {_LINES} select cast(l_suppkey as varchar) as search_run_id, platform, cast(o as varchar) as job_id, cast(arg_min(n, kk) as integer) as rank, cast(arg_min(l_quantity, kk) as integer) as page_start from good where kind = 'job_discovered' group by 1, 2, 3) q")
def streamed_hits(spark, sf):
    lake, path = _start(spark, sf), _written_log(spark, sf, files=3)
    import_stream(lake, path, shared_folder(spark, "progress"), max_files=100).awaitTermination()
    return lake.read("hits").select("search_run_id", "platform", "job_id", "rank", "page_start")


@query("bucketed_upsert", """select c_custkey as id, case when n is not null then n || ' orders' else c_mktsegment end as label, c_acctbal + coalesce(t, 0) as balance from customer left join (select o_custkey, count(*) as n, cast(sum(cast(o_totalprice as decimal(18, 2))) as double) as t from orders where o_orderpriority = '1-URGENT' group by o_custkey) o on o_custkey = c_custkey
union all select -r_regionkey - 1, r_name, 0 from region""")
def bucketed_upsert(spark, sf):
    lake = versions.Lake(spark, shared_folder(spark, "lake"))
    with lake.change() as now:
        now.put("customers", star.table(spark, sf, "customer").select(F.col("c_custkey").cast("long").alias("id"), F.col("c_mktsegment").alias("label"), F.col("c_acctbal").alias("balance")), keys=["id"], buckets=32)
    urgent = star.table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").groupBy(F.col("o_custkey").cast("long").alias("id")).agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("t"))
    with lake.change() as now:
        known = now.read("customers").select("id")
        now.rewrite("customers", urgent, lambda rows: keyed.upsert(rows, urgent.join(known, "id", "left_semi"), ["id"], {"label": F.concat(F.col("u.n").cast("string"), lit(" orders")), "balance": F.col("t.balance") + F.col("u.t")}))
    with lake.change() as now:
        now.upsert("customers", star.table(spark, sf, "region").select((-F.col("r_regionkey") - 1).cast("long").alias("id"), F.col("r_name").alias("label"), lit(0.0).alias("balance")))
    return lake.read("customers")


@query("refreshed_models", "select n_name, count(*) as customers, (select count(*) from orders) as orders from customer join nation on n_nationkey = c_nationkey group by n_name")
def refreshed_models(spark, sf):
    lake = versions.Lake(spark, shared_folder(spark, "models"))
    steps = [
        ("customers_by_nation", lambda t: t["customer"].groupBy("c_nationkey").agg(F.count("*").alias("customers")), ["customer"], ["c_nationkey"]),
        ("order_count", lambda t: t["orders"].agg(F.count("*").alias("orders")), ["orders"], []),
        ("named", lambda t: t["customers_by_nation"].join(t["nation"].select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey").join(t["order_count"].withColumn("_one", lit(1)), lit(1) == F.col("_one")).select("n_name", "customers", "orders"), ["customers_by_nation", "nation", "order_count"], []),
    ]
    sources = {n: f"{sf}/{n}.parquet" for n in ("customer", "orders", "nation")}
    versions.refresh(lake, sources, steps)
    versions.refresh(lake, sources, steps)  # nothing changed: nothing is made again
    return lake.read("named")


@query("lifecycle_run", f"""select platform, 'processed' as action_status, count(*) filter (coalesce(is_active, true) and last_seen_at < timestamp '{star.AS_OF}' - interval 60 day) as soft_expired, count(*) filter (last_seen_at < timestamp '{star.AS_OF}' - interval 120 day) as jobs_deleted,
(select count(*) from star_details d join star_jobs o using (platform, job_id) where d.platform = j.platform and o.last_seen_at < timestamp '{star.AS_OF}' - interval 120 day) as details_deleted,
(select count(*) from star_hits h join star_jobs o using (platform, job_id) where h.platform = j.platform and o.last_seen_at < timestamp '{star.AS_OF}' - interval 120 day) as hits_deleted from star_jobs j where platform <> 'xing' group by platform union all select 'xing', 'failed', 0, 0, 0, 0""")
def lifecycle_run(spark, sf):
    lake = versions.Lake(spark, shared_folder(spark, "lake"))
    with lake.change() as now:
        for p in star.PLATFORMS:
            of = lambda rows, p=p: rows.filter(F.col("platform") == p)
            now.put(f"{p}_jobs", of(star.jobs(spark, sf)) if p != "xing" else spark.range(1), keys=["job_id"] if p != "xing" else ["id"], buckets=8)  # one platform's table is broken
            now.put(f"{p}_hits", of(star.hits(spark, sf)), keys=["job_id"], buckets=8)
            now.put(f"{p}_details", of(star.details(spark, sf)), keys=["job_id"], buckets=8)
    runs = spark.createDataFrame([(p, i, "success") for i, p in enumerate(star.PLATFORMS)], "platform string, run_id int, status string").withColumns({"started_at": _now() - F.expr("interval 2 hours"), "finished_at": _now() - F.expr("interval 1 hour"), "stats": lit(None).cast("string")})
    lifecycle.lifecycle_run(lake, star.PLATFORMS, runs, "1", _now())
    return lake.read("lifecycle_stats").select("platform", "action_status", "soft_expired", "jobs_deleted", "details_deleted", "hits_deleted")


_AS = f"timestamp '{star.AS_OF}'"


def _requests(spark, sf):
    return star.geocode_requests(spark, sf).withColumns({"lat": lit(None).cast("double"), "lon": lit(None).cast("double"), "resolved_at": lit(None).cast("timestamp"), "last_error": lit(None).cast("string")})


@query("geocoded_places", f"""select id, case when not asked then status when id % 4 <> 0 then 'resolved' when attempt_count + 1 >= 6 then 'failed_permanent' else 'error' end as status, case when asked and id % 4 <> 0 then 50.5 end as lat, case when asked then attempt_count + 1 else attempt_count end as attempt_count,
case when not asked then next_retry_at when id % 4 = 0 and attempt_count + 1 < 6 then {_AS} + to_minutes(cast(least(60 * pow(2, attempt_count), 10080) as bigint)) end as next_retry_at from (select *, status <> 'resolved' or id % 2 = 0 as asked from star_requests) q""")
def geocoded_places(spark, sf):
    cache, k = _requests(spark, sf), F.col("id")
    batch = cache.filter("status <> 'resolved' or id % 2 = 0").select("id", k.alias("position"), F.col("location_text_norm").alias("query"))
    results = batch.select("position", F.when(k % 3 != 0, F.col("query")).alias("query"), F.when(k % 4 != 0, "50.5").otherwise("x").alias("lat"), lit("8.25").alias("lon"), F.when(k % 4 == 0, "bad").alias("error"))
    return geocoding.apply_results(cache, batch, results, _now()).select("id", "status", "lat", "attempt_count", "next_retry_at")


@query("requeued_places", f"select id, case when status = 'failed_permanent' then 'pending' else status end as status, case when status = 'failed_permanent' then 0 else attempt_count end as attempt_count, case when status = 'failed_permanent' then {_AS} else next_retry_at end as next_retry_at from star_requests")
def requeued_places(spark, sf):
    return geocoding.reset_failed(_requests(spark, sf), _now()).select("id", "status", "attempt_count", "next_retry_at")


# states by day and reads by cell


def _daily(spark, sf):
    """States of all jobs, of which one in seven came later and one in eleven first had another time."""
    lake, base = versions.Lake(spark, shared_folder(spark, "days")), unify(star.jobs(spark, sf), star.details(spark, sf))
    k = F.col("job_id").cast("long")
    daily.create(lake, 32, 16)
    older = base.withColumn("first_seen_at", F.when(k % 11 == 0, F.col("first_seen_at") - F.expr("interval 40 days")).otherwise(F.col("first_seen_at")))
    older = older.withColumn("posted_at_utc", F.when(k % 11 == 0, F.col("posted_at_utc") - F.expr("interval 3 days")).otherwise(F.col("posted_at_utc")))
    daily.update(lake, older.filter(k % 7 != 0))
    daily.update(lake, base.filter((k % 7 == 0) | (k % 11 == 0)))
    return lake


@query("daily_trend", f"""select m as bucket_start, count(distinct case when date_trunc('month', event_ts) = m then platform || job_id end) as jobs_unique from uno, (select cast(unnest(generate_series(date_trunc('month', timestamp '{star.AS_OF}' - interval 11 month), timestamp '{star.AS_OF}', interval 1 month)) as timestamp) as m) s group by m""")
def daily_trend(spark, sf):
    return daily.monthly_trend(_daily(spark, sf), _now())


@query("daily_skills", f"""select w as days_window, lower(trim(s)) as skill, count(distinct platform || job_id) as jobs_unique from skill, (select unnest([30, 90]) as w) w where event_ts >= timestamp '{star.AS_OF}' - to_days(cast(w as integer)) and trim(s) <> '' group by all""")
def daily_skills(spark, sf):
    return daily.top_skills(_daily(spark, sf), _now())


@query("boxed_points", "select platform, job_id, kind as token_kind, lat, lon from pt where kind = 'city' and lat between 48.9 and 50.3 and lon between 8.0 and 11.2")
def boxed_points(spark, sf):
    base = unify(star.jobs(spark, sf), star.details(spark, sf))
    points, path = places.map_points(base, places.location_candidates(base, carry=True), star.geocodes(spark, sf)), shared_folder(spark, "points")
    serving.store_by_cell(points.filter("token_kind = 'city'").select("platform", "job_id", "token_kind", "lat", "lon"), path)
    return serving.in_box(spark.read.parquet(path), (48.9, 8.0, 50.3, 11.2)).drop("cell")


@query("second_page", "select o_orderkey, o_totalprice from (select o_orderkey, o_totalprice, row_number() over (order by o_totalprice desc nulls last, o_orderkey) as r from orders) q where r between 51 and 100")
def second_page(spark, sf):
    rows, order = star.table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), [("o_totalprice", True), ("o_orderkey", False)]
    last = serving.page_after(rows, order, None, 50).collect()[-1]
    return serving.page_after(rows, order, (last["o_totalprice"], last["o_orderkey"]), 50)


@query("cells", """select c_custkey, cast(list_sum([((lat >> i) & 1) * (cast(1 as bigint) << (2 * i + 1)) + ((lon >> i) & 1) * (cast(1 as bigint) << (2 * i)) for i in range(16)]) as bigint) as cell
from (select c_custkey, cast(floor((c_custkey % 181) / 180.0 * 65536) as bigint) as a, least(65535, cast(floor((c_custkey % 181) / 180.0 * 65536) as bigint)) as lat, least(65535, cast(floor((c_custkey % 361) / 360.0 * 65536) as bigint)) as lon from customer) q""")
def cell_numbers(spark, sf):
    k = F.col("c_custkey")
    return star.table(spark, sf, "customer").select("c_custkey", cells.cell((k % 181).cast("double") - 90.0, (k % 361).cast("double") - 180.0).alias("cell"))


# scalars and reports


@query("parsed_times", """select o_orderkey, case o_orderkey % 5 when 0 then o_orderdate when 1 then o_orderdate - interval 2 hour when 2 then o_orderdate + interval 90 minute end as at,
case o_orderkey % 4 when 0 then '{"a":' || o_orderkey || '}' else '{}' end as criteria, case when o_orderkey % 3 = 0 or o_orderkey % 7 = 0 then 'failed' when o_orderkey % 3 = 1 or o_orderkey % 7 = 1 then 'blocked' else 'success' end as status from orders""")
def parsed_times(spark, sf):
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(k % 5 == 0, F.concat(day, lit("Z"))).when(k % 5 == 1, F.concat(day, lit("+02:00"))).when(k % 5 == 2, F.concat(day, lit("-01:30"))).when(k % 5 == 3, "soon")
    raw = F.when(k % 4 == 0, F.concat(lit('{"a":'), k.cast("string"), lit("}"))).when(k % 4 == 1, "[1]").when(k % 4 == 2, "{broken")
    step = lambda n: F.when(k % n == 0, "failed").when(k % n == 1, "blocked").when(k % n == 2, "success")
    return star.table(spark, sf, "orders").select("o_orderkey", intake.parse_time(text).alias("at"), intake.criteria_or_empty(raw).alias("criteria"), intake.run_status(step(3), step(7)).alias("status"))


@query("search_codes", """select p_partkey, case p_partkey % 3 when 0 then 1 when 1 then 2 end as sort, case p_partkey % 3 when 0 then 7 when 1 then 1 end as age, case when p_partkey % 2 = 0 then 'f_JT=F' else '' end || case when p_partkey % 4 = 1 then 'f_TPR=r' || p_partkey else '' end as facets from part""")
def search_codes(spark, sf):
    k = F.col("p_partkey")
    facets = F.create_map(lit("f_JT"), F.when(k % 2 == 0, "F"), lit("f_TPR"), F.when(k % 4 == 1, F.concat(lit("r"), k.cast("string"))).when(k % 4 == 3, ""))
    kept = F.map_entries(intake.clean_facets(facets))
    return star.table(spark, sf, "part").select(
        "p_partkey", intake.sort_code(F.when(k % 3 == 0, " Relevance").when(k % 3 == 1, "publish")).alias("sort"), intake.age_days_code(F.when(k % 3 == 0, "AGE_7").when(k % 3 == 1, "1")).alias("age"),
        F.array_join(F.transform(kept, lambda e: F.concat(e["key"], lit("="), e["value"])), "").alias("facets"),
    )


@query("search_addresses", """select p_partkey, 'https://l.org/s?keywords=' || replace(p_name, ' ', '+') || '&location=Berlin%2C+DE&geoId=' || p_size || '&start=25' || case when p_partkey % 3 = 0 then '&f_TPR=r86400&f_JT=F&f_JT=P' else '' end as paged,
'https://s.de/jobs/' || replace(p_name, ' ', '-') || '/in-' || lower(replace(p_brand, '#', '-')) || '?radius=30&sort=2&searchOrigin=Resultlist_top-search&whereType=autosuggest' || case when p_partkey % 3 = 1 then '&page=2' else '' end || case when p_partkey % 2 = 0 then '&ag=age_7' else '' end
  || '&action=' || case when p_partkey % 3 = 1 then 'paging_next' when p_partkey % 2 = 0 then 'facet_selected%3Bage%3Bage_7' else 'sort_publish' end as slugged,
'https://x.com/ki?keywords=' || replace(p_name, ' ', '+') || case when p_partkey % 2 = 1 then '&location=K%C3%B6ln' else '' end || case when p_partkey % 3 = 2 then '&cityId=' || p_size || '.a%2Ab~c' else '' end as keyed
from (select p_partkey, p_size, p_brand, lower(trim(regexp_replace(p_name, '[^A-Za-z0-9]+', ' ', 'g'))) as p_name from part) q""")
def search_addresses(spark, sf):
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    name = F.lower(F.trim(F.regexp_replace("p_name", "[^A-Za-z0-9]+", " ")))
    facets = F.when(k % 3 == 0, F.create_map(lit("f_TPR"), F.array(lit("r86400")), lit("f_JT"), F.array(lit("F"), lit("P"))))
    return star.table(spark, sf, "part").select(
        "p_partkey", urls.paged_search_url("https://l.org/s", name, lit("Berlin, DE"), size, lit(25), facets).alias("paged"),
        urls.slugged_search_url("https://s.de", name, F.col("p_brand"), lit(30), lit("newest"), F.when(k % 2 == 0, "7"), F.when(k % 3 == 1, 2).otherwise(1)).alias("slugged"),
        urls.keyword_search_url("https://x.com/ki", F.concat(lit(" "), name), F.when(k % 2 == 1, "Köln").otherwise(" "), F.when(k % 3 == 2, F.concat(size, lit(".a*b~c"))), lit(None).cast("string")).alias("keyed"),
    )


@query("preview_details", """select platform, job_id, k % 6 <> 5 as parse_ok, case when k % 6 = 5 then 'missing_list_preview_fields' end as last_error, case when k % 3 = 0 then 'Title ' || k end as job_title, case when k % 3 = 1 then 'Firm' when k % 6 = 5 then '' end as company_name, case when k % 6 = 2 then 'Ulm' end as job_location from star_jobs where k % 2 = 1 or k % 6 = 2""")
def preview_details(spark, sf):
    k = F.col("job_id").cast("long")
    jobs = star.jobs(spark, sf).withColumns({"is_external": (k % 2 == 1) | (k % 6 == 2), "list_preview": F.create_map(lit("job_title"), F.when(k % 3 == 0, F.concat(lit("Title "), "job_id")), lit("company_name"), F.when(k % 3 == 1, "Firm").when(k % 6 == 5, ""), lit("job_location"), F.when(k % 6 == 2, "Ulm"))})
    return searches.preview_details(jobs, _now()).select("platform", "job_id", "parse_ok", "last_error", "job_title", "company_name", "job_location")


@query("resolved_places", """select s_suppkey as query, cast(case when s_suppkey % 3 = 0 then s_suppkey * 10 + 2 else s_suppkey * 10 end as bigint) as id, case when s_suppkey % 3 = 0 then 'Berlin, Germany' else 'Berlin, NH' end as display_name from supplier""")
def resolved_places(spark, sf):
    k = F.col("s_suppkey")
    names = F.array(lit("Berlin, NH"), lit("Berlin, CT"), F.when(k % 3 == 0, "Berlin, Germany").otherwise("Berlin, MD"))
    hits = star.table(spark, sf, "supplier").select(k.alias("query"), F.posexplode(names).alias("pos", "display_name")).withColumn("id", (F.col("query") * 10 + F.col("pos")).cast("long"))
    return searches.best_place(hits, " Germany")


@query("resolved_facets", """select s_suppkey as search, facet, pos, value, unknown from (select s_suppkey, 'f_TPR' as facet, 0 as pos, 'r' || s_suppkey as value, null as unknown from supplier union all select s_suppkey, 'f_JT', 0, 'F', null from supplier union all select s_suppkey, 'f_JT', 1, case when s_suppkey % 2 = 0 then 'P' end, case when s_suppkey % 2 = 1 then 'Odd job type' end from supplier union all select s_suppkey, 'f_JT', 2, 'C', null from supplier) q""")
def resolved_facets(spark, sf):
    k = F.col("s_suppkey")
    asked = F.array(F.struct(lit("f_TPR").alias("facet"), F.array(F.concat(lit("r"), k.cast("string"))).alias("labels")), F.struct(lit("f_JT").alias("facet"), F.array(lit("Full-time "), F.when(k % 2 == 0, " part-TIME").otherwise("Odd job type"), lit("C")).alias("labels")))
    requests = star.table(spark, sf, "supplier").select(k.alias("search"), F.explode(asked).alias("x")).select("search", "x.facet", "x.labels")
    options = spark.createDataFrame([("f_JT", "Full-time", "F"), ("f_JT", "Part-time", "P")], "facet string, label string, value string")
    return searches.resolve_facets(requests, options)


@query("enabled_definitions", f"select n_name as name from (select *, {star._sql_pick(star.PLATFORMS, 'n_nationkey')} as platform from nation) q where platform = 'xing' and n_nationkey % 2 = 0")
def enabled_definitions(spark, sf):
    k = F.col("n_nationkey")
    return searches.enabled(star.table(spark, sf, "nation").select(star._pick(star.PLATFORMS, k).alias("platform"), (k % 2 == 0).alias("enabled"), F.col("n_name").alias("name")), "xing").select("name")


@query("run_records", f"select run_id, platform, status, case when run_id = -1 then 'blocked' end as ended from (select run_id, platform, status from star_runs union all select -1, 'xing', 'blocked') q")
def run_records(spark, sf):
    runs = searches.open_run(star.crawl_runs(spark, sf), "-1", "xing", "manual", _now())
    done = searches.finish_run(runs, "-1", "blocked", _now(), "{}", "shut out")
    return done.select("run_id", "platform", "status", F.when(F.col("error") == "shut out", F.col("status")).alias("ended"))


@query("expected_triggers", "select event_id, case when event_id % 3 = 0 then 'schedule' when event_id % 3 = 1 then 'manual' end as trigger from events")
def expected_triggers(spark, sf):
    k = F.col("event_id")
    external = star.table(spark, sf, "events").select("event_id", lit("crawl").alias("workflow"), F.when(k % 3 == 0, " Schedule").when(k % 3 == 1, "workflow_dispatch").otherwise("push").alias("event"))
    known = spark.createDataFrame([("crawl", "schedule", "schedule"), ("crawl", "workflow_dispatch", "manual")], "workflow string, event string, trigger string")
    return searches.expected_trigger(external, known).select("event_id", "trigger")


def _cases(spark, sf):
    k = F.col("event_id")
    outcome = F.when(k % 5 < 2, " Success").when(k % 5 == 2, "failure").when(k % 5 == 3, "cancelled").otherwise("odd")
    row = F.when(k % 7 == 0, "success").when(k % 7 == 1, "running").when(k % 7 == 2, "failed")
    return star.table(spark, sf, "events").select(k.alias("case_id"), outcome.alias("outcome"), F.when(k % 3 != 0, "schedule").alias("expected_trigger"), F.when(k % 11 != 0, k.cast("string")).alias("crawl_run_id"), row.alias("row_status"), F.when(row.isNotNull(), F.when(k % 2 == 0, "schedule").otherwise("manual")).alias("row_trigger"), (k % 13 == 0).cast("int").alias("stale"), (k % 4 == 0).cast("int").alias("lingering"))


@query("run_integrity", """select * from (with c as (select event_id as e, event_id % 5 < 2 as good, event_id % 5 in (2, 3) as bad, event_id % 7 < 3 as found from events)
select e as case_id, 'stale_rows_remain' as code from c where e % 13 = 0 union all select e, 'missing_crawl_run_id' from c where good and e % 11 = 0 union all select e, 'missing_crawl_row' from c where good and not found union all select e, 'non_terminal_crawl_row' from c where good and e % 7 = 1
union all select e, 'trigger_mismatch' from c where good and found and e % 3 <> 0 and e % 2 = 1 union all select e, 'lingering_running_after_non_success' from c where bad and e % 4 = 0 union all select e, 'unsupported_run_step_outcome' from c where not good and not bad) q""")
def run_integrity(spark, sf):
    return searches.integrity(_cases(spark, sf))


@query("run_checks", """select * from (with c as (select event_id as e, event_id % 5 < 2 as good, event_id % 5 in (2, 3) as bad, event_id % 7 < 3 as found from events)
select e as case_id, 'no_stale_running_rows_after_repair' as name, e % 13 <> 0 as ok, 'remaining_stale_count=' || case when e % 13 = 0 then 1 else 0 end as detail from c
union all select e, 'success_has_crawl_run_id', e % 11 <> 0, 'crawl_run_id=' || case when e % 11 <> 0 then cast(e as varchar) else '' end from c where good union all select e, 'success_row_exists', found, 'found_row=' || cast(found as integer) from c where good
union all select e, 'success_row_terminal_status', e % 7 <> 1, 'db_status=' || case e % 7 when 0 then 'success' when 1 then 'running' else 'failed' end from c where good and found
union all select e, 'success_trigger_matches', e % 2 = 0, 'db_trigger=' || case when e % 2 = 0 then 'schedule' else 'manual' end || ' expected=schedule' from c where good and found and e % 3 <> 0
union all select e, 'non_success_has_no_lingering_running_rows', e % 4 <> 0, 'lingering_running_count=' || case when e % 4 = 0 then 1 else 0 end from c where bad union all select e, 'supported_run_step_outcome', false, 'run_step_outcome=odd' from c where not good and not bad) q""")
def run_checks(spark, sf):
    return searches.integrity_checks(_cases(spark, sf))


@query("backlog_progress", """select platform, batch, remaining, lag(remaining) over (partition by platform order by batch) - remaining as delta, remaining > 0 and coalesce(lag(remaining) over (partition by platform order by batch) - remaining > 0, true) as go_on
from (select platform, batch, count(*) filter (where k % 10 = 0 and k % 4 >= batch) as remaining from star_jobs, (select unnest([0, 1, 2, 3, 4]) as batch) b group by all) q""")
def backlog_progress(spark, sf):
    k = F.col("job_id").cast("long")
    rows = star.jobs(spark, sf).select("platform", k.alias("k"), F.explode(F.array(*map(lit, range(5)))).alias("batch"))
    counts = rows.groupBy("platform", "batch").agg(F.count_if((F.col("k") % 10 == 0) & (F.col("k") % 4 >= F.col("batch"))).alias("remaining"))
    return reports.backlog_progress(counts, "platform")


@query("dictionary_table", "select 'tools' as group_name, cast(0 as integer) as group_pos, p_type as canonical, cast(row_number() over (order by p_type) - 1 as integer) as canonical_pos, lower(p_type) as alias from (select distinct p_type from part) q")
def dictionary_table(spark, sf):
    types = [r[0] for r in star.table(spark, sf, "part").select("p_type").distinct().orderBy("p_type").limit(10_000).collect()]  # a dictionary: the types that the catalogue has
    return taxonomy.dictionary_table(spark, taxonomy.flatten({"tools": [{"canonical": t, "aliases": [t.upper()]} for t in types]}))


# pieces of pages


def _pages(spark, sf, html):
    return star.table(spark, sf, "pages").withColumn("html", F.concat("html", html))


@query("page_counters", "select page_id, cast(page_id % 50 as integer) as total, cast(7 as integer) as shown from pages")
def page_counters(spark, sf):
    s = (F.col("page_id") % 50).cast("string")
    rows = _pages(spark, sf, F.concat(lit('<div data-total-count="'), s, lit('" data-shown-count="7"></div>'))).select("page_id", extraction.counters(F.col("html")).alias("c"))
    return rows.select("page_id", F.try_element_at("c", lit("total")).alias("total"), F.try_element_at("c", lit("shown")).alias("shown"))


@query("page_markers", "select page_id, case when page_id % 2 = 0 then 'Still nothing? See ' || page_id || ' more' end as marker, page_id % 3 = 0 as more from pages")
def page_markers(spark, sf):
    k, s = F.col("page_id"), F.col("page_id").cast("string")
    html = F.concat(F.when(k % 2 == 0, F.concat(lit("<h4>Still <b>nothing?</b> See "), s, lit(" more</h4><h3>other</h3>"))).otherwise("<h4>other</h4>"), F.when(k % 3 == 0, lit('<button type="button"><span>Show  more</span></button>')).otherwise(lit("<button>More</button>")))
    marks = extraction.section_markers(F.col("html"), ["still nothing\\?", "no such"])
    return _pages(spark, sf, html).select("page_id", F.get(marks, lit(0)).alias("marker"), extraction.has_more(F.col("html")).alias("more"))


@query("page_highlights", """select page_id, case when page_id % 2 = 0 then '€50,000' end as salary, case page_id % 3 when 0 then 'Hybrid' when 1 then 'On-site' end as work_model, case when page_id % 5 <> 0 then 'Full-time' end as employment_type, page_id % 7 = 0 as is_external from pages""")
def page_highlights(spark, sf):
    k = F.col("page_id")
    chips = F.array_compact(F.array(lit("New"), F.when(k % 5 != 0, "Full-time"), F.when(k % 2 == 0, "€50,000"), F.when(k % 3 == 0, "hybrid work").when(k % 3 == 1, "Vor Ort"), F.when(k % 7 == 0, "External job ad"), lit("urgently hiring")))
    return star.table(spark, sf, "pages").select("page_id", extraction.classify_highlights(chips).alias("x")).select("page_id", "x.*")


@query("page_criteria", "select page_id, 'Level ' || page_id as seniority_level, case when page_id % 2 = 0 then 'Vollzeit' end as employment_type, case when page_id % 3 = 0 then 'IT' end as industries from pages")
def page_criteria(spark, sf):
    k, s = F.col("page_id"), F.col("page_id").cast("string")
    pair = lambda label, value: F.concat(lit(f"<li><h3 class=\"x\">{label}</h3>\n<span>"), value, lit("</span></li>"))
    html = F.concat(pair("Seniority <i>level</i>", F.concat(lit("Level "), s)), F.when(k % 2 == 0, pair("Beschäftigungsverhältnis", lit("Vollzeit"))).otherwise(""), F.when(k % 3 == 0, pair("Branchen", lit("IT"))).otherwise(""), pair("Else", lit("x")))
    rows = _pages(spark, sf, html).select("page_id", extraction.criteria(F.col("html"), intake.CRITERIA_LABELS).alias("c"))
    return rows.select("page_id", *[F.try_element_at("c", lit(n)).alias(n) for n in ("seniority_level", "employment_type", "industries")])


@query("page_facets", "select page_id, 'f_JT' as facet, 'Full-time' as label, 'F' as value from pages union all select page_id, 'f_E', 'Level ' || page_id, cast(page_id % 9 as varchar) from pages")
def page_facets(spark, sf):
    k, s = F.col("page_id"), F.col("page_id").cast("string")
    html = F.concat(lit('<input id="a" name="f_JT" value="F"><label for="a">Full-time (1,234)</label><input type="text" name="q" value="x"><label>no</label><input name="f_E" value="'), (k % 9).cast("string"), lit('"><label>Level '), s, lit(" (7)</label>"))
    return extraction.facet_options(_pages(spark, sf, html))


@query("page_state", "select page_id, case when page_id % 2 = 0 then 'T' || page_id end as title from pages")
def page_state(spark, sf):
    k, s = F.col("page_id"), F.col("page_id").cast("string")
    html = F.when(k % 2 == 0, F.concat(lit('<script>window.__S = {"a": undefined, "job": {"text": "}</script>", "title": "T'), s, lit('"}};</script>'))).otherwise(lit("<script>window.__X = {}</script>"))
    return _pages(spark, sf, html).select("page_id", extraction.runtime_state(F.col("html"), r"window\.__S", "$.job.title").alias("title"))


@query("url_slugs", "select p_partkey, 'ueber-' || trim(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '-') || '-finanz' as slug from part")
def url_slugs(spark, sf):
    return star.table(spark, sf, "part").select("p_partkey", intake.url_slug(F.concat(lit(" Ueber / "), "p_name", lit(" ﬁnanz"))).alias("slug"))
