"""Keyed writes, lifecycle, geocoding, reports, logs, extraction."""

import datetime as dt
import json
import random
import time

import pytest
from pyspark.sql import functions as F

from postlake.functions import urls
from postlake.operators import extraction, geocoding, ingest, keyed, lifecycle, postings, reports, taxonomy
from postlake.sources import logs, snapshots
from postlake.streaming.ingest import stream_log

NOW = dt.datetime(2024, 1, 31)


def at(**d):
    return NOW - dt.timedelta(**d)


def now():
    return F.lit(NOW)


def test_upsert_last_wins_and_twice_is_once(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    new = spark.createDataFrame([("a", 5, 1), ("a", 6, 2), ("c", 7, 1)], "k string, v int, seq int")
    once = keyed.upsert(target, new, ["k"], order=["seq"])
    assert sorted(once.collect()) == [("a", 6, "x"), ("b", 2, "y"), ("c", 7, None)]
    assert sorted(keyed.upsert(once, new, ["k"], order=["seq"]).collect()) == sorted(once.collect())


def test_upsert_empty_sides(spark):
    target = spark.createDataFrame([], "k string, v int")
    assert keyed.upsert(target, target, ["k"]).count() == 0
    one = spark.createDataFrame([("a", None)], "k string, v int")
    assert keyed.upsert(target, one, ["k"]).collect() == [("a", None)]


def test_discovery_reactivates_and_keeps_first_seen(spark):
    jobs = spark.createDataFrame([("x", "1", "old", at(days=9), at(days=9), False, at(days=1), "gone")], "platform string, job_id string, job_url string, first_seen_at timestamp, last_seen_at timestamp, is_active boolean, expired_at timestamp, expire_reason string")
    found = spark.createDataFrame([("x", "1", "u1", at(days=2), 1), ("x", "1", "u2", at(days=3), 2), ("x", "2", "u3", NOW, 3)], "platform string, job_id string, job_url string, scraped_at timestamp, seq int")
    out = {r["job_id"]: r for r in ingest.apply_discovery(jobs, found).collect()}
    assert out["1"][2:] == ("u2", at(days=9), at(days=3), True, None, None)
    assert out["2"]["first_seen_at"] == NOW and out["2"]["is_active"]


def test_previews_merge_in_line_order(spark):
    rows = [("x", "1", 1, {"a": "1", "b": "2"}), ("x", "1", 2, {"b": None, "c": "3"})]
    df = spark.createDataFrame(rows, "platform string, job_id string, seq int, list_preview map<string,string>")
    assert ingest.merge_previews(df).first()["list_preview"] == {"a": "1", "b": None, "c": "3"}


def test_hits_first_line_wins(spark):
    fields = "search_run_id int, platform string, job_id string, rank int, page_start int, scraped_at timestamp"
    old = spark.createDataFrame([(1, "x", "1", 9, 9, NOW)], fields)
    found = spark.createDataFrame([(1, "x", "1", 1, 1, NOW, 1), (2, "x", "1", None, None, NOW, 2), (2, "x", "1", 5, 5, NOW, 3), (None, "x", "2", 1, 1, NOW, 4)], fields + ", seq int")
    assert sorted((r["search_run_id"], r["rank"]) for r in ingest.add_hits(old, found).collect()) == [(1, 9), (2, 0)]


def test_gone_and_back(spark):
    jobs = spark.createDataFrame([("x", str(i), True, None, None) for i in range(4)], "platform string, job_id string, is_active boolean, expired_at timestamp, expire_reason string")
    log = spark.createDataFrame([("x", "0", 1, at(days=3), "http_410", False), ("x", "0", 2, at(days=2), "http_410", False), ("x", "1", 1, NOW, "http_410", False), ("x", "1", 2, NOW, None, True), ("x", "2", 1, NOW, "blocked", False)], "platform string, job_id string, seq int, scraped_at timestamp, last_error string, parse_ok boolean")
    out = {r["job_id"]: tuple(r)[2:] for r in ingest.apply_gone(jobs, log).select("platform", "job_id", "is_active", "expired_at", "expire_reason").collect()}
    assert out["0"] == (False, at(days=3), "http_410") and out["1"] == (True, None, None) and out["2"] == (True, None, None) and out["3"] == (True, None, None)


@pytest.mark.parametrize(("days", "active", "stale"), [(59, True, False), (60, True, False), (61, True, True), (61, None, True), (61, False, False)])
def test_soft_expire_edges(spark, days, active, stale):
    jobs = spark.createDataFrame([("x", "1", at(days=days), active, None, None, None)], "platform string, job_id string, last_seen_at timestamp, is_active boolean, stale_since_at timestamp, expired_at timestamp, expire_reason string")
    assert (lifecycle.soft_expire(jobs, now()).first()["expire_reason"] == "not_seen_window") == stale


def test_health_gate(spark):
    rows = [("a", 1, "success", at(hours=2), at(hours=1), None), ("b", 1, "blocked", at(hours=2), at(hours=1), None), ("c", 1, "success", at(hours=50), at(hours=48), None), ("d", 1, "success", at(hours=3), at(hours=2), None), ("d", 2, "failed", at(hours=1), NOW, '{"discovery":{"status":"skipped"}}')]
    runs = spark.createDataFrame(rows, "platform string, run_id int, status string, started_at timestamp, finished_at timestamp, stats string")
    got = {r["platform"]: r["action_status"] for r in lifecycle.health_gate(runs, now()).collect()}
    assert got == {"a": "processed", "b": "skipped_unhealthy", "c": "skipped_unhealthy", "d": "processed"}


def test_recency_policy(spark):
    df = spark.createDataFrame([(False, None), (True, at(hours=11)), (True, at(hours=60)), (True, None)], "h boolean, s timestamp")
    assert [r[0] for r in df.select(lifecycle.recency_code(F.col("h"), F.col("s"), now())).collect()] == [None, "r86400", "r604800", "r604800"]


def test_backoff(spark):
    df = spark.createDataFrame([(1,), (2,), (20,)], "n int")
    assert [r[0] for r in df.select(geocoding.backoff_minutes(F.col("n"))).collect()] == [60, 120, 10080]


def test_nearest_takes_the_later_on_ties(spark):
    ext = spark.createDataFrame([(1, "s", NOW), (2, "s", at(days=5)), (3, None, NOW)], "external_id int, trigger string, created_at timestamp")
    runs = spark.createDataFrame([(10, "s", at(minutes=5), "success"), (11, "s", at(minutes=-5), "running"), (12, "t", NOW, "success")], "run_id int, trigger string, started_at timestamp, status string")
    got = {r["external_id"]: (r["run_id"], r["delta_seconds"], r["matched"]) for r in reports.reconcile(ext, runs, 1200).collect()}
    assert got == {1: (11, 300, True), 2: (None, None, False), 3: (None, None, False)}


@pytest.mark.parametrize("within", [0, 7, 60])
def test_nearest_equals_all_pairs(spark, within):
    rng = random.Random(within)
    times = lambda n, k: [(k + i, rng.choice(["s", "t", None]), rng.choice([None, *[at(seconds=rng.randrange(-200, 200), microseconds=rng.randrange(10**6)) for _ in range(9)]])) for i in range(n)]
    ext, runs = times(150, 0), [(*r, rng.choice(["running", "success"])) for r in times(60, 1000)]
    second = lambda t: (t.replace(microsecond=0) - NOW).total_seconds()
    want = {}
    for i, kind, t in ext:
        near = [(abs(second(u) - second(t)), -second(u), j, status) for j, other, u, status in runs if t and u and kind and kind == other and abs(second(u) - second(t)) <= within]
        want[i] = (min(near)[2], min(near)[3], min(near)[0]) if near else (None, None, None)
    got = reports.reconcile(spark.createDataFrame(ext, "external_id int, trigger string, created_at timestamp"), spark.createDataFrame(runs, "run_id int, trigger string, started_at timestamp, status string"), within)
    assert {r["external_id"]: (r["run_id"], r["run_status"], r["delta_seconds"]) for r in got.collect()} == want


def test_nearest_makes_no_pairs_of_a_crowd(spark):
    """20,000 rows of both sides within a minute were 400 million pairs, sorted on disk."""
    rows = spark.range(20_000).select("id", F.lit("s").alias("trigger"), (now() + F.make_interval(secs=F.col("id") % 60)).alias("time"))
    began = time.time()
    got = reports.reconcile(rows.select(F.col("id").alias("external_id"), "trigger", F.col("time").alias("created_at")), rows.select((F.col("id") + 5).alias("run_id"), "trigger", F.col("time").alias("started_at"), F.lit("success").alias("status")), 60)
    assert got.filter(F.col("matched") & (F.col("run_id") == F.col("external_id") % 60 + 5) & (F.col("delta_seconds") == 0)).count() == 20_000
    assert time.time() - began < 30


def test_log_reading_and_recovery(spark, tmp_path):
    lines = [json.dumps({"record_type": "page_fetch", "search_run_id": "1", "page_start": 0, "blocked": True}), "", json.dumps({"record_type": "job_discovered", "search_run_id": "1", "job_id": "a", "page_start": 25}), json.dumps({"record_type": "job_detail", "job_id": ""}), json.dumps({"record_type": "else"}), '{"record_type": "job_disc']
    (tmp_path / "log.jsonl").write_text("\n".join(lines))
    log = logs.read_log(spark, str(tmp_path / "log.jsonl"))
    pages, found, details = logs.split(log)
    assert (pages.count(), found.count(), details.count()) == (1, 1, 0)
    assert tuple(logs.recover(spark, str(tmp_path / "log.jsonl")).first()) == (4, 1)
    assert tuple(ingest.search_run_stats(log).first()) == ("1", 2, 1, 1, False)
    assert ingest.search_run_stats(log, None).first()["blocked"]


def test_stream_gives_every_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.jsonl").write_text(json.dumps({"record_type": "job_discovered", "job_id": str(i)}))
    seen = []
    q = stream_log(spark, str(tmp_path / "in"), str(tmp_path / "cp"), lambda df, i: seen.extend(r["job_id"] for r in df.collect()))
    q.awaitTermination(60)
    assert sorted(seen) == ["0", "1", "2"]


def test_snapshots_in_order(spark, tmp_path):
    steps = [("a", lambda t: spark.range(5), ["id"]), ("b", lambda t: t["a"].filter("id > 2"), [])]
    assert snapshots.refresh(spark, str(tmp_path), steps) == ["a", "b"]
    assert spark.read.parquet(f"{tmp_path}/b").count() == 2


def test_extraction(spark):
    html = '<title>T</title><script>var a="<h1>no</h1>";</script><h1 class="x">Data &amp; <b>AI</b></h1><a href="/jobs/1?x=1#y">One</a><a href="">none</a><a href="https://o.org/2">Two</a>'
    pages = spark.createDataFrame([(1, "u", html), (2, "u", None), (3, "u", "please solve the CAPTCHA")], "page_id int, url string, html string")
    rows = {r["page_id"]: r for r in extraction.dom_fields(pages).collect()}
    assert rows[2]["last_error"] == "no_title" and rows[3]["last_error"] == "blocked"
    cards = [(r["rank"], r["url"], r["label"]) for r in extraction.list_cards(pages, "https://s.org").orderBy("rank").collect()]
    assert cards == [(1, "https://s.org/jobs/1", "One"), (3, "https://o.org/2", "Two")]
    ld = '<script type="application/ld+json">{"@type":"Thing"}</script><script type="application/ld+json">{"@type":"JobPosting","title":"Dev","hiringOrganization":{"name":"Acme"}}</script>'
    got = spark.createDataFrame([(ld,), ("x",)], "h string").select(postings.jsonld_posting(F.col("h")).alias("j")).collect()
    assert got[0]["j"]["title"] == "Dev" and got[0]["j"]["company_name"] == "Acme" and got[1]["j"] is None


def test_urls(spark):
    rows = ["https://a.org/jobs/view/123/", "https://a.org/jobs/view/data-eng-456?x=1", "https://a.org/s?currentJobId=789", "https://a.org/jobs/berlin-dev-99", "https://a.org/about"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(rows)], "i int, u string")
    assert [r[1] for r in df.select("i", urls.posting_id(F.col("u"))).orderBy("i").collect()] == ["123", "456", "789", "99", None]
    assert spark.range(1).select(urls.slug(F.lit("  Ä?!"))).first()[0] == "x"


def test_taxonomy(spark):
    rows = taxonomy.flatten({"lang": [{"canonical": "Go", "aliases": ["go", "golang"]}, {"canonical": "SQL", "aliases": {"en": ["sql"], "de": ["sql"]}}], "db": [{"canonical": "SQL Server"}]})
    assert [r[4] for r in rows] == ["golang", "sql", "sql server"]
    with pytest.raises(ValueError):
        taxonomy.flatten({"x": "y"})
    docs = spark.createDataFrame([(1, "let's go, Golang and SQL Server"), (2, "mysql"), (3, None)], "id int, text string")
    got = {r["id"]: r["skills"] for r in taxonomy.grouped_skills(docs, rows).collect()}
    assert got == {1: {"lang": ["Go", "SQL"], "db": ["SQL Server"]}, 2: {}, 3: {}}


def test_search_grid_keeps_the_first_spelling(spark):
    spec = spark.createDataFrame([("x", ["Data  Eng", "data eng", "ML"], ["Berlin", "Bonn"]), ("y", ["a"], [])], "platform string, keywords array<string>, locations array<string>")
    got = sorted((r["name"], r["keyword"]) for r in taxonomy.search_grid(spec).collect())
    assert got == [("x__data_eng__berlin", "Data Eng"), ("x__data_eng__bonn", "Data Eng"), ("x__ml__berlin", "ML"), ("x__ml__bonn", "ML"), ("y__a__x", "a")]


def test_page_parts(spark):
    from postlake.functions.intake import CRITERIA_LABELS

    html = (
        '<h3> Employment type </h3><span>Full-time</span><h3>Branchen</h3> <span class="x">IT &amp; Co</span><h3>Other</h3><span>x</span>'
        '<input name="f_JT" value="F"> <label>Full-time (1,204)</label><h4>Similar jobs</h4><button>Show more</button><script>window.S = {"job":{"t":"Dev","u":undefined}};</script>'
    )
    df = spark.createDataFrame([(1, html), (2, "")], "page_id int, html string")
    h = F.col("html")
    rows = df.select(
        extraction.criteria(h, CRITERIA_LABELS).alias("c"), extraction.section_markers(h, ["similar", "more in"]).alias("m"), extraction.has_more(h).alias("b"),
        extraction.runtime_state(h, "window.S", "$.job.t").alias("t"), extraction.first_source({"a": F.lit(" "), "b": extraction.runtime_state(h, "window.S", "$.job.t"), "c": F.lit("z")}).alias("f"),
    ).collect()
    assert rows[0]["c"] == {"employment_type": "Full-time", "industries": "IT & Co"} and rows[0]["m"] == ["Similar jobs"] and rows[0]["b"] and rows[0]["t"] == "Dev" and tuple(rows[0]["f"]) == ("Dev", "b")
    assert rows[1]["c"] == {} and rows[1]["m"] == [] and not rows[1]["b"] and tuple(rows[1]["f"]) == ("z", "c")
    assert [tuple(r) for r in extraction.facet_options(df).collect()] == [(1, "f_JT", "Full-time", "F")]
    cards = spark.createDataFrame([(1, 1), (1, 2), (1, 3)], "page_id int, rank int")
    assert extraction.main_results(cards, F.lit(2)).count() == 2 and extraction.main_results(cards, F.lit(None).cast("int")).count() == 3


def test_highlights_in_order(spark):
    rows = [(1, ["New", "External job ad", "Full-time", "€50.000 – €60.000", "Hybrid work", "Remote"]), (2, ["Vor Ort", "40.000 - 50.000"]), (3, []), (4, None)]
    df = spark.createDataFrame(rows, "i int, chips array<string>").select("i", extraction.classify_highlights(F.col("chips")).alias("h"))
    got = {r["i"]: tuple(r["h"]) for r in df.collect()}
    assert got == {1: ("€50.000 – €60.000", "Hybrid", "Full-time", True), 2: ("40.000 - 50.000", "On-site", None, False), 3: (None, None, None, False), 4: (None, None, None, False)}


def test_block_rules_of_each_platform(spark):
    rows = [(1, 999, "u", "ok"), (2, 200, "https://x.org/checkpoint/1", "ok"), (3, 200, "u", "Temporarily BLOCKED"), (4, None, None, None), (5, 429, "u", "ok")]
    df = spark.createDataFrame(rows, "i int, status int, url string, html string")
    names = ("linkedin", "stepstone", "xing")
    got = df.select(*[extraction.is_blocked(F.col("html"), F.col("status"), F.col("url"), n).alias(n) for n in names]).collect()
    assert [tuple(r) for r in got] == [(True, False, False), (True, False, False), (False, True, True), (False, False, False), (True, True, True)]


def test_parts_of_a_log_keep_their_order(spark, tmp_path):
    for name, ids in (("b", ["1", "2"]), ("a", ["3", ""])):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps({"record_type": "job_detail", "job_id": i}) for i in ids))
    log = logs.merge(spark, [str(tmp_path / "b.jsonl"), str(tmp_path / "a.jsonl")])
    assert [r["job_id"] for r in log.orderBy("seq").collect()] == ["1", "2", "3", ""]
    assert logs.skipped_details(log).first()["skipped"] == 1 and logs.split(log)[2].count() == 3
