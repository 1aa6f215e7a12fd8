"""Lifecycle runs apart by platform, daily states, cells of the map, pages by key, checks in one scan, search addresses, the dictionary's file."""

import collections
import datetime as dt
import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from postlake import queries_state
from postlake.functions import cells, intake, urls
from postlake.operators import lifecycle, reports, searches, taxonomy
from postlake.plans import analytics, daily, serving
from postlake.plans.unified import unify
from postlake.sources import logs, star, versions

NOW = dt.datetime(2026, 2, 1, 12)
JOBS = "platform string, job_id string, last_seen_at timestamp, is_active boolean, stale_since_at timestamp, expired_at timestamp, expire_reason string"


def ago(**d):
    return NOW - dt.timedelta(**d)


def lake_of_platforms(spark, root, broken=()):
    lake = versions.Lake(spark, str(root))
    with lake.change() as now:
        for p in ("a", "b", "c"):
            rows = [(p, str(i), ago(days=20 * i), True, None, None, None) for i in range(8)]
            children = spark.createDataFrame([(p, str(i % 8), i) for i in range(16)], "platform string, job_id string, n int")
            now.put(f"{p}_jobs", spark.createDataFrame(rows, JOBS) if p not in broken else spark.range(3), keys=["job_id"] if p not in broken else ["id"], buckets=2)
            now.put(f"{p}_hits", children, keys=["job_id"], buckets=2)
            now.put(f"{p}_details", children.filter("n < 8"), keys=["job_id"], buckets=2)
    return lake


def runs_of(spark):
    rows = [(p, i, "success", ago(hours=3), ago(hours=2), None) for i, p in enumerate("abc")]
    return spark.createDataFrame(rows, "platform string, run_id int, status string, started_at timestamp, finished_at timestamp, stats string")


def test_one_broken_platform_leaves_the_others_applied(spark, tmp_path):
    lake = lake_of_platforms(spark, tmp_path, broken="b")
    assert lifecycle.lifecycle_run(lake, ["a", "b", "c"], runs_of(spark), "r1", F.lit(NOW)) == "partial"
    stats = {r["platform"]: r for r in lake.read("lifecycle_stats").collect()}
    assert stats["b"]["action_status"] == "failed" and stats["b"]["note"] and stats["b"]["jobs_deleted"] == 0
    for p in "ac":
        # 0, 20 .. 140 days: those of 80 to 140 expire, those of 140 (over 120) go with their rows
        assert [stats[p][c] for c in ("action_status", "soft_expired", "jobs_deleted", "hits_deleted", "details_deleted")] == ["processed", 4, 1, 2, 1]
        assert {r["job_id"]: r["is_active"] for r in lake.read(f"{p}_jobs").collect()} == {str(i): i < 4 for i in range(7)}
        assert lake.read(f"{p}_hits").count() == 14 and lake.read(f"{p}_details").count() == 7
    run = lake.read("lifecycle_runs").first()
    assert run["status"] == "partial" and json.loads(run["summary"])["totals"]["jobs_deleted"] == 2


def test_unhealthy_and_dry_runs(spark, tmp_path):
    lake = lake_of_platforms(spark, tmp_path)
    before = lake.manifest()["tables"]["a_jobs"]
    runs = runs_of(spark).filter("platform <> 'c'").withColumn("status", F.when(F.col("platform") == "b", "blocked").otherwise(F.col("status")))
    assert lifecycle.lifecycle_run(lake, ["a", "b", "c"], runs, "r1", F.lit(NOW), dry_run=True) == "success"
    stats = {r["platform"]: (r["action_status"], r["soft_expired"], r["jobs_deleted"]) for r in lake.read("lifecycle_stats").collect()}
    assert stats == {"a": ("processed", 4, 1), "b": ("skipped_unhealthy", 0, 0), "c": ("skipped_no_recent_run", 0, 0)}
    assert lake.manifest()["tables"]["a_jobs"] == before
    assert lifecycle.lifecycle_run(lake, ["a"], runs.filter("platform = 'z'"), "r2", F.lit(NOW)) == "success" and lake.read("lifecycle_runs").count() == 2


def test_daily_states_follow_changes(spark, tmp_path):
    sf, as_of = "/root/testdata/sf0.001", F.lit(star.AS_OF).cast("timestamp")
    base = unify(star.jobs(spark, sf), star.details(spark, sf)).cache()
    lake = versions.Lake(spark, str(tmp_path))
    daily.create(lake)
    first = base.filter("job_id % 5 <> 0")
    daily.update(lake, first)

    def same(rows):
        plain = lambda df: sorted(map(tuple, df.collect()))
        assert plain(daily.monthly_trend(lake, as_of)) == plain(analytics.monthly_trend(rows, as_of))
        assert plain(daily.top_skills(lake, as_of)) == plain(analytics.top_skills(rows, as_of))
        want = analytics.kpis(rows, as_of).select("total_active_jobs", "remote_roles").first()
        assert tuple(daily.active(lake, as_of).first()) == tuple(want)

    same(first)
    moved = base.filter("job_id % 97 = 1 and job_id % 5 <> 0").limit(3).cache()
    later = moved.withColumns({"posted_at_utc": F.col("posted_at_utc") + F.expr("interval 3 days"), "last_seen_at": F.lit(dt.datetime(2001, 7, 20))})
    fresh = base.filter("job_id % 5 = 0").limit(2)
    update = later.unionByName(fresh).cache()
    state, read = lake.manifest(), []
    keep = versions.Lake.read

    def noted(self, name, buckets=None, state=None):
        read.append((name, buckets))
        return keep(self, name, buckets, state)

    versions.Lake.read = noted
    try:
        days = daily.update(lake, update)
    finally:
        versions.Lake.read = keep
    which = spark.createDataFrame([(d,) for d in days], "day date")
    assert 0 < len(days) < 30
    for name in ("facts", "states"):
        allowed = set(lake.buckets_of(name, which))
        assert all(b is not None and set(b) <= allowed for n, b in read if n == name)
        changed = {b for b, p in lake.manifest()["tables"][name]["parts"].items() if state["tables"][name]["parts"].get(b) != p}
        assert {int(b) for b in changed} <= allowed < set(range(128))
    same(first.join(update.select("platform", "job_id"), ["platform", "job_id"], "left_anti").unionByName(update))
    assert lake.read("numbers").groupBy("job_no").count().filter("count > 1").isEmpty()


@pytest.mark.parametrize("seed", range(3))
def test_cover_holds_the_box(spark, seed):
    rng = random.Random(seed)
    places = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)] + [(90.0, 180.0), (-90.0, -180.0), (48.1, 11.5)]
    rows = [(r["lat"], r["lon"], r["c"]) for r in spark.createDataFrame([(*p,) for p in places] + [(None, 1.0), (float("nan"), 1.0)], "lat double, lon double").withColumn("c", cells.cell(F.col("lat"), F.col("lon"))).collect()]
    assert [c for _, _, c in rows[-2:]] == [None, None]
    for _ in range(20):
        south, west = rng.uniform(-90, 80), rng.uniform(-180, 170)
        box = (south, west, south + rng.uniform(0, 10) ** 2 / 10, west + rng.uniform(0, 10))
        ranges = cells.cover(*box)
        assert len(ranges) <= 24 and all(a <= b for a, b in ranges)
        for lat, lon, c in rows[:-2]:
            if box[0] <= lat <= box[2] and box[1] <= lon <= box[3]:
                assert any(a <= c <= b for a, b in ranges)
    assert cells.cover(1, 1, 0, 2) == []


def test_box_reads_few_row_groups(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    rows = spark.range(60_000).select("id", (F.rand(1) * 20 + 40).alias("lat"), (F.rand(2) * 30 - 5).alias("lon"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias("pay"))
    path = str(tmp_path / "points")
    serving.store_by_cell(rows, path, files=16, group_bytes=128 << 10)
    stored, box = spark.read.parquet(path), (48.0, 11.3, 48.3, 11.8)
    ranges = cells.cover(*box)
    groups = hit = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index("cell")
        for g in range(meta.num_row_groups):
            st = meta.row_group(g).column(at).statistics
            groups += 1
            hit += any(a <= st.max and st.min <= b for a, b in ranges)
    assert groups >= 60 and hit < 0.1 * groups
    got = serving.in_box(stored, box)
    assert "PushedFilters: [Or" in got._jdf.queryExecution().toString() or "GreaterThanOrEqual(cell" in got._jdf.queryExecution().toString()
    assert got.count() == stored.filter(serving.inside(*box)).count() > 0


def test_pages_by_the_last_key(spark):
    rng = random.Random(4)
    data = [(rng.choice([None, 1, 2, 3]), rng.choice("ab"), i) for i in range(40)]
    rows = spark.createDataFrame(data, "n int, p string, i int")
    order, last, got = [("n", True), ("p", False), ("i", False)], None, []
    while page := serving.page_after(rows, order, last, 7).collect():
        got += [tuple(r) for r in page]
        last = got[-1]
    assert got == sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0), r[1], r[2]))


def test_checks_of_a_table_in_one_scan(spark, tmp_path):
    spark.createDataFrame([(1, "a", None), (1, "b", "x"), (2, "a", "y"), (3, None, None)], "id int, s string, t string").write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    got = reports.table_checks(rows, {"no_s": F.col("s").isNull(), "never": F.lit(False)}, ("twice", ["id"]))
    assert got._jdf.queryExecution().sparkPlan().toString().count("FileScan parquet") == 1
    assert {(r["name"], r["violations"], r["ok"]) for r in got.collect()} == {("no_s", 1, False), ("never", 0, True), ("twice", 1, False)}
    assert {r["violations"] for r in reports.table_checks(rows.limit(0), {"no_s": F.col("s").isNull()}, ("twice", ["id"])).collect()} == {0}


def test_counts_while_a_log_is_read(spark, tmp_path):
    lines = [json.dumps({"record_type": "job_detail", "job_id": "a"}), json.dumps({"record_type": "job_detail", "job_id": ""}), "", '{"record_type": "job_disc', json.dumps({"record_type": "page_fetch"})]
    (tmp_path / "log.jsonl").write_text("\n".join(lines))
    rows, seen = logs.counted_log(spark, str(tmp_path / "log.jsonl"))
    assert rows.count() == 3 and seen.get == {"kept": 3, "skipped": 1, "nameless": 1}


def test_a_written_log_stays_near_the_size_of_its_input(spark, monkeypatch):
    """A line of some 300 bytes was written as it is: 52 GB of text for 4 GB of line items. With more files than a batch takes, each job's lines are still in one batch."""
    where = "/root/testdata/sf0.001"
    size = lambda path: [f.stat().st_size for f in Path(path.removeprefix("file://")).glob("part-*")]
    files, lines = size(queries_state._written_log(spark, where)), spark.read.parquet(f"{where}/lineitem.parquet").count()
    assert len(files) <= 4 and sum(files) < 60 * lines, sum(files) / lines
    want = collections.Counter(map(tuple, queries_state.imported_log(spark, where).collect()))
    monkeypatch.setattr(queries_state, "FILE_LINES", 50)
    assert len(size(queries_state._written_log(spark, where, files=3))) > 100
    assert collections.Counter(map(tuple, queries_state.streamed_log(spark, where).collect())) == want


def test_search_addresses(spark):
    one = spark.range(1)
    lit = F.lit
    value = lambda c: one.select(c).first()[0]
    facets = F.create_map(lit("f_TPR"), F.array(lit("r86400")), lit("f_JT"), F.array(lit("F"), lit("P")))
    assert value(urls.paged_search_url("https://l.org/search", lit("data & ai"), lit("Berlin, DE"), lit("103"), lit(25), facets)) == "https://l.org/search?keywords=data+%26+ai&location=Berlin%2C+DE&geoId=103&start=25&f_TPR=r86400&f_JT=F&f_JT=P"
    made = lambda *a: value(urls.slugged_search_url("https://s.de/", *map(lit, a)))
    assert made("Data Engineer/in", "Köln", 30, "newest", None, 1) == "https://s.de/jobs/data-engineer-in/in-köln?radius=30&sort=2&searchOrigin=Resultlist_top-search&whereType=autosuggest&action=sort_publish"
    assert made("ﬁnance", "Ulm", 10, "1", "7", 1).endswith("/jobs/finance/in-ulm?radius=10&sort=1&searchOrigin=Resultlist_top-search&whereType=autosuggest&ag=age_7&action=facet_selected%3Bage%3Bage_7")
    assert made("bi", "Ulm", 10, "2", "1", 3).endswith("&page=3&ag=age_1&action=paging_next")
    with pytest.raises(Exception, match="keywords are empty"):
        made(" ", "Ulm", 10, "2", None, 1)
    assert value(urls.keyword_search_url("https://x.com/ki", lit(" a*b~c "), lit(" "), lit("2.9"), lit(None).cast("string"))) == "https://x.com/ki?keywords=a%2Ab~c&cityId=2.9"
    assert value(intake.url_slug(lit("Ｄａｔａ  Ops/Müller"))) == "data-ops-müller"


def test_integrity_check_rows(spark):
    cases = [("1", "success", "schedule", "r", "success", "schedule", 0, 0), ("2", "success", "schedule", "", None, None, 2, 0), ("3", "Failure ", None, None, None, None, 0, 1), ("4", "odd", None, None, None, None, 0, 0), ("5", "success", "schedule", "r", "running", "manual", 0, 0)]
    rows = spark.createDataFrame(cases, "case_id string, outcome string, expected_trigger string, crawl_run_id string, row_status string, row_trigger string, stale int, lingering int")
    got = {(r["case_id"], r["name"]): (r["ok"], r["detail"]) for r in searches.integrity_checks(rows).collect()}
    assert got["1", "success_trigger_matches"] == (True, "db_trigger=schedule expected=schedule") and got["2", "success_row_exists"] == (False, "found_row=0") and ("2", "success_row_terminal_status") not in got
    assert got["3", "non_success_has_no_lingering_running_rows"] == (False, "lingering_running_count=1") and got["4", "supported_run_step_outcome"][0] is False and got["5", "success_row_terminal_status"] == (False, "db_status=running")
    failed = {(c, n) for (c, n), (ok, _) in got.items() if not ok}
    assert {c for c, _ in failed} == {r["case_id"] for r in searches.integrity(rows).collect()}


def test_backlog_progress(spark):
    rows = spark.createDataFrame([("a", 1, 10), ("a", 2, 4), ("a", 3, 4), ("b", 1, 0)], "platform string, batch int, remaining int")
    assert sorted(map(tuple, reports.backlog_progress(rows, "platform").collect())) == [("a", 1, 10, None, True), ("a", 2, 4, 6, True), ("a", 3, 4, 0, False), ("b", 1, 0, None, False)]


DICTIONARY = """
version: 3
groups:
  languages:
    - canonical: Go
      aliases: {en: ["go", "golang"], de: ["golang"]}
    - canonical: C#
      aliases: ["c#", ".net"]
  platforms:
    - canonical: Data Lake
      aliases:
        en: ["data lake", "lakehouse"]
"""


def test_dictionary_from_its_file(spark, tmp_path):
    (tmp_path / "d.yaml").write_text(DICTIONARY)
    version, rows = taxonomy.load(spark, str(tmp_path / "d.yaml"))
    assert version == 3 and taxonomy.dictionary_table(spark, rows).filter("alias = 'golang'").count() == 1 and ("languages", 0, "Go", 0, "go") not in rows
    texts = [(1, "We GO with Golang, c# and .NET"), (2, "a data\n lakehouse? no: DATA   LAKE!"), (3, "golangs xc# datalake"), (4, None), (5, "ｇｏｌａｎｇ"), (6, "x.net 1c#")]
    got = {r["i"]: r["skills"] for r in taxonomy.grouped_skills(spark.createDataFrame(texts, "i int, text string"), rows).collect()}
    assert got[1] == {"languages": ["Go", "C#"]} and got[2] == {"platforms": ["Data Lake"]} and got[3] == {} and got[4] == {} and got[5] == {"languages": ["Go"]} and got[6] == {}
    for bad in ("version: 1\ngroups: []", "version: x\ngroups: {}", 'version: 1\ngroups: {g: [{canonical: A, aliases: "a"}]}', "version: 1\ngroups: {g: [{canonical: A, aliases: {en: [1]}}]}"):
        (tmp_path / "bad.yaml").write_text(bad)
        with pytest.raises(ValueError):
            taxonomy.load(spark, str(tmp_path / "bad.yaml"))
