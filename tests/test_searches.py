"""Searches and ingest scalars."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postlake.functions import intake
from postlake.operators import searches

NOW = dt.datetime(2024, 1, 31)


def values(spark, rows, *columns):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v string")
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in df.select("i", *[c(F.col("v")) for c in columns]).orderBy("i").collect()]


def test_scalars(spark):
    assert values(spark, ["2024-01-31T00:00:00Z", "x", None], intake.parse_time) == [NOW, None, None]
    assert values(spark, ['{"a":1}', "[1]", "x", None], intake.criteria_or_empty) == ['{"a":1}', "{}", "{}", "{}"]
    assert values(spark, ["Data / ML  Größe!", " ", None, "--a--"], intake.url_slug) == ["data-ml-größe", "", "", "a"]
    assert values(spark, ["newest", "Relevance", None], intake.sort_code) == [2, 1, None]
    assert values(spark, ["age_7", "1"], intake.age_days_code) == [7, 1]
    with pytest.raises(Exception, match="unknown sort"):
        values(spark, ["other"], intake.sort_code)
    flags = spark.createDataFrame([("Vollzeit, Homeoffice",), (None,), ("Part Time",)], "w string").select(*[c.alias(n) for n, c in intake.work_flags(F.col("w")).items()]).collect()
    assert [tuple(f) for f in flags] == [(True, True, False), (False, False, False), (False, False, True)]


def test_status_and_error(spark):
    df = spark.createDataFrame([("success", None), ("blocked", "failed"), (None, "blocked"), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(intake.run_status(F.col("a"), F.col("b"))).collect()] == ["success", "failed", "blocked", "success"]
    df = spark.createDataFrame([("", True), ("x", True), (None, False)], "e string, b boolean")
    assert [r[0] for r in df.select(intake.detail_error(F.col("e"), F.col("b"))).collect()] == ["blocked", "x", None]


def test_facets(spark):
    df = spark.createDataFrame([({"a": None, "f_TPR": "", "f_JT": "F"},)], "f map<string,string>")
    assert df.select(intake.clean_facets(F.col("f"))).first()[0] == {"f_JT": "F"}
    asked = spark.createDataFrame([(1, "f_TPR", ["Past  week", "r86400", "never"]), (1, "f_JT", ["F", "full-time", " "])], "search int, facet string, labels array<string>")
    options = spark.createDataFrame([("f_TPR", "past week", "r604800"), ("f_JT", "Full-time", "F")], "facet string, label string, value string")
    got = sorted((r["facet"], r["pos"], r["value"], r["unknown"]) for r in searches.resolve_facets(asked, options).collect())
    assert got == [("f_JT", 0, "F", None), ("f_JT", 1, "F", None), ("f_TPR", 0, "r604800", None), ("f_TPR", 1, "r86400", None), ("f_TPR", 2, None, "never")]


def test_best_place(spark):
    hits = spark.createDataFrame([("q", 0, "1", "Berlin, US"), ("q", 1, "2", "Berlin, Germany "), ("r", 0, "3", "Bonn")], "query string, pos int, id string, display_name string")
    assert sorted(r["id"] for r in searches.best_place(hits, "germany").collect()) == ["2", "3"]
    assert sorted(r["id"] for r in searches.best_place(hits, None).collect()) == ["1", "3"]


def test_age_days(spark):
    rows = [("a", "running", None), ("b", "success", NOW - dt.timedelta(hours=3)), ("c", "success", NOW - dt.timedelta(hours=50)), ("d", "failed", NOW)]
    got = {r["platform"]: r["age_days"] for r in searches.age_days(spark.createDataFrame(rows, "platform string, status string, finished_at timestamp"), F.lit(NOW)).collect()}
    assert got == {"a": None, "b": 1, "c": 7, "d": 7}


def test_page_budget(spark):
    rows = [(1, "a", 0, 0), (1, "b", 0, 1), (1, "a", 1, 2), (1, "b", 2, 3), (1, "c", 3, 4), (2, "x", 0, 5), (2, "x", 1, 6), (2, "y", 2, 7)]
    found = spark.createDataFrame(rows, "s int, job_id string, page int, seq int")
    assert sorted((r["s"], r["job_id"]) for r in searches.page_budget(found, "s", "page", "seq", 10, 2).collect()) == [(1, "a"), (1, "b"), (2, "x"), (2, "y")]
    assert searches.page_budget(found, "s", "page", "seq", 1, 9).count() == 2


def test_external_previews(spark):
    jobs = spark.createDataFrame([("x", "1", True, {"job_title": "T"}), ("x", "2", True, {}), ("x", "3", False, {"job_title": "T"})], "platform string, job_id string, is_external boolean, list_preview map<string,string>")
    assert sorted((r["job_id"], r["parse_ok"], r["last_error"]) for r in searches.preview_details(jobs, F.lit(NOW)).collect()) == [("1", True, None), ("2", False, "missing_list_preview_fields")]


def test_run_records(spark):
    runs = spark.createDataFrame([], "run_id string, platform string, trigger string, status string, started_at timestamp, finished_at timestamp, stats string, error string")
    opened = searches.open_run(runs, "r1", "x", "manual", F.lit(NOW))
    done = searches.finish_run(opened, "r1", "success", F.lit(NOW), '{"details":{"status":"blocked"}}')
    assert opened.first()["status"] == "running" and done.first()["status"] == "success"
    assert tuple(searches.step_outcomes(done).first()) == ("x", 1, 0)


def test_integrity(spark):
    rows = [(1, "success", "t", "id", "success", "t", 0, 0), (2, "success", "t", "", None, None, 1, 0), (3, "success", "t", "id", "running", "u", 0, 0), (4, "failure", "t", None, None, None, 0, 2), (5, "odd", None, None, None, None, 0, 0)]
    df = spark.createDataFrame(rows, "case_id int, outcome string, expected_trigger string, crawl_run_id string, row_status string, row_trigger string, stale int, lingering int")
    got = sorted(tuple(r) for r in searches.integrity(df).collect())
    assert got == [(2, "missing_crawl_row"), (2, "missing_crawl_run_id"), (2, "stale_rows_remain"), (3, "non_terminal_crawl_row"), (3, "trigger_mismatch"), (4, "lingering_running_after_non_success"), (5, "unsupported_run_step_outcome")]


def test_expected_trigger(spark):
    ext = spark.createDataFrame([("w", " Schedule "), ("w", "push")], "workflow string, event string")
    table = spark.createDataFrame([("w", "schedule", "s1")], "workflow string, event string, trigger string")
    assert sorted((r["event"], r["trigger"]) for r in searches.expected_trigger(ext, table).collect()) == [("push", None), ("schedule", "s1")]


def test_expected_trigger_of_a_large_table(spark):
    table = spark.range(10_500).select(F.concat(F.lit("w"), "id").alias("workflow"), F.lit("push").alias("event"), F.col("id").cast("string").alias("trigger"))
    got = searches.expected_trigger(table.select("workflow", "event"), table)
    assert got.count() == 10_500 and got.filter("trigger is null").count() == 0
