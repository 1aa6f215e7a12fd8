"""Relative posting times."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postlake.functions import posted
from postlake.plans.unified import unify

AT = dt.datetime(2024, 3, 31, 12)


def moved(spark, rows):
    df = spark.createDataFrame([(i, t, AT) for i, t in enumerate(rows)], "i int, t string, at timestamp")
    df = df.withColumn("n", posted.normalized(F.col("t")))
    out = df.select("i", posted.back_from(F.col("at"), F.col("n"), posted.amount(F.col("n")), posted.unit(F.col("n"))).alias("v"))
    return [r["v"] for r in out.orderBy("i").collect()]


def test_relative_times_in_both_languages(spark):
    got = moved(spark, ["3 days ago", "1 month ago", "vor 2 Wochen", "vor 1 Tag", "Published: 5 hours ago", "Heute", "yesterday", "just now", "", None, "über 30 Tage", "2 years ago"])
    ago = lambda **d: AT - dt.timedelta(**d)
    assert got[:8] == [ago(days=3), dt.datetime(2024, 2, 29, 12), ago(days=14), ago(days=1), ago(hours=5), AT, ago(days=1), AT]
    assert got[8:11] == [None, None, None]
    assert got[11] == dt.datetime(2022, 3, 31, 12)


def test_number_too_large_is_unparsed_not_an_error(spark):
    assert moved(spark, ["99999999999999 days ago"]) == [None]


@pytest.mark.parametrize(("platform", "native", "text", "source"), [("xing", AT, "3 days ago", "native_xing_posted_at_utc"), ("linkedin", AT, "3 days ago", "parsed_relative_en"), ("xing", None, "vor 2 Tagen", "parsed_relative_de"), ("stepstone", None, " ", "missing_input"), ("stepstone", None, "soon", "unparsed_format"), ("stepstone", None, "gestern", "parsed_keyword")])
def test_source(spark, platform, native, text, source):
    jobs = spark.createDataFrame([(platform, "1", AT)], "platform string, job_id string, first_seen_at timestamp")
    details = spark.createDataFrame([(platform, "1", AT, text, native)], "platform string, job_id string, scraped_at timestamp, posted_time_ago string, native_posted_at_utc timestamp")
    row = unify(jobs, details).first()
    assert row["posted_at_source"] == source
    assert row["posted_at_parse_ok"] == (source not in ("missing_input", "unparsed_format"))
