"""Locations, points, bubbles."""

from postlake.functions import skills
from postlake.functions.locations import BOX, initcap_words
from postlake.plans import places
from pyspark.sql import functions as F


def candidates(spark, *rows):
    df = spark.createDataFrame([(p, str(i), loc, h, w) for i, (p, loc, h, w) in enumerate(rows)], "platform string, job_id string, job_location string, homeoffice_possible boolean, work_model string")
    out = {}
    for r in places.location_candidates(df).collect():
        out.setdefault(int(r["job_id"]), []).append((r["token_kind"], r["city_token_idx"], r["city_token_norm"], r["map_locations_total"], r["map_locations_used"]))
    return {k: sorted(v, key=lambda t: (t[0], t[1] or 0)) for k, v in out.items()}


def test_tokens(spark):
    twelve = "Aachen, Bonn, Celle, Dresden, Essen, Fulda, Gera, Halle, Ingolstadt, Jena, Kassel, Leipzig"
    got = candidates(spark, ("linkedin", "Berlin, Hamburg / München", None, None), ("linkedin", "Bavaria, Germany", None, None), ("linkedin", "Munich, Bavaria, Germany", None, None), ("linkedin", "A, Berlin, berlin", None, None), ("linkedin", twelve, None, None), ("linkedin", "", None, None), ("linkedin", None, None, None))
    assert [t[2] for t in got[0]] == ["berlin", "hamburg", "münchen"]
    assert [t[2] for t in got[1]] == ["bavaria"]
    assert got[2] == [("city", 1, "munich", 2, 2)]  # the region is dropped but counted
    assert [t[2] for t in got[3]] == ["berlin"]
    assert [t[1] for t in got[4]] == list(range(1, 11)) and got[4][0][3:] == (12, 10)
    assert 5 not in got and 6 not in got


def test_remote(spark):
    got = candidates(spark, ("linkedin", "Berlin (Hybrid)", None, None), ("linkedin", "Remote", None, None), ("linkedin", "Berlin Hybrid", None, None), ("stepstone", None, True, None), ("xing", "Bonn", None, "Remote"), ("xing", "Bonn", None, None), ("linkedin", "Bonn", True, "Remote"))
    assert [t[0] for t in got[0]] == ["city", "remote"] and got[0][0][2] == "berlin"
    assert [t[0] for t in got[1]] == ["remote"] and [t[0] for t in got[3]] == ["remote"]
    assert [t[0] for t in got[2]] == ["city", "remote"]
    assert [t[0] for t in got[4]] == ["city", "remote"]
    assert [t[0] for t in got[5]] == ["city"] and [t[0] for t in got[6]] == ["city"]


def test_weights_and_scatter(spark):
    from postlake.sources import star

    base = spark.createDataFrame([("linkedin", "1", "Berlin, Hamburg remote", None, None, None, None, None)], "platform string, job_id string, job_location string, homeoffice_possible boolean, work_model string, posted_at_utc timestamp, first_seen_at timestamp, extracted_skills string").withColumn("company_name", F.lit("x"))
    pts = places.map_points(base, places.location_candidates(base), star.geocodes(spark, "/root/testdata/sf0.001")).collect()
    assert abs(sum(p["map_weight"] for p in pts) - 1) < 1e-9
    remote = next(p for p in pts if p["token_kind"] == "remote")
    south, north, west, east = BOX
    assert south <= remote["lat"] <= north and west <= remote["lon"] <= east


def test_initcap_after_hyphen(spark):
    assert spark.range(1).select(initcap_words(F.lit("garmisch-partenkirchen am ölberg"))).first()[0] == "Garmisch-Partenkirchen Am Ölberg"


def test_skill_json(spark):
    rows = ['{"languages":["Python","SQL"]}', '{"languages":["Python"],"note":"x"}', '{"a":[" ","SQL "]}', "{}", None, "broken"]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, s string")
    assert [r["v"] for r in df.orderBy("i").select(skills.flat_skills(F.col("s")).alias("v")).collect()] == [["Python", "SQL"], ["Python"], ["SQL"], [], [], []]
