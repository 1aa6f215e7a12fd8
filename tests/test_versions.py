"""Versioned tables: published as a whole, changed bucket by bucket, each batch of a stream once."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from postlake.operators import ingest
from postlake.sources import logs, versions
from postlake.streaming.ingest import apply_log, import_stream

NOW = dt.datetime(2026, 2, 1, 12)


def files(root):
    return {os.path.join(d, n) for d, _, names in os.walk(root) for n in names if n.endswith(".parquet")}


def size(paths):
    return sum(os.path.getsize(p) for p in paths)


def test_upsert_rewrites_only_its_buckets(spark, tmp_path):
    lake = versions.Lake(spark, str(tmp_path / "lake"))
    rows = spark.range(20_000).select("id", F.concat(F.lit("v"), F.col("id").cast("string"), F.sha2(F.col("id").cast("string"), 256)).alias("v"))
    with lake.change() as now:
        now.put("t", rows, keys=["id"], buckets=100)
    before = files(tmp_path)
    updates = spark.createDataFrame([(7, "new"), (50_000, "added")], "id long, v string")
    with lake.change() as now:
        hit = now.upsert("t", updates)
    assert 1 <= len(hit) <= 2
    written = files(tmp_path) - before
    assert size(written) < 0.03 * size(before)
    got = lake.read("t")
    assert got.count() == 20_001 and {r["v"] for r in got.filter("id in (7, 50000)").collect()} == {"new", "added"}
    untouched = [b for b in range(100) if b not in hit]
    plan = lake.read("t", hit)._jdf.queryExecution().toString()
    assert not any(f"_bucket={b}/" in plan for b in untouched)
    assert lake.read("t", state=lake.manifest(1)).filter("v = 'new'").count() == 0  # the older version is still there


def test_failure_leaves_the_old_version(spark, tmp_path):
    lake = versions.Lake(spark, str(tmp_path / "lake"))
    source = str(tmp_path / "source")
    spark.range(10).write.parquet(source)
    steps = [("a", lambda t: t["s"].filter("id > 2"), ["s"], ["id"]), ("b", lambda t: t["a"].agg(F.sum("id").alias("n")), ["a"], []), ("c", lambda t: t["s"].agg(F.count("*").alias("n")), ["s"], [])]
    assert versions.refresh(lake, {"s": source}, steps) == ["a", "b", "c"]
    before = files(tmp_path), lake.manifest()
    assert versions.refresh(lake, {"s": source}, steps) == [] and (files(tmp_path), lake.manifest()) == before  # nothing changed, nothing written

    def broken(t):
        raise ValueError("no")

    spark.range(100, 110).write.mode("append").parquet(source)
    with pytest.raises(ValueError):
        versions.refresh(lake, {"s": source}, [*steps[:2], ("c", broken, ["s"], [])])
    assert lake.manifest() == before[1] and lake.read("a").count() == 7 and lake.read("b").first()["n"] == 42
    assert versions.refresh(lake, {"s": source}, steps) == ["a", "b", "c"] and lake.read("a").count() == 17
    lake.publish()
    assert spark.table("c").first()["n"] == 20


def test_two_writers(spark, tmp_path):
    lake = versions.Lake(spark, str(tmp_path / "lake"))
    with lake.change() as first:
        first.put("a", spark.range(1))
        with lake.change() as second:
            second.put("b", spark.range(2))
    assert sorted(lake.manifest()["tables"]) == ["a", "b"] and lake.manifest()["number"] == 2
    with pytest.raises(RuntimeError):
        with lake.change() as first:
            first.put("a", spark.range(3))
            with lake.change() as second:
                second.put("a", spark.range(4))
    assert lake.read("a").count() == 4


def test_tables_of_no_rows(spark, tmp_path):
    lake = versions.Lake(spark, str(tmp_path / "lake"))
    with lake.change() as now:
        now.put("t", spark.range(0), keys=["id"], buckets=4)
    assert lake.read("t").count() == 0
    with lake.change() as now:
        assert now.upsert("t", spark.range(0)) == []
        now.upsert("t", spark.range(3))
    assert lake.read("t").count() == 3


JOBS = "platform string, job_id string, job_url string, first_seen_at timestamp, last_seen_at timestamp, is_active boolean, stale_since_at timestamp, expired_at timestamp, expire_reason string"
HITS = "search_run_id string, platform string, job_id string, rank int, page_start int, scraped_at timestamp"
DETAILS = "platform string, job_id string, scraped_at timestamp, parse_ok boolean, last_error string, job_title string"


def line(kind, job, minute, **more):
    return json.dumps({"record_type": kind, "source": "x", "job_id": job, "search_run_id": "1", "scraped_at": f"2026-02-01T10:{minute:02d}:00Z"} | more)


def tables(spark):
    jobs = [("x", "j0", "u", NOW, NOW, False, NOW, None, None), ("x", "j9", "u", NOW, NOW, True, None, None, None)]
    return {"jobs": (spark.createDataFrame(jobs, JOBS), ["platform", "job_id"]), "hits": (spark.createDataFrame([], HITS), ["search_run_id", "platform", "job_id"]), "details": (spark.createDataFrame([], DETAILS), ["platform", "job_id"])}


def lake_of(spark, root):
    lake = versions.Lake(spark, str(root))
    with lake.change() as now:
        for name, (rows, keys) in tables(spark).items():
            now.put(name, rows, keys=keys, buckets=8)
    return lake


def shown(lake):
    return {n: sorted(map(str, lake.read(n).collect())) for n in ("jobs", "hits", "details")}


def test_stream_equals_batch_also_after_a_crash(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(4):
        lines = [line("job_discovered", f"j{i}", i, job_url=f"u{i}", rank=i), line("job_discovered", "j1", 10 + i, job_url=f"again{i}"), line("job_detail", "j1", 20 + i, parse_ok=i % 2 == 0, last_error=None if i % 2 == 0 else "http_410", job_title=f"t{i}"), '{"record_type": "job_disc', line("job_detail", "", 1)]
        (folder / f"{i}.jsonl").write_text("\n".join(lines))
        os.utime(folder / f"{i}.jsonl", (1_700_000_000 + i, 1_700_000_000 + i))
    batch = lake_of(spark, tmp_path / "batch")
    with batch.change() as now:
        log = logs.read_log(spark, str(folder))
        details = [c.split()[0] for c in DETAILS.split(", ")]
        apply_log(now, log)
    lake, calls = lake_of(spark, tmp_path / "lake"), []

    def crashing(now, rows):
        apply_log(now, rows)
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("stopped between write and publish")

    with pytest.raises(Exception):
        import_stream(lake, str(folder), str(tmp_path / "cp"), apply=crashing, max_files=1).awaitTermination(120)
    half = lake.manifest()
    assert half["batches"]["log"] == 0 and lake.read("details").first()["job_title"] == "t0"
    import_stream(lake, str(folder), str(tmp_path / "cp"), max_files=1).awaitTermination(120)
    assert shown(lake) == shown(batch) and lake.manifest()["batches"]["log"] == 3
    done = lake.manifest()
    seq = F.struct(F.lit("f").alias("file"), F.lit(0).cast("long").alias("block"), F.monotonically_increasing_id().alias("line"))
    assert not lake.apply_batch("log", logs.read_log(spark, str(folder)).withColumn("seq", seq), 3, apply_log) and lake.manifest() == done  # a batch that comes again
    assert details and ingest.KEY == ["platform", "job_id"]
