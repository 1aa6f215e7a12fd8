"""Durable intermediate tables in the folder that the cluster shares, and components of a link table."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_OWN: dict[str, str] = {}
#: Arrow batches while a table is written: rows and bytes that a JVM task and its Python worker hold at once beside the longest row.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset, a new local one for each application if all of Spark runs in one
    process (tests); elsewhere other machines would not see such a folder, so that is an error."""
    where = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="postlake-")
        where = _OWN[app]
    return where.rstrip("/")


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with other settings for a while."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: the lineage is cut, a lost executor loses nothing."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with settings(df.sparkSession, BATCHES):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """df as a side of a join that Spark shuffles and never broadcasts by its own guess. It takes the bytes of compressed files for those of the rows,
    and for what a map or an explode makes of a row it counts one row."""
    return df.hint("merge")


def components(links: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Connected components of undirected links: (id, component), component = smallest id reachable.

    Alternating large-star and small-star rounds: every round is a grouped minimum (combined before the shuffle) joined
    back to the links, so a hub with very many links is never gathered in one task. Only nodes with a link are returned;
    null ends and self links are ignored. A few rounds suffice (logarithmic in the longest chain); each is written out.
    """
    a, b = F.col(src).cast("long"), F.col(dst).cast("long")
    edges = links.select(F.greatest(a, b).alias("src"), F.least(a, b).alias("dst")).filter("src > dst").distinct()
    edges = keep(edges, "links")
    while not _is_forest_of_stars(edges):
        both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.min("dst").alias("low")).select("src", F.least("src", "low").alias("low"))
        large = both.filter("dst > src").join(shuffled(low), "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        large = large.filter("src > dst").distinct()
        low = large.groupBy("src").agg(F.min("dst").alias("low"))
        moved = large.join(shuffled(low), "src").filter("dst > low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
        edges = keep(moved.unionByName(low.select("src", F.col("low").alias("dst"))).distinct(), "links")
    roots = edges.select(F.col("dst").alias("id"), F.col("dst").alias("component")).distinct()
    return edges.select(F.col("src").alias("id"), F.col("dst").alias("component")).unionByName(roots)


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every node points at one smaller node that points at none: as a source it has one link, as an end it is no source."""
    ends = edges.select(F.col("src").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(edges.select(F.col("dst").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    bad = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("into").alias("into")).filter("out > 1 or (out = 1 and into = 1)")
    return bad.isEmpty()
