"""The folder that driver and executors share, for tables that a query writes and reads again."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the one that spark.checkpoint.dir names. Where that is unset, under a local one if all of Spark runs in one process (tests); elsewhere it is an error."""
    where = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix="postlake-")
        where = _OWN[app]
    return f"{where.rstrip('/')}/{name}-{uuid.uuid4().hex}"
