"""Stored read models, recomputed wholesale in the order of their dependencies, and their public names."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from postlake.sources import versions


def refresh(spark: SparkSession, root: str, steps: list[tuple[str, Callable[[dict[str, DataFrame]], DataFrame], list[str]]]) -> list[str]:
    """Runs (name, function of the tables made so far, sort columns) in order and stores all of them as one new version under root; a failing step leaves the
    old one. Steps that name what they read, and so run only when that changed, are for `versions.refresh`."""
    before = lambda i: [n for n, _, _ in steps[:i]]
    named = [(name, step, before(i), order) for i, (name, step, order) in enumerate(steps)]
    return versions.refresh(versions.Lake(spark, root), {}, named, version=uuid.uuid4().hex)


def publish(tables: dict[str, DataFrame]) -> list[str]:
    """Registers tables as views under public names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)
