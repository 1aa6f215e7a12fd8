"""Keyed writes as functions of two tables: what the target holds afterwards.

Updates are first reduced to one row a key by partial aggregation, so a hot key costs no more than another, and then joined once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _reduced(rows: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("_r")).select(*keys, "_r.*")


def last_by_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is last in the order; ties must be ruled out by the order."""
    return _reduced(rows, keys, order, F.max_by)


def first_by_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _reduced(rows, keys, order, F.min_by)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], changes: dict[str, Column] | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """target after inserting updates, rows with a known key changed instead.

    updates hold one row a key, or `order` says which of several is last. Without changes an update replaces every column it has; with
    changes only those named, as expressions over `t.<column>` and `u.<column>`. A new key takes the update's columns.
    """
    if order:
        updates = last_by_key(updates, keys, order)
    both = target.withColumn("_t", F.lit(True)).alias("t").join(updates.withColumn("_u", F.lit(True)).alias("u"), list(keys), "full_outer")
    known, new = F.col("t._t").isNotNull(), F.col("u._u").isNotNull()
    out = []
    for name in target.columns:
        if name in keys:
            out.append(F.col(name))
        elif name in updates.columns or (changes and name in changes):
            fresh = F.col(f"u.{name}") if name in updates.columns else F.lit(None)
            changed = (changes or {}).get(name, F.col(f"u.{name}") if changes is None else F.col(f"t.{name}"))
            out.append(F.when(known & new, changed).when(known, F.col(f"t.{name}")).otherwise(fresh).alias(name))
        else:
            out.append(F.col(f"t.{name}"))
    return both.select(*out)


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """target and the first row of every key that it lacks."""
    fresh = first_by_key(rows, keys, order).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def update_where(target: DataFrame, condition: Column, changes: dict[str, Column]) -> DataFrame:
    """target with columns changed where the condition is true."""
    hit = F.coalesce(condition, F.lit(False))
    return target.withColumns({name: F.when(hit, value).otherwise(F.col(name)) for name, value in changes.items()})


def migrate(shared: dict[str, DataFrame], platform: str) -> dict[str, DataFrame]:
    """One platform's rows of shared tables, each without the ones whose parent is missing: hits and details of no job go."""
    own = {name: df.filter(F.col("platform") == platform) for name, df in shared.items()}
    for child in ("hits", "details"):
        if child in own:
            own[child] = own[child].join(own["jobs"].select("platform", "job_id"), ["platform", "job_id"], "left_semi")
    return own


def migrate_runs(runs: DataFrame, search_runs: DataFrame, definitions: DataFrame, platform: str) -> dict[str, DataFrame]:
    """One platform's definitions, the search runs of these, and the crawl runs that have one: nothing in a shared run names its platform."""
    own = definitions.filter(F.col("source") == platform)
    searched = search_runs.join(own.select("search_definition_id"), "search_definition_id", "left_semi")
    crawled = runs.join(searched.select(F.col("crawl_run_id").alias("run_id")), "run_id", "left_semi")
    return {"definitions": own, "search_runs": searched, "runs": crawled}


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rows) of each."""
    parts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
