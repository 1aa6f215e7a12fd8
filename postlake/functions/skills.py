"""Skills: JSON of group -> list, and matching of a dictionary in texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def skill_values(extracted: Column) -> Column:
    """All entries of the list-valued groups of a JSON object, in order; groups that are no list are skipped one by one."""
    variant = F.try_parse_json(extracted)
    as_map = F.try_variant_get(variant, "$", "map<string,variant>")
    lists = F.filter(F.coalesce(F.map_values(as_map), F.array().cast("array<variant>")), lambda v: F.schema_of_variant(v).startswith("ARRAY"))
    return F.flatten(F.transform(lists, lambda v: F.coalesce(F.try_variant_get(v, "$", "array<string>"), F.array().cast("array<string>"))))


def flat_skills(extracted: Column, most: int = 10) -> Column:
    """Trimmed, distinct, in order, at most `most`."""
    trimmed = F.transform(skill_values(extracted), lambda s: F.trim(s))
    return F.slice(F.array_distinct(F.filter(trimmed, lambda s: s.isNotNull() & (s != ""))), 1, most)
