"""Scalars of the ingest side."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The words that name a kind of work in German and English.
WORK_WORDS = {"homeoffice_possible": ("homeoffice", "home office"), "full_time": ("vollzeit", "full time"), "part_time": ("teilzeit", "part time")}
CRITERIA_LABELS = {
    "seniority level": "seniority_level", "employment type": "employment_type", "job function": "job_function", "industries": "industries",
    "karrierestufe": "seniority_level", "beschäftigungsverhältnis": "employment_type", "taetigkeitsbereich": "job_function", "tätigkeitsbereich": "job_function", "branchen": "industries",
}
TERMINAL = ("success", "blocked", "failed")


def parse_time(text: Column) -> Column:
    """ISO-8601 with Z or an offset; null if it is none."""
    return F.try_to_timestamp(text)


def criteria_or_empty(criteria: Column) -> Column:
    """The JSON text if it is an object, else an empty object."""
    return F.when(F.coalesce(F.schema_of_variant(F.try_parse_json(criteria)).startswith("OBJECT"), F.lit(False)), criteria).otherwise("{}")


def work_flags(work_type: Column) -> dict[str, Column]:
    """Three booleans; a missing work type says no to all."""
    low = F.lower(F.coalesce(work_type, F.lit("")))
    return {name: low.contains(words[0]) | low.contains(words[1]) for name, words in WORK_WORDS.items()}


def detail_error(last_error: Column, blocked: Column) -> Column:
    return F.coalesce(F.nullif(last_error, F.lit("")), F.when(blocked, "blocked"))


def run_status(discovery: Column, details: Column) -> Column:
    """failed before blocked before success, over both steps."""
    any_is = lambda s: F.coalesce(discovery == s, F.lit(False)) | F.coalesce(details == s, F.lit(False))
    return F.when(any_is("failed"), "failed").when(any_is("blocked"), "blocked").otherwise("success")


@F.pandas_udf(T.StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: unicodedata.normalize("NFKC", t), na_action="ignore")


def nfkc(text: Column) -> Column:
    """Compatibility characters as their plain forms, composed; Python only sees texts with a character outside ASCII."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), _nfkc(F.when(text.rlike(r"[^\x00-\x7F]"), text))).otherwise(text)


def url_slug(text: Column) -> Column:
    """NFKC, lower case, '-' for slashes, spaces and other characters; letters with marks of the Latin blocks stay."""
    low = F.regexp_replace(F.lower(F.trim(nfkc(F.coalesce(text, F.lit(""))))), r"[/\s]+|[^0-9a-zÀ-ɏ-]", "-")
    return F.regexp_replace(F.regexp_replace(low, "-+", "-"), "^-|-$", "")


def sort_code(label: Column) -> Column:
    """1 by relevance, 2 by date; anything else is an error."""
    low = F.lower(F.trim(label))
    known = F.when(low.isin("1", "relevance", "relevant", "sort_relevance"), 1).when(low.isin("2", "newest", "date", "publish", "published", "sort_publish"), 2)
    return F.when(label.isNotNull() & known.isNull(), F.raise_error(F.concat(F.lit("unknown sort: "), label)).cast("int")).otherwise(known)


def age_days_code(label: Column) -> Column:
    low = F.lower(F.trim(label))
    known = F.when(low.isin("1", "age_1"), 1).when(low.isin("7", "age_7"), 7)
    return F.when(label.isNotNull() & known.isNull(), F.raise_error(F.concat(F.lit("unknown age: "), label)).cast("int")).otherwise(known)


def clean_facets(facets: Column) -> Column:
    """A map of facets without nulls and without an empty time window."""
    return F.map_filter(facets, lambda k, v: v.isNotNull() & ~((k == "f_TPR") & (v == "")))
