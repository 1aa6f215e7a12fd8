"""Relative posting times in English and German."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keywords, and units with the interval part and factor that each stands for.
NOW_WORDS = ("today", "heute", "just now", "gerade eben")
YESTERDAY_WORDS = ("yesterday", "gestern")
UNITS_EN = {"minute": ("mins", 1), "hour": ("hours", 1), "day": ("days", 1), "week": ("days", 7), "month": ("months", 1), "year": ("years", 1)}
UNITS_DE = {
    "minute": ("mins", 1), "minuten": ("mins", 1), "stunde": ("hours", 1), "stunden": ("hours", 1), "tag": ("days", 1), "tagen": ("days", 1),
    "woche": ("days", 7), "wochen": ("days", 7), "monat": ("months", 1), "monaten": ("months", 1), "jahr": ("years", 1), "jahren": ("years", 1),
}

PATTERN_EN = r"^([0-9]+)\s+(" + "|".join(f"{u}s?" for u in UNITS_EN) + r")\s+ago$"
PATTERN_DE = r"^vor\s+([0-9]+)\s+(" + "|".join(sorted(UNITS_DE, key=len, reverse=True)) + ")$"


def normalized(text: Column) -> Column:
    """Lower case without the prefix 'published:' and outer spaces; null if nothing is left."""
    return F.nullif(F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?i)^\s*published:\s*", ""))), F.lit(""))


def is_keyword(norm: Column) -> Column:
    return norm.isin(*NOW_WORDS, *YESTERDAY_WORDS)


def amount(norm: Column) -> Column:
    """The number of a relative time in either language, null if there is none or it is too large for an int."""
    raw = F.when(norm.rlike(PATTERN_EN), F.regexp_extract(norm, PATTERN_EN, 1)).when(norm.rlike(PATTERN_DE), F.regexp_extract(norm, PATTERN_DE, 1))
    return raw.try_cast("int")


def unit(norm: Column) -> Column:
    """The unit word as written."""
    return F.when(norm.rlike(PATTERN_EN), F.regexp_extract(norm, PATTERN_EN, 2)).when(norm.rlike(PATTERN_DE), F.regexp_extract(norm, PATTERN_DE, 2))


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once: what stands inside is not copied where the optimizer joins projections or moves filters."""
    return F.element_at(F.transform(F.array(value), body), 1)


def parsed(text: Column, at: Column) -> Column:
    """(norm, unit, english, at) of a relative posting time that was read at `at`."""

    def made(norm: Column) -> Column:
        fields = F.struct(amount(norm).alias("n"), unit(norm).alias("unit"))
        return once(fields, lambda x: F.struct(norm.alias("norm"), x["unit"].alias("unit"), norm.rlike(PATTERN_EN).alias("english"), back_from(at, norm, x["n"], x["unit"]).alias("at")))

    return once(normalized(text), made)


def back_from(at: Column, norm: Column, n: Column, word: Column) -> Column:
    """`at` less the relative time: months and years are calendar steps that clamp at the month's end."""
    single = {f"{u}{s}": v for u, v in UNITS_EN.items() for s in ("", "s")} | UNITS_DE
    slots = {}
    for slot in ("years", "months", "days", "hours", "mins"):
        value = F.lit(0)
        for factor in (1, 7):
            words = [w for w, v in single.items() if v == (slot, factor)]
            if words:
                value = F.when(word.isin(*words), n * factor).otherwise(value)
        slots[slot] = value
    moved = at - F.make_interval(years=slots["years"], months=slots["months"], days=slots["days"], hours=slots["hours"], mins=slots["mins"])
    return F.when(norm.isin(*NOW_WORDS), at).when(norm.isin(*YESTERDAY_WORDS), at - F.expr("INTERVAL 1 DAY")).when(n.isNotNull() & word.isNotNull(), moved)
