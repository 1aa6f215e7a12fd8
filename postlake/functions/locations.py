"""Free-text locations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
REMOTE_PATTERN = r"(remote|bundesweit|deutschlandweit|home\s*-?office|homeoffice|wfh|mobil|hybrid)"
REMOTE_MODELS = ("Remote", "Hybrid")
ADMIN_REGIONS = (
    "bavaria", "bayern", "baden-württemberg", "baden-wurttemberg", "north rhine-westphalia", "nordrhein-westfalen", "lower saxony", "niedersachsen", "hesse", "hessen",
    "saxony", "sachsen", "saxony-anhalt", "sachsen-anhalt", "thuringia", "thüringen", "thueringen", "rhineland-palatinate", "rheinland-pfalz", "schleswig-holstein",
    "saarland", "brandenburg", "mecklenburg-vorpommern", "mecklenburg western pomerania", "greater munich metropolitan area", "kanton zürich", "canton zurich",
)
STOP_TOKENS = (
    "remote", "bundesweit", "deutschlandweit", "home office", "home-office", "homeoffice", "hybrid", "mobil", "wfh", "de", "at", "ch", "dach",
    "germany", "deutschland", "austria", "oesterreich", "österreich", "switzerland", "schweiz",
)
REMOTE_LABEL = "Remote / Bundesweit"
#: South, north, west and east edges of the box in which remote postings are scattered.
BOX = (47.27, 55.06, 5.87, 15.04)
SPLIT = r"\s*(?:,|/|\|)\s*"
EDGES = r"^[,;\-\s\(\)\[\]]+|[,;\-\s\(\)\[\]]+$"
MOST_TOKENS = 10


def canonical(text: Column) -> Column:
    """Lower case without bracketed parts, single spaces, null if empty."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\([^\)]*\)", " ")
    return F.nullif(F.trim(F.regexp_replace(plain, r"\s+", " ")), F.lit(""))


def clean_token(token: Column) -> Column:
    """A token without remote words and edge punctuation, null if empty."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(token, F.lit(""))), REMOTE_PATTERN, " "), r"\s+", " ")
    return F.nullif(F.trim(F.regexp_replace(plain, EDGES, "")), F.lit(""))


def is_city(token: Column) -> Column:
    return token.isNotNull() & (F.length(token) >= 2) & ~token.isin(*STOP_TOKENS)


def city_tokens(canon: Column) -> Column:
    """Array of (ord, token): distinct city tokens of a location, each at its first place; filtered before any row is made."""
    parts = F.transform(F.split(F.coalesce(canon, F.lit("")), SPLIT), lambda x, i: F.struct((i + 1).alias("ord"), clean_token(x).alias("token")))
    cities = F.filter(parts, lambda p: is_city(p["token"]))
    names = F.array_distinct(F.transform(cities, lambda p: p["token"]))
    return F.transform(names, lambda n: F.struct(F.array_min(F.transform(F.filter(cities, lambda p: p["token"] == n), lambda p: p["ord"])).alias("ord"), n.alias("token")))


def is_remote_like(location: Column, homeoffice: Column, model: Column) -> Column:
    """Three-valued: null where nothing speaks for it and the work model is unknown."""
    return (location.isNotNull() & location.rlike("(?i)" + REMOTE_PATTERN)) | F.coalesce(homeoffice, F.lit(False)) | model.isin(*REMOTE_MODELS)


def initcap_words(text: Column) -> Column:
    """Capitals at the start of every run of letters and digits, as after '-' too."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0)), lambda w: F.initcap(w)), "")


def location_norm(text: Column) -> Column:
    """A whole location: single spaces, ', ' between parts, lower case, null if empty."""
    return F.nullif(F.lower(F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "), r"\s*,\s*", ", "))), F.lit(""))


def country_scope(platform: Column) -> Column:
    return F.when(platform.isin("linkedin", "stepstone"), "de").otherwise("de,at,ch")


def scatter(key: Column, low: float, high: float) -> Column:
    """A fixed pseudo-random number of [low, high] for a key."""
    return F.lit(low) + F.xxhash64(key).bitwiseAND(F.lit((1 << 63) - 1)).cast("double") / F.lit(float((1 << 63) - 1)) * F.lit(high - low)
