"""Ids and addresses of postings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(c: Column, most: int = 40) -> Column:
    """Runs of other characters as '_', lower case, 'x' if nothing is left, at most `most` characters."""
    text = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.substring(F.coalesce(F.nullif(text, F.lit("")), F.lit("x")), 1, most)


def canonical_url(href: Column, base: str, keep_query: bool = False) -> Column:
    """Absolute and without fragment, without query too unless it is kept."""
    plain = F.regexp_replace(href, "#.*$" if keep_query else "[?#].*$", "")
    return F.when(plain.rlike("^https?://"), plain).when(plain.startswith("/"), F.concat(F.lit(base.rstrip("/")), plain)).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), plain))


def posting_id(url: Column, urn: Column | None = None) -> Column:
    """The number at the end of a posting's path, of currentJobId, or of a urn; null if there is none."""
    found = [F.nullif(F.regexp_extract(url, p, 1), F.lit("")) for p in (r"/jobs/view/(?:[^/?#]*-)?([0-9]+)", r"[?&]currentJobId=([0-9]+)", r"/jobs/[^?#]*?-([0-9]+)(?:[/?#.]|$)")]
    if urn is not None:
        found.append(F.nullif(F.regexp_extract(urn, r"([0-9]+)$", 1), F.lit("")))
    return F.coalesce(*found)


def external_id(url: Column) -> Column:
    return F.concat(F.lit("ext_"), F.substring(F.sha1(url), 1, 20))


def search_url(base: str, keywords: Column, location: Column, page: Column) -> Column:
    return F.concat(F.lit(base + "?keywords="), F.url_encode(keywords), F.lit("&location="), F.url_encode(location), F.lit("&page="), page.cast("string"))


def form_encoded(text: Column) -> Column:
    """A value of a query string: space as '+', letters, digits and `_.-~` as they are, all else as %XX."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _query(base: Column, pairs: list[tuple[str, Column]]) -> Column:
    """base?name=value&...; pairs without a value are left out."""
    return F.concat(base, F.lit("?"), F.concat_ws("&", *[F.concat(F.lit(n + "="), form_encoded(v)) for n, v in pairs]))


def paged_search_url(base: str, keywords: Column, location: Column, geo_id: Column, start: Column, facets: Column) -> Column:
    """Address of the next results of a guest search; facets: map of name -> values, repeated for each value, in the map's order."""
    listed = F.flatten(F.transform(F.map_entries(facets), lambda f: F.transform(f["value"], lambda v: F.concat(form_encoded(f["key"]), F.lit("="), form_encoded(v)))))
    plain = _query(F.lit(base), [("keywords", keywords), ("location", location), ("geoId", geo_id), ("start", start.cast("string"))])
    return F.when(F.size(F.coalesce(listed, F.array().cast("array<string>"))) > 0, F.concat(plain, F.lit("&"), F.array_join(listed, "&"))).otherwise(plain)


def slugged_search_url(base: str, keywords: Column, location: Column, radius: Column, sort: Column, age_days: Column, page: Column) -> Column:
    """Address of a search by slugs of its words and place; sort and age as `intake.sort_code` and `intake.age_days_code` take them. Without words, place or radius it is an error."""
    from postlake.functions import intake

    words, place, code, age = intake.url_slug(keywords), intake.url_slug(location), intake.sort_code(sort), intake.age_days_code(age_days)
    needed = lambda ok, what: F.when(~ok, F.raise_error(F.lit(what)).cast("string"))
    aged = F.concat(F.lit("age_"), age.cast("string"))
    action = F.when(age.isNotNull() & (page == 1), F.concat(F.lit("facet_selected;age;"), aged)).when(page > 1, "paging_next").when(code == 1, "sort_relevance").otherwise("sort_publish")
    made = _query(F.concat(F.lit(base.rstrip("/") + "/jobs/"), words, F.lit("/in-"), place), [
        ("radius", radius.cast("string")), ("sort", code.cast("string")), ("searchOrigin", F.lit("Resultlist_top-search")), ("whereType", F.lit("autosuggest")),
        ("page", F.when(page > 1, page.cast("string"))), ("ag", aged), ("action", action),
    ])
    return F.coalesce(needed(words != "", "keywords are empty"), needed(place != "", "location is empty"), needed(radius > 0, "radius must be positive"), made)


def keyword_search_url(base: str, keywords: Column, location: Column, city_id: Column, since_period: Column) -> Column:
    """Address of a search by keywords and what else is given; blank values are left out, blank keywords are an error."""
    filled = lambda c: F.nullif(F.trim(c), F.lit(""))
    words = F.coalesce(filled(keywords), F.raise_error(F.lit("keywords are empty")).cast("string"))
    return _query(F.lit(base), [("keywords", words), ("location", filled(location)), ("cityId", filled(city_id)), ("sincePeriod", filled(since_period))])
