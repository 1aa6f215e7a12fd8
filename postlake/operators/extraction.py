"""Fields of raw pages as column expressions: one narrow stage over a page table.

The patterns take one level of a tag: a tag nested in another of the same name ends the outer one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import markup, urls

# Answers and texts of each platform that mean a request was shut out; "" holds for pages of unknown origin.
BLOCK_STATUS = {"": (403, 429, 503), "linkedin": (403, 429, 999), "stepstone": (403, 429, 503), "xing": (403, 429, 503)}
BLOCK_MARKERS = {
    "": ("captcha", "access denied", "unusual traffic", "are you a human"),
    "linkedin": ("security verification", "verify you are a human", "unusual activity", "captcha"),
    "stepstone": ("access denied", "errors.edgesuite.net", "verify you are a human", "captcha", "temporarily blocked"),
    "xing": ("access denied", "verify you are a human", "captcha", "temporarily blocked", "errors.edgesuite.net"),
}
BLOCK_PATHS = {"linkedin": "/checkpoint/"}
# What a salary looks like, and chips that say nothing about the job.
SALARY = r"[€$£]|\b\d{2,3}(?:[\.,]\d{3})+(?:\s?[–-]\s?\d{2,3}(?:[\.,]\d{3})+)?"
BADGES = ("urgently hiring", "actively recruiting", "be an early applicant", "last chance", "new")
# The entities that are resolved.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def visible_text(html: Column) -> Column:
    """Without scripts, styles and tags; entities resolved; single spaces."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)\b[^>]*>.*?</(?:script|style)>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->|<[^>]*>", " ")
    for name, value in ENTITIES.items():
        text = F.replace(text, F.lit(name), F.lit(value))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def tag(html: Column, name: str, group: int = 1) -> Column:
    """Visible text of the first tag of a name, null if there is none."""
    return F.nullif(visible_text(F.regexp_extract(html, rf"(?is)<{name}\b[^>]*>(.*?)</{name}>", group)), F.lit(""))


def is_blocked(html: Column, status: Column | None = None, url: Column | None = None, platform: str = "") -> Column:
    """Whether the status, a text in the page or the address says so; a missing one says nothing."""
    low = F.lower(F.coalesce(html, F.lit("")))
    found = F.lit(False)
    for m in BLOCK_MARKERS[platform]:
        found = found | low.contains(m)
    if status is not None:
        found = found | F.coalesce(status.isin(*BLOCK_STATUS[platform]), F.lit(False))
    if url is not None and platform in BLOCK_PATHS:
        found = found | F.coalesce(url.contains(BLOCK_PATHS[platform]), F.lit(False))
    return found


def dom_fields(pages: DataFrame) -> DataFrame:
    """page_id, url, title (h1, else title), n_links, n_items, text, blocked, parse_ok, last_error."""
    html = F.col("html")
    rows = pages.select(
        "page_id", "url", F.coalesce(tag(html, "h1"), tag(html, "title")).alias("title"), F.size(F.regexp_extract_all(html, F.lit(r"(?i)<a\s[^>]*href"), F.lit(0))).alias("n_links"),
        F.size(F.regexp_extract_all(html, F.lit(r"(?i)<li\b"), F.lit(0))).alias("n_items"), visible_text(html).alias("text"), is_blocked(html).alias("blocked"),
    )
    ok = ~F.col("blocked") & F.col("title").isNotNull()
    return rows.withColumns({"parse_ok": ok, "last_error": F.when(F.col("blocked"), "blocked").when(F.col("title").isNull(), "no_title")})


def list_cards(pages: DataFrame, base: str, card: str = r'(?is)<a\s[^>]*href="([^"]*)"[^>]*>(.*?)</a>') -> DataFrame:
    """A row for each link: page_id, rank (its place, from 1), url, label. Cards without an address are skipped, the others keep their rank."""
    hits = F.regexp_extract_all("html", F.lit(card), F.lit(0))
    rows = pages.select("page_id", F.posexplode(hits).alias("pos", "card"))
    href, label = F.regexp_extract("card", card, 1), visible_text(F.regexp_extract("card", card, 2))
    return rows.select("page_id", (F.col("pos") + 1).alias("rank"), href.alias("href"), label.alias("label")).filter("href <> ''").withColumn("url", urls.canonical_url(F.col("href"), base)).drop("href")


def counters(html: Column) -> Column:
    """data-*-count attributes as a map of numbers."""
    pairs = F.regexp_extract_all(html, F.lit(r'data-([a-z-]+)-count="([0-9]+)"'), F.lit(0))
    return F.map_from_entries(F.transform(F.array_distinct(pairs), lambda p: F.struct(F.regexp_extract(p, r"data-([a-z-]+)-count", 1), F.regexp_extract(p, r'"([0-9]+)"', 1).cast("int"))))


def classify_highlights(chips: Column) -> Column:
    """Salary, work model and employment type of ordered chips, and whether one marks an external ad. Each chip counts once: as that
    mark, else as the salary, the work model or the employment type, whichever fits first and is still open; badges are none of them."""
    text = "string"
    start = F.struct(F.lit(None).cast(text).alias("salary"), F.lit(None).cast(text).alias("work_model"), F.lit(None).cast(text).alias("employment_type"), F.lit(False).alias("is_external"))

    def step(seen: Column, chip: Column) -> Column:
        low = F.lower(chip)
        model = F.when(low.contains("hybrid"), "Hybrid").when(low.contains("remote"), "Remote").when(low.rlike("on-site|onsite|vor ort"), "On-site")
        mark = low.contains("external job ad")
        salary = ~mark & seen["salary"].isNull() & chip.rlike(SALARY)
        work = ~mark & ~salary & seen["work_model"].isNull() & model.isNotNull()
        kind = ~mark & ~salary & ~work & seen["employment_type"].isNull() & ~low.isin(*BADGES)
        return F.struct(F.when(salary, chip).otherwise(seen["salary"]).alias("salary"), F.when(work, model).otherwise(seen["work_model"]).alias("work_model"), F.when(kind, chip).otherwise(seen["employment_type"]).alias("employment_type"), (seen["is_external"] | mark).alias("is_external"))

    return F.aggregate(F.filter(F.coalesce(chips, F.array().cast("array<string>")), lambda x: F.trim(x) != ""), start, step)


def criteria(html: Column, labels: dict[str, str]) -> Column:
    """Map of key -> text from headings followed by a value (h3, then span), by a table of labels in lower case; unknown labels are left out."""
    pair = r"(?is)<h3\b[^>]*>(.*?)</h3>\s*<span\b[^>]*>(.*?)</span>"
    found = F.transform(F.regexp_extract_all(html, F.lit(pair), F.lit(0)), lambda p: F.struct(F.lower(visible_text(F.regexp_extract(p, pair, 1))).alias("label"), visible_text(F.regexp_extract(p, pair, 2)).alias("value")))
    table = F.create_map(*[F.lit(x) for item in labels.items() for x in item])
    keyed = F.filter(F.transform(found, lambda x: F.struct(F.element_at(table, x["label"]).alias("key"), x["value"].alias("value"))), lambda x: x["key"].isNotNull())
    names = F.array_distinct(F.transform(keyed, lambda x: x["key"]))
    return F.map_from_entries(F.transform(names, lambda n: F.struct(n, F.element_at(F.filter(keyed, lambda x: x["key"] == n), -1)["value"])))  # the last one counts


def facet_options(pages: DataFrame) -> DataFrame:
    """(page_id, facet, label, value) of filter inputs whose label follows; a count in brackets at the label's end is cut."""
    one = r'(?is)<input\b[^>]*name="(f_[A-Z]+)"[^>]*value="([^"]*)"[^>]*>\s*<label\b[^>]*>(.*?)</label>'
    rows = pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit(one), F.lit(0))).alias("x"))
    label = F.regexp_replace(visible_text(F.regexp_extract("x", one, 3)), r"\s*\([0-9.,]+\)$", "")
    return rows.select("page_id", F.regexp_extract("x", one, 1).alias("facet"), label.alias("label"), F.regexp_extract("x", one, 2).alias("value"))


def section_markers(html: Column, patterns: list[str]) -> Column:
    """Visible h3 and h4 headings that match one of the patterns, in order."""
    heads = F.transform(F.regexp_extract_all(html, F.lit(r"(?is)<h[34]\b[^>]*>(.*?)</h[34]>"), F.lit(1)), lambda h: visible_text(h))
    return F.filter(heads, lambda h: h.rlike("(?i)" + "|".join(f"(?:{p})" for p in patterns)) if patterns else F.lit(False))


def main_results(cards: DataFrame, displayed: Column) -> DataFrame:
    """Cards up to the number that the page says are its own results; all where it does not say. The rank counts from 1."""
    return cards.filter(displayed.isNull() | (F.col("rank") <= displayed))


def no_results(html: Column) -> Column:
    """(keywords, title_text, subheading) of the box that says that nothing was found; null without it."""
    box = F.regexp_extract(html, r"""(?is)<section\b[^>]*class=["'](?:[^"']*\s)?no-results(?:\s[^"']*)?["'][^>]*>.*?</section>""", 0)
    of = lambda kind: F.nullif(visible_text(F.regexp_extract(box, rf"""(?is)<(\w+)\b[^>]*class=["'](?:[^"']*\s)?no-results__{kind}(?:\s[^"']*)?["'][^>]*>(.*?)</\1>""", 2)), F.lit(""))
    return F.when(box != "", F.struct(of("main-title-keywords").alias("keywords"), tag(box, "h1").alias("title_text"), of("subheading").alias("subheading")))


def has_more(html: Column, label: str = "show more") -> Column:
    return F.exists(F.regexp_extract_all(html, F.lit(r"(?is)<button\b[^>]*>(.*?)</button>"), F.lit(1)), lambda b: F.lower(visible_text(b)).contains(label))


def runtime_state(html: Column, variable: str, path: str) -> Column:
    """A value of the JSON that a script assigns to a variable; `undefined` in it reads as null."""
    raw = markup.leading_object(F.regexp_extract(html, rf"(?s){variable}\s*=\s*(\{{.*)", 1))
    return F.get_json_object(F.regexp_replace(raw, r"\bundefined\b", "null"), path)


def first_source(sources: dict[str, Column]) -> Column:
    """(value, source) of the first source in order that has a text."""
    filled = [F.when(F.trim(c) != "", F.struct(F.trim(c).alias("value"), F.lit(n).alias("source"))) for n, c in sources.items()]
    return F.coalesce(*filled)
