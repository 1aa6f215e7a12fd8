"""Postings from raw pages: cards of result lists, fields of detail pages, embedded JSON. One narrow stage over a page table each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake.functions import markup, urls
from postlake.operators.extraction import ENTITIES, classify_highlights, first_source, visible_text

# The elements of each field in a platform's detail pages, outer ones first, in the order in which they are tried.
DETAIL_FIELDS: dict[str, dict[str, list[list[markup.Selector]]]] = {
    "linkedin": {
        "job_title": [[("h2", "class", "top-card-layout__title")], [("h2", "class", "topcard__title")], [("h1", "class", "top-card-layout__title")], [("h1", "class", "topcard__title")]],
        "company_name": [[("a", "class", "topcard__org-name-link")], [(r"\w+", "class", "topcard__flavor"), ("a", "href*", "/company/")]],
        "job_location": [[(r"\w+", "class", "topcard__flavor-row"), (r"\w+", "class", "topcard__flavor--bullet")]],
        "posted_time_ago": [[("span", "class", "posted-time-ago__text")]],
        "job_description": [[("div", "class", "description__text--rich"), ("div", "class", "show-more-less-html__markup")], [("div", "class", "description__text--rich")]],
        "contract_type": [],
        "work_type": [],
    },
    "stepstone": {
        "job_title": [[("h1", None, None)]],
        "company_name": [[(r"\w+", "data-at", "metadata-company-name")]],
        "job_location": [[(r"\w+", "data-at", "metadata-location")]],
        "posted_time_ago": [[(r"\w+", "data-at", "metadata-online-date")]],
        "job_description": [],
        "contract_type": [[(r"\w+", "data-at", "metadata-contract-type")]],
        "work_type": [[(r"\w+", "data-at", "metadata-work-type")]],
    },
    "xing": {
        "job_title": [[(r"h1|\w+(?=[^>]*\sdata-testid=[\"']job-details-title[\"'])", None, None)]],
        "company_name": [[(r"\w+", "data-testid", "job-details-company-info-name")]],
        "job_location": [[("div", "class*", "multi-location-display"), ("p", None, None)]],
        "posted_time_ago": [[(r"\w+", "data-testid", "job-details-published-date"), (r"\w+", "aria-hidden", "true")], [(r"\w+", "data-testid", "job-details-published-date")]],
        "job_description": [],
        "contract_type": [],
        "work_type": [],
    },
}
ABOUT = ("About this job", "Über uns", "Stellenbeschreibung")
SECTION_CLASS = "job-ad-display-nfizss"
SALARY_KEYS = ("displayValue", "formatted", "text", "label", "valueText")


def _filled(text: Column) -> Column:
    return F.nullif(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit(""))


def element(page: Column, *path: markup.Selector) -> Column:
    """Visible text of the first element of a path in a page that is cut, null without one."""
    return F.nullif(visible_text(markup.first(page, list(path))), F.lit(""))


def _first(options: list[Column]) -> Column:
    return F.coalesce(*options) if options else F.lit(None).cast("string")


def _sections(page: Column) -> Column:
    """Texts of the ad's sections, joined; those that also stand in the salary part are left out."""

    def texts(part: str) -> Column:
        found = markup.every(page, [(r"\w+", "data-at", part), ("span", "class", SECTION_CLASS)])
        return F.filter(F.transform(found, lambda x: visible_text(x["inside"])), lambda x: x != "")

    return markup.let(texts("job-ad-salary"), lambda salary: F.nullif(F.array_join(F.filter(texts("job-ad-content"), lambda x: ~F.array_contains(salary, x)), " "), F.lit("")))


def chips(page: Column, *paths: list[markup.Selector]) -> Column:
    """Texts of the chips of any of the paths, in page order: of the part that is hidden from readers aloud if there is one, else of all of it."""
    at = F.array_sort(F.array_distinct(F.flatten(F.array(*[markup.places(page, list(p)) for p in paths]))))
    found = F.transform(at, lambda i: markup.inside(page, i))
    text = lambda html: markup.let(markup.cut(html), lambda chip: F.coalesce(element(chip, (r"\w+", "aria-hidden", "true")), visible_text(html)))
    return F.filter(F.transform(found, text), lambda x: x != "")


def detail_fields(pages: DataFrame, platform: str) -> DataFrame:
    """pages with title, company, place, posting time, description, contract and work type of a platform's detail pages; null where absent.

    An element holds all that lies before its own end tag, however deep. For the platform whose details also come with structured data there are
    `posted_at` and `highlights` (ordered chips) too; `merged_detail` puts its sources together.
    """
    cut = "_page"
    while cut in pages.columns:
        cut = "_" + cut
    rows, page = markup.with_cut(pages, cut), F.col(cut)
    fields = {name: _first([element(page, *path) for path in tried]) for name, tried in DETAIL_FIELDS[platform].items()}
    if platform == "stepstone":
        fields["posted_time_ago"] = _filled(F.regexp_replace(fields["posted_time_ago"], r"(?i)^Erschienen:\s*", ""))
        fields["job_description"] = _sections(page)
    if platform == "xing":
        fields["job_description"] = F.nullif(visible_text(markup.around(page, [("h2", None, None)], "section", lambda h: visible_text(h).isin(*ABOUT))), F.lit(""))
        times = markup.every(page, [(r"\w+", "data-testid", "job-details-published-date"), ("time", None, None)])
        fields["posted_at"] = _filled(F.get(F.transform(times, lambda x: markup.attribute(x["tag"], "datetime")), F.lit(0)))
        fields["highlights"] = chips(page, [("ul", "aria-label*", "(?:Main details|Hauptdetails)"), ("li", None, None)])
    return rows.withColumns(fields).drop(cut)


def merged_detail(pages: DataFrame) -> DataFrame:
    """pages with the fields of its three sources, each the first that has one: JSON-LD, the page, the state that a script hands over.

    The description asks the page last; chips give salary and work model before the state does. `sources` names where each field came from.
    """
    rows = markup.made_once(markup.made_once(state_posting(detail_fields(pages, "xing")), "ld", jsonld_posting(F.col("html"))), "chip", classify_highlights(F.col("highlights")))
    c = F.col
    picked = {
        "job_title": {"jsonld": c("ld.title"), "dom": c("job_title"), "state": c("state.title")}, "company_name": {"jsonld": c("ld.company_name"), "dom": c("company_name"), "state": c("state.company_name")},
        "job_location": {"jsonld": c("ld.job_location"), "dom": c("job_location"), "state": c("state.job_location")}, "posted_at": {"jsonld": c("ld.date_posted"), "dom": c("posted_at"), "state": c("state.posted_at")},
        "employment_type": {"jsonld": c("ld.employment_type"), "highlights": c("chip.employment_type"), "state": c("state.employment_type")},
        "job_description": {"jsonld": c("ld.description"), "state": c("state.description"), "dom": c("job_description")},
        "salary_range_text": {"highlights": c("chip.salary"), "state": c("state.salary_range_text")}, "work_model": {"highlights": c("chip.work_model"), "state": c("state.work_model")},
    }
    found = {name: first_source(sources) for name, sources in picked.items()}
    named = F.struct(*[found[n]["source"].alias(n) for n in ("job_title", "company_name", "job_location", "posted_at", "employment_type", "job_description")])
    external = F.coalesce(c("chip.is_external"), F.lit(False)) | F.coalesce(c("state.is_external"), F.lit(False))
    return rows.withColumns({**{n: x["value"] for n, x in found.items()}, "external_ad": external, "sources": named}).drop("ld", "chip", "state")


def detail_outcome(title: Column, status: Column, blocked: Column) -> tuple[Column, Column]:
    """(parse_ok, last_error): blocked, another failed status, no answer at all, or a page without a title."""
    error = F.when(blocked, "blocked").when(status.isNull(), "request_failed").when(status >= 400, F.concat(F.lit("http_"), status.cast("string"))).when(title.isNull(), "missing_job_title")
    return error.isNull(), error


def _cards(pages: DataFrame, path: list[markup.Selector]) -> DataFrame:
    """(page_id, rank, tag, card) of a result list; rank counts all cards from 0, `card` is what one holds, cut."""
    rows = markup.with_cut(pages.select("page_id", "html"), "_page")
    cards = F.transform(markup.every(F.col("_page"), path), lambda x: F.struct(x["tag"].alias("tag"), markup.cut(x["inside"]).alias("card")))
    return rows.select("page_id", F.posexplode(cards).alias("rank", "x")).select("page_id", "rank", F.col("x.tag").alias("tag"), F.col("x.card").alias("card"))


def _first_attribute(card: Column, name: str, *path: markup.Selector) -> Column:
    return F.nullif(F.get(F.transform(markup.every(card, list(path)), lambda x: markup.attribute(x["tag"], name)), F.lit(0)), F.lit(""))


def posting_cards(pages: DataFrame, base: str) -> DataFrame:
    """(page_id, rank, job_id, job_url, title, company, location, posted_at) of a result list; rank counts all cards from 0, cards
    without an address or an id are skipped."""
    rows, card = _cards(pages, [("ul", "class", "jobs-search__results-list"), ("li", None, None)]), F.col("card")
    rows = rows.withColumns({"href": _first_attribute(card, "href", ("a", "class", "base-card__full-link")), "urn": markup.attribute(F.col("tag"), "data-entity-urn")})
    rows = rows.withColumn("job_id", urls.posting_id(F.col("href"), F.coalesce("urn", F.lit("")))).filter("href is not null and job_id is not null")
    return rows.select(
        "page_id", "rank", "job_id", urls.canonical_url(F.col("href"), base).alias("job_url"), element(card, ("h3", "class", "base-search-card__title")).alias("title"),
        F.coalesce(element(card, ("h4", "class", "base-search-card__subtitle")), element(card, ("a", "class", "hidden-nested-link"))).alias("company"),
        element(card, ("span", "class", "job-search-card__location")).alias("location"), F.coalesce(_first_attribute(card, "datetime", ("time", None, None)), element(card, ("time", None, None))).alias("posted_at"),
    )


def numbered_cards(pages: DataFrame, base: str) -> DataFrame:
    """(page_id, rank, job_id, job_url, displayed) of the layout whose cards carry nothing but their id; displayed: how many of them are the search's own results, null
    where the page doesn't say. Cards without a number keep their rank and are skipped."""
    shown = F.regexp_extract("html", r"""(?is)<[^>]*\sdata-resultlist-offers-total=[^>]*\sdata-resultlist-offers-main-displayed=["']([0-9]+)["']""", 1).try_cast("int")
    rows = markup.with_cut(pages.select("page_id", "html"), "_page").withColumn("displayed", shown)
    rows = rows.select("page_id", "displayed", F.posexplode(F.transform(markup.places(F.col("_page"), [("article", "id^", "job-item-")]), lambda i: F.get(F.col("_page.marks"), i))).alias("rank", "tag"))
    job_id = F.nullif(F.regexp_extract(F.trim(markup.attribute(F.col("tag"), "id")), "^job-item-([0-9]+)$", 1), F.lit(""))
    return rows.withColumn("job_id", job_id).filter("job_id is not null").select("page_id", "rank", "job_id", F.concat(F.lit(base.rstrip("/") + "/job/"), "job_id").alias("job_url"), "displayed")


def preview_cards(pages: DataFrame, base: str, host: str) -> DataFrame:
    """(page_id, rank, job_id, job_url, is_external, list_preview) of the layout whose cards show most of a posting. A link that is no posting of the host is an external ad,
    known by a digest of its address; one of the host without the mark of such an ad is skipped."""
    rows, card = _cards(pages, [("article", "data-testid", "job-search-result")]), F.col("card")
    hidden = element(card, ("time", None, None), (r"\w+", "aria-hidden", "true"))
    rows = rows.withColumns({
        "href": _first_attribute(card, "href", ("a", "href*", "")), "highlights": chips(card, [("div", "class*", "job-teaser-facts"), ("span", "role", "status")], [("li", "role", "status")]),
        "job_title": element(card, (r"\w+(?=[^>]*\sdata-testid=[\"']job-teaser-(?:list|card)-title[\"'])", None, None)),
        "company_name": element(card, (r"\w+(?=[^>]*\sdata-testid=[\"']job-teaser-card-company[\"'])|p(?=[^>]*\sclass=[\"'][^\"']*Company-sc)", None, None)),
        "job_location": element(card, ("div", "class*", "multi-location-display"), ("p", None, None)), "posted_at_utc": _first_attribute(card, "datetime", ("time", None, None)),
        "posted_time_ago": F.coalesce(hidden, element(card, ("time", None, None))),
    }).filter("href is not null").withColumn("chip", classify_highlights(F.col("highlights")))
    marked = F.exists("highlights", lambda h: F.lower(h).contains("external job ad")) | F.lower(F.coalesce(markup.attribute(F.col("tag"), "aria-label"), F.lit(""))).contains("external job ad")
    own = F.nullif(F.regexp_extract(F.trim("href"), r"/jobs/[^?#]*?-([0-9]+)(?:[/?#.]|$)", 1), F.lit(""))
    address = urls.canonical_url(F.col("href"), base)
    at_host = F.lower(F.parse_url(address, F.lit("HOST"))).contains(host)
    rows = rows.withColumns({"own": own, "marked": marked, "job_url": address, "at_host": F.coalesce(at_host, F.lit(False))}).filter("own is not null or marked or not at_host")
    external = F.col("own").isNull() | F.col("marked")
    fields = {"job_title": "job_title", "company_name": "company_name", "job_location": "job_location", "posted_at_utc": "posted_at_utc", "posted_time_ago": "posted_time_ago", "employment_type": "chip.employment_type", "salary_range_text": "chip.salary", "work_model": "chip.work_model"}
    preview = F.create_map(*[x for n, c in fields.items() for x in (F.lit(n), F.col(c))], F.lit("external_ad"), external.cast("string"))
    return rows.select("page_id", "rank", F.coalesce("own", urls.external_id(F.col("job_url"))).alias("job_id"), "job_url", external.alias("is_external"), preview.alias("list_preview"))


def fragment_text(html: Column) -> Column:
    """Text of a fragment whose entities may be escaped once: its headings, paragraphs and list items, or all of it without any."""
    plain = html
    for name, value in ENTITIES.items():
        plain = F.replace(plain, F.lit(name), F.lit(value))
    parts = F.regexp_extract_all(plain, F.lit(r"(?is)<(h[1-6]|p|li)\b[^>]*>(.*?)</\1\s*>"), F.lit(2))
    return F.nullif(visible_text(F.when(F.size(parts) > 0, F.array_join(parts, " ")).otherwise(plain)), F.lit(""))


def _objects(raw: Column) -> Column:
    """The JSON objects of a text that holds one or an array of them, as texts; none if it is broken."""
    each = F.when(F.trim(raw).startswith("["), F.from_json(raw, "array<string>")).otherwise(F.array(raw))
    return F.filter(F.coalesce(each, F.array().cast("array<string>")), lambda x: x.isNotNull())


def _joined(parts: list[Column]) -> Column:
    return F.nullif(F.concat_ws(", ", *[_filled(p) for p in parts]), F.lit(""))


def jsonld_posting(html: Column) -> Column:
    """Struct of the first JSON-LD object that is a JobPosting, alone or in an array; null if there is none. The place is the first
    with an address: locality, region, country."""
    blocks = F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script>"), F.lit(1))
    found = F.filter(F.flatten(F.transform(blocks, _objects)), lambda x: F.get_json_object(x, "$['@type']") == "JobPosting")

    def of(posting: Column) -> Column:
        path = lambda p: _filled(F.get_json_object(posting, p))
        where = F.transform(_objects(F.get_json_object(posting, "$.jobLocation")), lambda x: _joined([F.get_json_object(x, f"$.address.address{k}") for k in ("Locality", "Region", "Country")]))
        return F.struct(
            path("$.title").alias("title"), path("$.hiringOrganization.name").alias("company_name"), F.get(F.filter(where, lambda x: x.isNotNull()), F.lit(0)).alias("job_location"),
            path("$.employmentType").alias("employment_type"), path("$.datePosted").alias("date_posted"), fragment_text(F.get_json_object(posting, "$.description")).alias("description"),
        )

    return F.get(F.transform(F.slice(found, 1, 1), of), F.lit(0))


def state_posting(pages: DataFrame) -> DataFrame:
    """pages with `state`: the posting in the state that a script hands to the page, entries found by their references; null without one."""
    rest = F.regexp_extract("html", r"""(?is)<script\b(?=[^>]*\sid=["']runtime-config["'])[^>]*>\s*window\.crate=(.*)""", 1)
    raw = F.coalesce(markup.leading_object(rest), F.lit(""))
    store = F.from_json(F.get_json_object(F.regexp_replace(raw, r"\bundefined\b", "null"), "$.serverData.APOLLO_STATE"), "map<string,string>")
    rows = markup.made_once(pages, "_store", store)
    is_job = lambda x: F.coalesce(x.startswith("VisibleJob:"), F.lit(False))
    root = F.map_values(F.from_json(F.try_element_at("_store", F.lit("ROOT_QUERY")), "map<string,string>"))
    asked = F.filter(F.transform(root, lambda v: F.get_json_object(v, "$.__ref")), is_job)
    ref = F.coalesce(F.get(asked, F.lit(0)), F.get(F.filter(F.map_keys("_store"), is_job), F.lit(0)))
    rows = markup.made_once(rows, "_job", F.try_element_at("_store", ref))
    at = lambda p: F.get_json_object("_job", p)
    follow = lambda p, q: F.coalesce(F.get_json_object(F.try_element_at("_store", at(f"{p}.__ref")), f"$.{q}"), at(f"{p}.{q}"))
    options = F.upper(F.coalesce(at("$.remoteOptions"), F.lit("")))
    away = F.coalesce(at("$.redirectsToThirdPartyUrl"), F.lit(""))
    state = F.struct(
        _filled(at("$.title")).alias("title"), F.coalesce(_filled(at("$.companyInfo.companyNameOverride")), _filled(follow("$.companyInfo.company", "companyName"))).alias("company_name"),
        _joined([at("$.location.city"), at("$.location.region"), F.coalesce(_filled(at("$.location.country.localizationValue")), at("$.location.country.countryCode"))]).alias("job_location"),
        _filled(follow("$.employmentType", "localizationValue")).alias("employment_type"), F.coalesce(_filled(at("$.activatedAt")), _filled(at("$.refreshedAt"))).alias("posted_at"),
        fragment_text(at("$.description.content")).alias("description"), F.coalesce(*[_filled(at(f"$.salary.{k}")) for k in SALARY_KEYS]).alias("salary_range_text"),
        F.when(options.contains("HYBRID"), "Hybrid").when(options.contains("NON_REMOTE"), "On-site").when(options.contains("REMOTE"), "Remote").alias("work_model"),
        (~F.lower(away).isin("", "false", "null", "0")).alias("is_external"),
    )
    return rows.withColumn("state", F.when(F.col("_job").isNotNull(), state)).drop("_store", "_job")
