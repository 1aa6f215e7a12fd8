"""Registered queries over raw pages of all three layouts, and the same in SQL with plain values."""

from __future__ import annotations

from pyspark.sql import functions as F

from postlake.operators import extraction, postings
from postlake.queries import query
from postlake.sources import star

lit = F.lit
#: Every text of documents as plain words, so that it can stand in a page as it is.
_WORDS = "trim(regexp_replace(coalesce(text, ''), '[^A-Za-z]+', ' ', 'g'))"


def _documents(spark, sf):
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z]+", " "))
    return star.table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), words.alias("words"), F.col("doc_id").cast("string").alias("s"))


def _all(*parts):
    return F.concat(*[lit(p) if isinstance(p, str) else p for p in parts])


@query("nested_details", f"""select doc_id as page_id, case doc_id % 3 when 0 then 'linkedin' when 1 then 'stepstone' else 'xing' end as platform, case doc_id % 3 when 2 then 'Engineer ' || doc_id else 'Lead & ' || doc_id end as job_title,
'Firm ' || doc_id as company_name, case doc_id % 3 when 2 then 'Ulm' else 'Bonn, NRW' end as job_location, case doc_id % 3 when 0 then '2 hours ago' when 1 then 'vor 1 Tag' else '5 days ago' end as posted_time_ago,
case doc_id % 3 when 0 then trim(t || ' one inner ' || doc_id || ' tail ' || doc_id) when 1 then trim(t || ' one two ' || doc_id || ' three') else trim('About this job ' || t || ' inner ' || doc_id || ' end') end as job_description
from (select doc_id, {_WORDS} as t from documents) q""")
def nested_details(spark, sf):
    rows = _documents(spark, sf)
    t, s = F.col("words"), F.col("s")
    linkedin = _all('<section><!-- <h2 class="topcard__title">no</h2> --><a class="topcard__link" href="/x"><h2 class="a top-card-layout__title b">Lead <span>&amp;</span> ', s, '</h2></a><h4><div class="topcard__flavor-row"><span class="topcard__flavor"><a href=\'https://x.org/company/1>2\'>Firm ', s,
                    '</a></span><span class="topcard__flavor topcard__flavor--bullet">Bonn, <span>NRW</span></span></div><div class="topcard__flavor-row"><span class="posted-time-ago__text">2 hours ago</span></div></h4></section><span class="topcard__flavor--bullet">elsewhere</span>',
                    '<div class="show-more-less-html__markup">not inside</div><div class="description__text description__text--rich"><section><div class="show-more-less-html__markup x"><div><div>', t, "</div> one <div>inner ", s, "<br></div></div> tail ", s, "</div></section> beyond</div><div>after</div>")
    stepstone = _all("<h1>Lead &amp; <b>", s, '</b></h1><li><span data-at="metadata-company-name"><style>.x>y{color:red}</style><span>Firm</span> ', s, '</span></li><span data-at="metadata-location">Bonn, <span>NRW</span></span><span data-at="metadata-online-date"><span>Erschienen:</span> vor 1 Tag</span>',
                     '<div data-at="job-ad-content"><div><span class="job-ad-display-nfizss">', t, '<span> one</span></span></div><div><span class="job-ad-display-nfizss">two <span>', s, '</span></span><span class="job-ad-display-nfizss">pay</span></div><span class="job-ad-display-nfizss">three</span></div><div data-at="job-ad-salary"><span class="job-ad-display-nfizss">pay</span></div>')
    xing = _all('<h1>Engineer <span><span>', s, '</span></span></h1><p data-testid="job-details-company-info-name"><span>Firm</span> ', s, '</p><div class="a multi-location-display-b"><div><p>Ulm</p></div></div><p data-testid="job-details-published-date"><time datetime="2026-02-01T08:30:00Z"><span aria-hidden="true">5 days ago</span></time></p>',
                "<section>outer <section><h2>About this job</h2><div><div>", t, "</div><div>inner ", s, "</div></div> end</section> more</section>")
    each = [postings.detail_fields(rows.filter(F.col("page_id") % 3 == k).withColumn("html", html), name).withColumn("platform", lit(name)) for k, (name, html) in enumerate({"linkedin": linkedin, "stepstone": stepstone, "xing": xing}.items())]
    names = ("page_id", "platform", "job_title", "company_name", "job_location", "posted_time_ago", "job_description")
    return each[0].select(*names).unionByName(each[1].select(*names)).unionByName(each[2].select(*names))


@query("merged_details", f"""select doc_id as page_id, case when doc_id % 2 = 0 then 'Ld ' || doc_id when doc_id % 3 = 0 then 'Dom ' || doc_id else 'State ' || doc_id end as job_title, case when doc_id % 2 = 0 then 'jsonld' when doc_id % 3 = 0 then 'dom' else 'state' end as title_source,
case when doc_id % 2 = 0 then 'Full-time' when doc_id % 5 = 0 then 'Part-time' else 'Contract' end as employment_type, case when doc_id % 2 = 0 then 'jsonld' when doc_id % 5 = 0 then 'highlights' else 'state' end as employment_source,
case when doc_id % 5 = 0 then '€64,000 – €78,500' else '50 an hour' end as salary_range_text, case when doc_id % 5 = 0 then 'Remote' else 'Hybrid' end as work_model, t || ' }} "quoted" ' || doc_id as job_description, 'state' as description_source,
doc_id % 5 = 0 as external_ad from (select doc_id, ltrim({_WORDS} || ' in text') as t from documents) q""")
def merged_details(spark, sf):
    rows, s, k = _documents(spark, sf), F.col("s"), F.col("page_id")
    ld = F.when(k % 2 == 0, _all('<script type="application/ld+json">{"@type":"JobPosting","title":"Ld ', s, '","employmentType":"Full-time"}</script>')).otherwise("")
    dom = F.when(k % 3 == 0, _all("<h1>Dom ", s, "</h1>")).otherwise("")
    chips = F.when(k % 5 == 0, lit('<ul aria-label="Main details for this job:"><li><span>External job ad</span></li><li>Part-time</li><li><span>€64,000 – €78,500</span></li><li><span aria-hidden="true">Fully remote</span> read out</li><li>Urgently hiring</li></ul>')).otherwise("")
    text = F.ltrim(F.concat("words", lit(" in text")))
    state = _all('<script id="runtime-config">window.crate={"a":undefined,"b":"{","serverData":{"APOLLO_STATE":{"VisibleJob:1":{"title":"State ', s, '","description":{"content":"', text, ' }</script> \\"quoted\\" ', s, '"},"employmentType":{"localizationValue":"Contract"},"salary":{"text":"50 an hour"},"remoteOptions":["HYBRID"]}}}};</script>')
    found = postings.merged_detail(rows.withColumn("html", F.concat(dom, chips, ld, state)))
    return found.select("page_id", "job_title", F.col("sources.job_title").alias("title_source"), "employment_type", F.col("sources.employment_type").alias("employment_source"), "salary_range_text", "work_model", "job_description", F.col("sources.job_description").alias("description_source"), "external_ad")


@query("numbered_cards", """select page_id, cast(rank as bigint) as rank, job_id, 'https://s.example.org/job/' || job_id as job_url, cast(1 + page_id % 2 as integer) as displayed, rank < 1 + page_id % 2 as own
from (select page_id, 0 as rank, page_id || '1' as job_id from pages union all select page_id, 1, page_id || '2' from pages union all select page_id, 3, page_id || '4' from pages) q""")
def numbered_cards(spark, sf):
    pages, s = star.table(spark, sf, "pages"), F.col("page_id").cast("string")
    card = lambda n: _all('<article id="job-item-', s, f'{n}" class="res" data-at="job-item"><h2>x</h2></article>')
    shown = (1 + F.col("page_id") % 2).cast("string")
    html = F.concat("html", _all('<div data-resultlist-offers-numbers="" data-resultlist-offers-total="1265" data-resultlist-offers-main-displayed="', shown, '">'), card(1), lit("<div>"), card(2), lit('</div><article id="job-item-x"></article>'), card(4), lit("</div>"))
    rows = postings.numbered_cards(pages.withColumn("html", html), "https://s.example.org/")
    own = extraction.main_results(rows.withColumn("rank", F.col("rank") + 1), F.col("displayed")).select("page_id", "job_id", lit(True).alias("own"))
    return rows.join(own, ["page_id", "job_id"], "left").select("page_id", F.col("rank").cast("long").alias("rank"), "job_id", "job_url", "displayed", F.coalesce("own", lit(False)).alias("own"))


@query("preview_cards", """select page_id, cast(0 as bigint) as rank, cast(page_id as varchar) as job_id, 'https://x.example.org/jobs/berlin-data-' || page_id as job_url, false as is_external, 'Data & ' || page_id as job_title, 'Acme' as company_name, 'Berlin' as job_location, '3 days ago' as posted_time_ago,
  'Full-time' as employment_type, '€50,000' as salary_range_text, 'Hybrid' as work_model from pages
union all select page_id, 2, 'ext_' || substr(sha1('https://other.org/job/' || page_id), 1, 20), 'https://other.org/job/' || page_id, true, null, 'Beta', null, 'today', null, null, null from pages
union all select page_id, 3, page_id || '7', 'https://x.example.org/jobs/ulm-dev-' || page_id || '7', true, 'Dev', null, null, null, null, null, 'Remote' from pages""")
def preview_cards(spark, sf):
    pages, s = star.table(spark, sf, "pages"), F.col("page_id").cast("string")
    first = _all('<li><article data-testid="job-search-result"><article>nested</article><a href="/jobs/berlin-data-', s, '?trk=1"><h2 data-testid="job-teaser-list-title"><span>Data</span> &amp; ', s, '</h2></a><p class="x Company-sc-1">Acme</p><div class="multi-location-display-1"><div><p>Berlin</p></div></div><time datetime="2026-02-01"><span aria-hidden="true">3 days ago</span></time>',
                 '<div class="job-teaser-facts"><span role="status"><span aria-hidden="true">Full-time</span></span><span role="status">€50,000</span><span role="status">Hybrid</span></div></article></li>')
    inner = lit('<article data-testid="job-search-result"><a href="/companies/acme">about</a></article>')
    other = _all('<article data-testid="job-search-result"><a href="https://other.org/job/', s, '?x=1#y">ad</a><p data-testid="job-teaser-card-company">Beta</p><time>today</time></article>')
    marked = _all('<article aria-label="External job ad" data-testid="job-search-result"><a href="/jobs/ulm-dev-', s, '7">x</a><h3 data-testid="job-teaser-card-title">Dev</h3><ul><li role="status">Remote</li></ul></article>')
    rows = postings.preview_cards(pages.withColumn("html", F.concat("html", first, inner, other, marked)), "https://x.example.org", "x.example.org")
    fields = ("job_title", "company_name", "job_location", "posted_time_ago", "employment_type", "salary_range_text", "work_model")
    return rows.select("page_id", F.col("rank").cast("long").alias("rank"), "job_id", "job_url", "is_external", *[F.col("list_preview")[c].alias(c) for c in fields])
